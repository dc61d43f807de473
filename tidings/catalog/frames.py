"""Queries over the cleaning, joining and counting operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.catalog import inputs
from tidings.catalog.inputs import CLEAN_CTE, HEADLINES_CTE, TAGGED_CTE, duck_strip
from tidings.catalog.registry import query
from tidings.functions import text as T
from tidings.operators import frames

NUMERIC = "'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?'"


@query("l14_training_frame", f"""with {CLEAN_CTE}
select min(id) as id, sentence, label from joined group by sentence, label""")
def l14(spark, sf):
    return frames.event_type_training_frame(inputs.headlines(spark, sf), inputs.tagged(spark, sf))


@query("l15_gold_frame", f"""with {CLEAN_CTE}
select id, sentence, label, {duck_strip("coalesce(KTO,'')")} as gold_who, {duck_strip("coalesce(CO,'')")} as gold_what,
 {duck_strip("coalesce(TRIGGER,'')")} as gold_trigger, {duck_strip("coalesce(GDZIE,'')")} as gold_where,
 {duck_strip("coalesce(KIEDY,'')")} as gold_when from joined""")
def l15(spark, sf):
    return frames.relation_gold_frame(inputs.headlines(spark, sf), inputs.tagged(spark, sf))


@query("l13_gold_join_null_keys", f"""with {CLEAN_CTE}
select h.id, label, count(*) as n from h join t on h.id is not distinct from t.id group by h.id, label""")
def l13_match(spark, sf):
    """Counted on both sides before the join: ids that are no numbers are one key, whose pairs are never made."""
    left = inputs.headlines(spark, sf).groupBy(T.to_number(F.col("id")).cast("string").alias("id")).agg(F.count("*").alias("n_left"))
    label = T.normalize_label(F.col("kategoria")).alias("label")
    right = inputs.tagged(spark, sf).groupBy(T.to_number(F.col("id")).cast("string").alias("id"), label).agg(F.count("*").alias("n_right"))
    joined = frames.gold_join(left, right, "match")
    return joined.select("id", "label", (F.col("n_left") * F.col("n_right")).alias("n"))


@query("l13_gold_join", f"""with {CLEAN_CTE}
select h.id, label, length(sentence) as n_chars from h join t on h.id=t.id""")
def l13(spark, sf):
    joined = frames.gold_join(
        inputs.headlines(spark, sf), inputs.tagged(spark, sf).select("id", "kategoria")
    )
    return joined.select(
        "id",
        T.normalize_label(F.col("kategoria")).alias("label"),
        F.length(T.py_strip(F.col("headline"))).alias("n_chars"),
    )


_MISSING = {"id": "id", "KTO": "who", "CO": "what", "TRIGGER": "trigger", "GDZIE": "where", "KIEDY": "when"}


@query("l03_missing_tokens", f"""with {TAGGED_CTE}
select kategoria, count(*) as n, {', '.join(f"sum(case when {c} is null or {c}='NA' then 1 else 0 end)::bigint as missing_{name}" for c, name in _MISSING.items())}
from tagged group by kategoria""")
def l03(spark, sf):
    clean = inputs.tagged(spark, sf).select(*[T.missing_to_null(F.col(c)).alias(c) for c in frames.TAGGED_COLUMNS])
    missing = [F.sum(F.col(c).isNull().cast("bigint")).alias(f"missing_{name}") for c, name in _MISSING.items()]
    return clean.groupBy("kategoria").agg(F.count("*").alias("n"), *missing)


@query("l05_coerce_id", f"""with {HEADLINES_CTE}
select id as raw, case when regexp_full_match(id,{NUMERIC}) then cast(id as double) end as id from headlines
union all
select props as raw, case when regexp_full_match(value_text,{NUMERIC}) then cast(value_text as double) end as id
from (select props, cast(event_id%100 as varchar)||case event_id%4 when 0 then '' when 1 then 'd' when 2 then 'e2' else '.5f' end as value_text from events)""")
def l05(spark, sf):
    plain = inputs.headlines(spark, sf).select(
        F.col("id").alias("raw"), T.to_number(F.col("id")).alias("id")
    )
    events = inputs.table(spark, sf, "events").selectExpr(
        "props as raw",
        "cast(event_id%100 as string)||case event_id%4 when 0 then '' when 1 then 'd' when 2 then 'e2' else '.5f' end as text",
    )
    return plain.union(events.select("raw", T.to_number(F.col("text"))))


@query("l06_normalize_label", f"""select doc_id, label from (select doc_id, {duck_strip("split_part(raw,'(',1)")} as label from
 (select doc_id, chr(160)||' '||case when quality=1 then 'A (x)' when toxic=1 then '(y)' else ' B'||chr(8195) end||chr(10) as raw from labels))""")
def l06(spark, sf):
    raw = inputs.table(spark, sf, "labels").selectExpr(
        "doc_id",
        "char(160)||' '||case when quality=1 then 'A (x)' when toxic=1 then '(y)' else ' B\\u2003' end||char(10) as raw",
    )
    return raw.select("doc_id", T.normalize_label(F.col("raw")).alias("label"))


@query("l07_strip", f"""select doc_id, {duck_strip("chr(10)||chr(160)||text||chr(28)||chr(9)")} as stripped from documents""")
def l07(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    padded = F.concat(F.lit("\n\xa0"), F.col("text"), F.lit("\x1c\t"))
    return docs.select("doc_id", T.py_strip(padded).alias("stripped"))


_GOLD = ", ".join(f"""{duck_strip(f"coalesce({c},'')")} as {name}""" for c, name in frames.GOLD_RENAMES.items())


@query("l08_l09_l10_gold_columns", f"with {TAGGED_CTE} select {_GOLD}, count(*) as n from tagged group by all")
def l10(spark, sf):
    gold = (
        inputs.tagged(spark, sf)
        .select(*[T.gold_text(F.col(c)).alias(c) for c in frames.GOLD_RENAMES])
        .withColumnsRenamed(frames.GOLD_RENAMES)
    )
    return gold.groupBy(*frames.GOLD_RENAMES.values()).agg(F.count("*").alias("n"))



@query("l11_drop_empty", f"""with {HEADLINES_CTE}
select id, {duck_strip('headline')} as sentence from headlines where {duck_strip('headline')}<>''""")
def l11(spark, sf):
    return (
        inputs.headlines(spark, sf)
        .select("id", T.py_strip(F.col("headline")).alias("sentence"))
        .where("sentence <> ''")
    )


@query("l12_lines", f"""select doc_id, line from (select doc_id, {duck_strip('part')} as line from
 (select doc_id, unnest(regexp_split_to_array(text,'\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]')) as part from documents)) where line<>''""")
def l12(spark, sf):
    docs = inputs.table(spark, sf, "documents")
    return docs.select("doc_id", F.explode(T.lines(F.col("text"))).alias("line"))


@query("a01_dedup", f"""with {HEADLINES_CTE}
select min(cast(replace(id,'x','') as double)) as id, sentence, label from
 (select id, {duck_strip('headline')} as sentence, case when substr(id,1,1)='x' then 'B' else 'A' end as label from headlines)
group by sentence, label""")
def a01(spark, sf):
    df = inputs.headlines(spark, sf).select(
        T.to_number(F.replace("id", F.lit("x"), F.lit(""))).alias("id"),
        T.py_strip(F.col("headline")).alias("sentence"),
        F.when(F.col("id").startswith("x"), "B").otherwise("A").alias("label"),
    )
    return frames.dedup(df)


@query("a02_label_vocabulary", f"""with {CLEAN_CTE} select distinct label from t where label<>'' order by label""")
def a02(spark, sf):
    return frames.event_type_labels(inputs.tagged(spark, sf))


@query("a03_top_labels", f"""with {CLEAN_CTE}
select label, count(*) as n from (select sentence, label from joined group by sentence, label) group by label
order by n desc, label limit 10""")
def a03(spark, sf):
    return frames.top_labels(l14(spark, sf))


@query("a07_class_counts", f"""with {CLEAN_CTE}
select label, count(*) as n from (select sentence, label from joined group by sentence, label) group by label""")
def a07(spark, sf):
    return frames.label_counts(l14(spark, sf))
