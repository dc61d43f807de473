"""Queries over model answers, prompts and batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.catalog import inputs
from tidings.catalog.evaluate import matched_cte, report_sql, rounded
from tidings.catalog.inputs import PHRASES_CTE, duck_strip
from tidings.catalog.registry import query
from tidings.functions import answers as A, text as T
from tidings.functions.lexicon import FIELDS
from tidings.operators import answers as ops, evaluate as E
from tidings.operators.sampling import with_row_index
from tidings.plans.evaluation import answer_report

LABELS = ("BRAK_ZDARZENIA", "CLICK", "purchase", "view")
_LABELS_SQL = "(" + ", ".join(f"'{x}'" for x in LABELS) + ")"

_RAW = """case event_id%6
  when 0 then '{"label":"'||event_type||'","confidence":0.4,"who":"a","when":null,"what":true}'
  when 1 then 'Sure: {"label":"'||upper(event_type)||'","confidence":1.7,"who":" NULL ","trigger":12.5} done'
  when 2 then 'no json' when 3 then '{"label":"zzz","confidence":"-2","where":"  "}'
  when 4 then '{"confidence":"abc","where":"'||cast(user_id as string)||'"}'
  else '{"label":" '||event_type||' "}' end"""
ANSWERS_CTE = rf"""answers as (select event_id as idx, {_RAW} as raw from events),
 parsed as (select idx, raw, case when json_valid(raw) then raw when json_valid(regexp_extract(raw,'\{{.*\}}',0,'s')) then regexp_extract(raw,'\{{.*\}}',0,'s') end::json as j from answers)"""


def answers(spark, sf):
    return inputs.table(spark, sf, "events").selectExpr("event_id as idx", f"{_RAW} as raw")


def _shown(doc: str, name: str) -> str:
    """A JSON field as text, booleans with a capital."""
    return (
        f"case when json_type({doc},'$.{name}')='BOOLEAN' then upper(substr({doc}->>'$.{name}',1,1))||substr({doc}->>'$.{name}',2) "
        f"else {doc}->>'$.{name}' end"
    )


def _num(doc: str, name: str) -> str:
    return (
        f"case when regexp_full_match(trim({doc}->>'$.{name}'),'[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') "
        f"then cast({doc}->>'$.{name}' as double) end"
    )


@query("x01_extract_json_object", f"""with {ANSWERS_CTE}
select idx, j is not null as parsed, j->>'$.label' as label, j->>'$.where' as place from parsed""")
def x01(spark, sf):
    parsed = answers(spark, sf).withColumn("j", A.json_object(F.col("raw")))
    return parsed.select(
        "idx",
        F.col("j").isNotNull().alias("parsed"),
        A.text_of(A.field(F.col("j"), "label")).alias("label"),
        A.text_of(A.field(F.col("j"), "where")).alias("place"),
    )


_NULLISH = "case event_id%7 when 0 then null when 1 then '' when 2 then 'null' when 3 then ' NULL ' when 4 then 'None' when 5 then '  ' else '  '||event_type||' ' end"


@query("x03_x04_null_words", f"""with v as (select event_id, {_NULLISH} as v from events)
select event_id, case when lower({duck_strip('v')}) not in ('','null','none') then {duck_strip('v')} end as none_if_empty,
 case when v not in ('','null') then v end as null_ish from v""")
def x03(spark, sf):
    v = inputs.table(spark, sf, "events").selectExpr("event_id", f"{_NULLISH} as v")
    return v.select(
        "event_id",
        T.none_if_empty(F.col("v")).alias("none_if_empty"),
        T.null_ish(F.col("v")).alias("null_ish"),
    )


_CONF = "case event_id%5 when 0 then '0.'||cast(event_id%10 as string) when 1 then '-1' when 2 then 'abc' when 3 then null else '1e'||cast(event_id%3 as string) end"


@query("x05_clamp", f"""with v as (select event_id, {_CONF} as v from events)
select event_id, greatest(0.0, least(1.0, coalesce(try_cast(v as double), 0.0)))::double as c from v""")
def x05(spark, sf):
    v = inputs.table(spark, sf, "events").selectExpr("event_id", f"{_CONF} as v")
    return v.select("event_id", T.clamp01(F.col("v")).alias("c"))


@query("x06_valid_label", f"""select event_id, case when event_type in {_LABELS_SQL} then event_type
 when upper(event_type) in {_LABELS_SQL} then upper(event_type) else 'BRAK_ZDARZENIA' end as label from events""")
def x06(spark, sf):
    known = ops.label_list(LABELS)
    label = A.valid_label(F.col("event_type"), known, A.fallback_label(known, "BRAK_ZDARZENIA"))
    return inputs.table(spark, sf, "events").select("event_id", label.alias("label"))


CLASS_CTE = f"""{ANSWERS_CTE}, lab as (select idx, {duck_strip("coalesce(j->>'$.label','')")} as l, {_num('j', 'confidence')} as c from parsed),
 classed as (select idx, case when l in {_LABELS_SQL} then l when upper(l) in {_LABELS_SQL} then upper(l) else 'BRAK_ZDARZENIA' end as label,
  greatest(0.0, least(1.0, coalesce(c,0)))::double as confidence from lab)"""


@query("x09_class_answers", f"with {CLASS_CTE} select * from classed")
def x09(spark, sf):
    return ops.parse_class_answers(answers(spark, sf), LABELS)


def _nie(f: str) -> str:
    v = duck_strip(_shown("j", f))
    return f"""case when lower({v}) not in ('','null','none') then {v} end as "{f}" """


@query("x10_relation_answers", f"with {ANSWERS_CTE} select idx, {', '.join(_nie(f) for f in FIELDS)} from parsed")
def x10(spark, sf):
    return ops.parse_relation_answers(answers(spark, sf))


# --- batches ---------------------------------------------------------------

_ELEMENT = """case event_id%8
 when 0 then '{"idx":'||cast(event_id as string)||',"label":" '||event_type||' ","confidence":0.4,"who":"a","what":"null","where":"","when":null}'
 when 1 then '{"idx":"'||cast(event_id as string)||'","label":null,"confidence":"0.25","trigger":" x "}'
 when 2 then '{"idx":'||cast(event_id as string)||'.9,"label":"'||event_type||'","confidence":"abc"}'
 when 3 then '{"label":"'||event_type||'"}'
 when 4 then '{"idx":"abc","label":"'||event_type||'"}'
 when 5 then '{"idx":'||cast(event_id-5 as string)||',"label":"again","confidence":1.7,"who":"NULL"}'
 when 6 then '17'
 else '{"idx":'||cast(event_id as string)||',"label":"'||event_type||'","confidence":null,"who":12.5,"what":true}' end"""
_WRAP = """case batch%6 when 0 then '['||list||']' when 1 then '{"results":['||list||']}' when 2 then 'Sure: ['||list||'] ok'
 when 3 then '{"items":['||list||']}' when 4 then 'no answer' else '{"idx":'||cast(batch*16 as string)||',"label":"single"}' end"""
BATCH_CTE = rf"""elements as (select cast(floor(event_id/16) as bigint) as batch, string_agg({_ELEMENT}, ',' order by event_id) as list from events group by 1),
 raws as (select batch, {_WRAP} as raw from elements),
 bj as (select batch, case when json_valid(raw) then raw when regexp_extract(raw,'\[.*\]',0,'s')<>'' then regexp_extract(raw,'\[.*\]',0,'s') end::json as j from raws),
 lists as (select batch, case when json_type(j)='ARRAY' then j when json_type(j,'$.results')='ARRAY' then j->'$.results'
   when json_type(j,'$.items')='ARRAY' then j->'$.items' else to_json([j]) end as l from bj where j is not null),
 els as (select batch, unnest(cast(l as json[])) as e, generate_subscripts(cast(l as json[]),1)-1 as pos from lists),
 objs as (select batch, cast(row_number() over (partition by batch order by pos)-1 as bigint) as pos, e from els where json_type(e)='OBJECT'),
 read as (select batch, pos, case when json_type(e,'$.idx')='VARCHAR' then case when regexp_full_match(e->>'$.idx','[+-]?[0-9]+') then cast(e->>'$.idx' as bigint) end
   else cast(trunc(cast(e->>'$.idx' as double)) as bigint) end as idx, {duck_strip("coalesce(e->>'$.label','')")} as label,
   coalesce({_num('e', 'confidence')},0.0) as confidence, {', '.join(f"case when {_shown('e', f)} not in ('','null') then {_shown('e', f)} end as " + chr(34) + f + chr(34) for f in FIELDS)} from objs)"""


def batch_raws(spark, sf):
    lists = (
        inputs.table(spark, sf, "events")
        .selectExpr("cast(floor(event_id/16) as bigint) as batch", "event_id", f"{_ELEMENT} as e")
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "e"))).alias("es"))
        .selectExpr("batch", "array_join(transform(es, x -> x.e), ',') as list")
    )
    return lists.selectExpr("batch", f"{_WRAP} as raw")


@query("x02_x08_x11_batch_answers", f"with {BATCH_CTE} select * from read where idx is not null")
def x11(spark, sf):
    return ops.parse_batch_answers(batch_raws(spark, sf))


@query("x07_rejoin_answers", f"""with {BATCH_CTE}, last as (select * from read where idx is not null
  qualify row_number() over (partition by idx order by batch desc, pos desc)=1)
select event_id, event_type, label, confidence, last.idx is not null as answered from events left join last on event_id=last.idx""")
def x07(spark, sf):
    answers = ops.last_answers(ops.parse_batch_answers(batch_raws(spark, sf)), ["batch", "pos"])
    rows = inputs.table(spark, sf, "events").select(F.col("event_id").alias("idx"), "event_type")
    hit, missed = ops.rejoin_answers(rows, answers)
    nothing = {"label": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")}
    both = hit.select("idx", "event_type", "label", "confidence", F.lit(True).alias("answered")).unionByName(
        missed.withColumns({**nothing, "answered": F.lit(False)})
    )
    return both.withColumnRenamed("idx", "event_id")


@query("x12_prompts", f"""select doc_id, md5('Dozwolone etykiety: [{", ".join(LABELS)}].'||chr(10)||'Sklasyfikuj zdanie do jednej etykiety. Jeśli nie pasuje do żadnej, wybierz BRAK_ZDARZENIA (jeśli dostępne).'
 ||chr(10)||'Zwróć JSON w formacie: {{"label": "ETK", "confidence": 0.0}}.'||chr(10)||chr(10)||'Zdanie: '||text) as class_prompt,
 md5('Zwróć JSON w formacie: {{"who": string|null, "what": string|null, "trigger": string|null, "where": string|null, "when": string|null}}.'
 ||chr(10)||chr(10)||'Zdanie: '||text) as relation_prompt from documents""")
def x12(spark, sf):
    text, known = F.col("text"), ops.label_list(LABELS)
    return inputs.table(spark, sf, "documents").select(
        "doc_id",
        F.md5(ops.prompt(ops.CLASS_PROMPT, text, known)).alias("class_prompt"),
        F.md5(ops.prompt(ops.RELATION_PROMPT, text)).alias("relation_prompt"),
    )


@query("x13_micro_batches", """with n as (select row_number() over (order by doc_id, text)-1 as idx, text as sentence from documents)
select cast(floor(idx/8) as bigint) as batch, '['||string_agg('{"idx": '||idx||', "sentence": '||to_json(sentence)||'}', ', ' order by idx)||']' as items from n group by 1""")
def x13(spark, sf):
    docs = inputs.table(spark, sf, "documents").selectExpr("doc_id as id", "text as sentence")
    return ops.micro_batches(with_row_index(docs, ["id", "sentence"]), 8)


_BATCH_HEAD, _BATCH_TAIL = ops.BATCH_PROMPT.replace("{labels}", ", ".join(LABELS)).replace("'", "''").split("{text}")
_SYSTEMS = {"batch": ops.BATCH_SYSTEM, "class": ops.CLASS_SYSTEM, "relation": ops.RELATION_SYSTEM}


@query("x12_batch_prompts", f"""with n as (select row_number() over (order by doc_id, text)-1 as idx, text as sentence from documents),
 b as (select cast(floor(idx/8) as bigint) as batch, '['||string_agg('{{"idx": '||idx||', "sentence": '||to_json(sentence)||'}}', ', ' order by idx)||']' as items from n group by 1)
select batch, md5('{_BATCH_HEAD}'||items||'{_BATCH_TAIL}') as prompt, {', '.join(f"md5('{t.replace(chr(39), chr(39) * 2)}') as {k}_system" for k, t in _SYSTEMS.items())} from b""")
def x12_batch(spark, sf):
    docs = inputs.table(spark, sf, "documents").selectExpr("doc_id as id", "text as sentence")
    batches = ops.micro_batches(with_row_index(docs, ["id", "sentence"]), 8)
    prompt = F.md5(ops.prompt(ops.BATCH_PROMPT, F.col("items"), ops.label_list(LABELS))).alias("prompt")
    return batches.select("batch", prompt, *[F.md5(F.lit(t)).alias(f"{k}_system") for k, t in _SYSTEMS.items()])


@query("e18_answer_report", f"""with {PHRASES_CTE}, {matched_cte(True)}, rep as ({report_sql('matched', True, ())}),
 c as (select label as t, case when id%5=0 then 'WYPADEK' when id%7=0 then 'PROTEST' else label end as p from phrases),
 conf as (select t, p, count(*) as n from c group by t, p), names as (select t as l from conf union select p from conf),
 f as (select l, 2*coalesce((select sum(n) from conf where t=l and p=l),0)/(coalesce((select sum(n) from conf where t=l),0)+coalesce((select sum(n) from conf where p=l),0)) as f1,
   coalesce((select sum(n) from conf where t=l),0) as support from names)
select field, n, accuracy, all_fields, tp, fp, fn, precision, recall, f1, (select round(sum(case when t=p then n else 0 end)/sum(n),6) from conf) as label_accuracy,
 (select round(avg(f1),6) from f) as label_f1_macro, (select round(sum(f1*support)/sum(support),6) from f) as label_f1_weighted from rep""")
def e18(spark, sf):
    df = inputs.phrases(spark, sf).withColumnsRenamed({"label": "gold_label"})
    df = df.withColumn(
        "pred_label",
        F.expr("case when id%5=0 then 'WYPADEK' when id%7=0 then 'PROTEST' else gold_label end"),
    )
    report = answer_report(df, strict_when=True)
    rows = E.report_rows(report.select("n", "coverage", "gold_presence", "sentence_accuracy", "metrics"))
    labels = report.select(
        "n",
        F.round("event_type.accuracy", 6).alias("label_accuracy"),
        F.round("event_type.f1_macro", 6).alias("label_f1_macro"),
        F.round("event_type.f1_weighted", 6).alias("label_f1_weighted"),
    )
    return rounded(rows.drop("coverage", "gold_presence")).join(labels, "n")
