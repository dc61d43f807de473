"""Queries over matching, counting, reporting and corrections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.catalog import inputs
from tidings.catalog.inputs import PHRASES_CTE, duck_strip
from tidings.catalog.registry import query
from tidings.functions.lexicon import FIELDS
from tidings.functions.text import is_empty
from tidings.operators import evaluate as E

TOP = 200


def empty(c: str) -> str:
    return f"(coalesce({duck_strip(c)},'')='')"


SURFACE = "list_distinct(regexp_extract_all(lower({}),'[\\p{{L}}\\p{{N}}_]+'))"


def _hit(pred: str, gold: str, words: str) -> str:
    words = words.format
    inter = f"len(list_intersect({words(pred)},{words(gold)}))"
    size = f"len({words(gold)})"
    return (
        f"(not {empty(pred)} and not {empty(gold)} and {size}>0 and "
        f"{inter}/{size} >= case when {size}>=3 then 0.8 else 0.5 end)"
    )


def _ok(f: str, lenient: bool) -> str:
    gold_rule = "true" if lenient else empty(f'"{f}"')
    return f"""case when {empty(f'"gold_{f}"')} then {gold_rule} when {empty(f'"{f}"')} then false else "hit_{f}" end"""


def matched_cte(strict: bool, source: str = "phrases", name: str = "matched", words: str = SURFACE) -> str:
    """Hits, then field correctness, for the rows of `source`."""
    hits = ", ".join(
        '{} as "hit_{}"'.format(_hit(f'"{f}"', f'"gold_{f}"', words), f) for f in FIELDS
    )
    oks = ", ".join(
        f'{_ok(f, f == "when" and not strict)} as "ok_{f}", {_ok(f, False)} as "strict_{f}", '
        f'{_ok(f, f == "when")} as "lenient_{f}"'
        for f in FIELDS
    )
    return f"{name} as (select *, {oks} from (select *, {hits} from {source}))"


def report_sql(
    source: str, strict: bool, coverage=("who", "what", "where", "when"), whole: str = "ok"
) -> str:
    """The report as one row per field, from counted outcomes."""
    parts = []
    allok = " and ".join(f'"{whole}_{f}"' for f in FIELDS)
    for f in FIELDS:
        pe, ge = empty(f'"{f}"'), empty(f'"gold_{f}"')
        fp_unasked = "false" if f == "when" and not strict else f"(not {pe} and {ge})"
        miss = f'(not {pe} and not {ge} and not "hit_{f}")'
        covered = f"round(avg(case when {pe} then 0 else 1 end),6)" if f in coverage else "cast(null as double)"
        parts.append(
            f"""select '{f}' as field, count(*) as n, {covered} as coverage,
 round(avg(case when {ge} then 0 else 1 end),6) as gold_presence, round(avg(case when "ok_{f}" then 1 else 0 end),6) as accuracy,
 round(avg(case when {allok} then 1 else 0 end),6) as all_fields,
 sum(case when "hit_{f}" then 1 else 0 end)::double as tp,
 sum(case when {miss} or {fp_unasked} then 1 else 0 end)::double as fp,
 sum(case when {miss} or ({pe} and not {ge}) then 1 else 0 end)::double as fn from {source}"""
        )
    union = "\nunion all ".join(parts)
    return f"""select field, n, coverage, gold_presence, accuracy, all_fields, tp, fp, fn,
 round(p,6) as precision, round(r,6) as recall, round(case when p+r>0 then 2*p*r/(p+r) end,6) as f1 from
 (select *, case when tp+fp>0 then tp/(tp+fp) end as p, case when tp+fn>0 then tp/(tp+fn) end as r from ({union}))"""


def rounded(rows):
    keep = {"field", "n", "tp", "fp", "fn", "model"}
    return rows.select(
        *[c if c in keep else F.round(c, 6).alias(c) for c in rows.columns]
    )


def _matched(spark, sf, strict=False):
    return E.with_matches(inputs.phrases(spark, sf), strict_when=strict)


@query("e01_is_empty", f"""with {PHRASES_CTE}
select id, {empty('"gold_what"')} as no_gold, {empty('"who"')} as no_pred from phrases""")
def e01(spark, sf):
    return inputs.phrases(spark, sf).select(
        "id", is_empty(F.col("gold_what")).alias("no_gold"), is_empty(F.col("who")).alias("no_pred")
    )


@query("e02_lemma_set", f"""with {inputs.TOKENS_CTE},
 kept as (select distinct doc_id, s, lower({duck_strip('lemma')}) as lemma from tokens
  where pos not in ('ADP','DET','CCONJ','SCONJ','PART','PUNCT','SPACE') and regexp_matches(lemma,'[\\p{{L}}\\p{{N}}_]'))
select doc_id, s, coalesce(string_agg(lemma, ' ' order by lemma),'') as lemmas, count(lemma) as n
from sentences left join kept using (doc_id, s) group by doc_id, s""")
def e02(spark, sf):
    sets = inputs.annotated(spark, sf).select(
        "doc_id", "s", F.sort_array(E.lemma_set(F.col("tokens"))).alias("found")
    )
    return sets.select(
        "doc_id", "s", F.array_join("found", " ").alias("lemmas"), F.size("found").alias("n")
    )


@query("e03_match_by_lemmas", f"""with {PHRASES_CTE}, {matched_cte(False)}
select id, {', '.join(f'"hit_{f}" as hit_{f}' for f in FIELDS)} from matched""")
def e03(spark, sf):
    return _matched(spark, sf).select("id", *[F.col(f"_hit_{f}").alias(f"hit_{f}") for f in FIELDS])


@query("e04_field_ok", f"""with {PHRASES_CTE}, {matched_cte(True)}
select id, {', '.join(f'"ok_{f}" as ok_{f}' for f in FIELDS)} from matched""")
def e04(spark, sf):
    return _matched(spark, sf, True).select(
        "id", *[F.col(f"_ok_{f}").alias(f"ok_{f}") for f in FIELDS]
    )


@query("e05_e13_evaluation_report", f"with {PHRASES_CTE}, {matched_cte(False)} {report_sql('matched', False)}")
def e13(spark, sf):
    return rounded(E.report_rows(E.evaluation_report(_matched(spark, sf))))


@query("e11_strict_report", f"with {PHRASES_CTE}, {matched_cte(True)} {report_sql('matched', True)}")
def e11(spark, sf):
    report = E.evaluation_report(_matched(spark, sf, True), strict_when=True)
    return rounded(E.report_rows(report))


_SCORE = "+".join(f'cast("ok_{f}" as integer)' for f in FIELDS)
_TOP_CTE = f"top as (select *, {_SCORE} as match_score from matched order by match_score desc, id limit {TOP})"


@query("a06_top_matches", f"""with {PHRASES_CTE}, {matched_cte(False)}, {_TOP_CTE}
select id, label, sentence, {', '.join(f'"{f}", "gold_{f}"' for f in FIELDS)}, match_score from top""")
def a06(spark, sf):
    return E.top_matches(_matched(spark, sf), TOP).select(
        "id", "label", "sentence", *[c for f in FIELDS for c in (f, f"gold_{f}")], "match_score"
    )


def corrected(f: str) -> str:
    gold = duck_strip(f"""coalesce("gold_{f}",'')""")
    pred = duck_strip(f"""coalesce("{f}",'')""")
    rule = f"""case when "ok_{f}" then {gold} when {pred}<>'' then {pred} else {gold} end"""
    return f"case when {gold}='' then '' else {rule} end" if f == "when" else rule


@query("e14_corrections", f"""with {PHRASES_CTE}, {matched_cte(True)}
select id, {', '.join(f'{corrected(f)} as new_{f}' for f in FIELDS)} from matched""")
def e14(spark, sf):
    return _matched(spark, sf, True).select(
        "id", *[E.correct_field(f).alias(f"new_{f}") for f in FIELDS]
    )


@query("e15_suggested_tags", f"""with {PHRASES_CTE}, {matched_cte(False)}, {_TOP_CTE}
select id, label as kategoria, {corrected('who')} as "KTO", {corrected('what')} as "CO", {corrected('trigger')} as "TRIGGER",
 {corrected('where')} as "GDZIE", {corrected('when')} as "KIEDY" from top""")
def e15(spark, sf):
    return E.suggested_tags(E.top_matches(_matched(spark, sf), TOP))


@query("e16_top_report", f"""with {PHRASES_CTE}, {matched_cte(False)}, {_TOP_CTE}
{report_sql('top', False, FIELDS, 'strict')}""")
def e16(spark, sf):
    return rounded(E.report_rows(E.top_report(E.top_matches(_matched(spark, sf), TOP))))


@query("e17_corrected_report", f"""with {PHRASES_CTE}, {matched_cte(False)}, {_TOP_CTE},
 swapped as (select id, {', '.join(f'"{f}", {corrected(f)} as "gold_{f}"' for f in FIELDS)} from top),
 {matched_cte(False, 'swapped', 'rematched')}
{report_sql('rematched', False, FIELDS, 'lenient')}""")
def e17(spark, sf):
    return rounded(E.report_rows(E.corrected_report(E.top_matches(_matched(spark, sf), TOP))))


@query("e12_proxy_counts", f"""with {inputs.TOKENS_CTE}, {PHRASES_CTE.split('),', 1)[1]},
 names as (select e.doc_id*100000+e.s as id, label, trim(string_agg(text||ws, '' order by t.i)) as name
   from ents e join tokens t on e.doc_id=t.doc_id and e.s=t.s and t.i>=e."start" and t.i<e."end" group by e.doc_id, e.s, e."start", label),
 kinds as (select unnest(['who','where','where','when']) as field, unnest(['persName','geogName','placeName','date']) as label),
 preds as (select id, unnest(['who','where','when']) as field, unnest(["who","where","when"]) as pred from phrases),
 seen as (select id, field, name from names join kinds using (label)),
 judged as (select p.id, p.field, coalesce(pred,'')<>'' as has_pred, count(name)>0 as has_ent,
   coalesce(bool_or(contains(lower(pred), lower(name))), false) as overlap
   from preds p left join seen e on p.id=e.id and p.field=e.field group by p.id, p.field, pred),
 counts as (select field, sum(case when has_pred and has_ent and overlap then 1 else 0 end)::double as tp,
   sum(case when has_pred and not has_ent then 1 else 0 end)::double as fp,
   sum(case when not has_pred and has_ent then 1 else 0 end)::double as fn from judged group by field
   union all select unnest(['what','trigger']), 0, 0, 0),
 pr as (select *, case when tp+fp>0 then tp/(tp+fp) end as p, case when tp+fn>0 then tp/(tp+fn) end as r from counts)
select field, tp, fp, fn, round(p,6) as precision, round(r,6) as recall, round(case when p+r>0 then 2*p*r/(p+r) end,6) as f1 from pr""")
def e12(spark, sf):
    from tidings.operators.relations import entity_texts

    ents = inputs.annotated(spark, sf).select(
        (F.col("doc_id") * 100000 + F.col("s")).alias("id"),
        entity_texts(F.col("tokens"), F.col("ents")).alias("ents"),
    )
    return rounded(E.proxy_counts(inputs.phrases(spark, sf).join(ents, "id")))
