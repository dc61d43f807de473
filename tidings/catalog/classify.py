"""Queries over splitting, oversampling, prediction, rules, reports and records."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.catalog import features as features_catalog, inputs
from tidings.catalog.features import TFIDF_CTE, VOCAB_CTE
from tidings.catalog.registry import query
from tidings.catalog.relations import RELATIONS_CTE
from tidings.operators import classify, features, metrics, records, sampling
from tidings.operators.relations import with_relations
from tidings.plans import training
from tidings.session import fresh_path, written
from tidings.sources.model_store import load_model, save_model

SEED = 42
# Keyword rules with words that the driver texts contain.
RULES = (
    ("PRZESTEPSTWO", ("thand", "ation")),
    ("WYPADEK", ("queau", "ung")),
    ("KATASTROFA", ("ción", "re")),
    ("PROTEST", ("the", "der")),
)

HASH = "('0x'||substr(md5(concat_ws('|','42',{})),1,15))::bigint"

# Documents as training rows; the label is the source crossed with the language.
ROWS_CTE = "rows as (select doc_id, case when lang='en' then source else lang end as label, text as sentence from documents)"
SPLIT_CTE = f"""{ROWS_CTE},
 hashed as (select *, {HASH.format("label, cast(doc_id as varchar)")} as h from rows),
 shape as (select count(*) as n, cast(ceil(0.2*count(*)) as bigint) as n_test from rows),
 share as (select label, count(*) as c, (count(*)*any_value(n_test)) // any_value(n) as whole, (count(*)*any_value(n_test)) % any_value(n) as rest,
   any_value(n_test) as n_test from rows, shape group by label),
 quota as (select label, whole + case when row_number() over (order by rest desc, label) <= n_test-(select sum(whole) from share) then 1 else 0 end as q from share),
 split as (select doc_id, label, sentence, row_number() over (partition by label order by h, doc_id)-1 < q as is_test from hashed join quota using (label)),
 train as (select * from split where not is_test)"""


def rows(spark, sf):
    return inputs.table(spark, sf, "documents").selectExpr(
        "doc_id", "case when lang='en' then source else lang end as label", "text as sentence"
    )


def _split(spark, sf):
    return sampling.stratified_split(rows(spark, sf), seed=SEED, key=("label", "doc_id"))


@query("t01_stratified_split", f"with {SPLIT_CTE} select doc_id, label, is_test from split")
def t01(spark, sf):
    return _split(spark, sf).select("doc_id", "label", "is_test")


@query("t02_oversample", f"""with {SPLIT_CTE},
 sizes as (select label, count(*) as c, max(count(*)) over () - count(*) as lack from train group by label),
 draws as (select label, c, unnest(range(cast(lack as bigint))) as k from sizes),
 picks as (select label, {HASH.format("label, cast(k as varchar)")} % c as pick, count(*) as drawn from draws group by 1, 2),
 placed as (select doc_id, label, row_number() over (partition by label order by {HASH.format("label, cast(doc_id as varchar)")}, doc_id)-1 as pick from train)
select doc_id, label, 1+coalesce(drawn,0) as copies from placed left join picks using (label, pick)""")
def t02(spark, sf):
    train = _split(spark, sf).where("NOT is_test").select("doc_id", "label")
    return sampling.oversample(train, seed=SEED, key=("label", "doc_id"))


@query("a07_oversampled_counts", f"""with {SPLIT_CTE}, sizes as (select label, count(*) as n_before from train group by label)
select label, n_before, max(n_before) over () as n_after from sizes""")
def a07(spark, sf):
    grown = t02(spark, sf)
    before = grown.groupBy("label").agg(F.count("*").alias("n_before"))
    after = sampling.expand_copies(grown).groupBy("label").agg(F.count("*").alias("n_after"))
    return before.join(after, "label")


@query("a05_sample", f"""with s as (select event_id, event_type, {HASH.format("cast(event_id as varchar)")} as h from events)
select event_id, event_type from s order by h, event_id limit 500""")
def a05(spark, sf):
    events = inputs.table(spark, sf, "events").select("event_id", "event_type")
    return sampling.sample_n(events, 500, ["event_id"], SEED)


@query("a04_head", "select event_id, event_type, value from events order by event_id limit 100")
def a04(spark, sf):
    events = inputs.table(spark, sf, "events").select("event_id", "event_type", "value")
    return sampling.head_n(events, 100, ["event_id"])


@query("a04_row_index", """select user_id, event_type, row_number() over (order by user_id, event_type)-1 as idx from events""")
def a04_index(spark, sf):
    events = inputs.table(spark, sf, "events").select("user_id", "event_type")
    return sampling.with_row_index(events, ["user_id", "event_type"])


# --- predictions and rules -------------------------------------------------

SCORED_CTE = """scored as (select doc_id, text as sentence, case when doc_id%2=0 then 'WYPADEK' else 'POLITYKA' end as label,
 ((doc_id*37)%100)/cast(100 as double) as confidence from documents)"""


def scored(spark, sf):
    return inputs.table(spark, sf, "documents").selectExpr(
        "doc_id",
        "text as sentence",
        "case when doc_id%2=0 then 'WYPADEK' else 'POLITYKA' end as label",
        "((doc_id*37)%100)/cast(100 as double) as confidence",
    )


def _rule_sql(text: str, label: str, confidence: str) -> str:
    arms = " ".join(
        "when {} then '{}'".format(
            f"{label}<>'{name}' and (" + " or ".join(f"contains(lower({text}),'{k}')" for k in words) + ")", name
        )
        for name, words in RULES
    )
    return f"case when {confidence}<0.55 then case {arms} end end"


@query("t11_keyword_override", f"""with {SCORED_CTE}, judged as (select *, {_rule_sql('sentence','label','confidence')} as found from scored)
select doc_id, coalesce(found, label) as label, case when found is null then confidence else 0.9 end as confidence from judged""")
def t11(spark, sf):
    judged = classify.apply_keyword_rules(scored(spark, sf), RULES)
    return judged.select("doc_id", "label", "confidence")


_SCORES = "(doc_id%7-3)*0.5, (doc_id%5-2)*0.4, (doc_id%3-1)*0.3"


@query("t10_pseudo_probability", f"""with s as (select doc_id, unnest([1,2,3]) as k, unnest([{_SCORES}])::double as x from documents),
 e as (select doc_id, k, exp(x-max(x) over (partition by doc_id)) as e from s),
 p as (select doc_id, k, e/sum(e) over (partition by doc_id) as p from e),
 b as (select doc_id, k, round(p,6) as p from p qualify row_number() over (partition by doc_id order by round(p,9) desc, k)=1)
select doc_id, ['A','B','C'][k] as label, p as confidence from b
union all select doc_id, case when x>0 then 'B' else 'A' end, round(greatest(1/(1+exp(2*x)), 1/(1+exp(-2*x))),6)
 from (select doc_id, (doc_id%7-3)*0.5::double as x from documents)""")
def t10(spark, sf):
    docs = inputs.table(spark, sf, "documents").selectExpr(
        "doc_id",
        f"transform(array({_SCORES}), x -> cast(x as double)) as scores",
        "array(cast((doc_id%7-3)*0.5 as double)) as margin",
    )

    def judged(column, labels):
        best = classify.best_label(classify.pseudo_probabilities(F.col(column)), labels)
        return docs.select("doc_id", best.alias("best")).select(
            "doc_id", F.col("best.label").alias("label"), F.round("best.confidence", 6).alias("confidence")
        )

    return judged("scores", ["A", "B", "C"]).union(judged("margin", ["A", "B"]))


@query("t12_label_encoding", f"""with {ROWS_CTE}
select doc_id, label, cast(dense_rank() over (order by label)-1 as double) as code, label as decoded from rows""")
def t12(spark, sf):
    df = rows(spark, sf).select("doc_id", "label")
    indexer = classify.label_indexer(df, index="code")
    coded = indexer.transform(df)
    return classify.label_decoder(indexer, "code", "decoded").transform(coded)


def _labelled(spark, sf):
    return inputs.table(spark, sf, "documents").selectExpr("doc_id", "lang as label", "text as sentence")


@query("t08_t09_t13_train_predict")
def t13(spark, sf):
    """Fit on the documents, then classify all of them; solver results have no SQL."""
    df = _labelled(spark, sf)
    model, _report = training.train_event_type(df, seed=SEED)
    return training.predict(model, df.drop("label"), key="doc_id", rules=RULES).select("doc_id", "label", "confidence")


@query("t13_training_report")
def t13_report(spark, sf):
    """The report on the test side."""
    _model, report = training.train_event_type(_labelled(spark, sf), seed=SEED, oversample=False)
    return report.select("kind", "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("t08_fit", f"""with {VOCAB_CTE} select block, term, 0.0::double as gradient from vocab
union all select 'intercepts', '', 0.0::double""")
def t08(spark, sf):
    """The penalised loss's gradient at every coefficient of a fit on all documents, worked out without the solver: zero at the optimum."""
    df = written(sampling.with_row_index(_labelled(spark, sf), ["doc_id"], "place"), "numbered-rows")
    parts = features.text_parts(df, "sentence", features.PART_BYTES)
    terms = features.stored_terms(df, key="place", text="sentence", stop_words=features_catalog.STOP_WORDS, parts=parts)
    known = features.store_vocabulary(features.fit_vocabulary(terms, df.count(), parts=parts), parts)
    size = features.table_bytes(known)
    indexer = classify.label_indexer(df)
    targets = classify.balanced_weight(indexer.transform(df.select("place", "label")), copies=None)
    rows = written(targets.select("place", "label_index", "weight"), "fit-targets")
    weights = features.tfidf(terms, known, key="place", vocabulary_bytes=size, parts=parts)
    numbers = (df.agg(F.max("place")).first()[0] or 0) + 1
    fitted, intercepts = classify.fit_classifier(weights, rows, len(indexer.labels), key="place", numbers=numbers)
    fitted = written(known.join(fitted, ["block", "term"]), "model")

    n = len(intercepts)
    weights = features.tfidf(terms, fitted, key="place", vocabulary_bytes=features.table_bytes(fitted), parts=parts, keep=["part"])
    alone = F.array(*[F.lit(x) for x in intercepts])
    scored = rows.join(classify.linear_scores(weights, intercepts, "place"), "place", "left")
    p = classify.pseudo_probabilities(F.coalesce("scores", alone))
    rest = F.transform(p, lambda x, k: F.col("weight") * (x - F.when(F.col("label_index") == k, 1.0).otherwise(0.0)))
    rests = written(scored.select("place", rest.alias("rest")), "rests")
    pulled = [F.sum(F.col("x") * F.get("rest", F.lit(k))).alias(f"g{k}") for k in range(n)]
    entries = weights.withColumnRenamed("weight", "x").join(features.dealt_rows(rests, "place", parts), ["part", "place"])
    slopes = entries.groupBy("block", "term").agg(*pulled).join(fitted.select("block", "term", "coefficients"), ["block", "term"])
    steepest = lambda parts: F.round(F.greatest(*[F.abs(x) for x in parts]), 3)
    whole = slopes.select("block", "term", steepest([F.col(f"g{k}") + F.get("coefficients", F.lit(k)) for k in range(n)]).alias("gradient"))
    free = rests.agg(steepest([F.sum(F.get("rest", F.lit(k))) for k in range(n)]).alias("gradient"))
    return whole.union(free.select(F.lit("intercepts"), F.lit(""), "gradient"))


# A model made by arithmetic: every coefficient is a rule of the term's length and block.
_COEFFICIENTS = "((length(term)*{0}+case when block='word' then 3 else 1 end)%7-3)/10.0"
_SUMS = ", ".join(f"sum(weight*({_COEFFICIENTS.format(k)})) as s{k}" for k in (2, 3, 5))
_LABELS3 = ("A", "B", "C")
_INTERCEPTS = (0.05, 0.0, -0.05)


_PREDICTED = f"""with {TFIDF_CTE}, sums as (select doc_id, {_SUMS} from weights group by doc_id),
 z as (select doc_id, coalesce(s2,0)+0.05 as a, coalesce(s3,0) as b, coalesce(s5,0)-0.05 as c from documents left join sums using (doc_id)),
 p as (select *, greatest(a,b,c) as top, exp(a-greatest(a,b,c))+exp(b-greatest(a,b,c))+exp(c-greatest(a,b,c)) as total from z)
select doc_id, case when a=top then 'A' when b=top then 'B' else 'C' end as label, round(1/total, 5) as confidence from p"""


def _arithmetic_model(spark, sf):
    terms = features_catalog.vocabulary(spark, sf).withColumn(
        "coefficients", F.array(*[F.expr(f"cast({_COEFFICIENTS.format(k)} as double)") for k in (2, 3, 5)])
    )
    return training.EventTypeModel(terms, features.table_bytes(terms), _LABELS3, _INTERCEPTS, features_catalog.STOP_WORDS)


def _predicted(model, spark, sf):
    docs = inputs.table(spark, sf, "documents").selectExpr("doc_id", "text as sentence")
    found = training.predict(model, docs, key="doc_id", rules=())
    return found.select("doc_id", "label", F.round("confidence", 5).alias("confidence"))


@query("t09_predict", _PREDICTED)
def t09(spark, sf):
    return _predicted(_arithmetic_model(spark, sf), spark, sf)


@query("s04_saved_model", _PREDICTED)
def s04(spark, sf):
    """The same model, saved and loaded again."""
    path = fresh_path(spark, "saved-model")
    save_model(_arithmetic_model(spark, sf), path)
    return _predicted(load_model(spark, path), spark, sf)


@query("p05_two_decimals", "select event_id, printf('%.2f', ((event_id*37)%4000)/1000.0::double) as shown from events")
def p05_decimals(spark, sf):
    events = inputs.table(spark, sf, "events").selectExpr("event_id", "cast((event_id*37)%4000 as double)/1000 as c")
    return events.select("event_id", records.two_decimals(F.col("c")).alias("shown"))


# --- reports ---------------------------------------------------------------

_PAIRS = "case when doc_id%4=0 then 'WYPADEK' when doc_id%4=1 then 'POLITYKA' when doc_id%9=0 then 'X' else 'PROTEST' end"
METRICS_CTE = f"""pairs as (select case when doc_id%2=0 then 'WYPADEK' else 'POLITYKA' end as t, {_PAIRS} as p from documents),
 conf as (select t, p, count(*) as n from pairs group by t, p),
 names as (select t as label from conf union select p from conf),
 lab as (select label, coalesce((select sum(n) from conf where t=label and p=label),0)::double as tp,
   coalesce((select sum(n) from conf where p=label),0)::double as predicted, coalesce((select sum(n) from conf where t=label),0)::bigint as support from names),
 m as (select label, tp, support, case when predicted>0 then tp/predicted else 0 end as pr, case when support>0 then tp/support else 0 end as re,
   case when predicted+support>0 then 2*tp/(predicted+support) else 0 end as f from lab)"""


def _pairs(spark, sf):
    return inputs.table(spark, sf, "documents").selectExpr(
        "case when doc_id%2=0 then 'WYPADEK' else 'POLITYKA' end as label", f"{_PAIRS} as pred"
    )


@query("c01_classification_report", f"""with {METRICS_CTE}
select 'label' as kind, label, round(pr,6) as precision, round(re,6) as recall, round(f,6) as f1, support from m
union all select 'accuracy', null, null, null, round(sum(tp)/sum(support),6), sum(support)::bigint from m
union all select 'macro avg', null, round(avg(pr),6), round(avg(re),6), round(avg(f),6), sum(support)::bigint from m
union all select 'weighted avg', null, round(sum(pr*support)/sum(support),6), round(sum(re*support)/sum(support),6), round(sum(f*support)/sum(support),6), sum(support)::bigint from m""")
def c01(spark, sf):
    report = metrics.classification_report(_pairs(spark, sf))
    return report.select(
        "kind", "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query("c02_headline_scores", f"""with {METRICS_CTE}
select sum(support)::bigint as n, round(sum(tp)/sum(support),6) as accuracy, round(avg(f),6) as f1_macro, round(sum(f*support)/sum(support),6) as f1_weighted from m""")
def c02(spark, sf):
    scores = metrics.headline_scores(_pairs(spark, sf))
    return scores.select("n", *[F.round(c, 6).alias(c) for c in scores.columns[1:]])


# --- records ---------------------------------------------------------------

_SENT_LABEL = "case (doc_id+s)%3 when 0 then 'BRAK_ZDARZENIA' when 1 then 'WYPADEK' else 'POLITYKA' end"
_SENT_CONF = "((doc_id*37+s)%100)/cast(100 as double)"
EVENTS_CTE = f"""{RELATIONS_CTE},
 judged as (select doc_id, s, sentence, {_SENT_LABEL} as label, {_SENT_CONF} as confidence, {_rule_sql('sentence', _SENT_LABEL, _SENT_CONF)} as found from sentences),
 ev as (select doc_id, s, coalesce(found,label) as event_type, case when found is null then confidence else 0.9 end as confidence, sentence from judged),
 record as (select doc_id, s, event_type, case when event_type<>'BRAK_ZDARZENIA' then who end as who, case when event_type<>'BRAK_ZDARZENIA' then what end as what,
   case when event_type<>'BRAK_ZDARZENIA' then trigger end as trigger, "where", "when", confidence, sentence from ev join rel using (doc_id, s))"""


def event_records(spark, sf):
    """Every sentence of the documents as an event record."""
    text = inputs.sentences(spark, sf)
    annotated = with_relations(inputs.annotated(spark, sf, text, keep=("sentence",)))
    labelled = annotated.withColumns({"label": F.expr(_SENT_LABEL), "confidence": F.expr(_SENT_CONF)})
    judged = classify.apply_keyword_rules(labelled, RULES)
    return records.extract_event(judged.drop("tokens", "ents"))


@query("p01_extract_event", f"with recursive {EVENTS_CTE} select * from record")
def p01(spark, sf):
    return event_records(spark, sf)


@query("p05_record_text", f"""with recursive {EVENTS_CTE}
select doc_id, s, 'Typ zdarzenia: '||event_type||case when who<>'' then chr(10)||'KTO: '||who else '' end||case when what<>'' then chr(10)||'CO: '||what else '' end
 ||case when trigger<>'' then chr(10)||'Trigger: '||trigger else '' end||case when "where"<>'' then chr(10)||'GDZIE: '||"where" else '' end
 ||case when "when"<>'' then chr(10)||'KIEDY: '||"when" else '' end||chr(10)||'Pewność: '||printf('%.2f', confidence) as printed from record""")
def p05(spark, sf):
    return event_records(spark, sf).select("doc_id", "s", records.record_text().alias("printed"))
