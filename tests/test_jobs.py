"""Whole evaluation jobs on small frames."""

import pytest
from pyspark.sql import functions as F

from tidings.operators import evaluate as E
from tidings.plans.evaluation import evaluate_answers, evaluate_gold

FIELDS = ("who", "what", "trigger", "where", "when")


def load_annotator():
    """Words with their first four letters as lemma; the second one is the verb, capitals are names."""

    def parse(text):
        words = text.split()
        tokens = [
            dict(i=i, text=w, ws=" ", lemma=w.lower()[:4], pos="VERB" if i == 1 else "PROPN" if w[0].isupper() else "NOUN",
                 dep="ROOT" if i == 1 else "nsubj" if i == 0 else "obj", head=1 if len(words) > 1 else 0, ent_type="", verb_form="Fin")
            for i, w in enumerate(words)
        ]
        return tokens, [dict(start=0, end=1, label="persName")] if words and words[0][0].isupper() else []

    return parse


def gold(spark, rows):
    return spark.createDataFrame(
        [(float(k), s, "WYPADEK", *g) for k, (s, g) in enumerate(rows)],
        "id double, sentence string, label string, " + ", ".join(f"gold_{f} string" for f in FIELDS),
    )


ROWS = [
    ("Kierowcy uderzyli drzewo", ("Kierowca", "drzewa", "uderzyć", "", "")),
    ("Anna kupiła dom", ("Piotr", "dom", "", "", "jutro")),
    ("pies biegnie", ("", "", "biegnie", "las", "")),
    ("pies biegnie", ("", "", "biegnie", "las", "")),
]


def test_from_gold_to_report(spark):
    found = evaluate_gold(gold(spark, ROWS), load_annotator=load_annotator, top_n=3)
    rows = {r.field: r for r in E.report_rows(found.report).collect()}
    assert all(r.n == 4 for r in rows.values())
    # Lemmas match across endings: Kierowcy and Kierowca, drzewo and drzewa, but not Anna and Piotr.
    assert (rows["who"].tp, rows["who"].fp, rows["who"].fn) == (1, 3, 1)
    # Without an object the subject is the what.
    assert (rows["what"].tp, rows["what"].fp) == (2, 2)
    assert rows["when"].accuracy == 0.75 and rows["where"].fn == 2
    detail = found.predictions.collect()
    assert len(detail) == 4 and all(r._strict_when is False for r in detail)
    assert not [c for c in found.predictions.columns if c.startswith(("_hit", "_lemmas", "tokens"))]
    assert found.top.count() == 3 and found.corrected_report.first().n == 3
    # Against corrected gold every prediction is right by its own lemmas.
    corrected = {r.field: r for r in E.report_rows(found.corrected_report).collect()}
    assert corrected["who"].fp == 0 and corrected["what"].fp == 0
    # The report is the one that the rows give.
    again = E.evaluation_report(E.with_matches(found.predictions.select("id", *FIELDS, *[f"gold_{f}" for f in FIELDS])))
    assert again.first().n == 4


def test_one_scan_for_rows_and_report(spark, tmp_path):
    frame = gold(spark, ROWS).withColumn("seen", F.lit(1))
    calls = spark.sparkContext.accumulator(0)

    def loader():
        parse = load_annotator()

        def counted(text):
            calls.add(1)
            return parse(text)

        return counted

    evaluate_gold(frame, load_annotator=loader, dictionary=lambda p: p.select("phrase", F.split(F.lower("phrase"), " ").alias("lemmas")))
    assert calls.value == len(ROWS)


def test_limit_sample_and_proxy(spark):
    frame = gold(spark, ROWS)
    assert evaluate_gold(frame, load_annotator=load_annotator, limit=2).report.first().n == 2
    ids = [
        sorted(r.id for r in evaluate_gold(f, load_annotator=load_annotator, limit=3, sample=True, seed=5).predictions.collect())
        for f in (frame, frame.repartition(3))
    ]
    assert len(ids[0]) == 3 and ids[0] == ids[1]
    proxy = evaluate_gold(frame, load_annotator=load_annotator, proxy=True)
    rows = {r.field: r for r in E.report_rows(proxy.report).collect()}
    assert (rows["who"].tp, rows["who"].fp, rows["who"].fn) == (2, 2, 0)
    assert rows["who"].accuracy == 0 and rows["who"].gold_presence == 0 and rows["who"].all_fields == 0
    assert rows["what"].tp == rows["what"].fp == 0
    assert all(r[f"_ok_{f}"] is None for r in proxy.predictions.collect() for f in FIELDS)
    with pytest.raises(ValueError):
        evaluate_gold(frame)
    empty = evaluate_gold(frame.limit(0), load_annotator=load_annotator).report.first()
    assert empty.n == 0 and empty.metrics.who.precision is None


def test_phrases_come_back_to_their_rows(spark):
    rows = [(1, "a b", "a", None, ""), (1, "a b", "a", None, ""), (2, "c", "missing", " ", "a b")]
    df = spark.createDataFrame(rows, "id int, who string, gold_who string, what string, gold_what string")
    known = spark.createDataFrame([("a b", ["a", "b"]), ("a", ["a"]), ("c", ["c"])], "phrase string, lemmas array<string>")
    assert sorted(r.phrase for r in E.distinct_phrases(df, ("who", "what")).collect()) == ["a", "a b", "c", "missing"]
    got = E.with_phrase_lemmas(df, known, ("who", "what")).orderBy("id").collect()
    assert [(r._lemmas_who, r._lemmas_gold_who, r._lemmas_what, r._lemmas_gold_what) for r in got] == [
        (["a", "b"], ["a"], [], []), (["a", "b"], ["a"], [], []), (["c"], [], [], ["a", "b"])
    ]


def test_from_answers_to_report(spark):
    frame = spark.createDataFrame(
        [(k, f"s{k}", "WYPADEK", "Anna", "", "", "", "") for k in range(4)],
        "idx long, sentence string, gold_label string, " + ", ".join(f"gold_{f} string" for f in FIELDS),
    )
    batches = spark.createDataFrame(
        [(0, '[{"idx": 0, "label": "WYPADEK", "confidence": 0.5, "who": "Anna"}, {"idx": 1, "label": "PROTEST", "confidence": 1}]'), (1, "no json"), (2, None)],
        "batch long, raw string",
    )
    singles = spark.createDataFrame(
        [(2, '{"label": "wypadek", "confidence": 0.25}', '{"who": "anna"}'), (0, '{"label": "PROTEST"}', "{}")], "idx long, class_raw string, relation_raw string"
    )
    labels = ["WYPADEK", "PROTEST", "BRAK_ZDARZENIA"]
    found = evaluate_answers(frame, batches, labels, singles=singles)
    rows = {r.idx: r for r in found.predictions.collect()}
    assert [rows[k].pred_label for k in range(4)] == ["WYPADEK", "PROTEST", "WYPADEK", "BRAK_ZDARZENIA"]
    assert [rows[k].who for k in range(4)] == ["Anna", None, "anna", None] and rows[3].confidence == 0
    report = found.report.first()
    assert report.n == 4 and report.event_type.accuracy == 0.5 and report.metrics.who.tp == 2
    assert {r.label for r in found.classes.where("kind = 'label'").collect()} == set(labels)


def test_phrases_move_once_to_their_lemmas(spark):
    rows = [("a b", "c"), ("a b", "c"), (None, " ")]
    df = spark.createDataFrame(rows, "who string, gold_who string")
    dictionary = spark.createDataFrame([("a b", ["a", "b"]), ("c", ["c"])], "phrase string, lemmas array<string>")
    known = E.with_phrase_lemmas(df, dictionary, ["who"])
    got = sorted((r.who or "", r._lemmas_who, r._lemmas_gold_who) for r in known.collect())
    assert got == [("", [], []), ("a b", ["a", "b"], ["c"]), ("a b", ["a", "b"], ["c"])]
    # Rows aren't told apart by a shuffle of their own.
    plan = known._jdf.queryExecution().sparkPlan().toString()
    plan += known._jdf.queryExecution().executedPlan().toString()
    assert "place" not in "".join(line for line in plan.splitlines() if "Exchange" in line or "keys=" in line)


def test_rows_are_made_once_for_file_and_report(spark, tmp_path, monkeypatch):
    """The detail rows are written and summed up in one pass: their source is read by one job."""
    from tidings.catalog import SPARK
    from tidings.operators import evaluate
    from tidings.sources import delimited

    spark.createDataFrame([(1, "Ala ma kota. Pies śpi")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plans = []
    write = delimited.write_predictions
    monkeypatch.setattr(delimited, "write_predictions", lambda df, path: (plans.append(df._jdf.queryExecution().analyzed().toString()), write(df, path)))
    monkeypatch.setattr(evaluate, "evaluation_report", None)
    assert [r.n for r in SPARK["s01_s02_written_report"](spark, str(tmp_path)).collect()] == [2] * 5
    assert "CollectMetrics" in plans[0]
