from pyspark.sql import functions as F

from tidings.operators import evaluate as E, metrics, records

SCHEMA = "id int, label string, sentence string, " + ", ".join(
    f"`{f}` string, `gold_{f}` string" for f in E.FIELDS
)


def frame(spark, *rows):
    """Rows as dictionaries of fields; all else is empty."""
    names = [n for f in E.FIELDS for n in (f, f"gold_{f}")]
    data = [
        (k, "L", f"s{k}", *[r.get(n, "" if n.startswith("gold") else None) for n in names])
        for k, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def counts(report, field):
    m = report.first().metrics[field]
    return m.tp, m.fp, m.fn


def test_match_thresholds(spark):
    df = frame(
        spark,
        {"who": "a", "gold_who": "a b"},
        {"who": "a b x", "gold_who": "a b c"},
        {"who": "a b c d", "gold_who": "a b c d e"},
        {"who": "!!!", "gold_who": "a"},
        {"who": "a", "gold_who": "..."},
        {"who": "A, b!", "gold_who": "a"},
    )
    hits = [r._hit_who for r in E.with_matches(df).orderBy("id").collect()]
    assert hits == [True, False, True, False, False, True]


def test_outcomes_and_undefined_scores(spark):
    df = frame(
        spark,
        {"what": "x", "gold_what": "y"},
        {"when": "dziś"},
        {"where": "  ", "gold_where": "las"},
    )
    lenient = E.evaluation_report(E.with_matches(df))
    assert counts(lenient, "what") == (0, 1, 1)
    what = lenient.first().metrics.what
    assert what.precision == 0.0 and what.recall == 0.0 and what.f1 is None
    assert counts(lenient, "when") == (0, 0, 0)
    assert counts(lenient, "where") == (0, 0, 1)
    strict = E.evaluation_report(E.with_matches(df, strict_when=True), strict_when=True)
    assert counts(strict, "when") == (0, 1, 0)
    assert lenient.first().sentence_accuracy.when == 1.0
    assert abs(strict.first().sentence_accuracy.when - 2 / 3) < 1e-12
    assert lenient.first().metrics.who.f1 is None


def test_corrections(spark):
    df = frame(
        spark,
        {"who": "nowy", "gold_who": "stary", "when": "dziś"},
        {"gold_who": "stary", "when": "jutro", "gold_when": "wczoraj"},
    )
    fixed = E.suggested_tags(E.top_matches(E.with_matches(df), 5)).orderBy("id").collect()
    assert [(r.KTO, r.KIEDY) for r in fixed] == [("nowy", ""), ("stary", "jutro")]
    again = E.corrected_report(E.top_matches(E.with_matches(df), 5)).first()
    assert again.sentence_accuracy.who == 0.5 and again.metrics.who.fn == 1.0


def test_proxy_counts(spark):
    rows = [
        ("Jan Nowak", None, None, [("persName", "Nowak")]),
        ("ktoś", None, None, [("persName", "Nowak")]),
        ("ktoś", None, None, []),
        (None, "w Gdyni", None, [("geogName", "gdyni"), ("persName", "X")]),
    ]
    df = spark.createDataFrame(
        rows, "who string, `where` string, `when` string, ents array<struct<label:string,text:string>>"
    )
    got = {r.field: (r.tp, r.fp, r.fn) for r in E.proxy_counts(df).collect()}
    assert got["who"] == (1, 1, 1) and got["where"] == (1, 0, 0)
    assert got["what"] == got["trigger"] == got["when"] == (0, 0, 0)


def test_lemma_set_drops_function_words(spark):
    schema = "tokens array<struct<text:string,lemma:string,pos:string>>"
    tokens = [("W", "w", "ADP"), ("Polsce", "Polska", "PROPN"), ("Polska", "", "PROPN"), ("+", "+", "X")]
    df = spark.createDataFrame([(tokens,)], schema)
    assert df.select(E.lemma_set(F.col("tokens")).alias("s")).first().s == ["polska"]


def test_report_of_nothing_and_of_one_label(spark):
    empty = spark.createDataFrame([], "label string, pred string")
    row = metrics.headline_scores(empty).first()
    assert row.n == 0 and row.accuracy is None and row.f1_macro is None
    one = spark.createDataFrame([("A", "A"), ("A", "B")], "label string, pred string")
    report = {(r.kind, r.label): r for r in metrics.classification_report(one).collect()}
    assert report["label", "B"].recall == 0.0 and report["accuracy", None].f1 == 0.5
    assert abs(report["macro avg", None].f1 - 1 / 3) < 1e-12


def test_record_without_event(spark):
    df = spark.createDataFrame(
        [("BRAK_ZDARZENIA", 0.5, "s"), ("WYPADEK", 0.123, "s")], "label string, confidence double, sentence string"
    ).withColumns({f: F.lit(f) for f in E.FIELDS})
    none, some = records.extract_event(df).orderBy("event_type").collect()
    assert (none.who, none.what, none.trigger, none.where, none.when) == (None, None, None, "where", "when")
    assert some.who == "who"
    text = records.extract_event(df).where("event_type = 'BRAK_ZDARZENIA'").select(records.record_text().alias("t")).first().t
    assert text == "Typ zdarzenia: BRAK_ZDARZENIA\nGDZIE: where\nKIEDY: when\nPewność: 0.50"


def test_best_matches_are_kept_in_their_tasks(spark):
    rows = frame(spark, *[{"who": f"w{k}", "gold_who": f"w{k}" if k % 3 else "x"} for k in range(40)]).repartition(4)
    top = E.top_matches(E.with_matches(rows), 5)
    assert [r.id for r in top.collect()] == [1, 2, 4, 5, 7]
    for plan in (E.corrected_report(top), E.top_report(top)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_best_matches_tie_by_a_hash_of_the_row(spark):
    rows = frame(spark, *[{"who": f"w{k}"} for k in range(30)]).withColumns({"id": F.lit(1), "sentence": F.lit("s")})
    matched = E.with_matches(rows)
    first = matched.orderBy(F.md5(F.to_json(F.struct(*matched.columns)))).limit(7).collect()
    assert [r.who for r in E.top_matches(matched, 7).collect()] == [r.who for r in first]
