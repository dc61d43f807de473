import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.catalog import SPARK
from tidings.functions import text as T
from tidings.operators import classify, features, newton, sampling
from tidings.plans import extraction, training
from tidings.sources.model_store import load_model, save_model


def test_text_functions(spark):
    rows = [("\xa0 A (x) ", "Ala ma kota, ALA"), ("(y)", "ę"), (None, "a b")]
    df = spark.createDataFrame(rows, "label string, s string")
    got = df.select(
        T.normalize_label(F.col("label")).alias("l"),
        T.word_ngrams(T.word_tokens(F.col("s"), ["ma"])).alias("w"),
        T.char_ngrams(F.col("s")).alias("c"),
    ).collect()
    assert [r.l for r in got] == ["A", "", None]
    assert got[0].w == ["ala", "kota", "ala", "ala kota", "kota ala"]
    assert got[1].c == [" ę "] and got[2].c == [" a ", " b "]
    brute = []
    for word in "ala ma kota, ala".split():
        padded = f" {word} "
        for n in range(3, min(5, len(padded)) + 1):
            brute += [padded[k : k + n] for k in range(len(padded) - n + 1)]
    assert Counter(got[0].c) == Counter(brute)


def test_numbers_as_a_table_reader_sees_them(spark):
    texts = ["1", " 2.5 ", "1e2", "1d", "1.5f", "x", "", ".5", "-3.", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.n for r in df.select(T.to_number(F.col("t")).alias("n")).collect()]
    assert got == [1.0, 2.5, 100.0, None, None, None, None, 0.5, -3.0, None]


def test_tfidf_against_brute_force(spark):
    texts = ["ala ma kota", "ala ma psa", "kot i pies", "ala ala", "zzz"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, sentence string")
    terms = features.term_table(df, blocks=("word",))
    vocabulary = features.fit_vocabulary(terms, len(texts), max_df=0.5)
    known = {r.term: r.idf for r in vocabulary.collect()}
    assert known == {"ma": pytest.approx(math.log(6 / 3) + 1), "ala ma": pytest.approx(math.log(6 / 3) + 1)}
    for size in (None, 2, 10**12):
        weights = features.tfidf(terms, vocabulary, vocabulary_bytes=size).collect()
        assert {(r.id, r.term) for r in weights} == {(k, t) for k in (0, 1) for t in known}
        assert all(r.weight == pytest.approx(math.sqrt(0.5)) for r in weights)


def test_split_and_oversampling_keep_every_row(spark):
    sizes = {"A": 53, "B": 31, "C": 17, "D": 2}
    rows = [(c, f"{c}{k}") for c, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "label string, sentence string")
    split = sampling.stratified_split(df).collect()
    assert len(split) == 103 and sum(r.is_test for r in split) == 21
    tested = Counter(r.label for r in split if r.is_test)
    assert all(abs(tested[c] - 0.2 * n) < 1 for c, n in sizes.items())
    again = sampling.stratified_split(df.repartition(5)).collect()
    assert {(r.sentence, r.is_test) for r in again} == {(r.sentence, r.is_test) for r in split}
    lonely = sampling.stratified_split(df.unionAll(spark.createDataFrame([("E", "e")], df.schema)))
    assert lonely.where("is_test").count() == 21
    grown = sampling.oversample(df)
    copies = {r.label: r.n for r in grown.groupBy("label").agg(F.sum("copies").alias("n")).collect()}
    assert copies == dict.fromkeys(sizes, 53) and grown.count() == 103
    assert grown.agg(F.min("copies")).first()[0] == 1
    assert sampling.expand_copies(grown).count() == 4 * 53


def test_hot_group_is_ranked_whole(spark):
    df = spark.range(5000).selectExpr("'hot' as label", "cast(id as string) as sentence")
    ranks = sampling.ranked(df, ("label",), ("label", "sentence"), 1).select("_rank").collect()
    assert sorted(r._rank for r in ranks) == list(range(5000))


def test_sample_and_head(spark):
    df = spark.range(1000)
    first = {r.id for r in sampling.sample_n(df, 100, ["id"], 3).collect()}
    assert len(first) == 100
    assert first == {r.id for r in sampling.sample_n(df.repartition(7), 100, ["id"], 3).collect()}
    assert first != {r.id for r in sampling.sample_n(df, 100, ["id"], 4).collect()}
    assert sampling.limit_rows(df, 0, sample=True, key=["id"]).count() == 1000
    assert sorted(r.id for r in sampling.head_n(df, 20, ["id"]).collect()) == list(range(20))


def test_head_with_equal_order_keys_and_maps(spark):
    df = spark.range(40).selectExpr("cast(id % 5 as int) as k", "map('a', id div 10) as m")
    numbered = sorted((r.idx, r.k) for r in sampling.with_row_index(df, ["k"]).collect())
    assert [i for i, _ in numbered] == list(range(40))
    assert [k for _, k in numbered] == sorted(k for _, k in numbered)
    for n in (0, 3, 11, 40, 100):
        first = sorted((r.k, str(r.m)) for r in sampling.head_n(df, n, ["k"]).collect())
        again = sorted((r.k, str(r.m)) for r in sampling.head_n(df.repartition(5), n, ["k"]).collect())
        assert len(first) == min(n, 40) and first == again


def test_keyword_rules(spark):
    rows = [
        ("napastnik i pożar", "PRZESTEPSTWO", 0.4),
        ("Pożar", "BRAK_ZDARZENIA", 0.55),
        ("Pożar", "BRAK_ZDARZENIA", 0.54),
        ("nic", "WYPADEK", 0.1),
    ]
    df = spark.createDataFrame(rows, "sentence string, label string, confidence double")
    got = [(r.label, r.confidence) for r in classify.apply_keyword_rules(df).collect()]
    assert got == [("KATASTROFA", 0.9), ("BRAK_ZDARZENIA", 0.55), ("KATASTROFA", 0.9), ("WYPADEK", 0.1)]


class Fixed:
    def predict(self, sentence):
        return ("BRAK_ZDARZENIA" if "nic" in sentence else "PROTEST"), 0.8

    def extract_relations(self, sentence):
        return "kto", "trigger", None, "tu", None


def annotator():
    def parse(sentence):
        words = sentence.split()
        tokens = [
            dict(i=i, text=w, ws=" ", lemma=w.lower(), pos="VERB" if i == 1 else "NOUN",
                 dep="ROOT" if i == 1 else "nsubj", head=1 if len(words) > 1 else 0, ent_type="", verb_form="Fin")
            for i, w in enumerate(words)
        ]
        return tokens, []

    return parse


def test_plugged_in_models(spark):
    texts = spark.createDataFrame([(1, "Ala protestuje\n\n nic nie ma \n")], "doc int, text string")
    df = extraction.sentences_of(texts)
    got = extraction.extract_events(df, load_classifier=Fixed, load_extractor=Fixed).orderBy("sentence").collect()
    assert [(r.event_type, r.who, r.where) for r in got] == [("PROTEST", "kto", "tu"), ("BRAK_ZDARZENIA", None, "tu")]
    ruled = extraction.extract_events(df, load_classifier=Fixed, load_annotator=annotator).orderBy("sentence").first()
    assert (ruled.who, ruled.trigger) == ("Ala", "protestuje")
    with pytest.raises(ValueError):
        extraction.extract_events(df, load_classifier=Fixed)
    with pytest.raises(TypeError):
        training.train_with(Fixed(), df)
    with pytest.raises(RuntimeError):
        training.predict(None, df)


def test_train_save_load_predict(spark, tmp_path):
    rows = []
    for k in range(40):
        rows += [("WYPADEK", f"samochód uderzył w drzewo numer {k}"), ("PROTEST", f"strajk nauczycieli dzień {k}")]
    rows += [("POLITYKA", f"premier ogłosił ustawę {k}") for k in range(12)]
    df = spark.createDataFrame(rows, "label string, sentence string")
    model, report = training.train_event_type(df, max_iter=30)
    assert report.where("kind = 'accuracy'").first().f1 == 1.0
    texts = spark.createDataFrame([(1, "strajk trwa dzień"), (2, "premier i ustawę"), (3, "qqq")], "id int, sentence string")
    before = training.predict(model, texts, rules=()).orderBy("id").collect()
    assert [r.label for r in before][:2] == ["PROTEST", "POLITYKA"]
    save_model(model, str(tmp_path / "m"), meta={"author": "x"})
    loaded = load_model(spark, str(tmp_path / "m"))
    assert loaded.meta == {"author": "x"} and loaded.rules == model.rules and loaded.labels == model.labels
    after = training.predict(loaded, texts, rules=()).orderBy("id").collect()
    assert [(r.label, round(r.confidence, 9)) for r in after] == [(r.label, round(r.confidence, 9)) for r in before]
    with pytest.raises(TypeError):
        save_model(Fixed(), str(tmp_path / "n"))


@pytest.mark.parametrize("n_labels", [2, 3, 5])
def test_the_fit_ends_at_the_optimum(n_labels):
    rng = np.random.default_rng(n_labels)
    x = rng.random((200, 900)) * (rng.random((200, 900)) < 0.03)
    x[7] = 0  # a row without any term
    label, weight = rng.integers(0, n_labels, 200), rng.choice([0.5, 1, 40], 200)
    gram = x @ x.T
    fit = newton.solve(lambda table: gram @ table, label, weight, n_labels)
    scores = x @ (x.T @ fit.alpha) + fit.intercepts
    if n_labels == 2:
        p, hit = 1 / (1 + np.exp(-scores)), (label == 1)[:, None]
    else:
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p, hit = p / p.sum(axis=1, keepdims=True), np.eye(n_labels)[label]
    rest = weight[:, None] * (p - hit)
    assert np.linalg.norm(x.T @ fit.alpha + x.T @ rest) < 1e-4 and np.abs(rest.sum(axis=0)).max() < 1e-4
    # Separable classes and one row of a class end too.
    few = newton.solve(lambda table: gram[:3, :3] @ table, np.arange(3) % n_labels, np.ones(3), n_labels)
    assert few.gradient <= newton.GRADIENT


def test_products_with_the_gram_matrix(spark):
    rng = np.random.default_rng(1)
    x = rng.random((30, 60)) * (rng.random((30, 60)) < 0.2)
    entries = [(100 + i, "word", f"t{j}", float(x[i, j])) for i in range(30) for j in range(60) if x[i, j]]
    weights = spark.createDataFrame(entries + [(999, "word", "t0", 1.0)], "row long, block string, term string, weight double")
    rows = spark.createDataFrame([(100 + i, i) for i in range(30)], "row long, place long")
    postings = newton.term_postings(weights.repartition(5), rows, "row")
    table = rng.standard_normal((30, 3))
    np.testing.assert_allclose(newton.gram_product(postings)(table), x @ x.T @ table, atol=1e-12)
    found = {r.term: r.coefficients for r in newton.coefficients(postings, table).collect()}
    want = x.T @ table
    assert len(found) == int((x.any(axis=0)).sum())
    for term, got in found.items():
        np.testing.assert_allclose(got, want[int(term[1:])], atol=1e-12)


def test_stored_terms_are_the_terms(spark):
    texts = ["ala ma kota", None, "", "ala ma psa " * 50, "ala ma kota"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, sentence string").withColumn("side", F.col("id") % 2)
    stored = features.stored_terms(df, keep=["side"])
    assert sorted(map(tuple, stored.drop("side").collect())) == sorted(map(tuple, features.term_table(df).collect()))
    assert all(r.side == r.id % 2 for r in stored.collect())
    # A group by key needs no shuffle over the buckets.
    assert "Exchange" not in stored.groupBy("id", "block").count()._jdf.queryExecution().executedPlan().toString()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("terms")]


def test_a_bounded_fit_keeps_the_whole_vocabulary_and_every_label(spark):
    rows = [("A", f"kot numer {k} {w}") for k in range(12) for w in ("rano", "wieczorem")] + [("B", f"pies {k} noc") for k in range(8)]
    rows += [("C", f"premier {k} dom") for k in range(3)]
    df = spark.createDataFrame(rows, "label string, sentence string")
    whole, _ = training.train_event_type(df, max_iter=3)
    model, _ = training.train_event_type(df, max_iter=3, max_fit_rows=4)
    terms = lambda m: {(r.block, r.term, r.idf) for r in m.terms.collect()}
    assert terms(model) == terms(whole)
    assert model.labels == ("A", "B", "C")
    assert {len(r.coefficients) for r in model.terms.collect()} == {3}


def test_stream_of_sentences(spark, tmp_path):
    from tidings.streaming.scoring import write_event_stream

    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "Ala protestuje"), (2, "nic nie ma")], "id int, sentence string").write.parquet(source)
    stream = spark.readStream.schema("id int, sentence string").parquet(source)
    query = write_event_stream(
        stream, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), load_classifier=Fixed, load_annotator=annotator
    )
    query.awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").collect()
    assert [(r.event_type, r.trigger) for r in got] == [("PROTEST", "protestuje"), ("BRAK_ZDARZENIA", None)]


def test_two_decimals_round_the_binary_value(spark):
    from tidings.operators.records import two_decimals

    values = [0.125, 0.285, 1.005, 0.375, 0.0, 1.0, 0.999, 0.995, 0.445, 0.005, 0.015, 2.675, -0.125]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double").orderBy("k")
    assert [r[0] for r in df.select(two_decimals(F.col("v"))).collect()] == [f"{v:.2f}" for v in values]


def test_all_line_breaks_split(spark):
    df = spark.createDataFrame([("a\x1cb\x1dc\x1ed\r\ne\u2028f",)], "t string")
    assert df.select(T.lines(F.col("t"))).first()[0] == list("abcdef")


def test_char_terms_of_a_batch_are_those_of_each_text(spark):
    from tidings.functions.grams import char_term_counts

    rng = random.Random(3)
    letters = "aąbżé \t\u2028ß😀İ" + "".join(map(chr, range(0x4E00, 0x4E20)))
    texts = [None, "", " ", "a", " a\u3000ab\n", "ala ma kota ala", "x" * 3000, "".join(map(chr, range(0x3400, 0xD000)))]
    texts += ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = df.select("id", char_term_counts(F.col("t")).alias("now"), T.term_counts(T.char_ngrams(F.col("t"))).alias("then")).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.now is None) == (texts[r.id] is None)
        assert sorted(map(tuple, r.now or [])) == sorted(map(tuple, r.then or [])), r.id


def test_char_terms_are_spread_over_tasks(spark, tmp_path):
    """One small file is read by one task; its n-grams are made by all of them."""
    from tidings.catalog import SPARK

    rows = [(k, f"słowo {k} inne słowo") for k in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = SPARK["t05_char_ngrams"](spark, str(tmp_path))
    assert "hashpartitioning(doc_id" in found._jdf.queryExecution().executedPlan().toString()
    assert {r.term: (r.n, r.n_docs) for r in found.collect()}[" sł"] == (400, 200)


def test_term_sums_come_label_by_label():
    """One label's numbers are held at a time, however many labels there are."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"places": pa.array([[0, 2], [1]], pa.list_(pa.int32())), "values": pa.array([[1.0, 2.0], [3.0]], pa.list_(pa.float64()))}
    )
    table = np.arange(6.0).reshape(3, 2)
    got = [sums.tolist() for sums in newton._per_term(batch, table)]
    assert got == [[0.0 + 2 * 4, 3 * 2.0], [1.0 + 2 * 5, 3 * 3.0]]


def test_terms_stay_in_their_parts(spark, tmp_path, monkeypatch):
    """With a vocabulary too large to broadcast no term moves to it and back; keys may repeat or be null."""
    rows = [(k % 40 if k % 7 else None, " ".join(f"w{(k * j) % 17}" for j in range(k % 9 + 1)) + " ja Ärger") for k in range(120)]
    rows += [(500, None), (501, ""), (502, "..."), (503, "alone")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    results = []
    for limit in (features.BROADCAST_BYTES, 0):
        monkeypatch.setattr(features, "BROADCAST_BYTES", limit)
        for query in ("t07_tfidf_words", "t07_tfidf"):
            weights = SPARK[query](spark, str(tmp_path))
            results.append(sorted(map(tuple, weights.collect()), key=repr))
            plan = weights._jdf.queryExecution().sparkPlan().toString()
            assert ("ShuffledHashJoin" in plan) == (limit == 0)
            if not limit and query == "t07_tfidf_words":
                moved = [line for line in weights._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
                assert moved and all("part#" in line and "term#" not in line for line in moved)
    assert results[0] and results[0] == results[2] and results[1] == results[3]


def test_the_fit_takes_all_rows(spark, monkeypatch):
    """No number of training rows bounds the fit unless a caller says so."""
    seen, solve = [], newton.solve

    def watched(product, labels, weight, n_labels, **options):
        seen.append(int((weight > 0).sum()))
        return solve(product, labels, weight, n_labels, **options)

    monkeypatch.setattr(newton, "solve", watched)
    df = spark.range(130_000).selectExpr("if(id % 3 = 0, 'A', 'B') as label", "concat('s', id % 11) as sentence")
    training.train_event_type(df, max_iter=1, oversample=False)
    assert seen == [104_000]


def test_postings_are_packed(spark):
    """Many terms lie in one row, as bytes; numbers without a row stay out of the fit."""
    weights = spark.range(3000).selectExpr("id % 50 as place", "'word' as block", "concat('t', id div 3) as term", "0.5D as weight")
    postings = newton.term_postings(weights, None, "place")
    assert postings.count() < 100 and dict(postings.dtypes)["values"] == "binary"
    rows = spark.range(40).selectExpr("id as place", "cast(id % 3 as double) as label_index", "1.0D as weight")
    terms, intercepts = classify.fit_classifier(weights, rows, 3, key="place", numbers=50)
    alone, same = classify.fit_classifier(weights.where("place < 40"), rows, 3, key="place")
    found, wanted = ({r.term: r.coefficients for r in t.collect()} for t in (terms, alone))
    assert len(found) == 1000 and intercepts == pytest.approx(same, abs=1e-4)
    assert all(found[t] == pytest.approx(wanted.get(t, [0.0] * 3), abs=1e-4) for t in found)


def test_prediction_leaves_the_terms_in_their_parts(spark, monkeypatch):
    """With a model too large to broadcast, its entries go to the terms and not the other way."""
    texts = [f"ala ma {w} numer {k}" for k in range(12) for w in ("kota", "psa", "dom")] + ["", "..."]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, sentence string")
    vocabulary = features.fit_vocabulary(features.term_table(df.where("id % 3 > 0")), 24)
    terms = features.store_vocabulary(vocabulary.withColumn("coefficients", F.expr("array(length(term) / 10D, -0.2D, if(block = 'word', 0.3D, 0D))")))
    model = training.EventTypeModel(terms, features.table_bytes(terms), ("A", "B", "C"), (0.0, 0.1, 0.0))
    results = []
    for limit in (features.BROADCAST_BYTES, 0):
        monkeypatch.setattr(features, "BROADCAST_BYTES", limit)
        found = training.predict(model, df, rules=())
        results.append(sorted((r.id, r.label, round(r.confidence, 9)) for r in found.collect()))
        lines = found._jdf.queryExecution().sparkPlan().toString().splitlines()
        plan = found._jdf.queryExecution().executedPlan().toString().splitlines()
        assert any("ShuffledHashJoin" in line for line in lines) == (limit == 0)
        if not limit:
            assert not [line for line in plan if "Exchange hashpartitioning" in line and "term#" in line]
    assert len(results[0]) == 38 and results[0] == results[1]


def test_rows_without_label_leave_gaps_in_the_numbers(spark):
    rows = [(None if k % 5 == 0 else "AB"[k % 2], f"{'strajk' if k % 2 else 'pożar'} numer {k}") for k in range(60)]
    model, report = training.train_event_type(spark.createDataFrame(rows, "label string, sentence string"), max_iter=2)
    assert model.labels == ("A", "B") and report.where("kind = 'accuracy'").first().support > 0
