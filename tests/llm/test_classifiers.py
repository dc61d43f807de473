import os
import random
import zlib

import numpy as np
import pytest

from tidings.llm import language_id as L, quality_classifier as Q, subword as S, training

SYLLABLES = {"xx": ["ka", "lo", "mi", "tur"], "yy": ["sch", "ein", "ver", "ung"], "zz": ["ció", "ñe", "rra", "que"]}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def documents(rng, n=150):
    return [(k, text_of(rng, lang, rng.randint(8, 60)), lang) for k in range(n) for lang in [rng.choice(sorted(SYLLABLES))]]


def test_features_against_a_plain_reading():
    f = S.Features(bits=12, sizes=(1, 2, 3), words=True, letters=False)
    text = "ab  c ab\tdd dd"
    x = np.concatenate([[0], f.prepare(text), [0]]).astype(np.uint64)
    counts = [len(at) for at, _ in f.buckets(x, np.array([1]))]
    words = text.split()
    marked = [f"_{w}_" for w in words]
    grams = [sum(len(w) for w in words), sum(len(w) - 1 for w in marked), sum(max(0, len(w) - 2) for w in marked)]
    assert counts == [*grams, len(words), len(words) - 1]
    word_buckets = list(f.buckets(x, np.array([1])))[3][1]
    assert word_buckets[0] == word_buckets[2] and word_buckets[3] == word_buckets[4] and len(set(word_buckets)) == 3
    pairs = list(f.buckets(x, np.array([1])))[4][1]
    assert len(set(pairs)) == 4


def test_sums_do_not_depend_on_blocks_or_neighbours(monkeypatch):
    rng = random.Random(2)
    texts = [text_of(rng, "xx", n) for n in (1, 40, 900, 3)] + ["", None, "x" * 5000, "   ", "a" + " " * 3000 + "b c", " " * 900]
    f = S.Features(bits=10, sizes=(1, 2, 3, 4), words=True, letters=False)
    table = np.random.default_rng(0).normal(size=(1 << 10, 2)).astype(np.float32)
    alone = [S.table_sums(f, table, [t]) for t in texts]
    for block in (64, 700, 1 << 19):
        monkeypatch.setattr(S, "BLOCK", block)
        sums, counts = S.table_sums(f, table, texts)
        for k, (s, c) in enumerate(alone):
            np.testing.assert_allclose(sums[k], s[0], rtol=1e-9, atol=1e-9)
            assert counts[k] == c[0]
    monkeypatch.setattr(S, "BLOCK", 1 << 19)
    sums, counts = S.table_sums(f, table, texts)
    for k, (s, c) in enumerate(alone):
        np.testing.assert_allclose(sums[k], s[0], rtol=1e-9, atol=1e-9)
        assert counts[k] == c[0]
        found, shares = S.bag(f, texts[k])
        np.testing.assert_allclose((shares @ table[found]) * max(c[0], 0), s[0], rtol=1e-3, atol=1e-2)


def test_language_of_held_out_documents(spark, tables):
    rng = random.Random(4)
    rows = [(*r, "s", 1) for r in documents(rng, 240)]
    extra = [(1000, None, "xx", "s", 1), (1001, "", None, "s", 1), (1002, "123 !!", "xx", "s", 1), (None, text_of(rng, "yy", 30), "yy", "s", 1),
             (1003, text_of(rng, "zz", 20000), "zz", "s", 1), (0, rows[0][1], rows[0][2], "s", 1)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, source string, score int")
    got = L.op1_language_id(spark, tables(documents=docs)).collect()
    assert len(got) == len(rows) + len(extra)
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    odd = {r.doc_id: r for r in got}
    assert all((odd[k].lang_pred, odd[k].score, odd[k].rejected) == ("und", 0.0, True) for k in (1000, 1001, 1002))
    assert odd[1003].lang_pred == "zz" and odd[None].lang_pred == "yy"
    assert all(0 <= r.score <= 1 for r in got)
    kept = L.language_stage(spark, docs, "")
    assert kept.columns == docs.columns and kept.where("doc_id between 0 and 239").count() >= 238
    assert kept.where("doc_id between 1000 and 1002").count() == 0
    assert L.op1_language_id(spark, tables(documents=docs.limit(0))).count() == 0
    unlabelled = docs.limit(3).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in L.op1_language_id(spark, tables(documents=unlabelled)).collect()} == {"und"}


def test_foreign_text_is_rejected():
    rng = random.Random(6)
    rows = documents(rng, 200)
    bags, names = [S.bag(L.FEATURES, t) for _, t, _ in rows], sorted(SYLLABLES)
    model = S.train(L.FEATURES, bags, np.array([names.index(x) for _, _, x in rows]), names, epochs=5)
    best = lambda t: model.probabilities([t]).max()
    assert best(text_of(rng, "xx", 20)) > 0.9
    assert best("привет мир") < best(text_of(rng, "xx", 20))


def test_quality_of_held_out_documents(spark, tables):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(300):
        good = rng.random() < 0.7
        words = text_of(rng, "xx", rng.randint(20, 60)).split()
        if not good:
            words = [f"{w}%%" for w in words] if k % 2 else [words[0]] * len(words)
        rows.append((k, " ".join(words), "xx", "s"))
        labels.append((k, int(good), 0))
    rows += [(900, None, None, None), (901, "", None, None), (None, "ka lo", None, None), (5, rows[5][1], "xx", "s")]
    labels += [(5, labels[5][1], 0), (None, 1, 0), (902, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as label", "2 as h")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = Q.op3_quality_classifier(spark, tables(documents=docs, labels=marks)).collect()
    assert len(got) == len(rows)
    truth = {k: q for k, q, _ in labels[:300]}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    none = Q.op3_quality_classifier(spark, tables(documents=docs, labels=marks.limit(0))).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.op3_quality_classifier(spark, tables(documents=docs.limit(0), labels=marks)).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_training_repeats(seed):
    rng = random.Random(seed)
    bags = [S.bag(L.FEATURES, text_of(rng, "xx", 9)) for _ in range(10)]
    one, two = (S.train(L.FEATURES, bags, np.arange(10) % 2, [0, 1], epochs=2) for _ in range(2))
    np.testing.assert_array_equal(one.table, two.table)


def test_fit_runs_in_a_task(spark, monkeypatch):
    plain = training.train

    def noted(*args, **kinds):
        model = plain(*args, **kinds)
        model.pid = os.getpid()
        return model

    monkeypatch.setattr(training, "train", noted)
    rows = spark.createDataFrame([(f"{w} {w}{k}", w) for k in range(10) for w in ("kot", "pies")], "text string, label string")
    model, logits, held = training.fit(training.labelled(rows), rows, L.FEATURES, max_rows=20, epochs=2, rate=0.5)
    assert model.pid != os.getpid() and model.classes == ["kot", "pies"]
    assert logits.shape == (4, 2) and sorted(held) == [0, 0, 1, 1]
