"""Importance resampling, hard negatives and nearest neighbours against plain readings."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidings.llm import cover_tree as C, importance as I, prefix_forest as P, vectors as V

# --- importance resampling ---------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text, max_n, buckets):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    grams = [" ".join(words[i : i + n]) for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def plain_draw(docs, target, max_n=1, buckets=10_000, least=20, percent=10, seed=2024):
    own = [(i, *plain_features(t, max_n, buckets)) for i, t in docs]
    s, t = Counter(b for r in own for b in r[2]), Counter(b for x in target for b in plain_features(x, max_n, buckets)[1])
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in s}
    rows = []
    for i, words, found in own:
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, *r[1:4]))
    rank = Counter()
    drawn = [(*r, k + 1) for k, r in enumerate(able[: percent * len(able) // 100])]
    rank.update(r[:5] for r in drawn)
    rest = Counter(rows) - rank
    return sorted([*drawn, *((*r, None) for r in rest.elements())], key=repr)


def texts(rng, n):
    vocabulary = ["The", "river", "STONE", "é", "Ünder", "x1", "2024", "a-b", "ﬁ", "北京", "ı"]
    return [rng.choice([" ", "\n", ", "]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("max_n, joined", [(1, 1 << 22), (1, 50), (3, 1 << 22), (3, 50)])
def test_resampling_against_a_plain_reading(spark, monkeypatch, max_n, joined):
    rng = random.Random(max_n)
    docs = [*enumerate(texts(rng, 150)), (900, None), (901, ""), (902, " ,\x00; "), (None, "The river " * 15), (None, "stone " * 30), (3, "x1 " * 25), (3, "x1 " * 25)]
    target = [*texts(rng, 5), None, "river river stone"]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as score", "2 as rank", "3 as bucket")
    monkeypatch.setattr(I, "JOINED_BYTES", joined)
    counted = Counter()
    for _, _, where in I.batch_features([None if t is None else t.encode() for _, t in docs], max_n, 997):
        counted.update(where.tolist())
    assert counted == Counter(b for _, t in docs for b in plain_features(t, max_n, 997)[1])
    goal = spark.createDataFrame([(t,) for t in target], "text string").selectExpr("*", "1 as doc_id")
    got = I.resample(frame, goal, max_n=max_n, percent=30).collect()
    assert sorted(map(tuple, got), key=repr) == plain_draw(docs, target, max_n, percent=30)


def test_draw_with_ties_and_a_row_that_repeats(spark, tables, monkeypatch):
    monkeypatch.setattr(I, "CHUNK", 7)
    docs = [(5, "same words " * 12)] * 60 + [(k, "other words " * 11) for k in range(40)] + [(99, "short")]
    target = ["same"]
    folder = tables(
        documents=spark.createDataFrame(docs, "doc_id long, text string"), benchmark=spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    )
    got = I.op11_importance_resampling(spark, folder).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *r[2:]) for r in plain_draw(docs, target)), key=repr)
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 11))


def test_resampling_of_long_and_of_no_texts(spark, tables):
    long = "word " * 1_300_000
    schema = "doc_id long, text string"
    empty, goal = spark.createDataFrame([], schema), spark.createDataFrame([(1, "word")], "item_id long, text string")
    got = I.resample(spark.createDataFrame([(1, long), (2, "a" * 6_000_000)], schema), goal, percent=100).collect()
    assert sorted((r.doc_id, r.n_features, r.rank) for r in got) == [(1, 1_300_000, 1), (2, 1, None)]
    assert I.op11_importance_resampling(spark, tables(documents=empty, benchmark=goal)).count() == 0
    docs = spark.createDataFrame([(1, "a b c " * 9)], schema)
    got = I.op11_importance_resampling(spark, tables(documents=docs, benchmark=goal.limit(0))).collect()
    assert [(r.n_features, r.rank) for r in got] == [(27, None)]


# --- vector tables -----------------------------------------------------------


def vector_rows(rng, n, dimension=8, spread=0.3):
    """Clusters, copies, rows of other norms, and rows that take no part."""
    centres = rng.normal(size=(6, dimension))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dimension))
    x *= rng.choice([0.2, 1, 1, 3], n)[:, None]
    x[1::9] = x[0]
    rows = [(k, [float(v) for v in np.float32(x[k])], int(rng.integers(0, 10))) for k in range(n)]
    bad = [None, [], [float("nan")] * dimension, [1.0] * (dimension - 1) + [None], [1.0] * (dimension - 1) + [float("inf")], [1.0] * (dimension + 1)]
    rows += [(100 * (n + k), v, 1) for k, v in enumerate(bad)] + [(7 * n * 100, [1.0] * dimension, None), (None, [1.0] * dimension, 2)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_negatives(rows):
    dimension, usable = 8, []
    for i, v, label in rows:
        if i is None or label is None or v is None or len(v) != dimension or any(c is None or not math.isfinite(c) for c in v):
            continue
        usable.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * c) for c in v]))
    out = []
    for i, label, x in usable:
        if i % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), j, m == label) for j, m, y in usable if j != i)
            for p, j, _ in [s for s in scored if s[2]][:5]:
                window = [(n, j2) for n, j2, same in scored if not same and -30 * p <= -100 * n <= -90 * p][:10]
                out += [(i, j, r + 1, j2, -p, -n) for r, (n, j2) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize("block, leaf, wave", [(4096, 16, 32), (90, 2, 1)])
def test_hard_negatives_against_all_pairs(spark, tables, monkeypatch, block, leaf, wave):
    monkeypatch.setattr(V, "BLOCK_ROWS", block)
    monkeypatch.setattr(C, "LEAF", leaf)
    monkeypatch.setattr(C, "WAVE", wave)
    rows = vector_rows(np.random.default_rng(block), 700)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as score", "3 as rank", "4 as key").repartition(4)
    got = C.op12_hard_negatives(spark, tables(embeddings=frame)).collect()
    assert got and sorted(map(tuple, got)) == plain_negatives(rows)


def test_hard_negatives_do_not_depend_on_query_blocks(spark, monkeypatch):
    rows = C.candidates(spark.createDataFrame(vector_rows(np.random.default_rng(5), 500), SCHEMA), shifted=F.lit(False))
    one = sorted(map(tuple, C.hard_negatives(rows, rows.where("id % 50 = 0")).collect()))
    monkeypatch.setattr(V, "QUERY_BYTES", 200)
    assert one and sorted(map(tuple, C.hard_negatives(rows, rows.where("id % 50 = 0")).collect())) == one


def test_hard_negatives_of_few_rows(spark, tables):
    def run(rows):
        return C.op12_hard_negatives(spark, tables(embeddings=spark.createDataFrame(rows, SCHEMA))).count()

    assert run([]) == 0
    assert run([(0, None, 1), (100, [float("nan")], 1)]) == 0
    assert run([(0, [1.0], 1), (100, [1.0], 1)]) == 0  # no other label
    assert run([(0, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (100, [0.0, 0.0], 2)]) == 2  # 0 moves to label 2; scores of zero lie in their window


def test_cover_tree_covers_and_separates():
    x = np.random.default_rng(1).integers(-40, 40, (600, 5)).astype(float)
    x[::7] = x[3]
    tree = C.CoverTree(x)
    assert sorted(tree.order) == list(range(600))
    last_radius = np.inf
    for centre, cover, _, first, last in tree.levels:
        assert cover.max() <= last_radius
        last_radius = cover.max() / 2
        for c, r, a, b in zip(centre, cover, first, last):
            if a >= 0:
                own = tree.x[tree.order[a:b]]
                assert np.sqrt(((own - tree.x[c]) ** 2).sum(axis=1)).max() <= r * (1 + 1e-9)
                assert len(own) <= C.LEAF or r == 0
    queries = np.random.default_rng(2).integers(-40, 40, (9, 5)).astype(float)
    for level, (_, _, _, first, last) in enumerate(tree.levels):
        low, high = tree.bounds(level, queries, np.sqrt((queries**2).sum(axis=1)))
        for n in np.flatnonzero(first >= 0):
            score = queries @ x[tree.order[first[n] : last[n]]].T
            assert (score.min(axis=1) >= low[:, n]).all() and (score.max(axis=1) <= high[:, n]).all()


def plain_nearest(rows, k=20, every=20):
    usable = [(i, np.array(v, float)) for i, v, _ in rows if i is not None and v and len(v) == 8 and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, x in usable:
        if i % every == 0:
            out[i] = sorted(((-float((x * y).sum()), j) for j, y in usable if j != i))[:k]
    return out


def test_nearest_neighbours_recall(spark, tables):
    rows = vector_rows(np.random.default_rng(3), 3000) + [(2_000_020, [0.0] * 8, 1), (2_000_041, [0.0] * 8, 1)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as score", "3 as rank", "4 as query").repartition(3)
    got = P.op13_prefix_forest(spark, tables(embeddings=frame)).collect()
    want = plain_nearest(rows)
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(want)
    found = 0
    vector = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and len(v) == 8 and None not in v}
    for i, hits in by.items():
        hits.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in hits] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in hits] == sorted((-r.score, r.vec_id) for r in hits)
        assert all(r.score == float((vector[i] * vector[r.vec_id]).sum()) for r in hits)
        # Copies tie: a hit counts if its score is among the best ones'.
        found += sum(-r.score <= want[i][-1][0] for r in hits)
    assert found / sum(map(len, want.values())) >= 0.95


def test_nearest_without_misses_is_exact(spark, monkeypatch):
    rows = vector_rows(np.random.default_rng(4), 400)
    frame = spark.createDataFrame(rows, SCHEMA)
    want = sorted((i, r + 1, j) for i, hits in plain_nearest(rows).items() for r, (_, j) in enumerate(hits))

    def run():
        return sorted((r.query_id, r["rank"], r.vec_id) for r in P.nearest(frame, frame.where("vec_id % 20 = 0"), miss=0.0).collect())

    assert run() == want
    monkeypatch.setattr(V, "BLOCK_ROWS", 64)
    monkeypatch.setattr(V, "QUERY_BYTES", 500)
    assert run() == want


def test_nearest_of_few_rows(spark, tables):
    def run(rows):
        return sorted(map(tuple, P.op13_prefix_forest(spark, tables(embeddings=spark.createDataFrame(rows, SCHEMA))).collect()))

    assert run([]) == [] and run([(0, None, 1), (20, [0.0], 1)]) == []
    assert run([(0, [2.0], 1)]) == []
    assert run([(0, [2.0], 1), (1, [-3.0], 1), (2, [5.0], None), (2, [5.0], None)]) == [(0, 1, 2, 10.0), (0, 2, 2, 10.0), (0, 3, 1, -6.0)]


def test_blocks_of_rows():
    table = pa.table({"id": list(range(25)), "vector": [[float(k), 1.0] for k in range(25)], "label": [1] * 25})
    blocks = list(V.row_blocks(iter(table.to_batches(max_chunksize=4)), 2, 10))
    assert [len(b.id) for b in blocks] == [10, 10, 5]
    assert np.concatenate([b.x[:, 0] for b in blocks]).tolist() == list(range(25))
