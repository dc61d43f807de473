import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidings.llm import components, simhash as S, substring_dedup as P


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(points, near):
    """Least id reachable, by comparing everything with everything."""
    ids, parent = [i for i, _ in points], list(range(len(points)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(points)):
        for b in range(a):
            if near(points[a][1], points[b][1]):
                parent[root(a)] = root(b)
    least = {}
    for k, i in enumerate(ids):
        least[root(k)] = min(least.get(root(k), i), i)
    return {(i, k): least[root(k)] for k, i in enumerate(ids)}


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def test_fingerprints_against_a_plain_reading():
    rng = random.Random(1)
    for text in [None, "", " \n", "One", "A B", "a b c", "a b c d", "Ä É x\xa0y z", *(" ".join(words(rng, rng.randint(1, 200))) for _ in range(40))]:
        assert np.int64(S.fingerprint(text)).view(np.uint64) == plain_fingerprint(text)
    long = " ".join(words(rng, 3000))
    slices, S.SLICE = S.SLICE, 100
    try:
        assert np.int64(S.fingerprint(long)).view(np.uint64) == plain_fingerprint(long)
    finally:
        S.SLICE = slices


@pytest.mark.parametrize("n,radius", [(10, 4), (1 << 25, 4), (10, 3), (10, 1), (10, 0)])
def test_every_near_pair_meets_in_a_segment(n, radius):
    rng = random.Random(n + radius)
    plan = S.segment_plan(n, radius)
    assert sum(w for _, w, _ in plan) == 64
    for _ in range(2000):
        flips = rng.sample(range(64), radius)
        assert any(r >= 0 and sum(s <= f < s + w for f in flips) <= r for s, w, r in plan)


def planted(rng, groups, size, flips):
    found = set()
    for _ in range(groups):
        base = rng.getrandbits(64)
        for _ in range(size):
            x = base
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            found.add(x)
    return [int(np.uint64(x).view(np.int64)) for x in found]


@pytest.mark.parametrize("bucket,block", [(64, 4096), (1, 4096), (1, 7), (10**9, 1)])
def test_classes_do_not_depend_on_the_way_a_bucket_takes(spark, monkeypatch, bucket, block):
    rng = random.Random(5)
    fps = [0, -1, *planted(rng, 6, 60, 5)]
    monkeypatch.setattr(S, "BUCKET", bucket)
    monkeypatch.setattr(S, "BLOCK", block)
    rows = spark.createDataFrame(list(enumerate(fps)), "doc_id long, fp long")
    got = {(r.doc_id, r.doc_id): r.component_id for r in rows.join(S.simhash_classes(rows), "fp").collect()}
    assert got == classes(list(enumerate(fps)), lambda a, b: (a ^ b).bit_count() <= 4 if (a < 0) == (b < 0) else ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)


def test_stars_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    links = [(order[k], order[k + 1]) for k in range(n - 1)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = {r.a: r.b for r in components.stars(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(1, n)}, 1001: 1000}
    assert components.stars(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_query_and_stage_over_edge_cases(spark, tables):
    rng = random.Random(8)
    base = words(rng, 400)
    near = base.copy()
    near[200] = "changed"
    rows = [
        (7, " ".join(base)), (9, " ".join(near)), (3, None), (4, ""), (5, " "), (6, "alone here"), (6, "alone here"), (None, " ".join(base)),
        (None, "no id at all"), (8, " ".join(words(rng, 200_000))), (11, " ".join(base).upper()),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' as source", "'xx' as lang", "1 as fp", "2 as root", "3 as id")
    got = S.op7_simhash(spark, tables(documents=docs)).collect()
    assert len(got) == len(rows)
    fps = {(r.doc_id, r.fingerprint) for r in got}
    assert fps == {(i, f"{plain_fingerprint(t):016x}") for i, t in rows}
    ids = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    zero = "0" * 16
    assert ids[(3, zero)] == ids[(4, zero)] == ids[(5, zero)] == 3
    for i, t in ((7, base), (11, base)):
        assert ids[(i, f"{plain_fingerprint(' '.join(t)):016x}")] == 7
    kept = S.simhash_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == [-1, 3, 6, 7, 8]
    empty = docs.limit(0)
    assert S.op7_simhash(spark, tables(documents=empty)).count() == 0 and S.simhash_stage(spark, empty, "").count() == 0


# --- passages ----------------------------------------------------------------


def test_windows_are_the_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(4)
    for n in (1, 5, 8, 9, 40, 200):
        shingles = rng.integers(0, 1 << 62, n).astype(np.uint64)
        for length in (1, 3, 8):
            values = P._mixed(shingles, P.SEEDS[1])
            nodes = []

            def split(lo, hi):
                if hi - lo + 1 >= length:
                    c = lo + int(np.argmin(values[lo : hi + 1] & ~np.uint64((1 << 20) - 1)))
                    nodes.append((c, max(lo, c - length + 1), min(c, hi - length + 1)))
                    split(lo, c - 1)
                    split(c + 1, hi)

            split(0, n - 1)
            key, at, first, last = P.compact_windows(shingles, length, 1)
            assert sorted(zip(at.tolist(), first.tolist(), last.tolist())) == sorted(nodes)
            assert (shingles[at] == key).all()


def test_long_sequences_are_worked_on_in_parts(monkeypatch):
    shingles = np.random.default_rng(1).integers(0, 1 << 62, 3000).astype(np.uint64)
    whole = P.compact_windows(shingles, 46, 0)
    monkeypatch.setattr(P, "POSITION_BITS", 10)
    parts = P.compact_windows(shingles, 46, 0)
    starts = lambda w: {a: k for k, _, lo, hi in zip(*w) for a in range(lo, hi + 1)}
    assert starts(parts).keys() == starts(whole).keys() == set(range(3000 - 45))
    assert np.mean([starts(parts)[a] == starts(whole)[a] for a in starts(whole)]) > 0.99


def test_shared_passages_are_found_and_clean_texts_are_not(spark, tables):
    rng = random.Random(12)
    passages = [words(rng, n) for n in (51, 60, 90, 150)]
    rows, sharing = [], {}
    for k in range(120):
        text = words(rng, rng.randint(60, 200))
        if k < 60:
            own = passages[k % 4].copy()
            if k % 4 == 3 and k % 8 == 3:
                own[75] = "edited"
            at = rng.randint(0, len(text))
            text[at:at] = own
            sharing[k] = (at, len(own))
        rows.append((k, " ".join(text)))
    rows += [(500, None), (501, ""), (502, "few words"), (None, rows[0][1]), (0, rows[0][1]), (503, "same " * 4000), (504, "same " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as first", "3 as start")
    got = P.op4_substring_dedup(spark, tables(documents=docs)).collect()
    found = {}
    for r in got:
        found.setdefault(r.doc_id, []).append((r.start_word, r.n_words, r.least_doc_id))
    assert set(found) == {*sharing, 503, 504}
    for k, (at, n) in sharing.items():
        spans = found[k]
        assert any(s < at + n and at < s + m for s, m, _ in spans), k
        assert all(s >= at - 12 and s + m <= at + n + 12 for s, m, _ in spans), k
        assert min(least for _, _, least in spans) <= k
    links, _ = P.repeated_passages(docs)
    assert links.where("a = b or similarity < 0.8").count() == 0
    # Each passage's documents hang together.
    groups = {}
    for r in components.stars(links.select("a", "b")).collect():
        groups[r.a] = r.b
    assert all(groups.get(k, k) == k % 4 for k in sharing)
    assert P.op4_substring_dedup(spark, tables(documents=docs.limit(0))).count() == 0


def brute_starts(texts, length=46):
    """(document, start) that has a passage at another document's same or any shift of at least 0.8."""
    found = set()
    shingles = {k: P.shingle_hashes(t).tolist() for k, t in texts.items()}
    for a, x in shingles.items():
        for b, y in shingles.items():
            if a >= b:
                continue
            sets = [set(y[k : k + length]) for k in range(len(y) - length + 1)]
            for p in range(len(x) - length + 1):
                mine = set(x[p : p + length])
                for q, theirs in enumerate(sets):
                    shared = len(mine & theirs)
                    if shared * 1.8 >= 0.8 * (len(mine) + len(theirs)):
                        found |= {(a, p), (b, q)}
    return found


@pytest.mark.parametrize("n,edits", [(51, 0), (51, 1), (55, 1), (60, 1)])
def test_short_passages_with_an_edit_against_brute_force(spark, n, edits):
    rng = random.Random(n + edits)
    rows, sought = [], set()
    for k in range(60):
        passage = words(rng, n)
        both = []
        for doc in (2 * k, 2 * k + 1):
            own = passage.copy()
            if edits and doc % 2:
                own[rng.randrange(n)] = "edited"
            both.append((doc, " ".join(words(rng, rng.randint(20, 60)) + own + words(rng, rng.randint(20, 60)))))
        rows += both
        sought |= {d for d, _ in brute_starts(dict(both))}
    _, passages = P.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id for r in passages.collect()}
    assert got <= sought and len(got) >= 0.99 * len(sought) and len(sought) > 80


@pytest.mark.parametrize("bucket,block", [(64, 2048), (1, 2048), (1, 7)])
def test_every_edited_copy_finds_its_partner_among_hubs(spark, monkeypatch, bucket, block):
    """Texts that share a short phrase, of which only some are near copies of each other."""
    monkeypatch.setattr(P, "BUCKET", bucket)
    monkeypatch.setattr(P, "BLOCK", block)
    rng = random.Random(3)
    phrase, texts = words(rng, 12), {}
    for k in range(30):
        around = words(rng, 34), words(rng, 34)
        for copy in range(1 + (k % 3 == 0)):
            text = around[0] + phrase + around[1]
            text[3 if copy else 75] = "edited"
            texts[len(texts)] = " ".join(text)
    texts[100] = " ".join([*texts[0].split(), *words(rng, 60), *texts[0].split()])
    sought = brute_starts(texts)
    links, passages = P.repeated_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    spans = [(r.doc_id, r.start_word, r.n_words) for r in passages.collect()]
    covered = {(d, s) for d, at, n in spans for s in range(at, at + n - 49)}
    assert {d for d, _ in sought} == {d for d, _ in covered}
    # Brute force also takes passages laid over each other at another shift than their shared shingles have, at the texts' ends.
    assert len(covered & sought) >= 0.97 * len(sought)
    assert {d for d, at, _ in spans if d == 100 and at > 90} == {100}
    assert all(r.similarity >= 0.8 and r.a < r.b for r in links.collect())


def test_passages_do_not_depend_on_the_way_a_group_takes(spark, monkeypatch):
    rng = random.Random(17)
    phrase, base, texts = words(rng, 12), words(rng, 110), {}
    for k in range(40):
        text = [*words(rng, 40), *phrase, *words(rng, 40)] if k % 4 == 0 else base.copy()
        for _ in range(k % 3):
            text[rng.randrange(len(text))] = "edited"
        texts[k] = " ".join([*text, *(["again and again"] * 60 if k % 9 == 0 else [])])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    results = []
    for bucket, block in ((10**6, 2048), (8, 2048), (1, 5)):
        monkeypatch.setattr(P, "BUCKET", bucket)
        monkeypatch.setattr(P, "BLOCK", block)
        results.append(sorted(map(tuple, P.repeated_passages(docs)[1].collect())))
    assert results[0] and results[0] == results[1] == results[2]


def test_similarities_of_all_starts_against_sets():
    rng = np.random.default_rng(9)
    for alphabet in (6, 30, 10**6):
        length, rows = 8, []
        base = rng.integers(0, alphabet, 15)
        for _ in range(12):
            row = base.copy()
            row[rng.integers(0, 15, 2)] = rng.integers(0, alphabet, 2)
            lo, hi = sorted(rng.integers(0, length, 2))
            rows.append((row[lo : hi + length], lo - length + 1, hi - length + 1))
        s = P.Slices(np.concatenate([r for r, _, _ in rows]), np.array([len(r) for r, _, _ in rows]), np.array([b for _, b, _ in rows]), np.array([a for _, _, a in rows]), length, 0.5)
        i, j = map(np.array, zip(*[(i, j) for i in range(12) for j in range(i)]))
        found, ratio = s.similarities(i, j)
        got = {(int(i[f]), int(j[f]), at): r for f, row in zip(found, ratio) for at, r in enumerate(row) if r}
        want = {}
        for a, b in zip(i.tolist(), j.tolist()):
            for at in range(length):
                x, y = (set(rows[k][0][at - rows[k][1] - length + 1 :][:length].tolist()) if rows[k][1] <= at - length + 1 <= rows[k][2] else set() for k in (a, b))
                if x and y and len(x & y) / len(x | y) >= 0.5:
                    want[(a, b, at)] = len(x & y) / len(x | y)
        assert got == pytest.approx(want) and want


def test_a_shared_phrase_alone_is_no_reason_to_compare(monkeypatch):
    """Repetitive texts with one shingle in common, each with one near copy."""
    n, length, compared = 600, 46, []
    values = [np.resize([0, *(100 * (k // 2) + j for j in range(1, 9)), 100_000 + k], length) for k in range(n)]
    zeros = np.zeros(n, np.int64)
    slices = P.Slices(np.concatenate(values).astype(np.int32), np.full(n, length), zeros, zeros, length, 0.8)
    ratio = P.Slices.ratio
    monkeypatch.setattr(P.Slices, "ratio", lambda self, shared, x, y, hope: compared.append(len(y)) or ratio(self, shared, x, y, hope))
    links = list(P._forest(slices, np.arange(n), zeros, False, lambda x, y: np.ones(len(y), bool)))
    found = {(int(a), int(b)) for x, y, _ in links for a, b in zip(x, y)}
    assert found == {(k, k + 1) for k in range(0, n, 2)}
    assert sum(compared) <= 2 * n


def test_partners_are_never_left_out():
    rng = np.random.default_rng(5)
    for alphabet in (4, 12, 40):
        length, n = 12, 60
        base = rng.integers(0, alphabet, (6, 2 * length - 1))
        values = base[rng.integers(0, 6, n)]
        values[rng.random(values.shape) < 0.06] = alphabet + 1
        before, after = -rng.integers(0, length, n), np.zeros(n, np.int64)
        rows = [v[length - 1 + b : 2 * length - 1] for v, b in zip(values, before)]
        slices = P.Slices(np.concatenate(rows).astype(np.int32), np.array([len(r) for r in rows]), before, after, length, 0.6)
        i, j = map(np.array, zip(*[(i, j) for j in range(n) for i in range(j)]))
        near = {(int(i[k]), int(j[k])) for k in slices.similarities(i, j)[0]}
        tried = {(int(k), int(o)) for k, other in P._partners(slices, np.arange(n)) for o in other}
        assert near and near <= tried


def test_hashes_of_many_texts_are_those_of_each(monkeypatch):
    rng = random.Random(6)
    texts = [None, "", " \n", "a b c d e", "\x0b A b\tc\r\n d  e f\x0c", "a\x1cb c d e f g", "\xa0 Ä ä İ x \U0001f600 y z", " ".join(words(rng, 300)), "same " * 50]
    for size in (1, 40, 1 << 23):
        monkeypatch.setattr(P, "TEXT_BYTES", size)
        got = list(P.text_hashes(pa.array(["cut off", *texts, *texts]).slice(1)))
        assert [k for k, _ in got] == list(range(2 * len(texts)))
        assert all(np.array_equal(h, P.shingle_hashes(t)) for (_, h), t in zip(got, texts + texts))
    assert list(P.text_hashes(pa.array([], pa.string()))) == []


def edited_copies(n, length):
    """Slices of rows of which many are near each other, some with repeated values."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 40, (9, 2 * length - 1))
    values = base[rng.integers(0, 9, n)]
    values[rng.random(values.shape) < 0.05] = 41
    before, after = -rng.integers(0, length, n), rng.integers(0, 3, n) * 0
    rows = [v[length - 1 + b : 2 * length - 1] for v, b in zip(values, before)]
    return P.Slices(np.concatenate(rows).astype(np.int32), np.array([len(r) for r in rows]), before, after, length, 0.7)


def test_links_of_a_large_group_do_not_depend_on_its_batches(monkeypatch):
    n, length, results = 200, 12, []
    for cross in (False, True):
        for tried, cells, holders in ((1, 1, 1), (50, 1 << 20, 100), (1 << 11, 1 << 20, 1 << 18)):
            for name, value in (("TRIED", tried), ("CELLS", cells), ("HOLDERS", holders)):
                monkeypatch.setattr(P, name, value)
            links = list(P._forest(edited_copies(n, length), np.arange(n), np.arange(n) % 2, cross, lambda x, y: np.ones(len(y), bool)))
            results.append([np.concatenate(x).tolist() for x in zip(*links)])
        assert results[-1][0] and results[-3] == results[-2] == results[-1]
    assert results[0] != results[3] and all((x - y) % 2 for x, y in zip(*results[3][:2]))


def test_rows_of_a_large_group_are_compared_in_batches(monkeypatch):
    calls, ratio = [], P.Slices.ratio
    monkeypatch.setattr(P.Slices, "ratio", lambda self, shared, x, y, hope: calls.append(len(y)) or ratio(self, shared, x, y, hope))
    slices = edited_copies(200, 12)
    assert list(P._forest(slices, np.arange(200), np.zeros(200, int), False, lambda x, y: np.ones(len(y), bool)))
    assert len(calls) <= 20


def test_some_rows_of_slices_are_as_made_of_them_alone():
    slices, kept = edited_copies(40, 12), np.array([3, 4, 9, 30])
    some = slices.taken(kept)
    i, j = map(np.array, zip(*[(i, j) for j in range(4) for i in range(j)]))
    for a, b in zip(some.similarities(i, j), slices.similarities(kept[i], kept[j])):
        assert np.array_equal(a, b)
    assert some.run_row.max() == 3 and len(some.run_row) == np.isin(slices.run_row, kept).sum()


def test_probes_are_never_broadcast(spark):
    """A fingerprint gives dozens of probes, which the planner takes for as small as the fingerprints."""
    nodes = spark.range(2000).selectExpr("xxhash64(id) as fp")
    plan = S.near_links(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
