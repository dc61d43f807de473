import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidings.llm import decontamination as D, lm_scoring as M, mixing as X, sharding as H
from tidings.llm.common import is_remainder

WORD = r"[^\x20\x09-\x0D]+"


# --- mixing ------------------------------------------------------------------


def targets_of(sizes):
    """Water filling by hand: share, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=str) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, rest, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while open_ and rest > 1e-9:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if target[s] + level * weight[s] >= 2 * sizes[s]}
        if not full:
            for s in open_:
                target[s] += level * weight[s]
            break
        for s in full:
            rest -= 2 * sizes[s] - target[s]
            target[s] = 2.0 * sizes[s]
        open_ -= full
    return target


def mixed_docs(rng, n=400):
    rows = []
    for k in range(n):
        source = rng.choice(["hot"] * 6 + ["a", "b", "Ä", "tiny", None])
        rows.append((k, " ".join("w" * rng.randint(1, 3) for _ in range(1 if source == "tiny" else int(rng.lognormvariate(3, 1))))
                     , source))
    return rows


def test_mix_meets_its_targets(spark, tables):
    rng = random.Random(3)
    rows = mixed_docs(rng) + [(900, None, "a"), (901, "", "a"), (902, " \n", None), (5, "same id", "b"), (5, "same id", "b"), (None, "x y z", "b"), (903, "w " * 50_000, "long")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as key", "2 as size", "3 as rate", "4 as n")
    folder = tables(documents=docs)
    got = X.op8_entropy_mixing(spark, folder).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += len(re.findall(WORD, text or ""))
    want = targets_of(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(2, 0.01 * want[s]) or s == "long", (s, taken[s], want[s])
    again = X.op8_entropy_mixing(spark, folder).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    # The rates are exponential in the size, up to the cap.
    for s in sizes:
        own = [(r.size, math.log(r.rate)) for r in got if r.source == s and 0 < r.rate < 2 and r.size]
        slopes = [y / x for x, y in own]
        assert not own or max(slopes) - min(slopes) < 1e-6
    stage = X.mix_stage(spark, docs, "")
    assert stage.columns == docs.columns
    assert stage.where("text <> ''").groupBy().agg(F.sum(F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)))).first()[0] == sum(taken.values())
    assert X.op8_entropy_mixing(spark, tables(documents=docs.limit(0))).count() == 0
    blank = docs.where("doc_id in (900, 901)")
    assert X.op8_entropy_mixing(spark, tables(documents=blank)).count() == 2


# --- sharding ----------------------------------------------------------------


def test_shards_are_even_and_slots_have_no_gaps(spark, tables):
    rng = random.Random(6)
    rows = [(k, "é" * rng.randint(0, 400), rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "x"])) for k in range(2000)]
    rows += [(9000, None, None, None), (None, "no id", "en", "x"), (7, "again", "en", "x"), (7, "again", "en", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as shard", "2 as d0", "3 as tie")
    got = H.op9_kd_sharding(spark, tables(documents=docs)).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t, _, _ in rows)
    by = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None
        by[r.shard].append(r)
    assert sorted(by) == list(range(24))
    total = sum(r.size for r in got)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 24) < 5 * 808
    assert H.op9_kd_sharding(spark, tables(documents=docs.limit(0))).count() == 0


def test_shards_by_target_bytes_and_one_key(spark):
    same = spark.range(50).selectExpr("1L as doc_id", "'t' as text", "'en' as lang", "'s' as source")
    one = H.kd_shards(H.metadata_codes(same), shards=4).collect()
    assert len({r.shard for r in one}) == 1 and len(one) == 50
    docs = spark.range(1000).selectExpr("id as doc_id", "repeat('x', cast(id % 90 as int)) as text", "'en' as lang", "'s' as source")
    placed = H.kd_shards(H.metadata_codes(docs), target_bytes=6000).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert len(placed) == math.ceil(docs.selectExpr("sum(length(text) + 8)").first()[0] / 6000)
    assert all(r.b <= 6000 * 1.1 for r in placed)


def plain_tree(rows, shards):
    """The same rule on one sorted list per node. rows: (size, codes, tie)."""
    wide = [max(1, max(r[1][d] for r in rows) - min(r[1][d] for r in rows)) for d in range(4)]
    out = {}

    def cut(members, first, n):
        if n == 1 or not members:
            out.update((m, first) for m in members)
            return
        spans = [(max(rows[m][1][d] for m in members) - min(rows[m][1][d] for m in members)) / wide[d] for d in range(4)]
        dim = max(range(4), key=lambda d: (spans[d], -d))
        by = defaultdict(list)
        for m in members:
            by[rows[m][1][dim] * 65536 + rows[m][2]].append(m)
        total, left, before = sum(rows[m][0] for m in members), n // 2, 0
        goal = max(1, total * left // n)
        for key in sorted(by):
            upto = before + sum(rows[m][0] for m in by[key])
            if upto >= goal:
                break
            before = upto
        limit = key + (goal - before > upto - goal)
        cut([m for k, own in by.items() if k < limit for m in own], first, left)
        cut([m for k, own in by.items() if k >= limit for m in own], first + left, n - left)

    cut(list(range(len(rows))), 0, shards)
    return out


@pytest.mark.parametrize("shards", [7, 24, 200])
def test_tree_against_a_plain_one(spark, shards):
    rng = random.Random(shards)
    rows = [(k, "x" * int(rng.lognormvariate(4, 1)), rng.choice("abc"), rng.choice(["hot"] * 5 + ["x", None])) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = H.kd_shards(H.written(H.metadata_codes(docs, shards=shards), "codes"), shards=shards).collect()
    want = plain_tree([(r.size, (r.d0, r.d1, r.d2, r.d3), r.tie) for r in got], shards)
    assert [r.shard for r in got] == [want[k] for k in range(len(got))]


def test_equal_texts_stay_together_and_whole_rows_are_kept(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["aa", "b", "cc", "é"], k=rng.randint(5, 60))) for _ in range(400)]
    rows = [(k, texts[k % 400 if k < 1000 else 0], rng.choice("abc"), rng.choice("xyz"), k % 5, "old") for k in range(1500)]
    rows += [(2000, "long " * 40_000, "a", "x", 0, None), (2001, None, None, None, None, None), (7, texts[7], "a", "x", 0, "again"), (7, texts[7], "a", "x", 0, "again")]
    schema = "doc_id long, text string, lang string, source string, size long, slot string"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "doc_id as dim", "doc_id as doc", "1 as tie")
    got = H.shard_stage(spark, docs, "").collect()
    assert set(got[0].asDict()) == {*docs.columns, "shard"}
    assert Counter((r.doc_id, r.text, r.lang, r.source, r.size, r.dim, r.doc) for r in got) == Counter((*r[:5], r[0], r[0]) for r in rows)
    shards, total = defaultdict(set), Counter()
    for r in got:
        shards[r.text].add(r.shard)
        total[r.shard] += len((r.text or "").encode()) + 8
    assert all(len(own) == 1 for text, own in shards.items() if text != texts[0]) and len(shards[texts[0]]) > 3
    assert H.shard_stage(spark, docs.limit(0), "").count() == 0


# --- decontamination ---------------------------------------------------------


def test_templates_and_slots(spark, tables):
    item = "A farmer sells 12 apples to Anna and 15 pears to Peter for 30 dollars. How many fruits did Anna buy?"
    docs = spark.createDataFrame(
        [
            (1, "Well now. " + item), (2, "Intro, a farmer sells 77 apples to Maria and 91 pears to John Smith for 45 euros. How many fruits did Maria buy?"),
            (3, "A farmer sells 77 apples to Maria and 91 pears to John for 45 euros. How many fruits did John buy?"), (4, None), (5, ""),
            (6, item.upper()), (None, "x " + item), (1, "Well now. " + item), (7, "12 13 14 15 16 17 18 19 20"), (8, "word " * 200_000 + item),
            (9, "Nothing of that kind is sold by any farmer here."), (10, "five short words of text"),
        ],
        "doc_id long, text string",
    ).selectExpr("*", "1 as item_id", "2 as at", "3 as key", "4 as t")
    benchmark = spark.createDataFrame(
        [(7, item), (8, "five short words of text"), (9, None), (10, "12 13 14 15 16 17 18"), (11, "too short"), (7, item)], "item_id long, text string"
    )
    got = {(r.doc_id, r.item_id): r for r in D.op6_template_decontamination(spark, tables(documents=docs, benchmark=benchmark)).collect()}
    assert set(got) == {(1, 7), (2, 7), (6, 7), (None, 7), (8, 7), (10, 8), (7, 10)}
    assert got[(1, 7)].verbatim and got[(1, 7)].coverage == 1.0 and not got[(2, 7)].verbatim
    kept = D.decontamination_stage(spark, docs, tables(benchmark=benchmark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 9]
    for d, b in ((docs.limit(0), benchmark), (docs, benchmark.limit(0))):
        assert D.op6_template_decontamination(spark, tables(documents=d, benchmark=b)).count() == 0
    assert D.decontamination_stage(spark, docs, tables(benchmark=benchmark.limit(0))).count() == docs.count()


def test_items_of_every_kind_are_found(spark):
    items = [
        (1, "Who was Plato?"), (2, "Compute 12 + 7 - 3 * 5 + 9 / 4"), (None, "an item that has no id at all"),
        (4, "John has 12 apples. Mary gives John 5 apples. John eats 3 of them. How many apples does John have?"),
        (5, "What is the capital of France"), (6, "A crate holds 12 apples and 15 pears in the cellar of the old house by the lake"),
        (7, "一个农夫有十二个苹果"), (6, "quite another text under an id that was used before"),
    ]
    docs = {
        1: ("I asked: who was Plato? Nobody knew.", {1}), 2: ("now compute 12 + 7 - 3 * 5 + 9 / 4 please", {2}),
        3: ("this is an item that has no id at all ok", {None}),
        4: ("Peter has 30 apples. Susan gives Peter 8 apples. Peter eats 4 of them. How many apples does Peter have?", {4}),
        5: ("we walked home What is the capital of France and so on", {5}),
        6: ("A crate holds 20 apples and 20 pears in the cellar of the old house by the lake", {6}),
        7: ("他说一个农夫有十二个苹果吗", {7}), 8: ("Quite another text under an id that was used before.", {6}),
        # Every name stands for two: the slots contradict each other.
        9: ("Peter has 30 apples. Susan gives Anna 8 apples. Maria eats 4 of them. How many apples does Boris have?", set()),
        10: ("Abc " * 50_000, set()), 11: ("1," * 50_000 + "1", set()), 12: ("Plato was here, as who is not", set()), 13: (None, set()), 14: ("", set()),
    }
    frame = spark.createDataFrame([(k, t) for k, (t, _) in docs.items()], "doc_id long, text string")
    got = {k: set() for k in docs}
    for r in D.leaks(frame, spark.createDataFrame(items, "item_id long, text string")).collect():
        got[r.doc_id].add(r.item_id)
    assert got == {k: found for k, (_, found) in docs.items()}


def plain_leaks(docs, items, window, covered, agreeing):
    """All windows of all pairs, by the same token pattern."""
    import regex

    def readings(text):
        out = {}
        for family, names in ((D.TEMPLATE, True), (D.LITERAL, False)):
            pattern = D.SMALL + (D.NAMES if names else "") + D.PLAIN
            found = [m.group() for m in regex.finditer(pattern, (text or "") if names else (text or "").lower(), regex.V1)]
            kinds = []
            for t in found:
                if t[0] in " \t%$€£":
                    kinds.append("unit")
                elif names and regex.match(D.IS_NAME, t):
                    kinds.append("name")
                else:
                    kinds.append("number" if regex.fullmatch(r"\p{N}[\p{N}.,]*", t) else None)
            out[family] = [(t.lower().lstrip(" "), k) for t, k in zip(found, kinds)]
        return out

    results = set()
    for item_id, text in items:
        own = readings(text)
        for doc_id, doc in docs:
            other, best = readings(doc), 0.0
            for family, a in own.items():
                b, n = other[family], min(window, len(a))
                if not n:
                    continue
                shifts = defaultdict(list)
                for i in range(len(a) - n + 1):
                    for j in range(len(b) - n + 1):
                        x, y = a[i : i + n], b[j : j + n]
                        raw = family == D.LITERAL and [t for t, _ in x] == [t for t, _ in y]
                        form = sum(k is None for _, k in x) >= D.LEAST_WORDS and [k or t for t, k in x] == [k or t for t, k in y]
                        if raw or form:
                            shifts[j - i].append((i, raw, form))
                at = set()
                for shift, met in shifts.items():
                    places = {p for i, _, form in met if form for p in range(i, i + n) if a[p][1]}
                    by = defaultdict(Counter)
                    for p in places:
                        by[a[p][0]][b[p + shift][0]] += 1
                    sound = sum(max(c.values()) for c in by.values()) >= agreeing * len(places)
                    names = [c for v, c in by.items() if sum(c.values()) > 1 and any(a[p] == (v, "name") for p in places)]
                    sound &= sum(max(c.values()) for c in names) >= agreeing * sum(sum(c.values()) for c in names)
                    at |= {i for i, raw, form in met if raw or form and sound}
                best = max(best, len(at) / (len(a) - n + 1))
            if best >= covered:
                results.add((doc_id, item_id, round(best, 9)))
    return results


def test_leaks_against_all_pairs(spark):
    rng = random.Random(8)
    words = ["gives", "apples", "Anna", "Peter", "has", "12", "7", "3.5", " km", "$", "The", "of", "USA", "Ähre", "été", "中文"]

    def say(n):
        return " ".join(rng.choice(words) for _ in range(n)).replace("  ", " ")

    items = [(k if k % 7 else None, say(rng.choice([1, 2, 4, 6, 9, 14, 20]))) for k in range(40)] + [(99, None), (98, " .")]
    docs = []
    for k in range(60):
        text = rng.choice(items)[1] or ""
        if k % 3 == 0:
            text = text.replace("Anna", "Maria Curie").replace("12", rng.choice(["40", "7"])).replace("Peter", rng.choice(["Maria Curie", "Jo", "Paul"]))
        docs.append((k, f"{say(rng.randint(0, 9))}{rng.choice(['. ', ' ', chr(10)])}{text.upper() if k % 10 == 9 else text} {say(rng.randint(0, 9))}"))
    for window in (8, 3):
        found = D.leaks(
            spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=window
        ).collect()
        want = plain_leaks(docs, items, window, D.COVERED, D.AGREEING)
        best = {}
        for d, i, c in want:
            best[(d, i)] = max(c, best.get((d, i), 0))
        assert len(best) > 20
        assert {(r.doc_id, r.item_id): round(r.coverage, 9) for r in found} == best


def test_benchmark_join_gives_the_same_without_a_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"the {k} old men of town {k % 3} walked along the river in the morning light again") for k in range(20)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "The 4 old men of town 1 walked along the river in the morning light")], "item_id long, text string")
    one = sorted(map(tuple, D.leaks(docs, items).collect()))
    monkeypatch.setattr(D, "BROADCAST_BYTES", 0)
    assert one and sorted(map(tuple, D.leaks(docs, items).collect())) == one


# --- scoring -----------------------------------------------------------------


def plain_scores(rows):
    depth = M.DEPTH
    learn = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    framed = lambda t: bytes([M.END]) * depth + b" ".join(M.words_of(t)) + bytes([M.END])
    words, nodes = Counter(), [defaultdict(lambda: [0, 0]) for _ in range(depth + 1)]
    for t in learn:
        words.update([*M.words_of(t), M.END_TOKEN])
        x = framed(t)
        for i in range(depth, len(x)):
            for k in range(8):
                place, bit = 1 << k | x[i] >> 8 - k, x[i] >> 7 - k & 1
                for d in range(depth + 1):
                    nodes[d][(x[i - d : i], place)][bit] += 1
    pe, pw = [{} for _ in nodes], [{} for _ in nodes]
    for d in reversed(range(depth + 1)):
        kids = Counter()
        if d < depth:
            for (context, place), v in pw[d + 1].items():
                kids[(context[1:], place)] += v
        for key, (a, b) in nodes[d].items():
            pe[d][key] = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
            pw[d][key] = pe[d][key] if d == depth else math.log(0.5) + np.logaddexp(pe[d][key], kids[key])

    def one(x, i, place):
        p = None
        for d in reversed(range(depth + 1)):
            key = (x[i - d : i], place)
            if key in pe[d]:
                a, b = nodes[d][key]
                kt, stop = (b + 0.5) / (a + b + 1), 1 if d == depth else math.exp(math.log(0.5) + pe[d][key] - pw[d][key])
                p = kt if p is None else stop * kt + (1 - stop) * p
        return 0.5 if p is None else p

    out, total = [], sum(words.values())
    for i_, t in rows:
        x, score = framed(t), 0.0
        for i in range(depth, len(x)):
            for k in range(8):
                p = one(x, i, 1 << k | x[i] >> 8 - k)
                score += math.log10(p if x[i] >> 7 - k & 1 else 1 - p)
        own = [*M.words_of(t), M.END_TOKEN]
        out.append((i_, len(own), sum(words[w] > 0 for w in own), total, sum(math.log10((words[w] + 1) / (total + len(words) + 1)) for w in own), score))
    return out


@pytest.mark.parametrize("block", [400, 1 << 25])
def test_context_tree_against_a_plain_one(spark, tables, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK_BYTES", block)
    monkeypatch.setattr(M, "BUCKET_BYTES", block // 2)
    rng = random.Random(2)
    vocabulary = ["the", "of", "River", "stone", "étude", "a", "walked", "x1"]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 25)))) for k in range(30)]
    rows += [(100, None), (101, ""), (102, "unseen Zwölf!"), (None, "the stone"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as block", "2 as gram", "true as train")
    got = M.op10_context_tree_scoring(spark, tables(documents=docs)).collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    mine = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got), key=order)
    want = sorted(plain_scores(rows), key=order)
    assert [m[:4] for m in mine] == [w[:4] for w in want]
    np.testing.assert_allclose([m[4:] for m in mine], [w[4:] for w in want], rtol=1e-8)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got if r.doc_id is not None)


def test_scoring_of_no_rows_and_of_one_long_text(spark, tables):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.op10_context_tree_scoring(spark, tables(documents=empty)).count() == 0
    docs = spark.createDataFrame([(1, "to be or not to be " * 30_000), (2, "to be or not")], "doc_id long, text string")
    got = {r.doc_id: r for r in M.score_documents(docs, is_remainder(F.col("doc_id"), 7, 99)).collect()}
    assert got[1].n_tokens == 180_001 and got[1].score / got[1].n_tokens > -0.12  # two even choices in six words
    only_held = M.score_documents(docs, F.lit(True)).collect()
    assert {round(r.score / math.log10(0.5)) for r in only_held} == {8 * (len("to be or not to be " * 30_000)), 8 * 13}


# --- pipeline ----------------------------------------------------------------


def test_pipeline_from_stage_to_stage(spark, tables):
    import corpus_pipeline as pipeline

    rng = random.Random(1)
    say = lambda a, n: " ".join("".join(rng.choice(a) for _ in range(rng.randint(1, 4))) for _ in range(n))
    item = "seven old men of the town walked along the river in the morning light and sang songs"
    rows = [(k, say(["ka", "lo", "mi"] if k % 2 else ["sch", "ein", "ver"], 60), "xx" if k % 2 else "yy", f"s{k % 4}", 0) for k in range(120)]
    rows += [(500, rows[3][1], "xx", "s1", 0), (501, "!!! 123", "xx", "s0", 0), (502, None, None, None, None), (503, f"{rows[5][1]} {item} {say(['ka', 'lo'], 40)}", "xx", "s2", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = tables(documents=docs, benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))
    out = pipeline.run(spark, folder).collect()
    ids = Counter(r.doc_id for r in out)
    assert not set(ids) & {500, 501, 502, 503} and set(ids) <= set(range(120)) and max(ids.values()) <= 2
    frame = docs
    for name, stage in pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        assert frame.columns == docs.columns, name
    assert frame.count() == len(out)
    assert pipeline.run(spark, tables(documents=docs.limit(0), benchmark=spark.createDataFrame([(1, item)], "item_id long, text string"))).count() == 0
