import random
import re
from collections import Counter

import zstandard

from tidings.llm import quality_rules as Q

WORD = r"[^\x20\x09-\x0D]+"


def base(text):
    words = re.findall(WORD, text)
    grams = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def random_text(rng):
    return "".join(rng.choice(["a", "b", "cé", " ", " ", "\n", "\t", "#", "|", "\x0b", "\x1c", "\xa0", "dog cat ", "x y z\n"]) for _ in range(rng.randint(0, 120)))


def prose(rng, n):
    syllables = ["ka", "lo", "mi", "tur", "en", "sa", "vo", "pre", "di", "gan", "st", "or"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_statistics_against_brute_force():
    rng, z = random.Random(3), zstandard.ZstdCompressor(level=Q.LEVEL)
    for _ in range(400):
        text = random_text(rng)
        got = Q.judge(text, z)
        assert got[:5] == base(text), text
        assert got[5] == (got[0] < 50 or 100 * got[4] > 50 * got[0])


def test_bands_reject_repetitive_and_incompressible_text():
    rng, z = random.Random(5), zstandard.ZstdCompressor(level=Q.LEVEL)
    kept = lambda t: Q.judge(t, z)[6]
    for n in (60, 300, 1500, 8000):
        assert kept(prose(rng, n)), n
    assert not kept(" ".join(f"{k % 7} {k % 11} same words again" for k in range(600)))
    assert not kept(" ".join("".join(chr(rng.randint(33, 126)) for _ in range(12)) for _ in range(800)))
    # A clean start does not save a text whose chunks are noise.
    noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(12)) for _ in range(2000))
    assert not kept(prose(rng, 3000) + " " + noise)


def test_query_over_edge_cases(spark, tables):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, prose(random.Random(1), 400)), (4, prose(random.Random(1), 400)), (None, "a b c"), (5, "w " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as ratio", "2 as kept")
    got = Q.op5_quality_rules(spark, tables(documents=docs)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for k in (1, 2, 3):
        assert (by_id[k].n_words, by_id[k].base_failed, by_id[k].kept) == (0, True, False)
    assert by_id[4].kept and not by_id[5].kept and by_id[5].n_words == 300_000 and by_id[5].n_repeat_words == 300_000
    assert Q.op5_quality_rules(spark, tables(documents=docs.limit(0))).count() == 0
