import random
import time

from pyspark.sql import functions as F
from trees import by_sql, sentence

from tidings.functions.binding import let
from tidings.operators import plugins, relations as R

SCHEMA = f"id int, tokens {plugins.TOKENS}, ents {plugins.ENTS}"


def run(spark, cases):
    rows = [(k, t, e) for k, (t, e) in enumerate(cases)]
    df = R.with_relations(spark.createDataFrame(rows, SCHEMA)).orderBy("id")
    return [(r.who, r.trigger, r.what, r.where, r.when) for r in df.collect()]


ATTACK = sentence(
    ("Napastnik", "napastnik", "NOUN", "nsubj", 1),
    ("pobił", "pobić", "VERB", "ROOT", 1, "", "Fin"),
    ("ochroniarza", "ochroniarz", "NOUN", "obj", 1),
    ("przed", "przed", "ADP", "case", 4),
    ("klubem", "klub", "NOUN", "obl", 1),
    (".", ".", "PUNCT", "punct", 1),
)
CRASH = sentence(
    ("Samochód", "samochód", "NOUN", "nsubj", 1),
    ("uderzył", "uderzyć", "VERB", "ROOT", 1, "", "Fin"),
    ("w", "w", "ADP", "case", 3),
    ("drzewo", "drzewo", "NOUN", "obl:arg", 1),
    ("w", "w", "ADP", "case", 5),
    ("lesie", "las", "NOUN", "obl", 1),
    (".", ".", "PUNCT", "punct", 1),
)
FIRE = sentence(
    ("Pożar", "pożar", "NOUN", "nsubj", 1),
    ("zniszczył", "zniszczyć", "VERB", "ROOT", 1, "", "Fin"),
    ("towar", "towar", "NOUN", "obj", 1),
    ("w", "w", "ADP", "case", 4),
    ("Poznaniu", "Poznań", "PROPN", "obl", 1),
)
EXPERTS = sentence(
    ("Eksperci", "ekspert", "NOUN", "nsubj", 1),
    ("komentują", "komentować", "VERB", "ROOT", 1, "", "Fin"),
    ("sytuację", "sytuacja", "NOUN", "obj", 1),
    ("gospodarczą", "gospodarczy", "ADJ", "amod", 2),
)
INFLATION = sentence(
    ("Inflacja", "inflacja", "NOUN", "nsubj", 3),
    ("w", "w", "ADP", "case", 2),
    ("Holandii", "Holandia", "PROPN", "nmod", 0, "placeName"),
    ("przekroczyła", "przekroczyć", "VERB", "ROOT", 3, "", "Fin"),
    ("10", "10", "NUM", "nummod", 5),
    ("proc", "procent", "NOUN", "obj", 3),
)
DASH = sentence(
    ("Ceny", "cena", "NOUN", "nsubj", 1),
    ("wzrosły", "wzrosnąć", "VERB", "ROOT", 1, "", "Fin"),
    ("–", "–", "PUNCT", "punct", 1),
    ("poinformował", "poinformować", "VERB", "parataxis", 1, "", "Fin"),
    ("GUS", "GUS", "PROPN", "nsubj", 3),
)
AUX = sentence(
    ("Wyrok", "wyrok", "NOUN", "nsubj", 1),
    ("został", "zostać", "AUX", "ROOT", 1, "", "Fin"),
    ("utrzymany", "utrzymać", "VERB", "xcomp", 1),
    ("dziś", "dziś", "ADV", "advmod", 1),
)
TIMES = sentence(
    ("Rada", "rada", "NOUN", "nsubj", 1),
    ("obraduje", "obradować", "VERB", "ROOT", 1, "", "Fin"),
    ("w", "w", "ADP", "case", 3),
    ("poniedziałek", "poniedziałek", "NOUN", "obl", 1),
    ("w", "w", "ADP", "case", 5),
    ("maju", "maj", "NOUN", "obl", 1),
)
TWO_SUBJECTS = sentence(
    ("Las", "las", "NOUN", "nsubj", 1),
    ("płonie", "płonąć", "VERB", "ROOT", 1, "", "Fin"),
    ("strażacy", "strażak", "NOUN", "nsubj", 1),
)
ADJECTIVE = sentence(
    ("Piękny", "piękny", "ADJ", "ROOT", 0),
    ("w", "w", "ADP", "case", 2),
    ("Gdyni", "Gdynia", "PROPN", "obl", 0, "placeName"),
    ("jutro", "jutro", "ADV", "advmod", 0),
)


def test_hand_made_sentences(spark):
    cases = {
        "attack": (ATTACK, []),
        "crash": (CRASH, []),
        "fire": (FIRE, []),
        "experts": (EXPERTS, []),
        "inflation": (INFLATION, [(2, 3, "placeName")]),
        "dash": (DASH, []),
        "aux": (AUX, []),
        "times": (TIMES, []),
        "two subjects": (TWO_SUBJECTS, []),
        "no trigger": (ADJECTIVE, [(2, 3, "placeName")]),
    }
    got = dict(zip(cases, run(spark, cases.values())))
    assert got == {
        "attack": ("Napastnik", "pobić", "ochroniarza", "przed klubem", None),
        "crash": ("Samochód", "uderzyć", "w drzewo", "w lesie", None),
        "fire": ("Pożar", "zniszczyć", "towar", "w Poznaniu", None),
        "experts": ("Eksperci", "komentować", "sytuację gospodarczą", None, None),
        "inflation": ("w Holandii", "przekroczyć", "Inflacja w Holandii", "w Holandii", None),
        "dash": ("GUS", "poinformować", "GUS", None, None),
        "aux": (None, "utrzymać", None, None, "dziś"),
        "times": ("Rada", "obradować", "w maju", None, "w poniedziałek"),
        # The last subject speaks, the first one makes it a place, the swap repeats it.
        "two subjects": ("strażacy", "płonąć", "strażacy", "strażacy", None),
        # The preposition within two words to the left belongs to the place.
        "no trigger": (None, None, None, "w Gdyni", "w Gdyni jutro"),
    }
    assert list(got.values()) == by_sql(list(cases.values()))


def random_tree(rng):
    n = rng.randint(1, 14)
    order = list(range(n))
    rng.shuffle(order)
    heads = {order[0]: order[0]}
    for k, node in enumerate(order[1:], 1):
        heads[node] = order[rng.randrange(max(0, k - 3), k)]
    lemmas = ["las", "Środa", "maj", "w", "na", "po", "klub", "rok", "5 proc", "Anna", "10", "dom"]
    texts = lemmas + ["–", "dziś", "Jutro", "%"]
    pos = ["NOUN", "PROPN", "VERB", "AUX", "ADP", "ADJ", "PUNCT", "NUM", "CCONJ"]
    deps = ["nsubj", "nsubj:pass", "obj", "iobj", "obl", "obl:arg", "nmod", "xcomp", "ccomp", "acl", "case", "amod"]
    labels = ["", "", "", "persName", "placeName", "date", "LOC"]
    tokens = [
        (
            i,
            rng.choice(texts),
            rng.choice([" ", ""]),
            rng.choice(lemmas),
            rng.choice(pos),
            "ROOT" if heads[i] == i else rng.choice(deps),
            heads[i],
            rng.choice(labels),
            rng.choice(["Fin", ""]),
        )
        for i in range(n)
    ]
    ents = [(t[0], min(t[0] + rng.randint(1, 2), n), t[7]) for t in tokens if t[7]]
    return tokens, ents


def test_random_trees_match_the_sql(spark):
    rng = random.Random(7)
    cases = [random_tree(rng) for _ in range(1500)]
    got = run(spark, cases)
    wrong = [(c, g, w) for c, g, w in zip(cases, got, by_sql(cases)) if g != w]
    assert not wrong, wrong[0]


def test_subtrees_of_a_very_deep_chain(spark):
    n = 20_000
    chain = [(i, "x", " ", "x", "PROPN" if i % 1000 == 999 else "NOUN", "ROOT" if i == 0 else "nmod", max(i - 1, 0), "", "") for i in range(n)]
    df = spark.createDataFrame([(0, chain, [])], SCHEMA)
    tree = df.select(R.measure_tree(F.col("tokens")).alias("m")).first().m
    assert [(m.enter, m.size) for m in tree.spans] == [(i, n - i) for i in range(n)]
    assert tree.name == list(range(999, n, 1000))
    phrase = df.select(let(R.measure_tree(F.col("tokens")), lambda m: R.full_phrase(F.col("tokens"), m, F.lit(n - 3))).alias("p"))
    assert phrase.first().p == "x x x"


def test_heads_outside_the_sentence_make_roots(spark):
    heads = [0, None, 9, -1, 2]
    tokens = [(i, "x", " ", "x", "NOUN", "dep", h, None, "") for i, h in enumerate(heads)]
    df = spark.createDataFrame([(0, tokens, [])], SCHEMA)
    tree = df.select(R.measure_tree(F.col("tokens")).alias("m")).first().m
    assert [m.size for m in tree.spans] == [1, 1, 2, 1, 1]


def test_empty_sentence(spark):
    assert run(spark, [([], [])]) == [(None, None, None, None, None)]


def star(n):
    return [(i, "x", " ", "Las" if i == n - 1 else "x", "NOUN", "ROOT" if i == 0 else "obl", 0, "date" if i % 2 else "", "") for i in range(n)]


def test_what_all_tokens_ask_for_grows_with_the_sentence(spark):
    """Rules per token look at their own subtree, not at the whole sentence: 40,000 tokens end within the timeout."""
    n = 40_000
    df = spark.createDataFrame([(0, star(n), [])], SCHEMA)
    tokens = F.col("tokens")
    began = time.monotonic()
    kids = df.select(F.transform(R.children_lists(tokens), lambda k: F.size(k)).alias("k")).first().k
    assert kids == [n - 1] + [0] * (n - 1)

    def judged(tree):
        return F.transform(tokens, lambda t: R.is_time(tree, t["i"]) | R.looks_like_location(tree, t["i"]))

    told = df.select(let(R.tree_spans(tokens), judged).alias("j")).first().j
    assert told == [True] + [bool(i % 2) or i == n - 1 for i in range(1, n)]
    found = df.select(let(R.tree_spans(tokens), lambda tree: R.full_phrases(tokens, tree)).alias("p")).first().p
    assert found == [" ".join(["x"] * n)] + ["x"] * (n - 1)
    assert time.monotonic() - began < 40


def test_circles_of_heads_are_roots(spark):
    tokens = [(i, "x", " ", "x", "NOUN", "dep", h, "", "") for i, h in enumerate([1, 0, 2, 2, 1])]
    df = spark.createDataFrame([(0, tokens, []), (1, None, None)], SCHEMA).orderBy("id")
    trees = [r.m.spans for r in df.select(R.measure_tree(F.col("tokens")).alias("m")).collect()]
    assert [m.size for m in trees[0]] == [1, 1, 2, 1, 1]
    assert trees[1] is None
