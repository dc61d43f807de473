"""Who, what, trigger, where and when of an annotated sentence.

Every rule is an expression over the arrays of one row, so the stage is a
narrow projection without any shuffle.

`tokens`: array of `(i, text, ws, lemma, pos, dep, head, ent_type, verb_form)`
in sentence order with `i` from 0; the root is its own head.
`ents`: array of `(start, end, label)` token intervals in sentence order.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tidings.functions import lexicon as L
from tidings.functions.binding import first, let
from tidings.functions.text import py_strip
from tidings.functions.trees import subtree_spans


def _no_text() -> Column:
    return F.lit(None).cast("string")


# --- tree navigation -------------------------------------------------------


def base_dep(token: Column) -> Column:
    """The relation without its subtype."""
    return F.substring_index(token["dep"], ":", 1)


def children(tokens: Column, head: Column) -> Column:
    """Dependents of the token at index `head`, in sentence order."""
    return F.filter(tokens, lambda t: (t["head"] == head) & (t["i"] != head))


def children_lists(tokens: Column) -> Column:
    """The dependents' indices of every token, in sentence order; one sort serves all heads.

    Sorted by (head, child), a token's own entry (no child) stands before its children's.
    """
    step = 1 << 32
    own = F.transform(tokens, lambda t: t["i"].cast("bigint") * step)
    inside = F.filter(tokens, lambda t: (t["head"] != t["i"]) & t["head"].between(0, F.size(tokens) - 1))
    below = F.transform(inside, lambda t: t["head"].cast("bigint") * step + t["i"] + 1)

    def cut(entries: Column) -> Column:
        marked = F.transform(entries, lambda e, p: F.when(e % step == 0, p))
        places = F.concat(F.filter(marked, lambda p: p.isNotNull()), F.array(F.size(entries)))
        return let(
            places,
            lambda at: F.transform(
                tokens,
                lambda t, k: F.transform(
                    F.slice(entries, F.get(at, k) + 2, F.get(at, k + 1) - F.get(at, k) - 1), lambda e: (e % step - 1).cast("int")
                ),
            ),
        )

    return let(F.array_sort(F.concat(own, below)), cut)


# What a token may be marked as; the bits of `functions/trees.py`.
_MARKS = {
    "time": lambda t: t["ent_type"].isin(*L.TIME_ENTITIES) | time_word(t) | calendar_lemma(t),
    "place": lambda t: t["ent_type"].isin(*L.LOCATION_ENTITIES) | F.lower(t["lemma"]).isin(*L.PLACE_LEMMAS),
    "name": lambda t: t["pos"] == "PROPN",
    "preposition": lambda t: ((t["pos"] == "ADP") | (base_dep(t) == "case"))
    & F.lower(t["lemma"]).isin(*L.LOCATION_PREPOSITIONS),
}
_BITS = {mark: 1 << k for k, mark in enumerate(_MARKS)}


def tree_spans(tokens: Column) -> Column:
    """Struct of the tokens' places in the tree, all that the rules ask for.

    `spans`: per token `enter`, its place in pre-order, `size` of its subtree,
    whose tokens are those with the `size` places from `enter` on, `marks`, bits
    for what the subtree holds, and `at`: the token at the place of this number.
    """

    def bits(t: Column) -> Column:
        total = F.lit(0)
        for mark, rule in _MARKS.items():
            total = total + F.when(rule(t), F.lit(_BITS[mark])).otherwise(F.lit(0))
        return total

    return F.struct(subtree_spans(tokens["head"], F.transform(tokens, bits)).alias("spans"))


def measure_tree(tokens: Column) -> Column:
    """As `tree_spans`, with the places of tokens that have a mark: `time`, `place`, `name`, `preposition`."""

    def places(spans: Column, rule) -> Column:
        return F.transform(F.filter(tokens, rule), lambda t: F.get(spans, t["i"])["enter"])

    return let(
        tree_spans(tokens)["spans"],
        lambda spans: F.struct(spans.alias("spans"), *[places(spans, rule).alias(mark) for mark, rule in _MARKS.items()]),
    )


def _subtree_indices(tree: Column, index: Column) -> Column:
    """The token at `index` and all its descendants, in sentence order; the work is the subtree's."""
    return let(
        F.get(tree["spans"], index),
        lambda top: F.array_sort(F.transform(F.slice(tree["spans"], top["enter"] + 1, top["size"]), lambda m: m["at"])),
    )


def subtree(tokens: Column, tree: Column, index: Column) -> Column:
    """The token at `index` with all its descendants."""
    return F.transform(_subtree_indices(tree, index), lambda i: F.get(tokens, i))


def joined_text(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: F.concat(t["text"], t["ws"])), "")


def full_phrase(tokens: Column, tree: Column, index: Column) -> Column:
    """Text of the subtree at `index`; null when `index` is null."""
    return F.when(index.isNotNull(), py_strip(joined_text(subtree(tokens, tree, index))))


def full_phrases(tokens: Column, tree: Column) -> Column:
    """`full_phrase` of every token."""
    pieces = F.transform(tokens, lambda t: F.concat(t["text"], t["ws"]))

    def phrases(texts: Column) -> Column:
        def phrase(_t: Column, i: Column) -> Column:
            parts = F.transform(_subtree_indices(tree, i), lambda k: F.get(texts, k))
            return py_strip(F.array_join(parts, ""))

        return F.transform(tokens, phrase)

    return let(pieces, phrases)


def span_text(tokens: Column, start: Column, end: Column) -> Column:
    """Text of the tokens in [start, end) without the last one's white space."""
    inner = F.slice(tokens, start + 1, F.greatest(end - start - 1, F.lit(0)))
    return F.concat(joined_text(inner), F.get(tokens, end - 1)["text"])


def entity_texts(tokens: Column, ents: Column) -> Column:
    """Entities as `(label, text)`."""
    return F.transform(
        ents,
        lambda e: F.struct(
            e["label"].alias("label"), span_text(tokens, e["start"], e["end"]).alias("text")
        ),
    )


# --- time and place --------------------------------------------------------


def time_word(token: Column) -> Column:
    return F.lower(token["text"]).isin(*L.TIME_WORDS)


def calendar_lemma(token: Column) -> Column:
    return F.lower(token["lemma"]).isin(*L.DAY_LEMMAS, *L.MONTH_LEMMAS)


def governs(tree: Column, index: Column, mark: str) -> Column:
    """Whether the subtree at `index` has a token with the mark; null without index."""
    return F.get(tree["spans"], index)["marks"].bitwiseAND(F.lit(_BITS[mark])) != 0


def is_time(tree: Column, index: Column) -> Column:
    return F.when(index.isNotNull(), governs(tree, index, "time"))


def looks_like_location(tree: Column, index: Column) -> Column:
    """A place, or a proper noun behind a place preposition; never a time."""
    return F.when(
        index.isNotNull(),
        ~governs(tree, index, "time")
        & (
            governs(tree, index, "place")
            | (governs(tree, index, "name") & governs(tree, index, "preposition"))
        ),
    )


def with_preposition(tokens: Column, start: Column, prepositions: Iterable[str], reach: int) -> Column:
    """Start moved left to the nearest allowed preposition within reach.

    A boundary token between the two keeps the start where it is.
    """
    low = F.greatest(start - reach, F.lit(0))
    window = F.slice(tokens, low + 1, start - low)

    def last(condition) -> Column:
        return F.array_max(F.transform(F.filter(window, condition), lambda t: t["i"]))

    found = last(
        lambda t: (t["pos"] == "ADP") & F.lower(t["lemma"]).isin(*prepositions)
    )
    boundary = last(lambda t: t["pos"].isin(*L.BOUNDARY_POS))
    reached = found > F.coalesce(boundary, F.lit(-1))
    return F.when(F.coalesce(reached, F.lit(False)), found).otherwise(start)


# --- trigger ---------------------------------------------------------------


def _content_verb(tokens: Column, token: Column) -> Column:
    """An auxiliary gives way to its first verbal or adjectival complement."""
    complement = first(
        F.filter(
            children(tokens, token["i"]),
            lambda c: base_dep(c).isin("xcomp", "ccomp", "acl") & c["pos"].isin("VERB", "ADJ"),
        )
    )
    return F.when(token["pos"] == "AUX", F.coalesce(complement, token)).otherwise(token)


def trigger_after_dash(tokens: Column) -> Column:
    """First finite verb after the first dash."""
    dash = first(F.filter(tokens, lambda t: t["text"].isin(*L.DASHES)))["i"]
    finite = let(
        dash,
        lambda d: first(
            F.filter(
                tokens,
                lambda t: (t["i"] > d) & t["pos"].isin("VERB", "AUX") & (t["verb_form"] == "Fin"),
            )
        ),
    )
    return let(finite, lambda t: _content_verb(tokens, t))


def _root(tokens: Column) -> Column:
    return first(F.filter(tokens, lambda t: t["dep"] == "ROOT"))


def trigger_root_verb(tokens: Column) -> Column:
    return let(
        _root(tokens),
        lambda t: F.when(t["pos"].isin("VERB", "AUX"), _content_verb(tokens, t)),
    )


def trigger_first_verb(tokens: Column) -> Column:
    return first(F.filter(tokens, lambda t: t["pos"] == "VERB"))


def trigger_nominal_root(tokens: Column) -> Column:
    return let(_root(tokens), lambda t: F.when(t["pos"].isin("NOUN", "PROPN"), t))


def trigger_token(tokens: Column) -> Column:
    """The token the event hangs on; null when there is none."""
    return F.coalesce(
        trigger_after_dash(tokens),
        trigger_root_verb(tokens),
        trigger_first_verb(tokens),
        trigger_nominal_root(tokens),
    )


# --- arguments -------------------------------------------------------------


def argument_indices(tokens: Column, tree: Column, trigger: Column) -> Column:
    """Token indices of the trigger's arguments, each null when absent.

    The children are read once from left to right: the first time phrase is
    the when, the first place phrase the where, and the first object,
    complement, leftover oblique or plain modifier is the what.
    """

    def choose(kids: Column) -> Column:
        oblique = F.filter(kids, lambda c: base_dep(c) == "obl")
        when = first(F.filter(oblique, lambda c: is_time(tree, c["i"])))["i"]
        where = first(F.filter(oblique, lambda c: looks_like_location(tree, c["i"])))["i"]
        subjects = F.filter(kids, lambda c: base_dep(c) == "nsubj")
        return let(
            F.struct(when.alias("when"), where.alias("where")),
            lambda taken: F.struct(
                taken["when"].alias("when"),
                taken["where"].alias("where"),
                first(F.filter(kids, lambda c: _is_what(c, tree, taken)))["i"].alias("what"),
                first(subjects)["i"].alias("first_subject"),
                F.try_element_at(subjects, F.lit(-1))["i"].alias("subject"),
                F.try_element_at(subjects, F.lit(-1))["pos"].alias("subject_pos"),
            ),
        )

    return let(children(tokens, trigger["i"]), choose)


def _is_what(child: Column, tree: Column, taken: Column) -> Column:
    dep, i = base_dep(child), child["i"]
    leftover = ~i.eqNullSafe(taken["when"]) & ~i.eqNullSafe(taken["where"])
    plain = ~is_time(tree, i) & ~looks_like_location(tree, i)
    return (
        dep.isin("obj", "iobj", "xcomp", "ccomp")
        | ((dep == "obl") & leftover)
        | ((dep == "nmod") & plain)
    )


def fallback_where(tokens: Column, ents: Column, tree: Column) -> Column:
    """The latest location entity, a preceding preposition counting two places;
    without entities the first noun phrase that is a place with a preposition.
    """
    places = F.filter(ents, lambda e: e["label"].isin(*L.LOCATION_ENTITIES))
    scored = F.transform(
        places,
        lambda e: let(
            with_preposition(tokens, e["start"], L.LOCATION_PREPOSITIONS, 4),
            lambda start: F.struct(
                (e["start"] + F.when(start < e["start"], 2).otherwise(0)).alias("score"),
                (-e["start"]).alias("earlier"),
                start.alias("start"),
                e["end"].alias("end"),
            ),
        ),
    )
    by_entity = let(F.array_max(scored), lambda b: span_text(tokens, b["start"], b["end"]))
    noun = first(
        F.filter(
            tokens,
            lambda t: t["pos"].isin("NOUN", "PROPN")
            & looks_like_location(tree, t["i"])
            & governs(tree, t["i"], "preposition"),
        )
    )["i"]
    return F.coalesce(by_entity, let(noun, lambda i: full_phrase(tokens, tree, i)))


def fallback_when(tokens: Column, ents: Column) -> Column:
    """The first time entity, else the first time word or day/month name."""

    def from_span(start: Column, end: Column, reach: int) -> Column:
        return let(
            with_preposition(tokens, start, L.TIME_PREPOSITIONS, reach),
            lambda s: span_text(tokens, s, end),
        )

    times = F.filter(ents, lambda e: e["label"].isin(*L.TIME_ENTITIES))
    words = F.filter(tokens, lambda t: time_word(t) | calendar_lemma(t))
    return F.coalesce(
        let(first(times), lambda e: from_span(e["start"], e["end"], 4)),
        let(
            first(words),
            lambda t: F.when(time_word(t), from_span(t["i"], t["i"] + 1, 2)).otherwise(
                from_span(t["i"], t["i"] + 1, 3)
            ),
        ),
    )


def looks_numeric(text: Column) -> Column:
    """Contains a digit, `%` or `proc`."""
    return F.coalesce(
        text.rlike(r"[\p{Nd}²³¹⁰-⁹₀-₉]") | F.contains(text, F.lit("%"))
        | F.contains(F.lower(text), F.lit("proc")),
        F.lit(False),
    )


# --- the whole extraction --------------------------------------------------


def extract_relations(tokens: Column, ents: Column) -> Column:
    """Struct `who, trigger, what, where, when`; every field may be null."""

    def with_tree(tree: Column) -> Column:
        return let(
            F.struct(
                trigger_token(tokens).alias("trigger"),
                fallback_where(tokens, ents, tree).alias("where"),
                fallback_when(tokens, ents).alias("when"),
            ),
            lambda base: F.when(
                base["trigger"].isNull(),
                F.struct(
                    _no_text().alias("who"),
                    _no_text().alias("trigger"),
                    _no_text().alias("what"),
                    base["where"].alias("where"),
                    base["when"].alias("when"),
                ),
            ).otherwise(_from_trigger(tokens, ents, tree, base)),
        )

    return let(tree_spans(tokens), with_tree)


def _from_trigger(tokens, ents, tree, base) -> Column:
    person = first(F.filter(ents, lambda e: e["label"].isin(*L.PERSON_ENTITIES)))

    def phrases(found: Column) -> Column:
        subject_is_place = looks_like_location(tree, found["first_subject"])
        subject_is_time = is_time(tree, found["first_subject"])
        return F.struct(
            full_phrase(tokens, tree, found["subject"]).alias("subject"),
            found["subject_pos"].alias("subject_pos"),
            F.coalesce(subject_is_place, F.lit(False)).alias("subject_is_place"),
            F.coalesce(subject_is_time, F.lit(False)).alias("subject_is_time"),
            let(person, lambda e: span_text(tokens, e["start"], e["end"])).alias("person"),
            full_phrase(tokens, tree, found["what"]).alias("what"),
            F.coalesce(full_phrase(tokens, tree, found["where"]), base["where"]).alias("where"),
            F.coalesce(full_phrase(tokens, tree, found["when"]), base["when"]).alias("when"),
        )

    def settle(p: Column) -> Column:
        who = F.when(
            p["subject"].isNotNull(),
            F.when(p["person"].isNotNull() & (p["subject_pos"] != "PROPN"), p["person"]).otherwise(
                p["subject"]
            ),
        )
        where = F.coalesce(p["where"], F.when(p["subject_is_place"], p["subject"]))
        what = F.coalesce(
            p["what"],
            F.when(
                (p["subject"] != "") & ~p["subject_is_place"] & ~p["subject_is_time"], p["subject"]
            ),
        )
        return F.struct(who.alias("who"), what.alias("what"), where.alias("where"))

    def swap(p: Column) -> Column:
        return let(
            settle(p),
            lambda r: let(
                F.coalesce(
                    (p["subject"] != "")
                    & r["where"].isNotNull()
                    & (r["who"] == p["subject"])
                    & (p["subject_pos"] == "NOUN")
                    & (r["what"].isNull() | looks_numeric(r["what"])),
                    F.lit(False),
                ),
                lambda swapped: F.struct(
                    F.when(swapped, r["where"]).otherwise(r["who"]).alias("who"),
                    base["trigger"]["lemma"].alias("trigger"),
                    F.when(swapped, p["subject"]).otherwise(r["what"]).alias("what"),
                    r["where"].alias("where"),
                    p["when"].alias("when"),
                ),
            ),
        )

    return let(
        argument_indices(tokens, tree, base["trigger"]), lambda found: let(phrases(found), swap)
    )


def with_relations(df: DataFrame, tokens: str = "tokens", ents: str = "ents") -> DataFrame:
    """Add the five relation columns to annotated sentences."""
    return (
        df.withColumn("_relations", extract_relations(F.col(tokens), F.col(ents)))
        .withColumns({f: F.col(f"_relations.{f}") for f in L.FIELDS})
        .drop("_relations")
    )
