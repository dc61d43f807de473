"""Benchmark decontamination by template canonicalisation.

A text is read twice. As a template, numbers, names and units are replaced by
typed placeholders, so that a copy of a question with other values gives the
same tokens; any capitalised word counts as a name, wherever it stands in a
sentence, and a run of them as one. As lower-case tokens, with numbers and
units as placeholders or as they are, texts are found whose letter case is
lost and passages of too few plain words for a template: short items and rows
of numbers are found as they are. Windows of tokens are hash-joined with those
of the benchmark. Where templates meet, the values behind the placeholders
must be consistent: in one alignment of a document and an item, a value of the
item mostly stands for the same value of the document.

Everything is a column expression; documents are read once and only their
matching windows are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidings.functions.binding import let
from tidings.llm.common import read
from tidings.session import written

WINDOW = 8
# A placeholder window needs so many plain words; others are compared as they are.
LEAST_WORDS = WINDOW // 2
# The share of an item's windows that a document must have, and of an alignment's slots that must agree.
COVERED = 0.5
AGREEING = 0.75
# The benchmark's windows are broadcast up to this size, joined by shuffle beyond it.
BROADCAST_BYTES = 128 << 20

UNITS = (
    "mm|cm|dm|m|km|mg|g|kg|ml|cl|l|ms|s|sec|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|inch|inches|feet|foot|"
    "yards?|pounds?|ounces?|tons?|dollars?|cents?|euros?|percent|degrees?|meters?|metres?|kilometers?|liters?|litres?|grams?"
)
# Possessive repetition throughout: Java runs it as a loop, whatever the length. A unit keeps the blank before it, which tells
# it from words. Scripts without blanks give a token per character. Words of small ASCII letters are tried first, as they are
# most and their class is the cheapest.
_CAPITAL = r"\p{Lu}\p{Ll}++(?![\p{L}\p{M}\p{N}_])"
SMALL = r"[a-z]++(?![\p{L}\p{M}\p{N}_])|"
NAMES = rf"{_CAPITAL}(?:[ \t]{_CAPITAL})*+|"
PLAIN = (
    rf"(?<=\p{{N}})[ \t](?i:{UNITS})(?![\p{{L}}\p{{M}}\p{{N}}_])"
    r"|\p{N}++(?:[.,]\p{N}++)*+(?![\p{L}\p{M}\p{N}_])"
    r"|[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]"
    r"|[\p{L}\p{M}\p{N}_&&[^\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]]++"
    r"|[%$€£]"
)
IS_NAME = rf"^{_CAPITAL}"
NAME, UNIT, NUMBER = 1, 2, 3
# The readings of a text: a window's family and form.
TEMPLATE, LITERAL, RAW = 1, 2, 3


def tokens(text: Column, names: bool) -> Column:
    """With names as one token each, or the lower-case text's tokens."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_extract_all(text if names else F.lower(text), F.lit(SMALL + (NAMES if names else "") + PLAIN), F.lit(0))


def kind(token: Column) -> Column:
    """NAME, UNIT, NUMBER, or null for a plain word."""
    return (
        F.when(token < F.lit("!"), F.lit(UNIT))
        .when(token < F.lit(":"), F.when(token.isin("%", "$"), F.lit(UNIT)).when(token.rlike(r"^\p{N}[\p{N}.,]*+$"), F.lit(NUMBER)))
        # Small ASCII letters, most of all tokens.
        .when((token >= F.lit("a")) & (token < F.lit("{")), F.lit(None).cast("int"))
        .when(token.isin("€", "£"), F.lit(UNIT))
        .when(token.rlike(IS_NAME), F.lit(NAME))
        .when(token.rlike(r"^\p{N}[\p{N}.,]*+$"), F.lit(NUMBER))
    )


def as_it_is(token: Column) -> Column:
    return F.when(token < F.lit("!"), F.xxhash64(F.ltrim(F.lower(token)))).otherwise(F.xxhash64(F.lower(token)))


def canonical(token: Column) -> Column:
    """The hash of the token's kind for a placeholder, else of its lower-case form."""
    return F.coalesce(kind(token).cast("long"), as_it_is(token))


def window_key(form: int, length: int, hash_at) -> Column:
    """One hash per window; `hash_at(k)` is its k-th token's."""
    return F.xxhash64(F.lit(form), F.lit(length), *[hash_at(k) for k in range(length)])


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """key, item, item_id, family, raw, at, length, n_windows and slice per window and form of each item.

    `family` is TEMPLATE for windows over names, LITERAL for those over
    lower-case tokens; `raw` marks a window compared as it is. A window with
    fewer than `LEAST_WORDS` plain words has no placeholder form. Items of
    fewer than `window` tokens are one window; items without any token have
    none. `item` tells items of one id and other texts apart; a null id is an
    id of its own.
    """
    items = benchmark.select("item_id", F.xxhash64("item_id", "text").alias("item"), "text").distinct()
    families = F.explode(F.array(*[
        F.struct(F.lit(f).alias("family"), tokens(F.col("text"), f == TEMPLATE).alias("t")) for f in (TEMPLATE, LITERAL)
    ]))
    words = items.select("item_id", "item", families.alias("r")).select("item_id", "item", "r.*").where(F.size("t") > 0)
    words = words.withColumn("length", F.least(F.size("t"), F.lit(window)))
    words = words.withColumn("n_windows", F.size("t") - F.col("length") + 1)
    cut = words.withColumn("at", F.explode(F.expr("sequence(1, n_windows)"))).withColumn("slice", F.slice("t", F.col("at"), F.col("length")))
    enough = F.size(F.filter("slice", lambda t: kind(t).isNull())) >= LEAST_WORDS
    forms = F.array_compact(F.array(F.when(enough, F.col("family")), F.when(F.col("family") == LITERAL, F.lit(RAW))))
    cut = cut.withColumn("form", F.explode(forms)).withColumn("raw", F.col("form") == RAW)
    hashes = F.when(F.col("raw"), F.transform("slice", as_it_is)).otherwise(F.transform("slice", canonical))
    cut = cut.withColumn("h", hashes)
    key = F.coalesce(*[
        F.when((F.col("form") == form) & (F.col("length") == n), window_key(form, n, lambda k: F.get("h", F.lit(k))))
        for form in (TEMPLATE, LITERAL, RAW) for n in range(1, window + 1)
    ])
    return cut.select(key.alias("key"), "item", "item_id", "family", "raw", "at", "length", "n_windows", "slice")


def _hashed(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, both token lists (t1 with names, t2 lower-case) and their hashes h1 (templates), h2 (literal), h3 (raw)."""
    read_once = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), tokens(F.col("text"), True).alias("t1"), tokens(F.col("text"), False).alias("t2")
    )
    return read_once.select(
        "*", F.transform("t1", canonical).alias("h1"), F.transform("t2", canonical).alias("h2"), F.transform("t2", as_it_is).alias("h3")
    )


def _keys(hashed: DataFrame, lengths: list[tuple[int, int]]) -> DataFrame:
    """Add doc_at (from 0) and key: a row per position and (form, length), generated code over arrays that were made once."""
    longer = F.when(F.size("h1") >= F.size("h2"), F.col("h1")).otherwise(F.col("h2"))
    at = hashed.select("*", F.posexplode(longer).alias("doc_at", "_hash")).drop("_hash")

    def key(form: int, length: int) -> Column:
        hashes = F.col(f"h{form}")
        inside = F.col("doc_at") + length <= F.size(hashes)
        return F.when(inside, window_key(form, length, lambda k: F.get(hashes, F.col("doc_at") + k)))

    return at.withColumn("key", F.explode(F.array(*[key(*pair) for pair in lengths]))).where("key is not null")


def slot_pairs(item: Column, doc: Column, at: Column) -> Column:
    """Placeholders of a window: struct of the item's position, whether it is a name, its value and the document's."""
    plain = lambda t: F.ltrim(F.lower(t))
    pair = lambda t, k: F.when(
        kind(t).isNotNull(), F.struct((at + k).alias("p"), (kind(t) == NAME).alias("name"), plain(t).alias("a"), plain(F.get(doc, k)).alias("b"))
    )
    return F.array_compact(F.transform(item, pair))


def agreement(slots: Column) -> Column:
    """The share of slots whose document value is the commonest one for the item's value; of repeated names alone, if that is less.

    Numbers that coincide in the item or the document cost little, but a name
    that stands for two others is another question.
    """

    def share(pairs: Column) -> Column:
        same = lambda a: F.filter(pairs, lambda p: p["a"] == a)
        most = lambda own: F.array_max(F.transform(own, lambda p: F.size(F.filter(own, lambda q: q["b"] == p["b"]))))
        values = F.array_distinct(F.transform(pairs, lambda p: p["a"]))
        kept = F.aggregate(values, F.lit(0), lambda sum_, a: sum_ + let(same(a), most))
        return F.when(F.size(pairs) == 0, F.lit(1.0)).otherwise(kept / F.size(pairs))

    repeated = lambda pairs: F.filter(pairs, lambda p: p["name"] & (F.size(F.filter(pairs, lambda q: q["a"] == p["a"])) > 1))
    return F.least(let(slots, share), let(let(slots, repeated), share))


def leaks(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, covered: float = COVERED, agreeing: float = AGREEING) -> DataFrame:
    """doc_id, text_hash, item_id, coverage, n_slots, verbatim per document and item that it contains.

    coverage is the share of the item's windows found, in the better of its
    two readings: as templates in alignments whose slots agree, or as
    lower-case tokens. verbatim says that the windows found as they are cover
    the item too. Null and empty texts have no tokens; rows of one id and text
    give one result; rows of one id and other texts are told apart by
    text_hash; null ids of documents and items are values of their own; of
    items that repeat an id the best covered counts. An empty benchmark or
    table gives an empty result; other columns of either table play no part.
    """
    items = written(benchmark_windows(benchmark, window), "benchmark_windows")
    form = F.when(F.col("raw"), F.lit(RAW)).otherwise(F.col("family"))
    size = items.agg(
        F.coalesce(F.sum(F.lit(96) + F.length(F.concat_ws(" ", "slice")) * 4 + F.col("length") * 16), F.lit(0)),
        F.collect_set(F.struct(form.alias("form"), "length")),
    ).first()
    lengths = sorted((r.form, r.length) for r in size[1]) or [(RAW, window)]
    hashed = _hashed(docs)
    if size[0] <= BROADCAST_BYTES:
        found = _keys(hashed, lengths).join(F.broadcast(items), "key")
    else:
        # Only positions are shuffled; the tokens of documents that met an item are joined to their matches.
        narrow = _keys(hashed, lengths).select("doc_id", "text_hash", "doc_at", "key").join(items, "key")
        narrow = written(narrow, "met").withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
        found = hashed.dropDuplicates(["doc_id", "text_hash"]).join(narrow, same)
    doc = F.slice(F.when(F.col("family") == TEMPLATE, F.col("t1")).otherwise(F.col("t2")), F.col("doc_at") + 1, F.col("length"))
    no_slots = F.array().cast("array<struct<p:int,name:boolean,a:string,b:string>>")
    met = found.select(
        "doc_id", "text_hash", "item", "item_id", "family", "n_windows", "at", "raw", (F.col("doc_at") + 1 - F.col("at")).alias("shift"),
        F.when(F.col("raw"), no_slots).otherwise(let(doc, lambda d: slot_pairs(F.col("slice"), d, F.col("at")))).alias("slots"),
    )
    aligned = met.groupBy("doc_id", "text_hash", "item", "item_id", "family", "n_windows", "shift").agg(
        F.collect_set(F.when(~F.col("raw"), F.col("at"))).alias("ats"),
        F.collect_set(F.when(F.col("raw"), F.col("at"))).alias("raw_ats"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    sound = agreement(F.col("slots")) >= agreeing
    aligned = aligned.withColumns({"ats": F.when(sound, F.col("ats")).otherwise(F.array().cast("array<int>")), "n_slots": F.size("slots")})
    share = lambda ats: F.size(F.array_distinct(F.flatten(F.collect_list(ats)))) / F.col("n_windows")
    per_item = aligned.groupBy("doc_id", "text_hash", "item", "item_id", "family", "n_windows").agg(
        share(F.array_union("ats", "raw_ats")).alias("coverage"),
        share("raw_ats").alias("as_it_is"),
        F.max(F.when(F.size("ats") > 0, F.col("n_slots")).otherwise(0)).alias("n_slots"),
    )
    return per_item.where(F.col("coverage") >= covered).groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("coverage").alias("coverage"), F.max("n_slots").alias("n_slots"), F.max(F.col("as_it_is") >= covered).alias("verbatim")
    )


def op6_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", F.round("coverage", 6).alias("coverage"), "n_slots", "verbatim")


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns.

    Null and empty texts stay, and so does everything with an empty benchmark;
    rows that repeat an id go or stay by their own text, copies of a row
    together. An empty table gives an empty result.
    """
    bad = written(leaks(docs, read(spark, folder, "benchmark")), "leaks").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    )
    whole = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", F.xxhash64("text").alias("text_hash"))
    same = whole["doc_id"].eqNullSafe(bad["_id"]) & (whole["text_hash"] == bad["_hash"])
    return whole.join(bad, same, "left_anti").select("doc.*")
