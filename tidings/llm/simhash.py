"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit for each of the 64 bit positions, set where
over half of its word shingles' hashes have it set. Fingerprints that differ
in at most `radius` bits are linked; the documents' classes are the connected
components of the links.

Search: the fingerprint is cut into segments. If the distance is at most r,
some segment differs in at most r // segments bits, and only the first
r % segments + 1 segments need that radius, the others one less. Each
distinct fingerprint is entered in one table per segment; each one then
enumerates the small Hamming ball around its segment's value, fetches the
entries there and verifies the complete distance. Exact copies share one
entry. A bucket of up to `BUCKET` entries is joined as it is. A fuller one,
which large groups of near copies make, gives only a spanning forest of its
links: its entries and probes are cut into blocks, each pair of blocks is
compared in numpy and returns the links that connect something new, so that
a group of k texts gives about k links instead of k * k.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidings.llm.common import read
from tidings.llm.components import stars
from tidings.session import written

BUCKET = 64
BLOCK = 4096
# Shingles whose bits are unpacked at a time.
SLICE = 1 << 14


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint as a signed 64-bit number; no words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingles, n = [b" ".join(words)], 1
    else:
        shingles, n = map(b" ".join, zip(*(words[k:] for k in range(shingle)))), len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        octets = hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(text: str) -> Column:
    return F.pandas_udf(_fingerprints, "long")(text)


def segment_plan(n: int, radius: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) per segment; a segment has about log2(n) bits but at most half the word."""
    # Three segments keep buckets small up to 2**24 fingerprints, two beyond that.
    segments = 3 if n <= 1 << 24 else 2
    plan, shift = [], 0
    for k in range(segments):
        width = (64 - shift) // (segments - k)
        plan.append((shift, width, radius // segments - (k > radius % segments)))
        shift += width
    return plan


def _ball(width: int, radius: int) -> list[int]:
    masks = {0}
    for _ in range(max(radius, 0)):
        masks |= {m ^ (1 << b) for m in masks for b in range(width)}
    return sorted(masks)


def _segment(fp: str, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), shift).bitwiseAND(F.lit((1 << width) - 1))


def _first_meeting(plan, a: str, b: str) -> Column:
    """The first segment in which the two are near enough: a pair is taken from that segment alone."""
    out = F.lit(None).cast("int")
    for k, (shift, width, radius) in reversed(list(enumerate(plan))):
        if radius >= 0:
            away = F.bit_count(_segment(a, shift, width).bitwiseXOR(_segment(b, shift, width)))
            out = F.when(away <= radius, k).otherwise(out)
    return out


def _forest(radius: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def links_of_blocks(rows: pd.DataFrame) -> pd.DataFrame:
        """Entries and probes of a pair of blocks: links that form a spanning forest of theirs."""
        fps = rows["fp"].to_numpy().view(np.uint64)
        is_entry = rows["is_entry"].to_numpy()
        entries, probes = np.unique(fps[is_entry]), np.unique(fps[~is_entry])
        nodes = np.unique(fps)
        parent = np.arange(len(nodes))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        at_entry, at_probe = np.searchsorted(nodes, entries), np.searchsorted(nodes, probes)
        out = []
        for fp, me in zip(probes, at_probe):
            near = at_entry[np.bitwise_count(entries ^ fp) <= radius]
            mine = root(me)
            # Most neighbours are already linked: compare roots before taking any link.
            fresh = near[parent[near] != mine]
            for other in fresh:
                theirs = root(other)
                if theirs != mine:
                    parent[theirs] = mine
                    out.append((nodes[me], nodes[other]))
            parent[near] = mine
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return links_of_blocks


def near_links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """a, b: links that connect exactly the fingerprints (distinct, column `fp`) joined by distances up to `radius`."""
    plan = segment_plan(nodes.count(), radius)
    table = [(k, m) for k, (_, w, r) in enumerate(plan) if r >= 0 for m in _ball(w, r)]
    value = F.coalesce(*[F.when(F.col("k") == k, _segment("fp", s, w)) for k, (s, w, _) in enumerate(plan)])

    def keyed(masks: list[tuple[int, int]]) -> DataFrame:
        """fp once per (segment, mask): the segment's value with the mask's bits turned."""
        masks = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(m).cast("long").alias("mask")) for k, m in masks])
        turned = nodes.select("fp", F.explode(masks).alias("m")).select("fp", "m.k", "m.mask")
        return turned.select("fp", "k", value.bitwiseXOR(F.col("mask")).alias("key"))

    # The planner takes `probes`, a row per mask, for as small as `nodes`: no join may broadcast it or what comes of it.
    entries, probes = keyed([(k, m) for k, m in table if m == 0]).hint("merge"), keyed(table).hint("merge")
    # Without a ball, an entry that is alone in its bucket can meet nothing.
    met = F.col("k").isin([k for k, (_, _, r) in enumerate(plan) if r > 0]) | (F.col("n") > 1)
    counts = written(entries.groupBy("k", "key").agg(F.count("*").alias("n")).where(met), "buckets")

    regular = entries.join(counts.where(F.col("n") <= BUCKET), ["k", "key"]).select("k", "key", F.col("fp").alias("b"))
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius) & (F.col("a") > F.col("b"))
    pairs = (
        probes.withColumnRenamed("fp", "a")
        .join(regular, ["k", "key"])
        .where(near & (_first_meeting(plan, "a", "b") == F.col("k")))
        .select("a", "b")
    )

    full = counts.where(F.col("n") > BUCKET).select("k", "key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    at = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    every = F.explode(F.expr("sequence(0L, blocks - 1)"))
    cols = ("k", "key", "fp", "is_entry", "i", "j")
    full_entries = entries.join(full, ["k", "key"]).withColumns({"is_entry": F.lit(True), "i": at}).withColumn("j", every)
    full_probes = probes.join(full, ["k", "key"]).withColumns({"is_entry": F.lit(False), "j": at}).withColumn("i", every)
    forest = (
        full_entries.select(*cols)
        .union(full_probes.select(*cols))
        .groupBy("k", "key", "i", "j")
        .applyInPandas(_forest(radius), "a long, b long")
    )
    return pairs.union(forest)


def simhash_classes(rows: DataFrame, radius: int = 4) -> DataFrame:
    """fp, root and component_id per distinct fingerprint of `rows` (doc_id, fp).

    root is the least fingerprint of the class, component_id its least
    non-null doc_id (null when all are null).
    """
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "fingerprints")
    linked = stars(near_links(nodes, radius)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = written(
        nodes.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least_id"), "rooted"
    )
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id per row of `docs`.

    A text without words, a null one too, has fingerprint zero and links like
    any other. Rows that repeat an id each get their row. Empty table: empty
    result.
    """
    rows = written(docs.select("doc_id", fingerprints("text").alias("fp")), "simhash")
    classes = simhash_classes(rows, radius)
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(classes, "fp").select("doc_id", shown, "component_id")


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(read(spark, folder, "documents"))


def simhash_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class stays: the one with the least id; of rows that share it, the one with the least hash.

    A class without any id keeps one of its rows in the same way.
    """
    rows = written(docs.select("doc_id", F.xxhash64("text", "source", "lang").alias("row_hash"), fingerprints("text").alias("fp")), "simhash")
    classes = written(simhash_classes(rows), "classes")
    # One row per class: the ids and hashes of what stays, without its text.
    stays = (
        rows.join(classes, "fp")
        .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "row_hash")).alias("kept"))
        .select("kept.*")
    )
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    whole = docs.select(F.struct(*docs.columns).alias("doc"), named, F.xxhash64("text", "source", "lang").alias("row_hash"))
    found = whole.join(stays.select(named, "row_hash"), ["id", "row_hash"], "left_semi")
    # Of rows equal in id, text, source and language one stays; they are together already.
    return found.dropDuplicates(["id", "row_hash"]).select("doc.*")
