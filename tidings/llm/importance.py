"""Importance resampling of documents towards a target distribution, over hashed word n-grams.

A feature is a run of 1 to `max_n` words, its bucket a checksum modulo the
number of buckets. Buckets are counted over all documents and over all target
texts; a bucket's gain is the log of the ratio of its smoothed shares, a
document's weight the mean gain of its features. Gumbel noise from a hash of
the id turns weights into scores whose highest ones are a draw without
replacement.

Features are found by batch concatenation: the texts of a batch are joined
with a separator, one regex pass finds all words, a sorted search of the
words' positions in the documents' offsets tells whose they are, n-grams over
two documents are masked, and bincount sums up.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidings.llm.common import read
from tidings.session import written

BUCKETS = 10_000
# Upper-case ASCII is lowered first; in UTF-8 every byte of a character beyond ASCII is 0x80 or more.
WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
# Text joined at a time, and the length from which one text is cut into pieces.
JOINED_BYTES = 1 << 22
UNIT = 1000
# Copies of one row that are generated at a time.
CHUNK = 1 << 16


def _pieces(texts: list[bytes], max_n: int) -> Iterator[tuple[int, bytes, int]]:
    """(row, bytes, own): pieces of bounded size, cut between words; n-grams that start before `own` belong to the piece.

    Behind its own bytes a piece carries the next `max_n - 1` words, so that a
    cut loses no n-gram. A single word is never cut.
    """
    tail = re.compile(rb"[^0-9a-z\x80-\xff]*[0-9a-z\x80-\xff]+")
    for row, text in enumerate(texts):
        start = 0
        while len(text) - start > JOINED_BYTES:
            gap = GAP.search(text, start + JOINED_BYTES)
            if gap is None:
                break
            end = own = gap.start()
            for _ in range(max_n - 1):
                word = tail.match(text, end)
                end = word.end() if word else end
            yield row, text[start:end], own - start
            start = own
        yield row, text[start:], len(text) - start


def _joined(texts: list[bytes], max_n: int) -> Iterator[tuple[list[int], list[bytes], list[int]]]:
    """Pieces gathered up to `JOINED_BYTES`."""
    rows, parts, own, size = [], [], [], 0
    for row, piece, own_bytes in _pieces(texts, max_n):
        if parts and size + len(piece) > JOINED_BYTES:
            yield rows, parts, own
            rows, parts, own, size = [], [], [], 0
        rows.append(row)
        parts.append(piece)
        own.append(own_bytes)
        size += len(piece)
    if parts:
        yield rows, parts, own


def batch_features(texts: list[bytes | None], max_n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each word, row of each feature, bucket of each feature), joined part by joined part.

    `texts` are the UTF-8 bytes; a null has no words.
    """
    lowered = [(t or b"").lower() for t in texts]
    for rows, parts, own in _joined(lowered, max_n):
        joined = b"\n".join(parts)
        offsets = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
        found = [(m.start(), m.group()) for m in WORDS.finditer(joined)]
        if not found:
            continue
        at = np.fromiter((f[0] for f in found), np.int64, len(found))
        codes, words = pd.factorize(np.array([f[1] for f in found], dtype=object))
        piece = np.searchsorted(offsets, at, side="right") - 1
        mine = at - offsets[piece] < np.asarray(own)[piece]
        row = np.asarray(rows)[piece]
        checksums = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
        whose, where, checksum = [row[mine]], [checksums[codes[mine]] % buckets], checksums[codes]
        for n in range(2, max_n + 1):
            # The checksum of an n-gram goes on from the one of its first n - 1 words; equal ones are made once.
            if len(at) < n:
                break
            grams, first = np.unique(checksum[: len(at) - n + 1] * len(words) + codes[n - 1 :], return_inverse=True)
            heads, lasts = grams // len(words), grams % len(words)
            made = np.fromiter((zlib.crc32(b" " + words[w], int(h)) for h, w in zip(heads, lasts)), np.int64, len(grams))
            checksum = made[first]
            inside = (piece[: len(checksum)] == piece[n - 1 :]) & mine[: len(checksum)]
            whose.append(row[: len(checksum)][inside])
            where.append(checksum[inside] % buckets)
        yield row[mine], np.concatenate(whose), np.concatenate(where)


def _binary(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def bucket_counts(texts: DataFrame, *, max_n: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n over all rows of the column `text`; each task sends at most one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, where in batch_features(_binary(batch, "text"), max_n, buckets):
                total += np.bincount(where, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    tasks = texts.select("text").mapInArrow(count, "bucket long, n long")
    return tasks.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, *, max_n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of every bucket, in thousandths; `buckets` numbers are all that reaches the driver."""
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, table in ((s, docs), (t, target)):
        rows = bucket_counts(table, max_n=max_n, buckets=buckets).toArrow()
        counts[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(UNIT * math.log(r)) for r in ratio], np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, *, max_n: int = 1) -> DataFrame:
    """doc_id, n_words, n_features, weight per row; `gains` has one number per bucket."""
    ids = docs.schema["doc_id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, words, features, total = batch.num_rows, 0, 0, 0
            for by_word, whose, where in batch_features(_binary(batch, "text"), max_n, len(gains)):
                words = words + np.bincount(by_word, minlength=n)
                features = features + np.bincount(whose, minlength=n)
                # Sums of whole numbers, exact in doubles.
                total = total + np.bincount(whose, weights=gains[where], minlength=n).astype(np.int64)
            words, features, total = (np.zeros(n, np.int64) + x for x in (words, features, total))
            weight = total // np.maximum(features, 1)
            out = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, features, weight))]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(weigh, f"doc_id {ids}, n_words long, n_features long, weight long")


def with_score(weights: DataFrame, seed: int) -> DataFrame:
    """Add score: the weight plus Gumbel noise, in thousandths, from a hash of the id (a null id counts as no text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(UNIT)) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weights.withColumn("score", F.col("weight") + noise)


def with_rank(scored: DataFrame, *, least_words: int, percent: int) -> DataFrame:
    """Add rank (1, 2, ... by score, ties to the smaller id) for the first `percent` of the rows with enough words.

    The draw grows with the table, so no task ranks it all: scores are whole
    thousandths, a histogram of them gives every score the rank of its first
    row, and only rows of one score are numbered together. Null ids come last
    among equal scores, rows equal in score and id go by their other columns.
    """
    scored = written(scored, "scored")
    able = scored.where(F.col("n_words") >= least_words)
    # One row per whole score; both the weights' and the noise's ranges are bounded by logarithms.
    histogram = able.groupBy("score").agg(F.count("*").alias("n")).toArrow().sort_by([("score", "descending")])
    n = histogram["n"].to_numpy()
    after = np.cumsum(n)
    drawn = percent * int(n.sum()) // 100
    first = after - n
    taken = first < drawn
    firsts = pa.table({"score": histogram["score"].to_numpy()[taken], "_first": first[taken]})
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    lowest = int(firsts["score"].to_numpy().min())
    starts = F.broadcast(scored.sparkSession.createDataFrame(firsts))
    chosen = F.coalesce((F.col("n_words") >= least_words) & (F.col("score") >= lowest), F.lit(False))
    placed = _numbered(scored.where(chosen)).join(starts, "score").withColumn("rank", F.col("_first") + F.col("_place"))
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(*scored.columns, "rank")
    return placed.unionByName(scored.where(~chosen).withColumn("rank", F.lit(None).cast("long")))


def _numbered(rows: DataFrame) -> DataFrame:
    """Add `_place` from 1 by id among rows of one score.

    Equal rows are counted, numbered as one and written out again in chunks,
    so a row that repeats is no hot group; other rows of one score are few, as
    the noise spreads even equal weights over thousands of scores.
    """
    equal = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    order = [F.asc_nulls_last("doc_id"), *(c for c in rows.columns if c not in ("doc_id", "score"))]
    before = F.sum("_n").over(Window.partitionBy("score").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    chunks = equal.withColumn("_before", F.coalesce(before, F.lit(0))).withColumn(
        "_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(CHUNK).cast("long")))
    )
    copies = F.explode(F.sequence("_from", F.least(F.col("_from") + CHUNK - 1, F.col("_n"))))
    return chunks.withColumn("_copy", copies).select(*rows.columns, (F.col("_before") + F.col("_copy")).alias("_place"))


def resample(
    docs: DataFrame, target: DataFrame, *, max_n: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10, seed: int = 2024
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank per document; rank is null for those not drawn.

    A null or empty text has no words and weight 0; a long text is counted
    whole, piece by piece; rows that repeat an id are rows of their own with
    the same noise. An empty table gives an empty result, an empty target
    gains that only tell frequent buckets from rare ones. Other columns of
    either table play no part.
    """
    gains = bucket_gains(docs, target, max_n=max_n, buckets=buckets)
    scored = with_score(weighted(docs, gains, max_n=max_n), seed)
    return with_rank(scored, least_words=least_words, percent=percent)


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# CRC-32 is worked out bit by bit from its polynomial, as DuckDB has no function for it; only for distinct words.
ORACLE = r"""
with recursive steps(b, k, v) as (
    select b, 0, b from range(256) t(b)
    union all
    select b, k + 1, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end from steps where k < 8
),
crc as (select list(v order by b) as t from steps where k = 8),
words as (
    select 's' as side, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
    union all
    select 't', null, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark
),
hexed as (select distinct w, hex(encode(w)) as h from words),
hashed as (
    select w, xor(list_reduce(list_prepend(4294967295::bigint,
            [(16 * (instr('0123456789ABCDEF', h[2 * i - 1]) - 1) + instr('0123456789ABCDEF', h[2 * i]) - 1)::bigint for i in range(1, length(h) // 2 + 1)]),
        lambda c, x: xor(c // 256, crc.t[xor(c % 256, x) + 1]::bigint)), 4294967295) % 10000 as bucket
    from hexed, crc
),
placed as (select side, doc_id, bucket from words join hashed using (w)),
counts as (
    select bucket, count(*) filter (side = 's') as s, count(*) filter (side = 't') as t from placed group by bucket
),
totals as (select sum(s) as ss, sum(t) as tt from counts),
gains as (
    select bucket, floor(1000 * ln((t + 1)::double * (ss + 10000)::double / ((s + 1)::double * (tt + 10000)::double)))::bigint as gain
    from counts, totals
),
own as (
    select doc_id, count(*) as n_features, floor(sum(gain)::double / count(*))::bigint as weight
    from placed join gains using (bucket) where side = 's' group by doc_id
),
scored as (
    select d.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
    from documents d left join own using (doc_id)
),
drawn as (
    select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scored where n_features >= 20
)
select s.doc_id, s.n_features::bigint as n_features, s.weight, s.score, case when r <= 10 * n // 100 then r end as rank
from scored s left join drawn using (doc_id)
"""
