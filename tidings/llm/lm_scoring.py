"""Language-model scoring by context-tree weighting over bytes.

A text is its lower-cased words joined by one blank, then one end byte. Each
byte is eight binary decisions; a decision has a node for every context of
0 ... DEPTH bytes before it. A node's counts of zeros and ones give a
Krichevsky-Trofimov estimate; the weighting mixes the estimates of all depths
by how well each of them codes the training texts:

    log Pw(node) = log 1/2 + log(Pe(node) + product of Pw(children)),  Pw = Pe at the full depth.

A context that the training texts do not have carries no evidence: the mix
ends at the deepest context they have.

No task needs the whole model. Documents are dealt into blocks of bounded
bytes, n-grams and words into buckets:

1. Each block's distinct n-grams and words, with their training counts, become
   one compressed row per bucket.
2. A bucket has all n-grams whose contexts end in the same three bytes, so it
   builds the tree of those contexts alone, from the full depth up. The nodes
   below that depth are sums over buckets and few; Spark SQL finishes them.
3. Each bucket gets its nodes' mix from above, goes down again and hands every
   block the probabilities of the block's own n-grams; word counts likewise.
4. Each block meets its rows and is added up.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidings.llm.common import is_remainder, read
from tidings.session import written

DEPTH = 5
# No byte of UTF-8; stands before a text (DEPTH times) and after it.
END = 0xFF
# The base model's token for the end of a text; no word is empty.
END_TOKEN = b""
BLOCK_BYTES = 20 << 20
# Bytes that are turned into words and arrays at a time.
SLICE = 1 << 20
# An n-gram and the number of its text in a slice share 64 bits.
NUMBER_BITS = 64 - 8 * (DEPTH + 1)
# Contexts that end in the same so many bytes are in one bucket.
SUFFIX = 3
# Text per bucket of n-grams and words.
BUCKET_BYTES = 48 << 20
PACKED = "block long, bucket long, is_gram boolean, keys binary, counts binary"
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _pack(values: np.ndarray) -> bytes:
    """Eight-byte numbers, compressed by byte planes; sorted whole numbers go in as differences."""
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(kind)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only


def _slices(texts: pa.ChunkedArray) -> Iterator[tuple[int, list[list[bytes]], np.ndarray, np.ndarray]]:
    """For some texts at a time, at most 1 << NUMBER_BITS: the number of the first one, their words,
    and (n-gram, number within the slice) per byte and end."""
    frame = bytes([END]) * DEPTH

    def arrays(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(p) for p in parts])
        x = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64)
        gram = x[DEPTH:].copy()
        for back in range(1, DEPTH + 1):
            gram |= x[DEPTH - back : len(x) - back] << np.uint64(8 * back)
        number = np.repeat(np.arange(len(parts), dtype=np.uint64), lengths)
        starts = np.cumsum(lengths) - lengths
        inside = np.ones(len(x), bool)
        inside[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
        inside = inside[DEPTH:]
        return gram[inside], number[DEPTH:][inside]

    begin, own, parts, size = 0, [], [], 0
    for text in texts:
        words = words_of(text.as_py())
        part = frame + b" ".join(words) + bytes([END])
        own.append(words)
        parts.append(part)
        size += len(part)
        if size >= SLICE or len(parts) == 1 << NUMBER_BITS:
            yield begin, own, *arrays(parts)
            begin, own, parts, size = begin + len(parts), [], [], 0
    if parts:
        yield begin, own, *arrays(parts)


class _Counts:
    """Counts per key as sorted arrays; new ones are merged when they have grown as large as the old ones."""

    def __init__(self):
        self.keys, self.counts, self.fresh, self.waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.fresh.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(len(self.keys), 1 << 18):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *[k for k, _ in self.fresh]])
        counts = np.concatenate([self.counts, *[c for _, c in self.fresh]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        if len(keys):
            first, _ = _runs(keys)
            keys, counts = keys[first], np.add.reduceat(counts, first)
        self.keys, self.counts, self.fresh, self.waiting = keys, counts, [], 0


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First positions and lengths of runs of equal values."""
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return first, np.diff(np.append(first, len(sorted_keys)))


def _count_block(n_buckets: int):
    def count_block(key: tuple, docs: pa.Table) -> pa.Table:
        """Distinct n-grams and words of a block with their counts in its training texts, a row per bucket and kind."""
        is_train = docs["train"].to_numpy().astype(np.uint64)
        found, counts = _Counts(), Counter()
        for begin, texts, gram, number in _slices(docs["text"]):
            packed = np.sort(gram << np.uint64(1) | is_train[begin + number.astype(np.int64)])
            first, length = _runs(packed)
            own = packed[first]
            found.add(own >> np.uint64(1), length * (own & np.uint64(1)).astype(np.int64))
            for words, learns in zip(texts, is_train[begin:]):
                if learns:
                    counts.update(words)
                    counts[END_TOKEN] += 1
                else:
                    counts.update(dict.fromkeys(words, 0))
                    counts[END_TOKEN] += 0
        found.merge()
        rows = []
        suffix = (found.keys >> np.uint64(8)) & np.uint64((1 << 8 * SUFFIX) - 1)
        home = ((suffix * GOLDEN) >> np.uint64(33)) % np.uint64(n_buckets)
        for bucket in np.unique(home):
            own = home == bucket
            rows.append((int(bucket), True, _pack_sorted(found.keys[own]), _pack(found.counts[own])))
        homes = [[] for _ in range(n_buckets)]
        for word in counts:
            homes[xxhash.xxh64_intdigest(word) % n_buckets].append(word)
        for bucket, words in enumerate(homes):
            if words:
                words.sort()
                joined = zstandard.ZstdCompressor(level=1).compress(b" ".join(words))
                rows.append((bucket, False, joined, _pack(np.array([counts[w] for w in words], np.int64))))
        bucket, is_gram, keys, n = zip(*rows)
        return pa.table({
            "block": pa.array([key[0].as_py()] * len(rows), pa.int64()), "bucket": pa.array(bucket, pa.int64()),
            "is_gram": pa.array(is_gram), "keys": pa.array(keys, pa.binary()), "counts": pa.array(n, pa.binary()),
        })

    return count_block


def _words_in(row_keys: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(row_keys).split(b" ")


def _word_totals(key: tuple, rows: pa.Table) -> pa.Table:
    """The same rows with counts over all blocks; the bucket's tokens and distinct words stand in its first row."""
    total: Counter = Counter()
    for keys, n in zip(rows["keys"], rows["counts"]):
        for word, c in zip(_words_in(keys.as_py()), _unpack(n.as_py(), np.int64).tolist()):
            total[word] += c
    whole = [_pack(np.array([total[w] for w in _words_in(k.as_py())], np.int64)) for k in rows["keys"]]
    rest = [0] * (len(whole) - 1)
    return pa.table({
        "block": rows["block"], "keys": rows["keys"], "counts": pa.array(whole, pa.binary()),
        "tokens": pa.array([sum(total.values()), *rest], pa.int64()), "distinct": pa.array([sum(c > 0 for c in total.values()), *rest], pa.int64()),
    })


# --- the part of the tree that a bucket has for itself -------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    product = x.copy()
    for k in range(1, 8):
        product *= x + k
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def _log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    value = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - math.log(math.pi)
    return np.where(zeros + ones > 0, value, 0.0)


def _grouped(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first, _ = _runs(keys)
    return keys[first], *(np.add.reduceat(s[order], first) for s in sums)


def _decisions(grams: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(node, bit) of every n-gram for each of the eight decisions."""
    byte, context = grams & np.uint64(255), grams & ~np.uint64(255)
    for k in range(8):
        yield context | np.uint64(1 << k) | byte >> np.uint64(8 - k), (byte >> np.uint64(7 - k) & np.uint64(1)).astype(np.int64)


def _all_grams(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    found = _Counts()
    for keys, n in zip(rows["keys"], rows["counts"]):
        found.add(_unpack_sorted(keys.as_py()), _unpack(n.as_py(), np.int64))
    found.merge()
    return found.keys, found.counts


def _levels_up(grams: np.ndarray, n: np.ndarray) -> dict[int, tuple]:
    """Per depth from SUFFIX to DEPTH: keys, zeros, ones, log Pw and the weight of stopping there."""
    steps = list(_decisions(grams))
    keys = np.concatenate([k for k, _ in steps])
    keys, zeros, ones = _grouped(keys, np.concatenate([n * (1 - b) for _, b in steps]), np.concatenate([n * b for _, b in steps]))
    log_pw = _log_estimate(zeros.astype(float), ones.astype(float))
    levels = {DEPTH: (keys, zeros, ones, log_pw, np.ones(len(keys)))}
    for depth in range(DEPTH - 1, SUFFIX - 1, -1):
        keys, zeros, ones, kids = _grouped(keys & np.uint64((1 << 8 * (depth + 1)) - 1), zeros, ones, log_pw)
        log_pe = _log_estimate(zeros.astype(float), ones.astype(float))
        log_pw = math.log(0.5) + np.logaddexp(log_pe, kids)
        levels[depth] = (keys, zeros, ones, log_pw, np.exp(np.minimum(math.log(0.5) + log_pe - log_pw, 0)))
    return levels


def _tree_of_bucket(key: tuple, rows: pa.Table) -> pa.Table:
    keys, zeros, ones, log_pw, _ = _levels_up(*_all_grams(rows))[SUFFIX]
    return pa.table({
        "bucket": pa.array([key[0].as_py()] * len(keys), pa.int64()), "key": pa.array(keys.astype(np.int64)),
        "zeros": pa.array(zeros), "ones": pa.array(ones), "log_pw": pa.array(log_pw),
    })


def _mix_of_bucket(rows: pa.Table, above: pa.Table) -> pa.Table:
    """Each block's n-grams with the log10 probability of their last byte after the others."""
    grams, n = _all_grams(rows)
    levels = _levels_up(grams, n)
    keys = above["key"].to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    keys, done, rest, p = keys[order], *(above[c].to_numpy()[order] for c in ("done", "rest", "p"))
    for depth in range(SUFFIX, DEPTH + 1):
        own, zeros, ones, _, stop = levels[depth]
        # At the first depth the table has the node's own row, below that its parent's.
        at = np.searchsorted(keys, own if depth == SUFFIX else own & np.uint64((1 << 8 * depth) - 1))
        one = (ones + 0.5) / (zeros + ones + 1.0)
        p = np.where(zeros + ones > 0, done[at] + rest[at] * one, p[at])
        done, rest, keys = done[at] + rest[at] * stop * one, rest[at] * (1 - stop), own
    score = np.zeros(len(grams))
    for node, bit in _decisions(grams):
        q = p[np.searchsorted(keys, node)]
        score += np.log10(np.where(bit == 1, q, 1 - q))
    values = [_pack(score[np.searchsorted(grams, _unpack_sorted(k.as_py()))]) for k in rows["keys"]]
    return pa.table({"block": rows["block"], "keys": rows["keys"], "counts": pa.array(values, pa.binary())})


def log_gamma(x: Column) -> Column:
    """log of the gamma function for x > 0: Stirling's series at x + 8, taken back by the recurrence."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    product = x
    for k in range(1, 8):
        product = product * (x + k)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def _estimates(nodes: DataFrame) -> DataFrame:
    """key, zeros, ones and log Pe."""
    zeros, ones = F.col("zeros").cast("double"), F.col("ones").cast("double")
    estimate = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - math.log(math.pi)
    return nodes.withColumn("log_pe", F.when(zeros + ones > 0, estimate).otherwise(0.0))


def _upper_mix(nodes: DataFrame) -> DataFrame:
    """key, done, rest, p of the mix above every node of depth SUFFIX: what it has so far, its weight left, its value if it ends there."""
    half = math.log(0.5)
    levels = {SUFFIX: nodes}
    for depth in reversed(range(SUFFIX)):
        parent = F.col("key").bitwiseAND(F.lit((1 << 8 * (depth + 1)) - 1)).alias("key")
        sums = levels[depth + 1].groupBy(parent).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_pw").alias("kids")
        )
        top, low = F.greatest("log_pe", "kids"), F.least("log_pe", "kids")
        log_pw = half + top + F.log1p(F.exp(low - top))
        node = _estimates(sums).withColumn("log_pw", log_pw)
        node = node.withColumn("stop", F.exp(F.least(half + F.col("log_pe") - F.col("log_pw"), F.lit(0.0))))
        levels[depth] = written(node.drop("kids"), "tree")
    count = F.col("zeros") + F.col("ones")
    one = (F.col("ones") + 0.5) / (count + 1.0)
    root = F.when(count > 0, one).otherwise(F.lit(0.5)).alias("p")
    above = levels[0].select("key", (F.col("stop") * one).alias("done"), (1 - F.col("stop")).alias("rest"), root)
    for depth in range(1, SUFFIX):
        parent = F.col("key").bitwiseAND(F.lit((1 << 8 * depth) - 1)).alias("above")
        joined = levels[depth].withColumn("above", parent).join(above.select(F.col("key").alias("above"), "done", "rest", "p"), "above")
        above = joined.select(
            "key",
            (F.col("done") + F.col("rest") * F.col("stop") * one).alias("done"),
            (F.col("rest") * (1 - F.col("stop"))).alias("rest"),
            F.when(count > 0, F.col("done") + F.col("rest") * one).otherwise(F.col("p")).alias("p"),
        )
    parent = F.col("key").bitwiseAND(F.lit((1 << 8 * SUFFIX) - 1)).alias("above")
    return nodes.select("bucket", "key", parent).join(above.withColumnRenamed("key", "above"), "above").drop("above")


def _score_block(train_tokens: int, n_distinct: int):
    def score_block(docs: pa.Table, model: pa.Table) -> pa.Table:
        keys, values, counts = [np.zeros(0, np.uint64)], [np.zeros(0)], {}
        for is_gram, own, numbers in zip(model["is_gram"], model["keys"], model["counts"]):
            if is_gram.as_py():
                keys.append(_unpack_sorted(own.as_py()))
                values.append(_unpack(numbers.as_py(), np.float64))
            else:
                counts.update(zip(_words_in(own.as_py()), _unpack(numbers.as_py(), np.int64).tolist()))
        keys, values = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(keys)
        keys, values = keys[order], values[order]
        scores, n_tokens, n_known, base_scores = [np.zeros(0)], [], [], []
        for _, texts, gram, number in _slices(docs["text"]):
            # One sort brings equal n-grams together and keeps the texts in order inside them.
            packed = np.sort(gram << np.uint64(NUMBER_BITS) | number)
            found = packed >> np.uint64(NUMBER_BITS)
            first, length = _runs(found)
            value = np.repeat(values[np.searchsorted(keys, found[first])], length)
            own = (packed & np.uint64((1 << NUMBER_BITS) - 1)).astype(np.int64)
            scores.append(np.bincount(own, weights=value, minlength=len(texts)))
            for tokens in texts:
                c = np.fromiter(map(counts.__getitem__, tokens), np.float64, len(tokens))
                c = np.append(c, counts[END_TOKEN])
                n_tokens.append(len(c))
                n_known.append(int((c > 0).sum()))
                base_scores.append(float(np.log10((c + 1) / (train_tokens + n_distinct + 1)).sum()))
        return pa.table({
            "doc_id": docs["doc_id"], "held_out": docs["held_out"],
            "n_tokens": pa.array(n_tokens, pa.int64()), "n_known": pa.array(n_known, pa.int64()),
            "train_tokens": pa.array([train_tokens] * len(n_tokens), pa.int64()),
            "base_score": pa.array(base_scores, pa.float64()), "score": pa.array(np.concatenate(scores)),
        })

    return score_block


def score_documents(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row.

    Trains on the rows that are not held out. Null and empty texts have one
    token, their end. Repeated rows count and score as often as they are
    there; rows equal in id and text are in one block. Without training rows
    every bit has probability 1/2.
    """
    rows = docs.select("doc_id", "text", held_out.alias("held_out"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(total / BLOCK_BYTES))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))
    n_buckets = max(1, math.ceil(total / BUCKET_BYTES))
    texts = blocked.select("block", "text", (~F.col("held_out")).alias("train"))
    counted = written(texts.groupBy("block").applyInArrow(_count_block(n_buckets), PACKED), "ngrams")

    words = counted.where("not is_gram").groupBy("bucket").applyInArrow(
        _word_totals, "block long, keys binary, counts binary, tokens long, distinct long"
    )
    words = written(words, "words")
    sums = words.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()

    grams = counted.where("is_gram")
    nodes = grams.groupBy("bucket").applyInArrow(_tree_of_bucket, "bucket long, key long, zeros long, ones long, log_pw double")
    above = _upper_mix(written(nodes, "tree"))
    scored = grams.groupBy("bucket").cogroup(above.groupBy("bucket")).applyInArrow(_mix_of_bucket, "block long, keys binary, counts binary")
    model = scored.withColumn("is_gram", F.lit(True)).unionByName(words.select("block", "keys", "counts", F.lit(False).alias("is_gram")))
    schema = "doc_id {}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    kind = dict(docs.dtypes)["doc_id"]
    return blocked.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(_score_block(sums.n, sums.v), schema.format(kind))


def op10_context_tree_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(read(spark, folder, "documents"), is_remainder(F.col("doc_id"), 7, 2))
