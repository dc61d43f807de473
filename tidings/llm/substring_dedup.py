"""Near-duplicate passages by compact windows.

A text is the sequence of its word shingles' hashes. For one min-hash
function, the Cartesian tree over the sequence groups its passages: all
passages between the nearest smaller values left and right of a node share
that node as their minimum. Of each node this keeps the passages of the
wanted length, as a window: the run of starts whose minimum is the node. (The
minima come from block-wise prefix and suffix minima, which gives the same
nodes without building the tree.)

Windows of different documents with the same minimum meet. Windows of equal
content are one class, whose members are linked to its least document; only
classes are compared. Within a group of equal minima a class goes on only
while nearly all shingles of one of its passages are also in other classes,
and classes that differ in nothing but what no other class has are compared as
one. Every start that two windows have is then verified by the exact
similarity of the two passages' shingle sets: the starts that see an equal
shingle on both sides form an interval, so a running sum gives the
intersections of all starts at once. A group of up to `BUCKET` classes gives
all its links; a larger one is cut into blocks that are compared in pairs and
gives a spanning forest of its links and, for each start that has a partner, a
link that covers it. What the passages show, the starts and the least document
that links lead to, does not depend on which way a group took.
"""

from __future__ import annotations

from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidings.llm import components
from tidings.llm.common import read
from tidings.session import written

SHINGLE = 5
# Passages of this many words are compared.
WORDS = 50
# Passages that one of so many hash functions gives the same minimum are verified.
HASHES = 4
SIMILARITY = 0.8
# Classes of a group up to which all its links are listed; classes per block of a larger group.
BUCKET = 8
BLOCK = 2048
# Classes per task of groups of one block, pairs compared at a time.
ROWS = 1 << 13
PAIRS = 512
# Starts of a group's rows whose rarest shingles are sought at a time.
STARTS = 1 << 14
# Pairs of a large group tried at a time, places held for their first rows, holders of rare shingles looked at.
TRIED = 1 << 11
CELLS = 1 << 20
HOLDERS = 1 << 18
# Bytes of texts that are split at a time.
TEXT_BYTES = 1 << 23
# Shingles worked on at a time; low bits of a packed minimum are a position in it.
POSITION_BITS = 20
PRIME = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SEEDS = (0x2545F4914F6CDD1D, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def shingle_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash per shingle of lower-cased words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return _shingled(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))


def _shingled(w: np.ndarray) -> np.ndarray:
    n = max(len(w) - SHINGLE + 1, 0)
    out = w[:n].copy()
    for k in range(1, SHINGLE):
        out = (out ^ (out >> np.uint64(32))) * PRIME + w[k : k + n]
    return out


def text_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, its `shingle_hashes`) of each text; a word that many texts have is hashed once for them."""
    done = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(done, done[begin] + TEXT_BYTES, side="right")) - 1)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(begin, end - begin).fill_null("")))
        words, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        some = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty word
        row, words = row[some.to_numpy(zero_copy_only=False)], words.filter(some).dictionary_encode()
        known = words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        w = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))[words.indices.to_numpy()]
        shingles, bounds = _shingled(w), np.searchsorted(row, np.arange(end - begin + 1))
        for k in range(end - begin):
            yield begin + k, shingles[bounds[k] : max(bounds[k + 1] - SHINGLE + 1, bounds[k])]
        begin = end


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed)) * PRIME
    x = (x ^ (x >> np.uint64(29))) * np.uint64(SEEDS[0])
    return x ^ (x >> np.uint64(32))


def window_minima(values: np.ndarray, length: int) -> np.ndarray:
    """Position of the least value of every window of `length`; of equal ones the first."""
    low = np.uint64((1 << POSITION_BITS) - 1)
    packed = values & ~low | np.arange(len(values), dtype=np.uint64)
    blocks = -(-len(values) // length)
    grid = np.full(blocks * length, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(values)] = packed
    grid = grid.reshape(blocks, length)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - length + 1
    return (np.minimum(back[:n], ahead[length - 1 : length - 1 + n]) & low).astype(np.int64)


def compact_windows(
    shingles: np.ndarray, length: int, function: int, piece: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle at the minimum, its position, first start, last start) per window, for one hash function.

    `piece` numbers the text that each shingle is from, when texts are joined; no passage spans two.
    Equal minima, as repeated words make them, are windows of their own: all starts of a window see its minimum.
    """
    found = []
    step = (1 << POSITION_BITS) - length
    for begin in range(0, max(len(shingles) - length + 1, 0), step):
        part = shingles[begin : begin + step + length - 1]
        if len(part) < length:
            break
        least = window_minima(_mixed(part, SEEDS[function]), length) + begin
        start = np.arange(begin, begin + len(least))
        if piece is not None:
            whole = np.flatnonzero(piece[start] == piece[start + length - 1])
            least, start = least[whole], start[whole]
        if not len(start):
            continue
        opens = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1)]))
        found.append((shingles[least[opens]], least[opens], start[opens], start[np.append(opens[1:], len(start)) - 1]))
    if not found:
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    return tuple(np.concatenate(x) for x in zip(*found))


def _joined(texts: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(shingles, piece, row of each piece): texts joined up to what a packed position can number; a longer one stands alone."""
    parts, rows, size = [], [], 0

    def joined():
        return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.array(rows)

    for row, shingles in text_hashes(texts):
        if len(shingles) < length:
            continue
        if parts and size + len(shingles) > 1 << POSITION_BITS:
            yield joined()
            parts, rows, size = [], [], 0
        parts.append(shingles)
        rows.append(row)
        size += len(shingles)
    if parts:
        yield joined()


def slice_hashes(shingles: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of shingles[first:end] for each pair of bounds, wherever the slice stands."""
    n = len(shingles)
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, PRIME)]))
    back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, INVERSE)]))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(shingles, SEEDS[0]) * powers[:n])])
    return ((sums[end] - sums[first]) * back[first]).view(np.int64)


def _mixed_keys(keys: np.ndarray, function: int) -> pa.Array:
    return pa.array(_mixed(keys, function + 1).view(np.int64))


def _minima(length: int):
    """The windows' keys and documents only."""

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shingles, piece, rows in _joined(batch["text"], length):
                for function in range(HASHES):
                    key, _, first, _ = compact_windows(shingles, length, function, piece)
                    ids = batch["doc_id"].take(pa.array(rows[piece[first]]))
                    yield pa.RecordBatch.from_pydict({"key": _mixed_keys(key, function), "doc_id": ids})

    return minima


def _windows(length: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            for shingles, piece, rows in _joined(batch["text"], length):
                starts = np.searchsorted(piece, np.arange(len(rows)))
                found = [compact_windows(shingles, length, function, piece) for function in range(HASHES)]
                sizes = [len(at) for _, at, _, _ in found]
                _, _, first, last = map(np.concatenate, zip(*found))
                contents = np.split(slice_hashes(shingles, first, last + length), np.cumsum(sizes)[:-1])
                for function, ((key, at, first, last), content) in enumerate(zip(found, contents)):
                    mine = piece[first]
                    columns = {
                        "key": _mixed_keys(key, function),
                        "doc_id": ids.take(pa.array(rows[mine])),
                        "function": pa.array(np.full(len(at), function, np.int8)),
                        "at": pa.array((at - starts[mine]).astype(np.int32)),
                        "before": pa.array((first - at).astype(np.int32)),
                        "after": pa.array((last - at).astype(np.int32)),
                        "content": pa.array(content),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return windows


CLASS = ("key", "function", "before", "after", "content")
CARRIED = (*CLASS, "n", "lo_at", "hi_doc", "hi_at")


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[k], first[k] + 1, ..., sizes[k] numbers, for each k."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _contents(length: int):
    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = pc.list_value_length(batch["wanted"]).to_numpy(zero_copy_only=False).astype(np.int64)
            begins = np.cumsum(number) - number
            wanted = batch["wanted"].flatten()
            for shingles, piece, rows in _joined(batch["text"], length):
                starts = np.searchsorted(piece, np.arange(len(rows)))
                ends = np.searchsorted(piece, np.arange(len(rows)), side="right")
                mine = wanted.take(pa.array(_ranges(begins[rows], number[rows])))
                owner = np.repeat(np.arange(len(rows)), number[rows])
                field = dict(zip(CARRIED, mine.flatten()))
                first = field["lo_at"].to_numpy() + field["before"].to_numpy() + starts[owner]
                end = field["lo_at"].to_numpy() + field["after"].to_numpy() + length + starts[owner]
                # Of several texts with this id, the one the window comes from.
                here = np.flatnonzero(end <= ends[owner])
                here = here[slice_hashes(shingles, first[here], end[here]) == field["content"].to_numpy()[here]]
                low = (shingles & np.uint64(0x7FFFFFFF)).astype(np.int32)
                first, end = first[here], end[here]
                offsets = np.concatenate([[0], np.cumsum(end - first)])
                taken = {name: column.take(pa.array(here)) for name, column in field.items()}
                taken["lo_doc"] = batch["doc_id"].take(pa.array(rows[owner[here]]))
                taken["shingles"] = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(low[_ranges(first, end - first)]))
                yield pa.RecordBatch.from_pydict(taken)

    return contents


class Slices:
    """Windows' shingles laid over each other at their minima, and what verifying their starts takes."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray, before: np.ndarray, after: np.ndarray, length: int, similarity: float):
        self.length, self.similarity, width = length, similarity, 2 * length - 1
        n = len(sizes)
        self.lo, self.hi = length - 1 + before, length - 1 + after
        row = np.repeat(np.arange(n), sizes)
        at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.lo[row]
        self.v = np.full((n, width), -1, np.int32)
        self.v[row, at] = values
        # Of each position the starts from `since` see it as their first one of its value.
        order = np.argsort(self.v, axis=1, kind="stable")
        ordered = np.take_along_axis(self.v, order, 1)
        earlier = np.zeros((n, width), np.int64)
        np.put_along_axis(earlier, order[:, 1:], np.where(ordered[:, 1:] == ordered[:, :-1], order[:, :-1] + 1, 0), 1)
        self.earlier = earlier
        since = np.maximum(earlier, np.arange(width) - length + 1)
        # Runs: the starts whose passage has a value, from `lo` to `hi`; a value that comes again soon enough is in one run.
        flat, value = order.ravel(), ordered.ravel()
        owner = np.repeat(np.arange(n), width)
        real = value >= 0
        flat, value, owner = flat[real], value[real], owner[real]
        fresh = np.ones(len(flat), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1]) | (flat[1:] - flat[:-1] > length)
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(flat)) - 1 if len(first) else first
        self.run_row, self.run_value = owner[first], value[first]
        self.run_lo, self.run_hi = since[owner[first], flat[first]], flat[last]
        place = np.arange(len(first)) - np.searchsorted(self.run_row, self.run_row)
        self.values, self.los, self.his = (np.full((n, place.max(initial=0) + 1), x, np.int32) for x in (-1, 0, 0))
        for table, column in ((self.values, self.run_value), (self.los, self.run_lo), (self.his, self.run_hi)):
            table[self.run_row, place] = column
        self.distinct = self._sums(n, self.run_row, self.run_lo, self.run_hi)
        start = np.arange(length)
        # Starts that may have a partner; `hopeful` narrows them.
        self.hope = (start >= self.lo[:, None]) & (start <= self.hi[:, None])

    def taken(self, kept: np.ndarray) -> Slices:
        """The same of some rows only."""
        out, number = copy(self), np.full(len(self.v), -1)
        number[kept] = np.arange(len(kept))
        for name in ("v", "earlier", "lo", "hi", "values", "los", "his", "distinct", "hope"):
            setattr(out, name, getattr(self, name)[kept])
        runs = number[self.run_row] >= 0
        out.run_row = number[self.run_row[runs]]
        out.run_value, out.run_lo, out.run_hi = self.run_value[runs], self.run_lo[runs], self.run_hi[runs]
        return out

    def hopeful(self, group: np.ndarray) -> np.ndarray:
        """The starts (rows x length) at which a row may be near another row of its group.

        At some start nearly all of a row's shingles must also be in other
        rows; when a row goes, others may lose what they shared with it.
        """
        n, row = len(self.v), self.run_row
        code = group[row].astype(np.int64) << 31 | self.run_value
        _, number = np.unique(code, return_inverse=True)
        once = np.ones(len(row), bool)
        once[1:] = (row[1:] != row[:-1]) | (self.run_value[1:] != self.run_value[:-1])
        alive, left = np.ones(n, bool), -1
        while left != (left := np.count_nonzero(alive)):
            mine = alive[row]
            rows_with = np.bincount(number[once & mine], minlength=number.max(initial=-1) + 1)
            shared = mine & (rows_with[number] > 1)
            most = self._sums(n, row[shared], self.run_lo[shared], self.run_hi[shared])
            hope = self.hope & (most >= self.similarity * self.distinct - 1e-6) & alive[:, None]
            alive = hope.any(axis=1)
        return hope

    def patterns(self, group: np.ndarray) -> np.ndarray:
        """A number per row: rows of one group with the same number have the same similarity to any third row, start by start.

        A shingle that only one row of the group has can't be shared; of it
        counts only where it stands, and where the row had it before. Such rows
        differ in what no other row has.
        """
        n, width = self.v.shape
        row, at = np.nonzero(self.v >= 0)
        value = self.v[row, at].astype(np.int64)
        seen = self.earlier[row, at]
        once = seen == 0
        code = group[row].astype(np.int64) << 31 | value
        _, number = np.unique(code, return_inverse=True)
        rows_with = np.bincount(number[once], minlength=number.max(initial=-1) + 1)
        shared = rows_with[number] > 1
        content = np.where(shared, value, -2 - np.where(once, 0, at + 1 - seen))
        mixed = _mixed(content.view(np.uint64) * PRIME + at.astype(np.uint64), SEEDS[1])
        sums = np.zeros(n, np.uint64)
        np.add.at(sums, row, mixed)
        ends = (group.astype(np.uint64) * PRIME + self.lo.astype(np.uint64)) * PRIME + self.hi.astype(np.uint64)
        return _mixed(sums + _mixed(ends, SEEDS[2]), SEEDS[3])

    def _sums(self, n: int, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each of n rows and each start, the number of intervals [lo, hi] that hold it."""
        hi = np.minimum(hi, self.length - 1)
        some = lo <= hi
        row, lo, hi, step = row[some], lo[some], hi[some], self.length + 1
        steps = np.bincount(row * step + lo, minlength=n * step) - np.bincount(row * step + hi + 1, minlength=n * step)
        return np.cumsum(steps.reshape(n, step), axis=1)[:, : self.length]

    def similarities(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs' numbers that have a start of at least the similarity, and each one's similarity by start, else 0."""
        hope = self.hope[i] & self.hope[j]
        tried = np.flatnonzero(hope.any(axis=1))
        found, out = [], []
        for at in range(0, len(tried), PAIRS):
            some = tried[at : at + PAIRS]
            x, y = i[some], j[some]
            a, b = self.values[x], self.values[y]
            pair, p, q = np.nonzero((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None])
            shared = self._sums(len(some), pair, np.maximum(self.los[x[pair], p], self.los[y[pair], q]), np.minimum(self.his[x[pair], p], self.his[y[pair], q]))
            ratio = self.ratio(shared, x, y, hope[some])
            good = np.flatnonzero(ratio.any(axis=1))
            found.append(some[good])
            out.append(ratio[good])
        return (np.concatenate(found), np.concatenate(out)) if found else (np.zeros(0, np.int64), np.zeros((0, self.length)))

    def ratio(self, shared: np.ndarray, x: np.ndarray | int, y: np.ndarray, hope: np.ndarray) -> np.ndarray:
        out = shared / np.maximum(self.distinct[x] + self.distinct[y] - shared, 1)
        out[~hope | (out < self.similarity)] = 0
        return out


def _forest(slices: Slices, rows: np.ndarray, side: np.ndarray, cross: bool, apart) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of a pair of blocks: links that form a spanning forest of its links and cover every start that has one.

    Rows with the most hope come first: what they cover need not be looked at
    again, so a group of copies with an edit each takes few comparisons a row.
    """
    order = np.argsort(-slices.hope[rows].sum(axis=1), kind="stable")
    rows, side = rows[order], side[order]
    hope, values, los, his = slices.hope[rows], slices.values[rows], slices.los[rows], slices.his[rows]
    _, ids = np.unique(values, return_inverse=True)
    ids = ids.reshape(len(rows), -1)
    # A row's runs stand by value: runs of one value follow each other.
    column = np.arange(ids.shape[1])
    fresh = np.pad(ids[:, 1:] != ids[:, :-1], ((0, 0), (1, 0)), constant_values=True)
    again = column - np.maximum.accumulate(np.where(fresh, column, 0), axis=1)
    again[values < 0] = -1
    place = np.full((max(1, min(len(rows), CELLS // (ids.max() + 1))), ids.max() + 1), -1, np.int32)
    open_, root = hope.copy(), np.arange(len(rows))
    uncovered = _bits(open_)
    for some, number, other in _batches(_partners(slices, rows), len(place)):
        k = some[number]
        left = open_.any(axis=1)
        tried = (root[other] != root[k]) | left[other] | left[k]
        if cross:
            tried &= side[other] != side[k]
        k, number, other = k[tried], number[tried], other[tried]
        both = hope[other] & hope[k]
        tried = np.where(root[other] != root[k], both.any(axis=1), (both & (open_[other] | open_[k])).any(axis=1))
        tried &= apart(rows[k], rows[other])
        if not tried.any():
            continue
        k, number, other, both = k[tried], number[tried], other[tried], both[tried]
        shared = 0
        for time in range(again[some].max() + 1):
            row, own = np.nonzero(again[some] == time)
            place[row, ids[some[row], own]] = own
            p = place[number[:, None], ids[other]]
            place[row, ids[some[row], own]] = -1
            pair, q = np.nonzero(p >= 0)
            p, o, x = p[pair, q], other[pair], k[pair]
            shared = shared + slices._sums(len(other), pair, np.maximum(los[x, p], los[o, q]), np.minimum(his[x, p], his[o, q]))
        ratio = slices.ratio(shared, rows[k], rows[other], both)
        near = ratio > 0
        found = np.flatnonzero(np.where(root[other] != root[k], near.any(axis=1), (near & (open_[other] | open_[k])).any(axis=1)))
        kept = []
        for at, x, o, starts in zip(found.tolist(), k[found].tolist(), other[found].tolist(), _bits(near[found])):
            if not starts & (uncovered[o] | uncovered[x]) and root[o] == root[x]:
                continue
            if root[o] != root[x]:
                root[root == root[o]] = root[x]
            uncovered[o] &= ~starts
            uncovered[x] &= ~starts
            open_[[o, x]] &= ~near[at]
            kept.append(at)
        yield rows[k[kept]], rows[other[kept]], ratio[kept]


def _bits(starts: np.ndarray) -> list[int]:
    """Each row of flags as one number."""
    packed = np.packbits(starts, axis=1)
    flat, width = packed.tobytes(), packed.shape[1]
    return [int.from_bytes(flat[at : at + width]) for at in range(0, len(flat), width)]


def _batches(partners: Iterator[tuple[int, np.ndarray]], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, number of the row, its partner) of up to `most` rows at a time, and little more than `TRIED` pairs."""
    rows, others, size = [], [], 0
    for k, other in partners:
        rows.append(k)
        others.append(other)
        size += len(other)
        if len(rows) == most or size >= TRIED:
            yield np.array(rows), np.repeat(np.arange(len(rows)), [len(o) for o in others]), np.concatenate(others)
            rows, others, size = [], [], 0
    if rows:
        yield np.array(rows), np.repeat(np.arange(len(rows)), [len(o) for o in others]), np.concatenate(others)


def _partners(slices: Slices, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Of each row the later ones it may be near: those that hold one of its rarest shingles.

    A passage's partner has all but a few of its shingles, so of the rarest
    ones, one more than that, it has one. What a whole group shares, as the
    phrase that brought it together, is hardly among them.
    """
    n, length = len(rows), slices.length
    v, hope = slices.v[rows], slices.hope[rows]
    once = (slices.earlier[rows] == 0) & (v >= 0)
    _, number = np.unique(v, return_inverse=True)
    number = number.reshape(v.shape)
    holding = np.bincount(number[once], minlength=number.max(initial=-1) + 1)
    row, at = np.nonzero(once)
    holders = row[np.argsort(number[row, at], kind="stable")]
    ends = np.cumsum(holding)
    code = holding[number] << 32 | number
    rare = np.zeros(v.shape, bool)
    row, start = np.nonzero(hope)
    for at in range(0, len(row), STARTS):
        r, place = row[at : at + STARTS, None], start[at : at + STARTS, None] + np.arange(length)
        codes = code[r, place]
        distinct = slices.distinct[rows[r[:, 0]], place[:, 0]]
        spared = distinct - np.ceil(slices.similarity * distinct - 1e-6).astype(np.int64)
        ordered = np.sort(codes, axis=1)
        earlier = np.cumsum(ordered[:, 1:] != ordered[:, :-1], axis=1)
        most = np.take_along_axis(ordered, (earlier <= spared[:, None]).sum(axis=1)[:, None], 1)
        taken = codes <= most
        rare[np.broadcast_to(r, taken.shape)[taken], place[taken]] = True
    row, at = np.nonzero(rare & (holding[number] > 1))
    code = np.unique(row.astype(np.int64) << 32 | number[row, at])
    row, value = code >> 32, code & 0xFFFFFFFF
    sizes = holding[value]
    done, bounds = np.concatenate([[0], np.cumsum(sizes)]), np.searchsorted(row, np.arange(n + 1))
    begin = 0
    while begin < n:
        # Whole rows, of so many holders at a time.
        end = max(begin + 1, int(np.searchsorted(done[bounds], done[bounds[begin]] + HOLDERS, side="right")) - 1)
        mine = slice(bounds[begin], bounds[end])
        begin = end
        holder = holders[_ranges(ends[value[mine]] - sizes[mine], sizes[mine])]
        k = np.repeat(row[mine], sizes[mine])
        k, other = np.divmod(np.unique((k * n + holder)[holder > k]), n)
        first = np.flatnonzero(np.diff(k, prepend=-1))
        yield from zip(k[first].tolist(), np.split(other, first[1:]))


def _spread_links(here, there, ratio, inner, stands, members, apart) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of the other rows of `here`'s patterns to `there`, at starts that those rows do not share with their own leader."""
    open_ = np.where(inner[here], 0, ratio)
    some = np.flatnonzero(open_.any(axis=1))
    if not len(some) or not len(members):
        return
    order = np.argsort(stands[members], kind="stable")
    leader = stands[members][order]
    first, last = np.searchsorted(leader, here[some]), np.searchsorted(leader, here[some], side="right")
    pair = np.repeat(some, last - first)
    place = np.arange(len(pair)) - np.repeat(np.cumsum(last - first) - (last - first), last - first) + np.repeat(first, last - first)
    row = members[order[place]]
    kept = apart(row, there[pair])
    yield row[kept], there[pair][kept], open_[pair][kept]


def _compare(length: int, similarity: float, bucket: int = BUCKET):
    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in ("key", "function", "i", "j")])
        names = ("key", "function", "i", "j", "before", "after", "lo_at", "hi_at", "first_side")
        column = {c: table[c].to_numpy() for c in names}
        lists = table["shingles"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        slices = Slices(lists.flatten().to_numpy(), sizes, column["before"], column["after"], length, similarity)
        new = np.ones(len(sizes), bool)
        new[1:] = np.any([column[c][1:] != column[c][:-1] for c in ("key", "function", "i", "j")], axis=0)
        group = np.cumsum(new)
        slices.hope = slices.hopeful(group)
        kept = np.flatnonzero(slices.hope.any(axis=1))
        slices, group = slices.taken(kept), np.unique(group[kept], return_inverse=True)[1] + 1
        table, column = table.select(["lo_doc", "hi_doc"]).take(pa.array(kept)), {c: x[kept] for c, x in column.items()}
        docs = pa.concat_arrays([table[c].combine_chunks() for c in ("lo_doc", "hi_doc")])
        lo, hi = np.split(docs.dictionary_encode().indices.to_numpy(), 2)
        # A class stands for its least and its greatest document: two classes are compared if these are not one document.
        apart = lambda x, y: (lo[x] != lo[y]) | (hi[x] != lo[y]) | (lo[x] != hi[y])
        # Rows of one pattern are compared with the one of the least document only, which stands for them all.
        pattern = slices.patterns(group)
        rank = np.lexsort((np.arange(len(lo)), lo, pattern))
        pattern = pattern[rank]
        opens = np.concatenate([[True], pattern[1:] != pattern[:-1]])[: len(rank)]
        stands = np.empty(len(rank), np.int64)
        stands[rank] = rank[np.flatnonzero(opens)][np.cumsum(opens) - 1] if len(rank) else 0
        members = np.flatnonzero(stands != np.arange(len(rank)))
        leaders = np.flatnonzero(stands == np.arange(len(rank)))
        together = apart(stands[members], members)
        found, ratio = slices.similarities(stands[members[together]], members[together])
        own = members[together][found]
        pieces = [(stands[own], own, ratio)]
        # The starts at which a pattern's rows are near each other.
        inner = np.zeros((len(rank), length), bool)
        np.logical_or.at(inner, stands[own], ratio > 0)
        size = np.bincount(group[leaders], minlength=group.max(initial=-1) + 1)
        large = size[group] > bucket
        between = []
        small, step = leaders[~large[leaders]], 1
        while step < len(small):
            x, y = small[:-step], small[step:]
            near = group[x] == group[y]
            if not near.any():
                break
            x, y = x[near], y[near]
            found, ratio = slices.similarities(x, y)
            between.append((x[found], y[found], ratio))
            step += 1
        # Leaders are in the groups' order.
        ends = np.cumsum(size)
        for g in np.flatnonzero(size > bucket):
            rows = leaders[ends[g] - size[g] : ends[g]]
            cross = column["i"][rows[0]] != column["j"][rows[0]]
            between += _forest(slices, rows, column["first_side"][rows], cross, lambda x, y: np.ones(len(y), bool))
        pieces += [(x[k], y[k], ratio[k]) for x, y, ratio in between for k in [apart(x, y)]]
        # Where two patterns are near but the rows of one are not near each other, each of its rows is linked to the other's leader.
        if between:
            x, y, ratio = map(np.concatenate, zip(*between))
            for here, there in ((x, y), (y, x)):
                pieces += list(_spread_links(here, there, ratio, inner, stands, members, apart))
        x, y, ratio = map(np.concatenate, zip(*pieces)) if pieces else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, length)))
        # Runs of verified starts.
        edge = np.diff(np.pad((ratio > 0).astype(np.int8), ((0, 0), (1, 1))), axis=1)
        pair, first = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1]
        flat = np.append(np.pad(ratio, ((0, 0), (0, 1))).ravel(), 0)
        bounds = np.stack([pair * (length + 1) + first, pair * (length + 1) + end], 1).ravel()
        least = np.minimum.reduceat(flat, bounds)[::2] if len(bounds) else np.zeros(0)
        x, y = x[pair], y[pair]
        high_x = (lo[x] == lo[y]) & (hi[x] != lo[y])
        high_y = (lo[x] == lo[y]) & ~high_x
        n, out = len(lo), {"function": pa.array(column["function"][x], pa.int8())}
        for name, z, high in (("x", x, high_x), ("y", y, high_y)):
            out[name] = docs.take(pa.array(z + n * high))
            at = np.where(high, column["hi_at"][z], column["lo_at"][z])
            out[f"{name}_at"] = pa.array(at, pa.int32())
        out |= {"lo": pa.array(first - length + 1, pa.int32()), "hi": pa.array(end - length, pa.int32()), "similarity": pa.array(least, pa.float64())}
        return pa.table(out)

    return compare


def _verified(known: DataFrame, windows: DataFrame, length: int, similarity: float) -> DataFrame:
    """x, y (documents), x_at, y_at (where their minima are), lo, hi (verified starts, counted from there), similarity."""
    kind = dict(known.dtypes)["doc_id"]
    mine = F.struct("doc_id", "at")
    classes = written(windows.groupBy(*CLASS).agg(F.min(mine).alias("lowest"), F.max(mine).alias("highest")), "classes")
    # The first hash function's classes hold, or are compared with, all equal passages.
    shared = classes.where("function = 0 and lowest.doc_id <> highest.doc_id")
    other = F.when(F.col("doc_id") == F.col("lowest.doc_id"), F.col("highest")).otherwise(F.col("lowest"))
    copies = windows.join(shared, list(CLASS)).withColumn("other", other).select(
        F.col("doc_id").alias("x"), F.col("at").alias("x_at"), F.col("other.doc_id").alias("y"), F.col("other.at").alias("y_at"),
        F.col("before").alias("lo"), F.col("after").alias("hi"), F.lit(1.0).alias("similarity"),
    )

    groups = classes.groupBy("key", "function").agg(F.count("*").alias("n"), F.min("lowest.doc_id").alias("a"), F.max("highest.doc_id").alias("b"))
    groups = written(groups.where("n > 1 and a <> b").select("key", "function", "n"), "groups")
    tasks = max(1, -(-(groups.agg(F.sum("n")).first()[0] or 0) // ROWS))
    compared = classes.join(groups, ["key", "function"]).select(
        *CLASS, "n", F.col("lowest.at").alias("lo_at"), F.col("highest.doc_id").alias("hi_doc"), F.col("highest.at").alias("hi_at"),
        F.col("lowest.doc_id").alias("doc_id"),
    )
    wanted = compared.groupBy("doc_id").agg(F.collect_list(F.struct(*CARRIED)).alias("wanted"))
    types = f"key long, function byte, before int, after int, content long, n long, lo_at int, hi_doc {kind}, hi_at int, lo_doc {kind}, shingles array<int>"
    filled = known.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(_contents(length), types)
    # A large group's class is in one block, and meets every block.
    blocks = F.when(F.col("n") > BUCKET, F.ceil(F.col("n") / BLOCK)).otherwise(1)
    own = F.pmod(F.xxhash64("content", "before", "after"), F.col("blocks"))
    meet = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(
        F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j"), (F.col("own") <= k).alias("first_side")
    ))
    dealt = filled.withColumn("blocks", blocks.cast("long")).withColumn("own", own).withColumn("m", F.explode(meet)).select(
        "*", "m.i", "m.j", "m.first_side"
    ).drop("m", "blocks", "own")
    # Pairs of blocks are tasks of their own, groups of one block share them.
    task = F.when(F.col("n") > BLOCK, F.xxhash64("key", "function", "i", "j")).otherwise(F.pmod(F.xxhash64("key", "function"), F.lit(tasks)))
    result = f"function byte, x {kind}, x_at int, y {kind}, y_at int, lo int, hi int, similarity double"
    near = written(dealt.withColumn("task", task).groupBy("task").applyInArrow(_compare(length, similarity, BUCKET), result), "near")
    # A class of one document may stand at several places of it.
    again = classes.where("lowest.doc_id = highest.doc_id and lowest.at <> highest.at").select(*CLASS, F.col("lowest.at").alias("least_at"))
    again = written(windows.join(again, list(CLASS)).where("at <> least_at").select("doc_id", "function", "least_at", "at"), "repeats")
    for side in ("x", "y"):
        there = again.select("function", F.col("doc_id").alias(side), F.col("least_at").alias(f"{side}_at"), F.col("at").alias("_at"))
        moved = near.join(there, ["function", side, f"{side}_at"]).withColumn(f"{side}_at", F.col("_at")).drop("_at")
        near = near.unionByName(moved)
    return near.drop("function").unionByName(copies)


def _opened(by: list[str], gap: int) -> Column:
    """1 for a row of lo, hi that starts more than `gap` behind all earlier ones of its group."""
    along = Window.partitionBy(*by).orderBy("lo", "hi")
    reached = F.max("hi").over(along.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce((F.col("lo") - reached > gap).cast("int"), F.lit(1))


def repeated_passages(docs: DataFrame, *, words: int = WORDS, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(links, passages) of near-duplicate passages of at least `words` words in different documents.

    links: a, b, a_start, b_start, n_words, similarity (the least one of its starts).
    passages: doc_id, start_word, n_words, least_doc_id (the least id that
    links lead to from the passage's document, itself included) per passage of
    a document: verified starts that overlap. Starts count words from 0.

    A null text has no passages, nor has one of fewer than `words` words. Rows
    of one id are one document; rows without id link to nothing. All starts
    that two windows of equal minimum share are verified. Copies are linked to
    their least document, and a group of more than `BUCKET` classes gives a
    forest: classes and starts with a partner are whole, but links do not list
    every pair of partners. Empty table: empty results.
    """
    length = words - SHINGLE + 1
    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    kind = dict(docs.dtypes)["doc_id"]
    windows = known.mapInArrow(_windows(length), f"key long, doc_id {kind}, function byte, at int, before int, after int, content long")
    # Minima that one document alone has are most of all; only the others' windows are kept.
    minima = known.mapInArrow(_minima(length), f"key long, doc_id {kind}")
    ends = minima.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select("key")
    windows = written(windows.join(ends, "key", "left_semi"), "windows")
    found = _verified(known, windows, length, similarity)
    # The lesser document is a.
    swap = F.col("x") > F.col("y")
    side = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    found = found.select(
        F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), (side("y_at", "x_at") - side("x_at", "y_at")).alias("shift"),
        (side("x_at", "y_at") + F.col("lo")).alias("lo"), (side("x_at", "y_at") + F.col("hi")).alias("hi"), "similarity",
    )
    # Different hash functions verify the same starts: stretches that touch are one.
    pair = ["a", "b", "shift"]
    along = Window.partitionBy(*pair).orderBy("lo", "hi")
    runs = found.groupBy(*pair, "lo", "hi").agg(F.min("similarity").alias("similarity")).withColumn("opens", _opened(pair, 1))
    runs = runs.withColumn("run", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*pair, "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("similarity").alias("similarity")).drop("run")
    runs = written(runs, "verified")
    links = runs.withColumn("opens", _opened(pair, words)).withColumn("run", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    links = links.groupBy(*pair, "run").agg(
        F.min("lo").alias("a_start"), (F.min("lo") + F.first("shift")).alias("b_start"), (F.max("hi") - F.min("lo") + words).alias("n_words"), F.min("similarity").alias("similarity")
    ).drop("shift", "run")

    spans = runs.select(F.col("a").alias("doc_id"), "lo", "hi")
    spans = spans.union(runs.select("b", F.col("lo") + F.col("shift"), F.col("hi") + F.col("shift")))
    # Equal ends at one place are one, so that a document which many others share has few rows.
    spans = spans.groupBy("doc_id", "lo").agg(F.max("hi").alias("hi"))
    by_start = Window.partitionBy("doc_id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, 0)
    passages = (
        spans.withColumn("opens", _opened(["doc_id"], words))
        .withColumn("passage", F.sum("opens").over(by_start))
        .groupBy("doc_id", "passage")
        .agg(F.min("lo").alias("start_word"), (F.max("hi") - F.min("lo") + words).cast("int").alias("n_words"))
        .drop("passage")
    )
    least = components.stars(runs.select("a", "b")).select(F.col("a").alias("doc_id"), F.col("b").alias("least_doc_id"))
    passages = passages.join(least, "doc_id", "left").withColumn("least_doc_id", F.coalesce("least_doc_id", "doc_id"))
    return links, passages


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(read(spark, folder, "documents"))[1]
