"""Benchmark decontamination by greedy string tiling.

Documents and test items share seeds: equal windows of MIN_MATCH terms, found by running
Karp-Rabin hashes. Between a document and an item that share a seed, the longest match of
terms that no tile covers yet becomes a tile, again and again, until none of MIN_MATCH
terms is left. Tiles may lie in any order, so passages that were reordered are caught. A
document leaks an item whose tiles cover at least MIN_COVERAGE of it. Tiles cover no more
than all shared seeds together, so pairs whose seeds don't cover enough are left without
tiling. An item of fewer terms has no seed; a document leaks it that has just its terms.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ALNUM, LOWER, read, slices, text_bytes, window_hashes, word_hashes, words

MIN_MATCH, MIN_COVERAGE = 5, 0.5
#: Bytes of test text that are sent to the tasks at a time; more come in further blocks, each against all documents.
BLOCK_BYTES = 16 << 20
#: Pairs of equal windows of a document and an item that are held at a time, about; beyond them diagonals are walked.
MATCHES = 1 << 20
#: Places of seeds in items that a task looks up at a time; one document's may be more.
PLACES = 1 << 21


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every term: lower-cased runs of ASCII letters and digits and of bytes of other characters."""
    raw, at = text_bytes(column)
    low = LOWER[raw]
    start, end, row = words(low, at, ALNUM)
    return word_hashes(low, start, end), row


def tiles(doc: np.ndarray, item: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (start in doc, start in item, length) from the pairs of equal windows of ``least`` terms.

    Windows that follow each other on one diagonal are one maximal match. The longest match
    is taken first (ties: lowest start in doc, then item); a match that earlier tiles cut is
    tried again with what is left of it.
    """
    i, j = pairs
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    new = np.ones(len(i), bool)
    new[1:] = (np.diff(i) != 1) | (np.diff(j) != 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(i))) + least - 1
    out: list[tuple[int, int, int]] = []
    _take((length, i[first], j[first]), np.zeros(len(doc), bool), np.zeros(len(item), bool), least, out)
    return out


def tiles_of_repeats(doc: np.ndarray, item: np.ndarray, least: int = MIN_MATCH, most: int = MATCHES) -> list[tuple[int, int, int]]:
    """The same tiles without the pairs of windows, which are too many where terms repeat: the diagonals are walked one by one, in passes.

    A pass first counts the lengths of all matches of free terms, then takes those from the
    least length on of which there are about most, longest first; shorter ones wait for the
    next pass, as does what is left of matches that tiles cut.
    """
    used_d, used_i = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    out: list[tuple[int, int, int]] = []

    def walked(shortest: int):
        """Length, start in doc and in item of the maximal matches of free terms, a diagonal at a time."""
        free_d, free_i = ~used_d, ~used_i
        for d in range(least - len(item), len(doc) - least + 1):
            a, b = max(0, d), max(0, -d)
            n = min(len(doc) - a, len(item) - b)
            same = (doc[a : a + n] == item[b : b + n]) & free_d[a : a + n] & free_i[b : b + n]
            edge = np.flatnonzero(same[1:] != same[:-1]) + 1
            edge = np.concatenate((([0] if same[0] else []), edge, ([n] if same[-1] else []))).astype(np.int64)
            start, size = edge[::2], edge[1::2] - edge[::2]
            keep = size >= shortest
            if keep.any():
                yield size[keep], start[keep] + a, start[keep] + b

    while (~used_i).sum() >= least and (~used_d).sum() >= least:
        lengths = np.zeros(min(len(doc), len(item)) + 1, np.int64)
        for size, _, _ in walked(least):
            np.add.at(lengths, size, 1)
        found = np.flatnonzero(lengths)
        if not len(found):
            break
        beyond = np.cumsum(lengths[::-1])[::-1]
        shortest = int(min(found[-1], found[beyond[found] <= max(most, beyond[found[-1]])][0]))
        parts = list(walked(shortest))
        _take(tuple(np.concatenate(x) for x in zip(*parts, strict=True)), used_d, used_i, shortest, out)
    return out


def _take(matches, used_d: np.ndarray, used_i: np.ndarray, least: int, out: list) -> None:
    """Takes matches as tiles, longest first, and marks their terms; what is left of cut ones is tried again from least terms on."""
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(*matches, strict=True)]
    heapq.heapify(heap)
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = ~(used_d[a : a + n] | used_i[b : b + n])
        if free.all():
            used_d[a : a + n] = used_i[b : b + n] = True
            out.append((a, b, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
        for s, e in zip(edge[::2], edge[1::2], strict=True):
            if e - s >= least:
                heapq.heappush(heap, (-int(e - s), a + int(s), b + int(s)))


def _runs(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each run of n, one after the other."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Items:
    """Terms and sorted seeds of a block of test items."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = ids
        self.terms, row = terms(pa.array(texts, pa.string()))
        self.at = np.searchsorted(row, np.arange(len(ids) + 1))
        self.size = np.diff(self.at)
        seed, first = window_hashes(self.terms, row, MIN_MATCH)
        self.item_seeds, self.item_first = seed, np.searchsorted(row[first], np.arange(len(ids) + 1))
        order = np.argsort(seed, kind="stable")
        self.seed, self.place, self.row = seed[order], first[order], row[first][order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.seed & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.short: dict[bytes, list[int]] = {}
        for i in np.flatnonzero((self.size > 0) & (self.size < MIN_MATCH)):
            self.short.setdefault(self.terms[self.at[i] : self.at[i + 1]].tobytes(), []).append(int(i))

    def candidates(self, seed: np.ndarray, row: np.ndarray, coverage: float) -> list[tuple[int, int]]:
        """(row, item) pairs whose shared seeds together cover enough of the item, from the distinct (row, seed) pairs, ascending by row."""
        lo, hi = np.searchsorted(self.seed, seed, "left"), np.searchsorted(self.seed, seed, "right")
        found = np.flatnonzero(hi > lo)
        lo, n, row = lo[found], (hi - lo)[found], row[found]
        edge = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1], [True]))) if len(row) else np.zeros(1, np.int64)
        total, out, cut = np.concatenate(([0], np.cumsum(n))), [], 0
        while cut < len(edge) - 1:  # whole rows
            end = max(cut + 1, int(np.searchsorted(total[edge], total[edge[cut]] + PLACES, "right")) - 1)
            a, b = edge[cut], edge[end]
            k = _runs(lo[a:b], n[a:b])
            r, item, place = np.repeat(row[a:b], n[a:b]), self.row[k], self.place[k]
            order = np.lexsort((place, item, r))
            r, item, place = r[order], item[order], place[order]
            first = np.concatenate(([True], (r[1:] != r[:-1]) | (item[1:] != item[:-1])))
            new = np.full(len(r), MIN_MATCH)
            new[1:] = np.where(first[1:], MIN_MATCH, np.minimum(MIN_MATCH, place[1:] - place[:-1]))
            start = np.flatnonzero(first)
            keep = start[np.add.reduceat(new, start) >= coverage * self.size[item[start]]]
            out += zip(r[keep].tolist(), item[keep].tolist(), strict=True)
            cut = end
        return out

    def matches(self, column: pa.Array, coverage: float):
        """(row, item index, tiles) of every document and item whose shared seeds cover enough."""
        h, row = terms(column)
        start = np.searchsorted(row, np.arange(len(column) + 1))
        if self.short:
            n = np.diff(start)
            for r in np.flatnonzero((n > 0) & (n < MIN_MATCH)).tolist():
                for t in self.short.get(h[start[r] : start[r + 1]].tobytes(), ()):
                    yield r, t, [(0, 0, int(n[r]))]
        seed, first = window_hashes(h, row, MIN_MATCH)
        hit = np.flatnonzero(self.filter[(seed & np.uint64((1 << 20) - 1)).astype(np.int64)])
        seed, first = seed[hit], first[hit]
        at, order = row[first], np.lexsort((seed, row[first]))
        seed, first, at = seed[order], first[order], at[order]  # by document, then seed
        new = np.ones(len(seed), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (at[1:] != at[:-1])
        for r, t in self.candidates(seed[new], at[new], coverage):
            a, b = np.searchsorted(at, r), np.searchsorted(at, r, "right")
            wanted = self.item_seeds[self.item_first[t] : self.item_first[t + 1]]
            lo, hi = np.searchsorted(seed[a:b], wanted, "left"), np.searchsorted(seed[a:b], wanted, "right")
            if int((hi - lo).sum()) > MATCHES:
                yield r, t, tiles_of_repeats(h[start[r] : start[r + 1]], self.terms[self.at[t] : self.at[t + 1]])
                continue
            j = np.repeat(np.arange(len(wanted)), hi - lo)
            i = first[a:b][_runs(lo, hi - lo)] - start[r]
            doc, item = h[start[r] : start[r + 1]], self.terms[self.at[t] : self.at[t + 1]]
            same = np.ones(len(i), bool)
            for k in range(MIN_MATCH):  # equal seeds may yet be of other terms
                same &= doc[i + k] == item[j + k]
            if same.any():
                yield r, t, tiles(doc, item, (i[same], j[same]))


SCHEMA = "doc_id long, item_id long, n_tiles int, longest int, covered int, item_terms int, coverage double"


def _tiled(batches, sent, coverage: float):
    items = Items(*sent.value)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    for part in slices(batches):
        docs, rows = part.column("doc_id").to_pylist(), []
        for r, t, found in items.matches(part.column("text"), coverage):
            n, covered = int(items.at[t + 1] - items.at[t]), sum(x[2] for x in found)
            if covered >= coverage * n:
                rows.append((docs[r], items.ids[t], len(found), max(x[2] for x in found), covered, n, covered / n))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = MIN_COVERAGE) -> DataFrame:
    """Document and test item pairs where the document's tiles cover the item.

    Columns: doc_id, item_id, n_tiles, longest, covered (terms of the item in tiles),
    item_terms, coverage. Null and empty texts hold no term, and match nothing. Items of fewer
    than MIN_MATCH terms match documents of just these terms. Test items come to the tasks in
    blocks of BLOCK_BYTES at most (one larger item alone), so that what is broadcast has a
    bound whatever their number. Texts of any length are read whole. Repeated rows of either
    side give repeated pairs; a null doc_id or item_id stays null; other columns are not read.
    """
    spark = docs.sparkSession
    sized = benchmark.select("item_id", "text").filter("text is not null")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(-(-total // (BLOCK_BYTES // 2))) or 1
    out = None
    for k in range(blocks):
        block = sized if blocks == 1 else sized.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = sorted(((r.item_id, r.text) for r in block.collect()), key=lambda r: (r[0] is None, r))
        sent = spark.sparkContext.broadcast(([r[0] for r in rows], [r[1] for r in rows]))
        found = docs.select("doc_id", "text").mapInArrow(lambda it, sent=sent: _tiled(it, sent, coverage), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
