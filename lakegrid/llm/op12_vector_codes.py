"""Vector code compression: a codebook for each of four parts, searched by Orchard's algorithm.

Components become integers, vectors four parts, and each part the number of its codebook's
nearest entry; rounds of assigning and averaging fit the codebooks. Nearest entries are found by
Orchard's search, exactly: every entry keeps the list of all entries, nearest first. A query walks the list of
its current entry; an entry that is nearer makes its own list the one to walk; visited entries
are marked and never compared again; the walk ends at an entry beyond twice the query's
current distance, as by the triangle inequality all that follow are farther away from the query.

Tasks send the sums and counts of each entry's parts, already added up, so that a round moves a
few rows from every task whatever it holds. Only the codebooks (PARTS * ENTRIES rows, of fixed
number) pass through the driver.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read, written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries of a list that a query compares at a time, and queries searched at a time.
PORTION, QUERIES = 16, 2048
#: A label of so many rows is joined by broadcast; at most one in HOT rows is such a label.
HOT = 1_000_000


def largest(length: int) -> int:
    """Largest magnitude of a component for which squared distances of parts of that length fit a long."""
    return isqrt((2**63 - 1) // max(length, 1)) // 2


class Orchard:
    """Exact nearest entry of a codebook; of equal distances the lower index."""

    def __init__(self, book: np.ndarray):
        self.book = book
        apart = np.empty((len(book), len(book)), np.int64)
        for k, entry in enumerate(book):
            apart[k] = ((book - entry) ** 2).sum(1)
        self.lists = np.argsort(apart, 1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, 1)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each query's nearest entry."""
        out = [self._some(queries[i : i + QUERIES]) for i in range(0, len(queries), QUERIES)]
        return (np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _some(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, m = len(queries), len(self.book)
        current, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        distance = ((queries - self.book[0]) ** 2).sum(1)
        visited = np.zeros((n, m), bool)
        visited[:, 0] = True
        active = np.arange(n)
        while len(active):
            at = place[active][:, None] + np.arange(PORTION)
            inside = at < m
            at = np.minimum(at, m - 1)
            entry = self.lists[current[active][:, None], at]
            # twice the distance is four times its square; entries just at that bound may still tie
            near = inside & (-(-self.apart[current[active][:, None], at] // 4) <= distance[active][:, None])
            row, column = np.nonzero(near & ~visited[active[:, None], entry])
            query, other = active[row], entry[row, column]
            visited[query, other] = True
            reached = ((queries[query] - self.book[other]) ** 2).sum(1)
            # of the portion's entries the nearest, lower index first, if it is nearer than the current one
            order = np.lexsort((other, reached, query))
            query, other, reached = query[order], other[order], reached[order]
            first = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, np.int64)
            query, other, reached = query[first], other[first], reached[first]
            better = (reached < distance[query]) | ((reached == distance[query]) & (other < current[query]))
            place[active] += PORTION
            jump = query[better]
            current[jump], distance[jump], place[jump] = other[better], reached[better], 0
            ended = ~near[:, -1]
            moved = np.zeros(n, bool)
            moved[jump] = True
            active = active[~ended | moved[active]]
        return current, distance


def parts_of(length: int) -> list[slice]:
    """Places of the four consecutive parts, equal if length is a multiple of four."""
    return [slice(length * k // PARTS, length * (k + 1) // PARTS) for k in range(PARTS)]


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def _summed(batches, books, length):
    """(part, entry, n, sums) of a task's rows."""
    places = parts_of(length)
    search = [Orchard(b) for b in books.value]
    counts = [np.zeros(len(b), np.int64) for b in books.value]
    sums = [np.zeros(b.shape, np.int64) for b in books.value]
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch, length)
            for k, place in enumerate(places):
                code, _ = search[k].nearest(x[:, place])
                counts[k] += np.bincount(code, minlength=len(counts[k]))
                order = np.argsort(code, kind="stable")
                first = np.flatnonzero(np.diff(code[order], prepend=-1))
                sums[k][code[order[first]]] += np.add.reduceat(x[order, place], first)
    for k in range(PARTS):
        used = np.flatnonzero(counts[k])
        lists = pa.array([row.tolist() for row in sums[k][used]], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k), pa.int32()), pa.array(used, pa.int32()), pa.array(counts[k][used]), lists], names=["part", "entry", "n", "sums"])


def _coded(batches, books, length):
    """vec_id, code, error and label of a task's rows."""
    places = parts_of(length)
    search = [Orchard(b) for b in books.value]
    digits = np.array([f"{k:02x}" for k in range(ENTRIES)])
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch, length)
            found = [search[k].nearest(x[:, place]) for k, place in enumerate(places)]
            code = digits[found[0][0]]
            for other, _ in found[1:]:
                code = np.char.add(code, digits[other])
            # distances of four parts may sum beyond a long where one doesn't: such an error is null
            exact = np.sum([d.astype(np.float64) for _, d in found], 0) < 2.0**63
            error = np.where(exact, np.sum([d for _, d in found], 0), 0)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(code), pa.array(error, pa.int64(), mask=~exact), batch.column("label")], names=["vec_id", "code", "error", "label"])


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label and x (integer components) of the rows whose vector is whole and finite and as long as that of the smallest such vec_id."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = vectors.filter(F.col("embedding").isNotNull() & ~bad)
    length = kept.orderBy(F.col("vec_id").asc_nulls_last(), F.size("embedding")).select(F.size("embedding").alias("n")).first()
    length = length.n if length else 0
    most = float(largest(-(-length // PARTS)))
    whole = F.transform(x, lambda v: F.floor(F.greatest(F.lit(-most / SCALE), F.least(F.lit(most / SCALE), v)) * SCALE))
    return kept.filter(F.size("embedding") == length).select("vec_id", "label", whole.alias("x"))


def fitted(kept: DataFrame, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks of kept (vec_id, x) after the rounds, one integer matrix a part."""
    spark = kept.sparkSession
    start = [r.x for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()]
    length = len(start[0]) if start else 0
    matrix = np.array(start, np.int64).reshape(len(start), length)
    books = [matrix[:, place].copy() for place in parts_of(length)]
    for _ in range(rounds if length else 0):
        sent = spark.sparkContext.broadcast(books)
        parts = kept.mapInArrow(lambda it, sent=sent: _summed(it, sent, length), "part int, entry int, n long, sums array<long>")
        width = max(b.shape[1] for b in books)
        sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
        books = [b.copy() for b in books]
        for row in parts.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # PARTS * ENTRIES rows at most
            books[row.part][row.entry] = [row[f"s{i}"] // row.n for i in range(books[row.part].shape[1])]
    return books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel()).encode()).hexdigest()


def compressed(vectors: DataFrame) -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks) of vectors (vec_id, embedding, label).

    Codes: per kept row vec_id, code, error, label_error, codebooks_sha256. Rows of a null vector
    or of one with null, NaN or infinite components are dropped, as are rows of another length than
    that of the smallest kept vec_id; a length that isn't a multiple of four gives
    parts that differ by one. Components are taken exactly up to a magnitude of about 2^18 (the largest
    whose squared distances fit a long) and stand at that bound beyond it; an error or sum beyond a
    long is null. Rows that repeat stay; equal vec_ids start the codebooks in the order of their
    components, a null vec_id last. Fewer rows than ENTRIES give as many entries. Null labels are one
    group. Other columns are left out; an empty table gives an empty result.
    """
    kept = written(integers(vectors))
    books = fitted(kept)
    spark, length = kept.sparkSession, sum(b.shape[1] for b in books)
    sent = spark.sparkContext.broadcast(books)
    kind = f"vec_id long, code string, error long, label {kept.schema['label'].dataType.simpleString()}"
    coded = written(kept.select("vec_id", "label", "x").mapInArrow(lambda it: _coded(it, sent, length), kind))
    sums = written(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("rows"), F.count("error").alias("whole")).withColumn("label_error", F.when(F.col("rows") == F.col("whole"), F.col("label_error"))))
    hot = F.broadcast(sums.filter(F.col("rows") >= HOT))
    same = coded.label.eqNullSafe
    apart = coded.join(hot, same(hot.label)).select("vec_id", "code", "error", "label_error")
    rest = sums.filter(F.col("rows") < HOT)
    joined = coded.join(rest, same(rest.label)).select("vec_id", "code", "error", "label_error").union(apart)
    return joined.withColumn("codebooks_sha256", F.lit(codebooks_sha256(books))), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(read(spark, sf_dir, "embeddings"))[0]
