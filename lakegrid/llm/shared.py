"""What several operators share: reading, shared scratch folders, and words of Arrow text as numpy arrays.

Every helper works on one Arrow slice of bounded size inside a Spark task; Spark does
the partitioning and shuffling around it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into arrays at a time; one longer document is a slice by itself.
SLICE_BYTES = 3 << 19


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the given folder. Makes this package importable in the Python workers of a local session."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset (tests), below a local temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, sort: list[str] | None = None) -> DataFrame:
    """The frame as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    spark, at = df.sparkSession, shared_folder(df.sparkSession)
    if sort:
        df = df.sortWithinPartitions(*sort)
    df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def fold(modulus: int):
    """crc32 of doc_id as text, modulo; a null doc_id counts as -1, in no held-out part."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus, F.lit(-1)).cast("int")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about size bytes of text, whole rows each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        each = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cut, total = 0, np.cumsum(each)
        while cut < batch.num_rows:
            base = total[cut - 1] if cut else 0
            end = max(cut + 1, int(np.searchsorted(total, base + size, "right")))
            yield batch.slice(cut, end - cut)
            cut = end


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, and the offset of each row (one more at the end). Null is empty."""
    array = pc.fill_null(array, "").cast(pa.large_string())
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of a word: all but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of a term: ASCII letters and digits, and all bytes of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_rng = np.random.RandomState(20240229)
BYTE_CODE = _rng.randint(0, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_INVERSE = np.uint64(pow(int(STEP), -1, 2**64))
PLACE = _rng.randint(0, 2**62, 8).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of STEP and of its inverse, n of each or more."""
    if len(_powers[0]) < n:
        n = max(n, SLICE_BYTES + 1)
        for k, step in enumerate((STEP, STEP_INVERSE)):
            run = np.full(n, step, np.uint64)
            run[0] = 1
            _powers[k] = np.cumprod(run)
    return _powers[0], _powers[1]


def words(raw: np.ndarray, at: np.ndarray, inside: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each maximal run of inside bytes, and its row. Rows part words."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    mask = inside[raw]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    edge = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < n)]
    first[edge] = mask[edge]
    last[edge - 1] = mask[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def word_hashes(lowered: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes from running sums, then mixed with its length."""
    power, inverse = powers_to(len(lowered) + 1)
    run = np.zeros(len(lowered) + 1, np.uint64)
    np.cumsum(BYTE_CODE[lowered] * power[: len(lowered)], out=run[1:])
    return mix((run[end] - run[start]) * inverse[start] + (end - start).astype(np.uint64) * PLACE[7])


def window_hashes(h: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every window of that many words that lies in one row; the first word's index is the window's."""
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(h) - width + 1
    total = h[:n] * PLACE[0]
    for j in range(1, width):
        total += h[j : j + n] * PLACE[j]
    keep = np.flatnonzero(row[:n] == row[width - 1 :])
    return mix(total[keep]), keep


def distinct_sets(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash) pairs, ascending."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], row[new]


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles as (hash, row), ascending by row then hash: windows of lower-cased words; a text of fewer words gives its whole sequence as one, a text without words nothing."""
    raw, at = text_bytes(column)
    low = LOWER[raw]
    start, end, row = words(low, at)
    h = word_hashes(low, start, end)
    shingle, first = window_hashes(h, row, width)
    srow = row[first]
    count = np.bincount(row, minlength=len(column))
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        begin = np.searchsorted(row, short)
        total = np.zeros(len(short), np.uint64)
        for j in range(width - 1):
            has = count[short] > j
            total[has] += h[begin[has] + j] * PLACE[j]
        shingle = np.concatenate((shingle, mix(total + count[short].astype(np.uint64))))
        srow = np.concatenate((srow, short))
    return distinct_sets(shingle, srow)
