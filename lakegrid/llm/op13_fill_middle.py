"""Fill-in-the-middle transformation with a Fenwick tree over fixed text blocks.

A text is units: white space with the word after it, and white space at the end. Its bytes are cut
into blocks of BLOCK bytes; a Fenwick tree holds how many units and how many code points end in
each block. A cut after k units is found by binary lifting: the descent goes down the tree's powers
of two, keeps the blocks that hold less than k units in all, and reads the code points before the
cut's block on the way; only that one block is then searched for the boundary. A changed block
changes log(blocks) nodes, so a text can be edited and cut again without being counted anew.

Forms: plain leaves the text, psm puts prefix, suffix, middle, and spm suffix, prefix, middle, each
after its sentinel.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .shared import NOT_SPACE, read, slices, text_bytes

#: Bytes of a block.
BLOCK = 1024
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts so many are transformed, and of 100 of these so many as spm.
RATE, SPM, SEED = 50, 80, 42


class Blocks:
    """Fenwick tree over the blocks of one text: units and code points that end in them."""

    def __init__(self, raw: np.ndarray, block: int = BLOCK):
        self.raw, self.block = raw, block
        self.count = -(-len(raw) // block)
        starts = np.arange(0, len(raw), block)
        ends = unit_ends(raw)
        # a code point is counted where it begins
        points = (raw & 0xC0) != 0x80
        per = np.zeros((self.count, 2), np.int64)
        if self.count:
            per[:, 0] = np.add.reduceat(ends, starts, dtype=np.int64)
            per[:, 1] = np.add.reduceat(points, starts, dtype=np.int64)
        total = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(per, 0)))
        node = np.arange(1, self.count + 1)
        self.tree = np.concatenate((np.zeros((1, 2), np.int64), total[node] - total[node - (node & -node)]))
        self.units, self.points = (int(x) for x in total[-1])

    def changed(self, at: int, units: int, points: int) -> None:
        """Adds to what ends in block at."""
        at += 1
        while at <= self.count:
            self.tree[at] += units, points
            at += at & -at

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) where the first k units end."""
        if k <= 0:
            return 0, 0
        if k >= self.units:
            return len(self.raw), self.points
        at, before, points = 0, 0, 0
        step = 1 << (self.count.bit_length() - 1)
        while step:
            if at + step <= self.count and before + self.tree[at + step, 0] < k:
                at += step
                before += int(self.tree[at, 0])
                points += int(self.tree[at, 1])
            step >>= 1
        begin = at * self.block
        # the byte after the block tells whether a word ends with it
        local = self.raw[begin : begin + self.block + 1]
        ends = unit_ends(local)[: self.block] if len(local) > self.block else unit_ends(local)
        end = int(np.flatnonzero(ends)[k - before - 1]) + 1
        return begin + end, points + int(((local[:end] & 0xC0) != 0x80).sum())


def unit_ends(raw: np.ndarray) -> np.ndarray:
    """Whether a unit ends with each byte: a word's last byte, and the text's last byte."""
    inside = NOT_SPACE[raw]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    if len(ends):
        ends[-1] = True
    return ends


def drawn(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers from the hash of seed and doc_id (a null doc_id is the empty string)."""
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(x[:8], 16), int(x[8:16], 16), int(x[16:24], 16), int(x[24:32], 16)


def restored(form: str, output: bytes) -> bytes:
    """The text that gave the output, from form and output alone. Parts hold no sentinel, and no sentinel overlaps itself, so each one's first place after the last is its own."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    i = output.index(second, len(first))
    j = output.index(MIDDLE, i + len(second))
    a, b, middle = output[len(first) : i], output[i + len(second) : j], output[j + len(MIDDLE) :]
    return a + middle + b if form == "psm" else b + middle + a


def transformed_text(text: bytes, doc_id, rate: int = RATE, spm: int = SPM, seed: int = SEED):
    """(units, form, code points of prefix and middle or None, output)."""
    raw = np.frombuffer(text, np.uint8)
    blocks = Blocks(raw)
    n = blocks.units
    h1, h2, h3, h4 = drawn(doc_id, seed)
    if not text or h3 % 100 >= rate or PREFIX in text or SUFFIX in text or MIDDLE in text:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    (i, first), (j, second) = blocks.cut(low), blocks.cut(high)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    if h4 % 100 < spm:
        return n, "spm", first, second - first, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", first, second - first, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


FIELDS = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]


def _transform(batches, rate, spm, seed, digests):
    for part in slices(batches):
        raw, at = text_bytes(part.column("text"))
        data, ids, rows = raw.tobytes(), part.column("doc_id").to_pylist(), []
        for k, doc_id in enumerate(ids):
            *row, output = transformed_text(data[at[k] : at[k + 1]], doc_id, rate, spm, seed)
            # digests take the restored text from the output, not the text that went in
            rows.append((*row, hashlib.sha256(output).hexdigest(), hashlib.sha256(restored(row[1], output)).hexdigest()) if digests else (*row, output.decode()))
        fields = FIELDS[:4] + [("output_sha256", pa.string()), ("restored_sha256", pa.string())] if digests else FIELDS
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True))], names=["doc_id", *(n for n, _ in fields)])


def fill_in_middle(docs: DataFrame, rate: int = RATE, spm: int = SPM, seed: int = SEED, digests: bool = False) -> DataFrame:
    """Every text transformed.

    Per row of docs: doc_id, n (units), form (plain, psm, spm), prefix_chars and middle_chars (code
    points, null if plain) and output, or with digests its hash and the hash of the text restored from it.
    A null text is empty. Empty texts and texts that hold a sentinel stay plain. A null doc_id draws as the
    empty string. Equal draws give an empty middle. Texts are taken whole at any length; rows that repeat
    stay and are cut alike. Other columns are left out; an empty table gives an empty result.
    """
    kind = "doc_id long, n long, form string, prefix_chars long, middle_chars long, " + ("output_sha256 string, restored_sha256 string" if digests else "output string")
    return docs.select("doc_id", "text").mapInArrow(lambda it: _transform(it, rate, spm, seed, digests), kind)


def _restore(batches):
    for batch in batches:
        pairs = zip(batch.column("form").to_pylist(), batch.column("output").to_pylist(), strict=True)
        texts = [None if form is None or output is None else restored(form, output.encode()).decode() for form, output in pairs]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])


def fill_in_restored(outputs: DataFrame) -> DataFrame:
    """doc_id and text of what fill_in_middle returned, from form and output alone. A null form or output gives a null text."""
    return outputs.select("doc_id", "form", "output").mapInArrow(_restore, "doc_id long, text string")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(read(spark, sf_dir, "documents"), digests=True)
