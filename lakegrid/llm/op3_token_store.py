"""Token ids in a content-addressed store.

Encoding makes one id stream per document. A rolling hash over the ids cuts it into chunks
where the hash has chosen bits zero, so that equal passages give equal chunks wherever they
stand. The store has three tables, all Parquet:

    streams   kind=chunk: key (the SHA-256 hash of the ids), ids (little-endian 16- or
              32-bit), each once; kind=recipe: the recipes as encoded, not in order
    recipes   doc_id, n_tokens, hashes and lengths of its chunks in order, root, nth; files
              in ascending doc_id order, rows within them too
    manifest  part, first and last doc_id, documents, tokens, root over its documents' roots

Roots are Merkle roots; ``verify`` recomputes them from the files alone.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import mix, powers_to, read, shared_folder, slices, text_bytes, written

VOCABULARY, END = "byte_bpe_50k.json", 0
#: Ids of a chunk: at least, on average beyond that, at most; ids the rolling hash looks back on.
LEAST, MEAN, MOST, BACK = 64, 256, 1024, 12
#: Bytes of text that a task encodes at a time; one longer document is a slice by itself.
ENCODED_BYTES = 4 << 20
#: Pieces whose ids a task keeps; more start a new table.
KEPT_PIECES = 1_000_000
#: Pieces that go to the library as one text.
JOINED = 256

#: What a byte belongs to: other marks, letters, digits, white space. Two-byte characters of the leads listed are letters, but for the signs of multiplication and division.
OTHER, LETTER, DIGIT, WHITE = range(4)
KIND = np.full(256, OTHER, np.uint8)
KIND[65:91] = KIND[97:123] = KIND[128:] = LETTER
KIND[48:58] = DIGIT
KIND[[9, 10, 11, 12, 13, 32]] = WHITE
#: Bytes of texts whose pieces are found here: printable ASCII, white space, letters of Latin, Cyrillic and the common Han characters (by lead byte; continuation bytes follow their lead).
KNOWN = np.zeros(256, bool)
KNOWN[32:127] = KNOWN[9:14] = KNOWN[128:192] = True
KNOWN[[0xC3, *range(0xC4, 0xCA), 0xD0, 0xD1, *range(0xE5, 0xE9)]] = True


def piece_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the vocabulary's pattern starts a piece, in rows of KNOWN bytes.

    A piece is a run of letters, digits or marks with one space before it if there is one;
    white space is a piece up to the last character before such a run, which stands alone
    if it is no space; an apostrophe that starts a piece takes the ending of a contraction.
    """
    kind = KIND[raw]
    row = np.zeros(len(raw) + 3, bool)
    row[at[:-1]] = True
    row[len(raw) :] = True
    new = row.copy()
    new[1 : len(raw)] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(new[: len(raw)] & ~row[: len(raw)] & (kind != WHITE))
    run = run[kind[run - 1] == WHITE]
    new[run - 1] = True
    new[run] = raw[run - 1] != 32
    short = np.flatnonzero(raw == 39)
    if len(short):
        after = np.concatenate((raw, np.zeros(3, np.uint8)))
        short = short[new[short] & ~row[short + 1] & (KIND[after[short + 1]] == LETTER)]
        one, two = after[short + 1], np.where(row[short + 2], 0, after[short + 2])
        single = np.isin(one, list(b"stmd"))
        double = (one == 114) & (two == 101) | (one == 118) & (two == 101) | (one == 108) & (two == 108)
        new[short[single | double] + 1] = False
        new[short[single] + 2] = True
        new[short[double] + 3] = True
    return np.flatnonzero(new[: len(raw)])


def _values(array: pa.LargeBinaryArray) -> list[bytes]:
    """The strings of an array without offset or nulls."""
    _, offsets, data = array.buffers()
    ends, data = np.frombuffer(offsets, np.int64)[: len(array) + 1].tolist(), data.to_pybytes()
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


class Encoder:
    """The library's encoding of texts, by pieces whose ids are kept.

    The vocabulary's pattern cuts a text into pieces that are encoded one by one, so equal
    pieces have equal ids. Pieces are found in all texts of a slice at once, and only those
    new to the task go to the library, many at a time; a token's bytes tell which piece it is
    of. Texts with other characters or special strings, or any text of a vocabulary with
    another pattern, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        with open(path) as f:
            spec = json.load(f)
        before = spec["pre_tokenizer"] or {}
        self.cut = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not spec["normalizer"]
        self.special = [np.frombuffer(t["content"].encode(), np.uint8)[:2] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.size = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.size[i] = len(token)  # a character of a byte-level token is a byte; special strings are ASCII
        self.clear()

    def clear(self) -> None:
        """No piece is known; piece i has the ids first[i] to first[i + 1] of flat."""
        self.place: dict[bytes, int] = {}
        self.flat, self.first = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]

    def learn(self, pieces: list[bytes]) -> None:
        # pieces that begin with one space can follow each other in one text; others are given as pieces
        spaced = [p for p in pieces if p[0] == 32 and len(p) > 1 and p[1] > 32]
        others = [p for p in pieces if not (p[0] == 32 and len(p) > 1 and p[1] > 32)]
        joined = self.library.encode_batch_fast([b"".join(spaced[i : i + JOINED]).decode() for i in range(0, len(spaced), JOINED)], add_special_tokens=False)
        joined += self.library.encode_batch_fast([[p.decode() for p in others[i : i + JOINED]] for i in range(0, len(others), JOINED)], is_pretokenized=True, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, "<u4") for e in joined])
        ends = np.concatenate(([0], np.cumsum(self.size[ids])))
        cut = np.searchsorted(ends, np.cumsum([len(p) for p in spaced + others]))
        total = int(self.first[-1][-1])
        self.place.update(zip(spaced + others, range(len(self.place), len(self.place) + len(pieces)), strict=True))
        self.flat.append(ids)
        self.first.append(cut + total)

    def _whole_rows(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether each row goes to the library whole."""
        if not self.cut:
            return np.ones(len(at) - 1, bool)
        bad = ~KNOWN[raw]
        bad[:-1] |= (raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7))
        for s in self.special:
            bad[:-1] |= (raw[:-1] == s[0]) & (raw[1:] == s[-1])
        out = np.zeros(len(at) - 1, bool)
        out[np.searchsorted(at, np.flatnonzero(bad), "right") - 1] = True
        return out

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, END after each, and where each text's begin (one more at the end)."""
        raw, at = text_bytes(column)
        size = np.diff(at)
        whole = self._whole_rows(raw, at) & (size > 0)
        if whole.any():
            raw = raw[np.repeat(~whole, size)]
            at = np.concatenate(([0], np.cumsum(np.where(whole, 0, size))))
        count, ids = np.zeros(len(size), np.int64), np.zeros(0, "<u4")
        if len(raw):
            start = piece_starts(raw, at)
            offsets = pa.py_buffer(np.append(start, len(raw)).astype(np.int64))
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, offsets, pa.py_buffer(raw)]).dictionary_encode()
            pieces = _values(words.dictionary)
            if len(self.place) + len(pieces) > KEPT_PIECES:
                self.clear()
            which = list(map(self.place.get, pieces))
            if new := [p for p, k in zip(pieces, which, strict=True) if k is None]:
                self.learn(new)
                which = list(map(self.place.get, pieces))
            if len(self.flat) > 1:
                self.flat, self.first = [np.concatenate(self.flat)], [np.concatenate(self.first)]
            flat, first = self.flat[0], self.first[0]
            which = np.array(which)[words.indices.to_numpy()]
            n = first[which + 1] - first[which]
            end = np.cumsum(n)
            ids = flat[np.repeat(first[which] - end + n, n) + np.arange(int(end[-1]))]
            upto = np.concatenate(([0], end))[np.searchsorted(start, at)]
            count = np.diff(upto)
        encoded = [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(column.filter(pa.array(whole)).to_pylist(), add_special_tokens=False)] if whole.any() else []
        count[whole] = [len(e) for e in encoded]
        begin = np.concatenate(([0], np.cumsum(count + 1)))
        out = np.full(int(begin[-1]), END, "<u4")
        cut = np.where(whole, 0, count)
        out[np.repeat(begin[:-1] - (np.cumsum(cut) - cut), cut) + np.arange(len(ids))] = ids
        for i, e in zip(np.flatnonzero(whole), encoded, strict=True):
            out[begin[i] : begin[i] + len(e)] = e
        return out, begin


#: A number of 64 bits for each id below 2^16.
ID_CODE = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places after ids where the rolling hash of the last BACK ids of their stream is 0 modulo MEAN, for streams that begin at each of at (one more at the end)."""
    n = np.diff(at)
    # zeros between streams, so that none sees another
    place = np.arange(len(ids)) + np.repeat(np.arange(1, len(n) + 1) * BACK, n)
    wide = np.zeros(len(ids) + (len(n) + 1) * BACK, np.uint64)
    wide[place] = ID_CODE[ids] if len(ids) and ids.max() < len(ID_CODE) else mix(ids.astype(np.uint64) + np.uint64(1))
    power, inverse = powers_to(len(wide) + 1)
    run = np.cumsum(wide * power[: len(wide)])
    h = (run[place] - run[place - BACK]) * inverse[place]
    return np.flatnonzero((h >> np.uint64(32)) % np.uint64(MEAN) == 0) + 1


def chunk_ends(found: list[int], n: int) -> list[int]:
    """Ends (exclusive) of the chunks of a stream of n ids: at the cuts found, at least LEAST and at most MOST ids apart."""
    ends, at = [], 0
    for e in found:
        while e - at > MOST:
            at += MOST
            ends.append(at)
        if e - at >= LEAST:
            at = e
            ends.append(at)
    while n - at > MOST:
        at += MOST
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def merkle(hashes: list[bytes]) -> bytes:
    """Root over the hashes in order; an odd last node goes up as it is."""
    if not hashes:
        return hashlib.sha256(b"").digest()
    level = list(hashes)
    while len(level) > 1:
        level = [hashlib.sha256(b"\x01" + b"".join(level[i : i + 2])).digest() if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


STAGED = "kind string, key binary, ids binary, doc_id long, n_tokens long, hashes array<binary>, lengths array<int>, root binary"


def _chunked(batches, path: str):
    """Per document one row with its recipe, and per chunk new to the task one with its ids. The key is a chunk's hash, and deals recipes evenly."""
    encode = encoder(path).encode
    seen: set[bytes] = set()
    done = 0
    for part in slices(batches, size=ENCODED_BYTES):
        flat, at = encode(part.column("text"))
        found = cuts(flat, at)
        near = np.searchsorted(found, at, "right").tolist()
        wide, narrow, big = flat.tobytes(), flat.astype("<u2").tobytes(), int(flat.max()) > 65535
        tokens, hashes, lengths, roots, keys, new = np.diff(at).tolist(), [], [], [], [], {}
        found, at = found.tolist(), at.tolist()
        for i, n in enumerate(tokens):
            base = at[i]
            begin, mine, sizes = base, [], []
            for end in chunk_ends([x - base for x in found[near[i] : near[i + 1]]], n):
                end += base
                raw = wide[4 * begin : 4 * end]
                digest = hashlib.sha256(raw).digest()
                if digest not in seen:
                    seen.add(digest)
                    new[digest] = raw + b"\x00" if big and flat[begin:end].max() > 65535 else narrow[2 * begin : 2 * end]
                mine.append(digest)
                sizes.append(end - begin)
                begin = end
            hashes.append(mine)
            lengths.append(sizes)
            roots.append(merkle(mine))
            keys.append(roots[-1][:8] + done.to_bytes(6, "little"))
            done += 1
        if len(seen) > 2_000_000:
            seen.clear()
        n, k = len(tokens), len(new)
        yield pa.RecordBatch.from_arrays([
            pa.array(["recipe"] * n + ["chunk"] * k), pa.array(keys + list(new), pa.binary()), pa.array([None] * n + list(new.values()), pa.binary()), pa.concat_arrays([part.column("doc_id").cast(pa.int64()), pa.nulls(k, pa.int64())]), pa.array(tokens + [None] * k, pa.int64()),
            pa.array(hashes + [None] * k, pa.list_(pa.binary())), pa.array(lengths + [None] * k, pa.list_(pa.int32())), pa.array(roots + [None] * k, pa.binary()),
        ], names=[c.split()[0] for c in STAGED.split(", ")])


def _widened(raw: bytes) -> bytes:
    """Stored ids as little-endian unsigned 32-bit; an odd length marks ids stored so."""
    return raw[:-1] if len(raw) % 2 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()


#: Documents of a block of the manifest.
MANIFEST_BLOCK = 100_000


def write_store(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Encodes every text (null: empty), appends END to each, and writes the three tables below folder.

    A null doc_id sorts first. Repeated rows are documents of their own with the same chunks.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text").mapInArrow(lambda it: _chunked(it, path), STAGED)
    # one pass over the texts and one shuffle: chunks meet by their hash, the first of each stays
    once = rows.withColumn("nth", F.row_number().over(Window.partitionBy("kind", "key").orderBy("kind"))).filter("nth = 1 or kind = 'recipe'").drop("nth")
    once.write.partitionBy("kind").option("compression", "zstd").parquet(f"{folder}/streams")
    recipes = spark.read.schema(STAGED).parquet(f"{folder}/streams").filter("kind = 'recipe'").select("doc_id", "n_tokens", "hashes", "lengths", "root", "key")
    ordered = recipes.repartitionByRange("doc_id", "key").sortWithinPartitions("doc_id", "key").drop("key").withColumn("nth", F.monotonically_increasing_id())
    ordered.write.option("compression", "zstd").parquet(f"{folder}/recipes")
    _manifest(_recipes(spark, folder)).write.parquet(f"{folder}/manifest")


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(STAGED).parquet(f"{folder}/streams").filter("kind = 'chunk'").select(F.col("key").alias("hash"), "ids")


def _recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Recipes in their order: nth ascends with doc_id; its upper bits number the files, its lower ones the rows of a file."""
    return spark.read.schema("doc_id long, n_tokens long, hashes array<binary>, lengths array<int>, root binary, nth long").parquet(f"{folder}/recipes").withColumn("part", F.shiftright("nth", 33).cast("int"))


def _roots(groups):
    for batch in groups:
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("first"), batch.column("last"), batch.column("n_docs"), batch.column("n_tokens"), pa.array([merkle([r["root"] for r in x]) for x in batch.column("roots").to_pylist()], pa.binary())], names=["part", "first", "last", "n_docs", "n_tokens", "root"])


def _manifest(recipes: DataFrame) -> DataFrame:
    """One row per block of at most MANIFEST_BLOCK documents of a part, in doc_id order."""
    block = F.expr(f"(nth & {(1 << 33) - 1}) div {MANIFEST_BLOCK}")
    by = recipes.select("part", "doc_id", "n_tokens", "root", "nth", block.alias("block")).groupBy("part", "block")
    grouped = by.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("nth", "root"))).alias("roots"))
    return grouped.select("part", "first", "last", "n_docs", "n_tokens", "roots").mapInArrow(_roots, "part int, first long, last long, n_docs long, n_tokens long, root binary")


#: The reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo CRC-32's, bit-reversed, elementwise."""
    out, b = np.zeros(len(a), np.uint64), b.copy()
    for bit in range(31, -1, -1):
        out ^= np.where(a >> np.uint64(bit) & np.uint64(1), b, np.uint64(0))
        b = np.where(b & np.uint64(1), b >> np.uint64(1) ^ np.uint64(POLYNOMIAL), b >> np.uint64(1))
    return out


def shift(n_bytes: np.ndarray) -> np.ndarray:
    """x to the power of 8 n, modulo CRC-32's polynomial: what a CRC is multiplied with when n bytes follow."""
    power, out, n = np.full(1, 1 << 23, np.uint64), np.full(len(n_bytes), 1 << 31, np.uint64), n_bytes.astype(np.int64).copy()
    while n.any():
        out = np.where(n & 1, _times(out, np.broadcast_to(power, len(out)).copy()), out)
        power = _times(power, power)
        n >>= 1
    return out


CHUNK = "hash binary, size long, crc long, shift long, good boolean"


def _read_chunks(batches):
    import zlib

    for batch in batches:
        sizes, crcs, good = [], [], []
        for digest, raw in zip(batch.column("hash").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            raw = _widened(raw)
            sizes.append(len(raw))
            crcs.append(zlib.crc32(raw))
            good.append(hashlib.sha256(raw).digest() == digest)
        distinct, back = np.unique(np.array(sizes, np.int64), return_inverse=True)
        yield pa.RecordBatch.from_arrays([batch.column("hash"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(shift(distinct).astype(np.int64)[back]), pa.array(good)], names=["hash", "size", "crc", "shift", "good"])


def _used(batches):
    """Uses of chunks (nth, part, doc_id, k, hash) of recipes whose roots and lengths hold; others are an error."""
    for batch in batches:
        lists = batch.column("hashes")
        offsets = lists.offsets.to_numpy()
        flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
        n = np.diff(offsets)
        for doc, mine, sizes, root, tokens in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "hashes", "lengths", "root", "n_tokens")), strict=True):
            if merkle(mine) != root or sum(sizes) != tokens:
                raise ValueError(f"altered recipe of document {doc}")
        row = pa.array(np.repeat(np.arange(len(n)), n))
        k = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(row) for c in ("nth", "part", "doc_id")), pa.array(k.astype(np.int32)), flat], names=["nth", "part", "doc_id", "k", "hash"])


def _combined(batches):
    """CRCs of whole documents from their chunks' in order: crc(A B) = crc(A) x^(8 |B|) + crc(B)."""
    for batch in batches:
        lists = batch.column("chunks")
        at = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values
        crc, sh = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.uint64) for k in ("crc", "shift"))
        out, n = np.zeros(len(lists), np.uint64), np.diff(at)
        for k in range(int(n.max()) if len(n) else 0):
            live = np.flatnonzero(n > k)
            j = at[live] + k
            out[live] = _times(out[live], sh[j]) ^ crc[j]
        yield pa.RecordBatch.from_arrays([batch.column("nth"), batch.column("part"), batch.column("doc_id"), batch.column("n_tokens"), pa.array(out.astype(np.int64))], names=["nth", "part", "doc_id", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files. Fails if a chunk is missing or altered, or a recipe's root or length doesn't hold.

    A chunk that many documents use is one row on its side of the join; its uses are split
    by adaptive execution. Sums of whole files come first, then each file's own rows.
    """
    chunks = _chunks(spark, folder).mapInArrow(_read_chunks, CHUNK)
    uses = _recipes(spark, folder).mapInArrow(_used, "nth long, part int, doc_id long, k int, hash binary")
    found = uses.join(chunks, "hash", "left").withColumn("crc", F.when(F.col("good"), F.col("crc")).otherwise(F.raise_error(F.concat(F.lit("missing or altered chunk "), F.hex("hash"))).cast("long")))
    whole = found.groupBy("nth").agg(F.first("part").alias("part"), F.first("doc_id").alias("doc_id"), (F.sum("size") / 4).cast("long").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("k", "crc", "shift"))).alias("chunks"))
    out = written(whole.mapInArrow(_combined, "nth long, part int, doc_id long, n_tokens long, ids_crc32 long"))
    ends = Window.orderBy("part")  # one row a file
    before = out.groupBy("part").agg(F.sum("n_tokens").alias("all")).select("part", (F.sum("all").over(ends) - F.col("all")).alias("before"))
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1))
    placed = out.withColumn("own", F.coalesce(own, F.lit(0))).join(F.broadcast(before), "part")
    return placed.select("doc_id", (F.col("before") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, ids of every document, rebuilt from recipes and chunks."""
    uses = _recipes(spark, folder).select("nth", "doc_id", F.posexplode("hashes").alias("k", "hash"))

    def widen(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("nth"), b.column("doc_id"), pa.array([np.frombuffer(b"".join(_widened(x["ids"]) for x in c), "<u4").tolist() for c in b.column("chunks").to_pylist()], pa.list_(pa.int64()))], names=["nth", "doc_id", "ids"])

    found = uses.join(_chunks(spark, folder), "hash")
    whole = found.groupBy("nth").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("chunks"))
    return whole.mapInArrow(widen, "nth long, doc_id long, ids array<long>").select("doc_id", "ids")


def verify(spark: SparkSession, folder: str) -> DataFrame:
    """What of the store doesn't hold, as rows of (problem, at); none if it is whole: chunks that don't have their hash, recipes whose root or length is wrong or whose chunks are missing, manifest rows that don't follow from the recipes."""

    def bad(batches):
        for b in batches:
            keep = [merkle(h) != r or sum(s) != n for h, r, s, n in zip(*(b.column(c).to_pylist() for c in ("hashes", "root", "lengths", "n_tokens")), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(["recipe"] * sum(keep), pa.string()), b.column("doc_id").cast(pa.string()).filter(pa.array(keep, pa.bool_()))], names=["problem", "at"])

    chunks, recipes = _chunks(spark, folder).mapInArrow(_read_chunks, CHUNK), _recipes(spark, folder)
    altered = chunks.filter("not good").select(F.lit("chunk").alias("problem"), F.hex("hash").alias("at"))
    missing = recipes.select(F.explode("hashes").alias("hash")).distinct().join(chunks, "hash", "left_anti").select(F.lit("missing chunk").alias("problem"), F.hex("hash").alias("at"))
    said, true = spark.read.parquet(f"{folder}/manifest"), _manifest(recipes)
    differ = said.exceptAll(true).unionByName(true.exceptAll(said)).select(F.lit("manifest").alias("problem"), F.col("part").cast("string").alias("at"))
    return altered.union(missing).union(recipes.mapInArrow(bad, "problem string, at string")).union(differ)


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_store(read(spark, sf_dir, "documents"), folder)
    return read_digests(spark, folder)
