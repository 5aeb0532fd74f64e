"""LM scoring by partial matching: a byte-context trie with escapes and symbol exclusion.

The trie of all contexts of up to ORDER bytes is a set of tables: how often each symbol
followed each context in the training texts. A symbol's probability is its share in the
longest context where it was seen; each longer known context first charges an escape. With
T the counts and D the distinct symbols of a context (method C), and what the longer context
has already ruled out taken away (exclusion),

    share = c / (T' + D'),    escape = D' / (T' + D').

Below the empty context all symbols not seen at all are equally likely. A text is its
lower-cased bytes with an end symbol (byte 0); before its start the context is zeros.

Work is split by keys: tasks send the words and byte strings of their texts, packed by
hash bucket, and each bucket adds up its own keys. Nothing of the corpus is kept whole in
one place but the costs of byte strings, and those go out in blocks of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import LOWER, STEP, fold, mix, read, slices, text_bytes, word_hashes, words, written

ORDER = 4
#: Byte strings whose costs the tasks hold at a time; more go in further blocks, each over all texts.
BLOCK = 4_000_000
#: Distinct byte strings a task gathers before it sends them.
GATHERED = 1_500_000


def byte_strings(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER + 1 bytes that end at each symbol of each text, its end symbol included, as numbers, and each text's first index (one more at the end)."""
    rows, size = len(at) - 1, np.diff(at)
    pad = np.zeros(len(raw) + rows * (ORDER + 1), np.uint8)
    place = np.arange(len(raw)) + np.repeat(np.arange(rows) * (ORDER + 1) + ORDER, size)
    pad[place] = raw
    code = np.zeros(len(pad) - ORDER, np.uint64)
    for j in range(ORDER + 1):
        code <<= np.uint64(8)
        code |= pad[j : j + len(code)]
    real = np.ones(len(code), bool)
    gap = (at[1:-1] + np.arange(1, rows) * (ORDER + 1))[:, None] + np.arange(ORDER) - ORDER
    real[gap.ravel()] = False
    return code[real], at + np.arange(rows + 1)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.diff(np.append(first, len(codes)))


def _bucketed(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by bucket, and each bucket's first place (one more at the end)."""
    b = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    return order, np.searchsorted(b[order], np.arange(buckets + 1))


def _list(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))


PACKED = "bucket int, kind int, docs array<long>, keys array<long>, train array<long>, pair_doc array<int>, pair_key array<int>, pair_n array<int>"
_L, _I = pa.int64(), pa.int32()


def _packed(buckets: int, kind: int, columns: list[pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(buckets), _I), pa.array(np.full(buckets, kind), _I), *columns], names=[c.split()[0] for c in PACKED.split(", ")])


def _gather(batches, buckets: int):
    """Kind 0: the words of a slice with their counts in training texts, and who uses them how often. Kind 1: byte strings with their counts in training texts."""
    none = _list(np.zeros(0), np.zeros(buckets + 1), _L), _list(np.zeros(0), np.zeros(buckets + 1), _I)
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def strings():
        codes, n = _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        held.clear()
        order, at = _bucketed(mix(codes), buckets)
        return _packed(buckets, 1, [none[0], _list(codes[order].astype(np.int64), at, _L), _list(n[order], at, _L), none[1], none[1], none[1]])

    for part in slices(batches):
        raw, at = text_bytes(part.column("text"))
        low = LOWER[raw]
        learn = part.column("fold").to_numpy() != 0
        start, end, row = words(low, at)
        if len(start):
            h = word_hashes(low, start, end)
            order = np.lexsort((row, h))
            h, row = h[order], row[order]
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])))
            first = np.flatnonzero(new)
            tf, ph, prow = np.diff(np.append(first, len(h))), h[first], row[first]
            word_first = np.flatnonzero(np.concatenate(([True], ph[1:] != ph[:-1])))
            keys, n = ph[word_first], np.add.reduceat(tf * learn[prow], word_first)
            uses = np.diff(np.append(word_first, len(ph)))
            order, key_at = _bucketed(keys, buckets)
            # pairs follow their keys' order
            use_order = uses[order]
            pair_end = np.cumsum(use_order)
            pair = np.repeat(word_first[order] - (pair_end - use_order), use_order) + np.arange(len(ph))
            pair_at = np.concatenate(([0], pair_end))[key_at]
            local = np.repeat(np.arange(len(keys)), use_order) - np.repeat(key_at[:-1], np.diff(pair_at))
            ids = part.column("key").to_numpy()
            docs = _list(np.tile(ids, buckets), np.arange(buckets + 1) * len(ids), _L)
            if len(ids) > len(ph) // buckets // 2:  # few uses of many texts: name each bucket's own texts only
                b = np.repeat(np.arange(buckets), np.diff(pair_at))
                own, back = np.unique(b * len(ids) + prow[pair], return_inverse=True)
                doc_at = np.searchsorted(own, np.arange(buckets + 1) * len(ids))
                docs, pdoc = _list(ids[own % len(ids)], doc_at, _L), back - doc_at[b]
            else:
                pdoc = prow[pair]
            yield _packed(buckets, 0, [docs, _list(keys[order].astype(np.int64), key_at, _L), _list(n[order], key_at, _L), _list(pdoc, pair_at, _I), _list(local, pair_at, _I), _list(tf[pair], pair_at, _I)])
        codes, first = byte_strings(low, at)
        trained = np.repeat(learn, np.diff(first))
        seen, n = _counted(codes[trained])
        held.append((seen, n))
        other = np.unique(codes[~trained])
        held.append((other, np.zeros(len(other), np.int64)))
        if sum(len(h[0]) for h in held) > GATHERED:
            codes, n = _summed(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            held[:] = [(codes, n)]
            if len(codes) > GATHERED // 2:
                yield strings()
    if held:
        yield strings()


ADDED = "kind int, place int, key array<long>, value array<double>, known array<long>, tokens array<long>"


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    at = array.offsets.to_numpy().astype(np.int64)
    return array.values.to_numpy()[at[0] : at[-1]], np.diff(at)


def _add_up(table: pa.Table, buckets: int) -> pa.Table:
    """Of one bucket. Kind 0, packed by the texts' own bucket (place): each text's sum of log10(c + 0.1) over its words here, its known words and its words; kind 1: byte strings with their counts; kind 2: training words and distinct ones among them."""
    kind = table.column("kind").to_numpy()
    rows: list[tuple[int, int, list, list, list, list]] = []
    part = table.filter(pa.array(kind == 0))
    if part.num_rows:
        keys, per = _flat(part.column("keys"))
        train, _ = _flat(part.column("train"))
        distinct, back = np.unique(keys, return_inverse=True)
        c = np.bincount(back, train, len(distinct))
        rows.append((2, 0, [], [], [int(c.sum())], [int((c > 0).sum())]))
        value, known = np.log10(c + 0.1)[back], (c > 0)[back]
        docs, per_doc = _flat(part.column("docs"))
        pdoc, per_pair = _flat(part.column("pair_doc"))
        pkey, tf = _flat(part.column("pair_key"))[0], _flat(part.column("pair_n"))[0].astype(np.int64)
        k = pkey + np.repeat(np.cumsum(per) - per, per_pair)
        d = pdoc + np.repeat(np.cumsum(per_doc) - per_doc, per_pair)
        tokens = np.bincount(d, tf, len(docs))
        sums, n_known = np.bincount(d, tf * value[k], len(docs)), np.bincount(d, tf * known[k], len(docs))
        live = np.flatnonzero(tokens)
        order, at = _bucketed(mix(docs[live].astype(np.uint64)), buckets)
        live = live[order]
        for place in np.flatnonzero(np.diff(at)):
            j = live[at[place] : at[place + 1]]
            rows.append((0, int(place), docs[j], sums[j], n_known[j].astype(np.int64), tokens[j].astype(np.int64)))
    part = table.filter(pa.array(kind == 1))
    if part.num_rows:
        codes, n = _summed(_flat(part.column("keys"))[0], _flat(part.column("train"))[0])
        for i in range(0, len(codes), 50_000):
            rows.append((1, 0, codes[i : i + 50_000], [], n[i : i + 50_000], []))
    kinds = [pa.int32(), pa.int32(), pa.list_(_L), pa.list_(pa.float64()), pa.list_(_L), pa.list_(_L)]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=[c.split()[0] for c in ADDED.split(", ")])


def _by_text(table: pa.Table) -> pa.Table:
    """Sums of the texts of one place over all buckets."""
    key, _ = _flat(table.column("key"))
    distinct, back = np.unique(key, return_inverse=True)
    value = np.bincount(back, _flat(table.column("value"))[0], len(distinct))
    known, tokens = (np.bincount(back, _flat(table.column(c))[0], len(distinct)).astype(np.int64) for c in ("known", "tokens"))
    return pa.table({"key": distinct, "value": value, "known": known, "tokens": tokens})


def costs(strings: DataFrame) -> DataFrame:
    """log10 probability of the last byte of every byte string (gram, n) after the bytes before it; n counts training texts."""
    low = lambda c, j: c.bitwiseAND((1 << 8 * j) - 1)  # noqa: E731  the last j bytes
    train = strings.filter("n > 0")
    out, shorter, levels = strings, None, {}
    for j in range(ORDER + 1):  # contexts of j bytes
        nodes = train.groupBy(low(F.col("gram"), j + 1).alias(f"k{j}")).agg(F.sum("n").alias(f"c{j}"))
        context = F.shiftright(f"k{j}", 8)
        if shorter is None:
            each = nodes.withColumn("x", F.lit(0).cast("long"))
        else:
            each = nodes.withColumn(f"k{j - 1}", low(F.col(f"k{j}"), j)).join(shorter, f"k{j - 1}").withColumnRenamed(f"c{j - 1}", "x")
        levels[j] = (nodes, each.groupBy(context.alias(f"x{j}")).agg(F.sum(f"c{j}").alias(f"t{j}"), F.count("*").alias(f"d{j}"), F.sum("x").alias(f"e{j}")))
        shorter = nodes
    for j in range(ORDER + 1):
        nodes, contexts = levels[j]
        out = out.withColumn(f"k{j}", low(F.col("gram"), j + 1)).withColumn(f"x{j}", F.shiftright(f"k{j}", 8))
        out = out.join(nodes, f"k{j}", "left").join(contexts, f"x{j}", "left").drop(f"k{j}", f"x{j}")
    cost: Column = -F.log10(F.lit(256) - F.coalesce("d0", F.lit(0)))
    for j in range(ORDER + 1):
        ruled, gone = (F.coalesce(f"e{j + 1}", F.lit(0)), F.coalesce(f"d{j + 1}", F.lit(0))) if j < ORDER else (F.lit(0), F.lit(0))
        fresh = F.col(f"d{j}") - gone
        total = F.col(f"t{j}") - ruled + fresh
        escape = F.when(F.col(f"t{j}").isNull() | (fresh == 0), 0.0).otherwise(F.log10(fresh.cast("double")) - F.log10(total.cast("double")))
        cost = F.when(F.col(f"c{j}").isNotNull(), F.log10(F.col(f"c{j}").cast("double")) - F.log10(total.cast("double"))).otherwise(escape + cost)
    return out.select("gram", cost.alias("cost"))


class Table:
    """Open-addressed hash table from byte strings to costs, as arrays; 0 for strings it lacks."""

    EMPTY = np.uint64(2**64 - 1)

    def __init__(self, keys: np.ndarray, cost: np.ndarray):
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.cost = np.full(1 << bits, self.EMPTY), np.zeros(1 << bits)
        left, at = np.arange(len(keys)), self.slot(keys)
        while len(left):
            free = self.keys[at] == self.EMPTY
            self.keys[at[free]] = keys[left[free]]
            won = free & (self.keys[at] == keys[left])
            self.cost[at[won]] = cost[left[won]]
            left, at = left[~won], (at[~won] + 1) & self.last

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * STEP) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self.slot(keys)
        out, there = self.cost[at], self.keys[at]
        left = np.flatnonzero(there != keys)
        out[left] = 0.0
        left = left[there[left] != self.EMPTY]
        at = at[left]
        while len(left):
            at = (at + 1) & self.last
            there = self.keys[at]
            hit = there == keys[left]
            out[left[hit]] = self.cost[at[hit]]
            go = ~hit & (there != self.EMPTY)
            left, at = left[go], at[go]
        return out


def _score(batches, sent):
    table = Table(*sent.value)
    for part in slices(batches):
        raw, at = text_bytes(part.column("text"))
        low = LOWER[raw]
        n_words = np.bincount(words(low, at)[2], minlength=part.num_rows)
        codes, first = byte_strings(low, at)
        score = np.add.reduceat(table.find(codes), first[:-1])
        yield pa.RecordBatch.from_arrays([part.column("key"), part.column("doc_id"), part.column("fold"), pa.array(n_words, _L), pa.array(score)], names=["key", "doc_id", "fold", "n_words", "score"])


def score(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Base and model log10 probability of every text.

    Per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. Null
    text counts as empty: its end alone. A null doc_id is learned from. Repeated rows are
    learned from as often as they stand, and each is returned.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    frame = docs.select("doc_id", "text", fold(10).alias("fold")).withColumn("key", F.xxhash64("doc_id", "text"))
    texts = frame.filter("fold <> 0").count()
    added = written(frame.select("key", "fold", "text").mapInArrow(lambda it: _gather(it, buckets), PACKED).groupBy("bucket").applyInArrow(lambda t: _add_up(t, buckets), ADDED))
    seen = added.filter("kind = 2").agg(F.sum(F.col("known")[0]), F.sum(F.col("tokens")[0])).first()
    n, v = (seen[0] or 0) + texts, (seen[1] or 0) + (texts > 0)

    table = written(costs(added.filter("kind = 1").select(F.explode(F.arrays_zip("key", "known")).alias("x")).select(F.col("x.key").alias("gram"), F.col("x.known").alias("n"))))
    blocks, parts = max(1, -(-table.count() // BLOCK)), []
    for k in range(blocks):
        mine = (table if blocks == 1 else table.filter(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k)).toArrow()
        sent = spark.sparkContext.broadcast((mine.column("gram").to_numpy().astype(np.uint64), mine.column("cost").to_numpy()))
        parts.append(frame.select("key", "doc_id", "fold", "text").mapInArrow(lambda it, sent=sent: _score(it, sent), "key long, doc_id long, fold int, n_words long, score double"))
    scored = parts[0]
    if blocks > 1:
        for p in parts[1:]:
            scored = scored.unionByName(p)
        whole = scored.groupBy("key", "doc_id", "fold", "n_words").agg(F.count("*").alias("times"), F.sum("score").alias("score"))
        times = (F.col("times") / blocks).cast("int")
        scored = whole.withColumn("score", F.col("score") / times).withColumn("_", F.explode(F.sequence(F.lit(1), times))).drop("_", "times")

    sums = added.filter("kind = 0").select("place", "key", "value", "known", "tokens").groupBy("place").applyInArrow(_by_text, "key long, value double, known long, tokens long")
    out = scored.join(sums, "key", "left")
    times = F.when(F.col("n_words") > 0, F.col("tokens") / F.col("n_words")).otherwise(1.0)  # rows with the same doc_id and text
    n_tokens = F.col("n_words") + 1
    base = F.coalesce(F.col("value") / times, F.lit(0.0)) + F.log10(F.lit(texts + 0.1)) - n_tokens * F.log10(F.lit(float(n + 0.1 * (v + 1))))
    return out.select(
        "doc_id", (F.col("fold") == 0).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.coalesce((F.col("known") / times).cast("long"), F.lit(0)) + F.lit(int(texts > 0))).cast("long").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))
