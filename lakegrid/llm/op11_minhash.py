"""MinHash near-duplicates with sequential Bayesian verification.

Links between sets of 2-word shingles, 100 |A & B| >= 80 |A | B|, and the classes they connect:

* Texts of equal sets are one set, named by 128 bits and led by its smallest doc_id.
* A set's signature holds the smallest values of its shingles under BANDS * ROWS hash functions.
  Sets that agree in all ROWS values of a band are candidates; a linked pair agrees in no band
  with probability MISS at most. Groups of the same sets in several bands count once.
* Sequential verification: of each of KEPT further values a bit is kept, and BATCH bits of two
  signatures are compared at a time. Under a uniform prior the matches so far give the posterior
  of the similarity; a pair is pruned as soon as a similarity of PERCENT or more has a posterior
  below PRUNE.
* Survivors are verified exactly, on the full sets of the whole texts.

No group's pairs are all formed: first every set meets one leader per group; groups that then
still hold several classes are cut into blocks, and pairs of blocks go to tasks, which compare
signatures of sets of different classes only, each pair in the first band that it shares.
Survivors are verified best first, one for each pair of classes, then those whose classes still
differ. Keys of many rows are joined apart.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .op4_jaccard import _groups, fetched, in_blocks
from .shared import mix, read, shingle_sets, slices, written

#: Words of a shingle; a link needs PERCENT of the union in common.
WIDTH, PERCENT = 2, 80
#: Values of a band; probability that a linked pair shares no band; bands that follow from both.
ROWS, MISS = 6, 1e-5
BANDS = math.ceil(math.log(MISS) / math.log(1 - (PERCENT / 100) ** ROWS))
#: Signature bits kept for verification, compared at a time, and the posterior below which a pair is pruned.
KEPT, BATCH, PRUNE = 3072, 256, 1e-5
#: Sets that are verified with one copy of their leader; sets of a block.
SALTED, BLOCK = 2000, 1024
#: A key is joined apart if it has HOT rows or more, and more than one in HOTTEST of all: at most HOTTEST keys are broadcast.
HOT, HOTTEST = 65_536, 100_000

_L, _I = pa.int64(), pa.int32()
_rng = np.random.RandomState(80)
_FACTOR = _rng.randint(0, 2**31, BANDS * ROWS + KEPT).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_FLIP = _rng.randint(0, 2**32, len(_FACTOR), dtype=np.uint64).astype(np.uint32)


@cache
def least_matches(percent: int = PERCENT, prune: float = PRUNE) -> tuple[int, ...]:
    """Matches after BATCH, 2 BATCH ... bits below which a pair is pruned: the posterior of similarity percent or more is below prune. Bits of different values agree in half of the cases."""
    s = (np.arange(20_000) + 0.5) / 20_000
    same, other = np.log((1 + s) / 2), np.log((1 - s) / 2)
    out = []
    for n in range(BATCH, KEPT + 1, BATCH):
        low, high = 0, n  # the posterior grows with the matches
        while low < high:
            m = (low + high) // 2
            like = m * same + (n - m) * other
            like = np.exp(like - like.max())
            low, high = (low, m) if like[s >= percent / 100].sum() >= prune * like.sum() else (m + 1, high)
        out.append(low)
    return tuple(out)


def _name(h: np.ndarray, at: np.ndarray, salt: int) -> np.ndarray:
    run = np.concatenate(([np.uint64(0)], np.cumsum(mix(h ^ np.uint64(salt)))))
    return (run[at[1:]] - run[at[:-1]]).astype(np.int64)


def _sets(column: pa.Array):
    """Hashes, first index of each row (one more at the end), and the two halves of each row's name."""
    h, row = shingle_sets(column, WIDTH)
    at = np.searchsorted(row, np.arange(len(column) + 1))
    return h, at, _name(h, at, 0x5A5A5A5AA5A5A5A5), _name(h, at, 0xC3A5C85C97CB3127)


def signatures(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the bands' functions, sets) and (sets, packed bits of the others) of sets that start at first and aren't empty."""
    x = (h >> np.uint64(32)).astype(np.uint32)
    value, least = np.empty_like(x), np.empty((BANDS * ROWS, len(first)), np.uint32)
    bits, one = np.empty((KEPT, len(first)), np.uint8), np.empty(len(first), np.uint32)
    for k in range(len(_FACTOR)):
        np.bitwise_xor(x, _FLIP[k], out=value)
        np.multiply(value, _FACTOR[k], out=value)
        if k < len(least):
            np.minimum.reduceat(value, first, out=least[k])
        else:
            np.minimum.reduceat(value, first, out=one)
            bits[k - len(least)] = (one * np.uint32(0x9E3779B1)) >> np.uint32(31)
    return least, np.packbits(bits, 0).T


def _bands(sig: np.ndarray) -> np.ndarray:
    """(sets, bands): a 64-bit key of each band's values and its number."""
    out = np.empty((sig.shape[1], BANDS), np.int64)
    for b in range(BANDS):
        key = np.full(sig.shape[1], b + 1, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sig[k])
        out[:, b] = key.astype(np.int64)
    return out


SIGNED = "doc_id long, n long, high long, low long, sig binary, bands array<long>"


def _signed(batches):
    """Per text its set's size and name, and once per set and task its signature's kept bits and its bands."""
    seen: set[tuple[int, int]] = set()
    for part in slices(batches):
        h, at, high, low = _sets(part.column("text"))
        n = np.diff(at)
        fresh = np.zeros(len(n), bool)
        for i in np.flatnonzero(n):
            if (key := (int(high[i]), int(low[i]))) not in seen:
                fresh[i] = True
                if len(seen) < 1_000_000:
                    seen.add(key)
        own = np.repeat(fresh, n)
        size = n[fresh]
        least, lines = signatures(h[own], np.cumsum(size) - size) if len(size) else (np.zeros((BANDS * ROWS, 0), np.uint32), np.zeros((0, KEPT // 8), np.uint8))
        edge = np.concatenate(([0], np.cumsum(fresh)))
        bits = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((edge * (KEPT // 8)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(lines))])
        bands = pa.ListArray.from_arrays(pa.array((edge * BANDS).astype(np.int32)), pa.array(_bands(least).ravel(), _L))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, _L), pa.array(high, _L), pa.array(low, _L), bits, bands], names=[c.split()[0] for c in SIGNED.split(", ")])


def spread_join(many: DataFrame, one: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """many.join(one, keys, how), where column rows of one counts a key's rows in many; keys of a great part of all rows are joined by broadcast. Drops rows."""
    most, total = one.agg(F.max("rows"), F.sum("rows")).first()
    least = max(HOT, (total or 0) // HOTTEST)
    if (most or 0) < least:
        return many.join(one.drop("rows"), keys, how)
    hot = F.broadcast(one.filter(F.col("rows") >= least).drop("rows"))  # HOTTEST rows at most
    apart = many.join(hot, keys)
    rest = many.join(hot.select(keys), keys, "left_anti").join(one.filter(F.col("rows") < least).drop("rows"), keys, how)
    return rest.unionByName(apart)


def matched(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, matches) of the pairs of signature lines x[k], y[k] (words of 64 bits) that survive: batches are compared in turn and pairs pruned after each."""
    rows, matches = np.arange(len(x)), np.zeros(len(x), np.int64)
    for k, least in enumerate(least_matches()):
        at = slice(k * BATCH // 64, (k + 1) * BATCH // 64)
        matches = matches + BATCH - np.bitwise_count(x[rows, at] ^ y[rows, at]).sum(1, dtype=np.int64)
        keep = matches >= least
        rows, matches = rows[keep], matches[keep]
    return rows, matches


def _lines(column: pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    at = np.frombuffer(array.buffers()[1], np.int32)[array.offset]
    return np.frombuffer(array.buffers()[2], np.uint8)[at : at + len(array) * (KEPT // 8)].copy().view(np.uint64).reshape(-1, KEPT // 64)


PAIRS = "a long, b long, matches int"


def _pairs(a, b, matches) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, _L), pa.array(b, _L), pa.array(matches, _I)], names=["a", "b", "matches"])


def _sequential(batches):
    """Candidate pairs (a, b) with signatures that survive sequential verification."""
    for batch in batches:
        if batch.num_rows:
            rows, matches = matched(_lines(batch.column("sig_a")), _lines(batch.column("sig_b")))
            yield _pairs(batch.column("a").to_numpy()[rows], batch.column("b").to_numpy()[rows], matches)


def _crossed(batches):
    """Of each pair of blocks, the pairs of sets of different classes that survive, with the classes."""
    for group in _groups(batches):
        side, name, size, label = (group.column(k).to_numpy().astype(np.int64) for k in ("side", "member", "size", "label"))
        lines, band = _lines(group.column("sig")), group.column("shared").to_numpy()[0]
        bands = np.concatenate([c.flatten().to_numpy() for c in group.column("bands").chunks]).reshape(-1, BANDS)
        same = group.column("same")[0].as_py()
        x = np.flatnonzero(side == 0)
        y = x if same else np.flatnonzero(side == 1)
        for begin in range(0, len(x), 128):  # some rows of the block's matrix at a time
            part = x[begin : begin + 128]
            apart = (label[part][:, None] != label[y]) & (100 * np.minimum.outer(size[part], size[y]) >= PERCENT * np.maximum.outer(size[part], size[y]))
            i, j = np.nonzero(np.triu(apart, begin + 1) if same else apart)
            i, j = part[i], y[j]
            rows, matches = matched(lines[i], lines[j])
            i, j = i[rows], j[rows]
            own = (bands[i] == bands[j]).argmax(1) == band if len(rows) else np.zeros(0, bool)  # other lists leave the pair to this one
            if own.any():
                i, j = i[own], j[own]
                columns = (np.minimum(name[i], name[j]), np.maximum(name[i], name[j]), matches[own], np.minimum(label[i], label[j]), np.maximum(label[i], label[j]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if k == 2 else _L) for k, c in enumerate(columns)], names=["a", "b", "matches", "x", "y"])


def _exact(batches):
    """Pairs of each leader with the sets that follow it that are linked, from their whole texts."""
    lead, have = None, np.zeros(0, np.uint64)
    for batch in slices(batches):
        h, at, high, _ = _sets(batch.column("text"))
        salt, first = batch.column("salt").to_numpy(), batch.column("first").to_numpy(zero_copy_only=False)
        a, b, name = (batch.column(c).to_numpy() for c in ("a", "b", "high"))
        out = []
        for i in np.flatnonzero(high == name):  # rows that repeat a doc_id may have another text
            mine = h[at[i] : at[i + 1]]
            if first[i] == 0:
                lead, have = (a[i], salt[i]), mine.copy()
                continue
            if lead != (a[i], salt[i]):
                raise ValueError("a leader's set is missing")
            common = int((have[np.minimum(np.searchsorted(have, mine), len(have) - 1)] == mine).sum())
            if 100 * common >= PERCENT * (len(have) + len(mine) - common):
                out.append(i)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(a[out], _L), pa.array(b[out], _L)], names=["a", "b"])


def verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of leading doc_ids whose full sets are linked. sets: (owner, high). A leader's set goes once to every SALTED of its partners."""
    pairs = written(pairs.select("a", "b").distinct())
    counts = written(pairs.groupBy("a").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0]
    size = max(SALTED, (total or 0) // HOTTEST)
    # leaders of more than size sets, HOTTEST at most
    large = counts.filter(F.col("n") > size).select("a", F.ceil(F.col("n") / size).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    to = pairs.join(F.broadcast(large), "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt"), F.lit(1).alias("first"), F.col("b").alias("owner"))
    lead = counts.join(F.broadcast(large), "a", "left")
    to = to.union(lead.select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("first"), F.col("a").alias("owner")))
    asked = to.join(sets.select("owner", "high"), "owner").select(F.col("high").alias("name"), F.col("owner").alias("doc_id"), F.struct("a", "b", "salt", "first").alias("pair"))
    dealt = fetched(docs, asked, "pair").select(F.col("name").alias("high"), "pair.*", "text").repartition("a", "salt").sortWithinPartitions("a", "salt", "first")
    return written(dealt.mapInArrow(_exact, "a long, b long").distinct())


def _relabelled(pairs: DataFrame, columns: list[str], labels: DataFrame) -> DataFrame:
    """Pairs whose two columns of nodes are in different classes: columns x and y hold the classes, the smaller first."""
    for k, c in enumerate(columns):
        pairs = pairs.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"_{k}")), c, "left").withColumn(f"_{k}", F.coalesce(f"_{k}", c))
    return pairs.withColumns({"x": F.least("_0", "_1"), "y": F.greatest("_0", "_1")}).filter("x < y").drop("_0", "_1")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Classes of near-duplicate texts.

    Per row of docs: doc_id, n_shingles, component_id (smallest doc_id that links reach, its own
    included) and kept (doc_id = component_id, null equal to null). Null and empty texts and
    texts without a word have no shingle and are linked with nothing; a text of one word is
    one shingle. Texts are taken whole at any length. Rows of null doc_id take the class of
    their text, are never its id, and have a null component_id if it has no other. Rows that repeat a
    doc_id stay; if their texts differ, each has the class of its own text. Equal similarities of 80 %
    are links, and of equal matches the pair of smallest ids is verified first. Other columns are left out.
    """
    docs = docs.select("doc_id", "text")
    signed = written(docs.mapInArrow(_signed, SIGNED).withColumns({"sig": F.when(F.length("sig") > 0, F.col("sig")), "bands": F.when(F.size("bands") > 0, F.col("bands"))}))
    leaders = signed.filter("n > 0").groupBy("high", "low").agg(F.min("doc_id").alias("owner"), F.count("*").alias("rows"), F.max("n").cast("int").alias("size"), F.first("sig", True).alias("sig"), F.first("bands", True).alias("bands"))
    sets = written(leaders.filter("owner is not null"))

    keys = sets.select("owner", F.posexplode("bands").alias("band", "key"))
    groups = keys.groupBy("key").agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64("owner")).alias("set"), F.min("owner").alias("lead"), F.min("band").alias("band")).filter("rows > 1")
    # groups of the same sets in several bands are one list
    lists = written(groups.groupBy("rows", "set", "lead").agg(F.min(F.struct("band", "key")).alias("of")).select("of.key", "of.band", "rows", F.col("lead").alias("a"), F.xxhash64("rows", "set", "lead").alias("list")))
    members = written(spread_join(keys.select("owner", "key"), lists, ["key"]).select("list", "band", "a", F.col("owner").alias("b")))

    side = {k: sets.select(F.col("owner").alias(k), F.col("sig").alias("sig_" + k), F.col("size").alias("size_" + k)) for k in "ab"}
    star = written(members.filter("a <> b").select("a", "b").distinct())
    led = star.groupBy("a").agg(F.count("*").alias("rows")).join(side["a"], "a")
    star = spread_join(star, written(led), ["a"]).join(side["b"], "b").filter(100 * F.least("size_a", "size_b") >= PERCENT * F.greatest("size_a", "size_b"))
    star = written(star.select("a", "b", "sig_a", "sig_b").mapInArrow(_sequential, PAIRS))

    best = star.groupBy("b").agg(F.max_by("a", F.struct("matches", -F.col("a"))).alias("a"))
    edges = verified(docs, sets, best)
    labels = components(edges)

    # lists that still hold several classes, in pairs of blocks
    whose = members.join(labels.select(F.col("node").alias("b"), "label"), "b", "left").withColumn("label", F.coalesce("label", "b"))
    opened = whose.groupBy("list").agg((F.min("label") < F.max("label")).alias("open"), F.count("*").alias("n")).filter("open and n > 2").select("list")
    longer = whose.join(opened, "list")
    heavy = longer.groupBy("list", "label").agg(F.count("*").alias("n")).filter(F.col("n") >= BLOCK // 2).select("list", "label", F.col("label").alias("part"))
    size = sets.select(F.col("owner").alias("member"), "size", F.col("size").alias("rest"), "sig", "bands")
    dealt = longer.join(heavy, ["list", "label"], "left").select("list", F.col("band").alias("shared"), F.coalesce("part", F.lit(-1).cast("long")).alias("part"), F.col("b").alias("member"), "label").join(size, "member")
    # a label of half a block or more in a list has blocks of its own, so its pairs with itself are never formed
    dealt = in_blocks(written(dealt.select("list", "part", "member", "label", "size", "rest", "shared", "sig", "bands")), F.lit(BLOCK)).repartition("block").sortWithinPartitions("block")
    cross = dealt.mapInArrow(_crossed, PAIRS + ", x long, y long").withColumn("answered", F.lit(False))

    # first the best pair of each two classes, then all pairs whose classes still differ
    seen = _relabelled(star, ["a", "b"], labels).withColumn("answered", F.lit(False))
    done = _relabelled(best.select("a", "b", F.lit(0).alias("matches")), ["a", "b"], labels).withColumn("answered", F.lit(True))
    apart = seen.unionByName(done).unionByName(cross).groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "x", "y").agg(F.max("matches").alias("matches"), F.max("answered").alias("answered"))
    apart = written(apart.filter("not answered").drop("answered"))
    if not apart.isEmpty():
        first = written(apart.groupBy("x", "y").agg(F.max_by(F.struct("a", "b"), F.struct("matches", -F.col("a"), -F.col("b"))).alias("p")).select("p.a", "p.b"))
        more = verified(docs, sets, first)
        if not more.isEmpty():
            edges = edges.union(more)
            labels = components(edges)
        left = _relabelled(apart.select("a", "b", F.col("x").alias("p"), F.col("y").alias("q")), ["p", "q"], labels).select("a", "b", F.lit(False).alias("answered"))
        left = left.union(first.select("a", "b", F.lit(True))).groupBy("a", "b").agg(F.max("answered").alias("answered"))
        left = written(left.filter("not answered").select("a", "b"))
        if not left.isEmpty() and not (more := verified(docs, sets, left)).isEmpty():
            labels = components(edges.union(more))

    ids = sets.select("high", "low", "owner", "rows").join(labels.select(F.col("node").alias("owner"), "label"), "owner", "left").select("high", "low", "rows", F.coalesce("label", "owner").alias("least"))
    own = signed.select("doc_id", F.col("n").alias("n_shingles"), "high", "low")
    out = spread_join(own.filter("n_shingles > 0"), ids, ["high", "low"], "left").select("doc_id", "n_shingles", F.col("least").alias("component_id"))
    out = out.unionByName(own.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
