"""N-gram Jaccard join with set-relation skipping.

Exact links between sets of 5-word shingles, 100 |A & B| >= 75 |A | B|, and the classes that
links connect:

* Texts with equal sets are one set, named by a 64-bit sum of its mixed shingle hashes.
* Shingles are ordered, rare ones first; linked sets share one of their first
  n - ceil(0.75 n) + 1 shingles. Tasks send these prefixes, packed by hash bucket; a bucket
  builds its index lists, and lists of the same members become one.
* Index skipping: with a set's position in a list goes how many shingles follow it, so that
  members whose sizes or positions rule a link out are skipped in blocks.
* Answer skipping: first each list's members are compared with one pivot only, the member
  that shares most of its prefix with others. Lists whose members are connected then are
  done. Others are cut into blocks, and pairs of blocks go to tasks, those of one label or of
  sizes or rests without a link left out. Bounds for each pair of members not connected follow
  from their computed intersections with the pivot: some pairs are answered by them, either
  way; only the rest is compared.
* Before texts are fetched for a comparison, the sets' sketches answer most pairs without a
  link: a sketch keeps the parity of shingles in places that grow with the set, and places
  that differ are at most the shingles that only one of two sets holds.

No pair is dropped: each pair that shares a prefix shingle and isn't yet connected is
answered by a comparison or by an exact bound.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import mix, read, shingle_sets, slices, written

#: A link needs PERCENT of the union in common.
PERCENT = 75
#: How the order of shingles is chosen (results don't depend on it): of each GATHERED shingles a task names those of at least LOCAL distinct sets, the NAMED most frequent at most; the COMMON most frequent of all go last.
GATHERED, LOCAL, NAMED, COMMON = 3_000_000, 2, 65_536, 524_288
#: Sets that are compared with one copy of their pivot.
SALTED = 2000
#: Prefix shingles of an index bucket, and members of a block, on average at most.
PER_BUCKET, BLOCK = 1 << 19, 1024
#: Sizes of linked sets are in the same band or in bands next to each other: a band's sizes grow by a bit more than 100 / PERCENT.
BAND = 1.0001 * 100 / PERCENT

_L, _I = pa.int64(), pa.int32()


def needed(a, b):
    """Smallest intersection of linked sets of these sizes: ceil(PERCENT (a + b) / (100 + PERCENT))."""
    return (PERCENT * (a + b) + 99 + PERCENT) // (100 + PERCENT)


def _sets(column: pa.Array):
    """Hashes, first index of each row (one more at the end), and each row's name (0 for an empty set)."""
    h, row = shingle_sets(column)
    at = np.searchsorted(row, np.arange(len(column) + 1))
    run = np.concatenate(([np.uint64(0)], np.cumsum(mix(h ^ np.uint64(0xA5A5A5A55A5A5A5A)))))
    return h, at, run[at[1:]] - run[at[:-1]]


#: Least and most words, of 64 places each, of a set's sketch; places for each shingle, at least, between them. Powers of two, so that halves fold.
SKETCH, LONGEST, PLACES = 8, 512, 1.5


def _sketches(h: np.ndarray, at: np.ndarray) -> pa.Array:
    """Each row's sketch: whether an odd number of its shingles falls in a place."""
    n = np.diff(at)
    words = np.clip(2 ** np.ceil(np.log2(np.maximum(n * PLACES / 64, 1))).astype(np.int64), SKETCH, LONGEST)
    edge = np.concatenate(([0], np.cumsum(words)))
    out = np.zeros(int(edge[-1]), np.int64)
    for i in range(0, len(n), 1024):
        j = min(i + 1024, len(n))
        place = (h[at[i] : at[j]] >> np.uint64(20)).astype(np.int64) & np.repeat(64 * words[i:j] - 1, n[i:j])
        odd = np.bincount(place + np.repeat(64 * (edge[i:j] - edge[i]), n[i:j]), minlength=64 * int(edge[j] - edge[i])) & 1
        out[edge[i] : edge[j]] = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return _list(out, edge, _L)


def _list(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, kind))


NAMES = "kind int, id long, n long, name long, sketch array<long>"


def _named(batches):
    """Per text (kind 0) its size, name and sketch; per task (kind 1) shingles that several of its distinct sets hold."""
    held: list[np.ndarray] = []
    seen: set[int] = set()

    def frequent():
        s = np.sort(np.concatenate(held))
        held.clear()
        first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        count = np.diff(np.append(first, len(s)))
        top = np.flatnonzero(count >= LOCAL)
        top = top[np.argsort(-count[top], kind="stable")][:NAMED]
        return pa.RecordBatch.from_arrays([pa.array(np.ones(len(top)), _I), pa.array(s[first[top]].astype(np.int64)), pa.array(count[top], _L), pa.array(np.zeros(len(top)), _L), _list(np.zeros(0, np.int64), np.zeros(len(top) + 1), _L)], names=["kind", "id", "n", "name", "sketch"])

    for part in slices(batches):
        h, at, name = _sets(part.column("text"))
        n = np.diff(at)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n)), _I), part.column("doc_id"), pa.array(n, _L), pa.array(name.astype(np.int64)), _sketches(h, at)], names=["kind", "id", "n", "name", "sketch"])
        _, one = np.unique(name, return_index=True)
        fresh = [i for i in one if int(name[i]) not in seen]
        if len(seen) < 1_000_000:
            seen.update(int(name[i]) for i in fresh)
        keep = np.zeros(len(n), bool)
        keep[fresh] = True
        held.append(h[np.repeat(keep, n)])
        if sum(map(len, held)) > GATHERED:
            yield frequent()
    if held and sum(map(len, held)):
        yield frequent()


#: Tokens are the lower half of a shingle's hash, whose upper half chose the bucket: where two shingles meet in one token, a list has more members, whose sets are compared all the same.
POSTED = "bucket int, tokens array<int>, names array<long>, sizes array<int>, rest array<int>"


def _post(batches, sent, buckets: int):
    """The prefixes of a slice's distinct sets, packed by bucket: token, whose it is, and how many of its shingles come from there on."""
    common, rank = sent.value
    seen: set[int] = set()
    for part in slices(batches):
        h, at, name = _sets(part.column("text"))
        size = np.diff(at)
        _, one = np.unique(name, return_index=True)
        fresh = [i for i in one if size[i] and int(name[i]) not in seen]
        if len(seen) < 1_000_000:
            seen.update(int(name[i]) for i in fresh)
        keep = np.zeros(len(size), bool)
        keep[fresh] = True
        own = np.repeat(np.arange(len(size)), size)
        inside = keep[own]
        h, own = h[inside], own[inside]
        if not len(h):
            continue
        late = np.zeros(len(h), np.int64)
        if len(common):
            k = np.minimum(np.searchsorted(common, h), len(common) - 1)
            late = np.where(common[k] == h, rank[k], 0)
        order = np.lexsort((h, late, own))
        h, own = h[order], own[order]
        first = np.searchsorted(own, np.arange(len(size)))
        place = np.arange(len(h)) - first[own]
        n = size[own]
        inside = place < n - (PERCENT * n + 99) // 100 + 1
        h, own, rest = h[inside], own[inside], (n - place)[inside]
        b = ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        h, own, rest, b = h[order], own[order], rest[order], b[order]
        present, at = np.unique(b, return_index=True)
        at = np.append(at, len(b))
        yield pa.RecordBatch.from_arrays([pa.array(present, _I), _list(h.astype(np.uint32).view(np.int32), at, _I), _list(name[own].astype(np.int64), at, _L), _list(size[own], at, _I), _list(rest, at, _I)], names=[c.split()[0] for c in POSTED.split(", ")])


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) else array
    at = array.offsets.to_numpy().astype(np.int64)
    return array.values.to_numpy()[at[0] : at[-1]], np.diff(at)


LISTED = "list long, member long, size int, rest int, times int"


def _lists(table: pa.Table) -> pa.Table:
    """A bucket's index lists of two members or more: one row per member; lists of the same members are one, with the largest rest."""
    tokens, name, sizes, rest = (_flat(table.column(c))[0] for c in ("tokens", "names", "sizes", "rest"))
    order = np.lexsort((-rest, name, tokens))
    tokens, name, sizes, rest = tokens[order], name[order], sizes[order], rest[order]
    if len(tokens):  # a set that several slices sent counts once
        new = np.concatenate(([True], (tokens[1:] != tokens[:-1]) | (name[1:] != name[:-1])))
        tokens, name, sizes, rest = tokens[new], name[new], sizes[new], rest[new]
    first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1]))) if len(tokens) else np.zeros(0, np.int64)
    length = np.diff(np.append(first, len(tokens)))
    run = np.concatenate(([np.uint64(0)], np.cumsum(mix(name.astype(np.uint64)))))
    key = mix(run[first + length] - run[first] + length.astype(np.uint64))
    use = np.flatnonzero(length > 1)
    key, first, length = key[use], first[use], length[use]
    unique, lead, back, times = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    # the rows of each distinct list, and the largest rest over all lists like it
    n = length[lead]
    at = np.cumsum(n) - n
    rows = np.repeat(first[lead] - at, n) + np.arange(int(n.sum()))
    most = np.zeros(len(rows), np.int64)
    every = np.repeat(at[back] - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    source = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    np.maximum.at(most, every, rest[source])
    return pa.Table.from_arrays([pa.array(np.repeat(unique, n).astype(np.int64)), pa.array(name[rows], _L), pa.array(sizes[rows], _I), pa.array(most, _I), pa.array(np.repeat(times, n), _I)], names=[c.split()[0] for c in LISTED.split(", ")])


def _texts_sets(batches, asked: str):
    """(name, hashes, n) of the texts whose set has the name that is asked for."""
    for part in slices(batches):
        h, at, name = _sets(part.column("text"))
        keep = pa.array(name.astype(np.int64) == part.column("name").to_numpy())
        yield pa.RecordBatch.from_arrays([part.column("name"), part.column(asked), _list(h.astype(np.int64), at, _L)], names=["name", asked, "set"]).filter(keep)


def _compare(batches):
    """Intersections of each pivot with the sets that follow it."""
    pivot, have, size = None, np.zeros(0, np.int64), 0
    for batch in slices(batches):
        sort_of, at, name = _sets(batch.column("text"))
        keep = name.astype(np.int64) == batch.column("name").to_numpy()  # rows that repeat a doc_id may have another text
        if not keep.all():
            sort_of, at = sort_of[np.repeat(keep, np.diff(at))], np.concatenate(([0], np.cumsum(np.diff(at)[keep])))
            batch = batch.filter(pa.array(keep))
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("pivot", "salt")], 1)
        lead = batch.column("lead").to_numpy(zero_copy_only=False)
        names = batch.column("name").to_numpy()
        a, b, inter, na, nb = [], [], [], [], []
        edge = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for i, j in zip(np.concatenate(([0], edge)), np.append(edge, len(keys)), strict=True):
            if lead[i] == 0:
                pivot, have = tuple(keys[i]), sort_of[at[i] : at[i + 1]].copy()
                size = len(have)
                while i < j and lead[i] == 0:
                    i += 1
            if i == j:
                continue
            if pivot != tuple(keys[i]):
                raise ValueError("a pivot's set is missing")
            mine = sort_of[at[i] : at[j]]
            found = have[np.minimum(np.searchsorted(have, mine), size - 1)] == mine
            n = np.concatenate(([0], np.cumsum(found)))
            a.append(np.full(j - i, pivot[0]))
            b.append(names[i:j])
            inter.append(n[at[i + 1 : j + 1] - at[i]] - n[at[i:j] - at[i]])
            na.append(np.full(j - i, size))
            nb.append(np.diff(at[i : j + 1]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (a, b, inter, na, nb)], names=["a", "b", "inter", "na", "nb"])


#: Bits of the sieve that tells most documents whose sets nobody asks for, in words of 64.
SIEVE = 1 << 25


def fetched(docs: DataFrame, asked: DataFrame, column: str) -> DataFrame:
    """(name, column, text) of the documents asked for. asked: (name, doc_id, column).

    Their ids set bits in a sieve of SIEVE / 64 rows at most, which is broadcast, so that few
    other texts are shuffled; a full sieve lets all texts through, and the join decides either
    way. The join sorts and merges at any size.
    """
    asked = written(asked)
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE))
    place = {"word": F.shiftright(slot, 6), "bit": slot.bitwiseAND(63).cast("int")}
    words = asked.select("doc_id").withColumns(place).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    near = docs.select("doc_id", "text").filter("doc_id is not null").withColumns(place).join(F.broadcast(words), "word").filter("shiftright(bits, bit) & 1 = 1").select("doc_id", "text")
    return near.join(asked.hint("merge"), "doc_id").select("name", column, "text")


def possible(pairs: DataFrame, owners: DataFrame) -> DataFrame:
    """The pairs (a, b) of set names whose sketches leave a link possible: an exact bound, 2 |A & B| <= |A| + |B| - places that differ. The sizes of a pair are within PERCENT, so one sketch is at most twice as long and folds. owners: (name, size, sketch)."""
    x, y = (owners.select(F.col("name").alias(k), F.col("size").alias("size" + k), F.col("sketch").alias("sketch" + k)) for k in "ab")

    def folded(mine: str, other: str):
        n = F.size(other)
        return F.when(F.size(mine) > n, F.zip_with(F.slice(mine, 1, n), F.slice(mine, n + 1, n), lambda p, q: p.bitwiseXOR(q))).otherwise(F.col(mine))

    differ = F.zip_with(folded("sketcha", "sketchb"), folded("sketchb", "sketcha"), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(differ, F.lit(0), lambda total, k: total + k)
    want = F.expr(f"({PERCENT} * (sizea + sizeb) + {99 + PERCENT}) div {100 + PERCENT}")
    return pairs.join(x, "a").join(y, "b").filter(2 * want <= F.col("sizea") + F.col("sizeb") - apart).select("a", "b")


def compared(docs: DataFrame, owners: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, inter, na, nb) of the distinct pairs (a, b) of set names. owners: (name, doc_id), one document of each set. Each set goes once to each of its pivots a; large groups of a pivot are salted."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
    to = pairs.join(salts, "a").select(F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.lit(1).alias("lead"), F.col("b").alias("name"))
    to = to.union(salts.select(F.col("a").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("lead"), F.col("a").alias("name")))
    asked = to.groupBy("name").agg(F.collect_list(F.struct("pivot", "salt", "lead")).alias("pivots")).join(owners.select("name", "doc_id"), "name")
    texts = fetched(docs, asked, "pivots")  # texts are shorter than their sets
    # rows that repeat a doc_id may have repeated its text too; a pivot's further copies are passed over, members' fall to the distinct below
    dealt = texts.select("name", "text", F.explode("pivots").alias("p")).select("p.*", "name", "text").repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "lead")
    return dealt.mapInArrow(_compare, "a long, b long, inter long, na long, nb long").distinct()


def in_blocks(members: DataFrame, most) -> DataFrame:
    """Members dealt to pairs of blocks, so that no list is one group: block (a pair's key), same (the pair is one block), side (0, 1) and the members' columns.

    members: list, part, member, label, size, rest and others. A list's members of one part and
    band of sizes are a cell, cut by hash into blocks of about most (a column over band) members. Every
    pair of a list's members is in exactly one block pair, but for pairs of cells that hold one
    label together, or whose sizes or rests are too far apart or too small for a link.
    """
    members = members.withColumn("band", F.floor(F.log("size") / math.log(BAND)).cast("int"))
    cells = members.groupBy("list", "part", "band").agg(F.ceil(F.count("*") / most).cast("int").alias("blocks"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("size").alias("least"), F.max("rest").alias("most"))
    cells = written(cells)
    x, y = (cells.select("list", *(F.col(c).alias(c + k) for c in cells.columns if c != "list")) for k in "xy")
    pairs = x.withColumn("bandy", F.explode(F.array("bandx", F.col("bandx") + 1))).join(y, ["list", "bandy"]).filter("bandx < bandy or partx <= party")
    pairs = pairs.filter("not (lox = hix and loy = hiy and lox = loy)").filter(f"{100 + PERCENT} * cast(least(mostx, mosty) as bigint) >= {PERCENT} * (leastx + leasty)").withColumn("one", F.expr("partx = party and bandx = bandy"))
    pairs = pairs.select("list", "partx", "bandx", "blocksx", "party", "bandy", "blocksy", "one")
    own, i = F.pmod(F.xxhash64("member"), F.col("blocksx")).cast("int"), F.pmod(F.xxhash64("member"), F.col("blocksy")).cast("int")
    left = members.join(pairs.withColumns({"part": F.col("partx"), "band": F.col("bandx")}), ["list", "part", "band"]).withColumn("i", own)
    left = left.withColumn("j", F.explode(F.sequence(F.when(F.col("one"), F.col("i")).otherwise(0), F.col("blocksy") - 1))).withColumn("side", F.lit(0))
    right = members.join(pairs.withColumns({"part": F.col("party"), "band": F.col("bandy")}), ["list", "part", "band"]).withColumn("j", i)
    right = right.withColumn("i", F.explode(F.filter(F.sequence(F.lit(0), F.col("blocksx") - 1), lambda k: ~F.col("one") | (k < F.col("j"))))).withColumn("side", F.lit(1))
    kept = [F.xxhash64("list", "partx", "bandx", "i", "party", "bandy", "j").alias("block"), (F.col("one") & (F.col("i") == F.col("j"))).alias("same"), "side", *(c for c in members.columns if c not in ("list", "part", "band"))]
    return left.select(*kept).union(right.select(*kept))


def _groups(batches):
    """Whole block pairs, one table each, of rows sorted by block."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("block").to_numpy()
        edge = np.flatnonzero(key[1:] != key[:-1]) + 1
        for i, j in zip(np.concatenate(([0], edge)), np.append(edge, len(key)), strict=True):
            if held and key[i] != at:
                yield pa.Table.from_batches(held)
                held = []
            at = key[i]
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


#: Pairs that a task holds before it sends them.
HELD = 300_000


def _cross(batches):
    """Of each pair of blocks, pairs of members not connected yet that sizes and positions allow: sure where their answers with the pivot decide for a link, left out where they decide against one, else to be compared."""
    a, b, d, held = [], [], [], 0

    def sent():
        pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b), np.concatenate(d).astype(np.int64)], 1), axis=0)
        for x in (a, b, d):
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], _L), pa.array(pairs[:, 1], _L), pa.array(pairs[:, 2] == 1)], names=["a", "b", "sure"])

    for group in _groups(batches):
        side = group.column("side").to_numpy()
        name, size, rest, label, inter, pn = (group.column(k).to_numpy().astype(np.int64) for k in ("member", "size", "rest", "label", "inter", "pivot_size"))
        same = group.column("same")[0].as_py()
        x = np.flatnonzero(side == 0)
        y = x if same else np.flatnonzero(side == 1)
        apart = label[x][:, None] != label[y]
        apart &= 100 * np.minimum.outer(size[x], size[y]) >= PERCENT * np.maximum.outer(size[x], size[y])
        i, j = np.nonzero(np.triu(apart, 1) if same else apart)
        i, j = x[i], y[j]
        want = needed(size[i], size[j])
        known = (inter[i] >= 0) & (inter[j] >= 0)
        upper = np.minimum(inter[i], inter[j]) + np.minimum(size[i] - inter[i], size[j] - inter[j])
        keep = (np.minimum(rest[i], rest[j]) >= want) & (~known | (upper >= want))
        i, j, want, known = i[keep], j[keep], want[keep], known[keep]
        if len(i):
            a.append(np.minimum(name[i], name[j]))
            b.append(np.maximum(name[i], name[j]))
            d.append(known & (inter[i] + inter[j] - pn[i] >= want))
            held += len(i)
        if held > HELD:
            yield sent()
            held = 0
    if a:
        yield sent()


def crossed(opened: DataFrame) -> DataFrame:
    """opened (list, member, size, rest, label, inter, pivot_size) dealt to block pairs. A label of half a block or more in a list has blocks of its own, so its pairs with itself are never formed."""
    heavy = opened.groupBy("list", "label").agg(F.count("*").alias("n")).filter(F.col("n") >= BLOCK // 2).select("list", "label", F.col("label").alias("part"))
    parted = written(opened.join(heavy, ["list", "label"], "left").withColumn("part", F.coalesce("part", F.lit(0).cast("long"))).select("list", "part", "member", "label", "size", "rest", "inter", "pivot_size"))
    return in_blocks(parted, F.lit(BLOCK)).repartition("block").sortWithinPartitions("block")


#: Shingles of a block of sets, about; shingles that one matrix product counts.
BLOCK_SHINGLES, COLUMNS = 1 << 20, 1024


def shared_shingles(row_a: np.ndarray, token_a: np.ndarray, na: int, row_b: np.ndarray, token_b: np.ndarray, nb: int) -> np.ndarray:
    """Sizes of all intersections of na sets with nb, (na, nb), from their (row, token) entries. Shingles of many pairs are counted by matrix products, others pair by pair."""
    both = np.intersect1d(token_a, token_b)
    inter = np.zeros((na, nb), np.float32)
    if not len(both):
        return inter

    def entries(row, token):
        k = np.minimum(np.searchsorted(both, token), len(both) - 1)
        inside = both[k] == token
        k, row = k[inside], row[inside]
        order = np.argsort(k, kind="stable")
        return k[order], row[order], np.searchsorted(k[order], np.arange(len(both) + 1))

    (ka, ra, at_a), (kb, rb, at_b) = entries(row_a, token_a), entries(row_b, token_b)
    ca, cb = np.diff(at_a), np.diff(at_b)
    dense = ca * cb > max(16, na * nb // 256)
    many = np.flatnonzero(dense)
    for i in range(0, len(many), COLUMNS):
        place = np.full(len(both), -1)
        place[many[i : i + COLUMNS]] = np.arange(len(many[i : i + COLUMNS]))
        m = []
        for k, r, n in ((ka, ra, na), (kb, rb, nb)):
            x = np.zeros((n, len(many[i : i + COLUMNS])), np.float32)
            inside = place[k] >= 0
            x[r[inside], place[k[inside]]] = 1
            m.append(x)
        inter += m[0] @ m[1].T
    few = np.flatnonzero(~dense)
    run = np.cumsum(ca[few] * cb[few])
    cut = 0
    while cut < len(few):
        end = max(cut + 1, int(np.searchsorted(run, (run[cut - 1] if cut else 0) + (1 << 21), "right")))
        t = few[cut:end]
        n = ca[t] * cb[t]
        k = np.repeat(np.arange(len(t)), n)
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        pair = ra[at_a[t][k] + at // cb[t][k]] * nb + rb[at_b[t][k] + at % cb[t][k]]
        inter += np.bincount(pair, minlength=na * nb).reshape(na, nb)
        cut = end
    return inter


def _count_links(batches):
    """(name, n): links of each set in each pair of blocks that it is in."""
    for group in _groups(batches):
        name, side, same = group.column("name").to_numpy(), group.column("side").to_numpy(), group.column("same")[0].as_py()
        values, size = _flat(group.column("set"))
        at = np.cumsum(size) - size
        sides = []
        for k in (0,) if same else (0, 1):
            rows = np.flatnonzero(side == k)
            rows = rows[np.unique(name[rows], return_index=True)[1]]  # a repeated row's set counts once
            n = size[rows]
            own = np.repeat(np.arange(len(rows)), n)
            sides.append((own, values[at[rows][own] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)], len(rows), name[rows], n))
        x, y = sides[0], sides[-1]
        linked = shared_shingles(*x[:3], *y[:3]) >= needed(x[4][:, None], y[4])
        if same:
            np.fill_diagonal(linked, False)
        for who, n in ((x[3], linked.sum(1)),) if same else ((x[3], linked.sum(1)), (y[3], linked.sum(0))):
            has = n > 0
            if has.any():
                yield pa.RecordBatch.from_arrays([pa.array(who[has], _L), pa.array(n[has].astype(np.int64))], names=["name", "n"])


def link_counts(docs: DataFrame, owners: DataFrame, labels: DataFrame, sizes: DataFrame) -> DataFrame:
    """(name, n_links): of every linked set the exact number of distinct sets at PERCENT, from all pairs of its class, which hold all its links. labels (node, label); sizes (name, size).

    A class's sets are dealt in block pairs, each pair of sets to one of them, so that work
    is quadratic in a class but no task holds it; a class of two sets is its one link.
    """
    members = labels.groupBy("label").agg(F.count("*").alias("n")).join(labels, "label").join(sizes.withColumnRenamed("name", "node"), "node")
    members = written(members.select(F.col("label").alias("list"), F.lit(0).cast("long").alias("part"), F.col("node").alias("member"), F.col("node").alias("label"), "size", F.col("size").alias("rest"), "n"))
    most = F.greatest(F.lit(16), F.least(F.lit(BLOCK), F.floor(BLOCK_SHINGLES / F.pow(F.lit(BAND), F.col("band") + 1))))
    to = in_blocks(members.filter("n > 2").drop("n"), most)
    asked = to.groupBy(F.col("member").alias("name")).agg(F.collect_list(F.struct("block", "same", "side")).alias("blocks")).join(owners.select("name", "doc_id"), "name")
    sets = fetched(docs, asked, "blocks").mapInArrow(lambda it: _texts_sets(it, "blocks"), "name long, blocks array<struct<block:long,same:boolean,side:int>>, set array<long>")
    dealt = sets.select("name", "set", F.explode("blocks").alias("b")).select("b.*", "name", "set").repartition("block").sortWithinPartitions("block")
    found = dealt.mapInArrow(_count_links, "name long, n long").groupBy("name").agg(F.sum("n").alias("n_links"))
    return found.union(members.filter("n = 2").select("member", F.lit(1).cast("long")))


def similarity_classes(docs: DataFrame, buckets: int | None = None, links: bool = True) -> DataFrame:
    """Classes of near-duplicate texts.

    Per row of docs: doc_id, n_shingles, component_id (smallest doc_id of the class that links
    connect, its own included) and, if links are asked for, n_links (the exact number of other
    classes of equal sets that its set is linked with). Null and empty texts have no shingle
    and are linked with nothing. A null doc_id is never a class's id and has a null
    component_id if its class has no other; rows that repeat a doc_id stay.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    named = written(docs.mapInArrow(_named, NAMES))
    common = named.filter("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").limit(COMMON).toArrow()
    token, rank = common.column("id").to_numpy().astype(np.int64).view(np.uint64), np.argsort(np.argsort(common.column("n").to_numpy(), kind="stable")) + 1
    order = np.argsort(token)
    sent = spark.sparkContext.broadcast((token[order], rank[order]))
    names = named.filter("kind = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "name")
    prefixes = names.filter("n_shingles > 0").agg(F.coalesce(F.sum(F.expr(f"n_shingles - ({PERCENT} * n_shingles + 99) div 100 + 1")), F.lit(0))).first()[0]
    buckets = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-prefixes // PER_BUCKET))
    owners = written(named.filter("kind = 0 and n > 0 and id is not null").groupBy("name").agg(F.min("id").alias("doc_id"), F.max("n").alias("size"), F.first("sketch").alias("sketch")))

    posted = docs.filter("doc_id is not null").select("text").mapInArrow(lambda it: _post(it, sent, buckets), POSTED)
    lists = written(posted.groupBy("bucket").applyInArrow(_lists, LISTED).groupBy("list", "member").agg(F.max("size").alias("size"), F.max("rest").alias("rest"), F.sum("times").cast("int").alias("times")))
    # the member that shares most of its prefix is every list's pivot
    degree = lists.groupBy("member").agg((F.sum("times") / F.max("size")).alias("degree"))
    ranked = lists.join(degree, "member")
    pivots = ranked.groupBy("list").agg(F.max(F.struct("degree", "size", "member", "rest")).alias("p"), F.count("*").alias("n_members")).select("list", "n_members", F.col("p.member").alias("pivot"), F.col("p.size").alias("pivot_size"), F.col("p.rest").alias("pivot_rest"))
    starred = written(lists.drop("times").join(pivots, "list"))
    want = F.floor((PERCENT * (F.col("size") + F.col("pivot_size")) + 99 + PERCENT) / (100 + PERCENT))
    star = starred.filter("member <> pivot").filter((100 * F.least("size", "pivot_size") >= PERCENT * F.greatest("size", "pivot_size")) & (F.least("rest", "pivot_rest") >= want))
    asked = written(possible(star.select(F.col("pivot").alias("a"), F.col("member").alias("b")).distinct(), owners))
    first = written(compared(docs, owners, asked))
    linked = F.expr(f"100 * inter >= {PERCENT} * (na + nb - inter)")
    edges = first.filter(linked).select("a", "b")
    labels = components(edges)

    longer = starred.filter("n_members > 2").join(labels.select(F.col("node").alias("member"), "label"), "member", "left").withColumn("label", F.coalesce("label", "member"))
    split = longer.groupBy("list").agg((F.min("label") < F.max("label")).alias("open")).filter("open").select("list")
    answers = first.select(F.col("a").alias("pivot"), F.col("b").alias("member"), "inter")
    opened = longer.join(split, "list").join(answers, ["pivot", "member"], "left").withColumn("inter", F.when(F.col("pivot") == F.col("member"), F.col("size")).otherwise(F.coalesce("inter", F.lit(-1))))
    pairs = crossed(opened).mapInArrow(_cross, "a long, b long, sure boolean")
    pairs = written(pairs.groupBy("a", "b").agg(F.max("sure").alias("sure")))
    known = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = written(possible(pairs.filter("not sure").select("a", "b").join(known, ["a", "b"], "left_anti"), owners))
    more = written(compared(docs, owners, rest).filter(linked).select("a", "b").union(pairs.filter("sure").select("a", "b")))
    if not more.isEmpty():
        edges = edges.union(more)
        labels = components(edges)
    labelled = names.join(labels.withColumnRenamed("node", "name"), "name", "left").withColumn("label", F.when(F.col("n_shingles") > 0, F.coalesce("label", "name")))
    ids = labelled.filter("label is not null").groupBy("label").agg(F.min("doc_id").alias("least"))
    columns = ["doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")]
    labelled = labelled.join(ids, "label", "left")
    if links:
        sizes = names.filter("n_shingles > 0").groupBy("name").agg(F.max("n_shingles").cast("int").alias("size"))
        labelled = labelled.join(link_counts(docs, owners, labels, sizes), "name", "left")
        columns.append(F.when(F.col("n_shingles") > 0, F.coalesce("n_links", F.lit(0).cast("long"))).otherwise(0).alias("n_links"))
    return labelled.select(*columns)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(read(spark, sf_dir, "documents"), links=False)


def op4_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of op4_jaccard with n_links, for which its SQL has no column."""
    return similarity_classes(read(spark, sf_dir, "documents"))
