"""Toxicity: a factorization machine over hashed terms.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where x_i says whether a
text holds a term of slot i. The second sum learns pairs, such as an insult and whom it is
meant for, which additive weights miss; it is half of (sum v)^2 - sum v^2. Only the slots
most associated with the label have factors v: a text has hundreds of other terms, whose
pairs would drown the few that matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ALNUM, LOWER, distinct_sets, fold, read, slices, text_bytes, word_hashes, words

SLOTS = 1 << 20
#: Fixed values of training: labelled documents at most (those of lowest hash), factors, slots that have them, passes, how many of them come before factors move, and documents that a slot must occur in (a hundredth of few).
MAX_TRAINING, FACTORS, PAIRED, EPOCHS, ALONE, MIN_ROWS = 12_000, 4, 32, 28, 20, 30
#: Step, rows of a step, how much each occurrence shrinks a weight towards zero, and what share of it decays a factor; spread of factors at the start.
RATE, BATCH, SHRINK_W, DECAY_V, SPREAD, SEED = 0.25, 64, 0.1, 0.05, 0.05, 7
THRESHOLD = 0.3


def slots(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (slot, row) of a text column's terms, ascending by row."""
    raw, at = text_bytes(column)
    low = LOWER[raw]
    start, end, row = words(low, at, ALNUM)
    h = word_hashes(low, start, end) & np.uint64(SLOTS - 1)
    return distinct_sets(h.astype(np.int32), row)


def _slot_lists(batches):
    for part in slices(batches):
        slot, row = slots(part.column("text"))
        at = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("order"), part.column("toxic"), pa.ListArray.from_arrays(at, pa.array(slot, pa.int32()))], names=["doc_id", "order", "toxic", "slots"])


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING) -> tuple[np.ndarray, list[np.ndarray]]:
    """Labels and slots of at most limit labelled documents outside the held-out part, in an order of their own. Where rows repeat a doc_id, one of them counts: that of lowest text hash."""
    known = labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(fold(4) != 2).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    text = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # the limit bounds it
    listed = text.select("doc_id", "text", F.xxhash64("text").alias("order"), F.col("toxic").cast("int").alias("toxic")).mapInArrow(_slot_lists, "doc_id long, order long, toxic int, slots array<int>")
    rows = listed.groupBy("doc_id").agg(F.min(F.struct("order", "toxic", "slots")).alias("x")).select("x.toxic", "x.slots").toArrow()
    lists = rows.column("slots").combine_chunks()
    if not len(rows):
        return np.zeros(0), []
    at = lists.offsets.to_numpy()
    values = lists.values.to_numpy()
    y = rows.column("toxic").to_numpy().astype(float)
    found = [values[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    order = sorted(range(len(y)), key=lambda i: (len(found[i]), found[i].tobytes(), y[i]))
    order = np.random.RandomState(SEED).permutation(np.array(order))
    return y[order], [found[i] for i in order]


def _by_slot(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of ids by slot, first place of each slot in that order, and the slots."""
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_ids[1:] != sorted_ids[:-1])))
    return order, first, sorted_ids[first]


def associated(y: np.ndarray, found: list[np.ndarray], active: np.ndarray) -> np.ndarray:
    """Which of the active slots are the PAIRED whose share of label 1 is farthest from all rows', in standard errors."""
    rows = np.bincount(np.concatenate(found), minlength=SLOTS)[active]
    ones = np.bincount(np.concatenate(found), np.repeat(y, [len(f) for f in found]), SLOTS)[active]
    rate = y.mean()
    far = np.abs(ones - rows * rate) / np.sqrt(rows * rate * (1 - rate) * (1 - rows / len(y)) + 1e-9)
    out = np.zeros(len(active), bool)
    out[np.argsort(-far, kind="stable")[:PAIRED]] = True
    return out


def train(y: np.ndarray, found: list[np.ndarray]) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights by slot and factors by slot, by AdaGrad on the log loss. Without both labels: a constant."""
    w, v = np.zeros(SLOTS, np.float32), np.zeros((SLOTS, FACTORS), np.float32)
    rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    b = float(np.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return b, w, v
    rows = np.bincount(np.concatenate(found), minlength=SLOTS)
    active = np.flatnonzero(rows >= max(2, min(MIN_ROWS, len(y) // 100)))
    if not len(active):
        return b, w, v
    paired = associated(y, found, active)
    index = np.full(SLOTS, -1)
    index[active] = np.arange(len(active))
    x = [k[k >= 0] for k in (index[f] for f in found)]
    rng = np.random.RandomState(SEED)
    aw, av = np.zeros(len(active)), rng.normal(0, SPREAD, (len(active), FACTORS)) * paired[:, None]
    gw, gv, gb = np.full(len(active), 1e-2), np.full((len(active), FACTORS), 1e-2), 1e-2
    for epoch in range(EPOCHS):  # weights take what single terms say, then factors what is left
        order = rng.permutation(len(y))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            ids, row = np.concatenate([x[i] for i in batch]), np.repeat(np.arange(len(batch)), [len(x[i]) for i in batch])
            if not len(ids):
                continue
            some = paired[ids] & (epoch >= ALONE)
            pids, prow = ids[some], row[some]
            vi = av[pids]
            total = np.stack([np.bincount(prow, vi[:, k], len(batch)) for k in range(FACTORS)], 1)
            z = b + np.bincount(row, aw[ids], len(batch)) + 0.5 * ((total * total).sum(1) - np.bincount(prow, (vi * vi).sum(1), len(batch)))
            err = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]
            to, first, slot = _by_slot(ids)
            times = np.diff(np.append(first, len(ids)))
            dw = np.add.reduceat(err[row][to], first)
            gw[slot] += dw * dw
            moved = aw[slot] - RATE * dw / np.sqrt(gw[slot])
            aw[slot] = np.sign(moved) * np.maximum(0, np.abs(moved) - RATE * SHRINK_W * times / np.sqrt(gw[slot]))
            if len(pids):
                to, first, slot = _by_slot(pids)
                dv = np.add.reduceat((err[prow, None] * (total[prow] - vi) + DECAY_V * vi)[to], first, axis=0)
                gv[slot] += dv * dv
                av[slot] -= 0.5 * RATE * dv / np.sqrt(gv[slot])
            gb += err.sum() ** 2
            b -= RATE * err.sum() / np.sqrt(gb)
    w[active], v[active] = aw, av
    return float(b), w, v


def _scores(batches, model):
    b, ids, aw, av = model.value
    w, place = np.zeros(SLOTS, np.float32), np.full(SLOTS, -1, np.int32)
    w[ids] = aw
    paired = np.flatnonzero((av != 0).any(1))
    v = av[paired].astype(float)
    place[ids[paired]] = np.arange(len(paired))
    for part in slices(batches):
        n = part.num_rows
        slot, row = slots(part.column("text"))
        z = b + np.bincount(row, w[slot], n)
        some = place[slot] >= 0
        vi, row = v[place[slot[some]]], row[some]
        z -= 0.5 * np.bincount(row, (vi * vi).sum(1), n)
        for k in range(FACTORS):
            z += 0.5 * np.bincount(row, vi[:, k], n) ** 2
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("fold"), pa.array(score)], names=["doc_id", "fold", "score"])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every text.

    Per row of docs: doc_id, held_out, score (0 to 1), predicted (1 from THRESHOLD on). Null
    and empty texts have no term and get the model's bias; a text of any length is read
    whole. A document labelled more than once counts once, toxic if any label says so; labels
    without doc_id say nothing, and documents without one are scored and held in no fold.
    Repeated rows are each scored. Without labels the score is 0.5 for all. The model, of
    SLOTS weights at most, is all that is broadcast.
    """
    spark = docs.sparkSession
    b, w, v = train(*training_rows(docs, labels))
    ids = np.flatnonzero((w != 0) | (v != 0).any(1)).astype(np.int32)
    model = spark.sparkContext.broadcast((b, ids, w[ids], v[ids]))
    out = docs.select("doc_id", fold(4).alias("fold"), "text").mapInArrow(lambda it: _scores(it, model), "doc_id long, fold int, score double")
    return out.select("doc_id", (F.col("fold") == 2).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
