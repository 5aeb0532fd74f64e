"""Language of a text: a bidirectional gated recurrent network over bytes.

Each direction reads a window of bytes with state h and gate z:

    [z, n] = tanh(A[byte] + U h),  g = (z + 1) / 2,  h' = h + g (n - h)

Both states label every byte with language probabilities; a text's probabilities are the
mean over its bytes. Trained in numpy by backpropagation through time on windows of a
bounded sample; texts are labelled in windows of the same width, all bytes of all texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import fold, read, slices, text_bytes, written

#: Bytes of a window, state of a direction, labelled texts of a language and windows of a text to learn from, at most, passes, step.
WINDOW, STATE = 64, 8
PER_LANGUAGE, WINDOWS = 400, 6
#: How many times PER_LANGUAGE texts of a language are ranked to find those of lowest hash.
SPARE = 4
#: Languages whose bounds are broadcast, at most; beyond that windows are shuffled by language.
BROADCAST = 100_000
EPOCHS, BATCH, RATE, SEED = 14, 128, 0.01, 11
UNKNOWN = "und"
#: Windows that run through the network together; fewer where there are more than MANY languages.
TOGETHER, MANY = 4096, 64


def cut(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of WINDOW bytes (zero-filled), their lengths and rows."""
    size = np.diff(at)
    each = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), each)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    start = at[:-1][row] + nth * WINDOW
    length = np.minimum(WINDOW, at[1:][row] - start)
    padded = np.concatenate((raw, np.zeros(WINDOW, np.uint8)))
    window = padded[start[:, None] + np.arange(WINDOW)]
    window[np.arange(WINDOW) >= length[:, None]] = 0
    return window, length, row


def start_weights(k: int) -> dict[str, np.ndarray]:
    rng = np.random.RandomState(SEED)
    w = {}
    for d in "fb":
        w["A" + d] = rng.normal(0, 0.3, (256, 2 * STATE)).astype(np.float32)
        w["U" + d] = rng.normal(0, 0.3, (2 * STATE, STATE)).astype(np.float32)
    return w | {"V": rng.normal(0, 0.3, (k, 2 * STATE)).astype(np.float32), "c": np.zeros(k, np.float32)}


def states(w: dict, x: np.ndarray, keep: bool = False):
    """States of both directions at each position, (2 STATE, T, B); x is (T, B). keep: also gates and candidates, for training."""
    t, b = x.shape
    out = np.empty((t, 2 * STATE, b), np.float32)
    kept = {}
    for d, steps, at in (("f", range(t), 0), ("b", range(t - 1, -1, -1), STATE)):
        table, u = np.ascontiguousarray(w["A" + d].T), w["U" + d]
        h = np.zeros((STATE, b), np.float32)
        for s in steps:
            a = np.take(table, x[s], axis=1)
            a += u @ h
            np.tanh(a, out=a)
            g = a[:STATE] * 0.5
            g += 0.5
            if keep:
                kept[d, s] = (h, g, a[STATE:])
            h = h + g * (a[STATE:] - h)
            out[s, at : at + STATE] = h
    return out, kept


def label(w: dict, out: np.ndarray) -> np.ndarray:
    """Language probabilities of every position, (T, k, B)."""
    z = np.matmul(w["V"], out)
    z += w["c"][:, None]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def gradients(w: dict, x: np.ndarray, inside: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss over all labelled positions, by backpropagation through time."""
    t, b = x.shape
    out, kept = states(w, x, True)
    err = label(w, out)
    err[:, y, np.arange(b)] -= 1
    err *= inside[:, None, :] / inside.sum()
    g = {"V": np.einsum("tkb,tsb->ks", err, out), "c": err.sum((0, 2))}
    back = np.matmul(w["V"].T, err)
    for d, steps, at in (("f", range(t - 1, -1, -1), 0), ("b", range(t), STATE)):
        ga, gu = np.zeros((256, 2 * STATE), np.float32), np.zeros((2 * STATE, STATE), np.float32)
        dh = np.zeros((STATE, b), np.float32)
        for s in steps:
            h, gate, n = kept[d, s]
            dh = dh + back[s, at : at + STATE]
            da = np.concatenate((dh * (n - h) * 2 * gate * (1 - gate), dh * gate * (1 - n * n)))
            gu += da @ h.T
            np.add.at(ga, x[s], da.T)
            dh = dh * (1 - gate) + w["U" + d].T @ da
        g["A" + d], g["U" + d] = ga, gu
    return g


def train(window: np.ndarray, length: np.ndarray, y: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """Adam over shuffled batches of windows."""
    w = start_weights(k)
    m, v = ({n: np.zeros_like(a) for n, a in w.items()} for _ in range(2))
    rng, step = np.random.RandomState(SEED), 0
    weight = len(y) / np.maximum(1, np.bincount(y, minlength=k)) / k
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(order), BATCH):
            b = order[i : i + BATCH]
            inside = (np.arange(WINDOW)[:, None] < length[b]).astype(np.float32) * weight[y[b]].astype(np.float32)
            step += 1
            for n, g in gradients(w, window[b].T, inside, y[b]).items():
                m[n] = 0.9 * m[n] + 0.1 * g
                v[n] = 0.99 * v[n] + 0.01 * g * g
                w[n] -= RATE * 0.9**epoch * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-8)
    return w


def sample(docs: DataFrame) -> tuple[list[str], list[bytes], np.ndarray]:
    """Languages, and at most PER_LANGUAGE texts of each (those of lowest hash) outside the held-out part. Of a text, WINDOWS windows spread over it are taken.

    Languages are counted first; from the counts follows a bound on the hash under which
    SPARE times as many texts are expected, so that few rows of a common language are ranked.
    """
    known = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & (F.col("text") != "")).filter(fold(4) != 2).withColumn("at", F.xxhash64("doc_id"))
    counts = written(known.groupBy("lang").count())
    rare = F.col("count") <= SPARE * PER_LANGUAGE
    bound = counts.select("lang", F.when(rare, float(1 << 63)).otherwise((2.0 * SPARE * PER_LANGUAGE / F.col("count") - 1) * float(1 << 63)).alias("bound"))
    spread = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda i: F.substring("text", (F.length("text") - WINDOW) * i / (WINDOWS - 1) + 1, F.lit(WINDOW)))
    few = F.when(F.length("text") <= WINDOW, F.array("text")).otherwise(spread)
    first = Window.partitionBy("lang").orderBy("at", "parts")
    # windows are cut before rows move; the bounds, one row a language, go to the texts while they are few
    parts = known.select("lang", "at", few.alias("parts"))
    near = parts.join(F.broadcast(bound) if counts.count() <= BROADCAST else bound, "lang").filter(F.col("at") <= F.col("bound"))
    chosen = near.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= PER_LANGUAGE)
    rows = sorted(chosen.select("lang", "nth", "parts").collect(), key=lambda r: (r.lang, r.nth))
    langs = sorted({r.lang for r in rows})
    place = {lang: k for k, lang in enumerate(langs)}
    texts = [p.encode()[:WINDOW] for r in rows for p in r.parts]
    return langs, texts, np.array([place[r.lang] for r in rows for _ in r.parts], np.int64)


def learn(docs: DataFrame) -> tuple[list[str], dict | None]:
    langs, texts, y = sample(docs)
    if not texts:
        return [], None
    at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    window, length, row = cut(np.frombuffer(b"".join(texts), np.uint8), at)
    return langs, train(window, length, y[row], len(langs))


def pooled(w: dict, raw: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Sum of the probabilities over the bytes of each text, (texts, k)."""
    total = np.zeros((len(at) - 1, k))
    window, length, row = cut(raw, at)
    order = np.argsort(-length, kind="stable")
    together = max(1, TOGETHER * MANY // max(MANY, k))
    for i in range(0, len(order), together):
        part = order[i : i + together]
        x = np.ascontiguousarray(window[part, : length[part[0]]].T)
        p = label(w, states(w, x)[0])
        p *= (np.arange(len(x))[:, None] < length[part])[:, None, :]
        p = p.sum(0)
        for j in range(k):
            total[:, j] += np.bincount(row[part], p[j], len(total))
    return total


def _predict(batches, langs: list[str], w: dict | None):
    for part in slices(batches):
        raw, at = text_bytes(part.column("text"))
        if w is None:
            p = np.zeros((part.num_rows, 1))
            names = [UNKNOWN]
        else:
            p, names = pooled(w, raw, at, len(langs)), langs
        size = np.maximum(1, np.diff(at))
        score = np.clip(p.max(1) / size, 0, 1)
        best = pa.array([names[i] for i in p.argmax(1)], pa.string())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("fold"), part.column("letters"), best, pa.array(score)], names=["doc_id", "fold", "letters", "lang", "score"])


def identify(docs: DataFrame) -> DataFrame:
    """Language of every text.

    Per row of docs: doc_id, held_out, lang_pred (a learned language; ``und`` where the text is
    null or has no letter, or nothing could be learned), score (mean probability of that
    language over the bytes; 0 for und). Ties go to the first language in order. A null doc_id
    is in no held-out part and may be learned from; repeated rows are each labelled; every
    byte of a text of any length is read.
    """
    langs, w = learn(docs)
    frame = docs.select("doc_id", fold(4).alias("fold"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"), "text")
    out = frame.mapInArrow(lambda it: _predict(it, langs, w), "doc_id long, fold int, letters boolean, lang string, score double")
    known = F.col("letters") & (F.col("lang") != UNKNOWN)
    return out.select("doc_id", (F.col("fold") == 2).alias("held_out"), F.when(known, F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"), F.when(known, F.col("score")).otherwise(0.0).alias("score"))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))
