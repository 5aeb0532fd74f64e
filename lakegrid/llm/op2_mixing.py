"""Mixing to target weights with soft membership. DataFrame functions only.

A classifier learned from a table of labelled documents gives every document its posterior
probability of each domain. Rates r, one per document within [0, max_rate], are fitted so
that expected domain totals sum_d r_d t_d p_dk meet their targets b_k in least squares, by
projected gradient steps, each on the rates that the one before left:

    m_k = sum_d r_d t_d p_dk - b_k
    r_d = min(max_rate, max(0, r_d - step * w_d * sum_k p_dk m_k))

The gradient of half the squared misses is t_d sum_k p_dk m_k; it is scaled per document by
w_d / t_d with w_d = sum_k p_dk / (sum_d t_d p_dk^2), which any projection on bounds allows,
so that documents of small domains move as fast as those of large ones. The step is the
inverse of the largest eigenvalue of sum_d t_d w_d p_d p_d', so no step goes too far. Steps
start from rates carried on in their last direction (Nesterov's momentum, dropped when
misses grow). A step needs only the misses, one aggregate over the documents.
"""

from __future__ import annotations

import zlib
from functools import partial
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read, written

#: Labelled documents that the classifier learns from at most (those of lowest hash), terms it keeps, and documents a term needs.
MAX_LABELLED, TERMS, MIN_DOCS = 20_000, 256, 8
#: Passes over them, step and decay of the softmax regression.
PASSES, RATE, DECAY = 300, 0.05, 2e-3
#: Projected gradient steps at most, and steps between written tables of rates. A fit is done with misses below CLOSE of the goal, or where WINDOW steps took off less than GAIN of them.
STEPS, WRITTEN, CLOSE, WINDOW, GAIN = 200, 8, 1e-6, 10, 3e-3
#: Maps that the weights of terms are dealt to, so that a look-up reads few keys.
SLOTS = 64
#: Target share of each domain's tokens, and the largest rate.
TARGETS = {"good": 0.85, "poor": 0.10, "toxic": 0.05}
MAX_RATE = 8.0


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of labelled documents: toxic if any label says so, else poor if any says quality 0, else good. Rows without a label say nothing."""
    by = labels.select("doc_id", "quality", "toxic").filter("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    return by.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").otherwise("good").alias("domain"))


def _terms(text: Column) -> Column:
    """A text's terms: its lower-cased words, and marks of its style."""
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda letters: F.regexp_count(text, F.lit(letters)) / n
    bars = (F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit("")))) / n
    mark = lambda holds, name: F.when(holds, name).otherwise("")
    style = F.array(
        mark(share("[#*$%&<>]") > 0.02, "#symbols"), mark(bars > 0.02, "#bars"), mark(share("[A-Z]") > 0.3, "#capitals"),
        mark(share("[0-9]") > 0.1, "#digits"), mark(n < 200, "#short"), mark(n > 10_000, "#long"),
    )
    return F.concat(style, F.split(F.lower(text), WORD_ENDS))


#: Between words: ASCII and Latin-1 characters that are no letter or digit, and general and Han punctuation.
WORD_ENDS = r"[\x00-\x2f\x3a-\x60\x7b-\xa9\xab-\xb4\xb6-\xb9\xbb-\xbf\u2000-\u206f\u3000-\u303f]+"


def _words(text: Column) -> Column:
    """Number of words, parted by ASCII white space: other white space becomes spaces, at which splitting is cheap."""
    for c in "\n\t\r\x0b\f":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.size(F.array_remove(F.split(text, " "), "")).cast("long")


def _item(k: int, array: Column) -> Column:
    return array[k]


class Classifier:
    """Softmax regression over presence of chosen terms."""

    def __init__(self, domains: list[str], terms: list[str], start: np.ndarray, weights: np.ndarray):
        self.domains, self.terms, self.start, self.odds = domains, terms, start, weights

    def hits(self, terms: Column) -> Column:
        """The chosen ones among a text's terms, each once."""
        return F.array_intersect(F.array(*map(F.lit, self.terms)) if self.terms else F.array().cast("array<string>"), terms)

    def scores(self, hits: str) -> list[Column]:
        """One score column per domain from the column of terms present; their softmax is the posterior."""
        slots: list[list[Column]] = [[] for _ in range(SLOTS)]
        for t, o in zip(self.terms, self.odds, strict=True):
            slots[zlib.crc32(t.encode()) % SLOTS] += [F.lit(t), F.array(*(F.lit(float(x)) for x in o))]
        known = F.array(*(F.create_map(*x).cast("map<string,array<double>>") for x in slots))
        weights = F.transform(hits, lambda t: F.get(known, (F.crc32(t) % SLOTS).cast("int"))[t])
        return [F.lit(float(x)) + F.aggregate(F.transform(weights, partial(_item, k)), F.lit(0.0), lambda a, w: a + w) for k, x in enumerate(self.start)]


def learn(docs: DataFrame, domains: DataFrame) -> Classifier:
    """From at most MAX_LABELLED documents. Without any labelled document there is one domain, ``all``."""
    known = domains.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("domain", F.array_distinct(_terms(F.coalesce("text", F.lit("")))).alias("terms"))  # the limit bounds it
    rows = written(rows)
    counts = {r.domain: r["count"] for r in rows.groupBy("domain").count().collect()}
    names = sorted(counts)
    if not names:
        return Classifier(["all"], [], np.zeros(1), np.zeros((0, 1)))
    n = np.array([counts[k] for k in names], float)
    total = float(n.sum())
    by = rows.select("domain", F.explode("terms").alias("term")).filter("term <> ''").groupBy("term").agg(*(F.count(F.when(F.col("domain") == k, 1)).alias(f"n{i}") for i, k in enumerate(names)))
    every = sum(F.col(f"n{i}") for i in range(len(names)))
    apart = F.greatest(*(F.pow(F.col(f"n{i}") - every * (x / total), F.lit(2)) / (every * (x / total) + 1) for i, x in enumerate(n)), F.lit(0.0), F.lit(0.0))
    terms = [r.term for r in by.filter(every >= MIN_DOCS).withColumn("apart", apart).orderBy(F.desc("apart"), "term").limit(TERMS).collect()]
    place = {t: i for i, t in enumerate(terms)}
    held = rows.select("domain", Classifier(names, terms, np.zeros(0), np.zeros(0)).hits(F.col("terms")).alias("hits")).collect()
    x, y = np.zeros((len(held), len(terms)), np.float32), np.zeros((len(held), len(names)), np.float32)
    for i, r in enumerate(sorted(held, key=lambda r: (r.domain, sorted(r.hits)))):
        x[i, [place[t] for t in r.hits]] = 1
        y[i, names.index(r.domain)] = 1
    return Classifier(names, terms, *regression(x, y))


def regression(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intercepts and weights of a softmax regression, by Adam on all rows at once."""
    w = np.zeros((x.shape[1] + 1, y.shape[1]))
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    w[-1] = np.log(y.mean(0) + 1e-6)
    for t in range(1, PASSES + 1):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        g = x.T @ (p / p.sum(1, keepdims=True) - y) / len(x) + DECAY * w * (np.arange(len(w)) < len(w) - 1)[:, None]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= RATE * m / (1 - 0.9**t) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w[-1], w[:-1]


def memberships(docs: DataFrame, model: Classifier) -> DataFrame:
    """Per row: doc_id, n_tokens (words) and a posterior p_<domain> per domain, summing to 1. Null text: no words, no term."""
    text = F.coalesce("text", F.lit(""))
    frame = docs.select("doc_id", _words(text).alias("n_tokens"), model.hits(_terms(text)).alias("hits"))
    frame = frame.select("doc_id", "n_tokens", F.array(*model.scores("hits")).alias("scores"))
    if len(model.domains) == 1:
        return frame.select("doc_id", "n_tokens", F.lit(1.0).alias(f"p_{model.domains[0]}"))
    frame = frame.withColumn("most", F.array_max("scores"))
    weights = frame.select("doc_id", "n_tokens", F.transform("scores", lambda s: F.exp(s - F.col("most"))).alias("w")).withColumn("sum", F.aggregate("w", F.lit(0.0), lambda a, x: a + x))
    return weights.select("doc_id", "n_tokens", *((F.col("w")[k] / F.col("sum")).alias(f"p_{d}") for k, d in enumerate(model.domains)))


def _sums(table: DataFrame, *columns: Column) -> np.ndarray:
    return np.array([x or 0.0 for x in table.agg(*map(F.sum, columns)).first()])


def expected(table: DataFrame, names: list[str], rate: Column | None = None) -> np.ndarray:
    """Domain totals at rates, or at rate 1."""
    rate = F.lit(1.0) if rate is None else rate
    return _sums(table, *(F.col("n_tokens") * F.col(f"p_{d}") * rate for d in names))


class Fit(NamedTuple):
    table: DataFrame  # with rate
    totals: np.ndarray
    miss: float  # length of the misses, in lengths of the goal
    steps: int
    done: bool  # close to the goal, or as close as the bounds allow


def fit(table: DataFrame, names: list[str], goal: np.ndarray, most: float = MAX_RATE) -> Fit:
    """Rates of the rows of table (n_tokens, p_<domain> and others) for the goal (tokens by domain), from rate 1 on."""
    k, t, p, others = len(names), F.col("n_tokens"), [F.col(f"p_{d}") for d in names], list(table.columns)
    own = _sums(table, *(t * x * x for x in p))
    w = sum((F.lit(1.0 / max(1e-12, float(c))) * x for c, x in zip(own, p, strict=True)), F.lit(0.0))
    bend = _sums(table, *(t * w * a * b for a in p for b in p)).reshape(k, k)
    step = 1.0 / max(1e-12, float(np.linalg.eigvalsh(bend)[-1]))
    size, pace, misses = max(1.0, float(np.linalg.norm(goal))), 1.0, []
    table = table.withColumns({"rate": F.lit(float(min(1.0, most))), "ahead": F.lit(float(min(1.0, most)))})
    while True:
        off = expected(table, names, F.col("ahead")) - goal
        misses.append(float(np.linalg.norm(off)) / size)
        stalled = len(misses) > WINDOW and misses[-1] > (1 - GAIN) * misses[-1 - WINDOW]
        if misses[-1] < CLOSE or stalled or len(misses) > STEPS:
            totals = expected(table, names, F.col("rate"))
            return Fit(table.drop("ahead"), totals, float(np.linalg.norm(totals - goal)) / size, len(misses) - 1, misses[-1] < CLOSE or stalled)
        slope = sum((F.lit(float(step * m)) * x for m, x in zip(off, p, strict=True)), F.lit(0.0))
        if len(misses) > 1 and misses[-1] > misses[-2]:  # too much momentum
            pace = 1.0
        faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        table = table.withColumn("next", F.greatest(F.lit(0.0), F.least(F.lit(float(most)), F.col("ahead") - w * slope)))
        table = table.select(*others, F.col("next").alias("rate"), (F.col("next") + F.lit(float((pace - 1) / faster)) * (F.col("next") - F.col("rate"))).alias("ahead"))
        pace = faster
        if len(misses) % WRITTEN == 0:  # the plan stays short
            table = written(table)


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, most: float = MAX_RATE, anchor: str | None = None) -> DataFrame:
    """Rates that bring expected domain totals to their target shares.

    Per row of docs: doc_id, n_tokens, p_<domain> for each learned domain, rate (0 to most).
    Without anchor the total stays what it is; with it, the anchor domain keeps its tokens and
    no other domain gets more than it has. Domains without a target keep their share. Targets
    out of reach of the bounds are met as nearly as they allow, in least squares; ``fit`` says
    how nearly. Null text has no tokens and the rate its posteriors give. Repeated rows count
    each; doc_id may be null.
    """
    targets = TARGETS if targets is None else targets
    model = learn(docs, labelled_domains(labels))
    table = written(memberships(docs, model))
    totals = expected(table, model.domains)
    have = totals / max(1.0, totals.sum())
    want = np.array([targets.get(d, h) for d, h in zip(model.domains, have, strict=True)])
    want = want / want.sum() if want.sum() else want
    goal = want * totals.sum()
    if anchor in model.domains and want[k := model.domains.index(anchor)] > 0:
        goal = np.minimum(totals, want / want[k] * totals[k])
    return fit(table, model.domains, goal, most).table


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
