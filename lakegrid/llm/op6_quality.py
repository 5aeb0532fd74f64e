"""Quality rules: Jensen-Shannon distance of a document's histograms to language references. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import read, written

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Marks that stand at words; common words are compared without them and in lower case.
MARKS = ".,;:!?\"()[]"
#: Frequent function words of four languages.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are", "this", "from"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur", "avec"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una", "su", "para", "es"),
}
WORDS = tuple(sorted({w for ws in COMMON_WORDS.values() for w in ws}))
CLASSES = ("lower", "upper", "digit", "space", "symbol", "beyond", "rest")
#: Words a text needs before a histogram says anything, distances (square roots, base 2) from which it is rejected, and reference languages that one pass compares.
MIN_WORDS_CLASSES, MIN_WORDS_COMMON = 25, 60
MAX_CLASS_DISTANCE, MAX_COMMON_DISTANCE = 0.25, 0.30
TOGETHER = 64


def _count(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, letters, ""))


def features(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, the base counts, base_failed and the two histograms."""
    frame = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    frame = frame.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    frame = frame.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    # most characters are small letters; all other classes are counted without them
    frame = frame.withColumn("other", F.regexp_replace("text", "[a-z]+", ""))
    frame = frame.withColumn("plain", F.array_remove(F.split(F.translate("text", UPPER + MARKS, LOWER + " " * len(MARKS)), r"[\x20\x09-\x0D]+"), ""))
    other = F.col("other")
    frame = frame.select(
        "doc_id", "lang", "words",
        F.size("words").cast("long").alias("n_words"), F.size("plain").alias("n_plain"),
        F.length("text").alias("n_chars"), F.length(other).alias("n_other"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _count(other, SPACE).alias("space"), _count(other, SYMBOLS).alias("symbol"), _count(other, DIGITS).alias("digit"), _count(other, UPPER).alias("upper"),
        F.length(F.regexp_replace(other, r"[\x00-\x7F]+", "")).alias("beyond"),
        F.filter("plain", lambda w: w.isin(*WORDS)).alias("common"),
    )
    frame = frame.withColumn("windows", F.when(F.col("n_words") >= 5, F.expr("transform(sequence(0, cast(n_words as int) - 5), i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]))")).otherwise(F.array().cast("array<long>")))
    frame = frame.withColumn("again", F.size("windows") > F.size(F.array_distinct("windows")))
    # only texts with a window found twice need to know where it is
    frame = frame.withColumn("placed", F.when(F.col("again"), F.expr("sort_array(transform(windows, (h, i) -> struct(h as h, i as i)))")))
    frame = frame.withColumn("starts", F.when(F.col("again"), F.expr("sort_array(transform(filter(placed, (x, k) -> (k > 0 and placed[greatest(k - 1, 0)].h = x.h) or (k < size(placed) - 1 and placed[least(k + 1, size(placed) - 1)].h = x.h)), x -> x.i))")))
    covered = F.expr("aggregate(starts, struct(0L as n, 0 as upto), (a, i) -> struct(a.n + i + 5 - greatest(i, a.upto) as n, i + 5 as upto), a -> a.n)")
    frame = frame.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    classes = {
        "lower": F.col("n_chars") - F.col("n_other"), "upper": F.col("upper"), "digit": F.col("digit"), "space": F.col("space"), "symbol": F.col("symbol"), "beyond": F.col("beyond"),
        "rest": F.col("n_other") - F.col("space") - F.col("symbol") - F.col("digit") - F.col("upper") - F.col("beyond"),
    }
    n_common = F.transform(F.array(*map(F.lit, WORDS)), lambda w: (F.size("common") - F.size(F.array_remove("common", w))).cast("double"))
    return frame.select(
        "doc_id", "lang", "n_words",
        (F.col("n_chars") - F.col("space")).cast("long").alias("word_chars"), F.col("symbol").cast("long").alias("n_symbols"), "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        F.array(*(classes[c].cast("double") for c in CLASSES)).alias("classes"),
        F.concat(n_common, F.array((F.col("n_plain") - F.size("common")).cast("double"))).alias("frequent"),
    )


def references(table: DataFrame) -> Iterator[list[tuple[list[float], list[float]]]]:
    """Summed histograms of every language over all documents that pass the base rules, in blocks of TOGETHER languages."""
    sums = lambda name, k: F.array(*(F.sum(F.col(name)[i]) for i in range(k))).alias(name)
    by = table.filter("lang is not null and not base_failed").groupBy("lang").agg(sums("classes", len(CLASSES)), sums("frequent", len(WORDS) + 1))
    rows = by.toLocalIterator()
    while block := [(r["classes"], r["frequent"]) for r in islice(rows, TOGETHER)]:
        yield block


def distance(histogram: str, reference: list[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a column of shares to a fixed count array; null where a side is empty."""
    total = sum(reference)
    if not total:
        return F.lit(None).cast("double")
    q = "array(" + ",".join(f"{x / total!r}D" for x in reference) + ")"
    term = "(case when {0} > 0 then {0} * log2({0} / (({0} + {1}) / 2)) else 0D end)"
    apart = f"aggregate(zip_with({histogram}, {q}, (p, q) -> {term.format('p', 'q')} + {term.format('q', 'p')}), 0D, (a, x) -> a + x) / 2"
    return F.expr(f"case when {histogram} is not null then sqrt(greatest(0D, {apart})) end")


def shares(histogram: str) -> Column:
    """A count array as shares; null where all counts are 0."""
    n = f"aggregate({histogram}, 0D, (a, x) -> a + x)"
    return F.when(F.expr(n) > 0, F.zip_with(histogram, F.array_repeat(F.expr(n), F.size(histogram)), lambda x, t: x / t))


def quality(docs: DataFrame) -> DataFrame:
    """The base rules and the distances of every text to its closest language reference.

    Per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, class_distance, common_distance, kept. Null text counts as empty (no words:
    base_failed). Texts below the minimum lengths are not judged by a histogram. Without any
    language the distances are null and only the base rules decide. Texts of any length are
    counted whole. Repeated rows stay, and count in the references as often as they stand; a
    null doc_id stays null.
    """
    table = written(features(docs))
    blocks = references(table)
    least = lambda name, k, refs: F.array_min(F.array(*(distance(name, r[k]) for r in refs))) if refs else F.lit(None).cast("double")
    refs = next(blocks, [])
    table = table.withColumns({"classes": shares("classes"), "frequent": shares("frequent")}).withColumns({"class_distance": least("classes", 0, refs), "common_distance": least("frequent", 1, refs)})
    for refs in blocks:  # a pass for each further block keeps the plan small
        table = written(table).withColumns({"class_distance": F.least("class_distance", least("classes", 0, refs)), "common_distance": F.least("common_distance", least("frequent", 1, refs))})
    table = table.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "common_distance")
    far = (F.col("n_words") >= MIN_WORDS_CLASSES) & (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE)
    far = far | (F.col("n_words") >= MIN_WORDS_COMMON) & (F.coalesce("common_distance", F.lit(0.0)) > MAX_COMMON_DISTANCE)
    return table.withColumn("kept", ~F.col("base_failed") & ~far)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents")).drop("class_distance", "common_distance")
