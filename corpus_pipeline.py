"""The corpus pipeline: five stages from documents to token ids, each one of the llm operators.

Every stage takes (spark, docs, sf_dir) and returns a frame; the frame is written as Parquet
and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegrid.llm.op2_mixing import mixed
from lakegrid.llm.op3_token_store import read_digests, write_store
from lakegrid.llm.op4_jaccard import similarity_classes
from lakegrid.llm.op6_quality import quality
from lakegrid.llm.op10_decontaminate import leaks
from lakegrid.llm.shared import read, shared_folder, written

#: The iterative stages can't be written as one SQL statement; they are tested against brute force.
ORACLE_SQL = None
#: Shares of tokens that the mixing stage aims at; good documents keep theirs, others give way.
TARGETS = {"good": 0.90, "poor": 0.05, "toxic": 0.05}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts are too short and go, as do documents without an id; rows that repeat stay, whole texts of any length are judged, other columns are passed on. An empty table gives an empty one."""
    kept = quality(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one of smallest doc_id; of rows that repeat it, one. Texts without a word are classes of their own and stay; rows without an id go. Other columns are passed on."""
    first = similarity_classes(docs, links=False).filter("doc_id = component_id").select("doc_id").distinct()
    return docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item. Null and empty texts leak nothing; rows that repeat go or stay together; rows without an id can't be named and stay (the first stage drops them). Texts are read whole; other columns are passed on."""
    leaking = leaks(docs, read(spark, sf_dir, "benchmark")).filter("doc_id is not null").select("doc_id").distinct()
    return docs.join(leaking, "doc_id", "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at their rates (at most 1), by a hash of doc_id: a document stays if its point in [0, 1) is below its rate. Rows that repeat share a point; rows without an id, or that the mixing gives no rate, go; texts are read whole. Other columns are passed on."""
    rated = mixed(docs, read(spark, sf_dir, "labels"), TARGETS, 1.0, "good")
    point = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    return docs.join(rated.filter(point < F.col("rate")).select("doc_id"), "doc_id", "left_semi")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from its token store. Null and empty texts hold the end id alone; rows that repeat have each their place; documents without an id come first."""
    folder = shared_folder(spark)
    write_store(docs, folder)
    return read_digests(spark, folder)


STAGES = [("quality rules", quality_rules), ("near duplicates", near_duplicates), ("decontamination", decontaminate), ("mixing", mix), ("token ids", token_ids)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
