"""A corpus pipeline of five stages; each stage's result is written as Parquet and read again by the next.

All stages but the last return the columns of documents. A toxic document goes; repeated passages are deleted, and a
document that loses all of its words by that goes; of each group of near copies one document stays; a document with a
benchmark passage goes; what is left is packed into windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skewloom.llm.decontamination import decontaminate
from skewloom.llm.jaccard import jaccard_classes
from skewloom.llm.line_dedup import line_dedup
from skewloom.llm.packing import pack
from skewloom.llm.shared import bitmap_words, marked, out_of_fold, row_key
from skewloom.llm.toxicity import fit, sample, score
from skewloom.session import scratch_path, store

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
HELD_OUT = (5, 0)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a noisy-or toxicity below one half. The labels of held-out rows are not learned from.

    Null and empty texts stay; rows that repeat stay or go together.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(out_of_fold(F.col("doc_id"), *HELD_OUT))
    weights, bias = fit(sample(docs, labels, 6000))
    return score(docs.select(*COLUMNS), weights, bias, keep_text=True).filter("predicted = 0").select(*COLUMNS)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words and more that an earlier document has; n_chars follows the text.

    A text that was empty before stays; one that only becomes empty here was a copy and goes.
    """
    cleaned = line_dedup(docs.select(*COLUMNS))
    emptied = (F.size("removed") > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    length = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    rows = cleaned.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return rows.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of five-word n-gram similarity 0.8 connect: the one with the least doc_id
    (a null id comes first).

    Empty texts link with nothing and stay. Of rows that repeat, one stays. Whole rows are only shuffled where the ids
    leave a doubt: those that do not stay, and those that repeat.
    """
    keyed = docs.select(*COLUMNS, F.struct("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row")).alias("key"))
    rows = jaccard_classes(keyed.select(F.col("key").alias("doc_id"), "text"), size=5, percent=80)
    chosen = rows.filter("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("chosen")).select("chosen.row")
    chosen = store(chosen.union(rows.filter("component IS NULL").select("doc_id.row")).distinct(), "chosen")
    counts = rows.groupBy(F.col("doc_id.row").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    alone = counts.filter("n = 1").join(chosen, "row", "left_semi")
    doubtful = store(counts.join(alone.select("row"), "row", "left_anti").select("row"), "doubtful")
    whole = marked(keyed.select(*COLUMNS, "key.row"), F.col("row"), bitmap_words(doubtful, "row"), "doubt")
    kept = whole.filter("doubt").join(chosen, "row", "left_semi").dropDuplicates(["row"])
    return whole.filter("NOT doubt").unionByName(kept).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item. Null and empty texts stay; rows that repeat stay or go together."""
    keyed = docs.select(*COLUMNS, row_key(F.col("doc_id"), F.col("text")).alias("row"))
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaky = decontaminate(keyed.select(F.col("row").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("row"))
    leaky = store(leaky.distinct(), "leaky")
    whole = marked(keyed, F.col("row"), bitmap_words(leaky, "row"), "doubt")
    kept = whole.filter("doubt").join(leaky, "row", "left_anti")
    return whole.filter("NOT doubt").unionByName(kept).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: pieces of windows of 1024 tokens instead of documents. A null text is empty; rows that repeat are packed each."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_deduplication),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
