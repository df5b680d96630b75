"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .chat import format_conversations, read_back
from .decontamination import decontaminate
from .hidden_markov import hidden_markov_scores
from .jaccard import jaccard_components
from .kneser_ney import kneser_ney_quality
from .language import language_id
from .line_dedup import line_dedup
from .merkle import merkle_manifest
from .oracles import CHAT, JACCARD, MERKLE, RULES, SEARCH
from .packing import pack
from .personal_data import digest_columns, sanitise
from .rules import quality_rules
from .search import ranked_search
from .shared import table
from .toxicity import toxicity


def packed_windows(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def languages(spark: SparkSession, folder: str) -> DataFrame:
    return language_id(table(spark, folder, "documents"))


def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def ruled_documents(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"))


def contaminated_documents(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def deduplicated_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup(table(spark, folder, "documents")).select("doc_id", "text", "removed")


def similar_documents(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def language_model(spark: SparkSession, folder: str) -> DataFrame:
    return hidden_markov_scores(table(spark, folder, "documents"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return digest_columns(sanitise(table(spark, folder, "documents")))


def language_quality(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def document_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest(table(spark, folder, "documents"))


def ranked_documents(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def chat_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more, whose texts hold control strings."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], given.schema)
    return read_back(format_conversations(given.unionByName(more)))


QUERIES = {
    "op1_multiple_instance_toxicity": toxic_documents,
    "op2_winnowed_line_dedup": deduplicated_lines,
    "op3_qgram_decontamination": contaminated_documents,
    "op4_compression_language": languages,
    "op10_hidden_markov_model": language_model,
    "op8_information_theoretic_sanitisation": personal_data,
    "op5_kneser_ney_quality": language_quality,
    "op9_jaccard_components": similar_documents,
    "op7_line_frequency_rules": ruled_documents,
    "op6_sum_of_squares_packing": packed_windows,
    "op11_bit_sliced_search": ranked_documents,
    "op12_reply_tree_chat": chat_conversations,
    "op13_merkle_manifest": document_manifest,
}

ORACLES: dict[str, str] = {
    "op7_line_frequency_rules": RULES,
    "op9_jaccard_components": JACCARD,
    "op11_bit_sliced_search": SEARCH,
    "op12_reply_tree_chat": CHAT,
    "op13_merkle_manifest": MERKLE,
}
