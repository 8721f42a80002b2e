"""Queries of the training-data operators over the given tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import clusters


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.tokens import round_trip

    return round_trip(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"), ["doc_id"])


def op2_chats(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.chats import format_chats, read_back

    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    told = "</s>[INST] ok [/INST]"
    trial = spark.createDataFrame([(-7, 0, "user", told), (-7, 1, "assistant", told)], chats.schema)
    return read_back(format_chats(chats.unionByName(trial)))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.quality import quality

    return quality(table(spark, folder, "documents"))


def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.packing import pack

    return pack(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), ["doc_id"], end=0)


def op5_licences(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.licences import scan

    return scan(table(spark, folder, "documents"), ["doc_id"])


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.duplicates import near_duplicates

    return near_duplicates(table(spark, folder, "documents"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.language import identify

    return identify(table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.sharding import placed_documents

    return placed_documents(table(spark, folder, "documents"))


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.fingerprints import compare_edited

    return compare_edited(table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.toxicity import toxicity

    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.personal import personal_data

    return personal_data(table(spark, folder, "documents"))


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.clusters import cluster

    return cluster(table(spark, folder, "embeddings"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.llm.periods import run_digests

    return run_digests(table(spark, folder, "documents"))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_chats": op2_chats,
    "op3_quality": op3_quality,
    "op4_packing": op4_packing,
    "op5_licences": op5_licences,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language": op7_language,
    "op8_sharding": op8_sharding,
    "op9_fingerprints": op9_fingerprints,
    "op10_toxicity": op10_toxicity,
    "op11_personal_data": op11_personal_data,
    "op12_clusters": op12_clusters,
    "op13_periodic_runs": op13_periodic_runs,
}

#: SQL with the same result, where SQL can express the operator.
SQL: dict[str, str] = {"op12_clusters": clusters.oracle_sql()}
