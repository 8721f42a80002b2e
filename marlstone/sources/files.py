"""File round trips. Readers take an explicit schema: inference would read the data twice."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marlstone.workspace import scratch


def round_trip(df: DataFrame, form: str, **options: str) -> DataFrame:
    """Write as csv, json, orc or parquet below the shared folder and read back with the same schema."""
    spark = df.sparkSession
    path = scratch(spark, form)
    df.write.format(form).options(**options).save(path)
    return spark.read.format(form).schema(df.schema).options(**options).load(path)
