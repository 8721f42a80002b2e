"""Experiment runs, model versions and model cards over long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.operators.ordered import running_totals


def latest_metrics(runs: DataFrame) -> DataFrame:
    """Last logged value per (run, key)."""
    return runs.groupBy("run_id", "key").agg(F.max_by("value", "step").alias("value"))


def of_experiment(records: DataFrame, experiment: str) -> DataFrame:
    """Metric rows of the runs that carry the experiment's tag."""
    tagged = records.where((F.col("kind") == "tag") & (F.col("key") == "experiment") & (F.col("text") == experiment))
    return records.where("kind = 'metric'").join(tagged.select("run_id").distinct(), "run_id", "left_semi")


def search_runs(runs: DataFrame, keys: Sequence[str], condition: str, order_by: str) -> DataFrame:
    """One row per run with a column per metric, filtered, best first."""
    wide = latest_metrics(runs.where(F.col("key").isin(*keys))).groupBy("run_id").pivot("key", list(keys)).agg(F.first("value"))
    return wide.where(condition).orderBy(F.desc_nulls_last(order_by), "run_id")


def best_run(runs: DataFrame, key: str) -> DataFrame:
    """Run with the largest latest value of the metric, ties to the lowest id."""
    chosen = latest_metrics(runs.where(F.col("key") == key))
    first = F.min(F.struct((-F.col("value")).alias("_v"), "run_id"))
    return chosen.agg(first.alias("_b")).select("_b.run_id", (-F.col("_b._v")).alias("value"))


def model_versions(registered: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Version number 1.. of each registration within its name, in time order."""
    return running_totals(registered, [name], order, {"version": F.lit(1)})


def resolve_aliases(versions: DataFrame, name: str, value: str) -> DataFrame:
    """(name, alias, version): 'latest' is the newest version, 'champion' the one with the best value."""
    best = F.min(F.struct((-F.col(value)).alias("_v"), "version"))
    per_name = versions.groupBy(name).agg(F.max("version").alias("latest"), best.alias("_b"))
    return per_name.select(
        name,
        F.inline(
            F.array(
                F.struct(F.lit("latest").alias("alias"), F.col("latest").alias("version")),
                F.struct(F.lit("champion").alias("alias"), F.col("_b.version").alias("version")),
            )
        ),
    )


def model_cards(records: DataFrame) -> DataFrame:
    """(name, version, run_id, metrics, params): latest metrics and logged parameters as JSON text, keys sorted.

    A run's model is the one its tag names; a model's runs are its versions in the order of their first steps.
    """

    def as_json(value):
        return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", value)))))

    metrics = latest_metrics(records.where("kind = 'metric'")).groupBy("run_id").agg(as_json("value").alias("metrics"))
    params = records.where("kind = 'param'").groupBy("run_id").agg(as_json("text").alias("params"))
    named = records.where("kind = 'tag' AND key = 'model'").select(F.col("text").alias("name"), "run_id", "step")
    versions = model_versions(named, "name", ["step", "run_id"]).drop("step")
    return versions.join(metrics, "run_id").join(params, "run_id").select("name", "version", "run_id", "metrics", "params")
