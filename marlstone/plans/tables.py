"""Updates, merges, versions and differences of stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators.changes import change_feed, difference, merge_into, state_before, update_where
from marlstone.plans.registry import query, table
from marlstone.sources.snapshots import SnapshotTable
from marlstone.workspace import scratch, written

_RAISED = "CASE WHEN p_size > 25 THEN round(p_retailprice * 1.1, 4) ELSE p_retailprice END"


def _raise_prices(parts):
    return update_where(parts, F.col("p_size") > 25, {"p_retailprice": F.round(F.col("p_retailprice") * 1.1, 4)})


@query("ver_01_update_where", f"SELECT p_partkey, p_size, {_RAISED} AS p_retailprice FROM part")
def update(spark, folder):
    return _raise_prices(table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice"))


def _shifted(parts):
    """Every key moved up by one half of the largest key: half of the rows match, half are new."""
    half = parts.agg(F.expr("(max(p_partkey) + 1) div 2")).scalar()
    return parts.select(
        (F.col("p_partkey") + half).alias("p_partkey"),
        F.concat(F.col("p_name"), F.lit(" pro")).alias("p_name"),
        F.col("p_brand"),
        F.round(F.col("p_retailprice") + 1, 4).alias("p_retailprice"),
    )


_SHIFTED_SQL = """s AS (
  SELECT p_partkey + (SELECT (max(p_partkey) + 1) // 2 FROM part) AS p_partkey, p_name || ' pro' AS p_name, p_brand,
         round(p_retailprice + 1, 4) AS p_retailprice FROM part)"""


@query(
    "ver_02_merge",
    f"""WITH {_SHIFTED_SQL}
    SELECT t.p_partkey, coalesce(s.p_name, t.p_name) AS p_name, t.p_brand,
           coalesce(s.p_retailprice, t.p_retailprice) AS p_retailprice
    FROM part t LEFT JOIN s USING (p_partkey)
    UNION ALL SELECT p_partkey, p_name, p_brand, p_retailprice FROM s WHERE p_partkey NOT IN (SELECT p_partkey FROM part)""",
)
def merge(spark, folder):
    parts = table(spark, folder, "part")
    target = parts.select("p_partkey", "p_name", "p_brand", "p_retailprice")
    return merge_into(target, _shifted(parts), ["p_partkey"], ["p_name", "p_retailprice"])


_USER_FEATURES_SQL = """user_id, count(*) AS n_events, round(sum(value), 2) AS total_value FROM events"""


def _user_features(events):
    return events.groupBy("user_id").agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 2).alias("total_value"))


@query(
    "ver_03_feature_table_merge",
    f"""WITH late AS (SELECT {_USER_FEATURES_SQL} WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY user_id),
    early AS (SELECT {_USER_FEATURES_SQL} WHERE ts < TIMESTAMP '2024-01-16' GROUP BY user_id)
    SELECT * FROM late UNION ALL SELECT * FROM early WHERE user_id NOT IN (SELECT user_id FROM late)""",
)
def feature_table_merge(spark, folder):
    events = table(spark, folder, "events")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    features = SnapshotTable(spark, scratch(spark, "features"))
    features.overwrite(_user_features(events.where(F.col("ts") < middle)), "create")
    features.merge(_user_features(events.where(F.col("ts") >= middle)), ["user_id"], ["n_events", "total_value"])
    return features.read()


def _four_versions(spark, folder) -> SnapshotTable:
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    stored = SnapshotTable(spark, scratch(spark, "versions"))
    stored.overwrite(parts.where("p_size <= 40"), "create")
    stored.append(parts.where("p_size > 40"))
    stored.update(F.col("p_size") > 25, {"p_retailprice": F.round(F.col("p_retailprice") * 1.1, 4)})
    stored.merge(_shifted(parts), ["p_partkey"], ["p_name", "p_retailprice"])
    return stored


_STATES_SQL = f"""{_SHIFTED_SQL}, old AS (SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part WHERE p_size <= 45),
    new AS (SELECT p_partkey, p_name, p_brand, p_size, CASE WHEN p_size > 25 THEN round(p_retailprice * 1.1, 4) ELSE p_retailprice END AS p_retailprice FROM part WHERE p_size > 5)"""


def _states(spark, folder):
    """Two states of a table: parts up to size 45, and parts from size 6 with a price rise for large ones."""
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    return parts.where("p_size <= 45"), update_where(parts.where("p_size > 5"), F.col("p_size") > 25, {"p_retailprice": F.round(F.col("p_retailprice") * 1.1, 4)})


@query(
    "ver_04_change_feed",
    f"""WITH {_STATES_SQL}, both_states AS (SELECT old.*, new.p_retailprice AS price FROM old JOIN new USING (p_partkey) WHERE old.p_retailprice <> new.p_retailprice)
    SELECT 'insert' AS change, new.* FROM new WHERE p_partkey NOT IN (SELECT p_partkey FROM old)
    UNION ALL SELECT 'delete', old.* FROM old WHERE p_partkey NOT IN (SELECT p_partkey FROM new)
    UNION ALL SELECT 'update_before', p_partkey, p_name, p_brand, p_size, p_retailprice FROM both_states
    UNION ALL SELECT 'update_after', p_partkey, p_name, p_brand, p_size, price FROM both_states""",
)
def feed(spark, folder):
    """The row changes between two states of a table."""
    return change_feed(*_states(spark, folder), ["p_partkey"])


@query("ver_05_state_before", f"WITH {_STATES_SQL} SELECT * FROM old")
def earlier_state(spark, folder):
    """An old state, put together from the new one and the stored changes."""
    old, new = _states(spark, folder)
    stored = written(change_feed(old, new, ["p_partkey"]), "changes")
    return state_before(new, stored, ["p_partkey"])


@query(
    "ver_04_history",
    f"""WITH {_SHIFTED_SQL}
    SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, count(*) AS n_rows FROM part WHERE p_size <= 40
    UNION ALL SELECT 1, 'append', count(*) FROM part
    UNION ALL SELECT 2, 'update', count(*) FROM part
    UNION ALL SELECT 3, 'merge', (SELECT count(*) FROM part) + count(*) FROM s WHERE p_partkey NOT IN (SELECT p_partkey FROM part)""",
)
def history(spark, folder):
    return _four_versions(spark, folder).history().select("version", "operation", "n_rows")


@query("ver_05_read_version", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part WHERE p_size <= 40")
def read_version(spark, folder):
    return _four_versions(spark, folder).read(0)


@query(
    "ver_06_version_diff",
    f"""SELECT * FROM (SELECT p_partkey, p_retailprice AS old_value, {_RAISED} AS new_value,
    round({_RAISED} - p_retailprice, 2) AS change FROM part) WHERE old_value <> new_value""",
)
def version_diff(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    stored = SnapshotTable(spark, scratch(spark, "diff"))
    stored.overwrite(parts, "create")
    stored.overwrite(_raise_prices(stored.read(0)), "update")
    return difference(stored.read(0), stored.read(1), "p_partkey", "p_retailprice")
