import pytest
from pyspark.sql import functions as F

from marlstone.operators.changes import change_feed, difference, merge_into, state_before, update_where
from marlstone.sources.snapshots import SchemaMismatch, SnapshotTable
from marlstone.workspace import scratch

LAYOUT = "id bigint, name string, category string, price double, stock bigint"


@pytest.fixture
def products(spark):
    rows = [
        (1, "Laptop", "Electronics", 999.99, 50),
        (2, "Mouse", "Electronics", 80.0, 200),
        (3, "Desk", "Furniture", 299.0, 30),
        (4, "Monitor", "Electronics", 450.0, 75),
        (5, "Chair", "Furniture", 199.0, 60),
    ]
    return spark.createDataFrame(rows, LAYOUT)


@pytest.fixture
def stored(spark, products):
    table = SnapshotTable(spark, scratch(spark, "products"))
    table.overwrite(products, "create")
    table.append(spark.createDataFrame([(6, "Lamp", "Furniture", 20.0, 5), (7, "Pen", "Office", 2.0, 900)], LAYOUT))
    table.update(F.col("category") == "Electronics", {"price": F.round(F.col("price") * 1.10, 2)})
    updates = spark.createDataFrame(
        [(1, "Laptop Pro", "Computers", 1099.99, 45), (8, "Tablet", "Electronics", 500.0, 10), (9, "Cable", "Office", 5.0, 99)], LAYOUT
    )
    table.merge(updates, ["id"], ["name", "price", "stock"])
    return table


def test_versions(stored):
    history = stored.history().orderBy("version").collect()
    assert [(r["version"], r["operation"], r["n_rows"]) for r in history] == [
        (0, "create", 5),
        (1, "append", 7),
        (2, "update", 7),
        (3, "merge", 9),
    ]
    assert [stored.read(v).count() for v in range(4)] == [5, 7, 7, 9]
    assert tuple(stored.read().where("id = 1").first()) == (1, "Laptop Pro", "Electronics", 1099.99, 45)
    changed = {r["id"]: r["change"] for r in difference(stored.read(0), stored.read(3), "id", "price").collect()}
    assert changed == {1: 100.0, 2: 8.0, 4: 45.0}


def test_open_finds_the_last_version(spark, stored):
    assert SnapshotTable.open(spark, stored.path).version == 3
    assert SnapshotTable.open(spark, stored.path).read().count() == 9


def test_schema_is_enforced(spark, stored):
    with pytest.raises(SchemaMismatch) as refused:
        stored.append(spark.createDataFrame([(10, "Hub", 30.0)], "id bigint, name string, price double"))
    assert refused.value.missing == ["category", "stock"] and stored.version == 3
    with pytest.raises(SchemaMismatch) as refused:
        stored.append(spark.createDataFrame([(10, "Hub", "Office", 30, 1)], LAYOUT.replace("double", "int")), evolve=True)
    assert refused.value.changed == ["price"]


def test_schema_evolution(spark, stored):
    row = (10, "Hub", "Office", 30.0, 1, "2024-02-01")
    assert stored.append(spark.createDataFrame([row], LAYOUT + ", added_date string"), evolve=True) == 4
    assert stored.read().count() == 10 and stored.read().where("added_date IS NULL").count() == 9
    assert "added_date" not in stored.read(3).columns


def test_append_rewrites_nothing(stored):
    assert stored._entry(1).parts[0] == stored._entry(0).parts[0]


def test_merge_twice_is_merge_once(products):
    updates = products.where("id > 3").withColumns({"id": F.col("id") + 1, "stock": F.lit(1).cast("bigint")})
    once = merge_into(products, updates, ["id"], ["stock"])
    twice = merge_into(once, updates, ["id"], ["stock"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_merge_refuses_repeated_keys(products):
    with pytest.raises(ValueError):
        merge_into(products, products.unionByName(products), ["id"], ["stock"])


def test_merge_insert_columns(products):
    new = products.where("id = 5").withColumn("id", F.lit(50).cast("bigint"))
    added = merge_into(products, new, ["id"], [], ["id", "name"]).where("id = 50").first()
    assert (added["name"], added["category"], added["price"]) == ("Chair", None, None)


def test_update_skips_null_conditions(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id bigint, x bigint")
    got = update_where(df, F.col("x") > 1, {"x": F.lit(0)}).orderBy("id").collect()
    assert [r["x"] for r in got] == [None, 0]


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_merge_is_the_same_with_and_without_a_broadcast(spark, broadcast):
    target = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0), (None, "d", 4.0)], "k int, name string, v double")
    source = spark.createDataFrame([(1, 9, "new"), (3, 8, "added"), (None, 7, "null key")], "k int, v int, extra string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = merge_into(target, source, ["k"], ["v"])
        assert got.schema == target.schema
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert ("FullOuter" in plan) == (broadcast == "-1")
        rows = sorted(((r.k, r.name, r.v) for r in got.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == sorted([(1, "a", 9.0), (1, "b", 9.0), (2, "c", 3.0), (None, "d", 4.0), (3, None, 8.0), (None, None, 7.0)], key=str)


def test_changes_lead_back(spark):
    schema = "k int, name string, v double"
    old = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", None), (4, "d", 4.0)], schema)
    new = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0), (5, "e", None)], schema)
    feed = change_feed(old, new, ["k"]).cache()
    assert sorted((r.change, r.k) for r in feed.collect()) == [("delete", 4), ("insert", 5), ("update_after", 2), ("update_after", 3), ("update_before", 2), ("update_before", 3)]
    assert sorted(map(tuple, state_before(new, feed, ["k"]).collect()), key=str) == sorted(map(tuple, old.collect()), key=str)
    assert change_feed(old, old, ["k"]).count() == 0
