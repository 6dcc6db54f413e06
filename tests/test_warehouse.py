import os
import uuid

import pytest
from pyspark.sql import functions as F

from riverbend.operators import vault
from riverbend.operators import warehouse as dwh
from riverbend.session import settings
from test_plans import logged_plans

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def house(spark, tmp_dir):
    own = dwh.Warehouse(spark, f"dwh_{uuid.uuid4().hex}", buckets=4, location=os.path.join(tmp_dir, "schema"))
    own.create()
    yield own
    own.drop()


def stage(spark, rows):
    return spark.createDataFrame(rows, "District string, Crimes_total long, Crimes_monthly long, Frequent_crime_types string").withColumns(
        {c: F.lit("1.5").cast("decimal(37,15)") for c in ("Lat", "Lng")})


FIRST = [("A", 10, 1, "x"), ("B", 20, 2, "y"), ("C", 30, 3, None)]


def children(plan):
    """(operator, lines below it) of a formatted plan's tree."""
    tree = plan.split("\n\n")[0].splitlines()[1:]
    depth = [len(line) - len(line.lstrip(" :+-")) for line in tree]
    names = [line.lstrip(" :+-") for line in tree]

    def below(i):
        j = i + 1
        while j < len(tree) and depth[j] > depth[i]:
            j += 1
        return range(i + 1, j)
    for i, name in enumerate(names):
        first = [j for j in below(i) if depth[j] == depth[i] + 3]
        yield name, [[names[k] for k in (j, *below(j))] for j in first]


def test_tables_are_segmented_and_sorted(spark, house):
    assert dwh.layout(spark, house.name("hub")) == (["HK_DISTRICT"], 4)
    assert dwh.layout(spark, house.name("ods")) == (["District"], 4)
    assert dwh.layout(spark, house.name("file_log")) == ([], 0)
    house.create()  # again: nothing to do
    dwh.drop_table(spark, house.name("hub"))
    dwh.drop_table(spark, house.name("hub"))
    assert not spark.catalog.tableExists(house.name("hub"))
    house.create()
    assert house.table("hub").count() == 0


def test_load_rerun_and_changed_metric(spark, house):
    house.fill_stage(stage(spark, FIRST))
    assert house.load(load_ts="2024-01-01 00:00:00") == {"file_log": 1, "ods": 3, "hub": 3, "satellite": 3}
    assert house.load(load_ts="2024-01-02 00:00:00") == {"file_log": 0, "ods": 0, "hub": 0, "satellite": 0}
    house.fill_stage(stage(spark, [("A", 11, 1, "x"), ("D", 1, 1, "z")]))
    assert house.load(file_name="later", load_ts="2024-02-01 00:00:00") == {"file_log": 1, "ods": 2, "hub": 1, "satellite": 2}
    current = {r.DISTRICT: r.CRIMES_TOTAL for r in house.current().collect()}
    assert current == {"A": 11, "B": 20, "C": 30, "D": 1}


def test_the_same_as_the_chain_over_folders(spark, house, tmp_dir):
    house.fill_stage(stage(spark, FIRST))
    house.load(load_ts="2024-01-01 00:00:00")
    root = os.path.join(tmp_dir, "folders")
    vault.run_load_chain(stage(spark, FIRST), root, load_ts="2024-01-01 00:00:00")
    for name in vault.TABLES:
        assert sorted(map(tuple, house.table(name).collect()), key=str) == sorted(map(tuple, spark.read.parquet(f"{root}/{name}").collect()), key=str)


def test_anti_joins_leave_the_stored_side_where_it_lies(spark, house):
    house.fill_stage(stage(spark, FIRST))
    house.load(load_ts="2024-01-01 00:00:00")
    house.fill_stage(stage(spark, [("A", 11, 1, "x"), ("D", 1, 1, "z")]))
    with settings(spark, NO_BROADCAST):
        plans = logged_plans(spark, lambda: house.load(file_name="later", load_ts="2024-02-01 00:00:00"))
        with settings(spark, dwh.COLOCATED):
            plans += logged_plans(spark, lambda: house.current().collect())
    joins = [(name, parts) for plan in plans for name, parts in children(plan) if name.startswith("SortMergeJoin")]
    anti = [parts for name, parts in joins if "LeftAnti" in name]
    assert len({str(parts[1]) for parts in anti}) >= 3  # ODS, hub, satellite
    for _, stored in anti:
        assert any(line.startswith("Scan parquet") for line in stored) and not any("Exchange" in line or "ShuffleQueryStage" in line for line in stored)
    inner = [parts for name, parts in joins if "Inner" in name]
    assert inner and not any("Exchange" in line for parts in inner for side in parts for line in side)


def test_a_load_writes_one_file_a_bucket(spark, house):
    many = [(f"D{i}", i, i, "x") for i in range(200)]
    house.fill_stage(stage(spark, many).repartition(7))
    house.load(load_ts="2024-01-01 00:00:00")
    files = spark.table(house.name("satellite")).inputFiles()
    assert len(files) == 4
    for path in files:  # sorted within the bucket
        keys = [tuple(r) for r in spark.read.parquet(path).select("HK_DISTRICT", "HASHDIFF").collect()]
        assert keys == sorted(keys)


def test_violated_keys_and_nulls_are_refused(spark, house):
    for rows in ([("A", 1, 1, "x"), ("A", 2, 1, "x")], [(None, 1, 1, "x")], [("A", None, 1, "x")]):
        with pytest.raises(ValueError):
            house.fill_stage(stage(spark, rows))
    house.fill_stage(stage(spark, [("A", 1, 1, "x"), ("A", 2, 1, "x")]), check=False)
    with pytest.raises(ValueError, match="ods: primary key"):
        house.load(load_ts="2024-01-01 00:00:00")
    assert house.table("ods").count() == 0


def test_empty_stage_loads_nothing(spark, house):
    house.fill_stage(stage(spark, FIRST).limit(0))
    assert house.load() == {"file_log": 0, "ods": 0, "hub": 0, "satellite": 0}
    assert house.current().count() == 0


def test_external_table_keeps_its_files(spark, house, tmp_dir):
    path = os.path.join(tmp_dir, "crimes")
    stage(spark, FIRST).write.parquet(path)
    dwh.create_external_table(spark, house.name("crimes"), dwh.STAGE_DDL, path)
    assert house.table("crimes").count() == 3
    dwh.drop_table(spark, house.name("crimes"))
    assert spark.read.parquet(path).count() == 3


def test_names_are_checked(spark):
    for name in ("a b", "x;drop", "", "a..b", "`a`"):
        with pytest.raises(ValueError):
            dwh.drop_table(spark, name)
