import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from featuremart.sources import storage, tables


@pytest.fixture
def db(spark):
    tables.ensure_db(spark, "mart_test")
    yield "mart_test"
    spark.sql("DROP DATABASE mart_test CASCADE")


def frame(spark):
    return spark.range(10).select("id", (F.col("id") % 3).cast("string").alias("m"))


def test_partition_replace_is_repeatable(spark, db, rows):
    name = f"{db}.labels"
    tables.replace_partition(frame(spark), name, "m")
    changed = spark.createDataFrame([("1", 100)], "m string, id bigint")  # other column order
    tables.replace_partition(changed, name, "m")
    once = rows(tables.refresh(spark, name), "id", "m")
    tables.replace_partition(changed, name, "m")
    assert rows(tables.refresh(spark, name), "id", "m") == once
    assert once == {(i, str(i % 3)) for i in range(10) if i % 3 != 1} | {(100, "1")}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark, db):
    setting = storage._RELEASE
    own = spark.conf.get(setting, None)
    counted = spark.range(1000).groupBy((F.col("id") % 100).alias("id")).count().withColumn("m", F.lit("a"))
    before = shuffle_files(spark)
    tables.replace_partition(counted, f"{db}.released", "m", unique=["id"])
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(setting, None) == own
    with pytest.raises(ValueError, match="repeat"):
        tables.replace_partition(counted.union(counted), f"{db}.released", "m", unique=["id"])
    assert spark.conf.get(setting, None) == own
    # a frame that is run once more gives the same rows
    assert counted.agg(F.sum("count")).first()[0] == 1000 == tables.load(spark, f"{db}.released").agg(F.sum("count")).first()[0]


def test_rows_of_one_partition_are_written_where_they_are(spark, db, tmp_path, rows):
    one = frame(spark).withColumn("m", F.lit("a")).repartition(3)
    with storage.shuffles_released(spark), storage.shuffles_released(spark):
        pass
    assert spark.conf.get(storage._RELEASE, None) != "true"
    tables.replace_partition(one, f"{db}.sized", "m", sized=True)
    tables.replace_partition(frame(spark), f"{db}.sized", "m", sized=True)
    assert rows(tables.refresh(spark, f"{db}.sized"), "id", "m") == {(i, "a") for i in range(10)} | {(i, str(i % 3)) for i in range(10)}


def test_partition_filter_is_pruned(spark, db):
    tables.write_table(frame(spark), f"{db}.parts", partition_by=["m"])
    plan = tables.load(spark, f"{db}.parts").where("m = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(m" in plan


def test_write_and_locate(spark, db, rows):
    tables.write_table(frame(spark), f"{db}.plain", files=2)
    assert rows(tables.load(spark, f"{db}.plain", {"id": "key"}), "key") == {(i,) for i in range(10)}
    location = tables.table_location(spark, f"{db}.plain")
    assert tables.load_path(spark, location, "orc").count() == 10


def test_export_is_zstd(spark, tmp_path):
    path = tmp_path / "out"
    tables.export_parquet(frame(spark), str(path), files=1)
    assert [p.name.endswith(".zstd.parquet") for p in path.glob("*.parquet")] == [True]


def test_fetch_is_bounded(spark):
    assert len(tables.fetch_small(spark.range(5), 5)) == 5
    with pytest.raises(ValueError, match="more than 5"):
        tables.fetch_small(spark.range(6), 5)


def test_scratch_is_below_the_checkpoint_folder(spark):
    root = storage.checkpoint_dir(spark)
    assert storage.scratch_path(spark, "x").startswith(root)
    assert storage.scratch_path(spark, "x") != storage.scratch_path(spark, "x")


def test_small_sources(spark):
    assert tables.small_table(spark, [("a", 1)], ["name", "n"]).count() == 1
    assert [r.k for r in tables.row_numbers(spark, 3, "k").collect()] == [0, 1, 2]


def test_a_failed_write_leaves_the_old_partition(spark, db, rows):
    name = f"{db}.kept"
    tables.replace_partition(frame(spark), name, "m")
    before = rows(tables.load(spark, name), "id", "m")
    broken = frame(spark).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(-F.col("id")))
    with pytest.raises(Exception, match="lost"):
        tables.replace_partition(broken, name, "m")
    assert rows(tables.refresh(spark, name), "id", "m") == before


def test_a_new_partition_does_not_touch_the_others(spark, db, rows):
    name = f"{db}.months"
    assert tables.replace_partition(frame(spark).where("m = '0'"), name, "m") == []
    files = set(tables.load(spark, name).inputFiles())
    odd = spark.createDataFrame([(1, "a b=c/d'%20\\"), (2, None), (3, "")], "id bigint, m string")
    assert tables.replace_partition(odd, name, "m") == []
    assert files < set(tables.load(spark, name).inputFiles())
    assert tables.replace_partition(odd.withColumn("id", -F.col("id")), name, "m") != []
    assert rows(tables.load(spark, name).where("m <> '0' or m is null"), "id", "m") == {(-1, "a b=c/d'%20\\"), (-2, None), (-3, None)}
    assert tables.load(spark, name).where("m = '0'").count() == 4
    assert "0" in tables.partition_values(spark, name, "m")


def test_two_writers_of_one_table(spark, db):
    """Each replaces its own partition, at the same time, without a session setting."""
    name = f"{db}.shared"
    tables.replace_partition(frame(spark), name, "m")
    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(tables.replace_partition, spark.range(100).select("id", F.lit(m).alias("m")), name, "m") for m in "01"]
        assert all(len(j.result()) == 1 for j in jobs)
    assert {r.m: r["count"] for r in tables.refresh(spark, name).groupBy("m").count().collect()} == {"0": 100, "1": 100, "2": 3}


def test_a_repeated_key_is_refused(spark, db, rows):
    name = f"{db}.grain"
    good = spark.createDataFrame([("1", 1, 5), ("1", 2, 5), ("2", 1, 5), ("1", None, 5), ("1", None, 6)], "m string, k int, v int")
    tables.replace_partition(good, name, "m", unique=["k"])
    before = rows(tables.load(spark, name), "m", "k", "v")
    with pytest.raises(ValueError, match="2 rows"):
        tables.replace_partition(good.where("k is not null").union(spark.createDataFrame([("1", 2, 7), ("1", 2, 8)], good.schema)), name, "m", unique=["k"])
    assert rows(tables.refresh(spark, name), "m", "k", "v") == before and len(before) == 5
