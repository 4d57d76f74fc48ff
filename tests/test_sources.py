import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.plans import plan, settings
from tripflow.operators.align import union_all
from tripflow.session import scratch_path
from tripflow.sources.readers import _files_by_header, read_pairs_csv, read_table, read_trips_csv, read_warehouse, read_zones
from tripflow.sources.schemas import DAILY, MONTH_MAP
from tripflow.sources.writers import preview, publish_table, write_pairs_csv, write_table, write_warehouse


def put(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w") as f:
            f.write(text)
    return str(folder)


def data_files(path):
    return [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_files_of_differing_headers_align_by_name(spark, tmp_path, rows):
    folder = put(tmp_path / "d", one="a,b\n1,2\n", two="b,a\n3,4\n", three="a, b,c\n5,6,7\n", none="", bare="a,b\n")
    df = read_trips_csv(spark, folder)
    assert set(df.columns) == {"a", "b", " b", "c"}
    assert rows(df.select("a", "b")) == sorted([("1", "2"), ("4", "3"), ("5", None)], key=str)
    files = rows(read_trips_csv(spark, folder, with_file=True).select("source_file"))
    assert [f[0].rsplit("/", 1)[1] for f in files] == ["one.csv", "three.csv", "two.csv"]


def test_given_schema_is_enforced(spark, tmp_path):
    folder = put(tmp_path / "d", one="a,b\n1,2\n", two="b,a\n3,4\n")
    schema = StructType().add("a", "string").add("b", "string")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_trips_csv(spark, folder, schema=schema).collect()
    assert read_trips_csv(spark, f"{folder}/o*.csv", schema=schema).count() == 1


def test_globs_lists_and_odd_names(spark, tmp_path, rows):
    folder = put(tmp_path / "trip data", **{"fhv_2015-01 [x]": "a\n1\n", "fhv_2015-02%20": "a\n2\n", "fhv_2016-01": "a\n3\n"})
    assert rows(read_trips_csv(spark, f"{folder}/fhv_2015*")) == [("1",), ("2",)]
    assert rows(read_trips_csv(spark, [f"{folder}/fhv_2015*", f"{folder}/fhv_2016*"])) == [("1",), ("2",), ("3",)]
    with pytest.raises(ValueError, match="no file"):
        read_trips_csv(spark, put(tmp_path / "empty", none=""))


def test_header_look_up_reads_heads_only(spark, tmp_path):
    """Large files: the look-up reads a bounded part of each, and leaves the session's settings alone."""
    line = ",".join(["some value"] * 9) + "\n"
    folder = put(tmp_path / "large", **{f"f{i}": "a,b,c\n"[:: 1 if i % 2 else -1].strip() + "\n" + line * 400_000 for i in range(4)})
    size = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder))
    assert size > 150_000_000
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics
    read = lambda: sum(x.getValue() for x in statistics().get("file").getLongStatistics() if x.getName() == "bytesRead")
    began = read()
    groups = _files_by_header(spark, [folder])
    assert [[os.path.basename(f) for f in g] for g in groups] == [["f0.csv", "f2.csv"], ["f1.csv", "f3.csv"]]
    assert read() - began < 2**20


def test_header_look_up_of_odd_files(spark, tmp_path, rows):
    given = {"one": "a,b\n1,2\n", "two": "\n  \n" * 2000 + "b,a\n4,3\n", "none": "\n\n", "empty": "", "é x%20": "a,b\n5,6\n"}
    folder = put(tmp_path / "odd", **given)
    want = [("1", "2"), ("3", "4"), ("5", "6")]
    assert rows(read_trips_csv(spark, folder).select("a", "b")) == want
    groups = [[os.path.basename(f) for f in g] for g in _files_by_header(spark, [folder])]
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "64"}):  # the header behind blank lines is in a later part
        assert [[os.path.basename(f) for f in g] for g in _files_by_header(spark, [folder])] == groups


def test_unused_csv_columns_are_not_parsed(spark, tmp_path, rows):
    folder = put(tmp_path / "d", one="a,b,c\n1,2,3\n", two="c,b,a\n4,5,6\n")
    df = read_trips_csv(spark, folder).select("a")
    assert rows(df) == [("1",), ("6",)]
    assert "ReadSchema: struct<a:string>" in plan(df)


def test_ragged_rows_and_blank_lines(spark, tmp_path, rows):
    folder = put(tmp_path / "d", one="a,b\n\n1,2,,\n3\n4,\"x, y\"\n", two="a,b\r\n5,6\r\n")
    assert rows(read_trips_csv(spark, folder)) == sorted([("1", "2"), ("3", None), ("4", "x, y"), ("5", "6")], key=str)
    assert rows(read_trips_csv(spark, folder).select("b")) == sorted([("2",), (None,), ("x, y",), ("6",)], key=str)


def test_zone_file(spark, tmp_path, rows):
    path = put(tmp_path / "z", zones="zone_id,borough\n56,Queens\n56,Queens\n3,Bronx\n")
    assert rows(read_zones(spark, path)) == [("3", "Bronx"), ("56", "Queens"), ("56", "Queens")]


def test_pairs_csv(spark, tmp_path, rows):
    path = str(tmp_path / "pairs")
    df = spark.createDataFrame([(9.5, "2.5"), (1e-7, "x")], "fare double, distance string")
    write_pairs_csv(df, path, "fare", "distance")
    (text,) = [open(f"{path}/{f}").read() for f in os.listdir(path) if f.endswith(".csv") and "9.5" in open(f"{path}/{f}").read()]
    assert "9.5,2.5" in text and "fare" not in text
    assert rows(read_pairs_csv(spark, path)) == sorted([(9.5, 2.5), (1e-7, None)], key=str)
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        read_pairs_csv(spark, put(tmp_path / "bad", one="1.0,two\n")).collect()


def test_compact_table_is_one_file_and_partitions_prune(spark, tmp_path):
    df = spark.range(0, 1000, 1, 16).withColumns({"taxi_type": F.lit("green"), "year": (2015 + F.col("id") % 3).cast("int")})
    small = str(tmp_path / "small")
    write_table(df, small, compact=True)
    assert len(data_files(small)) == 1 and read_table(spark, f"{small}/*.parquet").count() == 1000
    total = str(tmp_path / "total")
    write_table(df, total, partition_by=["taxi_type", "year"], compact=True)
    assert len(data_files(total)) == 3
    year = read_table(spark, total).where("taxi_type = 'green' AND year = 2016")
    assert year.count() == 333
    assert "PartitionFilters: [isnotnull(taxi_type" in plan(year)
    write_table(df.limit(1), small)
    assert read_table(spark, small).count() == 1


def test_compact_splits_what_exceeds_one_file(spark, tmp_path):
    """A third of all rows in one folder: several files, not one task."""
    path = str(tmp_path / "hot")
    df = spark.range(0, 300_000, 1, 16).select(F.rand(3).alias("v"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB", "spark.sql.shuffle.partitions": "32"}):
        write_table(df, path, partition_by=["k"], compact=True)
    assert len(os.listdir(f"{path}/k=0")) > 3
    assert read_table(spark, path).count() == 300_000


def test_write_leaves_session_settings_alone(spark, tmp_path):
    key = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(key)
    write_table(spark.range(3), str(tmp_path / "t"), compact=True)
    assert spark.conf.get(key) == before


def test_publish_table(spark, tmp_path, rows):
    path = str(tmp_path / "daily's")
    df = spark.createDataFrame([], DAILY)
    write_table(df, path, compact=True)
    for _ in range(2):
        publish_table(spark, "published_daily", DAILY, path)
    assert spark.table("published_daily").schema.fieldNames() == DAILY.fieldNames()
    assert "parquet" in str(spark.sql("SHOW TBLPROPERTIES published_daily").collect())
    spark.sql("DROP TABLE published_daily")
    part = str(tmp_path / "map")
    city = [f for f in MONTH_MAP.fieldNames()]
    write_table(spark.createDataFrame([("New York", "green", -73.9, 40.7, 1, 2.0, 9.0, 1, None)], MONTH_MAP), part, ["taxi_type"])
    publish_table(spark, "published_map", MONTH_MAP, part, ["taxi_type"])
    assert set(spark.table("published_map").columns) == set(city) and spark.table("published_map").count() == 1
    spark.sql("DROP TABLE published_map")


def test_warehouse_by_catalog_and_by_connector(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    for _ in range(2):
        write_warehouse(df, "stored_trips", path=str(tmp_path / "w"))
    assert rows(read_warehouse(spark, "stored_trips")) == [(1, "a")]
    spark.sql("DROP TABLE stored_trips")
    path = str(tmp_path / "c")
    write_warehouse(df, "anything", fmt="orc", connector=True, path=path)
    assert rows(read_warehouse(spark, "anything", fmt="orc", path=path)) == [(1, "a")]


def test_preview(spark):
    df = spark.range(500)
    assert preview(df).count() == 50
    top = preview(df, 3, [F.col("id").desc()])
    assert [r[0] for r in top.collect()] == [499, 498, 497]
    assert "TakeOrderedAndProject" in plan(top)


class FakeSession:
    def __init__(self, **conf):
        self.conf = {k.replace("_", "."): v for k, v in conf.items()}


def test_scratch_follows_the_session(spark):
    one, two = (scratch_path(FakeSession(spark_checkpoint_dir="/shared/"), "x") for _ in range(2))
    assert one != two and one.startswith("/shared/tripflow/") and one.endswith("/x")
    assert "/tripflow-" in scratch_path(FakeSession(spark_master="local[2]"), "x")
    with pytest.raises(ValueError):
        scratch_path(FakeSession(spark_master="yarn"), "x")


def test_wide_union_stays_one_union(spark, data):
    orders = spark.read.parquet(f"{data}/orders.parquet").select("o_orderkey")
    frames = [orders.withColumnRenamed("o_orderkey", f"c{i % 4}") for i in range(22)]
    assert union_all(frames).count() == 22 * orders.count()
    assert plan(union_all(frames)).split("\n\n")[0].count("Union (") == 1
