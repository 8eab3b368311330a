import os

import pytest
from pyspark.sql import functions as F

from beaconry import session
from beaconry.sources import keyvalue, partitions, tables, textfiles


def test_snapshot_choices(spark):
    df = spark.createDataFrame([("20240101", 1), ("20240105", 2)], "dt string, v int")
    assert partitions.snapshot(df, "dt", "20240101")[1] == "20240101"
    assert partitions.snapshot(df, "dt", "20240103")[1] == "20240105"
    assert partitions.snapshot(df, "dt", "20240103", not_after=True)[1] == "20240101"
    assert partitions.snapshot(df.where("v > 9"), "dt", "20240103")[1] == "20240103"
    whole, used = partitions.snapshot(df, "dt", None)
    assert used is None and whole.count() == 2


def test_static_write_replaces_only_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(5).withColumn("x", F.lit("a"))
    partitions.write_partition(df, path, ["id", "x"], dt="1", tag="p")
    partitions.write_partition(df.limit(2), path, ["id", "x"], dt="2", tag="p")
    counted = partitions.write_partition(df.limit(3), path, ["id", "x"], dt="1", tag="p")
    assert counted.get["rows"] == 3
    rows = spark.read.schema("id bigint, x string, dt string, tag string").parquet(path).groupBy("dt").count().collect()
    assert {r["dt"]: r["count"] for r in rows} == {"1": 3, "2": 2}
    with pytest.raises(ValueError):
        partitions.write_partition(df, path, ["id"])


def test_drift_is_an_error_and_drops_nothing(spark):
    spec = tables.TableSpec.parse("drifting", "a string, m map<string, int>", "dt")
    tables.create_table(spark, spec)
    tables.insert_rows(spark, spec, [("x", {"k": 1})], dt="1")
    with pytest.raises(tables.SchemaDrift, match="unknown m"):
        tables.create_table(spark, tables.TableSpec.parse("drifting", "a string, b int", "dt"))
    assert spark.table("drifting").count() == 1
    assert partitions.has_partition(spark, "drifting", dt="1") and not partitions.has_partition(spark, "drifting", dt="2")
    partitions.drop_partition(spark, "drifting", dt="1")
    assert not partitions.has_partition(spark, "drifting", dt="1")


def test_features_come_from_the_first_table_that_has_them(spark):
    users = spark.createDataFrame([("u",), ("v",)], "user_id string")
    one = spark.createDataFrame([("u", 1), ("u", 1)], "cust_id string, a int")
    two = spark.createDataFrame([("u", 5, "x"), ("v", 6, "y")], "cust_id string, a int, b string")
    rows = tables.load_features(users, [one, two], ["a", "b", "c"]).orderBy("user_id").collect()
    assert [tuple(r) for r in rows] == [("u", 1, "x"), ("v", None, "y")]


def test_delivery_without_data_is_empty(spark, tmp_path):
    row = textfiles.write_delivery(None, spark, str(tmp_path), "E", ["a", "b"]).first()
    assert (row["bytes"], row["rows"]) == (len("a@!@b\n"), 0)


def test_delivery_blanks_tokens(spark, tmp_path):
    df = spark.createDataFrame([("1", None), ("NULL_VALUE", "z")], "a string, b string")
    textfiles.write_delivery(df, spark, str(tmp_path), "D", ["a", "b"])
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "D")).collect()) == ["1@!@", "@!@z"]
    assert os.path.isdir(tmp_path / "D.manifest")


def test_export_has_no_quotes(spark, tmp_path):
    path = str(tmp_path / "x")
    textfiles.write_delimited(spark.createDataFrame([('say "hi"', "b")], "t string, u string"), path)
    assert textfiles.read_with_header(spark, path).first().asDict() == {"t": 'say "hi"', "u": "b"}


def test_rows_reach_the_store(spark, tmp_path):
    folder = str(tmp_path)

    class FolderStore:
        """A stand-in store: one file per key."""

        def put(self, key, value, ttl):
            with open(f"{folder}/{key}", "w") as out:
                out.write(f"{ttl} {value}")

        def close(self):
            pass

    rows = keyvalue.kv_rows(spark.createDataFrame([(7, "n", None)], "id int, name string, x string"), "k", "id", ["name", "x"], 60)
    keyvalue.put_rows(rows, FolderStore)
    assert (tmp_path / "k|7").read_text() == '60 {"name":"n","x":null}'


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == folder
    assert session.scratch_path(spark, "a").startswith(folder)


def test_bad_rows_go_whichever_columns_are_used(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a\x01b\nx\x011\ny\x01oops\nz\x013\n")
    df = textfiles.read_delimited(spark, str(tmp_path / "in.csv"), "a string, b int")
    assert df.count() == 2 and len(df.collect()) == 2 and len(df.select("a").collect()) == 2


def test_export_of_empty_text(spark, tmp_path):
    textfiles.write_delimited(spark.createDataFrame([("", "a"), (None, "b")], "x string, y string"), str(tmp_path / "out"))
    assert sorted(r.y for r in textfiles.read_with_header(spark, str(tmp_path / "out")).where("x is null").collect()) == ["a", "b"]


def test_delivery_line_stays_one_line(spark, tmp_path):
    df = spark.createDataFrame([("a\r\nb", "c")], "x string, y string")
    made = textfiles.write_delivery(df, spark, str(tmp_path), "D", ["x", "y"]).first()
    assert made.rows == 1 and [r.value for r in spark.read.text(str(tmp_path / "D")).collect()] == ["a b@!@c"]


def test_partition_names_in_any_order_and_with_any_value(spark):
    spark.sql("DROP TABLE IF EXISTS parts_probe")
    spark.sql("CREATE TABLE parts_probe (x int, dt string, tag string) USING parquet PARTITIONED BY (dt, tag)")
    spark.sql("INSERT INTO parts_probe VALUES (1, '20240101', 'a/b'), (2, '20240101', \"o'x\"), (3, '20300101', 'c+d')")
    assert partitions.has_partition(spark, "parts_probe", tag="a/b", dt="20240101")
    assert partitions.has_partition(spark, "parts_probe", dt="20300101", tag="c+d")
    assert not partitions.has_partition(spark, "parts_probe", dt="20240101")
    partitions.drop_partition(spark, "parts_probe", tag="o'x", dt="20240101")
    assert not partitions.has_partition(spark, "parts_probe", tag="o'x", dt="20240101")
    assert partitions.retire(spark, "parts_probe", F.lit("2024-06-01").cast("date"), 30) == ["20240101"]
    assert [r.x for r in spark.table("parts_probe").collect()] == [3]
    spark.sql("DROP TABLE parts_probe")


def test_partitions_from_the_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, d) for i, d in enumerate(["20240101", "20240105", "20240105", "a/b c"])], "id int, dt string")
    partitions.write_by_value(df, path, ["dt"])
    assert sorted(partitions.partition_folders(spark, path, "dt")) == ["20240101", "20240105", "a/b c"]
    rows, used = partitions.snapshot_of_path(spark, path, "dt", "20240103", not_after=True)
    assert used == "20240101" and [tuple(r) for r in rows.collect()] == [(0, "20240101")]
    rows, used = partitions.snapshot_of_path(spark, path, "dt", "20240105")
    assert used == "20240105" and sorted(r.id for r in rows.collect()) == [1, 2]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and all("dt=20240105" in f for f in rows.inputFiles())
    assert partitions.snapshot_of_path(spark, path, "dt", "a/b c")[0].collect()[0].id == 3
    assert partitions.snapshot_of_path(spark, path, "dt", None)[0].count() == 4
    rows, used = partitions.snapshot_of_path(spark, path, "dt", "20230101", not_after=True)
    assert used == "20230101" and rows.count() == 0
    flat = str(tmp_path / "flat")
    df.write.parquet(flat)
    rows, used = partitions.snapshot_of_path(spark, flat, "day", "20240101")
    assert used == "20240101" and rows.count() == 4


def test_partitions_below_other_keys(spark, tmp_path):
    path = str(tmp_path / "n")
    partitions.write_by_value(spark.createDataFrame([(1, "x", "1"), (2, "y", "1"), (3, "x", "2")], "id int, tag string, dt string"), path, ["tag", "dt"])
    rows, used = partitions.snapshot_of_path(spark, path, "dt", "1")
    assert used == "1" and sorted((r.id, r.tag) for r in rows.collect()) == [(1, "x"), (2, "y")]


def test_snapshot_of_a_catalog_table(spark, tmp_path):
    spec = tables.TableSpec.parse("beaconry_snapshots", "id int", "dt")
    tables.create_table(spark, spec, str(tmp_path / "c"))
    try:
        for day in ("20240101", "20240104"):
            tables.insert_rows(spark, spec, [(int(day[-1]),)], dt=day)
        assert partitions.snapshot_of_table(spark, spec.name, "dt", "20240102")[1] == "20240104"
        rows, used = partitions.snapshot_of_table(spark, spec.name, "dt", "20240102", not_after=True)
        assert used == "20240101" and [r.id for r in rows.collect()] == [1]
        assert partitions.snapshot_of_table(spark, spec.name, "day", "20240102")[0].count() == 2
    finally:
        spark.sql(f"DROP TABLE {spec.name}")


def test_declared_write_checks_before_it_writes(spark, tmp_path):
    path = str(tmp_path / "d")
    spec = tables.TableSpec.parse("t", "id bigint, tags array<string>", "dt", "tag")
    df = spark.createDataFrame([(1, ["a"], "x")], "id int, tags array<string>, more string")
    for wrong in ({"dt": "1"}, {"tag": "1", "dt": "1"}, {"dt": "1", "tag": "2", "more": "3"}, {}, {"dt": "1", "tag": ""}, {"dt": 1, "tag": "2"}):
        with pytest.raises(partitions.PartitionMismatch):
            partitions.write_declared(df, path, spec, **wrong)
    for rows in (df.drop("tags"), df.withColumn("tags", F.lit("a"))):
        with pytest.raises(tables.SchemaDrift):
            partitions.write_declared(rows, path, spec, dt="1", tag="2")
    assert not (tmp_path / "d").exists()
    assert partitions.write_declared(df, path, spec, dt="1", tag="2").get["rows"] == 1
    back = spark.read.schema(spec.schema).parquet(path)
    assert back.dtypes[0] == ("id", "bigint") and [tuple(r) for r in back.collect()] == [(1, ["a"], "1", "2")]


def test_equal_versions_have_a_stable_survivor(spark):
    rows = [(1, "v", "b"), (1, "v", "a"), (2, "v", None), (2, "v", "z")]
    for order in (rows, rows[::-1]):
        log = spark.createDataFrame(order, "k int, version string, x string").repartition(3)
        assert sorted((r.k, r.x) for r in tables.latest_versions(log, "k", "version").collect()) == [(1, "a"), (2, None)]
