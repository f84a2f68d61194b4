from decimal import Decimal
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tallyroom.operators.staging import stage_orders, stage_users
from tallyroom.session import shuffle_partitions_for
from tallyroom.sources import (
    RAW_EVENTS_SCHEMA,
    RAW_ORDERS_SCHEMA,
    RAW_USERS_SCHEMA,
    TargetNotEmptyError,
    guarded_write,
    materialise,
    publish_version,
    quarantine,
    read_published,
    read_raw_csv,
    read_raw_parquet,
    read_raw_tables,
    scratch_dir,
    write_csv,
    write_months,
)

from .builders import raw_events, raw_orders, raw_users

CSV = "order_id,user_id,order_date,order_value,order_status\n1,7,2023-01-01T10:00:00Z,10.005,completed\n2,,2023-01-01T10:00:00Z,,pending\n"


@pytest.fixture
def orders_csv(tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(CSV)
    return str(path)


def test_csv_matches_columns_by_position(spark, rows, orders_csv):
    got = read_raw_csv(spark, orders_csv, RAW_ORDERS_SCHEMA)
    assert rows(got) == [
        (1, 7, "2023-01-01T10:00:00Z", Decimal("10.01"), "completed"),
        (2, None, "2023-01-01T10:00:00Z", None, "pending"),
    ]
    assert rows(stage_orders(got), "order_value") == [(Decimal("10.01"),)]


def test_csv_header_can_be_enforced(spark, orders_csv):
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_raw_csv(spark, orders_csv, RAW_ORDERS_SCHEMA, check_header=True).collect()


def test_csv_bad_value_aborts(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("order_id,user_id,order_date,order_amount,order_status\nx,7,2023-01-01T10:00:00Z,1.00,completed\n")
    with pytest.raises(Exception, match="Malformed records"):
        read_raw_csv(spark, str(path), RAW_ORDERS_SCHEMA).collect()


def test_csv_quotes_are_doubled_and_may_span_lines(spark, rows, tmp_path):
    path = tmp_path / "users.csv"
    path.write_text('user_id,first_name,last_name,email,country,signup_date\n1,"Ann ""A""","O,Neil",a@x.com,"",\n2,"two\nlines",L,b@x.com,US,\n')
    got = read_raw_csv(spark, str(path), RAW_USERS_SCHEMA, multiline=True)
    assert rows(got, "user_id", "first_name", "last_name", "country", "signup_date") == [
        (1, 'Ann "A"', "O,Neil", "", None),
        (2, "two\nlines", "L", "US", None),
    ]


def test_missing_source_fails_before_any_job(spark, orders_csv):
    with pytest.raises(AnalysisException):
        read_raw_tables(spark, {"users": "/nowhere/users.csv", "orders": orders_csv, "events": orders_csv})
    with pytest.raises(ValueError):
        read_raw_tables(spark, {"orders": orders_csv})


def test_csv_round_trip_of_all_raw_tables(spark, rows, tmp_path):
    tables = {
        "users": raw_users(spark, (1, "a@x.com", None, None), (2, "b,\"q\"@x.com", "2023-01-01 00:00:00")),
        "orders": raw_orders(spark, (1, 7, "2023-01-01T10:00:00Z", "9.00", "completed")),
        "events": raw_events(spark, (1, None, "s", "page_view", "2023-01-01 10:00:00")),
    }
    schemas = {"users": RAW_USERS_SCHEMA, "orders": RAW_ORDERS_SCHEMA, "events": RAW_EVENTS_SCHEMA}
    paths = {name: str(tmp_path / name) for name in tables}
    for name, df in tables.items():
        write_csv(df.withColumn("internal_flag", F.lit(True)), paths[name], schemas[name].names)
    loaded = read_raw_tables(spark, paths)
    for name, df in tables.items():
        assert rows(loaded[name]) == rows(df)
    assert rows(stage_users(loaded["users"]), "user_id") == [(2,)]


def test_parquet_reader_maps_and_prunes(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "x", "y")], "id int, a string, b string").write.parquet(path)
    got = read_raw_parquet(spark, path, ["order_id", "a"], {"id": "order_id"})
    assert got.columns == ["order_id", "a"]
    assert "ReadSchema: struct<id:int,a:string>" in got._jdf.queryExecution().executedPlan().toString()


def test_quarantine_splits_rows(spark, rows):
    df = spark.createDataFrame(
        [(1, "2023-01-01", "5.0"), (2, "soon", "5.0"), (3, "", None), (4, "later", "much")], "id int, d string, v string"
    )
    good, bad = quarantine(df, {"d": "date", "v": "decimal(12,2)"})
    assert rows(good, "id") == [(1,), (3,)]
    assert rows(bad, "id", "bad_columns") == [(2, ["d"]), (4, ["d", "v"])]


def test_guarded_write(spark, rows, tmp_path):
    target, df = str(tmp_path / "t"), spark.createDataFrame([(1,)], "k int")
    guarded_write(df.limit(0), target)
    guarded_write(df, target)
    with pytest.raises(TargetNotEmptyError):
        guarded_write(df, target)
    guarded_write(df.withColumn("k", F.lit(2)), target, replace=True)
    assert rows(spark.read.parquet(target)) == [(2,)]
    with pytest.raises(ValueError):
        guarded_write(df, target, replace=True, allowed_targets=["elsewhere"])


def test_a_failed_publish_changes_nothing(spark, rows, tmp_path):
    root = str(tmp_path / "root")
    good = spark.createDataFrame([(1,)], "k int")
    first = publish_version({"a": good, "b": good}, root)
    broken = good.withColumn("k", F.raise_error(F.lit("stop")).cast("int"))
    with pytest.raises(PySparkException):
        publish_version({"a": good.withColumn("k", F.lit(2)), "b": broken}, root)
    assert rows(read_published(spark, root, "a")) == [(1,)]
    second = publish_version({"a": good.withColumn("k", F.lit(3))}, root)
    assert second > first
    assert rows(read_published(spark, root, "a")) == [(3,)]
    assert rows(read_published(spark, root, "b")) == [(1,)]
    assert read_published(spark, root, "c") is None


def test_publish_without_replace_protects_rows(spark, tmp_path):
    root, df = str(tmp_path / "root"), spark.createDataFrame([(1,)], "k int")
    publish_version({"a": df.limit(0)}, root, replace=False)
    publish_version({"a": df}, root, replace=False)
    with pytest.raises(TargetNotEmptyError):
        publish_version({"a": df}, root, replace=False)
    with pytest.raises(ValueError):
        publish_version({"a": df}, root, allowed_roots=["/elsewhere"])


def test_a_published_table_may_be_derived_from_its_former_self(spark, rows, tmp_path):
    root = str(tmp_path / "root")
    publish_version({"a": spark.createDataFrame([(1,)], "k int")}, root)
    publish_version({"a": read_published(spark, root, "a").withColumn("k", F.col("k") + 1)}, root)
    assert rows(read_published(spark, root, "a")) == [(2,)]


def test_months_are_replaced_alone(spark, rows, tmp_path):
    target = str(tmp_path / "months")
    day = lambda *rs: spark.createDataFrame(list(rs), "d string, v int").withColumn("d", F.col("d").cast("date"))
    write_months(day(("2023-01-01", 1), ("2023-02-01", 1)), "d", target)
    write_months(day(("2023-02-05", 2)), "d", target)
    got = spark.read.parquet(target)
    assert [(str(a), b) for a, b in rows(got, "d", "v")] == [("2023-01-01", 1), ("2023-02-05", 2)]


def test_scratch_lies_in_the_clusters_shared_folder_and_is_removed(spark, rows):
    shared = spark.conf.get("spark.checkpoint.dir")
    with scratch_dir(spark, "/elsewhere") as folder, scratch_dir(spark, "/elsewhere") as other:
        assert folder.startswith(shared) and folder != other
        stored = materialise(spark.createDataFrame([(1, "a")], "k int, v string"), f"{folder}/t")
        assert rows(stored) == [(1, "a")]
        assert "FileScan parquet" in stored._jdf.queryExecution().executedPlan().toString()
    assert not Path(folder).exists() and Path(shared).exists()


def test_scratch_falls_back_beside_the_target(spark, tmp_path):
    no_shared_folder = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), _jvm=spark._jvm, _jsc=spark._jsc)
    with pytest.raises(RuntimeError), scratch_dir(no_shared_folder, str(tmp_path)) as folder:
        assert folder.startswith(str(tmp_path))
        materialise(spark.range(1), f"{folder}/t")
        raise RuntimeError("a failing run")
    assert not Path(folder).exists()


def test_shuffle_partitions_grow_with_the_data():
    assert shuffle_partitions_for(0) == 8
    assert shuffle_partitions_for(100 * 2**40) == 819_200
