"""Readers and writers for the raw extracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

# Dates stay text until staging, so one bad date is reported with its row.
RAW_USERS_SCHEMA = StructType(
    [
        StructField("user_id", LongType()),
        StructField("first_name", StringType()),
        StructField("last_name", StringType()),
        StructField("email", StringType()),
        StructField("country", StringType()),
        StructField("signup_date", StringType()),
    ]
)
RAW_ORDERS_SCHEMA = StructType(
    [
        StructField("order_id", LongType()),
        StructField("user_id", LongType()),
        StructField("order_date", StringType()),
        StructField("order_amount", DecimalType(12, 2)),
        StructField("order_status", StringType()),
    ]
)
RAW_EVENTS_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("user_id", LongType()),
        StructField("session_id", StringType()),
        StructField("event_name", StringType()),
        StructField("event_timestamp", StringType()),
        StructField("device_type", StringType()),
        StructField("page_url", StringType()),
    ]
)
RAW_SCHEMAS: Mapping[str, StructType] = {
    "users": RAW_USERS_SCHEMA,
    "orders": RAW_ORDERS_SCHEMA,
    "events": RAW_EVENTS_SCHEMA,
}


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    column_map: Mapping[str, str] | None = None,
    mode: str = "FAILFAST",
    check_header: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header line; columns are matched by position, empty fields are NULL.

    A value that does not fit its type fails the job.  ``check_header`` also
    compares the header with the schema, which positional matching ignores.
    ``multiline`` admits line breaks inside quoted fields, at the price that a
    file can no longer be split among tasks.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", mode)
        .option("escape", '"')
        # Only an unquoted empty field is NULL; a quoted one is an empty text.
        .option("nullValue", "\u0000")
        .option("multiLine", multiline)
        .option("enforceSchema", not check_header)
        .csv(path)
    )
    return rows.withColumnsRenamed(dict(column_map or {}))


def read_raw_parquet(
    spark: SparkSession, path: str, columns: Sequence[str], column_map: Mapping[str, str] | None = None
) -> DataFrame:
    """Parquet with upstream names mapped to ours; only ``columns`` are read."""
    return spark.read.parquet(path).withColumnsRenamed(dict(column_map or {})).select(*columns)


def read_raw_tables(spark: SparkSession, csv_paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """All three raw tables.  A missing path fails here, before anything is written."""
    missing = sorted(set(RAW_SCHEMAS) - set(csv_paths))
    if missing:
        raise ValueError(f"no path for raw tables: {', '.join(missing)}")
    return {name: read_raw_csv(spark, csv_paths[name], schema) for name, schema in RAW_SCHEMAS.items()}


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    """Only ``columns`` are written, in that order; NULL becomes an empty field."""
    df.select(*columns).write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


CORRUPT = "_corrupt_record"


def read_raw_csv_with_rejects(
    spark: SparkSession, path: str, schema: StructType, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """CSV rows that fit ``schema``, typed, and the rejected ones as read, for feeds where a broken row must not stop the run.

    A rejected row carries ``reason``: ``fields`` for too few or too many of
    them, with the line in ``_corrupt_record``; else the columns whose value
    does not fit its type, joined by ``+``.
    """
    as_text = StructType([StructField(f.name, StringType()) for f in schema] + [StructField(CORRUPT, StringType())])
    rows = (
        spark.read.schema(as_text)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # A query of few columns would not notice that there are too many or too few.
        .option("columnPruning", False)
        .option("escape", '"')
        .option("nullValue", "\u0000")
        .csv(path)
    )
    casts = {f.name: f.dataType.simpleString() for f in schema if not isinstance(f.dataType, StringType)}
    reason = F.when(F.col(CORRUPT).isNotNull(), "fields").otherwise(F.array_join(_bad_columns(casts), "+"))
    judged = rows.withColumn("reason", reason)
    typed = [F.expr(f"nullif(trim({f.name}), '')").cast(f.dataType).alias(f.name) if f.name in casts else F.col(f.name) for f in schema]
    return judged.filter("reason = ''").select(*typed), judged.filter("reason <> ''")


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("row_count"))


def _bad_columns(casts: Mapping[str, str]) -> Column:
    """The names of columns whose text does not fit its type."""

    def broken(column: str, target: str) -> Column:
        given = F.trim(F.col(column).cast("string"))
        return given.isNotNull() & (given != "") & given.try_cast(target).isNull()

    return F.array_compact(F.array(*[F.when(broken(c, t), F.lit(c)) for c, t in casts.items()]))


def quarantine(df: DataFrame, casts: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into castable and not, for feeds where one bad value must not stop the run.

    ``casts`` maps column to target type.  Blank text counts as missing, not
    as bad.  Rejected rows carry ``bad_columns``.
    """
    judged = df.withColumn("bad_columns", _bad_columns(casts))
    fits = F.size("bad_columns") == 0
    return judged.filter(fits).drop("bad_columns"), judged.filter(~fits)
