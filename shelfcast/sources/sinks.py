"""Sinks (S-06..S-08): parquet/CSV writers, split-partitioned output, read-back verification.

Outputs go under the cluster's shared folder (`spark.checkpoint.dir` or a caller path),
never a machine-local temporary folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """CSV scan with a declared schema (no inference pass) (S-01, S-02, S-05)."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", date_format).csv(path)


def align_schema(df: DataFrame, reference_columns: list[str]) -> DataFrame:
    """Select columns in the authoritative order; raises if any is missing (S-04)."""
    missing = [c for c in reference_columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*reference_columns)


def checksum(columns: list[str]):
    """Order-independent sum of the rows' hashes, as a decimal: equal for equal rows in any order."""
    return F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))


def write_verified(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write `df`, counting and hashing its rows on the way, and compare them with what the files hold (S-08).

    n_columns, same_columns, rows_read, rows_expected, same_rows, ok. The source runs once; the
    files are read back. A CSV file has no types, so its rows are compared by number only.
    """
    spark = df.sparkSession
    seen = Observation("written")
    write_table(df.observe(seen, F.count(F.lit(1)).alias("n"), checksum(df.columns).alias("sum")), path, fmt)
    back = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    same_cols = [c.lower() for c in back.columns] == [c.lower() for c in df.columns]
    here = back.agg(F.count(F.lit(1)).alias("rows_read"), (checksum(back.columns) if same_cols else F.lit(None).cast("decimal(38,0)")).alias("_sum"))
    wanted = F.lit(seen.get["sum"]).cast("decimal(38,0)")
    same_rows = F.lit(None).cast("boolean") if fmt == "csv" else F.col("_sum").eqNullSafe(wanted)
    n = F.lit(seen.get["n"]).cast("long")
    return here.select(F.lit(len(back.columns)).alias("n_columns"), F.lit(same_cols).alias("same_columns"), "rows_read", n.alias("rows_expected"), same_rows.alias("same_rows"),
                       (F.lit(same_cols) & (F.col("rows_read") == n) & F.coalesce(same_rows, F.lit(True))).alias("ok"))


def schema_contract(df: DataFrame, expected: dict[str, str], removed: list[str] = (), nullable: list[str] = ()) -> DataFrame:
    """Held against the rows of `df`, a row per expected column: column, type, expected_type, n_rows, nulls, ok (C-17).

    Raises if a column is missing, has another type, or one of `removed` is there. ok: no
    nulls, or the column may have them (`nullable`). Columns that aren't expected are allowed.
    """
    types = dict(df.dtypes)
    missing = [c for c in expected if c not in types]
    leaked = [c for c in removed if c in types]
    other = [f"{c}: {types[c]} instead of {t}" for c, t in expected.items() if c in types and types[c] != t]
    if missing or leaked or other:
        raise ValueError(f"schema contract violated: missing={missing} removed-but-present={leaked} types={other}")
    row = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(expected)))
    one = [F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("type"), F.lit(t).alias("expected_type"), F.col("n").alias("n_rows"), F.col(f"nulls_{i}").alias("nulls"),
                    ((F.col(f"nulls_{i}") == 0) | F.lit(c in nullable)).alias("ok")) for i, (c, t) in enumerate(expected.items())]
    return row.select(F.inline(F.array(*one)))
