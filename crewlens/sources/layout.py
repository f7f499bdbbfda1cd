"""How tables lie on disk: in buckets by key, or in ranges of time."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.operators.joins import plan_bytes, row_bytes

if TYPE_CHECKING:
    from crewlens.sources.registry import Sources

# The key of each table that other tables are joined to, or that it is summed by.
BUCKET_KEYS: dict[str, str] = {
    "invoice": "id",
    "invoice_item": "invoice_id",
    "estimate": "id",
    "estimate_item": "estimate_id",
    "job": "id",
    "appointment": "job_id",
    "appointment_assignment": "job_id",
    "job_split": "job_id",
    "timesheet": "job_id",
    "purchase_order": "job_id",
    "return": "job_id",
}

# The instant that reports cut a table by.
TIMES: dict[str, str] = {
    "job": "completed_on",
    "appointment": "start",
    "timesheet": "created_on",
    "non_job_timesheets": "created_on",
    "estimate": "sold_on",
}

_PREFIX = "src_"
HOT = 4

# Of a range as Spark estimates it; for files that is their compressed size, and its task sorts some ten times as much.
RANGE_BYTES = 16 * 1024 * 1024
# Spark says this or more of rows whose size it cannot tell.
_NO_SIZE = 1 << 50


def layout_name(table: str) -> str:
    """The logical name of a stored table."""
    return table.removeprefix(_PREFIX)


def is_bucketed(spark: SparkSession, table: str) -> bool:
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return "Num Buckets" in described


def _even(df: DataFrame, keys: list[str], buckets: int) -> bool:
    """Whether no bucket holds more than four times the mean. Counts are summed before they are sent."""
    sizes = df.groupBy(F.pmod(F.hash(*keys), F.lit(buckets)).alias("bucket")).count()
    total, most = sizes.agg(F.sum("count"), F.max("count")).first()
    return total is None or most * buckets <= HOT * total


def write_buckets(src: Sources, database: str, buckets: int, tables: Iterable[str] | None = None) -> dict[str, bool]:
    """Store tables of ``src`` in a database of the catalog, those of ``BUCKET_KEYS`` in buckets by key and tenant, sorted:
    a parent and its children are then joined, and children summed per parent, without a shuffle of either.

    A bucket is read by one task, so a table with a hot key (a bucket above four times the mean) is stored without
    buckets, and jobs split that key as they join. Returns which tables lie in buckets."""
    out = {}
    for name in tables if tables is not None else src.names():
        df = src.table(name)
        keys = [BUCKET_KEYS[name], "company_id"] if name in BUCKET_KEYS else []
        out[name] = bool(keys) and _even(df, keys, buckets)
        target = f"{database}.{_PREFIX}{name}"
        if out[name]:
            # One task per bucket, so one file each.
            dealt = df.repartition(buckets, *keys)
            dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(target)
        else:
            df.write.mode("overwrite").saveAsTable(target)
    return out


def _ranges(df: DataFrame) -> int:
    """How many ranges hold about ``RANGE_BYTES`` each. A table that Spark has no size of is counted."""
    size = plan_bytes(df)
    if size is None or size >= _NO_SIZE:
        size = df.count() * row_bytes(df)
    return -(-size // RANGE_BYTES)


def write_ranges(src: Sources, root: str, files: int, tables: Mapping[str, str] | None = None) -> None:
    """Store tables of ``src`` under ``root`` in directories by tenant, as ``Sources.from_parquet`` reads them, and
    within a tenant in ranges of time: the statistics of a file's groups of rows then tell a scan for some years to skip
    all others. A range is one task's work, so there are ``files`` ranges per table and more of a large one, of about
    ``RANGE_BYTES`` each; a large tenant has more files, and one instant may span several."""
    for name, time in (tables if tables is not None else TIMES).items():
        df = src.table(name)
        # The salt lets one instant, or NULL, that many rows have spread over ranges; sorted once more by it, files
        # would not be narrower.
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 16))
        dealt = df.withColumn("__salt", salt).repartitionByRange(max(files, _ranges(df)), "company_id", time, "__salt")
        dealt.sortWithinPartitions("company_id", time).drop("__salt").write.mode("overwrite").partitionBy("company_id").parquet(f"{root}/{name}")
