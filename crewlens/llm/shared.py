"""Tables written to the shared folder, and small helpers of the operators."""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, a fresh temporary one, but only if the driver is all there
    is (tests): executors elsewhere would each write to a disk of their own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="crewlens-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def written(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """The rows written once as Parquet to the shared folder and read back: lineage ends there. `batch`: rows that a
    Python function gets at a time, fewer than Spark's default where rows are large."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    if batch:
        spark.conf.set(setting, str(batch))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a few numbers that may be sent to every executor (some tens of MB).
BROADCAST_ROWS = 1 << 20


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it has at most `rows` rows; as it is otherwise, to be joined by shuffle. Its
    counting runs its plan: give it a written table."""
    return F.broadcast(df) if df.count() <= rows else df


#: What one range of a hash space may hold, in its one task.
RANGE_BYTES = 64 << 20


def hash_ranges(spark: SparkSession, sent: float) -> int:
    """Into how many equal ranges (a power of two) to cut a hash space that `sent` bytes fall into: as many as shuffle
    partitions, and as many as keep a range at `RANGE_BYTES` or less on average."""
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sent / RANGE_BYTES)
    return 1 << max(0, math.ceil(math.log2(most)))


def remainder(column: str, base: int) -> Column:
    """crc32 of the column as text, modulo base."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % base


#: Rows that Python functions get at a time where the session has Spark's default of 10,000: rows hold whole texts, and a
#: batch is held on both sides.
ROWS_PER_BATCH = 2048


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once per application (as `--py-files` would), and makes their
    batches of rows smaller unless the session has set them itself."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(ROWS_PER_BATCH))
    context = spark.sparkContext
    if getattr(context, "_crewlens_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="crewlens-")) / "crewlens.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._crewlens_shipped = True
