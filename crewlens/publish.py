"""Publishing jobs under names, for all tenants at once.

``publish`` keeps a dataset as a view in the catalog, which other sessions read, with a description and tags. Each run
writes its rows to a folder of its own and lists them in a table of its own, one partition per tenant; tenants the run
does not stand for are listed from where the version before has them. The one step that readers see is the last: the
view turns from the old table to the new one. A run that ends before it leaves the old rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crewlens.params import Params
from crewlens.plans import JOBS
from crewlens.sources import Sources

TENANT = "company_id"


def register_all(
    src: Sources, params: Params = Params(), prefix: str = "vw_", jobs: Iterable[str] = tuple(JOBS)
) -> dict[str, DataFrame]:
    """Make each job a view of this session that SQL can query. Views are recomputed on read; nothing runs here."""
    published = {f"{prefix}{name}": JOBS[name](src, params) for name in jobs}
    for name, df in published.items():
        df.createOrReplaceTempView(name)
    return published


def publish_all(
    src: Sources,
    root: str,
    params: Params = Params(),
    *,
    database: str = "default",
    prefix: str = "vw_",
    jobs: Iterable[str] = tuple(JOBS),
    tenants: Iterable[int] | None = None,
) -> list[str]:
    """Each job stored under ``root`` and published as a view of the catalog, described and tagged by its name. With
    ``tenants`` only those are computed and replaced."""
    asked = None if tenants is None else sorted(set(tenants))
    names = []
    for job in jobs:
        df = JOBS[job](src, params)
        name = f"{database}.{prefix}{job}"
        words = job.replace("_", " ")
        publish(
            df if asked is None else df.where(F.col(TENANT).isin(asked)),
            name,
            root,
            description=f"View {words.upper()}",
            tags=["dashboards", f"{prefix}{job}"],
            tenants=asked,
        )
        names.append(name)
    return names


def _quoted(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _version(spark: SparkSession, name: str) -> str | None:
    """The table that a published view reads."""
    if not spark.catalog.tableExists(name):
        return None
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()}
    return properties.get("crewlens.version")


def _locations(spark: SparkSession, table: str) -> dict[int, str]:
    """Where each tenant's rows of a version are."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect():
        cid = int(row[0].split("=", 1)[1])
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)} PARTITION ({TENANT} = {cid})").collect()
        found[cid] = next(r[1] for r in described if r[0] == "Location")
    return found


def publish(
    df: DataFrame,
    name: str,
    root: str,
    *,
    description: str = "",
    tags: Iterable[str] = (),
    properties: Mapping[str, str] | None = None,
    tenants: Iterable[int] | None = None,
) -> str:
    """Store ``df`` under ``root`` and turn the catalog view ``name`` to it. Returns the table behind the view.

    ``tenants`` are those that ``df`` stands for: each is replaced, also by nothing if it has no rows any more, and all
    others stay. Without it ``df`` stands for all. Rows of other tenants, or of none, are an error, and so is a change of
    columns in a run for some tenants; nothing is published then. Files of older versions are left where they are, as
    later versions may list them; ``unlisted`` names the folders that none does.
    """
    spark = df.sparkSession
    names = [n.strip("`") for n in name.split(".")]
    run = uuid.uuid4().hex[:12]
    table, path = f"{name}__{run}", f"{root.rstrip('/')}/{names[-1]}/{run}"
    before = _version(spark, name)
    kept: dict[int, str] = {}
    if tenants is not None:
        tenants = set(tenants)
        if before is not None:
            old = spark.table(before).schema
            if {f.name: f.dataType for f in old} != {f.name: f.dataType for f in df.schema}:
                raise ValueError(f"{name} has other columns, so all tenants must be published together")
            kept = {cid: at for cid, at in _locations(spark, before).items() if cid not in tenants}

    # The rebalance step gathers each tenant's rows into few files, and splits a large tenant over many tasks.
    df.hint("rebalance", TENANT).write.partitionBy(TENANT).parquet(path)
    body = T.StructType([f for f in df.schema if f.name != TENANT])
    kind = df.schema[TENANT].dataType.simpleString()
    stored = spark.read.schema(f"{body.toDDL()}, `{TENANT}` {kind}").parquet(path)
    found = [r[0] for r in stored.select(TENANT).distinct().collect()]
    strange = sorted(str(cid) for cid in found if cid is None or (tenants is not None and cid not in tenants))
    if strange:
        raise ValueError(f"{name}: rows of tenants that this run does not stand for: {', '.join(strange)}")

    spark.sql(f"CREATE TABLE {_quoted(table)} ({body.toDDL()}, `{TENANT}` {kind}) USING parquet PARTITIONED BY (`{TENANT}`) LOCATION {_text(path)}")
    listed = kept | {cid: f"{path}/{TENANT}={cid}" for cid in found}
    if listed:
        parts = " ".join(f"PARTITION ({TENANT} = {cid}) LOCATION {_text(at)}" for cid, at in sorted(listed.items()))
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS {parts}")
    noted = {**(properties or {}), "tags": ",".join(tags), "crewlens.version": table}
    shown = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in noted.items())
    columns = ", ".join(f"`{c}`" for c in df.columns)
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(name)} COMMENT {_text(description)} TBLPROPERTIES ({shown}) AS SELECT {columns} FROM {_quoted(table)}"
    )
    return table


def versions(spark: SparkSession, name: str) -> list[str]:
    """The tables of all finished runs of a published view, and of runs that ended before the view was turned."""
    database, _, last = name.replace("`", "").rpartition(".")
    tables = spark.catalog.listTables(database) if database else spark.catalog.listTables()
    prefix = f"{database}." if database else ""
    return sorted(f"{prefix}{t.name}" for t in tables if re.fullmatch(re.escape(last) + r"__[0-9a-f]{12}", t.name))


def forget_versions(spark: SparkSession, name: str) -> list[str]:
    """Drop all tables of a published view but the one it reads. Their files stay. Returns the dropped tables."""
    current = _version(spark, name)
    dropped = [t for t in versions(spark, name) if t != (current or "").replace("`", "")]
    for table in dropped:
        spark.sql(f"DROP TABLE {_quoted(table)}")
    return dropped


def unlisted(spark: SparkSession, name: str, folders: Iterable[str]) -> list[str]:
    """Of ``folders`` of tenants' rows, those that no version of a view lists: cleaning may delete them."""
    bare = {re.sub(r"^file:/+", "/", at) for t in versions(spark, name) for at in _locations(spark, t).values()}
    return [f for f in folders if re.sub(r"^file:/+", "/", f.rstrip("/")) not in bare]


def write_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    description: str = "",
    *,
    replace_all: bool = False,
    tenants: Iterable[int] | None = None,
) -> None:
    """Store a job as a table partitioned by tenant. Of a table that exists, only ``tenants`` are replaced, or the
    tenants in ``df`` if none are named; a named tenant without rows is emptied. ``replace_all`` replaces the whole table.

    Readers of the table see a run's tenants change one after the other; ``publish`` changes them in one step. The
    rebalance step gathers each tenant's rows into few files, and splits a large tenant over many tasks, so that
    neither tiny files nor one long task come out.
    """
    rows = df.hint("rebalance", TENANT)
    if replace_all or not spark.catalog.tableExists(name):
        rows.write.mode("overwrite").partitionBy(TENANT).format("parquet").saveAsTable(name)
    else:
        columns = spark.table(name).columns
        if set(columns) != set(df.columns):
            raise ValueError(f"{name} has other columns: {sorted(set(columns) ^ set(df.columns))}")
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()
        path = next(r[1] for r in described if r[0] == "Location")
        # The writer's own option: what other threads of the session write is not touched.
        replace = rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        replace.partitionBy(TENANT).parquet(path)
        if tenants is not None:
            stored = spark.read.schema(spark.table(name).schema).parquet(path)
            left = {r[0] for r in rows.where(F.col(TENANT).isin(sorted(set(tenants)))).select(TENANT).distinct().collect()}
            for cid in sorted(set(tenants) - left):
                if not stored.where(F.col(TENANT) == cid).isEmpty():
                    spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS PARTITION ({TENANT} = {cid}) PURGE")
        spark.sql(f"MSCK REPAIR TABLE {_quoted(name)}")
        spark.catalog.refreshTable(name)
    if description:
        spark.sql(f"COMMENT ON TABLE {_quoted(name)} IS {_text(description)}")
