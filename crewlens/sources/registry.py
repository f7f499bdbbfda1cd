"""Logical table names bound to DataFrames, all tenants together."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens.sources.layout import is_bucketed, layout_name
from crewlens.sources.schemas import SCHEMAS

Table = DataFrame | Callable[[], DataFrame]

# A cleaned copy of these tables may be bound under its own name; without one the raw table is read.
_COPIES = {"technician_copy": "technician", "timesheet_copy": "timesheet"}

_UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


class Sources:
    """The tables the jobs read and the tenants' time zones (``company_id`` to zone name).

    A table is a DataFrame, or a function that opens it when a job first asks for it. Every table
    has ``company_id``; it leads all join, group and window keys, so tenants never mix.

    ``together`` names the tables that lie in buckets by their key, without a hot one (see ``layout``): jobs join those to
    each other as they lie. ``of_tenant`` opens a table of one tenant, where that is less than opening all.
    """

    def __init__(
        self,
        tables: Mapping[str, Table],
        zones: Mapping[int, str],
        *,
        together: Iterable[str] = (),
        of_tenant: Callable[[int, str], DataFrame] | None = None,
    ):
        self._tables = dict(tables)
        self.zones = dict(zones)
        self._together = frozenset(together)
        self._of_tenant = of_tenant

    def lie_together(self, *names: str) -> bool:
        return all(name in self._together for name in names)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            name = _COPIES.get(name, name)
        if name not in self._tables:
            raise KeyError(f"no source bound for table {name!r}")
        found = self._tables[name]
        if not isinstance(found, DataFrame):
            found = self._tables[name] = found()
        zone = found.sparkSession.conf.get("spark.sql.session.timeZone")
        if zone not in _UTC_NAMES:
            raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")
        return found

    def names(self) -> list[str]:
        """The bound tables."""
        return sorted(self._tables)

    def for_company(self, company_id: int) -> Sources:
        """The same sources cut to one tenant; on a partitioned layout this prunes directories."""

        def cut(name: str) -> Callable[[], DataFrame]:
            if self._of_tenant is not None:
                return lambda: self._of_tenant(company_id, name)
            return lambda: self.table(name).where(F.col("company_id") == company_id)

        return Sources({name: cut(name) for name in self._tables}, self.zones, together=self._together)

    def repeated_ids(self, *names: str) -> DataFrame:
        """``table``, ``company_id``, ``id`` and ``rows`` of every id that stands more than once in one of the tables (all
        that have an ``id`` by default). Jobs look rows up by id: one that is repeated multiplies what is joined to it."""
        keyed = names or tuple(n for n, ddl in SCHEMAS.items() if n in self._tables and re.search(r"(^|, *)`?id`? ", ddl))
        counts = [
            self.table(n).groupBy("company_id", "id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(F.lit(n).alias("table"), "company_id", "id", "rows")
            for n in keyed
        ]
        return reduce(DataFrame.unionByName, counts)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, zones: Mapping[int, str]) -> Sources:
        """One Parquet dataset per table under ``root``, partitioned as ``company_id=<id>``. Schemas
        are declared, so no file is opened to infer one."""

        def opener(name: str, ddl: str) -> Callable[[], DataFrame]:
            return lambda: spark.read.schema(f"{ddl}, company_id BIGINT").parquet(f"{root}/{name}")

        return cls({name: opener(name, ddl) for name, ddl in SCHEMAS.items()}, zones)

    @classmethod
    def from_tenant_roots(
        cls, spark: SparkSession, roots: Mapping[int, str], zones: Mapping[int, str]
    ) -> Sources:
        """One directory of tables per tenant, as the raw loads leave them: ``<root>/<table>``.

        A table is one scan over all roots; a row's tenant follows from the path of its file. Roots are spelled as the
        file system spells them first, so ``/x/../t1`` and ``//t1`` are ``/t1``; a file under no root is an error, and so
        are two tenants with one root. ``for_company`` opens the files of that tenant's root alone."""
        by_root: dict[str, int] = {}
        for cid, root in roots.items():
            full = _qualified(spark, root)
            if full in by_root:
                raise ValueError(f"tenants {by_root[full]} and {cid} have the same root {full}")
            by_root[full] = cid
        own = {cid: root for root, cid in by_root.items()}
        spelled = {root: _spelled(spark, root) for root in by_root}

        def opener(name: str, ddl: str) -> Callable[[], DataFrame]:
            def open_() -> DataFrame:
                found = spark.read.schema(ddl).parquet(*[f"{root}/{name}" for root in by_root])
                file, longest_last = F.col("_metadata.file_path"), sorted(by_root.items(), key=lambda x: len(x[0]))

                def inside(path: Column, spelled: Callable[[str], str], tenant: Column) -> Column:
                    for root, cid in longest_last:
                        held = F.startswith(path, F.lit(f"{spelled(root)}/{name}/"))
                        tenant = F.when(held, F.lit(cid).cast("bigint")).otherwise(tenant)
                    return tenant

                # Without the scheme, which is spelled in several ways, and not escaped. Decoding each row's path costs more
                # than all else, so it is left to paths that are spelled unlike their root.
                raw = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
                path = F.regexp_replace(raw, _SCHEME, "/")
                lost = F.raise_error(F.concat(F.lit("no tenant's root holds "), path)).cast("bigint")
                tenant = inside(file, spelled.__getitem__, inside(path, lambda root: re.sub(_SCHEME, "/", root), lost))
                return found.withColumn("company_id", tenant)

            return open_

        def of_tenant(cid: int, name: str) -> DataFrame:
            name = _COPIES.get(name, name)
            found = spark.read.schema(SCHEMAS[name])
            # A tenant without a root has no rows, as in the scan over all roots.
            found = found.parquet(f"{own[cid]}/{name}") if cid in own else spark.createDataFrame([], SCHEMAS[name])
            return found.withColumn("company_id", F.lit(cid).cast("bigint"))

        tables = {name: opener(name, ddl) for name, ddl in SCHEMAS.items()}
        return cls(tables, zones, of_tenant=of_tenant)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, zones: Mapping[int, str]) -> Sources:
        """The tables of a database of the catalog, as ``layout.write_buckets`` leaves them."""
        names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
        logical = {layout_name(n): n for n in names}

        def opener(name: str) -> Callable[[], DataFrame]:
            return lambda: spark.table(f"`{database}`.`{name}`")

        together = [n for n, t in logical.items() if is_bucketed(spark, f"`{database}`.`{t}`")]
        return cls({n: opener(t) for n, t in logical.items()}, zones, together=together)


_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:/*"


def _qualified(spark: SparkSession, root: str) -> str:
    """The root as its file system spells it: with its scheme, without dots and doubled slashes."""
    if not re.match(_SCHEME, root):  # two slashes in front would name a host
        root = re.sub("/+", "/", root)
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().rstrip("/")


def _spelled(spark: SparkSession, root: str) -> str:
    """A qualified root as paths of files under it begin: escaped."""
    return spark._jvm.org.apache.hadoop.fs.Path(root).toUri().toString()
