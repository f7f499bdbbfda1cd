"""How tables are found, and how they lie."""

import datetime as dt
import glob
import os
import uuid
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from conftest import SF, got
from pyspark.sql import functions as F

from checks.testbed import PARAMS, ZONES, sources
from crewlens import Params, Sources, plans
from crewlens.params import JoinTuning
from crewlens.plans import rollups, timesheets
from crewlens.sources import layout, registry, write_buckets, write_ranges


def _tenant_files(spark, top, names=("technician", "employee")):
    src = sources(spark, SF)
    for name in names:
        for cid in ZONES:
            src.for_company(cid).table(name).drop("company_id").write.parquet(f"{top}/t{cid}/{name}")
    return src


@pytest.mark.parametrize("spelling", ["{top}/x/../t{cid}", "/{top}//t{cid}/", "file:{top}/./t{cid}", "file://{top}/t{cid}", "{top}/t{cid}"])
def test_roots_are_spelled_as_the_file_system_spells_them(spark, tmp_path, spelling):
    src = _tenant_files(spark, tmp_path)
    roots = {cid: spelling.format(top=tmp_path, cid=cid) for cid in ZONES}
    found = Sources.from_tenant_roots(spark, roots, ZONES)
    assert got(plans.technicians_employees(found)) == got(plans.technicians_employees(src))


def test_a_root_inside_another_is_the_nearer_one(spark, tmp_path):
    top = tmp_path / "with space+plus%41"
    src = sources(spark, SF)
    for cid, root in ((1, top), (2, top / "technician_roots" / "inner")):
        src.for_company(cid).table("technician").drop("company_id").write.parquet(f"{root}/technician")
    found = Sources.from_tenant_roots(spark, {1: str(top), 2: f"{top}/technician_roots/inner"}, ZONES)
    assert got(found.table("technician").groupBy("company_id").count(), "company_id", "count") == got(
        src.table("technician").where("company_id < 3").groupBy("company_id").count(), "company_id", "count"
    )


def test_two_tenants_with_one_root_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="same root"):
        Sources.from_tenant_roots(spark, {1: str(tmp_path), 2: f"{tmp_path}/a/.."}, ZONES)


def test_a_file_under_no_root_is_an_error(spark, tmp_path, monkeypatch):
    _tenant_files(spark, tmp_path, ("technician",))
    # As if the file system listed a root under another name than it was asked for.
    monkeypatch.setattr("crewlens.sources.registry._qualified", lambda spark, root: root)
    found = Sources.from_tenant_roots(spark, {1: f"{tmp_path}/x/../t1"}, ZONES).table("technician")
    with pytest.raises(Exception, match="no tenant's root holds"):
        found.select("company_id").collect()


def test_a_tenant_opens_its_own_files_alone(spark, tmp_path):
    src = _tenant_files(spark, tmp_path)
    all_ = Sources.from_tenant_roots(spark, {cid: f"{tmp_path}/t{cid}" for cid in ZONES}, ZONES)
    one = all_.for_company(2)
    for name in ("technician", "technician_copy", "employee"):
        assert {f.split(str(tmp_path))[1].split("/")[1] for f in one.table(name).inputFiles()} == {"t2"}
        assert one.table(name).columns == all_.table(name).columns
    assert got(plans.technicians_employees(one)) == got(plans.technicians_employees(src.for_company(2)))
    assert all_.for_company(9).table("technician").count() == 0
    assert one.for_company(1).table("technician").count() == 0


def test_repeated_ids(spark):
    people = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (1, 2)], "id bigint, company_id bigint")
    src = Sources({"technician": people, "customer": people.limit(0), "timesheet_code": people.where("id = 2")}, ZONES)
    assert got(src.repeated_ids()) == [("technician", 1, 1, 2)]
    assert got(src.repeated_ids("customer")) == []


@pytest.fixture
def database(spark, tmp_path):
    name = f"d_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _plan(spark, df):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_tables_in_buckets_are_summed_and_joined_where_they_lie(spark, database):
    src = sources(spark, SF)
    tables = ["job", "job_type", "invoice", "invoice_item", "estimate", "estimate_item", "timesheet", "purchase_order"]
    assert write_buckets(src, database, 8, tables) == {t: t != "job_type" for t in tables}
    stored = Sources.from_catalog(spark, database, ZONES)
    no_sets = Params(as_of=PARAMS.as_of, year_lo=1997, year_hi=1998, min_year=1998, join=JoinTuning(bitmap_bytes=0))
    # Tables that lie by job: no shuffle at all.
    for job in (timesheets.paid_hours_by_job, rollups.purchase_order_total_by_job):
        assert "Exchange" not in _plan(spark, job(stored, no_sets))
        assert got(job(stored, no_sets)) == got(job(src, no_sets))
    # Children by parent: summed and joined as they lie, then one shuffle of the sums by job.
    for job in (rollups.sold_hours_by_job, rollups.installed_estimates_by_job):
        plan = _plan(spark, job(stored, no_sets))
        assert plan.count("Exchange") == 1 == plan.count("Exchange hashpartitioning(job_id") and "SortMergeJoin" in plan
        assert got(job(stored, no_sets)) == got(job(src, no_sets))
    # Items are read twice, and neither time shuffled. Small jobs are sent to the invoices, which stay where they lie too;
    # large ones are joined by job, and what comes of it goes back to the items.
    for params, times in ((no_sets, 0), (replace(no_sets, join=replace(no_sets.join, broadcast_bytes=-1)), 1)):
        plan = _plan(spark, plans.invoiced_items(stored, params))
        assert plan.count("Exchange hashpartitioning(invoice_id") == times
        items = [line for line in plan.split("\n") if "FileScan" in line and "sku_name" in line]
        assert len(items) == 1 and "Bucketed: true" in items[0]
        assert got(plans.invoiced_items(stored, params)) == got(plans.invoiced_items(src, no_sets))


def test_a_table_with_a_hot_key_is_stored_without_buckets(spark, database):
    sheets = sources(spark, SF).table("timesheet").withColumn("job_id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("job_id")))
    sheets = sheets.withColumn("company_id", F.lit(1).cast("bigint"))
    src = Sources({"timesheet": sheets, "job": sheets.limit(0).select("company_id", "id")}, ZONES)
    assert write_buckets(src, database, 8) == {"timesheet": False, "job": True}
    stored = Sources.from_catalog(spark, database, ZONES)
    assert not stored.lie_together("timesheet") and stored.lie_together("job")
    assert got(timesheets.paid_hours_by_job(stored, PARAMS)) == got(timesheets.paid_hours_by_job(src, PARAMS))


def test_ranges_of_time_leave_most_files_unread(spark, tmp_path):
    src = sources(spark, SF)
    write_ranges(src, str(tmp_path), 12, {"job": "completed_on", "appointment": "start"})
    stored = Sources.from_parquet(spark, str(tmp_path), ZONES)
    assert got(stored.table("appointment"), "company_id", "job_id", "start") == got(src.table("appointment"), "company_id", "job_id", "start")
    files = glob.glob(f"{tmp_path}/job/company_id=*/*.parquet")
    year = (dt.datetime(1997, 1, 1), dt.datetime(1998, 1, 1))

    def may_hold(path):
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("completed_on")
        groups = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        return any(g.min < year[1] and g.max >= year[0] for g in groups)

    assert len(files) >= 12 and sum(map(may_hold, files)) <= len(files) / 3
    cut = stored.table("job").where(F.col("completed_on").between(*[F.lit(y) for y in year]))
    assert "PushedFilters: [IsNotNull(completed_on), GreaterThanOrEqual(completed_on" in cut._jdf.queryExecution().executedPlan().toString()
    hit = {os.path.basename(r[0]) for r in cut.select(F.input_file_name()).distinct().collect()}
    assert hit <= {os.path.basename(f) for f in files if may_hold(f)}


def test_one_instant_spreads_over_ranges(spark, tmp_path):
    same = spark.range(20_000).select("id", F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("completed_on"), F.lit(1).cast("bigint").alias("company_id"))
    write_ranges(Sources({"job": same}, ZONES), str(tmp_path), 8, {"job": "completed_on"})
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/job/*/*.parquet")]
    assert sum(sizes) == 20_000 and max(sizes) <= 5000


def test_a_larger_table_is_stored_in_more_ranges(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(layout, "RANGE_BYTES", 20_000)
    day, ddl = dt.datetime(2025, 1, 1), "id BIGINT, completed_on TIMESTAMP_NTZ, company_id BIGINT"
    # Of the second Spark has no size.
    known = spark.range(20_000).select("id", F.timestamp_micros(F.col("id") * 1000).cast("timestamp_ntz").alias("completed_on"), F.lit(1).cast("bigint").alias("company_id"))
    unknown = rows(ddl, [(i, day + dt.timedelta(minutes=i % 500) if i % 9 else None, 1 + i % 2) for i in range(4000)])
    for name, df, count in (("known", known, 16), ("unknown", unknown, 6)):
        write_ranges(Sources({"job": df}, ZONES), f"{tmp_path}/{name}", 2, {"job": "completed_on"})
        sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/{name}/job/*/*.parquet")]
        assert sum(sizes) == df.count() and len(sizes) >= count and max(sizes) <= 2 * sum(sizes) / count
        stored = spark.read.schema(ddl).parquet(f"{tmp_path}/{name}/job")
        assert got(stored) == got(df)


def test_paths_of_tenants_are_decoded_only_where_they_are_spelled_unusually(spark, tmp_path):
    top = f"{tmp_path}/a b+c%20d"
    _tenant_files(spark, top)
    stored = Sources.from_tenant_roots(spark, {cid: f"{top}/t{cid}" for cid in ZONES}, ZONES)
    raw = stored.table("technician")
    case = raw.select("company_id")._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < case.index("StartsWith(") < case.index("UrlCodec.decode")
    spelled = registry._spelled(spark, registry._qualified(spark, f"{top}/t2"))
    usual = F.startswith("_metadata.file_path", F.lit(f"{spelled}/technician/")).alias("usual")
    assert got(raw.select("company_id", usual).distinct()) == [(1, False), (2, True), (3, False)]
    assert got(raw, "company_id", "id") == got(sources(spark, SF).table("technician"), "company_id", "id")


def test_paths_spelled_unusually_are_decoded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "_spelled", lambda spark, root: "elsewhere")
    top = f"{tmp_path}/a b+c%20d"
    _tenant_files(spark, top)
    stored = Sources.from_tenant_roots(spark, {cid: f"{top}/t{cid}" for cid in ZONES}, ZONES)
    assert got(stored.table("technician"), "company_id", "id") == got(sources(spark, SF).table("technician"), "company_id", "id")
