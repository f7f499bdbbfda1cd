"""The jobs on hand-made rows."""

import datetime as dt
import re
from dataclasses import replace
from decimal import Decimal

import pytest
from conftest import SF, got
from pyspark.sql import functions as F

from checks.testbed import PARAMS, ZONES, sources
from crewlens import Params, Sources, display, plans, publish
from crewlens.params import JoinTuning
from crewlens.plans import JOBS, rollups, technicians, timesheets
from crewlens.plans.invoiced import invoiced_lines
from crewlens.plans.scope import Scope
from crewlens.plans.sales_master import recent_jobs, sales_master_rows
from crewlens.sources import SCHEMAS

TODAY = dt.date(2025, 6, 15)
P = Params(as_of=TODAY)
SPLIT = JoinTuning(broadcast_bytes=-1, buckets=64)


def day(n):
    return dt.datetime(2025, 6, 15) + dt.timedelta(days=n)


@pytest.fixture
def src(spark):
    """Sources out of {table: [dict, ...]}; columns not given are NULL, the tenant is 1."""

    def build(**tables):
        opened = {}
        for name, ddl in SCHEMAS.items():
            # "return" is a Python keyword.
            data = tables.get(name, tables.get(f"{name}_", []))
            opened[name] = spark.createDataFrame(
                [{"company_id": 1, **row} for row in data], f"company_id BIGINT, {ddl}"
            )
        return Sources(opened, ZONES)

    return build


# wip_appointments


def wip(src, starts, params=P, **extra):
    found = plans.wip_appointments(src(appointment=[{"job_id": 1, "start": s, **extra} for s in starts]), params)
    columns = ["first_appointment", "total_appointments", "start_appointment", "next_appointment", "most_recent_appointment"]
    return got(found, *columns)


def test_past_appointments_only(src):
    assert wip(src, [day(-3), day(-1)]) == [(day(-3), 2, day(-1), day(-1), day(-1))]


def test_one_future_appointment_after_a_past_one(src):
    # The past one is next, before the only future one.
    assert wip(src, [day(-1), day(2)]) == [(day(-1), 2, day(2), day(-1), day(-1))]


def test_four_future_appointments_count_as_two(src):
    assert wip(src, [day(i) for i in range(4)]) == [(None, 2, day(0), day(1), None)]


def test_one_future_appointment(src):
    assert wip(src, [day(1)]) == [(None, 1, day(1), day(1), None)]


def test_appointments_without_start_are_left_out(src):
    assert wip(src, [None, None]) == []


def test_today_counts_as_future(src):
    before_midnight = day(0) - dt.timedelta(seconds=1)
    assert wip(src, [before_midnight, day(0)])[0][:3] == (before_midnight, 2, day(0))


def test_null_job_gives_a_row_per_half(src):
    rows = [{"job_id": None, "start": day(-1)}, {"job_id": None, "start": day(1)}]
    found = got(plans.wip_appointments(src(appointment=rows), P), "job_id", "total_appointments")
    assert found == [(None, 1), (None, 1)]


def test_statuses_can_be_left_out(src):
    assert wip(src, [day(-1)], status="Canceled") != []
    assert wip(src, [day(-1)], Params(as_of=TODAY, exclude_status=("Canceled",)), status="Canceled") == []


# job_technicians


def people(*names):
    return [{"id": i, "name": n} for i, n in enumerate(names, 1)]


def assigned(tech, n, active=True, job=1):
    return {"job_id": job, "technician_id": tech, "assigned_on": None if n is None else day(n), "active": active}


def share(tech, split, n=0, job=1):
    return {
        "job_id": job,
        "technician_id": tech,
        "split": None if split is None else Decimal(split),
        "created_on": None if n is None else day(n),
    }


CASES = {
    "splits only": ([], [share(1, 20), share(2, 80)], ("A, B", "B")),
    "inactive assignment": ([assigned(1, 0, active=False), assigned(1, 0, active=None)], [share(2, 1)], ("B", "B")),
    "first assigned holds the largest split": ([assigned(1, 0), assigned(2, 1)], [share(1, 50), share(2, 50)], ("A, B", "A")),
    "first assigned has a smaller split": ([assigned(1, 0)], [share(1, 20), share(2, 80)], ("A", "B")),
    "no splits": ([assigned(2, 0), assigned(1, 1)], [], ("A, B", "B")),
    "unknown technician": ([assigned(9, 0)], [], ("", "")),
    "unknown first, known split": ([assigned(9, 0)], [share(1, 5)], ("", "A")),
    "names are trimmed and distinct": ([assigned(1, 1), assigned(3, 0)], [], ("A", "A")),
    "no assignment time comes first": ([assigned(1, 0), assigned(2, None)], [], ("A, B", "B")),
    "equal splits, earlier one": ([], [share(1, 5, 3), share(2, 5, 2), share(3, 4, 1)], ("A, B", "B")),
    "equal splits, no time": ([], [share(1, 5, 3), share(2, 5, None)], ("A, B", "B")),
    "no split comes last": ([], [share(1, None, 0), share(2, 1, 3)], ("A, B", "B")),
    "employees name assignments only": ([assigned(100, 0)], [share(100, 0)], ("Emp", "Emp")),
    "employees do not name splits": ([], [share(100, 5)], ("", "")),
    "repeated pairs": ([assigned(1, 0)] * 3 + [assigned(2, 1)], [share(2, 5)] * 3 + [share(2, 9)], ("A, B", "B")),
    "technician missing on both": ([assigned(None, 0)], [share(None, 7)], ("", "")),
}


@pytest.mark.parametrize("tuning", [JoinTuning(), SPLIT], ids=["plain", "split"])
@pytest.mark.parametrize("case", CASES)
def test_job_technicians(src, case, tuning):
    assignments, splits, want = CASES[case]
    tables = src(
        technician=people("A", "B", " A "),
        employee=[{"id": 100, "name": "Emp"}],
        appointment_assignment=assignments,
        job_split=splits,
    )
    found = plans.job_technicians(tables, Params(join=tuning))
    assert got(found, "assigned_technicians", "primary_technician") == [want]


def test_job_technicians_null_job_gives_a_row_per_side(src):
    tables = src(
        technician=people("A", "B"),
        appointment_assignment=[assigned(1, 0, job=None)],
        job_split=[share(1, 5, job=None), share(2, 9, job=None)],
    )
    assert got(plans.job_technicians(tables), "job_id", "assigned_technicians", "primary_technician") == [
        (None, "A", "A"),
        (None, "A, B", "B"),
    ]
    # A NULL job finds no split of its technician.
    assert got(technicians.assigned_technicians(tables), "primary_technician2", "pt_appt_split") == [("A", None)]


def test_person_in_both_halves_has_two_names(src):
    tables = src(
        technician=[{"id": 1, "name": "T"}],
        employee=[{"id": 1, "name": "E"}],
        appointment_assignment=[assigned(1, 0)],
        job_split=[share(1, 3)],
    )
    assert got(plans.job_technicians(tables), "assigned_technicians", "primary_technician") == [("E, T", "E")]
    assert got(technicians.split_technicians(tables), "assigned_technicians_split") == [("T",)]


# The other jobs


def test_directory_keeps_both_halves(src):
    tables = src(
        technician=[{"id": 1, "name": "T", "business_unit_id": 3, "is_managed_tech": True}],
        employee=[{"id": 1, "name": "E", "business_unit_id": 4}],
    )
    found = plans.technicians_employees(tables)
    assert got(found, "emp_type", "id", "business_unit_id", "is_managed_tech") == [
        ("Employee", 1, 4, None),
        ("Technician", 1, 3, True),
    ]
    bare = Sources({"technician": tables.table("technician"), "employee": tables.table("employee").drop("business_unit_id")}, ZONES)
    assert got(plans.technicians_employees(bare).where("emp_type = 'Employee'"), "business_unit_id") == [(None,)]


@pytest.mark.parametrize("tuning", [JoinTuning(), SPLIT], ids=["plain", "split"])
def test_timestamp_base(src, tuning):
    noon = dt.datetime(2025, 1, 1, 12)
    tables = src(
        technician=[{"id": 1, "name": "T"}],
        employee=[{"id": 1, "name": "E"}, {"id": 2, "name": "F"}],
        timesheet=[{"id": 10, "technician_id": 1, "job_id": 5, "done_on": noon, "active": True}, {"id": 11, "active": None}],
        non_job_timesheets=[{"id": 20, "employee_id": 2, "created_on": noon, "timesheet_code_id": 3, "active": True}],
        timesheet_code=[{"id": 3, "code": "MTG"}],
    )
    found = plans.timestamp_base(tables, Params(join=tuning))
    assert len(found.columns) == 18
    # Phoenix is seven hours behind; the arrival of a non-job entry is its creation.
    local = dt.datetime(2025, 1, 1, 5)
    assert got(found, "id", "emp_name", "source", "job_id", "arrival_ts", "end_ts", "code") == [
        (10, "E", "Job", 5, None, local, None),
        (10, "T", "Job", 5, None, local, None),
        (20, "F", "Non-Job", None, local, None, "MTG"),
    ]


def test_invoiced_items(src):
    # 2025 began at seven in UTC in Phoenix.
    edge = dt.datetime(2025, 1, 1, 7)
    jobs = [
        {"id": 1, "job_number": "1", "job_status": "Completed", "completed_on": edge, "job_type_id": 4},
        {"id": 2, "job_number": "2", "job_status": "Completed", "completed_on": edge - dt.timedelta(seconds=1)},
        {"id": 3, "job_number": "3", "job_status": "Canceled", "completed_on": edge},
        {"id": 4, "job_number": "4", "job_status": None, "completed_on": edge},
        {"id": 5, "job_number": "5", "job_status": "Completed", "completed_on": edge},
    ]
    items = [
        {"invoice_id": 1, "type": "Service", "sold_hours": Decimal("1.5"), "active": False, "price": Decimal("2.345")},
        {"invoice_id": 1, "type": "Material", "sold_hours": Decimal("2.25"), "active": True},
        {"invoice_id": 1, "type": None, "sold_hours": Decimal("4"), "active": None},
        {"invoice_id": 6, "type": "Service", "sku_name": " S\t", "sold_hours": None, "active": True},
        *[{"invoice_id": i, "type": "Service"} for i in (2, 3, 4)],
    ]
    tables = src(
        job=jobs,
        job_type=[{"id": 4, "name": " Repair "}],
        invoice=[{"id": i, "job_id": i} for i in range(1, 5)] + [{"id": 6, "job_id": 1, "sub_total": Decimal("9.10")}],
        invoice_item=items,
    )
    for tuning in (JoinTuning(), SPLIT):
        found = plans.invoiced_items(tables, Params(join=tuning))
        columns = ["job_number", "job_type", "completion_date", "item_code", "item_price", "invoice_subtotal", "sold_hours"]
        d, h = dt.date(2025, 1, 1), Decimal("2.25")
        assert got(found, *columns) == [
            ("1", "Repair", d, None, Decimal("2.35"), Decimal("0.00"), h),
            ("1", "Repair", d, "S", None, Decimal("9.10"), h),
        ]


def test_rollups_keep_the_two_notions_of_sold(src):
    sold = {"sold_on": day(0), "active": True}
    tables = src(
        job=[{"id": 1}, {"id": 2, "job_generated_lead_source_job_id": 1}, {"id": 10, "job_generated_lead_source_job_id": 1}],
        estimate=[
            {"id": 1, "job_id": 2, "status_value": 1, "active": True, "subtotal": Decimal(5)},
            {"id": 2, "job_id": 2, "status_value": 0, "subtotal": Decimal(7), **sold},
            {"id": 3, "job_id": 10, "status_value": 1, "subtotal": Decimal(11), **sold},
            {"id": 4, "job_id": 10, "status_value": 1, "active": None, "subtotal": Decimal(13)},
        ],
        estimate_item=[{"estimate_id": 3, "total": Decimal(1)}, {"estimate_id": 3, "total": Decimal(2)}, {"estimate_id": 2, "total": Decimal(4)}],
    )
    assert got(rollups.sold_estimates_by_job(tables), "job_id", "estimates", "subtotal") == [(10, 1, 11), (2, 1, 7)]
    assert got(rollups.installed_estimates_by_job(tables), "job_id", "estimate_items_total") == [(10, 3), (2, None)]
    assert got(rollups.lead_sales_by_parent(tables), "parent_job_id", "sub_total_lead") == [(1, 16)]
    assert got(rollups.lead_ids_by_parent(tables), "parent_job_id", "lead_created") == [(1, "2, 10")]


def test_paid_hours_count_boundaries_and_inactive_entries(src):
    t = dt.datetime(2025, 1, 1, 10, 0, 59)
    entry = {"job_id": 1, "dispatched_on": t}
    second = dt.timedelta(seconds=1)
    tables = src(timesheet=[{**entry, "done_on": t + second, "active": False}, {**entry, "done_on": t + 60 * second}, entry])
    assert got(timesheets.paid_hours_by_job(tables), "total_minutes", "total_paid_time") == [(2, Decimal("0.03"))]


@pytest.mark.parametrize("tuning", [JoinTuning(), SPLIT], ids=["plain", "split"])
def test_sales_master(src, tuning):
    # Local years: 2025 began at seven in UTC.
    before, after = dt.datetime(2025, 1, 1, 6, 59), dt.datetime(2025, 1, 1, 7)
    tables = src(
        job=[{"id": 1, "job_number": "1", "customer_id": 5}, {"id": 2, "job_number": "2"}, {"id": 3}],
        customer=[{"id": 5, "name": " C ", "type": "Home"}],
        appointment=[{"job_id": 1, "start": after}, {"job_id": 1, "start": after + dt.timedelta(days=1)}, {"job_id": 2, "start": before}],
        invoice=[{"id": 1, "job_id": 1, "sub_total": Decimal("3.5")}],
    )
    params = Params(as_of=TODAY, join=tuning)
    found = plans.sales_master_tracker(tables, params)
    assert len(found.columns) == 26
    columns = ["job_number", "customer_name", "job_subtotal", "assigned_technicians", "lead_created", "primary_technician"]
    assert got(found, *columns) == [("1", "C", Decimal("3.50"), "", "", None)]
    fixed = plans.sales_master_tracker(tables, Params(as_of=TODAY, fix_last_appt=True, join=tuning))
    assert got(found, "first_appt_date", "last_appt_date") == [(dt.date(2025, 1, 1),) * 2]
    assert got(fixed, "first_appt_date", "last_appt_date") == [(dt.date(2025, 1, 1), dt.date(2025, 1, 2))]


# All jobs


@pytest.mark.parametrize("name", sorted(JOBS))
def test_split_joins_change_no_row(spark, name):
    src = sources(spark, SF)
    split = Params(as_of=PARAMS.as_of, year_lo=1997, year_hi=1998, min_year=1998, join=SPLIT)
    assert got(JOBS[name](src, split)) == got(JOBS[name](src, PARAMS))


@pytest.mark.parametrize("name", ["wip_appointments", "job_technicians", "sales_master_tracker"])
def test_one_row_per_job(spark, name):
    df = JOBS[name](sources(spark, SF), PARAMS)
    key = "invoice_number" if name == "sales_master_tracker" else "job_id"
    assert df.count() == df.select("company_id", key).distinct().count()


@pytest.mark.parametrize("name", sorted(JOBS))
def test_tenants_never_mix(spark, name):
    src = sources(spark, SF)
    whole, alone = JOBS[name](src, PARAMS), JOBS[name](src.for_company(2), PARAMS)
    assert got(alone) == got(whole.where("company_id = 2")) != []


def test_input_partitions_change_nothing(spark):
    src = sources(spark, SF)
    names = ["job_split", "appointment_assignment", "technician", "employee"]
    shuffled = Sources({n: src.table(n).repartition(5, F.rand(7)) for n in names}, ZONES)
    assert got(plans.job_technicians(shuffled, PARAMS)) == got(plans.job_technicians(src, PARAMS))


def test_ids_are_unique(spark):
    # Collapsing the lead lookup and dropping unused dimension joins rest on this.
    src = sources(spark, SF)
    for table in ("job", "technician", "customer", "project", "job_type", "business_unit", "estimate", "invoice"):
        df = src.table(table)
        assert df.count() == df.select("company_id", "id").distinct().count(), table


# Sources, labels and publishing


def test_session_zone_must_be_utc(spark):
    src = sources(spark, SF)
    spark.conf.set("spark.sql.session.timeZone", "America/Phoenix")
    try:
        with pytest.raises(ValueError):
            src.table("job")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_partitioned_and_per_tenant_layouts(spark, tmp_path):
    src = sources(spark, SF)
    for name in ("technician", "employee"):
        df = src.table(name)
        if name == "employee":
            df = df.drop("business_unit_id")
        df.write.partitionBy("company_id").parquet(f"{tmp_path}/all/{name}")
        for cid in ZONES:
            df.where(F.col("company_id") == cid).drop("company_id").write.parquet(f"{tmp_path}/t{cid}/{name}")
    one = Sources.from_parquet(spark, f"{tmp_path}/all", ZONES)
    many = Sources.from_tenant_roots(spark, {cid: f"{tmp_path}/t{cid}" for cid in ZONES}, ZONES)
    want = got(plans.technicians_employees(src).withColumn(
        "business_unit_id", F.when(F.col("emp_type") == "Technician", F.col("business_unit_id"))
    ))
    assert got(plans.technicians_employees(one)) == want
    assert got(plans.technicians_employees(many)) == want
    plan = one.for_company(2).table("technician")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(company_id" in plan
    with pytest.raises(KeyError):
        one.table("nothing")


def test_labels_cover_all_columns(spark):
    src = sources(spark, SF)
    for labels, job in (
        (display.INVOICED_ITEMS, plans.invoiced_items),
        (display.SALES_MASTER_TRACKER, plans.sales_master_tracker),
        (display.TECH_DISPATCH_REPORT, plans.tech_dispatch_report),
        (display.TECHNICIAN_TIMESHEET_SUMMARY, plans.technician_timesheet_summary),
    ):
        assert ["company_id", *labels.values()] == job(src, PARAMS).columns


def test_reports_are_sorted(spark):
    src = sources(spark, SF)
    dates = [r[0] for r in display.invoiced_items(src, PARAMS).select("`Completion Date`").collect()]
    # Sorted on the instant; tenants' local days can differ by one.
    assert all(a <= b + dt.timedelta(days=1) for a, b in zip(dates, dates[1:]))
    rows = display.tech_dispatch_report(src, PARAMS).select("`Timesheet Activity Date`", "Name", "`Start Time`").collect()
    keys = [(r[0], r[1], r[2] is not None, r[2] or "") for r in rows]
    assert keys == sorted(keys)


def test_all_sorted_reports_are_in_order(spark):
    """Rows by the published key, then by ids; NULLs come first."""
    src = sources(spark, SF)

    def key(row):
        return [(v is not None, v if v is not None else 0) for v in row]

    hidden = invoiced_lines(src, PARAMS)
    by_job = {(r[0], r[1]): r[2] for r in hidden.select("company_id", "job_number", "completed_on").collect()}
    lines = display.invoiced_items(src, PARAMS).select("company_id", "`Job #`").collect()
    starts = {(r[0], r[1]): r[2] for r in sales_master_rows(src, PARAMS).select("company_id", "invoice_number", "first_appointment").collect()}
    master = display.sales_master_tracker(src, PARAMS).select("company_id", "`Invoice #`").collect()
    for found in (
        [(by_job[tuple(r)], int(r[1])) for r in lines],
        [(starts[tuple(r)], r[1], r[0]) for r in master],
        display.timestamp_base(src, PARAMS).select("source", "emp_name", "id", "company_id").collect(),
        display.wip_appointments(src, PARAMS).select("job_id", "company_id").collect(),
        display.tech_dispatch_report(src, PARAMS).select("`Timesheet Activity Date`", "Name", "`Start Time`", "`Job Number`").collect(),
    ):
        keys = [key(r) for r in found]
        assert len(keys) > 1 and keys == sorted(keys)


def test_publishing_one_tenant_keeps_the_others(spark):
    src, table = sources(spark, SF), "published_people"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    try:
        publish.write_table(spark, plans.technicians_employees(src), table)
        before = got(spark.table(table))
        one = plans.technicians_employees(src.for_company(2)).withColumn("name", F.lit("new"))
        publish.write_table(spark, one, table, "Second")
        after = spark.table(table)
        assert got(after.where("company_id <> 2")) == [r for r in before if r[after.columns.index("company_id")] != 2]
        assert [r[0] for r in after.where("company_id = 2").select("name").distinct().collect()] == ["new"]
        with pytest.raises(ValueError):
            publish.write_table(spark, one.drop("name"), table)
        publish.write_table(spark, one, table, replace_all=True)
        assert spark.table(table).select("company_id").distinct().count() == 1
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_job_technicians_sorts_no_pairs(spark):
    src = sources(spark, SF)
    plan = technicians._pairs(technicians._facts(src, True), True)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    split = technicians.split_technicians(src, PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    assert "assigned_on" not in split.split("is_assignment")[0]


def test_recent_jobs_reach_the_scan_and_hold_all_that_pass(spark, tmp_path):
    src = sources(spark, SF)
    recent = recent_jobs(src, PARAMS)
    keys = {tuple(r) for r in recent.select("company_id", "job_id").collect()}
    master = plans.sales_master_tracker(src, PARAMS).select("company_id", "invoice_number").collect()
    assert {tuple(r) for r in master} <= keys
    src.table("appointment").write.partitionBy("company_id").parquet(f"{tmp_path}/appointment")
    stored = recent_jobs(Sources.from_parquet(spark, str(tmp_path), ZONES), PARAMS)
    assert {tuple(r) for r in stored.select("company_id", "job_id").collect()} == keys
    assert "GreaterThanOrEqual(start" in stored._jdf.queryExecution().executedPlan().toString()


def test_facts_are_shuffled_by_their_rollup_alone(spark):
    """With a scope a fact is cut at its scan by a set that is sent, and shuffled once, summed, by job."""
    src = sources(spark, SF)
    scope = Scope(recent_jobs(src, PARAMS), PARAMS)
    for rollup in (rollups.invoice_total_by_job, rollups.sold_estimates_by_job, timesheets.paid_hours_by_job):
        plan = rollup(src, PARAMS, scope)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert plan.count("Exchange hashpartitioning(job_id") == 1
        assert plan.count("Exchange hashpartitioning(__range") == plan.count("Exchange hashpartitioning") - 1 == 2
    split = plans.sales_master_tracker(src, Params(as_of=PARAMS.as_of, min_year=1998, join=JoinTuning(broadcast_bytes=-1)))
    master = plans.sales_master_tracker(src, PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "left_semi" not in split._jdf.queryExecution().optimizedPlan().toString() and "SortMergeJoin" not in master


def test_hours_are_summed_per_invoice_before_they_meet_a_job(spark):
    plan = plans.invoiced_items(sources(spark, SF), PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    summed = [line for line in plan.splitlines() if "sum(sold_hours" in line]
    assert len(summed) == 2 and "invoice_id" in summed[1] and "job_id" not in summed[1]


def test_views_and_tables(spark):
    src = sources(spark, SF)
    views = publish.register_all(src, PARAMS)
    assert set(views) == {f"vw_{name}" for name in JOBS}
    n = spark.sql("SELECT count(*) FROM vw_technicians_employees WHERE emp_type = 'Technician'").first()[0]
    assert n == src.table("technician").count()
    table = "published_wip"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    publish.write_table(spark, views["vw_wip_appointments"], table, "Appointments, the customer's too")
    try:
        assert got(spark.table(table), *views["vw_wip_appointments"].columns) == got(views["vw_wip_appointments"])
        described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        assert described["Comment"] == "Appointments, the customer's too"
        assert len(spark.sql(f"SHOW PARTITIONS {table}").collect()) == 3
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_pairs_of_jobs_and_technicians_are_made_once_and_dealt_by_job_once(spark):
    def exchanges(params, **how):
        plan = plans.job_technicians(sources(spark, SF), params, **how)._jdf.queryExecution().executedPlan().toString()
        by = [re.sub(r"#\d+L?", "", e) for e in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
        return [e for e in by if e.startswith("job_id")]

    split = replace(PARAMS, join=JoinTuning(broadcast_bytes=-1, buckets=64))
    # Counting the technicians' rows makes no pairs.
    assert sorted(exchanges(split, null_jobs=False)) == ["job_id, company_id", "job_id, technician_id, company_id"]
    # Lists are made after the shuffle by job alone, not before it too.
    plan = plans.job_technicians(sources(spark, SF), PARAMS, null_jobs=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_collect_list") < plan.index("REPARTITION_BY_COL")
