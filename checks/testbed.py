"""The domain tables, derived from the given test tables (see FIXTURES.md, part C).

Each table is one projection: a test table, a filter and named expressions that mean the same in
Spark and in DuckDB. Spark gets a lazy DataFrame, so the work of a query grows with the test data;
the oracle gets the same projection as a SQL text. Rows whose text holds NULLs, blanks and bad clocks
are made on purpose.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crewlens import Params, Sources
from crewlens.sources.schemas import DURATIONS, SUMMARY_HOURS

# Made-up tenants: job id % 3 + 1.
ZONES = {1: "America/Phoenix", 2: "America/New_York", 3: "America/Chicago"}
PARAMS = Params(as_of=dt.date(1998, 7, 1), year_lo=1997, year_hi=1998, min_year=1998)


@dataclass(frozen=True)
class Projection:
    base: str
    columns: dict[str, str]
    where: str | None = None
    per_tenant: bool = False  # one copy of each row per tenant: small shared dimensions


_CLOCK = "CAST((hour(ts) + 11) % 12 + 1 AS STRING) || ':' || lpad(CAST(minute(ts) AS STRING), 2, '0')"
_AMPM = "CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END"
_VALUE = "CAST(value AS DECIMAL(18,2))"
_TEXT_TS = "substr(CAST(ts AS STRING), 1, 10) || 'T' || substr(CAST(ts AS STRING), 12, 8)"
PROJECTIONS: dict[str, Projection] = {
    "job": Projection(
        "orders",
        {
            "company_id": "o_orderkey % 3 + 1",
            "id": "o_orderkey",
            "job_number": "CAST(o_orderkey AS STRING)",
            "job_type_id": "o_orderkey % 25",
            "business_unit_id": "o_custkey % 5",
            "customer_id": "o_custkey",
            "project_id": "o_custkey % 50",
            "sold_by_id": "o_custkey % 100",
            "completed_on": "o_orderdate",
            "job_status": "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Completed' "
            "WHEN o_orderstatus = 'O' THEN 'Scheduled' ELSE 'Canceled' END",
            # Lead parents stay in the tenant of the job.
            "job_generated_lead_source_job_id": "CASE WHEN o_orderkey % 4 = 0 AND o_orderkey > 0 "
            "THEN CAST(FLOOR(o_orderkey / 24) AS BIGINT) * 3 + o_orderkey % 3 END",
            "job_generated_lead_source_employee_id": "CASE WHEN o_orderkey % 4 = 0 AND o_orderkey > 0 "
            "THEN o_custkey % 100 END",
        },
    ),
    "appointment": Projection(
        "lineitem",
        {
            "company_id": "l_orderkey % 3 + 1",
            "job_id": "l_orderkey",
            "start": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_shipdate END",
            "status": "l_linestatus",
        },
    ),
    "job_split": Projection(
        "lineitem",
        {
            "company_id": "l_orderkey % 3 + 1",
            "job_id": "l_orderkey",
            "technician_id": "l_suppkey",
            "split": "CAST(CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS DECIMAL(18,4))",
            "created_on": "l_shipdate",
        },
    ),
    # Line 5 points at employees; some ids match nobody.
    "appointment_assignment": Projection(
        "lineitem",
        {
            "company_id": "l_orderkey % 3 + 1",
            "job_id": "l_orderkey",
            "technician_id": "CASE WHEN l_linenumber = 5 THEN 1000000 + l_suppkey ELSE l_suppkey END",
            "assigned_on": "l_shipdate",
            "active": "l_linestatus = 'F'",
        },
    ),
    "technician": Projection(
        "supplier",
        {
            "id": "s_suppkey",
            "name": "'  ' || s_name || ' '",
            "business_unit_id": "CAST(s_nationkey AS BIGINT)",
            "login_name": "'login' || CAST(s_suppkey AS STRING)",
            "email": "'s' || CAST(s_suppkey AS STRING) || '@x.test'",
            "user_id": "s_suppkey + 5000",
            "active": "s_acctbal > 0",
            "role_id": "s_suppkey % 3",
            "is_managed_tech": "s_suppkey % 2 = 0",
        },
        per_tenant=True,
    ),
    "employee": Projection(
        "customer",
        {
            "id": "1000000 + c_custkey",
            "name": "c_name",
            "business_unit_id": "CAST(c_nationkey AS BIGINT)",
            "login_name": "'emp' || CAST(c_custkey AS STRING)",
            "email": "'c' || CAST(c_custkey AS STRING) || '@x.test'",
            "user_id": "c_custkey + 9000",
            "active": "c_acctbal > 0",
            "role_id": "c_custkey % 3",
        },
        per_tenant=True,
    ),
    "invoice": Projection(
        "orders",
        {
            "company_id": "o_orderkey % 3 + 1",
            "id": "o_orderkey",
            # Some invoices name no job that there is.
            "job_id": "CASE WHEN o_orderkey % 10 = 0 THEN -1 - o_orderkey ELSE o_orderkey END",
            "sub_total": "CAST(o_totalprice AS DECIMAL(18,2))",
        },
    ),
    "invoice_item": Projection(
        "lineitem",
        {
            "company_id": "l_orderkey % 3 + 1",
            "invoice_id": "l_orderkey",
            "sku_name": "' SKU-' || CAST(l_partkey AS STRING)",
            "display_name": "'Part ' || CAST(l_partkey % 500 AS STRING) || ' '",
            "description": "'line ' || CAST(l_linenumber AS STRING) || ' ' || l_returnflag",
            "quantity": "CAST(l_quantity AS DECIMAL(18,4))",
            "price": "CAST(l_extendedprice AS DECIMAL(18,4))",
            "sold_hours": "CAST(CAST(l_quantity AS DECIMAL(8,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4))",
            "active": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_returnflag <> 'R' END",
            "type": "CASE WHEN l_returnflag = 'A' THEN 'Material' WHEN l_returnflag = 'R' THEN 'Service' "
            "WHEN l_linestatus = 'F' THEN 'Equipment' WHEN l_linenumber = 5 THEN NULL ELSE 'PriceModifier' END",
        },
    ),
    "estimate": Projection(
        "orders",
        {
            "company_id": "o_orderkey % 3 + 1",
            "id": "o_orderkey",
            "job_id": "CASE WHEN o_orderkey % 5 = 0 THEN -1 - o_orderkey ELSE o_orderkey END",
            "status_value": "o_custkey % 2",
            "active": "o_orderstatus <> 'P'",
            "sold_on": "CASE WHEN o_custkey % 4 <> 0 THEN o_orderdate END",
            "subtotal": "CAST(o_totalprice AS DECIMAL(18,2))",
        },
    ),
    "estimate_item": Projection(
        "lineitem",
        {
            "company_id": "l_orderkey % 3 + 1",
            "estimate_id": "l_orderkey",
            "total": "CAST(l_extendedprice AS DECIMAL(18,2))",
        },
    ),
    "timesheet": Projection(
        "events",
        {
            "company_id": "CAST(FLOOR(event_id / 2) AS BIGINT) % 3 + 1",
            "id": "event_id",
            "technician_id": "user_id",
            "job_id": "CAST(FLOOR(event_id / 2) AS BIGINT)",
            "created_on": "ts",
            "dispatched_on": "ts",
            "arrived_on": "ts + INTERVAL '10' MINUTE",
            "done_on": "CASE WHEN event_id % 11 = 0 THEN NULL "
            "ELSE ts + INTERVAL '1' SECOND * CAST(FLOOR(value * 60) AS INT) END",
            "active": "event_type <> 'error'",
        },
        where="event_type <> 'signup'",
    ),
    "non_job_timesheets": Projection(
        "events",
        {
            "company_id": "event_id % 3 + 1",
            "id": "event_id",
            "employee_id": "1000000 + user_id",
            "created_on": "ts",
            "started_on": "ts - INTERVAL '5' MINUTE",
            "ended_on": "ts + INTERVAL '1' HOUR",
            "timesheet_code_id": "event_id % 7",
            "active": "event_id % 13 <> 0",
        },
        where="event_type = 'signup'",
    ),
    "timesheet_code": Projection(
        "region",
        {
            "id": "CAST(r_regionkey AS BIGINT)",
            "code": "substr(r_name, 1, 3)",
            "description": "r_name",
            "applicable_employee_type": "'Technician'",
            "type": "CASE WHEN r_regionkey % 2 = 0 THEN 'Paid' ELSE 'Unpaid' END",
        },
        per_tenant=True,
    ),
    # No job has the last type, and the type of some jobs is not there.
    "job_type": Projection(
        "nation",
        {"id": "CAST(CASE WHEN n_nationkey = 24 THEN -1 ELSE n_nationkey END AS BIGINT)", "name": "n_name || '  '"},
        per_tenant=True,
    ),
    "business_unit": Projection(
        "region", {"id": "CAST(r_regionkey AS BIGINT)", "name": "' ' || r_name"}, per_tenant=True
    ),
    "customer": Projection(
        "customer", {"id": "c_custkey", "name": "c_name", "type": "c_mktsegment"}, per_tenant=True
    ),
    # Projects exist for part of the project ids only.
    "project": Projection(
        "part",
        {
            "id": "CASE WHEN p_partkey % 50 = 49 THEN -1 - p_partkey ELSE p_partkey END",
            "number": "CAST(p_partkey + 70000 AS STRING)",
        },
        per_tenant=True,
    ),
    "purchase_order": Projection(
        "lineitem",
        {
            "company_id": "l_orderkey % 3 + 1",
            "job_id": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END",
            "total": "CAST(l_extendedprice AS DECIMAL(18,2))",
        },
    ),
    "return": Projection(
        "lineitem",
        {
            "company_id": "l_orderkey % 3 + 1",
            "job_id": "l_orderkey",
            "return_amount": "CAST(l_extendedprice AS DECIMAL(18,2))",
        },
    ),
    # Bad and NULL clocks; '/' stands where a blank should.
    "tech_dispatch_report": Projection(
        "events",
        {
            "company_id": "event_id % 3 + 1",
            "name": "'Tech ' || CAST(user_id AS STRING)",
            "timesheet_activity": "event_type",
            "timesheet_activity_date": "ts",
            "job_number": "event_id",
            "start_time": f"CASE WHEN event_id % 17 = 0 THEN 'n/a' WHEN event_id % 19 = 0 THEN NULL ELSE {_CLOCK} "
            f"|| CASE WHEN event_id % 3 = 0 THEN '/' ELSE ' ' END || {_AMPM} END",
            "regular_time": f"CAST({_VALUE} * 0.25 AS DECIMAL(18,4))",
            "end_time": "'5:30 PM'",
            "invoice_number": "event_id + 100",
            "job_business_unit": "'BU ' || CAST(user_id % 5 AS STRING)",
            "hourly_rate": "CAST(value AS DECIMAL(18,4))",
            "duration_dec": f"CAST({_VALUE} * 0.75 AS DECIMAL(18,4))",
            "overtime": f"CAST({_VALUE} * 0.05 AS DECIMAL(18,4))",
        },
    ),
    # The end never is a clock.
    "technician_timesheet_summary": Projection(
        "events",
        {
            "company_id": "event_id % 3 + 1",
            "employee_id": "user_id",
            "employee": "'Tech ' || CAST(user_id AS STRING)",
            "date": "ts",
            "start": f"{_CLOCK} || ' ' || {_AMPM}",
            "first_arrival_time": f"CASE WHEN event_id % 6 = 0 THEN NULL ELSE {_CLOCK} || ' ' || {_AMPM} END",
            "end": "'13:00 PM'",
            **{
                name: f"CASE WHEN event_id % {i % 5 + 3} = 0 THEN NULL "
                f"ELSE CAST(event_id % {i + 7} AS STRING) || 'h 15m' END"
                for i, name in enumerate(DURATIONS)
            },
            **{name: f"CAST(FLOOR(value) + {i} AS DECIMAL(18,2))" for i, name in enumerate(SUMMARY_HOURS)},
            "payroll_id": "'P' || CAST(user_id AS STRING)",
        },
    ),
    # The two instants come as text in several forms.
    "gross_pay_items": Projection(
        "events",
        {
            "company_id": "event_id % 3 + 1",
            "id": "event_id",
            "activity": "event_type",
            "activity_code": "substr(event_type, 1, 2)",
            "activity_code_id": "event_id % 9",
            "amount": _VALUE,
            "amount_adjustment": f"CASE WHEN event_id % 4 = 0 THEN NULL ELSE {_VALUE} END",
            "budget_code_id": "event_id % 12",
            "business_unit_name": "'BU ' || CAST(user_id % 5 AS STRING)",
            "created_on": "ts",
            "customer_id": "user_id * 3",
            "customer_name": "'Customer ' || CAST(user_id * 3 AS STRING)",
            "date": "ts",
            "employee_id": "user_id",
            "employee_payroll_id": "'P' || CAST(user_id AS STRING)",
            "employee_type": "CASE WHEN user_id % 2 = 0 THEN 'Technician' ELSE 'Employee' END",
            "ended_on": "substr(CAST(ts AS STRING), 1, 19)",
            "gross_pay_item_type": "event_type",
            "invoice_id": "event_id + 100",
            "invoice_item_id": "event_id * 10",
            "invoice_number": "CAST(event_id + 100 AS STRING)",
            "is_prevailing_wage_job": "event_id % 2 = 0",
            "job_id": "event_id",
            "job_number": "CAST(event_id AS STRING)",
            "job_type_name": "'Type ' || CAST(event_id % 25 AS STRING)",
            "labor_type_code": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'L' END",
            "labor_type_id": "event_id % 3",
            "location_address": "CAST(user_id AS STRING) || ' Main St'",
            "location_id": "user_id + 700",
            "location_name": "'Site ' || CAST(user_id AS STRING)",
            "location_zip": "lpad(CAST(user_id AS STRING), 5, '0')",
            "memo": "props",
            "modified_on": "ts + INTERVAL '1' HOUR",
            "paid_duration_hours": f"CAST({_VALUE} * 0.25 AS DECIMAL(18,4))",
            "paid_time_type": "CASE WHEN event_id % 2 = 0 THEN 'Working' ELSE 'Idle' END",
            "payout_business_unit_name": "'BU ' || CAST(user_id % 4 AS STRING)",
            "payroll_id": "CAST(event_id % 52 AS STRING)",
            "project_id": "event_id % 50",
            "project_number": "CAST(event_id % 50 + 70000 AS STRING)",
            "source_entity_id": "event_id + 5",
            "started_on": f"CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN {_TEXT_TS} || 'Z' "
            f"WHEN event_id % 5 = 2 THEN {_TEXT_TS} || '.5Z' "
            "WHEN event_id % 5 = 3 THEN substr(CAST(ts AS STRING), 1, 19) ELSE 'n/a' END",
            "tax_zone_name": "'Tax ' || CAST(user_id % 6 AS STRING)",
            "zone_name": "'Zone ' || CAST(user_id % 8 AS STRING)",
        },
    ),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given test tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain_table(spark: SparkSession, sf_dir: str, name: str, base: DataFrame | None = None) -> DataFrame:
    """One domain table as a lazy projection of a test table (``base``, if it is open already)."""
    p = PROJECTIONS[name]
    df = read(spark, sf_dir, p.base) if base is None else base
    if p.where:
        df = df.where(p.where)
    if p.per_tenant:
        ids = F.array(*[F.lit(cid).cast("bigint") for cid in ZONES])
        df = df.withColumn("company_id", F.explode(ids))
    columns = {"company_id": "company_id", **p.columns}
    return df.selectExpr(*[f"{expr} AS `{name}`" for name, expr in columns.items()])


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The domain tables of one scale factor. Each test table is opened once, when first read."""
    base = cache(lambda name: read(spark, sf_dir, name))

    def opener(name: str):
        return lambda: domain_table(spark, sf_dir, name, base(PROJECTIONS[name].base))

    return Sources({name: opener(name) for name in PROJECTIONS}, ZONES)


def _cte(name: str) -> str:
    p = PROJECTIONS[name]
    columns = {"company_id": "company_id", **p.columns}
    source = f"{p.base} CROSS JOIN d_tenant" if p.per_tenant else p.base
    where = f" WHERE {p.where}" if p.where else ""
    selected = ", ".join(f'{expr} AS "{name}"' for name, expr in columns.items())
    return f"d_{name} AS (SELECT {selected} FROM {source}{where})"


def oracle(sql: str) -> str:
    """A SQL text over ``d_<table>`` names, with the projections it uses put in front."""
    tenants = " UNION ALL ".join(
        f"SELECT CAST({cid} AS BIGINT) AS company_id, '{tz}' AS tz" for cid, tz in ZONES.items()
    )
    used = [n for n in PROJECTIONS if re.search(rf"\bd_{re.escape(n)}\b", sql)]
    ctes = [f"d_tenant AS ({tenants})", *[_cte(n) for n in used]]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {', '.join(ctes)}, {body[5:]}"
    return f"WITH {', '.join(ctes)} {body}"
