"""Every job and operator as a query over the given test tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.testbed import PARAMS, ZONES, domain_table, read, sources
from crewlens import Params, Sources, display, functions, operators, plans
from crewlens.params import JoinTuning
from crewlens.plans import appointments, rollups, technicians, timesheets
from crewlens.publish import publish
from crewlens.sources import write_buckets, write_ranges
from crewlens.sources.layout import TIMES

Query = Callable[[SparkSession, str], DataFrame]

# Forces the split join on data of any size.
SPLIT = JoinTuning(broadcast_bytes=-1, buckets=64)
SPLIT_PARAMS = replace(PARAMS, join=SPLIT)
# Sets of ids that fill up (many ids share a bit), and none at all: facts are cut by joins alone.
FULL_SETS = replace(PARAMS, join=JoinTuning(bitmap_bytes=4096))
NO_SETS = replace(PARAMS, join=JoinTuning(bitmap_bytes=0))


def _job(fn: Callable[[Sources, Params], DataFrame], params: Params = PARAMS) -> Query:
    return lambda spark, sf_dir: fn(sources(spark, sf_dir), params)


def _stored(spark: SparkSession) -> str:
    """A new folder for tables that a query writes first: in the shared one, if the cluster names it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared.rstrip('/')}/readers-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="readers-")


PEOPLE_TABLES = ("technician", "employee")
INVOICED_TABLES = ("job", "job_type", "invoice", "invoice_item")


def _partitioned(job: Callable[[Sources, Params], DataFrame], tables: tuple[str, ...]) -> Query:
    """A job, read from one partitioned dataset per table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, src = _stored(spark), sources(spark, sf_dir)
        for name in tables:
            src.table(name).write.mode("overwrite").partitionBy("company_id").parquet(f"{root}/{name}")
        return job(Sources.from_parquet(spark, root, ZONES), PARAMS)

    return query


def _tenant_roots(job: Callable[[Sources, Params], DataFrame], tables: tuple[str, ...]) -> Query:
    """A job, read from one directory of tables per tenant."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, src = _stored(spark), sources(spark, sf_dir)
        for name in tables:
            for cid in ZONES:
                tenant = src.for_company(cid).table(name).drop("company_id")
                tenant.write.mode("overwrite").parquet(f"{root}/tenant {cid}/{name}")
        roots = {cid: f"{root}/.//tenant {cid}/" for cid in ZONES}
        return job(Sources.from_tenant_roots(spark, roots, ZONES), PARAMS)

    return query


def _in_ranges(job: Callable[[Sources, Params], DataFrame], tables: tuple[str, ...]) -> Query:
    """A job over tables stored in ranges of time."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _stored(spark)
        times = {name: TIMES.get(name, "company_id") for name in tables}
        write_ranges(sources(spark, sf_dir), root, 6, times)
        return job(Sources.from_parquet(spark, root, ZONES), PARAMS)

    return query


def _in_buckets(job: Callable[[Sources, Params], DataFrame], tables: tuple[str, ...]) -> Query:
    """A job over tables of the catalog, in buckets by key."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        database = f"buckets_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {database} LOCATION '{_stored(spark)}'")
        write_buckets(sources(spark, sf_dir), database, 8, tables)
        return job(Sources.from_catalog(spark, database, ZONES), PARAMS)

    return query


def published_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published view, after a run for two tenants in which one of them has lost its rows."""
    name, root, src = f"default.people_{uuid.uuid4().hex}", _stored(spark), sources(spark, sf_dir)
    publish(plans.technicians_employees(src, PARAMS), name, root, description="People")
    later = plans.technicians_employees(src, PARAMS).where("company_id = 1 AND emp_type = 'Employee'")
    publish(later, name, root, description="People", tenants=[1, 2])
    return spark.newSession().table(name)


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that stand more than once, where every seventh technician's row is there twice and every fourteenth's thrice."""
    technicians = domain_table(spark, sf_dir, "technician")
    again = technicians.where("id % 7 = 0").unionByName(technicians.where("id % 14 = 0"))
    return Sources({"technician": technicians.unionByName(again), "job": domain_table(spark, sf_dir, "job")}, ZONES).repeated_ids()


def _lookup(tuning: JoinTuning) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
        parts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
        return operators.lookup_join(lines, parts, ["l_partkey"], tuning=tuning)

    return query


def lookup_join_split_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    people = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"), "s_name")
    return operators.lookup_join(events, people, ["user_id"], "inner", tuning=SPLIT)


def lookup_join_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["company_id", "job_id", "technician_id"]
    splits = domain_table(spark, sf_dir, "job_split").select(*keys, "split")
    assigned = domain_table(spark, sf_dir, "appointment_assignment")
    counts = operators.rollup(assigned, keys, {"assignments": F.count(F.lit(1))}, where=F.col("active"))
    return operators.lookup_join(splits, counts, keys, tuning=PARAMS.join)


def first_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pick with a descending DOUBLE that is NaN, NULL or a number."""
    price = F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).when(F.col("l_linenumber") != 5, F.col("l_extendedprice"))
    lines = read(spark, sf_dir, "lineitem").withColumn("price", price)
    order = [("price", "desc"), ("l_partkey", "asc"), ("l_suppkey", "asc")]
    return operators.first_per_group(lines, ["l_orderkey"], order, ["l_partkey", "l_suppkey"])


def hot_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.rollup(read(spark, sf_dir, "events"), ["user_id"], {"events": F.count(F.lit(1))})


def merge_on_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").withColumnRenamed("l_suppkey", "person_id")
    events = read(spark, sf_dir, "events").withColumnRenamed("user_id", "person_id")
    sales = operators.rollup(lines, ["person_id"], {"sales": F.count(F.lit(1))})
    clicks = operators.rollup(events, ["person_id"], {"events": F.count(F.lit(1))})
    return operators.merge_on_key(sales, clicks, ["person_id"])


def id_bitmap_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the invoices of one day's jobs: cut at the scan by two sets of ids, then joined."""
    jobs = domain_table(spark, sf_dir, "job").where("job_status = 'Scheduled'").select("company_id", F.col("id").alias("job_id"))
    invoices = operators.IdSet(jobs, "job_id", PARAMS.join).cut(domain_table(spark, sf_dir, "invoice"))
    invoices = invoices.select("company_id", F.col("id").alias("invoice_id"), "job_id")
    items = operators.IdSet(invoices, "invoice_id", PARAMS.join).cut(domain_table(spark, sf_dir, "invoice_item"))
    return items.select("company_id", "invoice_id", "sku_name").join(invoices.join(jobs, ["job_id", "company_id"]), ["invoice_id", "company_id"])


def id_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many ids the bitmaps of each table's keys hold, and in how many ranges."""
    orders = read(spark, sf_dir, "orders").select(F.lit(1).cast("bigint").alias("company_id"), "o_orderkey")
    bits = operators.id_bitmaps(orders, "o_orderkey", ranges=1 << 20)
    held = F.aggregate("__words", F.lit(0).cast("bigint"), lambda n, w: n + F.bit_count(w))
    return bits.agg(F.count(F.lit(1)).alias("ranges"), F.sum(held).alias("ids"))


def lookup_join_equal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact with few different rows, each very often, joined on the split path."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("bigint").alias("n_nationkey"), "l_returnflag")
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")
    joined = operators.lookup_join(lines, nations, ["n_nationkey"], tuning=SPLIT)
    return joined.groupBy("n_name", "l_returnflag").agg(F.count(F.lit(1)).alias("lines"))


def self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = domain_table(spark, sf_dir, "job")
    parent = F.col("job_generated_lead_source_job_id")
    leads = jobs.where(parent.isNotNull()).select(
        "company_id", F.col("id").alias("lead_job_id"), parent.alias("parent_job_id")
    )
    parents = jobs.select("company_id", F.col("id").alias("parent_job_id"), F.col("job_status").alias("parent_status"))
    return operators.lookup_join(leads, parents, ["company_id", "parent_job_id"], "inner", tuning=PARAMS.join)


def child_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    total = operators.child_rollup(orders, lines, ["o_orderkey"], ["o_custkey"], "price", "revenue")
    return total.withColumn("revenue", functions.money(F.col("revenue")))


def rollup_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.rollup(
        read(spark, sf_dir, "orders"),
        ["o_orderpriority"],
        {"orders": F.count(F.lit(1)), "first_order": F.min("o_orderdate"), "last_order": F.max("o_orderdate")},
        where=~F.col("o_orderstatus").isin("F"),
    )


def first_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [("l_quantity", "desc"), ("l_shipdate", "asc"), ("l_partkey", "asc"), ("l_suppkey", "asc")]
    lines = read(spark, sf_dir, "lineitem")
    return operators.first_per_group(lines, ["l_orderkey"], order, ["l_partkey", "l_suppkey"])


def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [("ts", "desc"), ("event_id", "asc")]
    return operators.first_per_group(read(spark, sf_dir, "events"), ["user_id"], order, ["event_id", "event_type"])


def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [("o_totalprice", "desc"), ("o_orderkey", "asc")]
    top = operators.top_n_per_group(orders, ["o_custkey"], order, 3, rank="rn")
    return top.select("o_custkey", "o_orderkey", F.col("rn").cast("bigint").alias("rn"))


def distinct_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = functions.utrim(F.concat("l_returnflag", "l_linestatus"))
    return operators.distinct_list(read(spark, sf_dir, "lineitem"), ["l_suppkey"], flags, "flags")


def ordered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    return operators.ordered_text(orders, ["o_custkey"], "o_orderkey", "order_ids", chunk=10_000)


def explode_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upcoming appointments one per row; a job without any keeps one row."""
    src = sources(spark, sf_dir)
    keys = appointments.KEYS
    merged = operators.merge_on_key(
        appointments.past_appointments(src, PARAMS), appointments.next_appointments(src, PARAMS), keys
    )
    slots = F.filter(F.array("start_appointment", "next_appointment"), lambda s: s.isNotNull())
    return operators.explode_keep(merged.select(*keys, slots.alias("slots")), "slots", "slot")


def stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select(
        F.lit("Customer").alias("kind"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = read(spark, sf_dir, "supplier").select(
        F.lit("Supplier").alias("kind"),
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        functions.typed_null("string").alias("segment"),
    )
    return operators.stack(customers, suppliers)


def tenant_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    def named(table: str, key: str, name: str, *balance: str) -> DataFrame:
        extra = [F.col(b).alias("balance") for b in balance]
        return read(spark, sf_dir, table).select(F.col(key).alias("id"), F.col(name).alias("name"), *extra)

    return operators.union_tenants(
        {
            1: named("customer", "c_custkey", "c_name", "c_acctbal"),
            2: named("supplier", "s_suppkey", "s_name", "s_acctbal"),
            3: named("part", "p_partkey", "p_name"),
        }
    )


def optional_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    employees = domain_table(spark, sf_dir, "employee")

    def unit(df: DataFrame, source: str) -> DataFrame:
        column = functions.optional_column(df, "business_unit_id", "bigint").alias("business_unit_id")
        return df.select("id", F.lit(source).alias("source"), column)

    return operators.stack(unit(employees, "with"), unit(employees.drop("business_unit_id"), "without"))


def json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return read(spark, sf_dir, "events").select(
        "event_id",
        functions.json_value(props, "$.k", "bigint").alias("k"),
        functions.json_value(props, "$.missing").alias("missing"),
    )


def local_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    company = (F.col("event_id") % 3 + 1).alias("company_id")
    events = read(spark, sf_dir, "events").select("event_id", company, "ts")
    company, ts = F.col("company_id"), F.col("ts")
    return events.select(
        "event_id",
        "company_id",
        functions.to_local(ts, company, ZONES).alias("local_ts"),
        functions.local_date(ts, company, ZONES).alias("local_day"),
        F.year(functions.to_local(ts, company, ZONES)).cast("bigint").alias("local_year"),
    )


def local_year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    company, done = F.col("company_id"), F.col("completed_on")
    inside = functions.in_local_years(done, company, ZONES, PARAMS.year_lo, PARAMS.year_hi)
    day = functions.local_date(done, company, ZONES).alias("completion_date")
    return domain_table(spark, sf_dir, "job").where(inside).select("company_id", "id", day)


def day_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, today = F.to_date("start"), functions.today_utc(PARAMS.as_of)
    half = F.when(day < today, "past").when(day >= today, "future").alias("half")
    return domain_table(spark, sf_dir, "appointment").select("company_id", "job_id", "start", half)


def minutes_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = functions.minutes_between(F.col("dispatched_on"), F.col("done_on"))
    return domain_table(spark, sf_dir, "timesheet").select("id", minutes.alias("minutes"))


def parse_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("start_time")
    return domain_table(spark, sf_dir, "tech_dispatch_report").select(
        "company_id", "job_number", raw.alias("raw"), functions.parse_clock(raw).alias("clock")
    )


def parse_ts_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("started_on")
    return domain_table(spark, sf_dir, "gross_pay_items").select(
        "id", raw.alias("raw"), functions.parse_ts(raw).alias("started_on")
    )


def unicode_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", functions.utrim(F.col("text")).alias("text"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", functions.clean_text(F.col("text")).alias("text"))


def labelled_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.col("event_type") != "view"
    parts = [("Type", F.when(shown, F.col("event_type"))), ("User", F.when(shown, F.col("user_id").cast("string")))]
    return read(spark, sf_dir, "events").select("event_id", functions.labelled_list(parts).alias("parts"))


def array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderpriority"))
    none = F.array().cast("array<string>")
    kept = F.filter(F.array("o_orderstatus", even), lambda v: v.isNotNull())
    one_or_null = F.when(even.isNotNull(), F.array(even))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        functions.join_text(kept).alias("kept"),
        F.get(F.coalesce(one_or_null, none), 0).alias("first_or_null"),
        functions.join_text(F.coalesce(one_or_null, none)).alias("list_or_empty"),
    )


def rounded_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(4,2)")
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        functions.money(price * discount).alias("discount"),
        F.round(F.col("l_linenumber") / 60, 4).alias("share"),
    )


def three_valued_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = domain_table(spark, sf_dir, "invoice_item")
    listed = items.where("active").where(~F.col("type").isin("Material", "Equipment"))
    return listed.select("company_id", "invoice_id", "type", "price")


QUERIES: dict[str, Query] = {
    # Jobs
    "technicians_employees": _job(plans.technicians_employees),
    "timestamp_base": _job(plans.timestamp_base),
    "wip_appointments": _job(plans.wip_appointments),
    "job_technicians": _job(plans.job_technicians),
    "invoiced_items": _job(plans.invoiced_items),
    "sales_master_tracker": _job(plans.sales_master_tracker),
    "tech_dispatch_report": _job(plans.tech_dispatch_report),
    "timesheet_summary": _job(plans.technician_timesheet_summary),
    "gross_pay_items": _job(plans.gross_pay_items),
    # The same with every lookup join on the split path
    "timestamp_base_split": _job(plans.timestamp_base, SPLIT_PARAMS),
    "job_technicians_split": _job(plans.job_technicians, SPLIT_PARAMS),
    "invoiced_items_split": _job(plans.invoiced_items, SPLIT_PARAMS),
    "sales_master_split": _job(plans.sales_master_tracker, SPLIT_PARAMS),
    # The same with sets of ids that cut little or nothing
    "sales_master_full_sets": _job(plans.sales_master_tracker, FULL_SETS),
    "sales_master_no_sets": _job(plans.sales_master_tracker, NO_SETS),
    "invoiced_items_no_sets": _job(plans.invoiced_items, NO_SETS),
    # Reports with the published labels
    "invoiced_items_report": _job(display.invoiced_items),
    "sales_master_report": _job(display.sales_master_tracker),
    "tech_dispatch_labelled": _job(display.tech_dispatch_report),
    "timesheet_summary_labelled": _job(display.technician_timesheet_summary),
    "timestamp_base_sorted": _job(display.timestamp_base),
    "wip_appointments_sorted": _job(display.wip_appointments),
    # Parts of the jobs
    "past_appointments": _job(appointments.past_appointments),
    "next_appointments": _job(appointments.next_appointments),
    "split_technicians": _job(technicians.split_technicians),
    "assigned_technicians": _job(technicians.assigned_technicians),
    "sold_hours_by_job": _job(rollups.sold_hours_by_job),
    "invoice_total_by_job": _job(rollups.invoice_total_by_job),
    "lead_invoice_total": _job(rollups.lead_invoice_total),
    "sold_estimates_by_job": _job(rollups.sold_estimates_by_job),
    "installed_estimates_by_job": _job(rollups.installed_estimates_by_job),
    "lead_sales_by_parent": _job(rollups.lead_sales_by_parent),
    "lead_ids_by_parent": _job(rollups.lead_ids_by_parent),
    "lead_jobs": _job(rollups.lead_jobs),
    "lead_summary_by_parent": _job(rollups.lead_summary_by_parent),
    "purchase_order_total_by_job": _job(rollups.purchase_order_total_by_job),
    "return_total_by_job": _job(rollups.return_total_by_job),
    "paid_hours_by_job": _job(timesheets.paid_hours_by_job),
    # The packaged readers, over tables written from the test tables
    "people_partitioned": _partitioned(plans.technicians_employees, PEOPLE_TABLES),
    "people_tenant_roots": _tenant_roots(plans.technicians_employees, PEOPLE_TABLES),
    "invoiced_items_partitioned": _partitioned(plans.invoiced_items, INVOICED_TABLES),
    "invoiced_items_tenant_roots": _tenant_roots(plans.invoiced_items, INVOICED_TABLES),
    "invoiced_items_buckets": _in_buckets(plans.invoiced_items, INVOICED_TABLES),
    "invoiced_items_ranges": _in_ranges(plans.invoiced_items, INVOICED_TABLES),
    "installed_estimates_buckets": _in_buckets(rollups.installed_estimates_by_job, ("estimate", "estimate_item")),
    "wip_appointments_ranges": _in_ranges(plans.wip_appointments, ("appointment",)),
    "published_people": published_people,
    "repeated_ids": repeated_ids,
    # Operators on the test tables as they are
    "lookup_join": _lookup(PARAMS.join),
    "lookup_join_split": _lookup(SPLIT),
    "lookup_join_split_inner": lookup_join_split_inner,
    "lookup_join_two_keys": lookup_join_two_keys,
    "lookup_join_equal_rows": lookup_join_equal_rows,
    "id_bitmap_cut": id_bitmap_cut,
    "id_bitmaps": id_bitmaps,
    "first_nan": first_nan,
    "hot_users": hot_users,
    "merge_on_key": merge_on_key,
    "self_join": self_join,
    "child_rollup": child_rollup,
    "rollup_where": rollup_where,
    "first_per_group": first_per_group,
    "latest_per_group": latest_per_group,
    "top_n_per_group": top_n_per_group,
    "distinct_list": distinct_list,
    "ordered_text": ordered_text,
    "explode_keep": explode_keep,
    "stack": stack,
    "tenant_union": tenant_union,
    # Functions on the test tables as they are
    "optional_column": optional_column,
    "json_value": json_value,
    "local_times": local_times,
    "local_year_filter": local_year_filter,
    "day_split": day_split,
    "minutes_between": minutes_between,
    "parse_clock": parse_clock,
    "parse_ts_fallback": parse_ts_fallback,
    "unicode_trim": unicode_trim,
    "clean_text": clean_text,
    "labelled_list": labelled_list,
    "array_functions": array_functions,
    "rounded_money": rounded_money,
    "three_valued_filters": three_valued_filters,
}
