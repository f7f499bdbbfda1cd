"""Amounts per job: invoices, estimates, leads, purchase orders and returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions import money, utrim
from crewlens.operators import child_rollup, lookup_join, ordered_text, rollup
from crewlens.params import Params
from crewlens.plans.scope import KEYS, Scope, within
from crewlens.sources import Sources

# ``jobs`` spares a rollup the work on other jobs (see ``Scope``).
INVOICE = ["invoice_id", "company_id"]


def sold_hours_by_job(src: Sources, params: Params = Params()) -> DataFrame:
    """Sold hours of the active items on all invoices of a job."""
    invoices = src.table("invoice").select(*KEYS, F.col("id").alias("invoice_id"))
    items = src.table("invoice_item").where("active").select(*INVOICE, "sold_hours")
    hours = child_rollup(invoices, items, INVOICE, KEYS, "sold_hours", "sold_hours", how="inner")
    return hours.withColumn("sold_hours", F.col("sold_hours").cast("decimal(28,4)"))


def invoice_total_by_job(src: Sources, params: Params = Params(), jobs: Scope | None = None) -> DataFrame:
    """Sum of invoice subtotals per job."""
    return rollup(within(src.table("invoice").select(*KEYS, "sub_total"), jobs), KEYS, {"total_invoice": money(F.sum("sub_total"))})


def lead_invoice_total(src: Sources, params: Params = Params()) -> DataFrame:
    """For each job that came from another job: what that other job was invoiced."""
    parent = F.col("job_generated_lead_source_job_id")
    leads = src.table("job").where(parent.isNotNull())
    leads = leads.select("company_id", F.col("id").alias("lead_job_id"), parent.alias("job_id"))
    # One parent may have led to a third of all jobs.
    totals = invoice_total_by_job(src, params).withColumnRenamed("total_invoice", "sub_total_lead")
    return lookup_join(leads, totals, KEYS, tuning=params.join)


def sold_estimates_by_job(src: Sources, params: Params = Params(), jobs: Scope | None = None) -> DataFrame:
    """Number and subtotal of active estimates with a sale date."""
    sold = src.table("estimate").where(F.col("sold_on").isNotNull() & F.col("active")).select(*KEYS, "id", "subtotal")
    return rollup(within(sold, jobs), KEYS, {"estimates": F.count("id"), "subtotal": money(F.sum("subtotal"))})


def installed_estimates_by_job(
    src: Sources, params: Params = Params(), jobs: Scope | None = None
) -> DataFrame:
    """Item totals of active estimates in status 1. A job whose estimates have no items stays, with
    a NULL total."""
    estimates = src.table("estimate").where((F.col("status_value") == 1) & F.col("active"))
    estimates = within(estimates.select(*KEYS, F.col("id").alias("estimate_id")), jobs)
    on = ["estimate_id", "company_id"]
    # Items of other estimates are cut before they are summed.
    items = Scope(estimates, params, "estimate_id").cut(src.table("estimate_item").select(*on, "total"))
    total = child_rollup(estimates, items, on, KEYS, "total", "estimate_items_total")
    return total.withColumn("estimate_items_total", money(F.col("estimate_items_total")))


def lead_sales_by_parent(src: Sources, params: Params = Params(), jobs: Scope | None = None) -> DataFrame:
    """Active estimates in status 1, summed over the jobs that a job led to."""
    links = src.table("job").select(
        "company_id",
        F.col("id").alias("job_id"),
        F.col("job_generated_lead_source_job_id").alias("parent_job_id"),
    )
    sold = src.table("estimate").where((F.col("status_value") == 1) & F.col("active"))
    if jobs is not None:
        links = jobs.cut(links.where(F.col("parent_job_id").isNotNull()), "parent_job_id")
        sold = Scope(links, params).cut(sold.select(*KEYS, "subtotal"))
    total = child_rollup(
        links, sold, KEYS, ["parent_job_id", "company_id"], "subtotal", "sub_total_lead", how="inner"
    )
    return total.withColumn("sub_total_lead", money(F.col("sub_total_lead")))


def lead_ids_by_parent(src: Sources, params: Params = Params(), jobs: Scope | None = None) -> DataFrame:
    """The ids of the jobs that a job led to, in numeric order, as text.

    The ids come from the job table and name jobs of the same table, so looking them up again would
    change nothing. Jobs without a lead source are dropped before any grouping.
    """
    parent = F.col("job_generated_lead_source_job_id")
    leads = src.table("job").where(parent.isNotNull()).select("company_id", parent.alias("parent_job_id"), "id")
    leads = within(leads, jobs, "parent_job_id")
    return ordered_text(leads, ["parent_job_id", "company_id"], "id", "lead_created")


def lead_jobs(src: Sources, params: Params = Params()) -> DataFrame:
    """One row per job that another job led to, with the name of the technician who made the lead."""
    parent = F.col("job_generated_lead_source_job_id")
    leads = src.table("job").where(parent.isNotNull()).select(
        "company_id",
        parent.alias("parent_job_id"),
        F.col("id").alias("job_id"),
        F.col("job_generated_lead_source_employee_id").alias("employee_id"),
    )
    people = src.table("technician_copy").select(
        "company_id", F.col("id").alias("employee_id"), F.col("name").alias("technician_name")
    )
    return lookup_join(leads, people, ["employee_id", "company_id"], tuning=params.join)


def lead_summary_by_parent(src: Sources, params: Params = Params()) -> DataFrame:
    """Per job: how many jobs it led to, and the names of the technicians who made the leads.

    Leads are counted per parent and technician first, so that a name is looked up and listed once, and a
    parent of very many leads is many small rows before anything is joined or collected."""
    parent = F.col("job_generated_lead_source_job_id")
    leads = src.table("job").where(parent.isNotNull()).select(
        "company_id", parent.alias("parent_job_id"), F.col("job_generated_lead_source_employee_id").alias("employee_id")
    )
    made = rollup(leads, ["parent_job_id", "employee_id", "company_id"], {"leads": F.count(F.lit(1))})
    people = src.table("technician_copy").select(
        "company_id", F.col("id").alias("employee_id"), F.col("name").alias("technician_name")
    )
    # Several rows of one technician must not count their leads again.
    names = rollup(people, ["employee_id", "company_id"], {"names": F.collect_set(utrim(F.col("technician_name")))})
    named = lookup_join(made, names, ["employee_id", "company_id"], tuning=params.join)
    listed = F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_list("names")))), ", ")
    return rollup(
        named,
        ["parent_job_id", "company_id"],
        {"lead_count": F.sum("leads"), "created_by": F.when(F.count(F.when(F.size("names") > 0, 1)) > 0, listed)},
    )


def purchase_order_total_by_job(src: Sources, params: Params = Params()) -> DataFrame:
    """Purchase orders per job."""
    return rollup(src.table("purchase_order"), KEYS, {"purchase_order_total": money(F.sum("total"))})


def return_total_by_job(src: Sources, params: Params = Params()) -> DataFrame:
    """Returned amount per job."""
    return rollup(src.table("return"), KEYS, {"returns_amount_total": money(F.sum("return_amount"))})
