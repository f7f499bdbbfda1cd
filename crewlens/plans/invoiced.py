"""Invoiced items of completed jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions import in_local_years, local_date, money, utrim
from crewlens.operators import child_rollup, lookup_join
from crewlens.params import Params
from crewlens.plans.rollups import INVOICE
from crewlens.plans.scope import KEYS, Scope
from crewlens.sources import Sources

NOT_LISTED = ("Material", "Equipment")


def invoiced_lines(src: Sources, params: Params = Params()) -> DataFrame:
    """The rows of ``invoiced_items`` with ``completed_on`` and the ids, on which reports sort."""
    company, completed = F.col("company_id"), F.col("completed_on")
    # NULL status and NULL type drop out, as NOT IN has it.
    jobs = src.table("job").where(
        ~F.col("job_status").isin("Canceled")
        & in_local_years(completed, company, src.zones, params.year_lo, params.year_hi)
    )
    types = src.table("job_type").select(
        "company_id", F.col("id").alias("job_type_id"), utrim(F.col("name")).alias("job_type")
    )
    jobs = lookup_join(
        jobs.select("company_id", F.col("id").alias("job_id"), "job_number", "job_type_id", "completed_on"),
        types,
        ["job_type_id", "company_id"],
        tuning=params.join,
        distinct_rows=True,
    )
    # What belongs to other jobs is cut where it is read: their invoices, then the items of those.
    wanted = Scope(jobs, params)
    invoices = wanted.cut(src.table("invoice").select("company_id", F.col("id").alias("invoice_id"), "job_id", "sub_total"))
    items = Scope(invoices, params, "invoice_id").cut(src.table("invoice_item"))
    # Hours are summed per invoice, then per job, before they meet anything: no hot key is left.
    hours = child_rollup(invoices, items.where("active").select(*INVOICE, "sold_hours"), INVOICE, KEYS, "sold_hours", "sold_hours", how="inner")
    jobs = jobs.join(hours.withColumn("sold_hours", F.col("sold_hours").cast("decimal(28,4)")), KEYS, "left")
    job_invoices = lookup_join(invoices, jobs, KEYS, "inner", tuning=params.join, distinct_rows=True)
    listed = items.where(~F.col("type").isin(*NOT_LISTED))
    lines = lookup_join(
        listed.select(*INVOICE, "sku_name", "display_name", "description", "quantity", "price"),
        job_invoices,
        INVOICE,
        "inner",
        tuning=params.join,
        together=src.lie_together("invoice_item"),
    )
    return lines.select(
        "company_id",
        "job_number",
        F.col("job_number").alias("invoice_number"),
        "job_type",
        local_date(completed, company, src.zones).alias("completion_date"),
        utrim(F.col("sku_name")).alias("item_code"),
        utrim(F.col("display_name")).alias("item_name"),
        utrim(F.col("description")).alias("item_description"),
        money(F.col("quantity")).alias("item_quantity"),
        money(F.col("price")).alias("item_price"),
        money(F.coalesce("sub_total", F.lit(0))).alias("invoice_subtotal"),
        money(F.col("sold_hours")).alias("sold_hours"),
        "completed_on",
        "job_id",
        "invoice_id",
    )


def invoiced_items(src: Sources, params: Params = Params()) -> DataFrame:
    """Invoice items, without material and equipment, of jobs that are not cancelled and were
    completed in the given local years. The sold hours of the whole job stand on each item."""
    return invoiced_lines(src, params).drop("completed_on", "job_id", "invoice_id")
