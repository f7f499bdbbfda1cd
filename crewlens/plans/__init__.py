"""The dataset jobs: ``fn(src, params) -> DataFrame``, all tenants at once, nothing run yet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from crewlens.params import Params
from crewlens.plans.appointments import wip_appointments
from crewlens.plans.invoiced import invoiced_items
from crewlens.plans.people import technicians_employees
from crewlens.plans.reports import gross_pay_items, tech_dispatch_report, technician_timesheet_summary
from crewlens.plans.sales_master import sales_master_tracker
from crewlens.plans.technicians import job_technicians
from crewlens.plans.timesheets import timestamp_base
from crewlens.sources import Sources

Job = Callable[[Sources, Params], DataFrame]

JOBS: dict[str, Job] = {
    "technicians_employees": technicians_employees,
    "timestamp_base": timestamp_base,
    "wip_appointments": wip_appointments,
    "job_technicians": job_technicians,
    "invoiced_items": invoiced_items,
    "sales_master_tracker": sales_master_tracker,
    "tech_dispatch_report": tech_dispatch_report,
    "technician_timesheet_summary": technician_timesheet_summary,
    "gross_pay_items": gross_pay_items,
}

__all__ = ["JOBS", "Job", *JOBS]
