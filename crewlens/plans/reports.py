"""Clean-ups of flat reports. Projections only: no shuffle at any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions import labelled_list, money, parse_clock, parse_ts
from crewlens.params import Params
from crewlens.sources import Sources

# The text of a missing duration, and the labels of the duration columns by group.
NO_TIME = "0h 00m"
CLOCK_IN_OUT = {
    "C643I/O": "c643i_o",
    "C688I/O": "c688i_o",
    "C1017I/O": "c1017i_o",
    "C1244I/O": "c1244i_o",
    "C31I/O": "c31i_o",
    "C1360I/O": "c1360i_o",
    "C657I/O": "c657i_o",
}
PAID = {"Manager Exception": "manager_exception", "HR Orientation": "hr_orientation"}
PAID_TIME_OFF = {
    "Holiday": "holiday",
    "Office Sick Time": "office_sick_time",
    "Vacation": "vacation",
    "PTO Office": "pto_office",
}
UNPAID = {
    "Temp C/O": "temp_c_o",
    "Meal": "meal",
    "Sick": "sick",
    "Unavab": "unavab",
    "EMS": "ems",
    "Morning Meeting": "morning_meeting",
}


def tech_dispatch_report(src: Sources, params: Params = Params()) -> DataFrame:
    """One row per dispatch report row, with real dates, clock times and rounded amounts."""
    return src.table("tech_dispatch_report").select(
        "company_id",
        "name",
        "timesheet_activity",
        F.to_date("timesheet_activity_date").alias("timesheet_activity_date"),
        F.col("job_number").cast("string").alias("job_number"),
        parse_clock(F.col("start_time")).alias("start_time"),
        money(F.col("regular_time")).alias("regular_time"),
        parse_clock(F.col("end_time")).alias("end_time"),
        "invoice_number",
        F.col("job_business_unit").alias("business_unit"),
        money(F.col("hourly_rate")).alias("hourly_rate"),
        money(F.col("duration_dec")).alias("duration_decimal"),
        money(F.col("overtime")).alias("overtime"),
    )


def technician_timesheet_summary(src: Sources, params: Params = Params()) -> DataFrame:
    """One row per technician and day; the duration columns are folded into four labelled texts."""

    def folded(group: dict[str, str]):
        return labelled_list([(label, F.col(c)) for label, c in group.items()], default=NO_TIME)

    return src.table("technician_timesheet_summary").select(
        "company_id",
        "employee_id",
        "employee",
        F.to_date("date").alias("work_date"),
        parse_clock(F.col("start")).alias("start_time"),
        parse_clock(F.col("first_arrival_time")).alias("first_arrival_time"),
        parse_clock(F.col("end")).alias("end_time"),
        "paid_idle",
        "paid_driving",
        "job_hrs",
        folded(CLOCK_IN_OUT).alias("codes_clock_in_out"),
        folded(PAID).alias("codes_paid"),
        folded(PAID_TIME_OFF).alias("codes_paid_time_off"),
        folded(UNPAID).alias("codes_unpaid"),
        "unpaid_time_off",
        "hours_worked",
        "regular",
        "overtime",
        "double_ot",
        "paid_time_off",
        "payroll_id",
    )


def gross_pay_items(src: Sources, params: Params = Params()) -> DataFrame:
    """Payroll lines as they are, with start and end read as instants whatever form they have."""
    items = src.table("gross_pay_items")
    instants = {"started_on", "ended_on"}
    rest = [c for c in items.columns if c != "company_id"]
    return items.select(
        "company_id", *[parse_ts(F.col(c)).alias(c) if c in instants else F.col(c) for c in rest]
    )
