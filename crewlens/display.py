"""Reports with the exact column labels and row order. Jobs themselves promise no order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens import plans
from crewlens.params import Params
from crewlens.plans.invoiced import invoiced_lines
from crewlens.plans.sales_master import sales_master_rows
from crewlens.sources import Sources

# Published labels, also the misspelled ones, by column.
INVOICED_ITEMS = {
    "Job #": "job_number",
    "Invoice #": "invoice_number",
    "Job Type": "job_type",
    "Completion Date": "completion_date",
    "Item Code": "item_code",
    "Item Name": "item_name",
    "Item Description": "item_description",
    "Item Quantity": "item_quantity",
    "Item Price": "item_price",
    "Invoice Subtotal": "invoice_subtotal",
    "Sould Hours": "sold_hours",
}
SALES_MASTER_TRACKER = {
    "Job #": "job_number",
    "Job Type": "job_type",
    "Business Unit": "business_unit",
    "Completion Date": "completion_date",
    "Project": "project",
    "Job Subtotal": "job_subtotal",
    "Customer Id": "customer_id",
    "Customer Name": "customer_name",
    "Assigned Technicians": "assigned_technicians",
    "Sold By": "sold_by",
    "Total Technicias Paid Time": "total_paid_time",
    "Primary Technician": "primary_technician",
    "Status": "status",
    "Scheduled Date": "scheduled_date",
    "Total Appointments": "total_appointments",
    "First Appt Date": "first_appt_date",
    "Last Appt Date": "last_appt_date",
    "Next Appt Start date": "next_appt_start_date",
    "Customer Type": "customer_type",
    "Jobs Estimate Sales Subtotal": "estimate_sales_subtotal",
    "Jobs Estimate Sales Installed": "estimate_sales_installed",
    "Appointments To Date": "appointments_to_date",
    "Sales from Leads Created": "sales_from_leads_created",
    "Lead Created": "lead_created",
    "Invoice #": "invoice_number",
}
TECH_DISPATCH_REPORT = {
    "Name": "name",
    "Timesheet Activity": "timesheet_activity",
    "Timesheet Activity Date": "timesheet_activity_date",
    "Job Number": "job_number",
    "Start Time": "start_time",
    "Regular Time": "regular_time",
    "End Time": "end_time",
    "Invoice Number": "invoice_number",
    "Business Unit": "business_unit",
    "Hourly Rate": "hourly_rate",
    "Duration Decimal": "duration_decimal",
    "Overtime": "overtime",
}
TECHNICIAN_TIMESHEET_SUMMARY = {
    "Employee Id": "employee_id",
    "Employee": "employee",
    "Date": "work_date",
    "Start": "start_time",
    "First Arrival Time": "first_arrival_time",
    "End": "end_time",
    "Paid Idle": "paid_idle",
    "Paid Driving": "paid_driving",
    "Job Hrs": "job_hrs",
    "Timesheet Codes ClockInOut": "codes_clock_in_out",
    "Timesheet Codes Paid": "codes_paid",
    "Timesheet Codes PaidTimeOff": "codes_paid_time_off",
    "Timesheet Codes Unpaid": "codes_unpaid",
    "Unpaid Time Off": "unpaid_time_off",
    "Hours Worked": "hours_worked",
    "Regular": "regular",
    "Overtime": "overtime",
    "Double OT": "double_ot",
    "Paid Time Off": "paid_time_off",
    "Payroll ID": "payroll_id",
}


def _report(rows: DataFrame, labels: Mapping[str, str], *order: str | Column) -> DataFrame:
    # The sort may be on a column that the report does not show, so it comes first. The last keys are ids: rows
    # that are equal in the first ones have an order too, and are divided over tasks like others.
    if order:
        rows = rows.orderBy(*order)
    return rows.select("company_id", *[F.col(c).alias(label) for label, c in labels.items()])


def invoiced_items(src: Sources, params: Params = Params()) -> DataFrame:
    return _report(invoiced_lines(src, params), INVOICED_ITEMS, "completed_on", "job_id", "invoice_id", "item_code", "item_description")


def sales_master_tracker(src: Sources, params: Params = Params()) -> DataFrame:
    return _report(sales_master_rows(src, params), SALES_MASTER_TRACKER, "first_appointment", "invoice_number", "company_id")


def tech_dispatch_report(src: Sources, params: Params = Params()) -> DataFrame:
    rows = plans.tech_dispatch_report(src, params)
    return _report(rows, TECH_DISPATCH_REPORT, "timesheet_activity_date", "name", "start_time", "job_number", "company_id")


def technician_timesheet_summary(src: Sources, params: Params = Params()) -> DataFrame:
    return _report(plans.technician_timesheet_summary(src, params), TECHNICIAN_TIMESHEET_SUMMARY)


def timestamp_base(src: Sources, params: Params = Params()) -> DataFrame:
    return plans.timestamp_base(src, params).orderBy("source", "emp_name", "id", "company_id")


def wip_appointments(src: Sources, params: Params = Params()) -> DataFrame:
    return plans.wip_appointments(src, params).orderBy("job_id", "company_id")
