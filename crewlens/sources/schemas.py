"""Declared columns of the source tables, as far as the jobs read them.

Each table also has ``company_id BIGINT``. Instants are TIMESTAMP_NTZ in UTC, amounts are DECIMAL.
A declared column that a file lacks reads as NULL, which is how ``employee.business_unit_id`` may be
missing for some tenants.
"""

from __future__ import annotations

# The names of the duration columns of timesheet summaries.
DURATIONS = [
    "c643i_o",
    "c688i_o",
    "c1017i_o",
    "c1244i_o",
    "c31i_o",
    "c1360i_o",
    "c657i_o",
    "manager_exception",
    "hr_orientation",
    "holiday",
    "office_sick_time",
    "vacation",
    "pto_office",
    "temp_c_o",
    "meal",
    "sick",
    "unavab",
    "ems",
    "morning_meeting",
]
# The names of their hour columns.
SUMMARY_HOURS = [
    "paid_idle",
    "paid_driving",
    "job_hrs",
    "unpaid_time_off",
    "hours_worked",
    "regular",
    "overtime",
    "double_ot",
    "paid_time_off",
]


def _cols(names: list[str], data_type: str) -> str:
    return ", ".join(f"{n} {data_type}" for n in names)


# Table and column names.
SCHEMAS: dict[str, str] = {
    "job": "id BIGINT, job_number STRING, job_type_id BIGINT, business_unit_id BIGINT, customer_id BIGINT, "
    "project_id BIGINT, sold_by_id BIGINT, completed_on TIMESTAMP_NTZ, job_status STRING, "
    "job_generated_lead_source_job_id BIGINT, job_generated_lead_source_employee_id BIGINT",
    "job_type": "id BIGINT, name STRING",
    "business_unit": "id BIGINT, name STRING",
    "project": "id BIGINT, number STRING",
    "customer": "id BIGINT, name STRING, type STRING",
    "invoice": "id BIGINT, job_id BIGINT, sub_total DECIMAL(18,2)",
    "invoice_item": "invoice_id BIGINT, sku_name STRING, display_name STRING, description STRING, "
    "quantity DECIMAL(18,4), price DECIMAL(18,4), sold_hours DECIMAL(18,4), active BOOLEAN, type STRING",
    "estimate": "id BIGINT, job_id BIGINT, status_value BIGINT, active BOOLEAN, sold_on TIMESTAMP_NTZ, "
    "subtotal DECIMAL(18,2)",
    "estimate_item": "estimate_id BIGINT, total DECIMAL(18,2)",
    "purchase_order": "job_id BIGINT, total DECIMAL(18,2)",
    "return": "job_id BIGINT, return_amount DECIMAL(18,2)",
    "technician": "id BIGINT, name STRING, business_unit_id BIGINT, login_name STRING, email STRING, "
    "user_id BIGINT, active BOOLEAN, role_id BIGINT, is_managed_tech BOOLEAN",
    "employee": "id BIGINT, name STRING, business_unit_id BIGINT, login_name STRING, email STRING, "
    "user_id BIGINT, active BOOLEAN, role_id BIGINT",
    "timesheet": "id BIGINT, technician_id BIGINT, job_id BIGINT, created_on TIMESTAMP_NTZ, "
    "dispatched_on TIMESTAMP_NTZ, arrived_on TIMESTAMP_NTZ, done_on TIMESTAMP_NTZ, active BOOLEAN",
    "non_job_timesheets": "id BIGINT, employee_id BIGINT, timesheet_code_id BIGINT, created_on TIMESTAMP_NTZ, "
    "started_on TIMESTAMP_NTZ, ended_on TIMESTAMP_NTZ, active BOOLEAN",
    "timesheet_code": "id BIGINT, code STRING, description STRING, applicable_employee_type STRING, type STRING",
    "job_split": "job_id BIGINT, technician_id BIGINT, split DECIMAL(18,4), created_on TIMESTAMP_NTZ",
    "appointment_assignment": "job_id BIGINT, technician_id BIGINT, assigned_on TIMESTAMP_NTZ, active BOOLEAN",
    "appointment": "job_id BIGINT, start TIMESTAMP_NTZ, status STRING",
    "tech_dispatch_report": "name STRING, timesheet_activity STRING, timesheet_activity_date TIMESTAMP_NTZ, "
    "job_number BIGINT, start_time STRING, regular_time DECIMAL(18,4), end_time STRING, invoice_number BIGINT, "
    "job_business_unit STRING, hourly_rate DECIMAL(18,4), duration_dec DECIMAL(18,4), overtime DECIMAL(18,4)",
    "technician_timesheet_summary": "employee_id BIGINT, employee STRING, date TIMESTAMP_NTZ, start STRING, "
    f"first_arrival_time STRING, end STRING, {_cols(DURATIONS, 'STRING')}, "
    f"{_cols(SUMMARY_HOURS, 'DECIMAL(18,2)')}, payroll_id STRING",
    # The two instants may be stored as text in several forms; all other columns pass through.
    "gross_pay_items": "id BIGINT, activity STRING, activity_code STRING, activity_code_id BIGINT, "
    "amount DECIMAL(18,2), amount_adjustment DECIMAL(18,2), budget_code_id BIGINT, business_unit_name STRING, "
    "created_on TIMESTAMP_NTZ, customer_id BIGINT, customer_name STRING, date TIMESTAMP_NTZ, employee_id BIGINT, "
    "employee_payroll_id STRING, employee_type STRING, ended_on STRING, gross_pay_item_type STRING, "
    "invoice_id BIGINT, invoice_item_id BIGINT, invoice_number STRING, is_prevailing_wage_job BOOLEAN, "
    "job_id BIGINT, job_number STRING, job_type_name STRING, labor_type_code STRING, labor_type_id BIGINT, "
    "location_address STRING, location_id BIGINT, location_name STRING, location_zip STRING, memo STRING, "
    "modified_on TIMESTAMP_NTZ, paid_duration_hours DECIMAL(18,4), paid_time_type STRING, "
    "payout_business_unit_name STRING, payroll_id STRING, project_id BIGINT, project_number STRING, "
    "source_entity_id BIGINT, started_on STRING, tax_zone_name STRING, zone_name STRING",
}
