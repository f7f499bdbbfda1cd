"""The directory of people."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crewlens.functions import optional_column, typed_null
from crewlens.operators import stack
from crewlens.params import Params
from crewlens.sources import Sources


def technicians_employees(src: Sources, params: Params = Params()) -> DataFrame:
    """Technicians, then employees, in one table tagged with ``emp_type``. The same id may stand in
    both halves."""
    technician, employee = src.table("technician"), src.table("employee")
    shared = ["login_name", "email", "user_id", "active", F.col("role_id").alias("roles_ids")]
    technicians = technician.select(
        "company_id",
        F.lit("Technician").alias("emp_type"),
        "id",
        "name",
        "business_unit_id",
        *shared,
        "is_managed_tech",
    )
    employees = employee.select(
        "company_id",
        F.lit("Employee").alias("emp_type"),
        "id",
        "name",
        optional_column(employee, "business_unit_id", "bigint").alias("business_unit_id"),
        *shared,
        typed_null("boolean").alias("is_managed_tech"),
    )
    return stack(technicians, employees)
