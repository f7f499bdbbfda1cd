"""SQL for DuckDB, one text per query, written from the definition of each dataset and in other steps than
the Spark code takes: sorted lists, ordered picks and values looked up one by one."""

from __future__ import annotations

from checks.testbed import PARAMS, oracle
from crewlens import display
from crewlens.functions.text import WHITE_SPACE

M = "DECIMAL(28,2)"
AS_OF = f"DATE '{PARAMS.as_of}'"
KEYS = "company_id, job_id"


def local(ts: str) -> str:
    return f"({ts} AT TIME ZONE 'UTC' AT TIME ZONE tz)"


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS {M})"


def clock(x: str) -> str:
    blanks = f"trim(regexp_replace({x}, '[^0-9:a-zA-Z]+', ' ', 'g'))"
    spaced = f"regexp_replace(upper({blanks}), ' ?(AM|PM)$', ' \\1')"
    return f"strftime(try_strptime({spaced}, '%I:%M %p'), '%H:%M:%S')"


def instant(x: str) -> str:
    return f"coalesce(try_strptime({x}, '%Y-%m-%dT%H:%M:%SZ'), try_strptime({x}, '%Y-%m-%dT%H:%M:%S.%gZ'), TRY_CAST({x} AS TIMESTAMP))"


PEOPLE = """
SELECT company_id, 'Technician' AS emp_type, id, name, business_unit_id, login_name, email, user_id, active,
       role_id AS roles_ids, is_managed_tech
FROM d_technician
UNION ALL
SELECT company_id, 'Employee', id, name, business_unit_id, login_name, email, user_id, active, role_id,
       CAST(NULL AS BOOLEAN)
FROM d_employee
"""

PAST = f"""
SELECT company_id, job_id, min(start) AS first_past_appointment, count(*) AS total_past_appointments,
       max(start) AS last_past_appointment
FROM d_appointment WHERE CAST(start AS DATE) < {AS_OF} GROUP BY company_id, job_id
"""

# All future starts of a job as one sorted list; the reports look at its first two.
NEXT = f"""
SELECT company_id, job_id, least(len(f), 2) AS total_future_appointments, f[1] AS start_appointment,
       f[2] AS next_appointment
FROM (SELECT company_id, job_id, list(start ORDER BY start) AS f FROM d_appointment
      WHERE CAST(start AS DATE) >= {AS_OF} GROUP BY company_id, job_id) x
"""

# One grouping for both halves. Rows without a job are grouped per half.
WIP = f"""
SELECT company_id, job_id, lo AS first_appointment, n + least(len(f), 2) AS total_appointments,
       coalesce(f[1], hi) AS start_appointment, coalesce(f[2], hi, f[1]) AS next_appointment,
       hi AS most_recent_appointment
FROM (SELECT company_id, job_id, min(start) FILTER (WHERE past) AS lo, max(start) FILTER (WHERE past) AS hi,
             count(*) FILTER (WHERE past) AS n, coalesce(list(start ORDER BY start) FILTER (WHERE NOT past), []) AS f
      FROM (SELECT *, CAST(start AS DATE) < {AS_OF} AS past FROM d_appointment WHERE start IS NOT NULL) a
      GROUP BY company_id, job_id, CASE WHEN job_id IS NULL THEN past END) x
"""

# One row per assignment and one per split, each with the name it goes by, ranked within its job and kind.
# A technician's own split of the job is the largest one of that technician there.
TECHNICIAN_ROWS = f"""
SELECT a.company_id, a.job_id, 'assigned' AS kind, who, own,
       row_number() OVER (PARTITION BY a.company_id, a.job_id
                          ORDER BY a.assigned_on NULLS FIRST, who, own DESC NULLS LAST) AS place
FROM (SELECT *, coalesce((SELECT trim(p.name) FROM ({PEOPLE}) p WHERE p.id = technician_id AND p.company_id = x.company_id), '') AS who,
             (SELECT max(s.split) FROM d_job_split s WHERE s.company_id = x.company_id AND s.job_id = x.job_id
                AND s.technician_id = x.technician_id) AS own
      FROM d_appointment_assignment x WHERE x.active) a
UNION ALL
SELECT b.company_id, b.job_id, 'split', who, b.split,
       row_number() OVER (PARTITION BY b.company_id, b.job_id
                          ORDER BY b.split DESC NULLS LAST, b.created_on NULLS FIRST, who)
FROM (SELECT *, coalesce((SELECT trim(p.name) FROM d_technician p WHERE p.id = technician_id AND p.company_id = x.company_id), '') AS who
      FROM d_job_split x) b
"""

# Rows without a job stay apart by kind.
TECHNICIANS = f"""
SELECT company_id, job_id, list_sort(list(DISTINCT who) FILTER (WHERE kind = 'assigned')) AS assigned,
       list_sort(list(DISTINCT who) FILTER (WHERE kind = 'split')) AS splitting,
       max(who) FILTER (WHERE kind = 'assigned' AND place = 1) AS earliest,
       max(own) FILTER (WHERE kind = 'assigned' AND place = 1) AS share_of_earliest,
       max(who) FILTER (WHERE kind = 'split' AND place = 1) AS largest, max(own) FILTER (WHERE kind = 'split') AS largest_share
FROM ({TECHNICIAN_ROWS}) r GROUP BY company_id, job_id, CASE WHEN job_id IS NULL THEN kind END
"""

JOB_TECHNICIANS = f"""
SELECT company_id, job_id, array_to_string(coalesce(assigned, splitting), ', ') AS assigned_technicians,
       CASE WHEN largest IS NULL THEN earliest WHEN earliest IS NULL THEN largest
            WHEN coalesce(largest_share, 0) > coalesce(share_of_earliest, 0) THEN largest ELSE earliest END AS primary_technician
FROM ({TECHNICIANS}) t
"""

SOLD_HOURS = """
SELECT i.company_id, i.job_id, CAST(sum(hours) AS DECIMAL(28,4)) AS sold_hours
FROM (SELECT company_id, invoice_id, sum(sold_hours) AS hours FROM d_invoice_item WHERE active GROUP BY ALL) h
JOIN d_invoice i ON i.id = h.invoice_id AND i.company_id = h.company_id GROUP BY ALL
"""

INVOICE_TOTAL = f"SELECT company_id, job_id, {money('sum(sub_total)')} AS total_invoice FROM d_invoice GROUP BY company_id, job_id"

SOLD_ESTIMATES = f"""
SELECT company_id, job_id, count(id) AS estimates, {money('sum(subtotal)')} AS subtotal
FROM d_estimate WHERE sold_on IS NOT NULL AND active IS TRUE GROUP BY company_id, job_id
"""

INSTALLED = f"""
SELECT company_id, job_id, {money('sum(worth)')} AS estimate_items_total
FROM (SELECT *, (SELECT sum(x.total) FROM d_estimate_item x WHERE x.company_id = e.company_id AND x.estimate_id = e.id) AS worth
      FROM d_estimate e WHERE active AND status_value = 1) priced GROUP BY ALL
"""

LEAD_SALES = f"""
SELECT company_id, parent_job_id, {money('sum(list_sum(sales))')} AS sub_total_lead
FROM (SELECT company_id, job_generated_lead_source_job_id AS parent_job_id,
             (SELECT list(subtotal) FROM d_estimate e WHERE e.company_id = j.company_id AND e.job_id = j.id AND active AND status_value = 1) AS sales
      FROM d_job j) led WHERE sales IS NOT NULL GROUP BY ALL
"""

LEAD_IDS = """
SELECT company_id, job_generated_lead_source_job_id AS parent_job_id, string_agg(CAST(id AS VARCHAR), ', ' ORDER BY id) AS lead_created
FROM d_job WHERE job_generated_lead_source_job_id IS NOT NULL GROUP BY ALL
"""

PAID_HOURS = f"""
SELECT company_id, job_id, CAST(sum(date_diff('minute', dispatched_on, done_on)) AS BIGINT) AS total_minutes,
       CAST(round(CAST(sum(date_diff('minute', dispatched_on, done_on)) AS DOUBLE) / 60, 2) AS {M}) AS total_paid_time
FROM d_timesheet GROUP BY company_id, job_id
"""



def _of_job(column: str, table: str, key: str) -> str:
    """A column looked up for the job ``j``."""
    return f"(SELECT {column} FROM {table} d WHERE d.company_id = j.company_id AND d.{key})"


INVOICED = f"""
SELECT j.company_id, j.job_number, j.job_number AS invoice_number,
       {_of_job('trim(d.name)', 'd_job_type', 'id = j.job_type_id')} AS job_type, j.day AS completion_date,
       trim(x.sku_name) AS item_code, trim(x.display_name) AS item_name, trim(x.description) AS item_description,
       {money('x.quantity')} AS item_quantity, {money('x.price')} AS item_price,
       {money('coalesce(i.sub_total, 0)')} AS invoice_subtotal,
       {money(_of_job('d.sold_hours', f'({SOLD_HOURS})', 'job_id = j.id'))} AS sold_hours
FROM d_invoice_item x
JOIN d_invoice i ON i.id = x.invoice_id AND i.company_id = x.company_id
JOIN (SELECT *, CAST({local('completed_on')} AS DATE) AS day FROM d_job JOIN d_tenant USING (company_id)) j
  ON j.id = i.job_id AND j.company_id = i.company_id
WHERE x.type NOT IN ('Material', 'Equipment') AND j.job_status <> 'Canceled'
  AND j.day BETWEEN DATE '{PARAMS.year_lo}-01-01' AND DATE '{PARAMS.year_hi}-12-31'
"""

# Each value is looked up on its own for a job; a job stays if any of its three local days is recent.
SALES_MASTER = f"""
SELECT j.company_id, j.job_number, {_of_job('trim(d.name)', 'd_job_type', 'id = j.job_type_id')} AS job_type,
       {_of_job('trim(d.name)', 'd_business_unit', 'id = j.business_unit_id')} AS business_unit,
       CAST({local('j.completed_on')} AS DATE) AS completion_date,
       {_of_job('d.number', 'd_project', 'id = j.project_id')} AS project,
       coalesce({_of_job('d.total_invoice', f'({INVOICE_TOTAL})', 'job_id = j.id')}, 0) AS job_subtotal,
       j.customer_id, {_of_job('trim(d.name)', 'd_customer', 'id = j.customer_id')} AS customer_name,
       coalesce({_of_job('d.assigned_technicians', f'({JOB_TECHNICIANS})', 'job_id = j.id')}, '') AS assigned_technicians,
       {_of_job('trim(d.name)', 'd_technician', 'id = j.sold_by_id')} AS sold_by,
       {_of_job('d.total_paid_time', f'({PAID_HOURS})', 'job_id = j.id')} AS total_paid_time,
       {_of_job('d.primary_technician', f'({JOB_TECHNICIANS})', 'job_id = j.id')} AS primary_technician,
       j.job_status AS status, w.d_start AS scheduled_date, w.total_appointments, w.d_first AS first_appt_date,
       w.d_first AS last_appt_date, w.d_next AS next_appt_start_date,
       {_of_job('trim(d.type)', 'd_customer', 'id = j.customer_id')} AS customer_type,
       coalesce({_of_job('d.subtotal', f'({SOLD_ESTIMATES})', 'job_id = j.id')}, 0) AS estimate_sales_subtotal,
       coalesce({_of_job('d.estimate_items_total', f'({INSTALLED})', 'job_id = j.id')}, 0) AS estimate_sales_installed,
       w.total_appointments AS appointments_to_date,
       coalesce({_of_job('d.sub_total_lead', f'({LEAD_SALES})', 'parent_job_id = j.id')}, 0) AS sales_from_leads_created,
       coalesce({_of_job('d.lead_created', f'({LEAD_IDS})', 'parent_job_id = j.id')}, '') AS lead_created,
       j.id AS invoice_number
FROM (SELECT * FROM d_job JOIN d_tenant USING (company_id)) j
JOIN (SELECT company_id, job_id, total_appointments, CAST({local('first_appointment')} AS DATE) AS d_first,
             CAST({local('start_appointment')} AS DATE) AS d_start, CAST({local('next_appointment')} AS DATE) AS d_next
      FROM ({WIP}) a JOIN d_tenant USING (company_id)) w
  ON w.company_id = j.company_id AND w.job_id = j.id
WHERE greatest(year(w.d_first), year(w.d_start), year(w.d_next)) >= {PARAMS.min_year}
"""



def _of(column: str, table: str, match: str) -> str:
    """A column looked up for the entry ``e``."""
    return f"(SELECT d.{column} FROM {table} d WHERE d.company_id = e.company_id AND d.id = e.{match})"


def _entries(table: str, source: str, person: str, times: dict[str, str], extra: str) -> str:
    """The active entries of one kind, each with its person looked up by id."""
    who = ", ".join(f"{_of(c, f'({PEOPLE})', person)} AS {name}" for c, name in (("name", "emp_name"), ("emp_type", "emp_type"), ("business_unit_id", "business_unit_id")))
    shown = ", ".join(f"{local(f'e.{c}')} AS {name}" for name, c in times.items())
    return f"SELECT e.company_id, e.id, e.active, '{source}' AS source, e.{person} AS emp_id, {who}, {shown}, {extra} FROM (SELECT * FROM {table} JOIN d_tenant USING (company_id)) e WHERE e.active"


_CODE_COLUMNS = ("code", "description", "applicable_employee_type", "type")
TIMESTAMP_BASE = f"""
{_entries("d_timesheet", "Job", "technician_id",
          {"created_on": "created_on", "start_ts": "dispatched_on", "arrival_ts": "arrived_on", "end_ts": "done_on"},
          "e.job_id, NULL::BIGINT AS timesheet_code_id, " + ", ".join(f"NULL::VARCHAR AS {c}" for c in _CODE_COLUMNS))}
UNION ALL BY NAME
{_entries("d_non_job_timesheets", "Non-Job", "employee_id",
          {"created_on": "created_on", "start_ts": "started_on", "arrival_ts": "created_on", "end_ts": "ended_on"},
          "NULL::BIGINT AS job_id, e.timesheet_code_id, " + ", ".join(f"{_of(c, 'd_timesheet_code', 'timesheet_code_id')} AS {c}" for c in _CODE_COLUMNS))}
"""

DISPATCH = f"""
SELECT company_id, name, timesheet_activity, CAST(timesheet_activity_date AS DATE) AS timesheet_activity_date,
       CAST(job_number AS VARCHAR) AS job_number, {clock('start_time')} AS start_time,
       {money('regular_time')} AS regular_time, {clock('end_time')} AS end_time, invoice_number,
       job_business_unit AS business_unit, {money('hourly_rate')} AS hourly_rate,
       {money('duration_dec')} AS duration_decimal, {money('overtime')} AS overtime
FROM d_tech_dispatch_report
"""


def _labelled(parts: dict[str, str]) -> str:
    return "concat_ws(' | ', " + ", ".join(f"'{label}: ' || coalesce({c}, '0h 00m')" for label, c in parts.items()) + ")"


# The labels of the duration columns, by group.
SUMMARY = f"""
SELECT company_id, employee_id, employee, CAST("date" AS DATE) AS work_date, {clock('"start"')} AS start_time,
       {clock('first_arrival_time')} AS first_arrival_time, {clock('"end"')} AS end_time,
       paid_idle, paid_driving, job_hrs,
       {_labelled({"C643I/O": "c643i_o", "C688I/O": "c688i_o", "C1017I/O": "c1017i_o", "C1244I/O": "c1244i_o",
                   "C31I/O": "c31i_o", "C1360I/O": "c1360i_o", "C657I/O": "c657i_o"})} AS codes_clock_in_out,
       {_labelled({"Manager Exception": "manager_exception", "HR Orientation": "hr_orientation"})} AS codes_paid,
       {_labelled({"Holiday": "holiday", "Office Sick Time": "office_sick_time", "Vacation": "vacation",
                   "PTO Office": "pto_office"})} AS codes_paid_time_off,
       {_labelled({"Temp C/O": "temp_c_o", "Meal": "meal", "Sick": "sick", "Unavab": "unavab", "EMS": "ems",
                   "Morning Meeting": "morning_meeting"})} AS codes_unpaid,
       unpaid_time_off, hours_worked, regular, overtime, double_ot, paid_time_off, payroll_id
FROM d_technician_timesheet_summary
"""

GROSS_PAY = f"""
SELECT * REPLACE ({instant('started_on')} AS started_on, {instant('ended_on')} AS ended_on) FROM d_gross_pay_items
"""


def _relabelled(sql: str, labels: dict[str, str]) -> str:
    shown = ", ".join(f'{c} AS "{label}"' for label, c in labels.items())
    return f"SELECT company_id, {shown} FROM ({sql}) rows"


_BLANKS = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)

ORACLES: dict[str, str] = {
    # Jobs
    "technicians_employees": PEOPLE,
    "timestamp_base": TIMESTAMP_BASE,
    "wip_appointments": WIP,
    "job_technicians": JOB_TECHNICIANS,
    "invoiced_items": INVOICED,
    "sales_master_tracker": SALES_MASTER,
    "tech_dispatch_report": DISPATCH,
    "timesheet_summary": SUMMARY,
    "gross_pay_items": GROSS_PAY,
    # The same with every lookup join on the split path
    "timestamp_base_split": TIMESTAMP_BASE,
    "job_technicians_split": JOB_TECHNICIANS,
    "invoiced_items_split": INVOICED,
    "sales_master_split": SALES_MASTER,
    # The same with sets of ids that cut little or nothing
    "sales_master_full_sets": SALES_MASTER,
    "sales_master_no_sets": SALES_MASTER,
    "invoiced_items_no_sets": INVOICED,
    # Reports with the published labels
    "invoiced_items_report": _relabelled(INVOICED, display.INVOICED_ITEMS),
    "sales_master_report": _relabelled(SALES_MASTER, display.SALES_MASTER_TRACKER),
    "tech_dispatch_labelled": _relabelled(DISPATCH, display.TECH_DISPATCH_REPORT),
    "timesheet_summary_labelled": _relabelled(SUMMARY, display.TECHNICIAN_TIMESHEET_SUMMARY),
    "timestamp_base_sorted": f"SELECT * FROM ({TIMESTAMP_BASE}) x ORDER BY source NULLS FIRST, emp_name NULLS FIRST, id, company_id",
    "wip_appointments_sorted": f"SELECT * FROM ({WIP}) x ORDER BY job_id NULLS FIRST",
    # Parts of the jobs
    "past_appointments": PAST,
    "next_appointments": NEXT,
    "split_technicians": f"""SELECT company_id, job_id, array_to_string(splitting, ', ') AS assigned_technicians_split,
        largest AS pt_split_desc, largest_share AS max_split FROM ({TECHNICIANS}) x WHERE splitting IS NOT NULL""",
    "assigned_technicians": f"""SELECT company_id, job_id, array_to_string(assigned, ', ') AS assigned_technicians2,
        earliest AS primary_technician2, share_of_earliest AS pt_appt_split FROM ({TECHNICIANS}) x WHERE assigned IS NOT NULL""",
    "sold_hours_by_job": SOLD_HOURS,
    "invoice_total_by_job": INVOICE_TOTAL,
    "lead_invoice_total": f"""SELECT j.company_id, j.id AS lead_job_id, j.job_generated_lead_source_job_id AS job_id,
        il.total_invoice AS sub_total_lead
        FROM d_job j LEFT JOIN ({INVOICE_TOTAL}) il
          ON il.job_id = j.job_generated_lead_source_job_id AND il.company_id = j.company_id
        WHERE j.job_generated_lead_source_job_id IS NOT NULL""",
    "sold_estimates_by_job": SOLD_ESTIMATES,
    "installed_estimates_by_job": INSTALLED,
    "lead_sales_by_parent": LEAD_SALES,
    "lead_ids_by_parent": LEAD_IDS,
    "lead_jobs": """SELECT j.company_id, j.job_generated_lead_source_job_id AS parent_job_id, j.id AS job_id,
        j.job_generated_lead_source_employee_id AS employee_id, t.name AS technician_name
        FROM d_job j LEFT JOIN d_technician t
          ON t.id = j.job_generated_lead_source_employee_id AND t.company_id = j.company_id
        WHERE j.job_generated_lead_source_job_id IS NOT NULL""",
    "lead_summary_by_parent": """SELECT j.company_id, j.job_generated_lead_source_job_id AS parent_job_id,
        count(j.id) AS lead_count, array_to_string(list_sort(list(DISTINCT trim(t.name))), ', ') AS created_by
        FROM d_job j LEFT JOIN d_technician t
          ON t.id = j.job_generated_lead_source_employee_id AND t.company_id = j.company_id
        WHERE j.job_generated_lead_source_job_id IS NOT NULL
        GROUP BY j.company_id, j.job_generated_lead_source_job_id""",
    "purchase_order_total_by_job": f"""SELECT company_id, job_id, {money('sum(total)')} AS purchase_order_total
        FROM d_purchase_order GROUP BY company_id, job_id""",
    "return_total_by_job": f"""SELECT company_id, job_id, {money('sum(return_amount)')} AS returns_amount_total
        FROM d_return GROUP BY company_id, job_id""",
    "paid_hours_by_job": PAID_HOURS,
    # The packaged readers, over tables written from the test tables
    "people_partitioned": PEOPLE,
    "people_tenant_roots": PEOPLE,
    "invoiced_items_partitioned": INVOICED,
    "invoiced_items_tenant_roots": INVOICED,
    "invoiced_items_buckets": INVOICED,
    "invoiced_items_ranges": INVOICED,
    "installed_estimates_buckets": INSTALLED,
    "wip_appointments_ranges": WIP,
    "published_people": f"""SELECT * FROM ({PEOPLE}) p WHERE company_id = 3 OR (company_id = 1 AND emp_type = 'Employee')""",
    "repeated_ids": """SELECT 'technician' AS "table", company_id, id, CASE WHEN id % 14 = 0 THEN 3 ELSE 2 END::BIGINT AS rows
        FROM d_technician WHERE id % 7 = 0""",
    # Operators on the test tables as they are
    "lookup_join": """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_name, p_brand
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "lookup_join_split": """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_name, p_brand
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""",
    "lookup_join_split_inner": """SELECT event_id, user_id, event_type, s_name
        FROM events JOIN supplier ON s_suppkey = user_id""",
    "lookup_join_two_keys": """SELECT s.company_id, s.job_id, s.technician_id, s.split, b.assignments
        FROM d_job_split s LEFT JOIN (SELECT company_id, job_id, technician_id, count(*) AS assignments
            FROM d_appointment_assignment WHERE active GROUP BY company_id, job_id, technician_id) b
          ON b.company_id = s.company_id AND b.job_id = s.job_id AND b.technician_id = s.technician_id""",
    "lookup_join_equal_rows": """SELECT n_name, l_returnflag, count(*) AS lines
        FROM lineitem LEFT JOIN nation ON n_nationkey = l_linenumber GROUP BY ALL""",
    "id_bitmap_cut": """SELECT x.company_id, x.invoice_id, x.sku_name, i.job_id FROM d_invoice_item x
        JOIN d_invoice i ON i.id = x.invoice_id AND i.company_id = x.company_id
        JOIN d_job j ON j.id = i.job_id AND j.company_id = i.company_id WHERE j.job_status = 'Scheduled'""",
    "id_bitmaps": """SELECT count(DISTINCT o_orderkey // 32768) AS ranges, count(DISTINCT o_orderkey) AS ids FROM orders""",
    "hot_users": """SELECT user_id, count(*) AS events FROM events GROUP BY user_id""",
    "merge_on_key": """SELECT coalesce(a.person_id, b.person_id) AS person_id, a.sales, b.events
        FROM (SELECT l_suppkey AS person_id, count(*) AS sales FROM lineitem GROUP BY l_suppkey) a
        FULL OUTER JOIN (SELECT user_id AS person_id, count(*) AS events FROM events GROUP BY user_id) b
          ON a.person_id = b.person_id""",
    "self_join": """SELECT c.company_id, c.id AS lead_job_id, p.id AS parent_job_id, p.job_status AS parent_status
        FROM d_job c JOIN d_job p ON p.id = c.job_generated_lead_source_job_id AND p.company_id = c.company_id""",
    "child_rollup": """SELECT o_custkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey""",
    "rollup_where": """SELECT o_orderpriority, count(*) AS orders, min(o_orderdate) AS first_order,
        max(o_orderdate) AS last_order FROM orders WHERE o_orderstatus NOT IN ('F') GROUP BY o_orderpriority""",
    "first_per_group": """SELECT l_orderkey, l_partkey, l_suppkey FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC NULLS LAST,
            l_shipdate NULLS FIRST, l_partkey, l_suppkey) AS rn FROM lineitem) x WHERE rn = 1""",
    "first_nan": """SELECT l_orderkey, l_partkey, l_suppkey FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY
            CASE WHEN l_linenumber = 3 THEN 'NaN'::DOUBLE WHEN l_linenumber <> 5 THEN l_extendedprice END DESC NULLS LAST,
            l_partkey, l_suppkey) AS rn FROM lineitem) x WHERE rn = 1""",
    "latest_per_group": """SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) AS rn
        FROM events) x WHERE rn = 1""",
    "top_n_per_group": """SELECT o_custkey, o_orderkey, rn FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
        FROM orders) x WHERE rn <= 3""",
    "distinct_list": """SELECT l_suppkey, array_to_string(list_sort(list(DISTINCT trim(l_returnflag || l_linestatus))), ', ')
        AS flags FROM lineitem GROUP BY l_suppkey""",
    "ordered_text": """SELECT o_custkey, array_to_string(list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey), ', ')
        AS order_ids FROM orders GROUP BY o_custkey""",
    "explode_keep": f"""SELECT w.company_id, w.job_id, s.slot FROM ({WIP}) w
        LEFT JOIN (SELECT company_id, job_id, start_appointment AS slot FROM ({NEXT}) n
                   UNION ALL SELECT company_id, job_id, next_appointment FROM ({NEXT}) n
                   WHERE next_appointment IS NOT NULL) s
          ON s.company_id = w.company_id AND s.job_id = w.job_id""",
    "stack": """SELECT 'Customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
        UNION ALL SELECT 'Supplier', s_suppkey, s_name, CAST(NULL AS VARCHAR) FROM supplier""",
    "tenant_union": """SELECT CAST(1 AS BIGINT) AS company_id, c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer
        UNION ALL SELECT 2, s_suppkey, s_name, s_acctbal FROM supplier
        UNION ALL SELECT 3, p_partkey, p_name, CAST(NULL AS DOUBLE) FROM part""",
    # Functions on the test tables as they are
    "optional_column": """SELECT id, 'with' AS source, business_unit_id FROM d_employee
        UNION ALL SELECT id, 'without', CAST(NULL AS BIGINT) FROM d_employee""",
    "json_value": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        json_extract_string(props, '$.missing') AS missing FROM events""",
    "local_times": f"""SELECT e.event_id, z.company_id, {local('e.ts')} AS local_ts, CAST({local('e.ts')} AS DATE) AS local_day,
        year({local('e.ts')}) AS local_year
        FROM events e JOIN d_tenant z ON z.company_id = e.event_id % 3 + 1""",
    "local_year_filter": f"""SELECT j.company_id, j.id, CAST({local('j.completed_on')} AS DATE) AS completion_date
        FROM d_job j JOIN d_tenant z ON z.company_id = j.company_id
        WHERE year({local('j.completed_on')}) BETWEEN {PARAMS.year_lo} AND {PARAMS.year_hi}""",
    "day_split": f"""SELECT company_id, job_id, start, CASE WHEN CAST(start AS DATE) < {AS_OF} THEN 'past'
        WHEN CAST(start AS DATE) >= {AS_OF} THEN 'future' END AS half FROM d_appointment""",
    "minutes_between": """SELECT id, date_diff('minute', dispatched_on, done_on) AS minutes FROM d_timesheet""",
    "parse_clock": f"""SELECT company_id, job_number, start_time AS raw, {clock('start_time')} AS clock
        FROM d_tech_dispatch_report""",
    "parse_ts_fallback": f"""SELECT id, started_on AS raw, {instant('started_on')} AS started_on FROM d_gross_pay_items""",
    "unicode_trim": f"""SELECT doc_id, trim(text, {_BLANKS}) AS text FROM documents""",
    "clean_text": """SELECT doc_id, regexp_replace(text, '[^0-9:a-zA-Z]', ' ', 'g') AS text FROM documents""",
    "labelled_list": """SELECT event_id,
        coalesce(nullif(array_to_string([v FOR v IN [
            'Type: ' || CASE WHEN event_type <> 'view' THEN event_type END,
            'User: ' || CASE WHEN event_type <> 'view' THEN CAST(user_id AS VARCHAR) END] IF v IS NOT NULL], ' | '), ''), '-')
        AS parts FROM events""",
    "array_functions": """SELECT o_orderkey, array_to_string([v FOR v IN [o_orderstatus,
            CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END] IF v IS NOT NULL], ', ') AS kept,
        CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS first_or_null,
        array_to_string(coalesce(CASE WHEN o_custkey % 2 = 0 THEN [o_orderpriority] END, []), ', ') AS list_or_empty
        FROM orders""",
    "rounded_money": """SELECT l_orderkey, l_linenumber, l_partkey,
        CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(28,2)) AS discount,
        round(CAST(l_linenumber AS DOUBLE) / 60, 4) AS share FROM lineitem""",
    "three_valued_filters": """SELECT company_id, invoice_id, type, price FROM d_invoice_item
        WHERE active IS TRUE AND type NOT IN ('Material', 'Equipment')""",
}


def oracle_sql() -> dict[str, str]:
    return {name: oracle(sql) for name, sql in ORACLES.items()}
