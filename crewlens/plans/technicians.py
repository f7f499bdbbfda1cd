"""Technicians per job: the assigned ones and the primary one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crewlens.functions import join_text, typed_null, utrim
from crewlens.operators import HotKeys, lookup_join, rollup, stack
from crewlens.params import Params
from crewlens.plans.people import technicians_employees
from crewlens.plans.scope import Scope, within
from crewlens.sources import Sources

# The tenant comes second: Spark compares sort keys by their first column, and there are few tenants.
PERSON = ["technician_id", "company_id"]


# An order key of a split: its value falling, then its time rising, NULL values last and NULL times first.
# One decimal of fixed width, so that pairs are grouped in a hash table and not sorted.
_SCALE, _LEAST_TIME, _MOST_SPLIT = "10000000000000000000", -(10**18), 10**18


def _time_key(column: str) -> Column:
    """Microseconds; the earliest of all for NULL."""
    return F.coalesce(F.unix_micros(F.col(column).cast("timestamp")), F.lit(_LEAST_TIME)).cast("decimal(19,0)")


def _split_key() -> Column:
    units = F.coalesce(-(F.col("split") * 10000).cast("decimal(19,0)"), F.lit(_MOST_SPLIT).cast("decimal(19,0)"))
    return (units * F.lit(_SCALE).cast("decimal(20,0)")).cast("decimal(38,0)") + _time_key("created_on").cast("decimal(38,0)")


def _directory(src: Sources, params: Params) -> DataFrame:
    """Per person id the trimmed names in the whole directory and those of technicians only: one row per
    id, so that joining it adds no rows."""

    def named(people: DataFrame, person: bool) -> DataFrame:
        name = utrim(F.coalesce("name", F.lit("")))
        return people.select("company_id", F.col("id").alias("technician_id"), name.alias("name"), F.lit(person).alias("person"))

    both = stack(named(technicians_employees(src, params), True), named(src.table("technician_copy"), False))
    return rollup(
        both,
        PERSON,
        {
            "person_names": F.collect_set(F.when(F.col("person"), F.col("name"))),
            "technician_names": F.collect_set(F.when(~F.col("person"), F.col("name"))),
        },
    )


def _facts(src: Sources, assigned: bool) -> DataFrame:
    """Splits, and active assignments if they are asked for, with the same columns."""
    splits = src.table("job_split").select(
        "company_id",
        "job_id",
        "technician_id",
        F.lit(False).alias("is_assignment"),
        typed_null("timestamp_ntz").alias("assigned_on"),
        F.col("split").cast("decimal(18,4)").alias("split"),
        "created_on",
    )
    if not assigned:
        return splits
    assignments = src.table("appointment_assignment").where("active").select(
        "company_id",
        "job_id",
        "technician_id",
        F.lit(True).alias("is_assignment"),
        "assigned_on",
        typed_null("decimal(18,4)").alias("split"),
        typed_null("timestamp_ntz").alias("created_on"),
    )
    return stack(assignments, splits)


def _pairs(facts: DataFrame, null_jobs: bool) -> DataFrame:
    """One row per job and technician.

    Both facts are stacked and grouped once. All that the outcome needs of a pair is its first
    assignment and its best split, so repeated pairs never multiply, and no join between the two
    facts is left.
    """
    is_assignment = F.col("is_assignment")
    if null_jobs:
        # A NULL job matches no other NULL job: its two sides stay apart.
        facts = facts.withColumn("side", F.when(F.col("job_id").isNull(), is_assignment))
    else:
        facts = facts.where(F.col("job_id").isNotNull())
    return rollup(
        facts,
        ["job_id", "technician_id", "company_id", *_side(null_jobs)],
        {
            # NULL without a row of that side; a NULL time still counts, and counts as the earliest.
            "first_assigned": F.min(F.when(is_assignment, _time_key("assigned_on"))),
            "best_split": F.min(F.when(~is_assignment, _split_key())),
            "split": F.max("split"),
        },
    )


def _side(null_jobs: bool) -> list[str]:
    return ["side"] if null_jobs else []


def _or_unnamed(names: Column) -> Column:
    # An unknown or nameless technician counts as '', never as NULL.
    return F.when(F.size(F.coalesce(names, F.array().cast("array<string>"))) > 0, names).otherwise(F.array(F.lit("")))


def _by_job(
    src: Sources, params: Params, null_jobs: bool = True, assigned: bool = True, jobs: Scope | None = None
) -> DataFrame:
    """Both sides per job: names and the pick of each. A side without rows is NULL."""
    facts = within(_facts(src, assigned), jobs)
    # The facts are counted, as pairs would have to be made twice: a bucket that is not hot among them holds few pairs too.
    hot = HotKeys(facts, [PERSON], params.join)
    pairs = lookup_join(_pairs(facts, null_jobs), _directory(src, params), PERSON, tuning=params.join, hot=hot, distinct_rows=True)
    # Dealt by job as they are: lists made before the shuffle would hold as much and be merged again after it.
    pairs = pairs.repartition("job_id", "company_id")

    # Assignments are named after the whole directory, splits after technicians only.
    person_names = _or_unnamed(F.col("person_names"))
    technician_names = _or_unnamed(F.col("technician_names"))
    is_assigned, is_split = F.col("first_assigned").isNotNull(), F.col("best_split").isNotNull()
    # A NULL technician matches no split row.
    own_split = F.when(F.col("technician_id").isNotNull(), F.col("split"))
    return rollup(
        pairs,
        ["job_id", "company_id", *_side(null_jobs)],
        {
            # Pairs are distinct, so a list holds at most one entry per technician.
            "assigned_names": F.collect_list(F.when(is_assigned, person_names)),
            "assigned_pick": F.min(
                F.when(
                    is_assigned,
                    F.struct(
                        F.col("first_assigned"),
                        F.array_min(person_names).alias("name"),
                        own_split.isNull().alias("none"),
                        (-own_split).alias("down"),
                    ),
                )
            ),
            "split_names": F.collect_list(F.when(is_split, technician_names)),
            "split_pick": F.min(
                F.when(is_split, F.struct("best_split", F.array_min(technician_names).alias("name")))
            ),
            "max_split": F.max(F.when(is_split, F.col("split"))),
        },
    )


def _list(names: str) -> Column:
    return F.sort_array(F.array_distinct(F.flatten(F.col(names))))


def split_technicians(src: Sources, params: Params = Params()) -> DataFrame:
    """Per job, from splits: all names, the technician with the largest split, and that split."""
    return (
        _by_job(src, params, assigned=False)
        .where(F.col("split_pick").isNotNull())
        .select(
            "company_id",
            "job_id",
            join_text(_list("split_names")).alias("assigned_technicians_split"),
            F.col("split_pick.name").alias("pt_split_desc"),
            "max_split",
        )
    )


def assigned_technicians(src: Sources, params: Params = Params()) -> DataFrame:
    """Per job, from active assignments: all names, the first assigned technician and their split."""
    return (
        _by_job(src, params)
        .where(F.col("assigned_pick").isNotNull())
        .select(
            "company_id",
            "job_id",
            join_text(_list("assigned_names")).alias("assigned_technicians2"),
            F.col("assigned_pick.name").alias("primary_technician2"),
            (-F.col("assigned_pick.down")).alias("pt_appt_split"),
        )
    )


def job_technicians(
    src: Sources, params: Params = Params(), *, null_jobs: bool = True, jobs: Scope | None = None
) -> DataFrame:
    """Per job: the list of assigned technicians (of assignments if there are any, else of splits)
    and the primary one: the first assigned, unless their split is below the largest split of the
    job, which then decides.

    Rows without a job give one row per side. For a join on the job they are of no use: without them
    (``null_jobs=False``) the result is grouped by the job alone and is not shuffled again.
    """
    first, best = F.col("assigned_pick.name"), F.col("split_pick.name")
    zero = F.lit(0).cast("decimal(18,4)")
    holds_largest = F.coalesce(-F.col("assigned_pick.down"), zero) >= F.coalesce("max_split", zero)
    primary = (
        F.when(F.col("assigned_pick").isNull(), best)
        .when(holds_largest, first)
        .otherwise(F.coalesce(best, first))
    )
    names = F.when(F.col("assigned_pick").isNotNull(), _list("assigned_names")).otherwise(_list("split_names"))
    return _by_job(src, params, null_jobs, jobs=jobs).select(
        "company_id",
        "job_id",
        join_text(names).alias("assigned_technicians"),
        primary.alias("primary_technician"),
    )
