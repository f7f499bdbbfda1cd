"""The jobs that a report is about, so that facts of other jobs are cut where they are read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from crewlens.operators import IdSet
from crewlens.params import Params

# The tenant comes second: Spark compares sort keys by their first column, and there are few tenants.
KEYS = ["job_id", "company_id"]


class Scope(IdSet):
    """Some rows' ids per tenant (``ids`` has ``company_id`` and ``column``). What is summed for a scope may hold other
    rows too (see ``IdSet``): it is joined to the rows of the scope."""

    def __init__(self, ids: DataFrame, params: Params, column: str = "job_id"):
        super().__init__(ids, column, params.join)


def within(fact: DataFrame, scope: Scope | None, column: str | None = None) -> DataFrame:
    """``fact`` cut to a scope, if there is one."""
    return fact if scope is None else scope.cut(fact, column)
