"""Unions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(*parts: DataFrame) -> DataFrame:
    """UNION ALL of equally named columns; duplicates stay."""
    return reduce(DataFrame.unionByName, parts)


def union_tenants(parts: Mapping[int, DataFrame]) -> DataFrame:
    """The same table of several tenants as one, tagged with ``company_id``. A column that some
    tenants lack is NULL there."""
    tagged = [df.withColumn("company_id", F.lit(cid).cast("bigint")) for cid, df in sorted(parts.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
