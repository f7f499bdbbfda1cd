"""Field-service reporting jobs as lazy Spark DataFrames, all tenants in one plan."""

from crewlens.params import Params
from crewlens.sources import Sources

__all__ = ["Params", "Sources"]
