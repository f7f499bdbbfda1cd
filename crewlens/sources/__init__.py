"""Where the jobs read from, and how tables are stored for them."""

from crewlens.sources.layout import write_buckets, write_ranges
from crewlens.sources.registry import Sources
from crewlens.sources.schemas import SCHEMAS

__all__ = ["SCHEMAS", "Sources", "write_buckets", "write_ranges"]
