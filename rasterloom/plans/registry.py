"""Registry of the queries over the driver's tables and of their SQL."""

from . import batch_queries, export_queries, marker_queries, object_queries, quality_queries, raster_queries, result_queries, source_queries  # noqa: F401
from ._register import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
