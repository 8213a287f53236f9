"""Every operator bound to the driver tables, each with the SQL it must agree with."""

from quotelake.plans.catalog import analyses, columns, feeds_and_entities, files, relational, time_series  # noqa: F401
from quotelake.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
