"""Checked queries by family; importing this package registers them."""

from tidemark.plans import catalog, jobs, lineage, loads, protection, relational, reports, scalars  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES, Tables  # noqa: F401
