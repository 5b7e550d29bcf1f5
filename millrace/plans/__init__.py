"""Registered queries.  Importing the package fills the registry."""

from millrace.plans import ingest, rows, scalars, state, tables, windows  # noqa: F401, I001
from millrace.plans import streams  # noqa: F401  (uses the SQL of the others)
from millrace.plans.registry import QUERIES, SQL  # noqa: F401
