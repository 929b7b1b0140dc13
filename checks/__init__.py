"""Registered queries over the driver tables and their DuckDB equivalents."""

from checks.base import ORACLE, QUERIES  # noqa: F401
from checks import points  # noqa: F401,E402
from checks import quality  # noqa: F401,E402
from checks import ingest, storage, reshape, streams  # noqa: F401,E402
