"""Independent SQL for every query, for an engine that reads the same files."""

from lumenmart.oracle.build import oracle_queries  # noqa: F401
