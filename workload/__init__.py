"""The library's operators run over the TPC-H-like tables, each with a SQL twin."""

from . import bi, ingest, masters, star_queries, warehouse  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
