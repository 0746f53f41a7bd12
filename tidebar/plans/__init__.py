"""The library's operators applied to the test tables, by id, with SQL for each."""

from . import asof, bars, builds, catalog, golden, keys, payloads, projection, reads, rules, storage, validation  # noqa: F401
from . import second  # noqa: F401, E402, I001  over the texts of catalog
from .base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
