"""All registered queries; importing the package fills the registry."""

from sembra.catalog import analysis, caching, clusters, flows, search, text  # noqa: F401
from sembra.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
