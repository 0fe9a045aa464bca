"""The registered queries over the driver tables and their SQL checks."""

from orebed.catalogue import files, itemsets, ratings, recommend, reviews, similarity  # noqa: F401
from orebed.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
