"""treeflat: semi-structured XML records to clean relational tables, on Spark."""

from treeflat.plans.contracts import Contracts, Field
from treeflat.plans.mapping import Mapping

__all__ = ["Contracts", "Field", "Mapping"]
