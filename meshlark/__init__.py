"""A property-graph query engine on PySpark: typed resources over DataFrames, traversals as joins."""

import sys

from pyspark import cloudpickle

from .plans.expr import attr, calc, ci, exists, func, traverse
from .plans.query import Query, combine, ordered
from .schema import Aggregate, Attribute, Calculation, Domain, Guard, Relationship, Resource
from .sources.graph import Graph

__all__ = ["Aggregate", "Attribute", "Calculation", "Domain", "Graph", "Guard", "Query", "Relationship", "Resource", "attr", "calc", "ci", "combine", "exists", "func", "ordered", "traverse"]

# Functions go to executors whole, which then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
