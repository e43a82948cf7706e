"""Property-graph analytics on Spark DataFrames."""

from graphloom.model.graph import NodeTable, PropertyGraph, RelTable
from graphloom.model.schema import GraphSchema
from graphloom.operators.patterns import Match
from graphloom.sources.catalog import GraphCatalog

__all__ = ["GraphCatalog", "GraphSchema", "Match", "NodeTable", "PropertyGraph", "RelTable"]
