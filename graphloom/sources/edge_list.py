"""Graphs from plain edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.model.graph import NodeTable, PropertyGraph, RelTable
from graphloom.operators.ids import generated_id

# Label and type in a graph read from an edge list.
NODE_LABEL = "V"
REL_TYPE = "E"


def graph_of_edges(edges: DataFrame) -> PropertyGraph:
    """Graph of rows `source, target`, with `id` if there is one; nodes are the different ends.

    Both ends are taken off one scan, and repetitions are dropped before the shuffle.
    """
    rels = edges if "id" in edges.columns else edges.select(generated_id().alias("id"), "source", "target")
    nodes = edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()
    return PropertyGraph.from_tables(
        NodeTable(NODE_LABEL, nodes), RelTable(REL_TYPE, rels, [NODE_LABEL], [NODE_LABEL])
    )


def edge_list_graph(spark: SparkSession, path: str, **options) -> PropertyGraph:
    """Graph of text files with a source and a target number per line; options as for reading CSV,
    with a space as the default separator."""
    edges = spark.read.options(**{"sep": " ", **options}).schema("source bigint, target bigint").csv(path)
    return graph_of_edges(edges)
