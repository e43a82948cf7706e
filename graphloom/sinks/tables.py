"""Graphs and query results as catalog tables and files."""

from __future__ import annotations

import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from graphloom.errors import GraphSchemaError
from graphloom.model.graph import ID, SOURCE, TARGET, NodeTable, PropertyGraph, RelTable, quoted
from graphloom.operators.patterns import IN, OUT
from graphloom.sources.graph_files import WRITERS, canonical_nodes, canonical_relationships, folder_name, property_columns

# Fixed value: format of saved results unless another is given.
RESULT_FORMAT = "parquet"


_REVERSE = "_in"


def _plain(name: str) -> str:
    return re.sub(r"\W", "_", name).lower()


def save_graph_tables(
    graph: PropertyGraph, name: str, database: str, format: str = RESULT_FORMAT, buckets: int | None = None, reverse: bool = False
) -> list[str]:
    """Write every table of a graph to the catalog, replacing those there: `name_vertex_label`,
    `name_edge_type`. Gives the table names.

    With `buckets`, nodes are bucketed and sorted by id and relationships by source, so that following
    relationships out of nodes needs no shuffle. With `reverse` too, a second copy of the relationships
    (`name_edge_type_in`) is bucketed by target, for walking in; `read_graph_tables` picks the copy.
    """
    if reverse and buckets is None:
        raise GraphSchemaError("a reverse copy is for bucketed tables")
    graph.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    types = [r.rel_type for r in graph.relationships]
    jobs: list[tuple[str, DataFrame]] = []
    for node in graph.nodes:
        jobs.append((f"{database}.{_plain(f'{name}_vertex_{folder_name(node.labels)}')}", canonical_nodes(node)))
    for rel in graph.relationships:
        table = f"{name}_edge_{folder_name([rel.rel_type])}"
        if types.count(rel.rel_type) > 1:
            table += f"_{folder_name(rel.source_labels)}_{folder_name(rel.target_labels)}"
        jobs.append((f"{database}.{_plain(table)}", canonical_relationships(rel)))
        if reverse:
            jobs.append((f"{database}.{_plain(table)}{_REVERSE}", canonical_relationships(rel)))
    names = [n for n, _ in jobs]
    if len(set(names)) < len(names):
        raise GraphSchemaError(f"tables would share a name: {sorted(n for n in names if names.count(n) > 1)}")
    with ThreadPoolExecutor(WRITERS) as pool:
        writes = [pool.submit(_save, df, table, format, buckets) for table, df in jobs]
    for write in writes:
        write.result()
    return names


def _save(df: DataFrame, table: str, format: str, buckets: int | None) -> None:
    writer = df.write.mode("overwrite").format(format)
    if buckets is not None:
        ends = SOURCE in df.columns and TARGET in df.columns
        key = ID if not ends else TARGET if table.endswith(_REVERSE) else SOURCE
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(table)


def read_graph_tables(graph: PropertyGraph, name: str, database: str, direction: str = OUT) -> PropertyGraph:
    """The graph whose tables `save_graph_tables` has written, with its labels, types and ends. With direction `in`, relationships are
    read from their copies by target, where there are any: walking in then needs no shuffle either."""
    spark, types = graph.spark, [r.rel_type for r in graph.relationships]
    tables: list[NodeTable | RelTable] = []
    for node in graph.nodes:
        saved = spark.table(f"{database}.{_plain(f'{name}_vertex_{folder_name(node.labels)}')}")
        tables.append(NodeTable(node.labels, _as_stored(saved, property_columns(node.properties), [ID])))
    for rel in graph.relationships:
        table = f"{name}_edge_{folder_name([rel.rel_type])}"
        if types.count(rel.rel_type) > 1:
            table += f"_{folder_name(rel.source_labels)}_{folder_name(rel.target_labels)}"
        copy = f"{database}.{_plain(table)}{_REVERSE}"
        saved = spark.table(copy if direction == IN and spark.catalog.tableExists(copy) else f"{database}.{_plain(table)}")
        saved = _as_stored(saved, property_columns(rel.properties), [ID, SOURCE, TARGET])
        tables.append(RelTable(rel.rel_type, saved, rel.source_labels, rel.target_labels))
    return PropertyGraph.from_tables(*tables, spark=spark)


def _as_stored(saved: DataFrame, columns: Mapping[str, str], fixed: list[str]) -> DataFrame:
    """Stored columns under the names of their properties."""
    return saved.select(*fixed, *[quoted(stored).alias(p) for p, stored in columns.items()])


def drop_graph_tables(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def save_result(df: DataFrame, folder: str, name: str, format: str = RESULT_FORMAT) -> str:
    """Write a query result to `folder/name.format`, replacing what is there. Gives the path.
    `avro` works where Spark has its Avro package."""
    path = f"{folder.rstrip('/')}/{name}.{format}"
    df.write.mode("overwrite").format(format).save(path)
    return path


def save_as_table(df: DataFrame, view: str, table: str) -> None:
    """Give a result a view name, and make a managed table of that view."""
    df.createOrReplaceTempView(view)
    df.sparkSession.sql(f"CREATE TABLE {table} AS SELECT * FROM {view}")


def materialize(df: DataFrame, table: str, folder: str, format: str = RESULT_FORMAT) -> str:
    """A table defined by a query: its result is saved, and an external table reads the saved files.
    Running it again refreshes the table. Gives the schema as JSON."""
    path = save_result(df, folder, table.replace(".", "_"), format)
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.catalog.createTable(table, path=path, source=format, schema=df.schema)
    return df.schema.json()


def as_rows(df: DataFrame, kind: type | None = None):
    """Result rows one partition at a time, as `Row` or as objects of a class with matching fields."""
    for row in df.toLocalIterator():
        yield row if kind is None else kind(**row.asDict())


def non_null_properties(row: Row) -> dict:
    """A returned node or relationship as a dictionary, leaving out the properties it does not have."""
    entity = row.asDict(recursive=True)
    entity["properties"] = {k: v for k, v in (entity.get("properties") or {}).items() if v is not None}
    return entity


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
