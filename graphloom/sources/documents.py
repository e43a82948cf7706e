"""Graphs in a document collection: vertex and edge documents with lists of properties."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphNotFoundError
from graphloom.model.graph import NodeTable, PropertyGraph, RelTable
from graphloom.model.types import java_class_type
from graphloom.operators import metadata
from graphloom.operators.documents import EDGE_DOCUMENT, FIRST, VERTEX_DOCUMENT, explode_edges, explode_vertices
from graphloom.operators.updates import live, upsert

VERTEX, EDGE = "vertex", "edge"


class DocumentStore:
    """Vertex and edge documents of any number of datasources.

    Collections laid out in folders by `datasource` and `label` are read only where a scan asks for
    them; otherwise the conditions are pushed to the files.
    """

    def __init__(self, vertices: DataFrame, edges: DataFrame):
        self._documents = {VERTEX: vertices, EDGE: edges}
        self._types: dict[tuple[str, str], dict[str, dict[str, T.DataType]]] = {}

    @classmethod
    def read(
        cls, spark: SparkSession, vertex_path: str, edge_path: str, format: str = "parquet", **options
    ) -> DocumentStore:
        """Documents in files, or in anything else Spark has a connector for."""

        def load(path: str, schema: T.StructType) -> DataFrame:
            with_mark = T.StructType([*schema.fields, T.StructField("deleted", T.StringType())])
            return spark.read.format(format).options(**options).schema(with_mark).load(path)

        return cls(load(vertex_path, VERTEX_DOCUMENT), load(edge_path, EDGE_DOCUMENT))

    # -- scans ------------------------------------------------------------------------------------

    def _scan(self, kind: str, datasource: str, labels: str | Iterable[str] | None) -> DataFrame:
        docs = self._documents[kind].where(F.col("datasource") == datasource)
        docs = live(docs) if "deleted" in docs.columns else docs
        if labels is None:
            return docs
        names = [labels] if isinstance(labels, str) else list(labels)
        return docs.where(F.col("label") == names[0] if len(names) == 1 else F.col("label").isin(names))

    def vertices(self, datasource: str, labels: str | Iterable[str] | None = None) -> DataFrame:
        return self._scan(VERTEX, datasource, labels)

    def edges(self, datasource: str, labels: str | Iterable[str] | None = None) -> DataFrame:
        return self._scan(EDGE, datasource, labels)

    def count(self, datasource: str) -> int:
        """Vertices and edges of a datasource together."""
        return self.vertices(datasource).select("id").unionAll(self.edges(datasource).select("id")).count()

    # -- metadata ---------------------------------------------------------------------------------

    def datasources(self) -> DataFrame:
        return metadata.datasource_sizes(self._documents[VERTEX], self._documents[EDGE])

    def labels(self, datasource: str) -> DataFrame:
        """`kind, datasource, label, n`."""
        found = [
            metadata.labels(docs, datasource).select(F.lit(kind).alias("kind"), "datasource", "label", "n")
            for kind, docs in self._documents.items()
        ]
        return found[0].unionAll(found[1])

    def key_types(self, datasource: str, label: str, kind: str = VERTEX) -> DataFrame:
        return metadata.key_types(self._documents[kind], datasource, label)

    def scan(self) -> DataFrame:
        return metadata.scan(self._documents[VERTEX], self._documents[EDGE])

    def _column_types(self, kind: str, datasource: str) -> dict[str, dict[str, T.DataType]]:
        """Label -> key -> type. Types are as many as the schema has, and are looked up once."""
        if (kind, datasource) not in self._types:
            for k in (VERTEX, EDGE):
                self._types[(k, datasource)] = {}
            for row in metadata.collected(self._scan_types(datasource)):
                keys = self._types[(row["kind"], datasource)].setdefault(row["label"], {})
                if row["key"] is not None:
                    keys[row["key"]] = java_class_type(row["type"])
            for of_kind in ((VERTEX, datasource), (EDGE, datasource)):
                self._types[of_kind] = {k: dict(sorted(v.items())) for k, v in sorted(self._types[of_kind].items())}
        return self._types[(kind, datasource)]

    def _scan_types(self, datasource: str) -> DataFrame:
        return metadata.scan(self._scan(VERTEX, datasource, None), self._scan(EDGE, datasource, None))

    def label_schema(self, datasource: str, label: str, kind: str = VERTEX) -> T.StructType:
        base = [f for f in VERTEX_DOCUMENT.fields if f.name != "properties"]
        keys = self._keys(kind, datasource, label)
        return T.StructType([*base, *[T.StructField(k, t) for k, t in keys.items()]])

    def _keys(self, kind: str, datasource: str, label: str) -> dict[str, T.DataType]:
        known = self._column_types(kind, datasource)
        if label not in known:
            raise GraphNotFoundError(f"datasource '{datasource}' has no {kind} label '{label}'")
        return known[label]

    # -- tables and graphs ------------------------------------------------------------------------

    def read_vertices(self, datasource: str, label: str, repeated: str = FIRST) -> DataFrame:
        """Documents of a label with one typed column per property; `repeated` as in `explode_vertices`."""
        return explode_vertices(self.vertices(datasource, label), self._keys(VERTEX, datasource, label), repeated)

    def read_edges(self, datasource: str, label: str, repeated: str = FIRST) -> DataFrame:
        return explode_edges(self.edges(datasource, label), self._keys(EDGE, datasource, label), repeated)

    def node_table(self, datasource: str, label: str) -> NodeTable:
        return NodeTable(label, self.read_vertices(datasource, label))

    def rel_table(
        self, datasource: str, label: str, source_labels: Iterable[str] = (), target_labels: Iterable[str] = ()
    ) -> RelTable:
        return RelTable(label, self.read_edges(datasource, label), source_labels, target_labels)

    def graph(self, datasource: str, endpoints: Mapping[str, tuple[str, str]] | None = None) -> PropertyGraph:
        """Everything a datasource holds. `endpoints` may name the labels at the two ends of an edge
        label, which the documents do not tell."""
        nodes = [self.node_table(datasource, label) for label in self._column_types(VERTEX, datasource)]
        rels = []
        for label in self._column_types(EDGE, datasource):
            source, target = (endpoints or {}).get(label, (None, None))
            rels.append(self.rel_table(datasource, label, [source] if source else (), [target] if target else ()))
        if not nodes:
            raise GraphNotFoundError(f"no documents of datasource '{datasource}'")
        return PropertyGraph.from_tables(*nodes, *rels)

    def with_changes(self, vertices: DataFrame | None = None, edges: DataFrame | None = None) -> DocumentStore:
        """The store after an upsert of changed documents."""
        changes = {VERTEX: vertices, EDGE: edges}
        return DocumentStore(
            *[docs if changes[k] is None else upsert(docs, changes[k]) for k, docs in self._documents.items()]
        )

    def save(self, root: str, buckets: int | None = None) -> None:
        """Write the documents, deleted ones too, as a new version of the collection under `root` and switch to it. The
        versions before stay until they are cleared, so the documents may have been read from one of them."""
        from graphloom.sources.document_files import write_documents

        write_documents(self._documents, root, buckets)

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> DocumentStore:
        """The current version under `root`."""
        from graphloom.sources.document_files import SavedDocuments

        return SavedDocuments(spark, root)

    # the store as a catalog source: every datasource is a graph

    def graph_names(self) -> list[str]:
        both = [docs.select("datasource") for docs in self._documents.values()]
        return sorted(row["datasource"] for row in metadata.collected(both[0].unionAll(both[1]).distinct()))

    def store(self, name: str, graph: PropertyGraph, overwrite: bool = False) -> None:
        raise NotImplementedError("documents are written with upsert")

    def delete(self, name: str) -> None:
        raise NotImplementedError("documents are deleted with soft_delete")
