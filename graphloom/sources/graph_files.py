"""Graphs stored in folders: one table per label combination and relationship type, plus a schema."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphExistsError, GraphNotFoundError, GraphSchemaError
from graphloom.model.graph import ID, SOURCE, TARGET, NodeTable, PropertyGraph, RelTable, quoted
from graphloom.model.schema import GraphSchema
from graphloom.sources.files import SharedFiles

# Layout of a stored graph.
SCHEMA_FILE = "propertyGraphSchema.json"
TABLES_FILE = "graphTables.json"
NODES_FOLDER = "nodes"
RELS_FOLDER = "relationships"
NO_LABEL_FOLDER = "__NO_LABEL__"
AT_SIGN_ESCAPE = "_specialCharacterEscape_"
WRITERS = 8
_POINTER = "current-"  # and a number: files that each name a version's folder, the last of them the one in use

# Text files hold texts as they are: blanks at the ends, empty texts apart from nulls, and line breaks, which are
# spelled out so that files can still be split at lines. The escapes can be undone one after the other.
NULL_TEXT = "\\N"
TEXT_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))
CSV_OPTIONS = {
    "escape": '"',
    "nullValue": NULL_TEXT,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def folder_name(names: Iterable[str]) -> str:
    """Folder of a label combination or type; characters a path may not hold are spelled out."""
    joined = "_".join(sorted(names))
    return re.sub(r"[^A-Za-z0-9_.-]", lambda m: f"@{ord(m.group()):04x}", joined) or NO_LABEL_FOLDER


def property_columns(properties: Iterable[str]) -> dict[str, str]:
    """Property -> column it is stored in: the lower-cased name. Two names that differ in case only
    would share a column and are refused."""
    columns = {p: p.lower() for p in sorted(properties)}
    taken = [c for c in columns.values()] + [ID, SOURCE, TARGET]
    clash = sorted(p for p, c in columns.items() if taken.count(c) > 1)
    if clash:
        raise GraphSchemaError(f"properties {clash} would share a column")
    return dict(sorted(columns.items(), key=lambda item: item[1]))


def canonical_nodes(node: NodeTable) -> DataFrame:
    """Id first, then the properties in order of their columns."""
    columns = property_columns(node.properties)
    return node.df.select(quoted(ID), *[quoted(p).alias(c) for p, c in columns.items()])


def canonical_relationships(rel: RelTable) -> DataFrame:
    columns = property_columns(rel.properties)
    ends = [quoted(ID), quoted(SOURCE), quoted(TARGET)]
    return rel.df.select(*ends, *[quoted(p).alias(c) for p, c in columns.items()])


# -- what a format cannot hold --------------------------------------------------------------------


def _encoded(df: DataFrame, format: str) -> DataFrame:
    if format == "csv":

        def as_text(field: T.StructField) -> Column:
            column = quoted(field.name)
            if isinstance(field.dataType, T.BinaryType):
                return F.hex(column).alias(field.name)
            if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
                column = F.to_json(column)
            elif not isinstance(field.dataType, T.StringType):
                return column
            for plain, escaped in TEXT_ESCAPES:
                column = F.replace(column, F.lit(plain), F.lit(escaped))
            return column.alias(field.name)

        return df.select([as_text(f) for f in df.schema.fields])
    if format == "orc":
        if any(AT_SIGN_ESCAPE in c for c in df.columns):
            raise GraphSchemaError(f"a column name may not contain '{AT_SIGN_ESCAPE}'")
        return df.toDF(*[c.replace("@", AT_SIGN_ESCAPE) for c in df.columns])
    return df


def _stored_schema(schema: T.StructType, format: str) -> T.StructType:
    """Schema the files of a table have."""
    nested = (T.BinaryType, T.StructType, T.ArrayType, T.MapType)
    return T.StructType(
        [
            T.StructField(
                f.name.replace("@", AT_SIGN_ESCAPE) if format == "orc" else f.name,
                T.StringType() if format == "csv" and isinstance(f.dataType, nested) else f.dataType,
            )
            for f in schema.fields
        ]
    )


def _options(format: str) -> dict[str, str]:
    return CSV_OPTIONS if format == "csv" else {}


def _decoded(df: DataFrame, schema: T.StructType, format: str, escaped: bool) -> DataFrame:
    if format == "orc":
        return df.toDF(*schema.fieldNames())
    if format == "csv":

        def from_text(field: T.StructField) -> Column:
            column = quoted(field.name)
            if isinstance(field.dataType, T.BinaryType):
                return F.unhex(column).alias(field.name)
            nested = isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
            if escaped and (nested or isinstance(field.dataType, T.StringType)):
                for plain, written_as in reversed(TEXT_ESCAPES):
                    column = F.replace(column, F.lit(written_as), F.lit(plain))
            return (F.from_json(column, field.dataType) if nested else column).alias(field.name)

        return df.select([from_text(f) for f in schema.fields])
    return df


# -- the source -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class _StoredTable:
    path: str
    schema: T.StructType
    columns: Mapping[str, str]
    labels: tuple[str, ...] = ()
    rel_type: str | None = None
    source_labels: tuple[str, ...] = ()
    target_labels: tuple[str, ...] = ()

    def to_dict(self) -> dict:
        described = {k: getattr(self, k) for k in self.__dataclass_fields__}
        return {**described, "schema": self.schema.jsonValue()}

    @classmethod
    def from_dict(cls, stored: dict) -> _StoredTable:
        return cls(**{**stored, "schema": T.StructType.fromJson(stored["schema"])})


class GraphFiles:
    """Graphs under one folder, in `csv`, `parquet`, `orc` or another format Spark writes.

    `files_per_table` caps the number of files of a table by a shuffle before the write, so leave it out for
    large graphs. With a `database`, stored tables also become external tables
    of the session catalog.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        format: str = "parquet",
        files_per_table: int | None = None,
        database: str | None = None,
    ):
        self._spark = spark
        self._files = SharedFiles(spark)
        self.root = root.rstrip("/")
        self.format = format
        self.files_per_table = files_per_table
        self.database = database

    def folder(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def _pointers(self, name: str) -> list[str]:
        return [f for f in self._files.files(self.folder(name)) if re.fullmatch(_POINTER + r"\d+", f)]  # drafts are named otherwise

    def _current(self, name: str) -> str:
        """The folder of the version in use: the one that the last pointer names, else the graph's own."""
        pointers = self._pointers(name)
        return f"{self.folder(name)}/{self._files.read_text(f'{self.folder(name)}/{pointers[-1]}')}" if pointers else self.folder(name)

    def graph_names(self) -> list[str]:
        """Graphs that are stored completely: the schema is written last."""
        return [n for n in self._files.folders(self.root) if self._files.exists(f"{self._current(n)}/{SCHEMA_FILE}")]

    def has_graph(self, name: str) -> bool:
        return self._files.exists(f"{self._current(name)}/{SCHEMA_FILE}")

    def schema(self, name: str) -> GraphSchema:
        if not self.has_graph(name):
            raise GraphNotFoundError(f"no graph '{name}' in {self.root}")
        return GraphSchema.from_json(self._files.read_text(f"{self._current(name)}/{SCHEMA_FILE}"))

    # -- reading ----------------------------------------------------------------------------------

    def graph(self, name: str) -> PropertyGraph:
        schema = self.schema(name)
        folder = self._current(name)
        listing = f"{folder}/{TABLES_FILE}"
        own = self._files.exists(listing)
        if own:
            stored = [_StoredTable.from_dict(t) for t in json.loads(self._files.read_text(listing))]
        else:
            stored = self._by_convention(schema)
        tables: list[NodeTable | RelTable] = []
        for table in stored:
            df = self._read(f"{folder}/{table.path}", table.schema, own)
            back = {c: p for p, c in table.columns.items()}
            df = df.select([quoted(c).alias(back.get(c, c)) for c in df.columns])
            if table.rel_type is None:
                tables.append(NodeTable(table.labels, df))
            else:
                tables.append(RelTable(table.rel_type, df, table.source_labels, table.target_labels))
        return PropertyGraph.from_tables(*tables, schema=schema, spark=self._spark)

    def _by_convention(self, schema: GraphSchema) -> list[_StoredTable]:
        """Tables of a graph that comes with a schema only. Ids in text files are text, elsewhere binary."""
        id_type = T.StringType() if self.format == "csv" else T.BinaryType()

        def struct(keys: list[str], properties: Mapping[str, T.DataType]) -> tuple[T.StructType, dict[str, str]]:
            columns = property_columns(properties)
            fields = [T.StructField(k, id_type) for k in keys]
            return T.StructType(fields + [T.StructField(c, properties[p]) for p, c in columns.items()]), columns

        tables = []
        for combo, properties in schema.node_properties.items():
            table_schema, columns = struct([ID], properties)
            tables.append(
                _StoredTable(f"{NODES_FOLDER}/{folder_name(combo)}", table_schema, columns, tuple(sorted(combo)))
            )
        for rel_type, properties in schema.rel_properties.items():
            table_schema, columns = struct([ID, SOURCE, TARGET], properties)
            tables.append(
                _StoredTable(
                    f"{RELS_FOLDER}/{folder_name([rel_type])}", table_schema, columns, rel_type=rel_type
                )
            )
        return tables

    def _read(self, path: str, schema: T.StructType, own: bool) -> DataFrame:
        """`own` tables were written here; text files that come from elsewhere are read as plain text."""
        stored = _stored_schema(schema, self.format)
        options = _options(self.format) if own else {}
        return _decoded(self._spark.read.format(self.format).options(**options).schema(stored).load(path), schema, self.format, own)

    # -- writing ----------------------------------------------------------------------------------

    def store(self, name: str, graph: PropertyGraph, overwrite: bool = False) -> None:
        """Write all tables side by side, then the schema. Any table that fails makes the store fail.

        A graph that is there already gets a new version, in a folder of its own, and a pointer to it that is written last: there
        is a whole graph at any time, a failed write leaves the old one, and a graph may be stored over the one it is
        read from. `clear` deletes the versions before.
        """
        final = self.folder(name)
        there = self._files.exists(final)
        if there and not overwrite:
            raise GraphExistsError(f"'{name}' is in {self.root} already")
        before = self._pointers(name)
        version = f"version-{uuid.uuid4().hex}"
        folder = f"{final}/{version}" if there else final

        jobs: list[tuple[_StoredTable, DataFrame]] = []
        for node in graph.nodes:
            df = canonical_nodes(node)
            path = f"{NODES_FOLDER}/{folder_name(node.labels)}"
            columns = property_columns(node.properties)
            jobs.append((_StoredTable(path, df.schema, columns, tuple(sorted(node.labels))), df))
        types = [r.rel_type for r in graph.relationships]
        for rel in graph.relationships:
            df = canonical_relationships(rel)
            path = f"{RELS_FOLDER}/{folder_name([rel.rel_type])}"
            if types.count(rel.rel_type) > 1:
                path += f"-{folder_name(rel.source_labels)}-{folder_name(rel.target_labels)}"
            ends = (tuple(sorted(rel.source_labels)), tuple(sorted(rel.target_labels)))
            columns = property_columns(rel.properties)
            jobs.append((_StoredTable(path, df.schema, columns, (), rel.rel_type, *ends), df))
        paths = [t.path for t, _ in jobs]
        if len(set(paths)) < len(paths):
            raise GraphSchemaError(f"tables would share a folder: {sorted(p for p in paths if paths.count(p) > 1)}")

        with ThreadPoolExecutor(WRITERS) as pool:
            writes = [pool.submit(self.write_table, f"{folder}/{t.path}", df) for t, df in jobs]
        for write in writes:
            write.result()

        self._files.write_text(f"{folder}/{TABLES_FILE}", json.dumps([t.to_dict() for t, _ in jobs], indent=2))
        self._files.write_text(f"{folder}/{SCHEMA_FILE}", graph.schema.to_json())
        if there:
            number = int(before[-1].removeprefix(_POINTER)) + 1 if before else 1
            self._files.publish(f"{final}/{_POINTER}{number:08}", version)
        if self.database:
            for table, _ in jobs:
                self._create_external(name, folder, table)

    def clear(self, name: str) -> None:
        """Delete the versions before the one in use. DataFrames of theirs end with them."""
        final, pointers = self.folder(name), self._pointers(name)
        if not pointers:
            return
        current = self._files.read_text(f"{final}/{pointers[-1]}")
        for old in [*(f for f in self._files.folders(final) if f.startswith("version-") and f != current), NODES_FOLDER, RELS_FOLDER, SCHEMA_FILE, TABLES_FILE, *pointers[:-1]]:
            if self._files.exists(f"{final}/{old}"):
                self._files.delete(f"{final}/{old}")

    def write_table(self, path: str, df: DataFrame) -> None:
        rows = df if self.files_per_table is None else df.repartition(self.files_per_table)
        _encoded(rows, self.format).write.format(self.format).options(**_options(self.format)).save(path)

    def table_name(self, graph_name: str, table: _StoredTable) -> str:
        kind, names = ("vertex", table.labels) if table.rel_type is None else ("edge", (table.path.rpartition("/")[2],))
        plain = re.sub(r"\W", "_", f"{graph_name}_{kind}_{'_'.join(names)}")
        return f"{self.database}.{plain}"

    def _create_external(self, graph_name: str, folder: str, table: _StoredTable) -> None:
        name = self.table_name(graph_name, table)
        self._spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._spark.catalog.createTable(
            name,
            path=f"{folder}/{table.path}",
            source=self.format,
            schema=_stored_schema(table.schema, self.format),
            **_options(self.format),
        )

    def delete(self, name: str) -> None:
        """Remove the stored graph, and its external tables if there are any."""
        folder = self.folder(name)
        listing = f"{self._current(name)}/{TABLES_FILE}"
        if self.database and self._files.exists(listing):
            for table in json.loads(self._files.read_text(listing)):
                self._spark.sql(f"DROP TABLE IF EXISTS {self.table_name(name, _StoredTable.from_dict(table))}")
        self._files.delete(folder)
