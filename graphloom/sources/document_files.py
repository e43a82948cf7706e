"""Document collections in files: buckets by id, folders by datasource and label, and counts that tell what they hold.

    root/manifests/00000007.json          what makes up version 7: for each kind and bucket the folder that it is in
    root/documents/<kind>/at_write=<folder>/at_bucket=3/at_source=.shop/at_label=.customer/...
    root/counts/<kind>/at_write=<folder>/at_bucket=3/...

A document lies in the bucket of its id's hash. A change rewrites the buckets that it touches, into a new folder, and counts the
entries of these alone; what it does not touch stays as it is, and the manifest that names both is published last. A
reader sees one version throughout. Whoever loses a race for the next version is refused, and a write that is lost leaves
nothing but files that no manifest names, which `clear` deletes.

Scans read the folders of the datasource and labels asked for. Names of folders carry a mark before the value, so that an empty
text and null are different; the documents hold the values themselves as well.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.errors import GraphError, GraphNotFoundError
from graphloom.operators import metadata
from graphloom.operators.documents import EDGE_DOCUMENT, VERTEX_DOCUMENT
from graphloom.operators.updates import latest, live, upsert
from graphloom.session import written
from graphloom.sources.documents import EDGE, VERTEX, DocumentStore
from graphloom.sources.files import SharedFiles

BUCKETS = 16  # of a new collection; the larger it is, the less a change rewrites
_WRITE, _BUCKET, _SOURCE, _LABEL = "at_write", "at_bucket", "at_source", "at_label"
_MARK = "."
_DELETED = T.StructField("deleted", T.StringType())
_SCHEMAS = {kind: T.StructType([*schema.fields, _DELETED]) for kind, schema in ((VERTEX, VERTEX_DOCUMENT), (EDGE, EDGE_DOCUMENT))}
_COUNTS = "datasource string, label string, whole boolean, key string, type string, n long"


@dataclass(frozen=True)
class Manifest:
    """Version, number of buckets, and by kind the folder of each bucket that holds documents."""

    version: int
    buckets: int
    folders: Mapping[str, Mapping[int, str]]

    @classmethod
    def current(cls, files: SharedFiles, root: str) -> Manifest | None:
        names = [name for name in files.files(f"{root}/manifests") if name.endswith(".json")]
        if not names:
            return None
        held = json.loads(files.read_text(f"{root}/manifests/{names[-1]}"))
        folders = {kind: {int(b): folder for b, folder in of.items()} for kind, of in held["folders"].items()}
        return cls(held["version"], held["buckets"], folders)

    def publish(self, files: SharedFiles, root: str) -> None:
        text = json.dumps({"version": self.version, "buckets": self.buckets, "folders": self.folders})
        files.publish(f"{root}/manifests/{self.version:08}.json", text)

    def paths(self, root: str, kind: str, of: str = "documents", only: Iterable[int] | None = None) -> list[str]:
        held = self.folders[kind]
        return [f"{_written(root, of, kind, held[b])}/{_BUCKET}={b}" for b in sorted(held if only is None else set(held) & set(only))]


def _written(root: str, of: str, kind: str, folder: str) -> str:
    return f"{root}/{of}/{kind}/{_WRITE}={folder}"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _write(docs: DataFrame, files: SharedFiles, root: str, folder: str, kind: str, buckets: int) -> dict[int, str]:
    """Write documents and their counts; the folder of each bucket that got any."""
    given = {f.name for f in docs.schema.fields}
    columns = [F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in _SCHEMAS[kind].fields]
    marked = [F.concat(F.lit(_MARK), F.col(c)).alias(at) for c, at in (("datasource", _SOURCE), ("label", _LABEL))]
    dealt = docs.select(*columns, _bucket(buckets).alias(_BUCKET), *marked).repartition(_BUCKET, _SOURCE, _LABEL)
    path = _written(root, "documents", kind, folder)
    dealt.write.partitionBy(_BUCKET, _SOURCE, _LABEL).parquet(path)
    found = [int(name.partition("=")[2]) for name in files.folders(path) if name.startswith(f"{_BUCKET}=")]
    if found:
        saved = docs.sparkSession.read.schema(T.StructType([*_SCHEMAS[kind].fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(path)
        counts = metadata.entry_counts(live(saved), _BUCKET)
        counts.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(_written(root, "counts", kind, folder))
    return {b: folder for b in found}


def write_documents(documents: Mapping[str, DataFrame], root: str, buckets: int | None = None) -> None:
    """All documents as the next version of the collection under `root`, in as many buckets as it has, unless named."""
    files = SharedFiles(next(iter(documents.values())).sparkSession)
    before = Manifest.current(files, root)
    buckets = buckets or (before.buckets if before else BUCKETS)
    folder = uuid.uuid4().hex
    folders = {kind: _write(docs, files, root, folder, kind, buckets) for kind, docs in documents.items()}
    Manifest(before.version + 1 if before else 1, buckets, folders).publish(files, root)


class SavedDocuments(DocumentStore):
    """The version of a collection that was current when it was opened."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root, self._files = spark, root, SharedFiles(spark)
        manifest = Manifest.current(self._files, root)
        if manifest is None:
            raise GraphNotFoundError(f"no documents are saved under {root}")
        self.manifest = manifest
        super().__init__(self._read(VERTEX).drop(_SOURCE, _LABEL), self._read(EDGE).drop(_SOURCE, _LABEL))

    def _read(self, kind: str, only: Iterable[int] | None = None) -> DataFrame:
        schema = T.StructType([*_SCHEMAS[kind].fields, T.StructField(_SOURCE, T.StringType()), T.StructField(_LABEL, T.StringType())])
        paths = self.manifest.paths(self._root, kind, only=only)
        return self._parquet("documents", kind, schema, paths).select(*schema.names)

    def _parquet(self, of: str, kind: str, schema: T.StructType | str, paths: list[str]) -> DataFrame:
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).option("basePath", f"{self._root}/{of}/{kind}").parquet(*paths)

    def _scan(self, kind: str, datasource: str, labels: str | Iterable[str] | None) -> DataFrame:
        docs = self._read(kind).where((F.col(_SOURCE) == _MARK + datasource) & (F.col("datasource") == datasource))
        if labels is not None:
            names = [labels] if isinstance(labels, str) else list(labels)
            docs = docs.where(F.col(_LABEL).isin([_MARK + n for n in names]) & F.col("label").isin(names))
        return live(docs.drop(_SOURCE, _LABEL))

    # -- metadata, from the counts of the buckets; live documents only ----------------------------

    def entry_counts(self) -> DataFrame:
        """`kind, datasource, label, whole, key, type, n`, added up over the buckets. Documents are not read."""
        parts = []
        group = ["kind", "datasource", "label", "whole", "key", "type"]
        for kind in (VERTEX, EDGE):
            held = self.manifest.folders[kind]
            counted = {f: set(self._files.folders(_written(self._root, "counts", kind, f))) for f in set(held.values())}
            # A bucket of deleted documents counts none.
            paths = self.manifest.paths(self._root, kind, "counts", [b for b, f in held.items() if f"{_BUCKET}={b}" in counted[f]])
            read = self._parquet("counts", kind, _COUNTS, paths)
            parts.append(read.select(F.lit(kind).alias("kind"), *group[1:], "n"))
        return parts[0].unionAll(parts[1]).groupBy(*group).agg(F.sum("n").alias("n"))

    def count(self, datasource: str) -> int:
        held = self.entry_counts().where((F.col("datasource") == datasource) & F.col("whole"))
        return held.agg(F.sum("n")).first()[0] or 0

    def datasources(self) -> DataFrame:
        whole = self.entry_counts().where("whole")
        number = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
        return whole.groupBy("datasource").agg(number(VERTEX).alias("n_vertices"), number(EDGE).alias("n_edges"))

    def labels(self, datasource: str) -> DataFrame:
        return self.entry_counts().where((F.col("datasource") == datasource) & F.col("whole")).select("kind", "datasource", "label", "n")

    def key_types(self, datasource: str, label: str, kind: str = VERTEX) -> DataFrame:
        held = (F.col("kind") == kind) & (F.col("datasource") == datasource) & (F.col("label") == label)
        return metadata.key_types_of(self.entry_counts().where(held).drop("kind"))

    def scan(self) -> DataFrame:
        return metadata.scan_of(self.entry_counts())

    def _scan_types(self, datasource: str) -> DataFrame:
        return metadata.scan_of(self.entry_counts().where(F.col("datasource") == datasource))

    def graph_names(self) -> list[str]:
        return sorted(row["datasource"] for row in metadata.collected(self.datasources()))

    # -- changes ----------------------------------------------------------------------------------

    def upsert(self, vertices: DataFrame | None = None, edges: DataFrame | None = None) -> SavedDocuments:
        """The next version: changed documents are put in place of those with equal ids, or added. Buckets that none of them
        belongs to are not read or written."""
        folder = uuid.uuid4().hex
        folders = {kind: dict(held) for kind, held in self.manifest.folders.items()}
        for kind, changes in ((VERTEX, vertices), (EDGE, edges)):
            if changes is None:
                continue
            changes = written(latest(changes), "changes")
            touched = [row[0] for row in changes.select(_bucket(self.manifest.buckets)).distinct().collect()]  # no more than there are buckets
            old = self._read(kind, touched).drop(_SOURCE, _LABEL)
            new = _write(upsert(old, changes), self._files, self._root, folder, kind, self.manifest.buckets)
            folders[kind] = {b: f for b, f in folders[kind].items() if b not in touched} | new
        Manifest(self.manifest.version + 1, self.manifest.buckets, folders).publish(self._files, self._root)
        return SavedDocuments(self._spark, self._root)

    def clear(self) -> None:
        """Delete the manifests before this one and the files that it does not name. Readers of earlier versions and writers of the next
        one lose theirs, so there must be none."""
        newest = Manifest.current(self._files, self._root)
        if newest is None or newest.version != self.manifest.version:
            raise GraphError(f"there is a version after {self.manifest.version}")
        for of in ("documents", "counts"):
            for kind, held in self.manifest.folders.items():
                for name in self._files.folders(f"{self._root}/{of}/{kind}"):
                    folder = name.partition("=")[2]
                    path = _written(self._root, of, kind, folder)
                    if folder not in held.values():
                        self._files.delete(path)
                        continue
                    for bucket in self._files.folders(path):
                        if held.get(int(bucket.partition("=")[2])) != folder:
                            self._files.delete(f"{path}/{bucket}")
        for name in self._files.files(f"{self._root}/manifests"):
            if name != f"{self.manifest.version:08}.json":
                self._files.delete(f"{self._root}/manifests/{name}")
