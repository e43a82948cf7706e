"""Exact dedup by a stream with keyed state: what has been seen stays known, on disk, without expiry.

Parquet files are a stream. Of each digest of a text the state keeps the row that stays (its id and its place: file and row),
and how many rows have been met. The state lies in a RocksDB store on the executors' disks and, after each batch, in the
checkpoint of the stream, so that a lost executor loses nothing and a later call with the same folder reads new files only.
Each task counts its own rows of a digest first: a text that a third of all rows have is a row a task in the exchange.

A digest met again is a hit, and hits are compared in full: the texts of a digest that more than one row has are grouped by all
their bytes, in each task first. Those that are not the text at the place the state names are told apart by their bytes from
then on. (With SHA-256 none are ever expected; tests use a digest of a few bits.)

All of it is DataFrame operations. A null text is an empty one. Of equal texts the row of the largest id stays; a null id is less than
any other, and of rows of one id the one of the last file and row stays. A table without rows gives none. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graphloom.llm.registry import query
from graphloom.session import new_location, written

FILES_A_BATCH = 10_000  # what is read again if the driver is lost; results are the same for any number
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",  # for all stores of an executor together
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every store takes 4 MB of disk ahead
}

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class ExactDedup:
    """The rows of Parquet files that have equal texts, known by the state in `folder`, which is new unless named."""

    def __init__(self, spark: SparkSession, id: str = "doc_id", text: str = "text", folder: str | None = None, digest: Digest = sha256):
        self.spark, self.id, self.text, self.digest = spark, id, text, digest
        self.folder = folder or new_location(spark, "dedup-state")

    def absorb(self, path: str, files_a_batch: int = FILES_A_BATCH) -> None:
        """Bring the state up to date with the files at `path`. Files that it has read before are left alone."""
        source = self._session().readStream.schema(self._schema(path)).option("maxFilesPerTrigger", files_a_batch)
        # As a pattern, so that a single file can be a stream too.
        rows = self._rows(source.parquet(f"{path[:-1]}[{path[-1]}]"))
        kept = rows.groupBy("digest").agg(F.max("row").alias("row"), F.count("*").alias("n"))
        stream = kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", self.folder)
        stream.trigger(availableNow=True).start().awaitTermination()

    def state(self) -> DataFrame:
        """`digest`, `kept` (id, file and place of the row that stays) and `n`, of every digest met so far; a written copy."""
        stored = self._session().read.format("statestore").load(self.folder)
        path = new_location(self.spark, "dedup-state-copy")
        stored.select("key.digest", F.col("value.max").alias("kept"), F.col("value.count").alias("n")).write.parquet(path)
        return self.spark.read.parquet(path)

    def _session(self) -> SparkSession:
        """One whose settings are its own."""
        session = self.spark.newSession()
        for name, value in _SETTINGS.items():
            session.conf.set(name, value)
        return session

    def decisions(self, path: str) -> DataFrame:
        """`id`, `keep_id`, `group_size`, `kept` and `text_sha256` of every row at `path`, which `absorb` has read."""
        rows = self._rows(self.spark.read.schema(self._schema(path)).parquet(path))
        state = self.state()
        apart = written(self._apart(rows, state), "apart")
        if apart.isEmpty():
            decided = rows.select("digest", "row", "sha").join(state, "digest")
        else:
            decided = self._by_bytes(rows, state, apart)
        same = (F.col("row.file") == F.col("kept.file")) & (F.col("row.place") == F.col("kept.place"))
        return decided.select(F.col("row.id").alias(self.id), F.col("kept.id").alias("keep_id"), F.col("n").alias("group_size"), same.alias("kept"), F.col("sha").alias("text_sha256"))

    def _schema(self, path: str) -> StructType:
        given = self.spark.read.parquet(path).schema
        return StructType([given[self.id], given[self.text]])

    def _rows(self, docs: DataFrame) -> DataFrame:
        place = docs.metadataColumn("_metadata")
        text = F.coalesce(F.col(f"`{self.text}`"), F.lit(""))
        row = F.struct(F.col(f"`{self.id}`").alias("id"), place["file_path"].alias("file"), place["row_index"].alias("place"))
        return docs.select(self.digest(text).alias("digest"), row.alias("row"), text.alias("text"), F.sha2(text, 256).alias("sha"))

    def _apart(self, rows: DataFrame, state: DataFrame) -> DataFrame:
        """`digest`, `text` of the texts that are not the one their digest stands for."""
        hits = rows.select("digest", "row", "text").join(state.where("n > 1"), "digest")
        stands = (F.col("row.file") == F.col("kept.file")) & (F.col("row.place") == F.col("kept.place"))
        # By the place, which is as good as the digest, but lets a digest that many rows have be split in the join.
        texts = hits.groupBy("kept.file", "kept.place", "text").agg(F.max(stands).alias("stands"))
        return texts.where("not stands").select(self.digest(F.col("text")).alias("digest"), "text")

    def _by_bytes(self, rows: DataFrame, state: DataFrame, apart: DataFrame) -> DataFrame:
        own = rows.join(apart, ["digest", "text"]).groupBy("digest", "text").agg(F.max("row").alias("own"), F.count("*").alias("own_n"))
        others = own.groupBy("digest").agg(F.sum("own_n").alias("other_n"))
        left = state.join(others, "digest", "left").select("digest", "kept", (F.col("n") - F.coalesce("other_n", F.lit(0))).alias("n"))
        told = rows.join(own, ["digest", "text"], "left").select("digest", "row", "sha", "own", "own_n")
        return told.join(left, "digest").select("row", "sha", F.coalesce("own", "kept").alias("kept"), F.coalesce("own_n", "n").alias("n"))


def exact_dedup(spark: SparkSession, path: str, id: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """Every row at `path` with the one of its text that stays."""
    dedup = ExactDedup(spark, id, text, folder)
    dedup.absorb(path)
    return dedup.decisions(path)


@query(
    "op11_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
      sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op11_exact_dedup(spark, folder):
    """Every document with the last one of the same text."""
    return exact_dedup(spark, f"{folder}/documents.parquet")
