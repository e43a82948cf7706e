"""Document fingerprints: MinHash signatures, banded candidates joined in Spark, Jaccard verified.

A signature has, for each of several universal hash functions, the least hash over the distinct shingles of a text: five
neighbouring words, A-Z in lower case, or all words of a text that has fewer. A text without words has no shingles; its
signature is the greatest value throughout, and it is near no other. The likeness of two signatures is the
share of equal places, an estimate of the Jaccard index of the shingles. Null texts are empty. Equal texts
have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.registry import query
from graphloom.llm.text import Rolling, dealt_anew, flat, lowered, map_slices, signed, slices, word_hashes, word_spans
from graphloom.session import written

WORDS, PLACES, BANDS = 5, 64, 16
LIKENESS = 0.8
BLOCK = 512  # texts of a bucket that meet as many others in one group
_BLOCK = 1 << 13  # shingles hashed at once, so that the products stay in the processor's cache

_random = np.random.default_rng(31415)
_FACTORS = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(0, 2**63, 256, dtype=np.uint64)


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of every text, with repeats, and where those of each text begin (one more than texts)."""
    data, offsets = flat(column)
    starts, ends, first = word_spans(lowered(data), offsets)
    rolling = Rolling(word_hashes(lowered(data), starts, ends))
    n = np.diff(first)
    made = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    edges = np.concatenate([[0], np.cumsum(made)])
    begin = np.repeat(first[:-1] - edges[:-1], made) + np.arange(edges[-1])
    return rolling.runs(begin, np.minimum(begin + words, np.repeat(first[1:], made))), edges


def signatures(column: pa.Array, words: int = WORDS, places: int = PLACES) -> np.ndarray:
    """One row of `places` 32-bit numbers per text."""
    hashes, edges = shingles(column, words)
    out = np.full((len(column), places), 2**32 - 1, np.uint32)
    factors, terms = _FACTORS[:places, None], _TERMS[:places, None]
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK]
        # Universal by multiplying and keeping the high bits.
        values = ((part[None, :] * factors + terms) >> np.uint64(32)).astype(np.uint32)
        low, high = np.searchsorted(edges, at, "right") - 1, np.searchsorted(edges, at + len(part), "left")
        docs = np.arange(low, high)
        docs = docs[edges[docs + 1] > np.maximum(edges[docs], at)]
        cuts = np.maximum(edges[docs], at) - at
        out[docs] = np.minimum(out[docs], np.minimum.reduceat(values, cuts, axis=1).T)
    return out


def hexed(signature: np.ndarray) -> pa.Array:
    return pa.array([row.astype(">u4").tobytes().hex() for row in signature], pa.string())


def fingerprinted(docs: DataFrame, id: str = "doc_id", text: str = "text", places: int = PLACES) -> DataFrame:
    """`id` and `fingerprint` (hexadecimal) of each row. A narrow step."""

    def work(batch):
        return pa.RecordBatch.from_arrays([batch.column(id), hexed(signatures(batch.column(text), places=places))], names=[id, "fingerprint"])

    kind = docs.schema[id].dataType.simpleString()
    return map_slices(docs.select(id, text), work, f"`{id}` {kind}, fingerprint string", text)


def near_pairs(docs: DataFrame, least: float = LIKENESS, text: str = "text", bands: int = BANDS, block: int = BLOCK) -> DataFrame:
    """Pairs of different texts that agree on a band of their signatures and whose shingles have a Jaccard index of
    `least` or more: `key_a < key_b`, `jaccard`. A key is the 64-bit hash of a text.

    Equal texts are one, so groups of copies cost one row. In a band, every two texts of a bucket are compared. A large
    bucket is cut into blocks by a hash of the key, and two blocks at a time meet in a task of their own.
    """
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select(F.xxhash64("text").alias("key"), "text")

    def work(batch):
        found = signatures(batch.column("text"))
        hashes, edges = shingles(batch.column("text"))
        rows = PLACES // bands
        names = np.ascontiguousarray(found.reshape(len(found), bands, rows)).view(f"V{4 * rows}")[..., 0]
        coded = [int.from_bytes(hashlib.blake2b(bytes([b]) + v.tobytes(), digest_size=8).digest(), "little", signed=True) for own in names for b, v in enumerate(own)]
        sets = [np.unique(hashes[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
        lists = lambda parts, kind: pa.ListArray.from_arrays(np.cumsum([0, *map(len, parts)]).astype(np.int32), pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]), kind))
        filled = pa.array([len(s) > 0 for s in sets])
        return pa.RecordBatch.from_arrays(
            [batch.column("key"), lists([np.array(coded[i * bands : (i + 1) * bands], np.int64) for i in range(len(found))], pa.int64()), lists([signed(s) for s in sets], pa.int64())],
            names=["key", "buckets", "shingles"],
        ).filter(filled)

    sets = written(map_slices(texts, work, "key long, buckets array<long>, shingles array<long>").dropDuplicates(["key"]), "signatures")
    dealt = sets.select("key", F.explode("buckets").alias("bucket"))
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select(dealt_anew("bucket"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    placed = dealt.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    # Once for each block that it meets, its own among them.
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = lambda s: F.when(F.col("own") <= F.col("other"), F.col(s[0])).otherwise(F.col(s[1]))
    met = placed.select("bucket", side(("own", "other")).alias("low"), side(("other", "own")).alias("high"), "own", "key")
    a = met.where("own = low").select("bucket", "low", "high", F.col("key").alias("a"))
    b = met.where("own = high").select("bucket", "low", "high", F.col("key").alias("b"))
    pairs = a.join(b, ["bucket", "low", "high"]).where((F.col("low") < F.col("high")) | (F.col("a") < F.col("b")))
    pairs = pairs.select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b")).distinct()
    both = pairs.join(sets.select(F.col("key").alias("key_a"), F.col("shingles").alias("a")), "key_a")
    both = both.join(sets.select(F.col("key").alias("key_b"), F.col("shingles").alias("b")), "key_b")
    common = F.size(F.array_intersect("a", "b"))
    return both.select("key_a", "key_b", (common / (F.size("a") + F.size("b") - common)).alias("jaccard")).where(F.col("jaccard") >= least)


def in_order(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Rows of `docs` dealt by ranges of a whole-number `id`, sorted, each range followed by the first row of the next.

    Columns `id`, `text`, `n_range`, `follows`. As many ranges as the session has shuffle partitions are cut at
    approximate quantiles of the ids; the driver sees one id per range. The row after the last is the first of
    all. Rows without an id come first, ties are in the order of texts.
    """
    if not isinstance(docs.schema[id].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"rows are put in the order of whole numbers; '{id}' is {docs.schema[id].dataType.simpleString()}")
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)] or [0.5]
    cuts = np.unique(rows.agg(F.percentile_approx("id", steps, max(10_000, 20 * parts))).first()[0] or [])

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), "right")).astype("int32")

    # Nulls never reach pandas, which would make floating-point numbers of a batch that has some.
    ranged = rows.withColumn("n_range", F.when(F.col("id").isNull(), 0).otherwise(range_of(F.coalesce("id", F.lit(0)))))
    least = {r.n_range: r.id for r in ranged.groupBy("n_range").agg(F.min("id").alias("id")).collect()}
    filled = sorted(least)
    before = {r: filled[i - 1] for i, r in enumerate(filled)}

    @F.pandas_udf("int")
    def range_before(ranges: pd.Series) -> pd.Series:
        return ranges.map(before).astype("int32")

    first = F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "text"))
    heads = ranged.where(F.col("id").isin([i for i in least.values() if i is not None]) | F.col("id").isNull())
    heads = heads.groupBy("n_range").agg(first.alias("first"))
    heads = heads.select("first.id", "first.text", range_before("n_range").alias("n_range"), F.lit(True).alias("follows"))
    every = ranged.withColumn("follows", F.lit(False)).unionByName(heads)
    dealt = every.repartitionById(len(cuts) + 1, F.col("n_range"))
    return dealt.sortWithinPartitions("n_range", "follows", F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first())


def compared_with_next(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint next to those of the following row and of its edited text.

    The edited text has the last quarter of the characters replaced by the first as many of the following row in the
    order of `id` (of the first row, after the last). A single row follows itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whose next one is not known yet
        for whole in batches:
            for part in slices(whole, "text"):
                table = pa.Table.from_batches([part] if held is None else [held, part])
                table = table.combine_chunks()
                last = table.slice(table.num_rows - 1).to_batches()[0]
                made = compared(table)
                held = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in last.columns], schema=part.schema)
                if made is not None:
                    yield made

    def compared(table: pa.Table) -> pa.RecordBatch | None:
        ranges_, follows = table.column("n_range").to_pylist(), table.column("follows").to_pylist()
        own = [i for i in range(table.num_rows - 1) if not follows[i] and ranges_[i] == ranges_[i + 1]]
        if not own:
            return None
        texts = [t or "" for t in table.column("text").to_pylist()]
        edited = [texts[i][: len(texts[i]) - len(texts[i]) // 4] + texts[i + 1][: len(texts[i]) // 4] for i in own]
        found, changed = signatures(pa.array(texts, pa.large_string())), signatures(pa.array(edited, pa.large_string()))
        own = np.array(own)
        alike = lambda a, b: pa.array((a == b).mean(axis=1), pa.float64())
        return pa.RecordBatch.from_arrays(
            [
                table.column("id").combine_chunks().take(pa.array(own)),
                pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                hexed(found[own]),
                hexed(changed),
                alike(found[own], changed),
                alike(found[own], found[own + 1]),
            ],
            names=[id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    kind = docs.schema[id].dataType.simpleString()
    return in_order(docs, id, text).mapInArrow(
        run,
        f"`{id}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


@query("op3_fingerprints")
def op3_fingerprints(spark, folder):
    """Fingerprints of every document, of its edited text and of the next document."""
    return compared_with_next(spark.read.parquet(f"{folder}/documents.parquet"))
