"""Quality classifier: documents ranked by a Bradley-Terry model of preference pairs.

A pair is a labelled good document and a labelled bad one. The chance that the good one is preferred is a logistic
function of the difference of their scores, which are linear in features of the text; the weights have the
least logistic loss on differences of features. The cut between good and bad is the quantile of the labelled
scores at the share of bad labels. Scores are moved so that the cut is at 0.7.

Every labelled document that is not held out takes part in pairs: those of each kind are numbered by a hash of their id, and each of the
larger kind meets the `PARTNERS` next ones of the smaller, round and round. Moments, gradients and curvatures are sums over Spark's tasks,
of contributions rounded to multiples of 2**-30, so that no order of rows changes a sum; the cut is found by counting ranges of
scores. Only a few hundred sums at a time reach the driver. Every document is scored. Features are built-in functions of the text alone. Null texts are empty. Documents without an id are never held out and never
learned from. Without labels of both kinds every score is 0.5. Equal texts have equal scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.quality_rules import measured
from graphloom.llm.registry import query
from graphloom.operators.paging import page
from graphloom.operators.table import with_row_index
from graphloom.session import passing_tables, written

PARTNERS = 4  # pairs of each labelled document of the larger kind
PAIRS = 60_000  # drawn where the rows are an array
CUT = 0.7
ROUNDS = 40  # of Newton steps, at most
RIDGE = 1e-4
_UNIT = 2.0**30


def features(measures: Column) -> list[Column]:
    """Shares of a text, between 0 and 1 or nearly so; 0 for a text without words."""
    m = lambda name: measures[name].cast("double")
    share = lambda a, b: F.when(m(b) > 0, m(a) / m(b)).otherwise(F.lit(0.0))
    repeated, capitals = share("n_repeat_words", "n_words"), share("n_capitals", "word_chars")
    return [
        F.least(F.lit(1.0), share("n_symbols", "n_words")),
        repeated,
        repeated * repeated,
        capitals,
        capitals * capitals,
        share("n_dup_lines", "n_lines"),
        F.log1p(m("n_words")) / F.lit(10.0),
        F.least(F.lit(1.0), m("n_stop_words") / F.lit(5.0)),
        F.least(F.lit(2.0), share("word_chars", "n_words") / F.lit(10.0)),
    ]


@dataclass(frozen=True)
class Ranking:
    weights: tuple[float, ...]
    cut: float
    width: float

    def total(self, values: list[Column]) -> Column:
        total = F.lit(0.0)
        for weight, value in zip(self.weights, values, strict=True):
            total = total + F.lit(weight) * value
        return total

    def score(self, values: list[Column]) -> Column:
        """Between 0 and 1; `CUT` or more for what is preferred."""
        total = self.total(values)
        odds = F.log(F.lit(CUT / (1 - CUT)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-((total - F.lit(self.cut)) / F.lit(self.width) + odds)))


def fitted(values: np.ndarray, good: np.ndarray, pairs: int = PAIRS, rounds: int = ROUNDS, ridge: float = RIDGE) -> Ranking | None:
    """Weights from rows of features and their labels, by Newton steps on the loss over pairs."""
    if good.all() or not good.any():
        return None
    draw = np.random.default_rng(7)
    better, worse = draw.choice(np.flatnonzero(good), pairs), draw.choice(np.flatnonzero(~good), pairs)
    scale = values.std(axis=0)
    scale[scale == 0] = 1
    differences = (values[better] - values[worse]) / scale
    weights = np.zeros(values.shape[1])
    for _ in range(rounds):
        wrong = 1 / (1 + np.exp(np.clip(differences @ weights, -500, 500)))
        gradient = differences.T @ wrong / pairs - ridge * weights
        bend = (differences * (wrong * (1 - wrong))[:, None]).T @ differences / pairs + ridge * np.eye(len(weights))
        weights = weights + np.linalg.solve(bend, gradient)
    weights = weights / scale
    ranked = np.sort(values @ weights)
    place = int((~good).sum())
    cut = (ranked[place - 1] + ranked[min(place, len(ranked) - 1)]) / 2
    return Ranking(tuple(map(float, weights)), float(cut), float(ranked.std() or 1.0))


def _sums(rows: DataFrame, column: str, terms: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums of the `terms` of all rows, the same in any order of rows. `column` has lists of one length; the terms of a batch of
    them are a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            if batch.num_rows:
                lists = batch.column(column).flatten().to_numpy().reshape(batch.num_rows, -1)
                own = np.rint(terms(lists) * _UNIT).astype(np.int64).sum(axis=0).tolist()
                total = [x + y for x, y in zip(total or [0] * len(own), own, strict=True)]
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(map(Decimal, total), pa.decimal128(28, 0))], names=["term", "total"])

    found = rows.select(column).mapInArrow(run, "term int, total decimal(28,0)").groupBy("term").agg(F.sum("total").alias("total")).collect()
    return np.array([float(r.total) for r in sorted(found)]) / _UNIT


def _products(rows: np.ndarray, by: np.ndarray | None = None) -> np.ndarray:
    """The products of every two columns, times the number of each row in `by`, as columns."""
    left = rows if by is None else rows * by[:, None]
    return (left[:, :, None] * rows[:, None, :]).reshape(len(rows), -1)


def _pairs(known: DataFrame, n_good: int, n_bad: int) -> DataFrame:
    """`gap`, the features of a good row less those of a bad one. `known` has `place`, `v`, `good`; places number the bad rows first."""
    place = F.when(F.col("good"), F.col("place") - n_bad).otherwise(F.col("place"))
    many, few = (F.col("good"), ~F.col("good")) if n_good >= n_bad else (~F.col("good"), F.col("good"))
    turn = F.explode(F.sequence(F.lit(0), F.lit(PARTNERS - 1)))
    one = known.where(many).select("v", place.alias("place"), turn.alias("turn"))
    one = one.select(F.col("v").alias("one"), F.pmod(F.col("place") * PARTNERS + F.col("turn"), F.lit(min(n_good, n_bad))).alias("place"))
    met = one.join(known.where(few).select(place.alias("place"), F.col("v").alias("other")), "place")
    sign = 1.0 if n_good >= n_bad else -1.0
    return met.select(F.zip_with("one", "other", lambda x, y: (x - y) * F.lit(sign)).alias("gap"))


def fitted_on_tables(known: DataFrame, id: str) -> Ranking | None:
    """As `fitted`, from a table of all rows (`id`, which is unique, `v` and `good`), by sums over its tasks."""
    counts = {r.good: r["count"] for r in known.groupBy("good").count().collect()}
    n_good, n_bad = counts.get(True, 0), counts.get(False, 0)
    if not n_good or not n_bad:
        return None
    moments = _sums(known, "v", lambda v: np.hstack([v, _products(v)])) / (n_good + n_bad)
    width = int((np.sqrt(4 * len(moments) + 1) - 1) / 2)
    mean, squares = moments[:width], moments[width:].reshape(width, width)
    spread = squares - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(spread), 0))
    scale[scale == 0] = 1
    numbered = written(with_row_index(known, "good", F.xxhash64(id), id, name="place").select("place", "v", "good"), "labelled-places")
    gaps = written(_pairs(numbered, n_good, n_bad), "labelled-pairs")
    pairs = PARTNERS * max(n_good, n_bad)
    weights = np.zeros(width)
    for _ in range(ROUNDS):

        def terms(gap: np.ndarray, weights: np.ndarray = weights) -> np.ndarray:
            gap = gap / scale
            wrong = 1 / (1 + np.exp(np.clip(gap @ weights, -500, 500)))
            return np.hstack([gap * wrong[:, None], _products(gap, wrong * (1 - wrong))])

        total = _sums(gaps, "gap", terms) / pairs
        bend = total[width:].reshape(width, width) + RIDGE * np.eye(width)
        step = np.linalg.solve(bend, total[:width] - RIDGE * weights)
        weights = weights + step
        if np.abs(step).max() <= 1e-6 * (1 + np.abs(weights).max()):
            break
    weights = weights / scale
    ranking = Ranking(tuple(map(float, weights)), 0.0, float(np.sqrt(max(weights @ spread @ weights, 0))) or 1.0)
    totals = known.select(id, ranking.total([F.col("v")[i] for i in range(width)]).alias("total"))
    beside = page(totals, "total", skip=n_bad - 1, limit=2).collect()
    return Ranking(ranking.weights, sum(r.total for r in beside) / len(beside), ranking.width)


def held_out(id: str) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 4 == 2, F.lit(False))


def learned(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", sample: int | None = None) -> Ranking | None:
    """A ranking from all labels that are not held out, one row of each id (that of the least hash of its text). With `sample`, from the
    rows of so many ids at most, which are fitted in the driver; no text gets there."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out(id)).groupBy(id).agg(F.max(label).alias("_label"))
    rows = docs.select(id, text).where(F.col(id).isNotNull() & ~held_out(id))
    if sample is not None:
        known = F.broadcast(known.orderBy(F.xxhash64(id), id).limit(sample))  # a row of two numbers for each of the sample
        rows = rows.join(known.select(id), id, "left_semi")
    # Texts are measured where they are; what is joined are numbers.
    values = measured(rows, text).select(id, F.array(*features(F.col("measures"))).alias("v"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_hash"))
    values = values.join(known, id).select(id, "_hash", "v", (F.col("_label") == 1).alias("good"))
    one = values.groupBy(id).agg(F.min(F.struct("_hash", "v", "good")).alias("one"))  # ids may repeat in documents
    one = one.select(id, "one.v", "one.good")
    if sample is None:
        with passing_tables():
            return fitted_on_tables(written(one, "labelled"), id)
    found = sorted((r[0], r.v, r.good) for r in one.collect())
    if not found:
        return None
    return fitted(np.array([v for _, v, _ in found]), np.array([g for _, _, g in found]))


def scored(docs: DataFrame, ranking: Ranking | None, text: str = "text") -> DataFrame:
    """`docs` with `score` and `predicted`, in place of columns of those names in any case."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    wide = measured(docs.select(F.struct(*kept).alias("_row"), F.col(f"`{text}`").alias("_text")), "_text")
    score = ranking.score(features(F.col("measures"))) if ranking else F.lit(0.5)
    return wide.select("_row.*", score.alias("score")).withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@query("op8_quality_classifier")
def op8_quality_classifier(spark, folder):
    """Scores of every document, learned from the labels that are not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    ranking = learned(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return scored(docs, ranking).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")
