"""Windows of one length that occur more than once in a corpus, found exactly and without shipping the windows.

A window chooses an anchor among the places near its beginning, by its content alone, so equal windows choose the same one.
Neighbouring windows with the same anchor make a stretch, whose core (what all of its possible windows have in common) is its key:
equal windows lie in stretches of equal keys, at equal places from the anchor. So one posting per stretch is enough
to see what may repeat at all:

1. Keys are counted, by partial aggregation. Those met once are done with.
2. A key with one content throughout repeats as a whole. These stretches need no further look.
3. Of a key with several contents, contents met more than once repeat as a whole; of the others, each window is
   compared with those of the same key (`fine`, given by the operator).

Rows are known by the 64-bit hash of their text, so copies share their results. Joins on keys and texts leave a hot one on
a side that adaptive execution can split; a hot key is counted map-side first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.text import dealt_anew, first_least, map_slices, mixed, signed
from graphloom.session import dropped, written


@dataclass(frozen=True)
class Windows:
    """`length` items each; the anchor is one of `choices` places from `first` on."""

    length: int
    choices: int
    first: int = 0

    @property
    def core(self) -> int:
        return self.length - self.choices + 1


def stretches(values: np.ndarray, edges: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of flat texts that begin at `edges`: the first window, number of windows and anchor of each stretch.

    `values` orders the places as anchors, the least first, and is one per item.
    """
    k = windows.length
    if len(values) < k:
        return (np.zeros(0, np.int64),) * 3
    chosen = first_least(values[windows.first : len(values) - k + windows.first + windows.choices], windows.choices) + windows.first
    inside = np.zeros(len(values) + 1, np.int64)
    sizes = np.diff(edges)
    long = sizes >= k
    np.add.at(inside, edges[:-1][long], 1)
    np.add.at(inside, edges[1:][long] - k + 1, -1)
    inside = np.cumsum(inside)[: len(chosen)] > 0
    starts = inside.copy()
    starts[1:] &= (chosen[1:] != chosen[:-1]) | ~inside[:-1]
    first = edges[:-1][long]
    starts[first] = True
    ends = inside.copy()
    ends[:-1] &= starts[1:] | ~inside[1:]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends)
    return starts, ends - starts + 1, chosen[starts]


POSTING = "key long, content long, doc long, start long, n int"


def postings_batch(keys, contents, docs, starts, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(keys)), pa.array(signed(contents)), pa.array(docs), pa.array(starts.astype(np.int64)), pa.array(counts.astype(np.int32))],
        names=["key", "content", "doc", "start", "n"],
    )


def with_place(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of content together with a place in it."""
    return mixed(hashes + places.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """`docs` with the text made not null in `_text`, and its hash in `_doc`."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select("*", body.alias("_text")).select("*", F.xxhash64("_text").alias("_doc"))


def gathered(intervals: DataFrame) -> DataFrame:
    """The different intervals of each text as a list. As long as the text has stretches, at most."""
    return intervals.select("doc", "start", "n").distinct().groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("intervals"))


def repeated(
    texts: DataFrame,
    post: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    fine: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """`doc` and `intervals` (first window, number of windows) of the windows that occur more than once.

    `texts` has `_doc`, `_text`. `post` makes the postings of a batch of them. `fine` is given stretches of keys with
    several contents (`key`, `doc`, `start`, `n`, `open`), one for each content, and the texts, and returns the intervals
    that repeat of those that are `open`.
    """
    postings = written(map_slices(texts.select("_doc", "_text"), post, POSTING, "_text"), "postings")
    keys = postings.groupBy("key").agg(
        F.count("*").alias("met"), F.min("content").alias("one"), F.max("content").alias("other")
    )
    keys = keys.where("met > 1").select(dealt_anew("key"), (F.col("one") == F.col("other")).alias("whole"))
    shared = written(postings.join(keys, "key"), "stretches")
    dropped(postings)
    several = shared.where("not whole")
    contents = written(
        several.groupBy("key", "content").agg(F.count("*").alias("met"), F.min(F.struct("doc", "start", "n")).alias("one")), "contents"
    )
    dropped()  # no table: the shuffles that `shared` and `contents` were made by
    again = several.join(contents.where("met > 1").select("key", "content"), ["key", "content"], "left_semi")
    compared = fine(contents.select("key", "one.*", (F.col("met") == 1).alias("open")), texts)
    whole = shared.where("whole").select("doc", "start", "n").unionByName(again.select("doc", "start", "n"))
    return gathered(whole.unionByName(compared.select("doc", "start", "n")))


def met_twice(windows: DataFrame) -> DataFrame:
    """Of windows (`name`, `doc`, `start`, `open`), those that are open and whose name is met twice or more, one by one."""
    names = windows.groupBy("name").agg(F.count("*").alias("met")).where("met > 1").select(dealt_anew("name"))
    return windows.where("open").join(names, "name", "left_semi").select("doc", "start", F.lit(1).alias("n"))


def first_of_each(keys: pa.Array, seen: set[int]) -> np.ndarray:
    """Which rows have a key not seen before in this task; copies of a text need one look."""
    keep = []
    for key in keys.to_pylist():
        keep.append(key not in seen)
        seen.add(key)
    return np.array(keep, bool)


def asked_stretches(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of `texts`, each copy of one too, that have stretches asked for, with these as `asked`. All columns stay,
    so that the exchange of the texts is the one that the final join has."""
    lists = asked.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "n", "open")).alias("asked"))
    return texts.join(lists.select(dealt_anew("doc", "_doc"), "asked"), "_doc")


def unnested(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """The fields of all asked stretches, and the row of each."""
    sizes = np.array([len(x) for x in column.to_pylist()]) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten()
    return [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)], np.repeat(np.arange(len(column)), sizes)


def covered(intervals: list[dict] | None, length: int, items: int) -> np.ndarray:
    """A mask of the items of one text that lie in windows of `intervals`."""
    marks = np.zeros(items + 1, np.int64)
    if intervals:
        starts = np.array([x["start"] for x in intervals])
        ends = starts + np.array([x["n"] for x in intervals]) + length - 1
        np.add.at(marks, starts, 1)
        np.add.at(marks, ends, -1)
    return np.cumsum(marks)[:-1] > 0
