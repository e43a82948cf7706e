"""Substring dedup by recompression of word sequences.

Rounds name runs of one symbol and then pairs of two, until a sequence is one symbol. A pair is named where its first symbol
falls in the left half of the alphabet and the second in the right, so neighbours agree without looking further; the
halves are drawn anew in each round. A name is a hash of what it stands for: tasks give the same run or pair the
same name without an exchange, and equal sequences end in equal symbols wherever they stand. The boundaries that survive the
first round are the places where windows of words anchor, since equal windows have them in common; the symbols
of whole stretches of windows, shared between documents, reveal the repeats, and those of single windows verify the rest.

A window is 35 consecutive words of one document. Words covered by a window that starts anywhere else too
are removed, all copies alike; windows are judged on the input. A null text has no words. Copies of a document cover each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.registry import query
from graphloom.llm.stretches import (
    Windows,
    asked_stretches,
    covered,
    first_of_each,
    keyed,
    met_twice,
    postings_batch,
    repeated,
    stretches,
    unnested,
    with_place,
)
from graphloom.llm.text import dealt_anew, flat, mixed, ranges, signed, slices, word_hashes, word_spans

WINDOW = Windows(length=35, choices=16, first=1)
_BLOCK = 1 << 18  # symbols named at once

_PAIR, _RUN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _half(names: np.ndarray, round_: int) -> np.ndarray:
    """Whether each symbol is in the right half of this round's alphabet."""
    return (mixed(names + np.uint64(0x632BE59BD9B4E019 * (round_ + 1) % 2**64)) & np.uint64(1)) == 1


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * _PAIR + mixed(right ^ _RUN))


def boundaries(names: np.ndarray) -> np.ndarray:
    """Where a symbol of the first round begins: not within a run, nor between a left and a right symbol."""
    right = _half(names, 0)
    cut = np.ones(len(names), bool)
    cut[1:] = (names[1:] != names[:-1]) & ~(~right[:-1] & right[1:])
    return cut


def roots(names: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The symbol that each of the sequences, one after the other in `names`, ends in. None is empty."""
    out = np.zeros(len(lengths), np.uint64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    round_ = 0
    while len(names):
        # Runs.
        begins = np.ones(len(names), bool)
        begins[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(names)))
        names, owner = names[at], owner[at]
        long = size > 1
        names[long] = mixed(names[long] * _RUN + size[long].astype(np.uint64))
        # Pairs. A sequence of two is a pair whatever the halves.
        same = owner[1:] == owner[:-1]
        first = np.ones(len(names), bool)
        first[1:] = ~same
        last = np.append(first[1:], True)
        right = _half(names, round_)
        joined = same & ((~right[:-1] & right[1:]) | (first[:-1] & last[1:]))
        at = np.flatnonzero(joined)
        names[at] = _pair(names[at], names[at + 1])
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, owner = names[keep], owner[keep]
        # Whoever is one symbol has ended.
        alone = np.ones(len(names), bool)
        if len(names) > 1:
            differs = owner[1:] != owner[:-1]
            alone[1:] &= differs
            alone[:-1] &= differs
        out[owner[alone]] = names[alone]
        names, owner = names[~alone], owner[~alone]
        round_ += 1
    return out


def named(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Roots of any parts of a sequence, in blocks."""
    out = np.zeros(len(starts), np.uint64)
    block = np.cumsum(lengths) // _BLOCK
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(starts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = roots(words[ranges(starts[a:b], lengths[a:b])], lengths[a:b])
    return out


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    starts, ends, edges = word_spans(data, offsets)
    return word_hashes(data, starts, ends), edges


def _post(windows: Windows):
    def post(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        words, edges = _words(batch.column("_text"))
        values = np.where(boundaries(words), _pair(words, np.append(words[1:], words[:1])), np.uint64(2**64 - 1))
        starts, counts, anchors = stretches(values, edges, windows)
        if not len(starts):
            return None
        core = named(words, anchors - windows.first, np.full(len(starts), windows.core))
        content = with_place(named(words, starts, counts + windows.length - 1), anchors - starts)
        row = np.searchsorted(edges, starts, "right") - 1
        docs = batch.column("_doc").to_numpy()[row]
        return postings_batch(core, content, docs, starts - edges[row], counts)

    return post


def _fine(windows: Windows):
    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for part in slices(whole, "_text"):
                part = part.filter(pa.array(first_of_each(part.column("_doc"), seen)))
                if not part.num_rows:
                    continue
                words, edges = _words(part.column("_text"))
                (_, start, n, open_), row = unnested(part.column("asked"))
                n = n.astype(np.int64)
                at = ranges(start, n)
                row = np.repeat(row, n)
                names = named(words, at + edges[row], np.full(len(at), windows.length))
                docs = part.column("_doc").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(names)), pa.array(docs), pa.array(at), pa.array(np.repeat(open_.astype(bool), n))],
                    names=["name", "doc", "start", "open"],
                )

    def fine(asked: DataFrame, texts: DataFrame) -> DataFrame:
        rows = asked_stretches(asked, texts).mapInArrow(single, "name long, doc long, start long, open boolean")
        return met_twice(rows.distinct())

    return fine


def repeated_windows(docs: DataFrame, windows: Windows = WINDOW, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """`docs` with `_text` and `_doc`, and the windows of each `doc` that occur more than once."""
    texts = keyed(docs, text).drop(text)
    return texts, repeated(texts, _post(windows), _fine(windows))


def deduplicated(docs: DataFrame, windows: Windows = WINDOW, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `n_words`, `n_removed` and `kept`, the words left of each row joined by spaces (binary)."""
    texts, found = repeated_windows(docs.select(F.col(id).alias("_id"), text), windows, text)
    rows = texts.join(found.select(dealt_anew("doc", "_doc"), "intervals"), "_doc", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "_text"):
                counts, removed, kept = [], [], []
                for t, intervals in zip(part.column("_text").to_pylist(), part.column("intervals").to_pylist(), strict=True):
                    words = t.encode().split()  # on ASCII white space, as bytes are split
                    counts.append(len(words))
                    mask = covered(intervals, windows.length, len(words)) if intervals else None
                    removed.append(int(mask.sum()) if intervals else 0)
                    kept.append(b" ".join(w for w, gone in zip(words, mask.tolist(), strict=True) if not gone) if intervals else b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                    names=[id, "n_words", "n_removed", "kept", "kept_sha256"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, n_words long, n_removed long, kept binary, kept_sha256 string")


@query("op4_recompression")
def op4_recompression(spark, folder):
    """What is left of every document without the windows that repeat."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return deduplicated(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
