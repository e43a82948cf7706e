"""Hierarchical packing of documents into training sequences of several lengths.

Whole windows are cut off long documents; what is left of each is routed to the smallest context (tier) that holds it.
Windows of a tier are opened by its longest pieces, and their gaps filled with the best fitting pieces of the shorter
tiers; where none fits, one is cut. So every sequence is full: its length is one of the contexts. Less than one
window is left at the end of a partition and becomes sequences of powers of two. Sequences are dealt to step
groups of one length and of equal tokens.

Each partition packs its own rows, block by block, without an exchange. Every row has at least its end id,
null and empty texts too; repeated rows are packed each for itself.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from graphloom.llm.registry import query
from graphloom.llm.text import slices
from graphloom.llm.word_bpe import word_model

CONTEXTS = (256, 512, 1024, 2048)
STEP_WINDOWS = 8  # longest windows whose tokens make a step
_SEQUENCE_BITS = 40

_SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context long, step_group long"
)


class Packer:
    """Pieces waiting for a window, by tier, shortest first. A piece is (length, number, document, start, ids, all tokens)."""

    def __init__(self, contexts: tuple[int, ...] = CONTEXTS):
        if any(c & (c - 1) for c in contexts):
            raise ValueError("contexts must be powers of two")
        self.contexts = tuple(sorted(contexts))
        self.tiers: list[list[tuple]] = [[] for _ in self.contexts]
        self.pieces = 0

    def _put(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        tier = next(i for i, c in enumerate(self.contexts) if len(ids) <= c)
        self.pieces += 1
        insort(self.tiers[tier], (len(ids), self.pieces, doc, start, ids, total))

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple[int, list[tuple]]]:
        """Whole windows of a document; the rest of it waits."""
        longest = self.contexts[-1]
        whole = len(ids) // longest * longest
        for start in range(0, whole, longest):
            self.pieces += 1
            yield longest, [(longest, self.pieces, doc, start, ids[start : start + longest], len(ids))]
        if whole < len(ids):
            self._put(doc, whole, ids[whole:], len(ids))

    def _fitting(self, gap: int, top: int) -> tuple | None:
        """The longest piece of the tiers up to `top` that is no longer than `gap`."""
        for tier in self.tiers[top::-1]:
            at = bisect_right(tier, gap, key=lambda piece: piece[0])
            if at:
                return tier.pop(at - 1)
        return None

    def _cut(self, gap: int, top: int) -> tuple | None:
        """The beginning of the shortest piece longer than `gap`; the rest waits on."""
        for tier in self.tiers[: top + 1]:
            at = bisect_right(tier, gap, key=lambda piece: piece[0])
            if at < len(tier):
                _, number, doc, start, ids, total = tier.pop(at)
                self._put(doc, start + gap, ids[gap:], total)
                return gap, number, doc, start, ids[:gap], total
        return None

    def full(self) -> Iterator[tuple[int, list[tuple]]]:
        """Windows that can be filled now. Less than the longest one is left in each tier."""
        for top in range(len(self.contexts) - 1, -1, -1):
            while self.tiers[top]:
                gap, parts = self.contexts[top], []
                while gap and (piece := self._fitting(gap, top) or self._cut(gap, top)):
                    parts.append(piece)
                    gap -= piece[0]
                if gap:
                    for _, _, doc, start, ids, total in parts:
                        self._put(doc, start, ids, total)
                    break
                yield self.contexts[top], parts

    def rest(self) -> Iterator[tuple[int, list[tuple]]]:
        """What is left, as sequences of powers of two."""
        left, top = sum(piece[0] for tier in self.tiers for piece in tier), len(self.tiers) - 1
        while left:
            size = gap = min(1 << (left.bit_length() - 1), self.contexts[-1])
            parts = []
            while gap:
                piece = self._fitting(gap, top) or self._cut(gap, top)
                parts.append(piece)
                gap -= piece[0]
            left -= size
            yield size, parts


class Steps:
    """Numbers of step groups: a group has sequences of one length, and as many tokens as any other of it."""

    def __init__(self, tokens: int):
        self.tokens, self.groups, self.room = tokens, 0, {}

    def next(self, context: int) -> int:
        group, room = self.room.get(context, (0, 0))
        if room < context:
            group, room = self.groups, self.tokens
            self.groups += 1
        self.room[context] = (group, room - context)
        return group


def packed(
    docs: DataFrame,
    tokenizer: str,
    contexts: tuple[int, ...] = CONTEXTS,
    end_id: int = 1,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: its document, place there, and place in a sequence. Other columns of `docs` are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << _SEQUENCE_BITS
        packer, steps, sequences = Packer(contexts), Steps(STEP_WINDOWS * max(contexts)), 0

        def batch(windows) -> pa.RecordBatch | None:
            nonlocal sequences
            rows = []
            for context, parts in windows:
                offset, step = 0, first + steps.next(context)
                for length, _, doc, start, ids, total in parts:
                    crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
                    rows.append((doc, start, length, crc, total, first + sequences, offset, context, step))
                    offset += length
                sequences += 1
            if not rows:
                return None
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names=[id, *names])

        kind = None
        for whole in batches:
            kind = whole.column(id).type
            for part in slices(whole, text):
                ids, counts = word_model(tokenizer).encode(part.column(text))
                edges = np.concatenate([[0], np.cumsum(counts)]).tolist()
                windows = []
                for doc, a, b in zip(part.column(id).to_pylist(), edges, edges[1:], strict=False):
                    windows += packer.add(doc, np.append(ids[a:b], np.int32(end_id)))
                windows += packer.full()
                if (made := batch(windows)) is not None:
                    yield made
        if kind is not None and (made := batch(packer.rest())) is not None:
            yield made

    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"`{id}` {kind}, {_SCHEMA}")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op7_packing")
def op7_packing(spark, folder):
    """All documents packed into sequences of up to 2,048 tokens."""
    return packed(spark.read.parquet(f"{folder}/documents.parquet"), tokenizer_path())
