"""SentencePiece encoding and decoding by vectorised merge rounds.

A slice of texts becomes one flat array of characters, cut wherever two characters stand side by side in no piece
of the vocabulary, so that no merge can cross. Different words are merged once per slice, all at the same time: each round
finds the best pair of every word by a segmented minimum, merges its leftmost place (all its places where
that provably comes to the same), and compacts the arrays, until no pair is left.

A null text is empty. Empty texts have the begin and end ids alone. Equal texts get equal ids.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm.registry import query
from graphloom.llm.text import map_slices, ranges

_NONE = np.int32(2**31 - 1)
_SPACE = "▁"
_NORMAL, _BYTE, _CONTROL, _UNKNOWN = 1, 6, 3, 2  # kinds of pieces in the model's file


class Merges:
    """Pairs of symbols, the rank of each (least first) and the symbol it becomes."""

    def __init__(self, left, right, rank, merged):
        self.rank, self.merged = np.asarray(rank, np.int32), np.asarray(merged, np.int32)
        left, right = np.asarray(left, np.int64), np.asarray(right, np.int64)
        bits = max(10, int(len(left) * 4).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self._keys, self._entries = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        keys = (left << 32) | right
        todo, slots = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self._keys[slots] < 0
            _, first = np.unique(np.where(free, slots, -1), return_index=True)
            first = first[free[first]]
            self._keys[slots[first]], self._entries[slots[first]] = keys[todo[first]], todo[first]
            rest = np.ones(len(todo), bool)
            rest[first] = False
            todo, slots = todo[rest], (slots[rest] + 1) & self._mask
        # A pair may be merged everywhere at once if what it becomes is in no pair of the same or a better rank.
        best = np.full(int(max(left.max(), right.max(), self.merged.max())) + 1, _NONE)
        np.minimum.at(best, left, self.rank)
        np.minimum.at(best, right, self.rank)
        self.everywhere = best[self.merged] > self.rank

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The entry of each pair, -1 without one."""
        keys = (left.astype(np.int64) << 32) | right
        slots = self._slot(keys)
        met = self._keys[slots]
        found = np.where(met == keys, self._entries[slots], np.int32(-1))
        open_ = np.flatnonzero((met != keys) & (met >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self._mask
            met = self._keys[slots[open_]]
            hit = met == keys[open_]
            found[open_[hit]] = self._entries[slots[open_[hit]]]
            open_ = open_[~hit & (met >= 0)]
        return found

    def apply(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left of each word, and how many. Words are not empty; `starts` are their first places."""
        words = len(starts)
        lengths = np.diff(np.append(starts, len(symbols)))
        symbols, word = symbols.astype(np.int32), np.repeat(np.arange(words), lengths)
        entry = np.full(len(symbols), -1, np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        entry[inner] = self.find(symbols[inner], symbols[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            rank = np.where(entry >= 0, self.rank[entry], _NONE)
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.append(first, len(word)))
            ended = np.repeat(best == _NONE, sizes)
            if ended.any():
                done.append((word[ended], symbols[ended]))
                going = ~ended
                symbols, word, entry, rank = symbols[going], word[going], entry[going], rank[going]
                best, sizes = best[best != _NONE], sizes[best != _NONE]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            leading = np.diff(word[at], prepend=-1) != 0
            follows = np.concatenate([[False], (at[1:] == at[:-1] + 1) & ~leading[1:]])
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            even = (np.arange(len(at)) - run) % 2 == 0
            at = at[leading | (even & self.everywhere[entry[at]])]
            symbols[at] = self.merged[entry[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, word, entry = symbols[keep], word[keep], entry[keep]
            at -= np.arange(len(at))
            again = np.concatenate([at, at[at > 0] - 1])
            last = again == len(symbols) - 1
            entry[again[last]] = -1
            again = again[~last]
            same = word[again] == word[again + 1]
            entry[again[~same]] = -1
            again = again[same]
            entry[again] = self.find(symbols[again], symbols[again + 1])
        word = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        symbols = np.concatenate([s for _, s in done]) if done else np.zeros(0, np.int32)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=words)


class PieceModel:
    """Vocabulary and merges of a SentencePiece model of the BPE kind with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("a model that rewrites texts is not supported")
        self.prefix = _SPACE if spec.add_dummy_prefix else ""
        pieces = list(model.pieces)
        self.begin = next(i for i, p in enumerate(pieces) if p.piece == "<s>")
        self.end = next(i for i, p in enumerate(pieces) if p.piece == "</s>")
        normal = {p.piece: i for i, p in enumerate(pieces) if p.type == _NORMAL}
        self.n = len(pieces)
        self.bytes_ = np.zeros(256, np.int32)
        surface = []
        for i, p in enumerate(pieces):
            if p.type == _BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes_[value] = i
                surface.append(bytes([value]))
            else:
                surface.append({_CONTROL: "", _UNKNOWN: " ⁇ "}.get(p.type, p.piece.replace(_SPACE, " ")).encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_length = np.array([len(x) for x in surface], np.int64)
        self.surface_start = np.cumsum(self.surface_length) - self.surface_length
        self.spaced = np.array([p.piece.startswith(_SPACE) for p in pieces])
        # Characters are pieces where the vocabulary has them, else symbols after the last piece.
        self.symbol = np.arange(0x110000, dtype=np.int32) + np.int32(self.n)
        for piece, i in normal.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        name = lambda part: int(self.symbol[ord(part)]) if len(part) == 1 else normal.get(part)
        order = {s: r for r, s in enumerate(sorted({pieces[i].score for i in normal.values()}, reverse=True))}
        table = []
        self._joined = np.zeros(1 << 20, bool)
        for piece, i in normal.items():
            codes = np.array([ord(c) for c in piece], np.int64)
            self._joined[self._pair(codes[:-1], codes[1:])] = True
            for cut in range(1, len(piece)):
                left, right = name(piece[:cut]), name(piece[cut:])
                if left is not None and right is not None:
                    table.append((left, right, order[pieces[i].score], i))
        self.merges = Merges(*zip(*table, strict=True))

    @staticmethod
    def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """A place in a table of pairs. Pairs that share one only leave words longer than they need be."""
        return (left * 0x9E37 + right * 0x85EB + (left >> 7)) & ((1 << 20) - 1)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with begin and end ids, and how many each has."""
        parts = [self.prefix + t.replace(" ", _SPACE) if t else "" for t in texts]
        whole = "".join(parts)
        edges = np.cumsum([0, *map(len, parts)])
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32).astype(np.int64)
        if not len(codes):
            return np.tile(np.array([self.begin, self.end], np.int32), len(texts)), np.full(len(texts), 2)
        cut = np.ones(len(codes), bool)
        cut[1:] = ~self._joined[self._pair(codes[:-1], codes[1:])]
        cut[edges[:-1][edges[:-1] < len(codes)]] = True
        starts = np.flatnonzero(cut)
        width = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
        places = np.concatenate([[0], np.cumsum(width)])
        offsets = places[np.append(starts, len(codes))]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(whole.encode())])
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy()
        # The first place of each different word stands for it.
        first = np.zeros(len(coded.dictionary), np.int64)
        first[which[::-1]] = starts[::-1]
        long = np.diff(np.append(starts, len(codes)))
        lengths = np.zeros(len(first), np.int64)
        lengths[which] = long
        symbols = self.symbol[codes[ranges(first, lengths)]]
        symbols, counts = self.merges.apply(symbols, np.cumsum(lengths) - lengths)
        symbols, counts = self._fallen_back(symbols, counts)
        begin = np.cumsum(counts) - counts
        sizes = counts[which]
        ids = symbols[ranges(begin[which], sizes)]
        totals = np.add.reduceat(np.append(sizes, 0), np.searchsorted(starts, edges[:-1])) if len(texts) else np.zeros(0, np.int64)
        totals[np.diff(edges) == 0] = 0
        out = np.empty(len(ids) + 2 * len(texts), np.int32)
        at = np.cumsum(totals + 2) - (totals + 2)
        out[at], out[at + totals + 1] = self.begin, self.end
        out[ranges(at + 1, totals)] = ids
        return out, totals + 2

    def _fallen_back(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        strange = np.flatnonzero(symbols >= self.n)
        if not len(strange):
            return symbols, counts
        coded = [chr(c - self.n).encode() for c in symbols[strange].tolist()]
        size = np.ones(len(symbols), np.int64)
        size[strange] = [len(x) for x in coded]
        out = np.repeat(symbols, size)
        begin = np.cumsum(size) - size
        out[ranges(begin[strange], size[strange])] = self.bytes_[np.frombuffer(b"".join(coded), np.uint8)]
        total = np.concatenate([[0], np.cumsum(size)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return out, total[edges[1:]] - total[edges[:-1]]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts as UTF-8, without the space that encoding has put before each."""
        lengths = self.surface_length[ids]
        data = self.surface[ranges(self.surface_start[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edges = np.concatenate([[0], np.cumsum(counts)])
        first = np.minimum(edges[:-1] + 1, len(ids) - 1) if len(ids) else edges[:-1]
        drop = self.spaced[ids[first]].astype(np.int64) if self.prefix else np.zeros(len(first), np.int64)
        return [data[a:b] for a, b in zip((ends[edges[:-1]] + drop).tolist(), ends[edges[1:]].tolist(), strict=True)]


@cache
def piece_model(path: str) -> PieceModel:
    """One model per worker."""
    return PieceModel(path)


def encoded(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and `ids`, with begin and end ids, of each row. A narrow step."""

    def work(batch):
        ids, counts = piece_model(model).encode(batch.column(text).to_pylist())
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), ids)
        return pa.RecordBatch.from_arrays([batch.column(id), lists], names=[id, "ids"])

    kind = docs.schema[id].dataType.simpleString()
    return map_slices(docs.select(id, text), work, f"`{id}` {kind}, ids array<int>", text)


def round_trip(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the ids of each row, and of the text decoded from them. A narrow step."""

    def work(batch):
        pieces = piece_model(model)
        ids, counts = pieces.encode(batch.column(text).to_pylist())
        data = ids.astype("<u4").tobytes()
        edges = (4 * np.concatenate([[0], np.cumsum(counts)])).tolist()
        return pa.RecordBatch.from_arrays(
            [
                batch.column(id),
                pa.array(counts, pa.int64()),
                pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(edges, edges[1:], strict=False)], pa.string()),
                pa.array([hashlib.sha256(t).hexdigest() for t in pieces.decode(ids, counts)], pa.string()),
            ],
            names=[id, "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = docs.schema[id].dataType.simpleString()
    return map_slices(
        docs.select(id, text), work, f"`{id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string", text
    )


@query("op5_sentencepiece")
def op5_sentencepiece(spark, folder):
    """Every document encoded, and decoded again."""
    import public_tokenizers

    return round_trip(spark.read.parquet(f"{folder}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
