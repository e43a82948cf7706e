"""Ids of a byte-level BPE with word ends, for many texts at once.

Texts are cut at ASCII white space, which no token crosses; different chunks are encoded once per slice. Chunks of
common characters are split and merged in flat arrays, the others are given to the tokenizer itself.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from graphloom.llm.sentencepiece_bpe import Merges
from graphloom.llm.text import ranges

_WORD_END = "</w>"
_KEPT_CHUNKS = 300_000  # whose ids a worker remembers before it starts anew; a matter of speed only
# Characters whose normal form is known to be their lower case, so that chunks of them can be split here.
_COMMON = "^[!-~À-ÖØ-öø-ÿ]*$"
_LETTERS = "a-zß-öø-ÿ"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\n{_LETTERS}0-9]+|\n")


def byte_characters() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself if printable, else the next free one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class WordModel:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        if model["end_of_word_suffix"] != _WORD_END:
            raise ValueError("a vocabulary without word ends is not supported")
        vocab = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges(
            [vocab[a] for a, _ in pairs], [vocab[b] for _, b in pairs], range(len(pairs)), [vocab[a + b] for a, b in pairs]
        )
        names = byte_characters()
        self.inner = np.array([vocab[c] for c in names], np.int32)
        self.last = np.array([vocab[c + _WORD_END] for c in names], np.int32)
        self._forget()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has. A null text is empty."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        chunks, edges = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        coded = chunks.dictionary_encode()
        which = self._rows(coded.dictionary)[coded.indices.to_numpy()]
        sizes = self._counts[which]
        total = np.concatenate([[0], np.cumsum(sizes)])[edges]
        return self._ids[ranges(self._begin[which], sizes)], np.diff(total)

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._ids, self._begin, self._counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _rows(self, chunks: pa.Array) -> np.ndarray:
        """Where the ids of different chunks are kept, after encoding those not met lately."""
        if len(self._known) > _KEPT_CHUNKS:
            self._forget()
        names = chunks.to_pylist()
        rows = np.fromiter((self._known.get(c, -1) for c in names), np.int64, len(names))
        new = np.flatnonzero(rows < 0)
        if len(new):
            ids, counts = self._chunks(chunks.take(pa.array(new)))
            rows[new] = np.arange(len(self._counts), len(self._counts) + len(new))
            self._known.update((names[i], r) for i, r in zip(new.tolist(), rows[new].tolist(), strict=True))
            self._begin = np.append(self._begin, len(self._ids) + np.cumsum(counts) - counts)
            self._counts = np.append(self._counts, counts)
            self._ids = np.append(self._ids, ids)
        return rows

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different chunks. Empty ones have none."""
        plain = pc.and_not(pc.match_substring_regex(chunks, _COMMON), pc.match_substring(chunks, "<|"))
        strange = pc.invert(plain)
        places = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        counts = np.zeros(len(chunks), np.int64)
        ids, sizes = self._split("\n".join(chunks.filter(plain).to_pylist()), len(places))
        others = [self.tokenizer.encode(c, add_special_tokens=False).ids for c in chunks.filter(strange).to_pylist()]
        counts[places] = sizes
        rest = np.flatnonzero(strange.to_numpy(zero_copy_only=False))
        counts[rest] = [len(x) for x in others]
        out = np.empty(int(counts.sum()), np.int32)
        begin = np.cumsum(counts) - counts
        out[ranges(begin[places], sizes)] = ids
        out[ranges(begin[rest], counts[rest])] = [i for x in others for i in x]
        return out, counts

    def _split(self, joined: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        words = pa.array(_SPLIT.findall(joined.lower()), pa.large_string()).dictionary_encode()
        which = words.indices.to_numpy()
        line = pc.index(words.dictionary, pa.scalar("\n", pa.large_string())).as_py()
        breaks = which == line
        chunk = np.cumsum(breaks)[~breaks]
        data = words.dictionary.cast(pa.large_binary())
        lengths = pc.binary_length(data).to_numpy()
        whole = np.frombuffer(b"".join(data.to_pylist()), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[whole]
        symbols[ends - 1] = self.last[whole[ends - 1]]
        ids, counts = self.merges.apply(symbols, ends - lengths)
        begin = np.cumsum(counts) - counts
        which = which[~breaks]
        sizes = np.bincount(chunk, weights=counts[which], minlength=n)[:n].astype(np.int64)
        return ids[ranges(begin[which], counts[which])], sizes


@cache
def word_model(path: str) -> WordModel:
    """One model per worker."""
    return WordModel(path)
