"""Secret scans: a keyword automaton, anchored regular expressions at its hits, checksums inside tokens.

One Aho-Corasick pass over each text finds the places where a secret may begin; the expression of its kind is tried
there and nowhere else. Runs of hexadecimal digits have no keyword and are found by their own expression. Kinds
with an embedded checksum are reported only if it holds.

Spans are `kind:start:end` in code points, end exclusive, by start and then by the order of the kinds. Of one kind, spans are
leftmost and do not overlap. A null text is empty and has none. Equal texts have equal spans.
"""

from __future__ import annotations

import hashlib
import re
import string
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from graphloom.llm.registry import query
from graphloom.llm.text import map_slices

_DIGITS = string.digits + string.ascii_uppercase + string.ascii_lowercase


def _base62_crc(token: str) -> bool:
    """The last six characters are the CRC-32 of the body, in base 62."""
    body, check = token[token.index("_") + 1 : -6], token[-6:]
    value = zlib.crc32(body.encode())
    digits = ""
    for _ in range(6):
        value, rest = divmod(value, 62)
        digits = _DIGITS[rest] + digits
    return digits == check


@dataclass(frozen=True)
class Kind:
    """`pattern` is tried where one of `keywords` begins. `holds` judges a match, which is passed over otherwise."""

    name: str
    pattern: str
    keywords: tuple[str, ...]
    any_case: bool = False
    holds: Callable[[re.Match], bool] = lambda match: True


#: The kinds that every scan has.
BASE = (
    Kind(
        "assign",
        r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        any_case=True,
        holds=lambda m: len(m[1]) >= 8,
    ),
    Kind("access", r"AKIA[A-Z0-9]+", ("AKIA",), holds=lambda m: len(m[0]) >= 16),
    Kind("hex", r"[0-9a-f]+", ()),
)
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Tokens whose last characters are a checksum of the others, and keys in armour.
CHECKED = (
    Kind("hub", r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), holds=lambda m: _base62_crc(m[0])),
    Kind("npm", r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])", ("npm_",), holds=lambda m: _base62_crc(m[0])),
    Kind("key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", ("-----BEGIN ",)),
)
KINDS = (*BASE, *CHECKED)

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class Scanner:
    def __init__(self, kinds: tuple[Kind, ...] = KINDS):
        import ahocorasick

        self.kinds = kinds
        self._patterns = [re.compile(k.pattern) for k in kinds]
        # Keywords are looked up in lower case; the expression tells the cases apart.
        starts: dict[str, list[int]] = {}
        for i, kind in enumerate(kinds):
            for word in kind.keywords:
                starts.setdefault(word.lower(), []).append(i)
        self._words = ahocorasick.Automaton()
        for word, own in starts.items():
            self._words.add_word(word, (len(word), own))
        self._words.make_automaton()
        self._hex = next((i for i, k in enumerate(kinds) if k.name == "hex"), None)

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """Start, place of the kind, end."""
        if not text:
            return []
        found, tried = [], {}
        # A keyword may end another one's hit at the same start, so starts are tried in order.
        hits = sorted({(end + 1 - size, i) for end, (size, own) in self._words.iter(text.translate(_LOWER)) for i in own})
        for start, i in hits:
            if start < tried.get(i, 0):
                continue
            match = self._patterns[i].match(text, start)
            if match:
                tried[i] = match.end()
                if self.kinds[i].holds(match):
                    found.append((start, i, match.end()))
        if self._hex is not None:
            found += [(m.start(), self._hex, m.end()) for m in _HEX.finditer(text)]
        return sorted(found)


@cache
def scanner() -> Scanner:
    """One automaton per worker."""
    return Scanner()


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def scanned(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, counts of the base kinds, and all spans as text with the digest of the base ones. A narrow step."""

    def work(batch):
        own = scanner()
        name = [k.name for k in own.kinds]
        counts = [[] for _ in BASE]
        digests, spans = [], []
        for t in batch.column(text).to_pylist():
            found = own.spans(t)
            written = [f"{name[i]}:{a}:{b}" for a, i, b in found]
            base = ",".join(w for w, (_, i, _) in zip(written, found, strict=True) if i < len(BASE))
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            spans.append(",".join(written))
            for i, column in enumerate(counts):
                column.append(sum(k == i for _, k, _ in found))
        arrays = [batch.column(id), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, names=[id, *(f"n_{k.name}" for k in BASE), "base_sha256", "spans"])

    kind = docs.schema[id].dataType.simpleString()
    columns = ", ".join(f"n_{k.name} long" for k in BASE)
    return map_slices(docs.select(id, text), work, f"`{id}` {kind}, {columns}, base_sha256 string, spans string", text)


def redacted_text(text: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced by `mark`; spans that overlap are one. Null stays null."""

    @F.pandas_udf("string")
    def redact(texts):
        return texts.map(lambda t: redact_one(t, mark), na_action="ignore")

    return redact(text)


def redact_one(text: str, mark: str = "[SECRET]") -> str:
    out, done = [], 0
    for start, _, end in scanner().spans(text):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


@query("op6_secret_scans")
def op6_secret_scans(spark, folder):
    """Secrets of every document."""
    return scanned(spark.read.parquet(f"{folder}/documents.parquet"))
