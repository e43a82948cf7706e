"""Suffix-array dedup: longest-previous-factor arrays over groups of text that may repeat.

In suffix order, the nearest suffix on either side that begins at a smaller position shares the longest prefix of all
that begin earlier; the longer of the two is the longest previous factor. Positions where it reaches the
length asked for begin a later copy. In the order of falling positions the same arrays give the earlier copies.

A suffix array of the whole corpus would need it in one place. Equal windows of 400 bytes lie in stretches of
equal keys (see `stretches`), so arrays over the stretches of a key, in tasks of bounded size, see every repeat. A key of
more stretches than a task should hold is handled by counting hashes of its windows in Spark: exact as well, and a hot
key is then counted map-side first.

Texts are UTF-8 bytes; matches do not cross documents. Bytes covered by a string of the length asked for that starts anywhere
else too are removed, all copies alike; `kept_first` leaves the first of them. A null text is empty.
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
from graphloom.llm.text import byte_rolling, dealt_anew, flat, ranges, signed, slices
from graphloom.operators.table import with_row_index
from graphloom.session import passing_tables, written

WINDOW = Windows(length=400, choices=128)
GROUP = 1024  # stretches of one key that a suffix array is built over; a key of more is counted by windows
_BLOCK = 1 << 19  # bytes of whole groups that are sorted at once
_CONTEXT = 8  # bytes whose hash orders the places as anchors


def ranks(data: np.ndarray, length: int, wanted: np.ndarray | None = None) -> list[tuple[int, np.ndarray]]:
    """Ranks of suffixes by their first 7, 14, ... and at last `length` bytes; what is past the end is least.

    Each is (bytes, rank by position); equal ranks are equal bytes. With `wanted`, a mask, the last ranks are those of
    these positions only, and the ones before are those that it takes to make them.
    """
    n = len(data)
    sizes = [7]
    while sizes[-1] < length:
        sizes.append(min(2 * sizes[-1], length))
    needed = [np.ones(n, bool) if wanted is None else wanted]
    for size, before in zip(sizes[:0:-1], sizes[-2::-1], strict=True):
        mask, step = needed[0].copy(), size - before
        mask[step:] |= needed[0][: n - step] if step < n else False
        needed.insert(0, mask)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data.astype(np.uint64) + np.uint64(1)  # 0 is past the end
    # Nine bits each: seven fit one number.
    key = np.zeros(n, np.uint64)
    for i in range(7):
        key = (key << np.uint64(9)) | padded[i : i + n]
    out = [(7, _dense(key, needed[0]))]
    for size, mask in zip(sizes[1:], needed[1:], strict=True):
        done, rank = out[-1]
        after = np.zeros(n, np.int64)
        if size - done < n:
            after[: n - size + done] = rank[size - done :] + 1
        out.append((size, _dense(rank.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64), mask)))
    return out


def _dense(keys: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Ranks of the keys in the mask, -1 elsewhere."""
    at = np.flatnonzero(mask)
    order = np.argsort(keys[at])
    ranked = keys[at[order]]
    rank = np.full(len(keys), -1, np.int64)
    rank[at[order]] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]])) if len(at) else 0
    return rank


def _nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each place, the nearest earlier place with a smaller value, -1 without one."""
    near = np.arange(-1, len(values) - 1)
    open_ = np.arange(len(values))
    while len(open_):
        open_ = open_[near[open_] >= 0]
        open_ = open_[values[near[open_]] > values[open_]]
        near[open_] = near[near[open_]]
    return near


def longest_previous_factors(
    data: np.ndarray, length: int, levels: list[tuple[int, np.ndarray]] | None = None, later: bool = False, whole: bool = False
) -> np.ndarray:
    """For each position, how many bytes from there also stand at some smaller position (a greater one with
    `later`), up to `length`; sources may overlap. Sorting stops at `length` bytes, beyond which ties need no order.
    With `whole`, factors shorter than `length` are left at 0, and only positions ranked in the last of `levels`
    take part."""
    levels = levels or ranks(data, length)
    n = len(data)
    order = np.flatnonzero(levels[-1][1] >= 0)
    order = order[np.argsort(levels[-1][1][order])]
    position = order if not later else n - 1 - order
    best = np.zeros(n, np.int64)
    before = _nearest_smaller(position)
    after = len(order) - 1 - _nearest_smaller(position[::-1])[::-1]
    for near in (before, after):
        real = (near >= 0) & (near < len(order))
        a, b = order[real], order[near[real]]
        if whole and levels[-1][0] == length:
            inside = (levels[-1][1][a] == levels[-1][1][b]) & (np.maximum(a, b) + length <= n)
            best[a[inside]] = length
            continue
        best[a] = np.maximum(best[a], _common(data, levels, a, b, length))
    return np.where(best >= length, best, 0) if whole else best


def _common(data: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Common prefixes of pairs of suffixes, up to `length`."""
    n = len(data)
    full = levels[-1][1][a] == levels[-1][1][b]
    shared = np.where(full, np.minimum(length, n - np.maximum(a, b)), 0)
    a, b, open_ = a.copy(), b.copy(), ~full
    for size, rank in reversed(levels[:-1]):
        for _ in range(2):
            inside = open_ & (np.maximum(a, b) + size <= n)
            hit = inside.copy()
            hit[inside] = rank[a[inside]] == rank[b[inside]]
            a[hit] += size
            b[hit] += size
            shared[hit] += size
    for _ in range(7):
        inside = open_ & (np.maximum(a, b) < n)
        inside[inside] = data[a[inside]] == data[b[inside]]
        open_ &= inside
        a[inside] += 1
        b[inside] += 1
        shared[inside] += 1
    return np.minimum(shared, length)


def _post(windows: Windows):
    def post(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, edges = flat(batch.column("_text"))
        if len(data) < windows.length:
            return None
        rolling = byte_rolling(data)
        context = min(_CONTEXT, windows.core)
        values = rolling.windows(context)
        starts, counts, anchors = stretches(np.append(values, np.zeros(len(data) - len(values), np.uint64)), edges, windows)
        if not len(starts):
            return None
        core = rolling.runs(anchors, anchors + windows.core)
        content = with_place(rolling.runs(starts, starts + counts + windows.length - 1), anchors - starts)
        row = np.searchsorted(edges, starts, "right") - 1
        docs = batch.column("_doc").to_numpy()[row]
        return postings_batch(core, content, docs, starts - edges[row], counts)

    return post


def _sorted_groups(windows: Windows):
    """Windows that repeat within the stretches of a key. Rows come sorted by key."""

    def flagged(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        # A value that is no byte stands after each stretch, so that nothing matches across two of them.
        data = np.concatenate([np.append(np.frombuffer(r[5], np.uint8).astype(np.int16), 256) for r in rows])
        first = np.cumsum([0, *(len(r[5]) + 1 for r in rows[:-1])])
        wanted = np.zeros(len(data), bool)
        wanted[ranges(first, np.array([r[3] for r in rows]))] = True
        levels = ranks(data, windows.length, wanted)
        earlier, later = (longest_previous_factors(data, windows.length, levels, later=way, whole=True) for way in (False, True))
        copied = np.maximum(earlier, later)
        begin = 0
        for _, doc, start, n, open_, text in rows:
            if open_:
                own = np.flatnonzero(copied[begin : begin + n] >= windows.length)
                for run in np.split(own, np.flatnonzero(np.diff(own) > 1) + 1):
                    if len(run):
                        yield doc, start + int(run[0]), len(run)
            begin += len(text) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, group, size, last = [], [], 0, None

        def made(rows) -> pa.RecordBatch:
            found = list(flagged(rows))
            columns = list(zip(*found, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32())], names=["doc", "start", "n"]
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last:
                    block += group
                    group, last = [], row[0]
                    if size > _BLOCK:
                        yield made(block)
                        block, size = [], 0
                group.append(row)
                size += len(row[5])
        if block or group:
            yield made(block + group)

    return run


def _fine(windows: Windows, group: int):
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for part in slices(whole, "_text"):
                part = part.filter(pa.array(first_of_each(part.column("_doc"), seen)))
                if not part.num_rows:
                    continue
                (key, start, n, open_), row = unnested(part.column("asked"))
                texts = [t.encode() for t in part.column("_text").to_pylist()]
                cut = [texts[r][a : a + m + windows.length - 1] for r, a, m in zip(row.tolist(), start.tolist(), n.tolist(), strict=True)]
                docs = part.column("_doc").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(docs), pa.array(start), pa.array(n), pa.array(open_.astype(bool)), pa.array(cut, pa.binary())],
                    names=["key", "doc", "start", "n", "open", "data"],
                )

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for part in slices(whole, "_text"):
                part = part.filter(pa.array(first_of_each(part.column("_doc"), seen)))
                if not part.num_rows:
                    continue
                data, edges = flat(part.column("_text"))
                rolling = byte_rolling(data)
                (_, start, n, open_), row = unnested(part.column("asked"))
                n = n.astype(np.int64)
                at, row = ranges(start, n), np.repeat(row, n)
                names = rolling.runs(at + edges[row], at + edges[row] + windows.length)
                docs = part.column("_doc").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(names)), pa.array(docs), pa.array(at), pa.array(np.repeat(open_.astype(bool), n))],
                    names=["name", "doc", "start", "open"],
                )

    def fine(asked: DataFrame, texts: DataFrame) -> DataFrame:
        sizes = asked.groupBy("key").agg(F.count("*").alias("size"))
        sized = written(asked.join(sizes, "key"), "asked")
        small, large = sized.where(F.col("size") <= group).drop("size"), sized.where(F.col("size") > group).drop("size")
        kind = "key long, doc long, start long, n int, open boolean, data binary"
        cut = asked_stretches(small, texts).mapInArrow(cut_out, kind).dropDuplicates(["key", "doc", "start"])
        dealt = cut.repartition("key").sortWithinPartitions("key", "doc", "start").select("key", "doc", "start", "n", "open", "data")
        by_arrays = dealt.mapInArrow(_sorted_groups(windows), "doc long, start long, n int")
        rows = asked_stretches(large, texts).mapInArrow(single, "name long, doc long, start long, open boolean")
        return by_arrays.unionByName(met_twice(rows.distinct()))

    return fine


def repeated_strings(docs: DataFrame, windows: Windows = WINDOW, text: str = "text", group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """`docs` with `_text` and `_doc`, and the windows of each `doc` that occur more than once."""
    texts = keyed(docs, text).drop(text)
    return texts, repeated(texts, _post(windows), _fine(windows, group))


def deduplicated(docs: DataFrame, windows: Windows = WINDOW, id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """`id`, `n_bytes`, `n_removed`, `n_spans` (runs removed), `kept` (what is left, binary) and its `kept_sha256`."""
    texts, found = repeated_strings(docs.select(F.col(id).alias("_id"), text), windows, text, group)
    rows = texts.join(found.select(dealt_anew("doc", "_doc"), "intervals"), "_doc", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "_text"):
                sizes, removed, spans, kept = [], [], [], []
                for t, intervals in zip(part.column("_text").to_pylist(), part.column("intervals").to_pylist(), strict=True):
                    data = t.encode()
                    sizes.append(len(data))
                    if intervals:
                        mask = covered(intervals, windows.length, len(data))
                        removed.append(int(mask.sum()))
                        spans.append(int((np.diff(mask.astype(np.int8), prepend=0) == 1).sum()))
                        data = np.frombuffer(data, np.uint8)[~mask].tobytes()
                    else:
                        removed.append(0)
                        spans.append(0)
                    kept.append(data)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary()),
                     pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                    names=[id, "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
                )

    kind = docs.schema[id].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id}` {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def kept_first(docs: DataFrame, windows: Windows = WINDOW, id: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """`id` and `kept` (binary): what is left of each row without later copies of strings that repeat, see `first_kept`."""
    left = first_kept(docs.select(id, text), windows, id, text, group)
    return left.select(F.col("_rest")[id].alias(id), "kept")


def _mostly_left(copies: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """A mask of the runs of `copies` of which less is `gone` than left."""
    run = np.cumsum(np.diff(copies.astype(np.int8), prepend=0) == 1)
    weight = np.bincount(run, np.where(gone, 1, -1) * copies)
    return copies & (weight[run] < 0)


def first_kept(
    docs: DataFrame, windows: Windows = WINDOW, id: str = "doc_id", text: str = "text", group: int = GROUP, give_way: bool = False
) -> DataFrame:
    """`_rest` (all columns but the text, as one struct), `kept` (binary): what is left of each row without later copies of strings that
    repeat, and `kept_text`: the same without the characters that lose a byte.

    The first of a string is the least by id (null last), hash of the text and position, and stays whole, also where a later
    copy of another string overlaps it. Of equal texts the row of the least id stays, one of them if ids are equal too.

    A passage that stands in many texts is met with the same letters around it in some of them. What it makes with these is a string of
    its own, whose first copy keeps nearly all of the passage in place. With `give_way`, later copies (runs of bytes that such strings
    cover) go as a whole where firsts that overlap them would leave more than goes.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_rest")
    numbered = docs.select(rest, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    numbered = numbered.withColumn("_id", F.col("_rest")[id])
    numbered = written(numbered, "numbered")
    with passing_tables() as tables:
        texts, found = repeated_strings(numbered, windows, "text", group)
        found = written(found, "repeated")
        tables.remove(found)
    first = F.min(F.struct(F.col("_id").isNull().alias("unnamed"), "_id", "_row")).alias("first")
    leading = texts.groupBy("_doc").agg(first).select(dealt_anew("_doc"), "first.unnamed", "first._id", F.col("first._row").alias("_leads"))
    of_doc = found.select(dealt_anew("doc", "_doc"), "intervals")
    rows = texts.join(leading.select("_doc", "_leads"), "_doc").withColumn("leads", F.col("_row") == F.col("_leads")).select("_rest", "_doc", "_text", "leads")
    rows = rows.join(of_doc, "_doc", "left")

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "_text"):
                data, edges = flat(part.column("_text"))
                rolling = byte_rolling(data)
                (start, n), row = unnested(part.column("intervals"))
                n = n.astype(np.int64)
                at, row = ranges(start, n), np.repeat(row, n)
                names = rolling.runs(at + edges[row], at + edges[row] + windows.length)
                yield pa.RecordBatch.from_arrays([pa.array(signed(names)), part.column("rank").take(pa.array(row)), pa.array(at)], names=["name", "rank", "start"])

    with passing_tables() as tables:  # the shuffle of the names ends here
        # A small number stands for the text in each of its windows.
        ranked = with_row_index(leading.join(of_doc.select("_doc"), "_doc").select("unnamed", "_id", "_doc", "_leads"), "unnamed", "_id", "_doc", name="rank")
        asked = texts.select("_doc", "_row", "_text").join(ranked.select(dealt_anew("_doc"), "_leads", "rank"), "_doc").where("_row = _leads")
        asked = asked.join(of_doc, "_doc").select("rank", "_text", "intervals")
        firsts = asked.mapInArrow(named, "name long, rank long, start long").groupBy("name").agg(F.min(F.struct("rank", "start")).alias("first"))
        firsts = firsts.groupBy(F.col("first.rank").alias("rank")).agg(F.collect_list("first.start").alias("firsts"))  # no more than the text has bytes
        firsts = written(firsts.join(ranked.select(dealt_anew("rank"), "_doc"), "rank").select("_doc", "firsts"), "firsts")
        tables.remove(firsts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "_text"):
                kept, kept_text = [], []
                columns = (part.column(c).to_pylist() for c in ("_text", "leads", "intervals", "firsts"))
                for t, leads, intervals, own in zip(*columns, strict=True):
                    if not intervals:
                        kept.append(t.encode())
                        kept_text.append(t)
                        continue
                    data = np.frombuffer(t.encode(), np.uint8)
                    later = np.zeros(len(data), bool)
                    later[ranges(np.array([x["start"] for x in intervals]), np.array([x["n"] for x in intervals]))] = True
                    first = np.zeros(len(data), bool)
                    if leads and own:
                        first[own] = True
                    one_each = lambda mask: [{"start": i, "n": 1} for i in np.flatnonzero(mask).tolist()]
                    copies = covered(one_each(later & ~first), windows.length, len(data))
                    gone = copies & ~covered(one_each(first), windows.length, len(data))
                    if give_way:
                        gone |= _mostly_left(copies, gone)
                    kept.append(data[~gone].tobytes())
                    character = np.cumsum(data & 0xC0 != 0x80) - 1
                    torn = np.zeros(len(data), bool)
                    torn[character[gone]] = True
                    kept_text.append(data[~torn[character]].tobytes().decode())
                yield pa.RecordBatch.from_arrays([part.column("_rest"), pa.array(kept, pa.binary()), pa.array(kept_text, pa.string())], names=["_rest", "kept", "kept_text"])

    out = rows.join(firsts.select(dealt_anew("_doc"), "firsts"), "_doc", "left")
    kind = numbered.schema["_rest"].dataType.simpleString()
    return out.select("_rest", "_text", "leads", "intervals", "firsts").mapInArrow(run, f"_rest {kind}, kept binary, kept_text string")


@query("op9_suffix_arrays")
def op9_suffix_arrays(spark, folder):
    """What is left of every document without the strings of 400 bytes that repeat."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
