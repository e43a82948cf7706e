"""The trie next to a plain one, of short, deep, equal, empty and repeated conversations."""

import hashlib
import random
import zlib

import pytest

from graphloom.llm import prefix_trie as trie
from graphloom.llm import queries
from graphloom.llm.prefix_trie import prefix_trie


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))

    def order(t):
        return (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}:{t[2]}".encode()).hexdigest())

    own = {c: [t[1:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append((c, d == len(whole)))
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        below = [total[c] for c in children.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        total[node] = (sum(x for x, _ in below) or 1, saved + sum(x for _, x in below))
    return sorted(
        (
            min(members[n])[0], len(n), min(members[n[:-1]])[0] if n else -1, len(members[n]), len(children.get(n, [])), *total[n],
            hashlib.sha256(",".join(str(c) for c, last in sorted(members[n]) if last).encode()).hexdigest(),
        )
        for n in members
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(frame):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in frame.collect())


def check(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, depth int, a int").repartition(3)
    assert found(prefix_trie(frame)) == plain(rows)


def test_hard_rows(spark):
    rows = [(c, t, "user", f"{t}") for c in (0, 1, 2, 3, 104, 205, 206) for t in range(4)]
    rows += [(7, None, None, None), (7, None, "", "x"), (7, 3, "user", "é😀"), (7, 3, "user", "é😀"), (7, 3, "bot", "z"), (None, 0, "user", "lost")]
    rows += [(300, 0, "user", "one"), *((300 + i, 0, "user", "own") for i in range(1, 9)), (901, 0, "u", "turnless, as no 900 is there"), (902, 5, None, "x" * 2_000_000)]
    rows += [(1000, 0, "a:b", "c"), (2000, 0, "a", "b:c")]
    check(spark, rows)


def test_no_conversations(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])


def test_a_deep_conversation_and_its_variants(spark):
    rnd = random.Random(3)
    long = [rnd.choice("ab") for _ in range(75)]
    rows = [(400, t, "user", x) for t, x in enumerate(long)]
    for c in range(401, 440):
        cut = rnd.randrange(76)
        rows += [(c, t, "user", x) for t, x in enumerate(long[:cut] + [rnd.choice("abc") for _ in range(rnd.randrange(4))])]
    check(spark, rows)


@pytest.mark.parametrize("piece", [1, 3])
def test_many_equal_conversations(spark, monkeypatch, piece):
    monkeypatch.setattr(trie, "_PIECE", piece)
    check(spark, [(c, t, "user", x) for c in range(300) for t, x in enumerate("abcdefg" if c % 3 else "abcdefgh")])


def test_query(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = queries()["op12_prefix_trie"](spark, folder)
    assert {t for c, t in out.dtypes if c != "ends_sha256"} == {"bigint"}
    assert found(out) == plain(rows)
