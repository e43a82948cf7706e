"""Components next to comparing all pairs of documents."""

import random

import pytest

import graphloom.llm.jaccard_join as join
from graphloom.llm.components import components
from graphloom.llm.jaccard_join import near_components


def token_set(text):
    words = [w.decode() for w in (text or "").encode().split()]
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def roots_of(ids, edges):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def plain(docs):
    sets = {i: token_set(t) for i, t in docs}
    by_token = {}
    for i, s in sets.items():
        for token in s:
            by_token.setdefault(token, []).append(i)
    pairs = {(a, b) for own in by_token.values() for a in own for b in own if a < b}
    near = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    component = roots_of(sets, near)
    return [(i, len(sets[i]), component[i]) for i in sorted(sets)]


def found(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_components(frame).collect())


def check(spark, texts):
    docs = list(enumerate(texts))
    frame = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, set string").repartition(3)
    assert found(frame) == plain(docs)


def edited(words, vocabulary, edits, rnd):
    words = list(words)
    for _ in range(edits):
        at = rnd.randrange(len(words) + 1)
        words[at : at + rnd.choice([0, 1, 1, 2])] = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 1, 2]))]
    return words


def families(seed, vocabulary=400, bases=6, copies=14, length=(5, 160)):
    """Copies with few and many edits, some of them copies of copies, about the limit."""
    rnd = random.Random(seed)
    words = [f"W{i}" if i % 3 else f"w{i}" for i in range(vocabulary)]
    texts = []
    for _ in range(bases):
        family = [[rnd.choice(words) for _ in range(rnd.randint(*length))]]
        for _ in range(copies):
            family.append(edited(rnd.choice(family) or ["x"], words, rnd.randint(0, 4), rnd))
        texts += [" ".join(f) for f in family]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize(("seed", "frequent"), [(1, 100_000), (2, 0), (3, 7)])
def test_families_of_near_copies(spark, monkeypatch, seed, frequent):
    """Whatever is known about frequent tokens."""
    monkeypatch.setattr(join, "SAMPLE", 1)
    monkeypatch.setattr(join, "FREQUENT", max(frequent, 1))
    check(spark, families(seed))


def test_short_texts_and_a_common_passage(spark):
    rnd = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = families(4, vocabulary=3, bases=3, copies=10, length=(1, 12))
    texts += [f"{passage} {' '.join(f'w{rnd.randrange(9)}' for _ in range(rnd.randint(0, 14)))}" for _ in range(25)]
    check(spark, texts)


def test_isolated_pairs_at_the_limit(spark):
    """A set and what is left of it, or what it grows to, at 0.80 to 0.85 and next to nothing else."""
    texts = []
    for seed in range(600):
        rnd = random.Random(seed)
        n = rnd.randint(5, 40) if seed % 3 else rnd.randint(5, 500)
        words = [f"s{seed}w{i}" for i in range(n + 4)]
        share = rnd.uniform(0.80, 0.85)
        at = rnd.choice([0, len(words)])
        more = max(1, int(n / share) - n)
        grown = words[:at] + [f"s{seed}m{i}" for i in range(more)] + words[at:]
        texts += [" ".join(words), " ".join(grown)]
    check(spark, texts)


def test_odd_texts(spark):
    check(spark, ["", None, " \n ", "a", "A", "a b c d", "A B\tc  d", "a b c d e", "É a b c d", "é a b c d", "x " * 400, "x " * 500, "x x x x x y"])


def test_null_ids_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (6, ""), (None, "")], "doc_id long, text string")
    rows = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in near_components(frame).collect()), key=str)
    assert rows == [(0, 0, None), (0, 2, 5), (5, 2, 5), (5, 2, 5), (6, 0, 6)]
    assert near_components(frame.limit(0)).collect() == []


def test_every_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert found(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 130)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    nodes = {x for e in edges for x in e}
    rows = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = roots_of(nodes, edges)
    assert {n: rows.get(n, n) for n in nodes} == expected


def test_tokens_of_a_slice_take_little_memory():
    import tracemalloc

    import pyarrow as pa

    from graphloom.llm import jaccard_join as join
    from graphloom.llm.text import slices

    batch = pa.RecordBatch.from_arrays([pa.array([f"w{i} v{i} " * 3000 for i in range(160)])], names=["_text"])
    tracemalloc.start()
    parts = [len(join.token_sets(part.column("_text"))) for part in slices(batch, "_text", join.SLICE)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(parts) == 160 and peak < 100e6
