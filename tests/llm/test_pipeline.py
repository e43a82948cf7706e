"""The pipeline next to plain versions of its stages."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from graphloom.llm.packing import tokenizer_path
from graphloom.llm.pipeline import STAGES
from graphloom.llm.quality_rules import _STOP_WORDS
from graphloom.llm.secret_scans import redact_one
from tests.llm.test_jaccard_join import plain as plain_components
from tests.llm.test_quality import plain as plain_measures

NAMES = ["quality_rules", "jaccard_join", "suffix_arrays", "secret_scans", "packing"]


def kept(text):
    n_words, chars, symbols, dup_lines, repeated = plain_measures(text)
    text = text or ""
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    if n_words < 50 or 2 * repeated > n_words or 10 * symbols > n_words or not 2 * n_words <= chars <= 20 * n_words:
        return False
    capitals = sum("A" <= c <= "Z" for c in text)
    return not (2 * dup_lines > len(lines) or (n_words >= 100 and not set(words) & set(_STOP_WORDS)) or 5 * capitals > 2 * chars)


def without_repeats(docs, k=200):
    """Texts by id without later copies of what repeats; the first is that of the least id, then of the least place."""
    data = [t.encode() for _, t in docs]
    met = Counter(d[i : i + k] for d in data for i in range(len(d) - k + 1))
    seen, out = set(), {}
    for (x, _), d in sorted(zip(docs, data, strict=True)):
        stays, gone = np.zeros(len(d), bool), np.zeros(len(d), bool)
        for i in range(len(d) - k + 1):
            if met[d[i : i + k]] > 1:
                (gone if d[i : i + k] in seen else stays)[i : i + k] = True
                seen.add(d[i : i + k])
        gone &= ~stays
        at, left = 0, []
        for c in d.decode():
            if not gone[at : at + len(c.encode())].any():
                left.append(c)
            at += len(c.encode())
        out[x] = "".join(left)
    return out


def plain(docs):
    """The texts by id that reach packing, after each stage."""
    first = {i: t for i, t in docs if kept(t)}
    root = {i: c for i, _, c in plain_components(list(first.items()))}
    second = {i: t for i, t in first.items() if root[i] == i}
    third = {i: t for i, t in without_repeats(list(second.items())).items() if t.strip(" \t\n\x0b\x0c\r")}
    return [first, second, third, {i: redact_one(t) for i, t in third.items()}]


def texts_of(pieces, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    length = defaultdict(int)
    for r in pieces:
        length[r.doc_id] += r.length
    assert dict(length) == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in docs.items()}


@pytest.fixture(scope="module")
def documents():
    rnd = random.Random(8)
    words = [w + x for w in "the of and to alpha beta gamma delta".split() for x in ("", "n", "r", "st")]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, docs = text(90), []
    for i in range(30):
        own = text(rnd.randint(30, 160))
        if i % 5 == 0:
            own = own[: len(own) // 2] + f" {passage} " + own[len(own) // 2 :]
        if i % 4 == 0:
            own += " password=abcdefgh1234"
        docs.append(own)
    docs += [docs[3], docs[6] + " more", docs[6].upper(), "", None, "### " * 80, text(49)]
    return list(enumerate(docs))


def test_each_stage_and_the_whole(spark, documents, tmp_path):
    rows = [(i, t, "en", "s", len(t or ""), "x") for i, t in documents]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _text string").repartition(3)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    expected, docs = plain(documents), frame
    for (_, stage), texts in zip(STAGES, expected, strict=False):
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
        found = docs.collect()
        assert {r.doc_id: r.text for r in found} == texts and len(found) == len(texts)
        assert all(r.n_chars == len(r.text) and r["_text"] == "x" for r in found)
    texts_of(corpus_pipeline.run(spark, str(tmp_path)).collect(), expected[-1])


def test_rows_that_repeat_null_ids_and_no_rows(spark, documents):
    texts = [t for _, t in documents if kept(t)][:3]
    rows = [(1, texts[0], "a"), (1, texts[0], "a"), (None, texts[0], "b"), (None, texts[1], "c"), (1, texts[2], "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    joined = STAGES[1][1](spark, frame, "")
    assert sorted((r.doc_id or 0, r.lang) for r in joined.collect()) == [(0, "c"), (1, "a"), (1, "d")]
    for _, stage in STAGES:
        assert stage(spark, frame.limit(0), "").collect() == []


def test_every_document(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    expected = plain([(r.doc_id, r.text) for r in docs.collect()])
    texts_of(entry.queries()["pipeline"](spark, folder).collect(), expected[-1])


def test_passages_stay_once(spark):
    """Passages of over 50 words of each of four documents: one copy of each is left, and nothing else is lost."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [text(rnd.randint(51, 90)) for _ in range(40)]
    docs = [text(rnd.randint(60, 200)) for _ in range(160)]
    whole = [f"{d[: len(d) // 2]}\n{passages[i % 40]}\n{d[len(d) // 2 :]}" for i, d in enumerate(docs)]
    frame = spark.createDataFrame(list(enumerate(whole)) + [(1000 + i, text(80)) for i in range(40)], "doc_id long, text string")
    left = {r.doc_id: r.text for r in STAGES[2][1](spark, frame.repartition(5), "").collect()}
    of = lambda p: [i for i, t in left.items() if passages[p] in t]
    assert [of(p) for p in range(40)] == [[p] for p in range(40)]
    assert all(len(left[i]) >= len(docs[i]) - 4 and left[i].startswith(d[: len(d) // 2 - 4]) and left[i].endswith(d[-(len(d) // 2 - 4) :]) for i, d in enumerate(docs))
    assert {i: t for i, t in left.items() if i >= 1000} == {r.doc_id: r.text for r in frame.where("doc_id >= 1000").collect()}


def test_passages_stay_once_whatever_is_beside_them(spark):
    """The letters next to a passage are the same in some documents: the first with these keeps no copy of the passage."""
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [text(n).encode()[:size].decode(errors="ignore") for n, size in ((70, 280), (110, 600))]
    for passage in passages:
        halves = [(text(60), text(60)) for _ in range(24)]
        beside = [("abcd"[i % 4], "stuvwx"[i // 4]) for i in range(24)]
        rows = [(i, f"{a} {x}\n{passage}\n{y} {b}") for i, ((a, b), (x, y)) in enumerate(zip(halves, beside, strict=True))]
        left = {r.doc_id: r.text for r in STAGES[2][1](spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()}
        assert left[0] == rows[0][1]
        for i, (a, b) in enumerate(halves):
            assert left[i].startswith(a[:-20]) and left[i].endswith(b[20:])  # words of a document too may be beside a passage elsewhere
            assert i == 0 or 2 * (len(left[i]) - len(a) - len(b)) <= len(passage) + 12, (i, len(passage), len(left[i]) - len(a) - len(b))


@pytest.mark.parametrize("change", [str, str.upper])
def test_columns_of_any_name(spark, documents, change):
    names = [change(n) for n in "_given _parts _rest _row _id _doc _text kept kept_text measures failed base_failed leads intervals first firsts component_id set token".split()]
    texts = [t for _, t in documents if kept(t)][:4]
    docs = spark.createDataFrame([(i, t, *range(len(names))) for i, t in enumerate(texts)], ["doc_id", "text", *names])
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", *names]
        assert {tuple(r)[2:] for r in docs.collect()} == {tuple(range(len(names)))}


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    assert corpus_pipeline.ORACLE_SQL is None


def test_the_join_leaves_one_table(spark):
    """Its tables hold the texts once more: only the one that the rows are taken from stays."""
    from pathlib import Path

    from graphloom.llm.pipeline import jaccard_join
    from graphloom.session import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    docs = spark.createDataFrame([(i, " ".join(f"w{(i // 2) * k % 89}" for k in range(60 + i % 2))) for i in range(20)], "doc_id long, text string")
    before = set(folder.iterdir())
    rows = jaccard_join(spark, docs, "")
    left = [p.name for p in folder.iterdir() if p not in before and p.is_dir()]
    assert rows.count() > 0 and len(left) == 1, left
