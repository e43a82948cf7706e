"""N-gram Jaccard join by a token-group matrix, exact at any size of a group of copies.

The tokens of a text are its distinct shingles: five neighbouring words, A-Z in lower case, or all words of a text that has
fewer. Two texts link when 100 * common >= 80 * all of their tokens. A text without words has none and links with nothing.

1. Texts of equal tokens are one set. Links need only be found between different sets.
2. Two linked sets share one of the first n - ceil(0.8 n) + 1 tokens of each, in any one order of all tokens. The order
   puts tokens of many sets last, as far as a bounded sample of the corpus shows them; it decides about work, never about
   results. Of these prefixes, tokens that occur in one prefix only are dropped. Behind the end of its own prefix another set
   may still have them, so their number bounds what a set can have in common only with sets whose prefixes end no earlier.
3. Similar sets are partitioned into groups: with a token, each set is compared with its centre, the one whose tokens are
   met most often in others (the text that copies were made of), and what links is a group.
4. The matrix has, for each token and group, what is known of the members that have it: how large they are, how much of the
   token's centre they have, how much else. That bounds what a set can have in common with them. Groups of several members
   also have the union of all their tokens, and a set with too few of its own in there does not open them. A set is
   compared with the members of another group only where token and bound allow a link, at the first token that both have: what
   comes before it in the common order they do not share. Members of one group need no comparing: they are
   tied already.

Rows of `documents` that repeat, null ids and texts, and other columns are handled: each row gets a row. A frequent
token lies on a side of its joins that adaptive execution can split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.components import components, tied
from graphloom.llm.fingerprints import shingles
from graphloom.llm.registry import query
from graphloom.llm.text import dealt_anew, map_slices, signed, slices
from graphloom.session import dropped, written

LARGE = 8  # members of a group whose tokens are brought together before it is opened
SKETCH = 8  # tokens of a set by which two sets know that they meet elsewhere too
SAMPLE = 16  # one text in so many is looked at for tokens of many sets
SLICE = 1 << 19  # bytes of text whose tokens a task makes at once: hashes and sums take some 50 times that
FREQUENT = 100_000  # tokens, the most frequent of the sample, that are put last: all that a task is given


def token_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted tokens of each text, as 64-bit hashes."""
    hashes, edges = shingles(column)
    return [np.unique(hashes[a:b]) for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)]


def set_name(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int) -> int:
    return n - (4 * n + 4) // 5 + 1 if n else 0


def in_common_order(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """Sorted tokens with the frequent ones put last, and how many are not frequent."""
    if not len(frequent):
        return tokens, len(tokens)
    last = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens
    return np.concatenate([tokens[~last], tokens[last]]), int((~last).sum())


def prefix_end(tokens: np.ndarray, frequent: np.ndarray) -> int:
    """Where the prefix of a set ends in the common order, as far as 31 bits tell."""
    ordered, rare = in_common_order(tokens, frequent)
    at = prefix_length(len(tokens)) - 1
    return (int(at >= rare) << 30) | (int(ordered[at]) >> 34)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    edges = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(edges, pa.array(signed(np.concatenate([*parts, np.zeros(0, np.uint64)]))))


def frequent_tokens(texts: DataFrame) -> np.ndarray:
    """Tokens that most of the sampled texts have in common, sorted; at most FREQUENT."""
    few = texts.where(F.xxhash64("_text") % SAMPLE == 0).groupBy(F.xxhash64("_text").alias("_key")).agg(F.min("_text").alias("_text"))

    def work(batch):
        return pa.RecordBatch.from_arrays([_lists(token_sets(batch.column("_text")))], names=["tokens"])

    counted = map_slices(few.select("_text"), work, "tokens array<long>", "_text", SLICE).select(F.explode("tokens").alias("token")).groupBy("token").count()
    found = counted.where("count > 2").orderBy(F.desc("count"), "token").limit(FREQUENT).select("token").collect()
    return np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))


def prefixes(texts: DataFrame, frequent: np.ndarray) -> DataFrame:
    """`token`, `set`, `place` of the prefix of every set, by its place in the common order; a task posts a set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for part in slices(whole, "_text", SLICE):
                names, tokens, places = [], [], []
                for own in token_sets(part.column("_text")):
                    name = set_name(own)
                    if not len(own) or name in seen:
                        continue
                    seen.add(name)
                    own, _ = in_common_order(own, frequent)
                    tokens.append(own[: prefix_length(len(own))])
                    names.append(np.full(len(tokens[-1]), name, np.int64))
                    places.append(np.arange(len(tokens[-1]), dtype=np.int32))
                if names:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(np.concatenate(tokens))), pa.array(np.concatenate(names)), pa.array(np.concatenate(places))], names=["token", "set", "place"]
                    )

    return texts.select("_text").mapInArrow(run, "token long, set long, place int")


def _most(end_a: Column, most_a: Column, first_b: Column, final_b: Column, most_b: Column) -> Column:
    """What two sets can have in common. What both have up to the end of the prefix that ends first is in both prefixes, so
    `most` of that set holds. `first_b` and `final_b` are the ends of several sets, or of one."""
    return F.when(end_a < first_b, most_a).when(end_a > final_b, most_b).otherwise(F.greatest(most_a, most_b))


def _bound(b: str, first: str, final: str) -> Column:
    """What a set can have in common with another, whose columns end in `b`: they meet in the centre or outside of it."""
    c = F.col
    least = lambda name: F.least(name, name + b)
    most = _most(c("end"), c("most"), c(first), c(final), c(f"most{b}"))
    return F.least(least("centre") + least("rest"), least("size"), most)


def _may_link(n_a: Column, n_b: Column, common: Column) -> Column:
    """Whether sets of these sizes, or larger ones, can be near with so much in common at most."""
    return 100 * common >= 80 * (n_a + F.greatest(n_b, common) - common)


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`a`, `b`, `common` and whether they are `near`, of each of the `pairs`. `sets` has the text of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "text_a", SLICE):
                texts = part.column("text_b").dictionary_encode()  # the other side is often the same
                of_b, which = token_sets(texts.dictionary), texts.indices.to_pylist()
                shared, near = [], []
                for x, i in zip(token_sets(part.column("text_a")), which, strict=True):
                    y = of_b[i]
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    shared.append(int((y[at] == x).sum()))
                    near.append(100 * shared[-1] >= 80 * (len(x) + len(y) - shared[-1]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(shared, pa.int64()), pa.array(near)], names=["a", "b", "common", "near"]
                )

    side = lambda s: sets.select(F.col("set").alias(s), F.col("text").alias(f"text_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long, common long, near boolean").distinct()


def linked_sets(texts: DataFrame) -> DataFrame:
    """`node`, `root`: the component of each set that links with another, by set names. `texts` has `_text`."""
    frequent = frequent_tokens(texts)
    found = prefixes(texts, frequent)
    shared = found.groupBy("token").count().where("count > 1").select(dealt_anew("token"))
    every = written(found.join(shared, "token", "left_semi").distinct(), "prefixes")
    # Copies may have been posted by several tasks: now that they are one, tokens of one set show.
    shared = every.groupBy("token").agg(F.count("*").alias("sets")).where("sets > 1").select(dealt_anew("token"), "sets")
    posted = written(every.join(shared, "token"), "shared-prefixes")
    dropped(every)

    kept = posted.select("set").distinct().select(dealt_anew("set"))
    sets = written(_texts_of(texts, kept, frequent), "sets")
    own = posted.groupBy("set").agg(F.count("*").alias("shared"), F.sum("sets").alias("met"))
    sizes = sets.select("set", "n", "end").distinct().join(own, "set")
    prefix = F.col("n") - F.floor((4 * F.col("n") + 4) / 5) + 1
    most = F.col("n") - (prefix - F.col("shared"))  # in common with sets whose prefixes end no earlier
    sizes = sizes.select("set", "n", "end", "met", most.alias("most"))
    rows = written(posted.drop("sets").join(sizes.select(dealt_anew("set"), "n", "end", "met", "most"), "set"), "matrix-rows")
    dropped(posted)

    c = F.col
    centre = F.min(F.struct((-c("met")).alias("order"), "n", "set", "most", "end")).alias("c")
    centres = rows.groupBy("token").agg(centre)
    centres = centres.select(dealt_anew("token"), c("c.set").alias("b"), c("c.n").alias("n_b"), c("c.most").alias("most_b"), c("c.end").alias("end_b"))
    upper = F.least("n", "n_b", _most(c("end"), c("most"), c("end_b"), c("end_b"), c("most_b")))
    centred = written(rows.join(centres, "token").withColumn("upper", upper).drop("end_b", "most_b"), "centred")
    dropped(rows)
    pairs = centred.where("set <> b").where(_may_link(F.col("n"), F.col("n_b"), F.col("upper")))
    checked = written(compared(pairs.select(F.col("set").alias("a"), "b").distinct(), sets), "compared")
    links = checked.where("near").select("a", "b")

    grouped = centred.join(checked.select(F.col("a").alias("set"), "b", "common"), ["set", "b"], "left")
    # A set that was not compared with the centre may share all that it shares with it, or outside of it.
    known = F.when(F.col("set") == F.col("b"), F.col("n")).otherwise(F.col("common"))
    rest = F.col("n") - F.coalesce(known, F.lit(0))
    grouped = grouped.select("token", "set", "place", "n", "end", "most", F.coalesce(known, "upper").alias("centre"), rest.alias("rest"))
    grouped = grouped.join(tied(links).select(dealt_anew("node", "set"), "root"), "set", "left")
    grouped = written(grouped.select("token", "set", "place", "n", "end", "most", "centre", "rest", F.coalesce("root", "set").alias("group")), "grouped")
    dropped(centred)
    groups = grouped.groupBy("token").agg(F.min("group").alias("least"), F.max("group").alias("most_")).where("least <> most_")
    contested = written(grouped.join(groups.select(dealt_anew("token")), "token", "left_semi"), "contested")
    dropped(grouped)
    least = F.slice(F.array_sort(F.collect_list(F.struct("place", "token"))), 1, SKETCH)["token"].alias("sketch")
    sketches = contested.groupBy("set").agg(least).select(dealt_anew("set"), "sketch")
    matrix = contested.groupBy("token", "group").agg(
        F.count("*").alias("members"), F.min("n").alias("n_other"), F.max("n").alias("size_other"), F.min("end").alias("first_other"),
        F.max("end").alias("final_other"), *[F.max(m).alias(f"{m}_other") for m in ("most", "centre", "rest")],
    )
    matrix = written(matrix, "matrix")
    sketched = written(contested.join(sketches, "set"), "sketched")
    dropped(contested)
    asking = sketched.join(matrix.select("token", "group", F.col("members").alias("beside")), ["token", "group"])
    # The smaller group asks the larger one.
    other = matrix.withColumnRenamed("group", "other")
    rank = lambda members, group: F.struct(F.col(members), F.col(group))
    asking = asking.withColumn("size", c("n"))
    open_ = asking.join(other, "token").where(rank("beside", "group") < rank("members", "other"))
    open_ = open_.where(_may_link(c("n"), c("n_other"), _bound("_other", "first_other", "final_other")))
    open_ = written(open_, "open")
    open_ = open_.join(_closed(open_, sketched, sets), ["set", "other"], "left_anti")
    known = ("n", "end", "most", "centre", "rest", "sketch", "place")
    members = sketched.select("token", c("group").alias("other"), c("set").alias("b"), *[c(m).alias(f"{m}_b") for m in known], c("n").alias("size_b"))
    pairs = open_.select("token", "other", c("set").alias("a"), *known, "size").join(members, ["token", "other"])
    # Two sets meet at the first token that both have, in the common order: what comes before it in either is not shared. Where that
    # is among the first contested tokens of both, they meet at no other.
    meet = F.get(F.array_intersect("sketch", "sketch_b"), F.lit(0))
    shared = F.least(c("n") - c("place"), c("n_b") - c("place_b"))
    first = (F.coalesce(meet, c("token")) == c("token")) & (100 * shared >= 80 * (c("n") + c("n_b") - shared))
    pairs = pairs.where(_may_link(c("n"), c("n_b"), _bound("_b", "end_b", "end_b")) & first).select("a", "b").distinct()
    return components(links.unionByName(compared(pairs, sets).where("near").select("a", "b")))


def _closed(asked: DataFrame, members: DataFrame, sets: DataFrame) -> DataFrame:
    """`set`, `other`: of the sets that ask a group of LARGE members or more, those with too few tokens in the union of all tokens of that
    group to be near any member. Smaller groups are cheaper to open than to bound."""
    groups = members.select("group", "set", "n").distinct()
    sizes = groups.groupBy("group").agg(F.count("*").alias("members"), F.min("n").alias("least")).where(F.col("members") >= LARGE)
    large = written(sizes.select(F.col("group").alias("other"), "least"), "large-groups")
    asked = written(asked.select("set", "n", "other").distinct().join(large.select(dealt_anew("other"), "least"), "other"), "asked-groups")
    beside = groups.withColumnRenamed("group", "other").join(asked.select("other").distinct().select(dealt_anew("other")), "other", "left_semi").select("other", "set")
    wanted = beside.select("set").unionByName(asked.select("set")).distinct()
    tokens = written(_tokens_of(sets.join(wanted.select(dealt_anew("set")), "set", "left_semi")), "all-tokens")
    union = beside.join(tokens, "set").select("other", "token").distinct()
    met = asked.join(tokens, "set").join(union.withColumn("in_union", F.lit(1)), ["other", "token"], "left")
    common = met.groupBy("set", "other").agg(F.count("in_union").alias("common"), F.min("n").alias("n"), F.min("least").alias("least"))
    return common.where(~_may_link(F.col("n"), F.col("least"), F.col("common"))).select("set", "other")


def _tokens_of(sets: DataFrame) -> DataFrame:
    """`set`, `token` of all tokens of sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "text", SLICE):
                tokens = token_sets(part.column("text"))
                names = np.repeat(part.column("set").to_numpy(), [len(x) for x in tokens])
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(signed(np.concatenate([*tokens, np.zeros(0, np.uint64)])))], names=["set", "token"])

    return sets.select("set", "text").mapInArrow(run, "set long, token long").distinct()  # a set may be there more than once


def _texts_of(texts: DataFrame, kept: DataFrame, frequent: np.ndarray) -> DataFrame:
    """`set`, `n`, the `end` of the prefix and one `text` of each set of `kept`; a task gives a set once."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for part in slices(whole, "_text", SLICE):
                own = token_sets(part.column("_text"))
                names = [set_name(x) for x in own]
                new = []
                for name, tokens in zip(names, own, strict=True):
                    new.append(len(tokens) > 0 and name not in seen)
                    seen.add(name)
                ends = [prefix_end(x, frequent) if fresh else 0 for x, fresh in zip(own, new, strict=True)]
                made = pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array([len(x) for x in own], pa.int64()), pa.array(ends, pa.int32()), part.column("_text")],
                    names=["set", "n", "end", "text"],
                )
                yield made.filter(pa.array(new, pa.bool_()))

    every = texts.select("_text").mapInArrow(named, "set long, n long, end int, text string").join(kept, "set", "left_semi")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in batches:
            new = []
            for name in part.column("set").to_pylist():
                new.append(name not in seen)
                seen.add(name)
            yield part.filter(pa.array(new, pa.bool_()))

    return every.mapInArrow(once, "set long, n long, end int, text string")


def near_components(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `n_shingles` and `component_id`, the least id that is reachable by links, of each row."""
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def work(batch):
        own = token_sets(batch.column("_text"))
        names = pa.array([set_name(x) if len(x) else None for x in own], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("_id"), names, pa.array([len(x) for x in own], pa.int64())], names=["_id", "set", "n"])

    kind = docs.schema[id].dataType.simpleString()
    rows = written(map_slices(texts, work, f"_id {kind}, set long, n long", "_text", SLICE), "set-names")
    linked = linked_sets(texts)
    of_set = rows.where("set is not null").groupBy("set").agg(F.min("_id").alias("least"))
    rooted = of_set.join(linked.withColumnRenamed("node", "set"), "set", "left").select("set", "least", F.coalesce("root", "set").alias("root"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(roots, "root").select(dealt_anew("set"), "component_id")
    out = rows.join(named, "set", "left")
    return out.select(F.col("_id").alias(id), F.col("n").alias("n_shingles"), F.coalesce("component_id", "_id").alias("component_id"))


@query("op2_jaccard_join")
def op2_jaccard_join(spark, folder):
    """The group of near copies of every document."""
    return near_components(spark.read.parquet(f"{folder}/documents.parquet"))
