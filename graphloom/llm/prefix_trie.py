"""The trie of conversations' prefixes by Van Emde Boas recursion, over any depth, in rounds that grow with its logarithm.

A conversation is a sequence of turns (role, text); a node of depth d is a sequence that d first turns spell. The range of depths is cut in
half: the prefix up to the cut is named, the trie of the upper halves and the forests below each name are built
the same way, both at once, and the forests' totals are grafted upward onto the names that they hang from. Every round is a
few DataFrame operations over one level of cuts, all of them in parallel:

1. Bottom up, the turns of each aligned block of 2, 4, 8, ... are hashed from the two blocks that it is made of.
2. Top down, a prefix that ends in the middle of a block is named by the name at the block's beginning and the hash of its first
   half. A depth is the middle of one block only, so each turn is named once.
3. Names are counted: what remains are nodes, each known by its smallest member. Each learns the names of its ancestors at 1, 2, 4, ...
   steps that lie in the block around it, no more than the logarithm of the depth.
4. Bottom up, totals of the lower halves are added to the names at the cut; top down, what hangs below a block is added to the nodes
   inside of it.

A conversation of any length is rows, never one value or one task's: its blocks are dealt by conversation and place.
A node that a third of all conversations pass is counted map-side first. Rounds shrink by half, so all of them together
shuffle a few times the turns, without the texts. Names are 128 bits of hash of roles, texts and places.

Turns are ordered by turn, null first; equal ones by the SHA-256 of `<characters of role>:<role>:<text>`, as hex. Null roles and texts are
empty. A row without a conversation's id is in none. Ids are whole numbers. Repeated rows are turns each. Without conversations
there is no node. Columns other than the four are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.registry import query
from graphloom.llm.text import dealt_anew
from graphloom.operators.table import with_row_index
from graphloom.session import written

SHARED = 100  # conversations that may begin with turns of the first one of them
HEADS = 6  # they begin with less than so many
_PIECE = 4_096  # ids in one piece of a list that is hashed
_NAME = ["depth", "a", "b"]  # of a node


def numbered_turns(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """`conv`, `place` (from 1), `digest` (of role and text) and `chars` (code points of the text) of every turn. Places come from one range
    partitioning of all turns, so a conversation may have any number of them."""
    of = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.length(of(role)), of(role), of(text)).cast("binary"), 256)
    rows = conversations.select(F.col(f"`{id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), digest.alias("digest"), F.length(of(text)).cast("long").alias("chars"))
    indexed = with_row_index(rows.where("conv is not null"), "conv", F.col("turn").asc_nulls_first(), "digest", name="at")
    first = indexed.groupBy("conv").agg(F.min("at").alias("first"))
    turns = indexed.join(first.select(dealt_anew("conv"), "first"), "conv")
    return written(turns.select("conv", (F.col("at") - F.col("first") + 1).alias("place"), "digest", "chars"), "turns")


def rebuilt_turns(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """`conv`, `depth`, `digest`, `chars` of conversations that begin with the first turns of the first one of their hundred."""
    own = convs.select("conv", (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("taken"), (F.col("conv") - F.col("conv") % SHARED).alias("base"))
    heads = turns.where(F.col("place") < HEADS).withColumnRenamed("conv", "base")
    begun = own.join(heads, "base").where("place <= taken").select("conv", F.col("place").alias("depth"), "digest", "chars")
    # Where the base has fewer turns, what follows moves up.
    sizes = heads.groupBy("base").agg(F.count("*").alias("heads"))
    known = own.join(sizes, "base", "left").select("conv", "taken", F.least("taken", F.coalesce("heads", F.lit(0))).alias("begun"))
    rest = turns.join(known, "conv").where("place > taken")
    return begun.unionByName(rest.select("conv", (F.col("place") - F.col("taken") + F.col("begun")).alias("depth"), "digest", "chars"))


def _level(depth: str = "depth") -> Column:
    """How often two divides a depth over 0: the level of the cut that it is."""
    return F.bit_count(F.col(depth).bitwiseAND(-F.col(depth)) - 1)


def block_hashes(turns: DataFrame, levels: int) -> list[DataFrame]:
    """By level k: `conv`, `depth` (a multiple of 2**k), two hashes `a` and `b` of the 2**k turns up to there, `chars` of the last one."""
    hashed = lambda salt: F.xxhash64(F.lit(salt), "depth", "digest")
    made = [written(turns.select("conv", "depth", hashed(1).alias("a"), hashed(2).alias("b"), "chars"), "hashed")]
    for k in range(1, levels):
        end = F.ceil(F.col("depth") / 2**k).cast("long") * 2**k
        last = F.sum(F.when(F.col("depth") == F.col("end"), F.col("chars")).otherwise(0)).alias("chars")
        halves = made[-1].withColumn("end", end).groupBy("conv", "end")
        blocks = halves.agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), last, F.count("*").alias("halves")).where("halves = 2")
        made.append(written(blocks.select("conv", F.col("end").alias("depth"), "a", "b", "chars"), "blocks"))
    return made


def prefix_names(blocks: list[DataFrame]) -> list[DataFrame]:
    """`conv`, `depth`, `a`, `b`, `chars` of every prefix but the empty one, whose name is 0, 0; those of each level of cuts."""
    named: list[DataFrame] = []
    for k in reversed(range(len(blocks))):
        cuts = blocks[k].where(_level() == k)
        if named:
            begin = _all(named).select("conv", (F.col("depth") + 2**k).alias("depth"), F.col("a").alias("from_a"), F.col("b").alias("from_b"))
            cuts = cuts.join(begin, ["conv", "depth"], "left")
            xor = lambda c: F.col(c).bitwiseXOR(F.coalesce(F.col(f"from_{c}"), F.lit(0))).alias(c)
            cuts = cuts.select("conv", "depth", xor("a"), xor("b"), "chars")
        named.append(written(cuts, "prefix-names"))
    return named


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("long")).alias(column)


def trie_nodes(convs: DataFrame, names: DataFrame) -> DataFrame:
    """Of every node: its name, `conv` (smallest member), `n_convs`, `n_children`, what it adds to totals (`leaves`, `tokens`), and
    `ups`: names of the ancestors 1, 2, 4, ... steps above it, as many as the level of its depth asks for."""
    root = convs.select("conv", *[F.lit(0).cast("long").alias(c) for c in (*_NAME, "chars")])
    members = names.unionByName(root).groupBy(*_NAME).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"))
    nodes = written(members, "nodes")
    steps = nodes.where("depth > 0").select(*_NAME, "conv", F.explode(F.sequence(F.lit(0), _level())).alias("step"))
    steps = steps.withColumn("up", F.col("depth") - F.pow(F.lit(2), F.col("step")).cast("long"))
    above = names.select("conv", F.col("depth").alias("up"), F.col("a").alias("up_a"), F.col("b").alias("up_b"))
    steps = steps.join(above, ["conv", "up"], "left").select(*_NAME, F.struct("step", _zero("up_a"), _zero("up_b")).alias("up"))
    ups = written(steps.groupBy(*_NAME).agg(F.array_sort(F.collect_list("up")).alias("ups")), "ancestors")
    children = ups.select(*_up(0)).groupBy(*_NAME).agg(F.count("*").alias("n_children"))
    tree = nodes.join(ups, _NAME, "left").join(children, _NAME, "left")
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    tree = tree.select(*_NAME, "conv", "n_convs", "chars", _zero("n_children"), "ups")
    return written(tree.select("*", leaf.alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("tokens")).drop("chars"), "tree")


def _up(step: int) -> list[Column]:
    """The name of the ancestor 2**step above."""
    up = F.col("ups")[step]
    return [(F.col("depth") - 2**step).alias("depth"), up["up_a"].alias("a"), up["up_b"].alias("b")]


def grafted(tree: DataFrame, levels: int) -> DataFrame:
    """`leaves` and `tokens` summed over the subtree of every node."""

    def grafts(onto: DataFrame, hanging: DataFrame) -> DataFrame:
        sums = hanging.groupBy(*_NAME).agg(F.sum("leaves").alias("more_leaves"), F.sum("tokens").alias("more_tokens"))
        both = onto.join(sums, _NAME, "left")
        more = lambda c: (F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))).alias(c)
        return written(both.select(*_NAME, "ups", more("leaves"), more("tokens")), "grafted")

    rows = tree.select(*_NAME, "ups", "leaves", "tokens")
    blocks = []  # by level, nodes with the totals of the block that begins below them
    for k in range(levels):
        cuts = rows.where((F.col("depth") > 0) & (_level() == k))
        blocks.append(cuts)
        rows = grafts(rows.where((F.col("depth") == 0) | (_level() > k)), cuts.select(*_up(k), "leaves", "tokens"))
    done = [rows]  # the root, below which nothing is missing
    for k in reversed(range(levels)):
        hanging = _all(done).where("depth > 0").select(*_up(k), "leaves", "tokens")
        done.append(grafts(blocks[k], hanging))
    return _all(done).drop("ups")


def ends(convs: DataFrame, turns: DataFrame, names: DataFrame) -> DataFrame:
    """`conv` of every conversation with the name of the node that it ends in."""
    last = convs.join(turns.groupBy("conv").agg(F.max("depth").alias("depth")), "conv", "left").select("conv", _zero("depth"))
    return last.join(names.select("conv", *_NAME), ["conv", "depth"], "left").select("conv", "depth", _zero("a"), _zero("b"))


def hashed_lists(members: DataFrame) -> DataFrame:
    """`ends_sha256` of the ascending ids (`conv`) of each name, joined by commas. Ids are joined where a range partitioning has put them, so what
    meets in the task that hashes a name is a few pieces, read one by one: SHA-256 takes them in order."""

    most = _PIECE

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, own = None, []

        def made() -> pa.RecordBatch:
            values = [[name[0]], [name[1]], [name[2]], [own[0]], [",".join(map(str, own))]]
            return pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in values[:4]), pa.array(values[4], pa.string())], names=[*_NAME, "first", "ids"])

        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own and (key != name or len(own) == most):
                    yield made()
                    own = []
                name = key
                own.append(conv)
        if own:
            yield made()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in name), pa.array([state.hexdigest()], pa.string())], names=[*_NAME, "ends_sha256"])

        for batch in batches:
            for *key, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != name:
                    if state is not None:
                        yield made()
                    name, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
        if state is not None:
            yield made()

    dealt = members.repartitionByRange(*_NAME, "conv").sortWithinPartitions(*_NAME, "conv").select(*_NAME, "conv")
    joined = dealt.mapInArrow(pieces, "depth long, a long, b long, first long, ids string")
    whole = joined.repartition(*_NAME).sortWithinPartitions(*_NAME, "first").select(*_NAME, "ids")
    return whole.mapInArrow(digests, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every node: `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`."""
    own = numbered_turns(conversations, id, turn, role, text)
    convs = written(own.select("conv").distinct(), "conversations")
    deepest = own.agg(F.max("place")).first()[0] or 0
    # A conversation is at most as long as its own turns and those that it begins with.
    blocks = block_hashes(rebuilt_turns(own, convs), (deepest + HEADS).bit_length())
    parts = prefix_names(blocks)
    names = _all(parts)
    tree = trie_nodes(convs, names)
    totals = grafted(tree, len(blocks)).select(*_NAME, F.col("leaves").alias("n_leaves"), F.col("tokens").alias("saved_tokens"))
    lists = hashed_lists(written(ends(convs, blocks[0], names), "ends"))
    parents = tree.where("n_children > 0").select("conv", *[F.col(c).alias(f"parent_{c}") for c in _NAME]).withColumnRenamed("conv", "parent_conv_id")
    up = dict(zip(_NAME, _up(0), strict=True))
    rows = tree.select(*_NAME, "conv", "n_convs", "n_children", *[up[c].alias(f"parent_{c}") for c in _NAME])
    rows = rows.join(parents, [f"parent_{c}" for c in _NAME], "left").join(totals, _NAME).join(lists, _NAME, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return rows.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256")
    )


@query("op12_prefix_trie")
def op12_prefix_trie(spark, folder):
    """The trie of all conversations, rebuilt to share their first turns."""
    return prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet"))
