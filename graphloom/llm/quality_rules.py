"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Words are runs of characters other than ASCII white space. A text that is null or without words has no
words, lines or symbols. Every row gets a result; equal rows get equal results; a table without rows gives none.
Columns that are added replace given ones of the same name, in any case; all other columns stay, whatever they are called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.registry import query

_SPACE = r"[\x20\x09-\x0D]"
_PLACE_BITS = 24  # of a window's key; texts of more words take the other way
# Frequent short words of the languages of the corpus: running text has some, debris may have none.
_STOP_WORDS = (
    "the of to and in is that for with be a as der die und das von zu mit ist den "
    "de la le et les des que un une en el los y por con una las"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails if `part` is under `least` or over `most`, per `whole` where one is named."""

    name: str
    part: str
    whole: str | None = None
    least: float | None = None
    most: float | None = None
    from_words: int = 0

    def fails(self, fields: dict[str, Column]) -> Column:
        value = fields[self.part].cast("double")
        scale = fields[self.whole].cast("double") if self.whole else F.lit(1.0)
        bad = F.lit(False)
        if self.least is not None:
            bad = bad | (value < F.lit(self.least) * scale)
        if self.most is not None:
            bad = bad | (value > F.lit(self.most) * scale)
        return bad & (fields["n_words"] >= self.from_words)


#: The rules that every corpus is held to: long enough, not mostly repeated.
BASE_RULES = (
    Rule("too_short", "n_words", least=50),
    Rule("repeats_itself", "n_repeat_words", "n_words", most=0.5),
)
#: What tells running text from debris. Shares, so that they hold at every length.
SHAPE_RULES = (
    Rule("symbols", "n_symbols", "n_words", most=0.1),
    Rule("short_or_long_words", "word_chars", "n_words", least=2.0, most=20.0),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("no_stop_words", "n_stop_words", least=1, from_words=100),
    Rule("capitals", "n_capitals", "word_chars", most=0.4),
)


def _neighbours(array: Column) -> Column:
    """Each element `a` with the next one `b`."""
    rest = F.greatest(F.size(array) - 1, F.lit(0))
    return F.arrays_zip(F.slice(array, 1, rest).alias("a"), F.slice(array, 2, rest).alias("b"))


def _both(one: Column, other: Column) -> Column:
    return F.sort_array(F.array_distinct(F.concat(one, other)))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with a struct `measures` of what the rules compare. One row in, one row out, no exchange."""
    columns, docs = docs.columns, docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_given"))
    body = F.coalesce(F.col("_given")[text], F.lit(""))
    parts = F.split(body, _SPACE)
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(F.btrim(line, F.lit(" \t\x0b\x0c\r"))) > 0)
    wide = docs.select("*", F.struct(F.array_remove(parts, "").alias("words"), F.size(parts).alias("n_parts"), lines.alias("lines")).alias("_parts"))
    words, lines, n = F.col("_parts.words"), F.col("_parts.lines"), F.size("_parts.words")

    # Hashes of three neighbours with their place in the low bits, sorted: equal windows come to lie side by side.
    starts = F.slice(words, 1, F.greatest(n - 2, F.lit(0)))
    keys = F.transform(
        starts,
        lambda w, i: F.shiftleft(F.shiftright(F.xxhash64(w, words[i + 1], words[i + 2]), _PLACE_BITS), _PLACE_BITS).bitwiseOR(i.cast("long")),
    )
    wide = wide.select("*", F.sort_array(keys).alias("_keys"))
    pairs = F.filter(_neighbours(F.col("_keys")), lambda k: F.shiftright(k["a"], _PLACE_BITS) == F.shiftright(k["b"], _PLACE_BITS))
    place = lambda key: key.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
    wide = wide.select("*", F.transform(pairs, lambda k: F.struct(place(k["a"]).alias("a"), place(k["b"]).alias("b"))).alias("_pairs"))
    # Words decide. Should the bits of different windows be equal, the windows themselves are sorted.
    window = lambda at: F.slice(words, at + 1, 3)
    sure = F.forall("_pairs", lambda p: window(p["a"]) == window(p["b"])) & (n < 1 << _PLACE_BITS)
    slow = F.filter(
        _neighbours(F.sort_array(F.transform(starts, lambda w, i: F.struct(F.array(w, words[i + 1], words[i + 2]).alias("window"), i.alias("place"))))),
        lambda k: k["a"]["window"] == k["b"]["window"],
    )
    places = F.when(sure, _both(F.col("_pairs.a"), F.col("_pairs.b"))).otherwise(
        _both(slow.getField("a").getField("place"), slow.getField("b").getField("place"))
    )
    wide = wide.select("*", places.alias("_places"))
    # Each repeated window adds the words that the one before it has not covered.
    covered = F.when(F.size("_places") == 0, F.lit(0)).otherwise(
        F.lit(3) + F.aggregate(_neighbours(F.col("_places")), F.lit(0), lambda total, s: total + F.least(F.lit(3), s["b"] - s["a"]))
    )
    count = lambda pattern: F.regexp_count(body, F.lit(pattern)).cast("long")
    measures = F.struct(
        n.cast("long").alias("n_words"),
        (F.length(body) - (F.col("_parts.n_parts") - 1)).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in _STOP_WORDS]))).cast("long").alias("n_stop_words"),
        count("[A-Z]").alias("n_capitals"),
    )
    # A generated row is a fence: a filter on what is measured isn't copied into the steps above.
    return wide.select(*_kept_columns(columns, "measures"), F.explode(F.array(measures)).alias("measures"))


def _kept_columns(columns: list[str], *replaced: str) -> list[Column]:
    """Fields of `_given` that no new column replaces."""
    return [F.col("_given")[c].alias(c) for c in columns if c.lower() not in replaced]


def judged(
    docs: DataFrame, rules: tuple[Rule, ...] = SHAPE_RULES, base: tuple[Rule, ...] = BASE_RULES, text: str = "text"
) -> DataFrame:
    """`docs` with `measures`, `base_failed`, `kept`, and `failed`, the names of the rules that a document breaks."""
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_given"), F.col(f"`{text}`").alias("_text"))
    wide = measured(given, "_text")
    fields = {name: F.col("measures")[name] for name in wide.schema["measures"].dataType.names}
    broken = lambda some: F.array_compact(F.array(*[F.when(r.fails(fields), F.lit(r.name)) for r in some]))
    base_failed = F.size(broken(base)) > 0
    return wide.select(
        *_kept_columns(docs.columns, "measures", "base_failed", "kept", "failed"),
        "measures",
        base_failed.alias("base_failed"),
        (~base_failed & (F.size(broken(rules)) == 0)).alias("kept"),
        broken((*base, *rules)).alias("failed"),
    )


_SQL_WORDS = r"[^\x20\x09-\x0D]+"
_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_SQL_WORDS}') AS w
  FROM documents
), g AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS place, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS gram
  FROM d WHERE len(w) >= 3
), twice AS (
  SELECT r, place FROM g QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([place, place + 1, place + 2]) AS p FROM twice) GROUP BY r
), l AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l
  WHERE regexp_matches(line, '{_SQL_WORDS}') GROUP BY r
), m AS (
  SELECT doc_id, len(w) AS n_words,
    coalesce(list_sum([length(x) FOR x IN w]), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(list_intersect(w, [{", ".join(f"'{w}'" for w in _STOP_WORDS)}])) AS n_stop_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.1 * n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR n_dup_lines > 0.5 * n_lines OR (n_words >= 100 AND n_stop_words < 1)
    OR n_capitals > 0.4 * word_chars) AS kept
FROM f
"""


@query("op10_quality_rules", _SQL)
def op10_quality_rules(spark, folder):
    """Measures and verdict of every document."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    m = lambda name: F.col("measures")[name].alias(name)
    return judged(docs).select(
        "doc_id", m("n_words"), m("word_chars"), m("n_symbols"), m("n_dup_lines"), m("n_repeat_words"), "base_failed", "kept"
    )
