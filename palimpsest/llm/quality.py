"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions or a shuffle.

Every metric is a built-in expression over the whole text, so a partition is read once and nothing is exchanged.

Nulls and empty texts have no words, so all counts are 0 and the rule `words` fails. Rows are judged one by one, so repeated
rows, equal ids and null ids give a row each, and there are no ties. A text of any length is judged whole, by arrays of its
words in one task's memory; no rule rejects a text for being long. An empty table gives an empty result. Extra columns of the
input do not reach the output, and may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, WORD

SYMBOLS = "#*$%&|<>"
# Frequent function words of the languages that the rules know.
STOP_WORDS = (
    "the be to of and that have with in is it for as was on are by this at from "
    "der die und das von zu mit sich auf ist nicht im dem ein eine den "
    "le la les de et en un une du que pour dans est qui par pas sur au "
    "el los las que del se con por una para su al es no lo como"
).split()
#: A position within a document in the low bits of a window's sorting key; the rest is of its hash.
POSITION_BITS = 24


@dataclass(frozen=True)
class Rule:
    """A document passes if low <= metric <= high; a missing bound doesn't bind. Metrics are SQL over the counts."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None

    def passes(self) -> Column:
        m = F.expr(self.metric)
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (m >= self.low)
        if self.high is not None:
            ok = ok & (m <= self.high)
        return ok


#: In the order of documents' usual faults. Ratios are products, so that no division by zero comes up.
RULES = (
    Rule("words", "n_words", 50),
    Rule("repeated", "100 * n_repeat_words - 50 * n_words", None, 0),
    Rule("word_length_low", "word_chars - 2 * n_words", 0),
    Rule("word_length_high", "word_chars - 14 * n_words", None, 0),
    Rule("symbols", "10 * n_symbols - n_words", None, 0),
    Rule("stop_words", "n_stop_words", 2),
    Rule("duplicate_lines", "2 * n_dup_lines - n_lines", None, 0),
    Rule("bullet_lines", "10 * n_bullet_lines - 9 * n_lines", None, 0),
    Rule("ellipsis_lines", "10 * n_ellipsis_lines - 3 * n_lines", None, 0),
)
BASE = ("words", "repeated")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_bullet_lines", "n_ellipsis_lines")


def _repeat_words(words: Column, keys: Column) -> Column:
    """Words inside 3-word windows that the text has twice or more.

    keys: sorted (hash | position) of all windows. Equal windows stand next to each other; neighbours of equal hash are
    compared by their words, and a text with a collision, or of too many words for a position's bits, is sorted by the windows themselves.
    """
    low = (1 << POSITION_BITS) - 1
    at = lambda j: F.get(keys, j)
    same = lambda a, b: F.shiftright(a, POSITION_BITS) == F.shiftright(b, POSITION_BITS)
    where = lambda key: key.bitwiseAND(F.lit(low)).cast("int")
    window = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    pairs = F.filter(F.transform(keys, lambda key, j: F.when((j > 0) & same(key, at(j - 1)), F.array(where(at(j - 1)), where(key)))), lambda p: p.isNotNull())
    covered = lambda starts: F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))
    # Of all windows in order: those equal to a neighbour.
    ordered = F.array_sort(F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(window(i).alias("w"), i.alias("i"))))
    let = lambda value, f: F.get(F.transform(F.array(value), f), 0)
    exact = let(
        ordered,
        lambda o: covered(F.transform(F.filter(F.transform(o, lambda x, j: F.struct(x["i"].alias("i"), ((F.get(o, j - 1)["w"] == x["w"]) | (F.get(o, j + 1)["w"] == x["w"])).alias("two"))), lambda x: x["two"]), lambda x: x["i"])),
    )
    fast = let(pairs, lambda ps: F.when(F.exists(ps, lambda p: window(F.get(p, 0)) != window(F.get(p, 1))), exact).otherwise(covered(F.flatten(ps))))
    return F.when(F.size(words) < 4, F.lit(0)).when(F.size(words) > low, exact).otherwise(fast)


def metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of COUNTS (long)."""
    t = F.col("text")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    size = lambda c: F.size(c).cast("long")
    without = lambda chars: F.length(F.translate(t, chars, ""))
    words = F.col("words")
    key = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.lit(-(1 << POSITION_BITS))).bitwiseOR(i.cast("long"))
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .select("doc_id", "text", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("words"), lines.alias("lines"))
        .select(
            "doc_id", "words",
            F.when(F.size(words) < 4, F.array().cast("array<bigint>")).otherwise(F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), key))).alias("keys"),
            size("words").alias("n_words"),
            without(SPACES).cast("long").alias("word_chars"),
            (F.length(t) - without(SYMBOLS)).cast("long").alias("n_symbols"),
            size("lines").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stop_words"),
            size(F.filter(F.col("lines"), lambda x: x.rlike(r"^[\x20\x09]*[-*•]"))).alias("n_bullet_lines"),
            size(F.filter(F.col("lines"), lambda x: x.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("n_ellipsis_lines"),
        )
        .select("doc_id", *[c for c in COUNTS if c != "n_repeat_words"], _repeat_words(words, F.col("keys")).cast("long").alias("n_repeat_words"))
    )


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[str, ...] = BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts, `failed` (names of the rules that a document breaks), `base_failed` and `kept`."""
    failed = F.filter(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    counted = metrics(docs, id_col, text_col)
    return counted.select("doc_id", *COUNTS, failed.alias("failed")).select(
        "doc_id", *COUNTS, "failed", F.arrays_overlap("failed", F.array(*map(F.lit, base))).alias("base_failed"), (F.size("failed") == 0).alias("kept")
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_W = r"[^\x20\x09-\x0D]"
# Not generated from RULES, so that it can't follow an error there; base_failed is the contract's text.
OP9_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
c AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '{_W}+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS lines FROM d),
w AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM c WHERE len(words) >= 3)),
two AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM w) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM two CROSS JOIN (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(words, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in STOP_WORDS)}))) AS BIGINT) AS n_stop_words,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•]'))) AS BIGINT) AS n_bullet_lines,
         CAST(len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS BIGINT) AS n_ellipsis_lines
  FROM c LEFT JOIN rep ON rep.r = c.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND ((word_chars - 2 * n_words) >= 0) AND ((word_chars - 14 * n_words) <= 0) AND ((10 * n_symbols - n_words) <= 0) AND ((n_stop_words) >= 2) AND ((2 * n_dup_lines - n_lines) <= 0) AND ((10 * n_bullet_lines - 9 * n_lines) <= 0) AND ((10 * n_ellipsis_lines - 3 * n_lines) <= 0) AS kept
FROM m
"""
