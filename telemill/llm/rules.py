"""Quality rules as a bitmask ledger: DataFrame functions only.

``ledger`` evaluates every rule once and stores, per row, the measurements and the failed rules
as bits. A policy is a version with a mask of rules: applying one, comparing versions and
computing ablations are bitwise operations on the ledger, without touching the texts again.

Null texts count as empty; they have no words and fail the rules on length. Repeated rows are
judged each by itself. An empty table gives an empty ledger. Only the id and text columns are
read, so other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import BLANKS, let, texts

SYMBOLS = "#*$%&|<>"  # fixed value
WINDOW = 8
MEASURES = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words".split()


@dataclass(frozen=True)
class Rule:
    """Fails where ``fails`` is true; integer arithmetic on measurements, valid Spark and DuckDB SQL."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("many_symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 14 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
)
# Versioned policies: the rules that reject.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "short_words", "long_words"),
    "v2": tuple(r.name for r in RULES),
}


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    return sum(1 << k for k, r in enumerate(rules) if r.name in names)


def measured(text: Column) -> dict[str, Column]:
    """The measurements of a text that take no list of words."""
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    lines = let(F.filter(F.split(text, "\n", -1), has_word), lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    return {
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "__lines": lines,
    }


def repeats(words: Column, window: int = WINDOW) -> Column:
    """Words that lie in a window of so many words that occurs twice or more, its first place included."""

    def marked(hashes: Column) -> Column:
        # Equal windows are neighbours once sorted; their starts, in order, cover the words.
        def starts(s: Column) -> Column:
            same = lambda i: F.coalesce(F.get(s, i)["v"] == F.get(s, i - 1)["v"], F.lit(False)) | F.coalesce(
                F.get(s, i)["v"] == F.get(s, i + 1)["v"], F.lit(False)
            )
            at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), same)
            return F.sort_array(F.transform(at, lambda i: F.get(s, i)["i"]))

        def covered(p: Column) -> Column:
            gaps = F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda k: F.least(F.get(p, k) - F.get(p, k - 1), F.lit(window)))
            return F.lit(window) + F.when(F.size(p) > 1, F.aggregate(gaps, F.lit(0), lambda a, g: a + g)).otherwise(0)

        ordered = F.sort_array(F.transform(hashes, lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(ordered, lambda s: let(starts(s), covered)))

    def hashed(h: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))
        return F.when(F.size(h) >= window, let(each, marked)).otherwise(0)

    return let(F.transform(words, lambda w: F.xxhash64(w)), hashed).cast("long")


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, measurements, failed bits): one pass over the texts, no shuffle, no Python."""
    rows = texts(docs, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    counted = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeats(w).alias("r")))
    rows = rows.select("doc_id", counted.alias("__words"), *[c.alias(k) for k, c in measured(text).items()])
    rows = rows.select(
        "doc_id", F.col("__words.n").alias("n_words"), "word_chars", "n_symbols", F.col("__lines.n").cast("long").alias("n_lines"),
        (F.col("__lines.n") - F.col("__lines.d")).cast("long").alias("n_dup_lines"), F.col("__words.r").alias("n_repeat_words"),
    )
    bits = [F.expr(f"CASE WHEN {r.fails} THEN {1 << k}L ELSE 0L END") for k, r in enumerate(rules)]
    return rows.withColumn("failed", sum(bits[1:], bits[0]))


def applied(book: DataFrame, policy: str, policies: dict[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The ledger with ``kept`` under a policy."""
    return book.withColumn("kept", F.col("failed").bitwiseAND(mask(policies[policy], rules)) == 0)


def ablations(book: DataFrame, policy: str, policies: dict[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of a policy: rows that fail it, and rows that only it rejects (kept if it were dropped).

    One aggregate over the ledger, whose state is two counters a rule.
    """
    active = F.col("failed").bitwiseAND(mask(policies[policy], rules))
    named = [(k, r) for k, r in enumerate(rules) if r.name in policies[policy]]
    sums = [F.count_if(active.bitwiseAND(1 << k) != 0).alias(f"f{k}") for k, _ in named]
    sums += [F.count_if(active == (1 << k)).alias(f"o{k}") for k, _ in named]
    one = book.agg(F.count("*").alias("n"), F.count_if(active == 0).alias("kept"), F.bit_or(active).alias("seen"), *sums)
    each = [F.struct(F.lit(r.name).alias("rule"), F.col(f"f{k}").alias("n_failed"), F.col(f"o{k}").alias("n_only")) for k, r in named]
    return one.select(F.lit(policy).alias("policy"), F.inline(F.array(*each)), "n", "kept")


def changed(book: DataFrame, old: str, new: str, policies: dict[str, tuple[str, ...]] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """How many rows two policy versions judge alike and otherwise."""
    sides = [(F.col("failed").bitwiseAND(mask(policies[p], rules)) == 0).alias(f"kept_{k}") for p, k in ((old, "old"), (new, "new"))]
    return book.select(*sides).groupBy("kept_old", "kept_new").agg(F.count("*").alias("n"))
