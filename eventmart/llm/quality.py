"""Quality rules kept in a ledger of bitmasks.

Every rule is evaluated once for each document: its measurements stay as columns, its failures as bits of
one number. A policy is a version, a mask of the rules that count, and how many of them may fail. Policies
and ablations read the ledger alone: a policy is a bitwise test, and what dropping or adding a rule would
do is summed over the distinct masks. All of it is DataFrame functions; nothing is shuffled to build the
ledger.

Defined cases: a null or empty text has no words and fails the rules on length; repeated rows are documents
of their own; an empty table has an empty ledger, and its ablation has no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions.json import once
from eventmart.llm.arrow import kept_columns

# What separates words, and what counts as a symbol.
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
REPEAT_WIDTH = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words", "n_letters")

# Rules in the order of their bits: name and when a document fails. Numbers are whole, so that a rule
# means the same in any engine.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "too_many_words": "n_words > 100000",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 25 * n_words",
    "symbols": "2 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "few_letters": "10 * n_letters < 4 * word_chars",
    "some_repeated_words": "100 * n_repeat_words > 30 * n_words",
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """Which rules count, and how many of those may fail."""

    version: str
    rules: tuple[str, ...]
    may_fail: int = 0

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)

    def keeps(self, bits: Column) -> Column:
        return F.bit_count(bits.bitwiseAND(F.lit(self.mask).cast("long"))) <= self.may_fail


BASE = Policy("base", ("too_few_words", "repeated_words"))
# The first version also held repeated lines against a text, which lists and verses have.
POLICIES = {
    "base": BASE,
    "v1": Policy("v1", ("too_many_words", "short_words", "long_words", "symbols", "repeated_lines", "few_letters")),
    "v2": Policy("v2", ("short_words", "long_words", "symbols", "few_letters")),
}
CURRENT = "v2"


def _words(text: Column) -> Column:
    plain = F.trim(F.translate(text, SPACES[:-1], " " * (len(SPACES) - 1)))
    return F.when(F.length(plain) > 0, F.split(plain, " +")).otherwise(F.array().cast("array<string>"))


def _repeated(words: Column) -> Column:
    """Words in windows that are found twice or more in the text.

    Windows are sorted by hash with their position; those with an equal neighbour are repeated. Sorted by
    position, each covers as many words as there are to the next, at most its width.
    """
    n = F.size(words) - REPEAT_WIDTH
    at = F.when(n >= 1, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(
        at, lambda i: F.struct(F.xxhash64(*[words[i + k] for k in range(REPEAT_WIDTH)]).alias("h"), i.alias("i"))
    )
    return F.array_sort(windows)


def _covered(windows: Column) -> Column:
    size = F.size(windows)
    same = lambda i, j: (j >= 0) & (j < size) & (F.get(windows, j)["h"] == F.get(windows, i)["h"])
    index = F.when(size > 1, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    repeated = F.filter(index, lambda i: F.coalesce(same(i, i - 1), F.lit(False)) | F.coalesce(same(i, i + 1), F.lit(False)))
    return F.array_sort(F.transform(repeated, lambda i: F.get(windows, i)["i"]))


def _union(positions: Column) -> Column:
    """Words in windows at these ascending positions."""
    steps = F.transform(
        positions, lambda p, k: F.coalesce(F.least(F.get(positions, k + 1) - p, F.lit(REPEAT_WIDTH)), F.lit(REPEAT_WIDTH))
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` with the measurements and `rule_bits`, the failed rules."""
    columns = kept_columns(docs, [*MEASURES, "rule_bits"], keep)
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    long = lambda c: c.cast("long")
    own = [F.col(f"`{c}`") for c in columns]
    rows = docs.select(*own, value.alias("_value_"), _words(value).alias("_words_"))
    lines = F.filter(F.split("_value_", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    rows = rows.select(
        *own,
        long(F.size("_words_")).alias("n_words"),
        long(F.length(F.translate("_value_", SPACES, ""))).alias("word_chars"),
        long(F.length("_value_") - F.length(F.translate("_value_", SYMBOLS, ""))).alias("n_symbols"),
        lines.alias("_lines_"),
        _repeated(F.col("_words_")).alias("_windows_"),
        long(F.length(F.regexp_replace("_value_", r"[^\p{L}]+", ""))).alias("n_letters"),
    )
    rows = rows.withColumn("_positions_", _covered(F.col("_windows_")))
    rows = rows.select(
        *own,
        "n_words",
        "word_chars",
        "n_symbols",
        long(F.size("_lines_") - F.size(F.array_distinct("_lines_"))).alias("n_dup_lines"),
        long(F.size("_lines_")).alias("n_lines"),
        _union(F.col("_positions_")).alias("n_repeat_words"),
        "n_letters",
    )
    # Kept as one column, so that a filter on the ledger does not compute its measurements again.
    rows = rows.select(*own, once(F.struct(*MEASURES)).alias("_measured_")).select(*own, "_measured_.*")
    bits = F.lit(0).cast("long")
    for name, fails in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return rows.withColumn("rule_bits", bits)


def apply_policy(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """A ledger with `base_failed` and `kept` under a version of the policy."""
    base = BASE.keeps(F.col("rule_bits"))
    return rows.withColumns({"base_failed": ~base, "kept": base & POLICIES[version].keeps(F.col("rule_bits"))})


def ablation(rows: DataFrame, version: str = CURRENT) -> DataFrame:
    """(rule, kept, kept_without, only_failure): documents a policy keeps, those it would keep without
    each of its rules, and those that only this rule rejects; '' stands for none dropped.

    The ledger is first summed by mask, of which there are few.
    """
    policy = POLICIES[version]
    masks = rows.groupBy("rule_bits").agg(F.count(F.lit(1)).alias("n"))
    base = BASE.keeps(F.col("rule_bits"))
    kept = F.when(base & policy.keeps(F.col("rule_bits")), F.col("n")).otherwise(0)
    out = []
    for rule in ("", *policy.rules):
        rest = Policy(version, tuple(r for r in policy.rules if r != rule), policy.may_fail)
        without = F.when(base & rest.keeps(F.col("rule_bits")), F.col("n")).otherwise(0)
        out.append(F.struct(F.lit(rule).alias("rule"), kept.alias("kept"), without.alias("kept_without")))
    counted = masks.select(F.explode(F.array(*out)).alias("r")).groupBy("r.rule")
    counted = counted.agg(F.sum("r.kept").alias("kept"), F.sum("r.kept_without").alias("kept_without"))
    return counted.withColumn("only_failure", F.col("kept_without") - F.col("kept"))
