"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; policies are
masks over those bits, so a new policy version, or the question what a rule alone would reject, needs no second look at
the text. Only built-in SQL expressions run; a document's repeated windows are found inside its own row, so nothing is
shuffled and no document meets another.

Cases: a null text has no words and fails ``few_words``. Null ids, repeated rows and further columns of any name pass
through untouched. An empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE, WORD, text_or_empty, unpack, whole_row

WINDOW = 8
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A rule's bit and when it fails, in terms of the measurements."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 20"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("exclamations", 3, "5 * n_exclamations > n_words"),
    Rule("long_words", 4, "word_chars > 40 * n_words"),
    Rule("duplicate_lines", 5, "2 * n_dup_lines > n_lines"),
)
BASE = ("few_words", "repeated_windows")
#: A policy never changes once used; a new one gets a new version.
POLICIES = {
    "v1": BASE,
    "v2": (*BASE, "symbols", "exclamations", "long_words"),
    "v3": (*BASE, "symbols", "exclamations", "long_words", "duplicate_lines"),
}


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[n] for n in names)


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _repeated(hashes: Column) -> Column:
    """Start positions of windows that occur more than once, ascending; only evaluated where there are any."""
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                  F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc`` (the row as it came) and the measurements of its whole text.

    Windows are compared by a 64-bit hash within their document.
    """
    text = F.col("_text")
    at_words = docs.select(whole_row(docs), text_or_empty(text_col).alias("_text")).select(
        "doc", "_text",
        F.regexp_extract_all("_text", F.lit(f"({WORD})")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"),
    )
    n = F.size("_words")
    at_windows = at_words.select(
        "doc", n.cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        _count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
        _count_of(text, "!").cast("long").alias("n_exclamations"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                        lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))).alias("_hashes"),
    )
    kept = [c for c in at_windows.columns if c != "_hashes"]
    at_sorted = at_windows.select(*kept, _repeated(F.col("_hashes")).alias("_sorted"))
    s = F.col("_sorted")
    at_repeats = at_sorted.select(*kept, F.sort_array(F.filter(
        F.transform(s, lambda e, i: F.when((e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"]), e["p"])),
        lambda p: p.isNotNull())).alias("_at"))
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    measures = [*kept[1:], F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")]
    # As a generated row the measurements stop a filter, which would else be pushed down to the text with all that they
    # are made of written out in it, time and again.
    return at_repeats.select("doc", F.inline(F.array(F.struct(*measures))))


def ledger(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc``, the measurements, and ``failed``, a bit per failed rule."""
    rows = measured(docs, text_col)
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)) for r in rules]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return rows.withColumn("failed", failed.cast("long"))


def passes(policy: str) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0


def kept(docs: DataFrame, policy: str = "v2", text_col: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    return ledger(docs, text_col).where(passes(policy)).select(*unpack("doc", docs.columns))


def ablation(rows: DataFrame, policy: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each rule of a policy does, from the ledger alone: documents it fails, and those that only it fails.

    The ledger is first counted per mask (at most two to the number of rules), so the rules meet a tiny table.
    """
    asked = [r for r in rules if r.name in POLICIES[policy]]
    masks = (rows.select(F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))).alias("m"))
             .groupBy("m").agg(F.count("*").alias("n")))
    per_rule = masks.select("m", "n", F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in asked])).alias("r"))
    return per_rule.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"))
