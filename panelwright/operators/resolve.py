"""Product key resolution and new members."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import first_key


def resolve_by_key(fact: DataFrame, fact_key: str, master: DataFrame, master_key: str, carry: list[str]) -> DataFrame:
    """Left join on one code of the master, carrying master columns."""
    keyed = master.select(F.col(master_key).alias("_key"), *[F.col(c).alias(f"_m_{c}") for c in carry]).filter(
        "_key is not null"
    )
    joined = fact.join(keyed, fact[fact_key] == F.col("_key"), "left").drop("_key")
    return joined.withColumnsRenamed({f"_m_{c}": c for c in carry})


def _codes(rule: str, keys: list[str]) -> list[Column]:
    """(rule, rank, code) per master code; a code a row carries twice counts once, for its first column."""
    entries = []
    for rank, key in enumerate(keys):
        repeats = [F.col(key).eqNullSafe(F.col(k)) for k in keys[:rank]]
        code = F.col(key)
        if repeats:
            code = F.when(~reduce(lambda x, y: x | y, repeats), code)
        entries.append(F.struct(F.lit(rule).alias("_rule"), F.lit(rank).alias("_rank"), code.alias("_key")))
    return entries


def resolve_by_rules(
    fact: DataFrame,
    rule: str,
    fact_key: str,
    master: DataFrame,
    rules: dict[str, list[str]],
    carry: list[str],
    unique: bool = False,
) -> DataFrame:
    """Left join of fact rows to master rows; a fact row's rule says which master codes its key may be.

    "Matches one code or the other" would be a nested loop over fact × master.
    The master's codes are put in rows instead, one per rule and code, and all
    rules are served by one equi join with the same result. With ``unique`` a
    code that leads to several master rows takes the one matched by the first
    listed code, so the fact keeps its row count.
    """
    entries = [e for name, keys in rules.items() for e in _codes(name, keys)]
    keyed = master.select(*[F.col(c).alias(f"_m_{c}") for c in carry], F.inline(F.array(*entries))).filter(
        "_key is not null"
    )
    if unique:
        order = [F.col("_rank").asc(), *[F.col(f"_m_{c}").asc_nulls_last() for c in carry]]
        window = Window.partitionBy("_rule", "_key").orderBy(*order)
        keyed = keyed.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")
    same = (fact[rule] == F.col("_rule")) & (fact[fact_key] == F.col("_key"))
    joined = fact.join(keyed, same, "left").drop("_key", "_rank", "_rule")
    return joined.withColumnsRenamed({f"_m_{c}": c for c in carry})


def resolve_by_any_key(
    fact: DataFrame, fact_key: str, master: DataFrame, master_keys: list[str], carry: list[str], unique: bool = False
) -> DataFrame:
    """Left join that matches on any of several master codes."""
    tagged = fact.withColumn("_one", F.lit("any"))
    return resolve_by_rules(tagged, "_one", fact_key, master, {"any": master_keys}, carry, unique).drop("_one")


def with_mapped_key(df: DataFrame, precedence: list[str | Column], out: str) -> DataFrame:
    return df.withColumn(out, first_key(*precedence))


def not_in(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose key is not in the list. NULL keys are not "new"; NULLs in the list are ignored."""
    known_keys = known.select(F.col(known_key).alias("_known")).filter("_known is not null")
    return df.filter(F.col(key).isNotNull()).join(known_keys, F.col(key) == F.col("_known"), "left_anti")
