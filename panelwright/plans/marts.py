"""Gold facts over several panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import feeds, resolve

# Output columns of both gold facts, in order.
GOLD_FACT = ["PDT_COD", "CHL_COD", "SAL_TYP_COD", "SRC_DSC", "PER_DSC", "SAL_VAL", "SAL_UNT", "SAL_WGT",
             "SRC_DSC_ORG", "LOA_DAT"]
NATIONAL_PRECEDENCE = ["PNL_C_COD", "PNL_D_COD", "PNL_B_COD"]
TOP2_PRECEDENCE = ["EAN_COD", "PNL_C_COD", "PNL_A_COD", "PNL_D_COD"]


def _gold(df: DataFrame, precedence: list[str]) -> DataFrame:
    mapped = resolve.with_mapped_key(df, [*precedence, "PDT_COD"], "_product")
    return mapped.withColumns({"PDT_COD": F.col("_product"), "PER_DSC": F.col("PER_DSC").try_cast("int")}).select(
        *GOLD_FACT
    )


def national_fact(panels: dict[str, DataFrame], master: DataFrame, match: str = "panel") -> DataFrame:
    """Panels C, B and D (which has no weight) under one product key: C before D before B.

    ``panels`` maps the master's code column (``PNL_C_COD`` …) to its panel.
    ``match="panel"`` resolves a row by its own panel's code; ``match="product"``
    by the master's product code. Either way the master is made unique on the
    matched code, so fact rows are never multiplied; unmatched rows keep their
    code. The panels are joined together, the master is read once.
    """
    if match not in ("panel", "product"):
        raise ValueError(f"unknown match {match}")
    union = feeds.union_aligned([df.withColumn("_panel", F.lit(code)) for code, df in panels.items()])
    rules = {code: [code if match == "panel" else "PDT_COD"] for code in panels}
    resolved = resolve.resolve_by_rules(union, "_panel", "PDT_COD", master, rules, NATIONAL_PRECEDENCE, unique=True)
    return _gold(resolved, NATIONAL_PRECEDENCE)


def top2_fact(panel_c: DataFrame, panel_a: list[DataFrame], master: DataFrame, unique: bool = False) -> DataFrame:
    """Panel C (matched by its code or the barcode) and the panel A feeds under one product key.

    A code that leads to two master rows gives two fact rows, as an OR join
    does; ``unique`` takes one by precedence instead.
    """
    tagged = [panel_c.withColumn("_panel", F.lit("C")), *[a.withColumn("_panel", F.lit("A")) for a in panel_a]]
    rules = {"C": ["PNL_C_COD", "EAN_COD"], "A": ["PNL_A_COD"]}
    resolved = resolve.resolve_by_rules(
        feeds.union_aligned(tagged), "_panel", "PDT_COD", master, rules, TOP2_PRECEDENCE, unique
    )
    return _gold(resolved, TOP2_PRECEDENCE)
