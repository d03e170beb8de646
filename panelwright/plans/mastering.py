"""Product master, new products and the product and sales-type dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import keys
from ..operators import dedup, feeds, resolve
from ..schemas import PT_PRODUCT_COLUMNS

# Columns of the fallback member that are codes, not labels.
FALLBACK_CODES = {c: "99" for c in ["PNL_D_COD", "PNL_C_COD", "PNL_A_COD", "PNL_B_COD", "EAN_COD"]} | {"STS_COD": "1"}
PANEL_CODES = ["PNL_D_COD", "PNL_B_COD", "EAN_COD", "PNL_C_COD", "PNL_A_COD"]


def product_master(staging: DataFrame) -> DataFrame:
    """Cleansed master plus one "not assigned" member with the staging's audit values."""
    cleansed = staging.select(
        *[(F.trim(c) if c == "STS_COD" else keys.norm(c)).alias(c) for c in PT_PRODUCT_COLUMNS],
        "SRC_DSC_ORG",
        "LOA_DAT",
    )
    fallback = {c: F.lit(FALLBACK_CODES.get(c, keys.NOT_ASSIGNED_LABEL)) for c in PT_PRODUCT_COLUMNS}
    return feeds.add_member(cleansed, fallback, ["SRC_DSC_ORG", "LOA_DAT"], staging)


def product_dimension(master: DataFrame) -> DataFrame:
    """One product per resolved code (C before D before B), latest version."""
    cleaned = master.withColumns({c: keys.clean_token(c) for c in PANEL_CODES})
    keyed = resolve.with_mapped_key(cleaned, ["PNL_C_COD", "PNL_D_COD", "PNL_B_COD"], "PDT_COD").filter(
        "PDT_COD is not null"
    )
    described = [c for c in PT_PRODUCT_COLUMNS if c not in PANEL_CODES]
    return dedup.latest_version(keyed, ["PDT_COD"]).select(
        "PDT_COD", *PANEL_CODES, *described, "SRC_DSC_ORG", "LOA_DAT"
    )


def new_products(fact: DataFrame, master: DataFrame, categories: DataFrame, source: str) -> DataFrame:
    """Products of the fact that the master knows, but not under this source."""
    # the fact repeats a product for every sale: reduce it before any join
    sold = fact.select("PDT_COD", "PDT_PCK", "SRC_COD", "SRC_DSC_ORG", "LOA_DAT").distinct()
    unknown = resolve.not_in(sold, "PDT_COD", master.filter(F.col("ORG_DSC") == source), "PDT_COD")
    known_as = master.select(F.col("PDT_COD").alias("_code"), F.col("CAT_DSC").alias("_cat")).distinct()
    mapped = categories.select(F.col("SRC_COD").alias("_src"), F.col("CAT_DSC").alias("_cat_of_src")).distinct()
    return (
        unknown.join(known_as, F.col("PDT_COD") == F.col("_code"))
        .join(mapped, (F.col("SRC_COD") == F.col("_src")) & (F.col("_cat") == F.col("_cat_of_src")))
        .select("PDT_COD", "PDT_PCK", "SRC_COD", "SRC_DSC_ORG", "LOA_DAT")
        .distinct()
    )


def new_product_attributes(staging: DataFrame, detected: DataFrame) -> DataFrame:
    """Latest description per pack of the detected products."""
    packs = detected.select(F.col("PDT_PCK").alias("_pack"), "SRC_COD").distinct()
    joined = staging.join(packs, keys.norm("PDT_PCK") == F.col("_pack")).drop("_pack")
    return dedup.latest_version(joined, ["PDT_PCK"]).select(
        "CNY_DSC", "PDT_DSC", "PDT_PCK", "CAT_DSC", "OTC_N01", "OTC_N02", "OTC_N03", "OTC_N04", "SRC_COD",
        "SRC_DSC_ORG", "LOA_DAT",
    )


def sales_type_dimension(sales_types: DataFrame) -> DataFrame:
    """Sales types with their parent channel (first digit of the code)."""
    return sales_types.select(
        keys.parent_code("SAL_TYP_COD").alias("CHL_COD"), "SAL_TYP_COD", "SAL_TYP_DSC", "SOURCE_CODE", "LOA_DAT"
    )
