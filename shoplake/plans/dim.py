"""Dimensions.  Copies keep the source columns; sku and spu get names from other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake import schemas
from shoplake.operators import flatten_tree, lookup_join

_CATEGORY = {c: c for c in ("category3_name", "category2_id", "category2_name", "category1_id", "category1_name")}
_BRAND = {"brand_name": "brand_name"}

# How rows of other raw tables reach a dimension built around its own: table -> column of the own rows that names them.
LINKS = {
    "spu_info": {"base_brand": "brand_id", "base_category": "category3_id"},
    "sku_info": {"spu_info": "spu_id", "base_brand": "brand_id", "base_category": "category3_id"},
}


def copy(table: str, ods: DataFrame) -> DataFrame:
    """base_brand, base_dic, base_region, coupon_info and user_info: latest state as it is."""
    return ods.select(*schemas.fields(table))


def below(ods_category: DataFrame, ids: DataFrame, levels: int = 3) -> DataFrame:
    """The ids and those of all categories below them."""
    out = level = ids.select("id")
    for _ in range(levels - 1):
        level = ods_category.join(level.select(F.col("id").alias("_up")), F.col("parent_id") == F.col("_up"), "left_semi").select("id")
        out = out.union(level)
    return out.distinct()


def base_category(ods_category: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Every category with its ancestors; the row itself fills the category3 columns at any level."""
    flat = flatten_tree(ods_category, nodes=nodes)
    return flat.select(
        "id", "category_name", "level", "parent_id", "category3_id", "category3_name", "category2_id",
        "category2_name", "category1_id", "category1_name", "create_time", "update_time",
    )


def spu_info(ods_spu: DataFrame, ods_brand: DataFrame, dim_category: DataFrame) -> DataFrame:
    out = lookup_join(ods_spu, ods_brand, ("brand_id", "id"), _BRAND)
    out = lookup_join(out, dim_category, ("category3_id", "id"), _CATEGORY)
    return out.select(
        "id", "spu_name", "description", "category3_id", "category3_name", "category2_id", "category2_name",
        "category1_id", "category1_name", "brand_id", "brand_name", "create_time", "update_time",
    )


def sku_info(ods_sku: DataFrame, ods_spu: DataFrame, ods_brand: DataFrame, dim_category: DataFrame) -> DataFrame:
    out = lookup_join(ods_sku, ods_spu, ("spu_id", "id"), {"spu_name": "spu_name"})
    out = lookup_join(out, ods_brand, ("brand_id", "id"), _BRAND)
    out = lookup_join(out, dim_category, ("category3_id", "id"), _CATEGORY)
    return out.select(
        "id", "sku_name", "spu_id", "spu_name", "category3_id", "category3_name", "category2_id",
        "category2_name", "category1_id", "category1_name", "brand_id", "brand_name", "price", "weight",
        "img_url", "is_sale", "sku_attr", "create_time", "update_time",
    )
