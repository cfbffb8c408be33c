"""Brands: resolving them in metadata, joining reviews to them, inventories and gates."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import lexicon as lx


def alias_pattern(alias: str) -> str:
    return r"(?i)(?<![a-z0-9])" + r"\s+".join(re.escape(p) for p in alias.split()) + r"(?![a-z0-9])"


def matches(fields: dict[str, Column], brands: dict[str, tuple[str, ...]] = lx.BRANDS) -> Column:
    """Array of (weight, alias_len, -order, brand, field) for all aliases found in the fields."""
    found = [
        F.when(x.rlike(alias_pattern(a)), F.struct(F.lit(lx.FIELD_WEIGHTS[f]).alias("weight"), F.lit(len(a)).alias("alias_len"), F.lit(-o).alias("order"), F.lit(b).alias("brand"), F.lit(f).alias("field")))
        for f, x in fields.items()
        for o, (b, aliases) in enumerate(brands.items())
        for a in aliases
    ]
    return F.filter(F.array(*found), lambda m: m.isNotNull())


def resolve(fields: dict[str, Column], brands: dict[str, tuple[str, ...]] = lx.BRANDS) -> Column:
    """The brand of the best match: by field, then by length of the alias, then by order of the list."""
    return F.array_max(matches(fields, brands))["brand"]


def canonical(raw: Column, brands: dict[str, tuple[str, ...]] = lx.BRANDS) -> Column:
    return resolve({"details.Brand": raw}, brands)


def last_write(pairs: DataFrame, key: str, value: str, position: str) -> DataFrame:
    """A map from rows: of equal keys the last by position counts."""
    return pairs.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(value, position).alias(value))


def of_reviews(reviews: DataFrame, brand_of: DataFrame, *, first: str = "parent_asin", second: str = "asin") -> DataFrame:
    """Adds brand: that of the parent product, else that of the product itself."""
    a = brand_of.select(F.col("asin").alias(first), F.col("brand").alias("__a"))
    b = brand_of.select(F.col("asin").alias(second), F.col("brand").alias("__b"))
    return reviews.join(a, first, "left").join(b, second, "left").withColumn("brand", F.coalesce("__a", "__b")).drop("__a", "__b")


def review_stats(reviews: DataFrame, brands: DataFrame, *, brand: str = "brand", sku: str = "sku", rating: str = "rating", at: str = "posted_at") -> DataFrame:
    """For each listed brand: reviews, products, ratings 1 to 5, mean, first and last date; brands without
    reviews show 0."""
    stars = [F.count_if(F.col(rating) == r).alias(f"rating_{r}") for r in range(1, 6)]
    agg = reviews.groupBy(brand).agg(F.count(F.lit(1)).alias("reviews"), F.count_distinct(sku).alias("products"), *stars, F.round(F.avg(rating), 4).alias("avg_rating"), F.to_date(F.min(at)).alias("first_date"), F.to_date(F.max(at)).alias("last_date"))
    return brands.select(brand).distinct().join(agg, brand, "left").na.fill(0, ["reviews", "products", *[f"rating_{r}" for r in range(1, 6)]])


def inventory(items: DataFrame, *, brand: str, sku: str, name: str, order: str, examples: int = 5) -> DataFrame:
    """Items, different products and the first few names of each brand."""
    rank = F.row_number().over(Window.partitionBy(brand).orderBy(order))
    few = items.withColumn("__n", rank).where(F.col("__n") <= examples).groupBy(brand).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__n", name))), lambda s: s[name]), " | ").alias("examples"))
    return items.groupBy(brand).agg(F.count(F.lit(1)).alias("items"), F.count_distinct(sku).alias("products")).join(few, brand, "left")


def gate(inventory: DataFrame, reviews: DataFrame, *, least_items: int = 20, least_reviews: int = 1000, brand: str = "brand", merged: tuple[str, str] | None = None) -> DataFrame:
    """Which brands have enough items and reviews, and why not. `merged` names a brand that goes under
    another when that one is included."""
    j = inventory.select(brand, "items").join(reviews.select(brand, "reviews"), brand, "left").na.fill(0, ["reviews"])
    items, n = F.col("items"), F.col("reviews")
    few_items, few_reviews = items < least_items, n < least_reviews
    reason = F.when(~few_items & ~few_reviews, "ok").when(items <= 0, "not found in metadata").when(n <= 0, "no matched reviews after metadata join")
    reason = reason.when(few_items & few_reviews, F.format_string(f"below thresholds: %d items < {least_items} and %d reviews < {least_reviews}", items, n))
    reason = reason.when(few_items, F.format_string(f"too few matched metadata items: %d < {least_items}", items)).otherwise(F.format_string(f"too few matched reviews: %d < {least_reviews}", n))
    out = j.select(brand, "items", "reviews", (~few_items & ~few_reviews).alias("included"), reason.alias("reason"))
    if merged:
        under = out.agg(F.coalesce(F.bool_or((F.col(brand) == merged[1]) & F.col("included")), F.lit(False)).alias("__under"))  # one row
        late = (F.col(brand) == merged[0]) & F.col("__under") & ~F.col("included") & few_reviews
        out = out.join(F.broadcast(under)).withColumn("reason", F.when(late, f"too few matched reviews or merged under {merged[1]}").otherwise(F.col("reason"))).drop("__under")
    return out


def confidence_note(fields: Column) -> Column:
    """What the fields (an array) that matched say of a brand's match."""
    structured = F.arrays_overlap(fields, F.array(F.lit("details.Brand"), F.lit("store")))
    return F.when(structured, "high: matched structured brand/store field").when(F.array_contains(fields, "details_json"), "medium: matched serialized details").otherwise("medium: matched title/categories alias")
