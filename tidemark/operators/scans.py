"""Running values over long sequences: sorted over all tasks, folded in blocks, carried from block to block.

A sequence is sorted by range, so that a task holds a stretch of it, and rows are numbered in that order. What a stretch
does to a running value is one small row; those rows are put together in turn, and each stretch is run through once
with the value it begins with. No task holds more than its stretch, however long a sequence is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import kept

#: Rows of a block, and blocks of a block of blocks (bits of the row number); 33 bits number the rows of a task.
LEVELS = (8, 16, 33, 63)


def numbered(rows: DataFrame, series: list[str], order: list[str], name: str = "at") -> DataFrame:
    """rows with a number that grows in the order of series and order; 2**33 a task."""
    by = [*series, *order]
    return kept(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id()), "numbered")


def running_sums(rows: DataFrame, scope: list[str], at: str, sums: dict[str, Column]) -> DataFrame:
    """numbered() rows with the running sum of each column, its own row included: sums of stretches first, then offsets
    (as many rows as a scope has tasks), then the rows of each stretch."""
    by = [*scope, "__part"]
    df = rows.withColumns({"__part": F.shiftright(at, 33), **{f"__v_{k}": v for k, v in sums.items()}})
    earlier = Window.partitionBy(*scope).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*by).agg(*[F.sum(f"__v_{k}").alias(f"__t_{k}") for k in sums])
    begins = totals.select(*[F.col(c).alias(f"__k_{c}") for c in by], *[F.coalesce(F.sum(f"__t_{k}").over(earlier), F.lit(0)).alias(f"__b_{k}") for k in sums])
    joined = df.join(begins, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in by]).drop(*[f"__k_{c}" for c in by])
    inside = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    out = joined.withColumns({k: F.col(f"__b_{k}") + F.coalesce(F.sum(f"__v_{k}").over(inside), F.lit(0)) for k in sums})
    return out.drop("__part", *[f"__{x}_{k}" for k in sums for x in "vb"])


def states_before(maps: DataFrame, keys: list[str]) -> DataFrame:
    """(at, before) from rows (keys, at, a, b) that each turn their series' running value s into s a + b: the value before each
    row, null for the first. Maps put together are maps again: they are folded level by level, and the values handed
    down from the top."""
    levels, rows = [], maps.select(*keys, "at", "a", "b")
    for bits in LEVELS:
        block = F.shiftright("at", bits) if bits < 63 else F.lit(0).cast("long")
        held = kept(rows.groupBy(*keys, block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "a", "b"))).alias("m")), "blocks")
        levels.append((bits, held))
        folded = F.aggregate("m", F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b")), lambda s, m: F.struct((s["a"] * m["a"]).alias("a"), (s["b"] * m["a"] + m["b"]).alias("b")))
        rows = held.select(*keys, F.get("m", F.lit(0))["at"].alias("at"), folded.alias("f")).select(*keys, "at", "f.a", "f.b")
    before: DataFrame | None = None
    for bits, held in reversed(levels):
        top = held.withColumn("s", F.lit(None).cast("double"))
        if before is not None:
            down = before.select(*[F.col(c).alias(f"up_{c}") for c in keys], F.shiftright("at", bits).alias("up_block"), F.col("before").alias("s"))
            top = held.join(down, [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in [*keys, "block"]])
        # the value before each row of the block, by the rows before it
        none = F.struct(F.col("s").alias("s"), F.array().cast("array<double>").alias("v"))
        run = F.aggregate("m", none, lambda acc, m: F.struct((F.coalesce(acc["s"], F.lit(0.0)) * m["a"] + m["b"]).alias("s"), F.concat(acc["v"], F.array(acc["s"])).alias("v")))
        before = top.select(*keys, F.explode(F.arrays_zip(F.col("m.at").alias("at"), run["v"].alias("before"))).alias("r")).select(*keys, "r.at", "r.before")
    return before.select("at", "before")


def ewma(rows: DataFrame, value: str, series: list[str], order: list[str], span: int, out: str = "baseline") -> DataFrame:
    """Adds the EWMA of the earlier rows of each series, seeded with the first and null without any, in time linear in the
    series. x -> alpha x + (1 - alpha) s is a map of s; the first row's is x itself."""
    alpha = 2.0 / (span + 1)
    at = numbered(rows, series, order, "__at")
    keys = [f"__k{i}" for i in range(len(series))]
    light = at.select(*[F.col(c).alias(k) for c, k in zip(series, keys, strict=True)], F.col("__at").alias("at"), F.col(value).cast("double").alias("x"))
    first = light.groupBy(*keys).agg(F.min("at").alias("first")).select(F.col("first").alias("at"), F.lit(True).alias("begins"))
    light = light.join(first, "at", "left").withColumn("begins", F.coalesce("begins", F.lit(False)))
    maps = light.select(*keys, "at", F.when(F.col("begins"), 0.0).otherwise(1 - alpha).alias("a"), F.when(F.col("begins"), F.col("x")).otherwise(alpha * F.col("x")).alias("b"))
    return at.join(states_before(maps, keys).select(F.col("at").alias("__at"), F.col("before").alias(out)), "__at").drop("__at")
