"""Mixing sources to target weights along a curriculum.

Each source has a weight schedule over training time t in [0, 1], piecewise linear between knots. The
integral of a source's schedule is its share of all words; shares that would ask for more than
`max_epochs` passes over a source are held there, and the excess goes to the other sources by weight
until none is above. The cumulative word demand of a source is its target times the share of its
schedule's integral that lies before t. The copies of its documents stand in a keyed order, and the
demand curve is inverted at the words before each copy: that is the copy's position in training.
Documents are range-sorted by position.

Running word counts are taken in two steps, buckets within a source and documents within a bucket,
so a source that holds a third of all rows is spread over its buckets.

The last copy of a source is cut where its target is met, so at most one document a source is cut;
words taken from a source equal its target, rounded. A null or empty text has size 0 and is never
taken. A null source is a source of its own, ranked last. Ties and repeated rows each count as a row.
An empty table gives no rows. Columns other than id, text and source don't matter to plan_mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, words

#: Schedules by rank of the source, repeating: (time, weight) knots. They integrate to 5, 2 and 1:
#: heavy sources lead at first, light ones come up towards the end.
SCHEDULES = (((0.0, 6.0), (1.0, 4.0)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 0.5), (1.0, 1.5)))
#: Rows of a bucket, about.
BUCKET_ROWS = 50_000


def integral(schedule: tuple[tuple[float, float], ...]) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:], strict=False))


def _inverse(u: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The time by which a share u of the schedule's integral has been asked for."""
    whole, done, out = integral(schedule), 0.0, F.lit(1.0)
    pieces = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area, slope = (t1 - t0) * (w0 + w1) / 2, (w1 - w0) / (t1 - t0)
        pieces.append((done, area, t0, w0, slope))
        done += area
    for before, area, t0, w0, slope in reversed(pieces):
        need = F.greatest(u * whole - before, F.lit(0.0))
        # w0 x + slope x^2 / 2 = need, in the form that is stable for any slope
        root = F.sqrt(F.greatest(w0 * w0 + 2 * slope * need, F.lit(0.0)))
        x = F.when(need > 0, 2 * need / (w0 + root)).otherwise(0.0)
        out = F.when(u * whole <= before + area, t0 + x).otherwise(out)
    return F.least(out, F.lit(1.0))


def source_targets(sources: DataFrame, schedules: tuple = SCHEDULES, max_epochs: int = 3) -> DataFrame:
    """From (skey, source, source_size): adds kind (the schedule's number), weight and target."""
    kind = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(schedules)
    weight = F.element_at(F.array(*[F.lit(float(integral(s))) for s in schedules]), F.col("kind") + 1)
    out = sources.withColumn("kind", kind.cast("int")).withColumn("weight", weight)
    # sources meet their cap in the order of cap / weight; those before the first that stays below are held
    w = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    out = out.withColumn("rate", (total - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum("weight").over(after))
    out = out.withColumn("held", F.max((cap > F.col("rate") * F.col("weight")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 0)
    rate = F.min(F.when(~F.col("held"), F.col("rate"))).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = F.first(F.when(~F.col("held"), F.col("rate")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("held"), cap).otherwise(F.least(cap, F.coalesce(first, rate) * F.col("weight")))
    return out.withColumn("target", target.cast("double")).select("skey", "source", "source_size", "kind", "weight", "target")


def plan_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", schedules: tuple = SCHEDULES, max_epochs: int = 3, seed: int = 17) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and positions (of its copies,
    in order), position (the first; null if it isn't taken). Sorted by position, untaken ones last."""
    sizes = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
    )
    sizes = sizes.withColumn("skey", F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))).withColumn("order", F.xxhash64(F.lit(seed), F.col("doc_id")))
    sizes = materialize(sizes, "sizes")
    sources = sizes.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = materialize(sources, "sources")
    targets = materialize(source_targets(sources.drop("n"), schedules, max_epochs), "targets")
    largest = sources.agg(F.max("n")).first()[0] or 1
    buckets = max(1, min(1 << 20, -(-largest // BUCKET_ROWS)) * 8)
    sizes = sizes.withColumn("bucket", F.pmod("order", F.lit(buckets)))
    base = sizes.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    base = base.withColumn("base", F.coalesce(F.sum("words").over(Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("words")
    base = base.join(targets.drop("source"), "skey")
    inner = Window.partitionBy("skey", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = sizes.withColumn("inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    run = run.join(base, ["skey", "bucket"]).withColumn("start", F.col("base") + F.col("inner"))
    want = F.round("target").cast("long")
    run = run.withColumn("full", F.when(F.col("source_size") > 0, F.floor(want / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long"))
    run = run.withColumn("rest", want - F.col("full") * F.col("source_size"))
    run = run.withColumn("part", F.least(F.greatest(F.col("rest") - F.col("start"), F.lit(0)), F.col("size")))
    run = run.withColumn("taken", F.col("full") * F.col("size") + F.col("part"))
    copies = F.when(F.col("size") > 0, F.col("full") + (F.col("part") > 0).cast("long")).otherwise(0)
    at = lambda e: (e * F.col("source_size") + F.col("start")) / F.greatest("target", F.lit(1.0))
    curve = lambda u: F.coalesce(*[F.when(F.col("kind") == i, _inverse(u, s)) for i, s in enumerate(schedules)])
    run = run.withColumn("positions", F.when(copies > 0, F.transform(F.sequence(F.lit(0).cast("long"), copies - 1), lambda e: curve(at(e)))).otherwise(F.array().cast("array<double>")))
    run = run.withColumn("position", F.get("positions", F.lit(0)))
    out = run.select("doc_id", "size", "source_size", "target", "taken", "part", "positions", "position")
    return out.repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """The mix itself: the copies of the documents with all their columns, range-sorted by training
    position. A copy that is cut keeps its first words, joined by single spaces; n_chars, where the
    table has it, is counted anew for those."""
    plan = plan_mix(docs, id_col=id_col, text_col=text_col, **options)
    # a document stays whole in one column
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    keyed = docs.select(F.col(id_col).alias("own_id"), F.lit(0).alias("side"), F.size(words(F.col(text_col))).cast("long").alias("size"), whole)
    given = plan.select(F.col("doc_id").alias("own_id"), F.lit(1).alias("side"), "size", F.struct("size", "part", "positions").alias("plan"))
    # documents and plan are dealt by id together, so that texts are shuffled once until they know their positions. Rows that share an id
    # are told apart by their rank among them: the n-th document of an id by size comes just before the n-th row of its plan
    rows = keyed.unionByName(given, allowMissingColumns=True).repartition("own_id")
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("own_id", "side").orderBy("size", "plan.part")))
    rows = rows.withColumn("plan", F.lead("plan").over(Window.partitionBy("own_id", "nth").orderBy("side"))).where("side = 0")
    copies = rows.select("own_id", "whole", "plan.size", "plan.part", F.size("plan.positions").alias("copies"), F.posexplode("plan.positions").alias("epoch", "position"))
    copies = copies.withColumn("cut", (F.col("epoch") == F.col("copies") - 1) & (F.col("part") > 0) & (F.col("part") < F.col("size")))
    own = {c: F.col("whole").getField(c) for c in docs.columns}
    text = F.when(F.col("cut"), F.array_join(F.slice(words(own[text_col]), F.lit(1), F.col("part").cast("int")), " ")).otherwise(own[text_col])
    copies = copies.withColumn("new_text", text)
    own[text_col] = F.col("new_text")
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("cut"), F.length("new_text").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    out = copies.select("position", "own_id", F.struct(*[e.alias(c) for c, e in own.items()]).alias("row"))
    return out.repartitionByRange("position", "own_id").sortWithinPartitions("position", "own_id").select("row.*")
