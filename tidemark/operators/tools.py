"""Answers to batches of analytics and incident questions from tables of counts.

Mentions are counted once by all their facets; grouping sets over those counts give every answer there is: a distribution
by severity, sentiment or aspect, with any of the other facets held or not. A question finds its rows by one join on
its filters, in which null stands for all.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import kept

FACETS = ("aspect", "sentiment", "severity", "brand")
#: Fixed value: incidents that an answer names.
MOST_INCIDENTS = 5


def kind_of(question: Column) -> Column:
    """Which distribution a question asks for; aspects unless it names another."""
    q = F.lower(F.coalesce(question, F.lit("")))
    return F.when(q.contains("severity"), "severity").when(q.contains("sentiment"), "sentiment").when(q.contains("status"), "status").otherwise("aspect")


def counts_cube(mentions: DataFrame) -> DataFrame:
    """(kind, label, aspect, sentiment, severity, brand, n) from mentions with these facets: for each kind the counts of its
    labels, for every choice of the other facets; a facet that isn't held is null. Mentions without a
    label count in no distribution of its kind; a null facet is held by nobody."""
    base = mentions.groupBy(*FACETS).agg(F.count(F.lit(1)).alias("n"))
    out = None
    for kind in ("severity", "sentiment", "aspect"):
        others = [f for f in FACETS if f != kind]
        sets = [[kind, *held] for size in range(len(others) + 1) for held in combinations(others, size)]
        cube = base.where(F.col(kind).isNotNull()).groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(f) for f in FACETS]).agg(F.sum("n").alias("n"), *[F.grouping(f).alias(f"__g_{f}") for f in others])
        # a held facet that is null is no choice of anybody's
        cube = cube.where(" AND ".join(f"(__g_{f} = 1 OR {f} IS NOT NULL)" for f in others))
        part = cube.select(F.lit(kind).alias("kind"), F.col(kind).alias("label"), *[(F.lit(None).cast("string") if f == kind else F.col(f)).alias(f) for f in FACETS], "n")
        out = part if out is None else out.unionByName(part)
    return out


def status_counts(statuses: DataFrame, status: str = "status") -> DataFrame:
    """Rows of kind status; no facet restricts them."""
    none = [F.lit(None).cast("string").alias(f) for f in FACETS]
    return statuses.groupBy(F.col(status).alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("status").alias("kind"), "label", *none, "n")


def filters_of(questions: DataFrame) -> DataFrame:
    """(question_id, kind, aspect, sentiment, severity, brand): what each routed question (question, aspect, sentiment, brand)
    looks up. The facet that it asks for is no filter; of severities those of negative mentions count."""
    kind = kind_of(F.col("question"))
    hold = lambda f: F.when((kind != f) & (kind != "status"), F.col(f)).alias(f)
    sentiment = F.when(kind == "severity", "negative").when((kind != "sentiment") & (kind != "status"), F.col("sentiment")).alias("sentiment")
    return questions.select("question_id", kind.alias("kind"), hold("aspect"), sentiment, F.lit(None).cast("string").alias("severity"), hold("brand"))


def looked_up(filters: DataFrame, counts: DataFrame) -> DataFrame:
    """(filters, label, n): the counts of each different set of filters, which many questions may share."""
    names = ["kind", *FACETS]
    asked = filters.select(*names).distinct()
    held = counts.select(*[F.col(c).alias(f"__{c}") for c in names], "label", "n")
    return asked.join(held, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]).select(*names, "label", "n")


def analytics(questions: DataFrame, counts: DataFrame) -> DataFrame:
    """(question_id, kind, total, answer): the counts as text, larger first, then by label; of aspects also the largest
    and the one with the most negative mentions. The distinct filters are answered, and questions find theirs."""
    # questions are routed once; their filters are read three times
    filters = kept(filters_of(questions), "filters")
    names = ["kind", *FACETS]
    rows = looked_up(filters, counts)
    negative = filters.where("kind = 'aspect'").withColumn("sentiment", F.lit("negative"))
    worst = looked_up(negative, counts).groupBy("aspect", "severity", "brand").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("w"))
    # as many rows a group as there are labels of a kind
    lists = rows.groupBy(*names).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "label"))).alias("c"), F.sum("n").alias("total"))
    worst = worst.select(F.lit("aspect").alias("__kind"), *[F.col(c).alias(f"__{c}") for c in ("aspect", "severity", "brand")], "w")
    lists = lists.join(worst, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in ("kind", "aspect", "severity", "brand")], "left").select(*names, "c", "total", "w")
    named = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws("=", x["label"], (-x["n"]).cast("string"))), ", ")
    told, first = named(F.col("c")), F.get("c", F.lit(0))
    # fixed values: the wording of the answers
    aspects = F.concat(
        F.lit("Aspect distribution across "), F.col("total").cast("string"), F.lit(" mentions: "), told,
        F.lit(". Largest aspect: "), first["label"], F.lit(" ("), (-first["n"]).cast("string"), F.lit(" mentions)."),
        F.when(F.col("w").isNotNull(), F.concat(F.lit(" Most negative aspect: "), F.col("w.label"), F.lit(" ("), (-F.col("w.n")).cast("string"), F.lit(" negative mentions)."))).otherwise(""),
    )
    text = F.when(F.col("kind") == "severity", F.concat(F.lit("Severity distribution of negative mentions: "), told, F.lit(".")))
    text = text.when(F.col("kind") == "sentiment", F.concat(F.lit("Sentiment distribution of aspect mentions: "), told, F.lit(".")))
    text = text.when(F.col("kind") == "status", F.concat(F.lit("ABSA processing-status distribution: "), told, F.lit("."))).otherwise(aspects)
    answers = lists.select(*[F.col(c).alias(f"__{c}") for c in names], "total", text.alias("answer"))
    # an answer a set of filters, however many questions share it: sent to the questions
    out = filters.join(F.broadcast(answers), [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names], "left")
    none = F.when(F.col("kind") == "severity", "Severity distribution of negative mentions: (none).").when(F.col("kind") == "sentiment", "Sentiment distribution of aspect mentions: (none).")
    none = none.when(F.col("kind") == "status", "ABSA processing-status distribution: (none).").otherwise("No aspect mentions are present in the database yet.")
    return out.select("question_id", "kind", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("answer", none).alias("answer"))


def incident_aspects(incidents: DataFrame) -> DataFrame:
    """The aspects that have an incident, in order."""
    return incidents.select("aspect").where("aspect IS NOT NULL").distinct().orderBy("aspect")


def incident_granularities(incidents: DataFrame) -> DataFrame:
    """The granularities that have an incident, in order."""
    return incidents.select("granularity").distinct().orderBy("granularity")


def top_incidents(incidents: DataFrame, most: int = MOST_INCIDENTS) -> DataFrame:
    """(aspect, rank, line, ...): the first incidents by falling severity score, z, then week and label, of each aspect, and (null
    aspect) of all. Each list is cut before its rows meet."""
    each = incidents.withColumn("of", F.explode(F.array(F.col("aspect"), F.lit(None).cast("string"))))
    nth = F.row_number().over(Window.partitionBy("of").orderBy(F.desc("severity_score"), F.desc("z"), F.desc("week_start"), "aspect", F.coalesce("cluster_label", F.lit(""))))
    unit = F.coalesce(F.nullif("cluster_label", F.lit("")), F.concat("aspect", F.lit(" (aspect-level)")))
    # fixed values: the wording of a line
    number = lambda c: F.round(c, 2).cast("string")
    line = F.format_string("%d. [%s] %s — week %s: observed %d vs baseline %s (z=%s, severity %s).", F.col("rank"), F.col("granularity"), unit, F.date_format("week_start", "yyyy-MM-dd"), F.col("volume"), number("baseline"), number("z"), number("severity_score"))
    line = F.concat(line, F.when(F.coalesce("summary", F.lit("")) != "", F.concat(F.lit("\n   "), "summary")).otherwise(""))
    return each.withColumn("rank", nth).where(F.col("rank") <= most).withColumn("line", line)


def incident_answers(questions: DataFrame, incidents: DataFrame, most: int = MOST_INCIDENTS) -> DataFrame:
    """(question_id, n_incidents, answer) for questions (question_id, aspect); a null aspect asks for all."""
    lists = top_incidents(incidents, most).groupBy("of").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda x: x["line"]), "\n").alias("lines"))
    text = F.concat(F.lit("Top "), F.col("n").cast("string"), F.lit(" emerging-issue incident(s) by severity score:\n"), F.col("lines"))
    j = questions.join(lists.select("of", "n", text.alias("answer")), F.col("aspect").eqNullSafe(F.col("of")), "left")
    return j.select("question_id", F.coalesce("n", F.lit(0)).alias("n_incidents"), F.coalesce("answer", F.lit("No emerging-issue incidents have been detected.")).alias("answer"))
