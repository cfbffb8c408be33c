"""Questions: routing, filters, citations and guarded answers, for batches of questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import cited_ids, contains_any, content_tokens, strip, strip_unsupported
from tidemark.operators import lexicon as lx

NO_EVIDENCE = "No reviews were retrieved for this question."
SENTINEL = "INSUFFICIENT_EVIDENCE"


def aspect_of(question: Column) -> Column:
    q = F.lower(question)
    return F.coalesce(*[F.when(q.contains(a), c) for a, c in lx.ASPECT_ALIASES.items()])


def route(question: Column) -> Column:
    """incident before analytics before retrieval; a question that names an aspect goes to retrieval."""
    q = strip(F.lower(F.coalesce(question, F.lit(""))))
    return (
        F.when(q == "", "insufficient_scope")
        .when(contains_any(q, lx.INCIDENT_WORDS), "incident_summary")
        .when(contains_any(q, lx.ANALYTICS_WORDS), "analytics_summary")
        .when(contains_any(q, lx.RETRIEVAL_WORDS), "retrieval_answer")
        .when(aspect_of(q).isNotNull(), "retrieval_answer")
        .otherwise("insufficient_scope")
    )


def sentiment_of(question: Column) -> Column:
    q = F.lower(question)
    neg, pos = contains_any(q, lx.NEGATIVE_HINTS), contains_any(q, lx.POSITIVE_HINTS)
    return F.when(neg & ~pos, "negative").when(pos & ~neg, "positive")


def brand_of(question: Column) -> Column:
    q = F.lower(question)
    return F.coalesce(*[F.when(q.rlike(rf"\b{b.lower()}\b"), b) for b in lx.BRANDS])


def routed(questions: DataFrame, text: str = "question") -> DataFrame:
    q = F.col(text)
    return questions.withColumns({"route": route(q), "aspect": aspect_of(q), "sentiment": sentiment_of(q), "brand": brand_of(q)})


def citations(hits: DataFrame, text: str = "text", quote: str | None = None, aspects: str | None = None) -> DataFrame:
    """Ranked hits as numbered evidence, gathered by question (a question has at most its top-k hits): the
    document, its snippet, a quote and the aspects it is tagged with, where columns for these are named."""
    said = F.coalesce(F.col(quote), F.lit("")) if quote else F.lit("")
    tags = F.coalesce(F.col(aspects), F.array().cast("array<string>")) if aspects else F.array().cast("array<string>")
    one = F.struct(F.col("rank").cast("int").alias("id"), "doc_id", F.col(text).alias("evidence"), said.alias("quote"), tags.alias("aspects"))
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_list(one)).alias("citations"))


def answer(questions: DataFrame, cited: DataFrame, text: str = "question") -> DataFrame:
    """Offline answers: evidence whose quote, snippet or aspects share a content word with the question is
    cited, else the question is declared unanswerable. Adds answer, insufficient, unsupported (markers
    without evidence) and uncited."""
    df = questions.join(cited, "query_id", "left").withColumn("citations", F.coalesce("citations", F.array().cast(cited.schema["citations"].dataType)))
    words = content_tokens(F.col(text), lx.ANSWER_STOP_WORDS)
    evidence = lambda c: F.concat_ws(" ", c["quote"], c["evidence"], F.array_join(c["aspects"], " "))
    relevant = F.filter("citations", lambda c: F.arrays_overlap(words, content_tokens(evidence(c), lx.ANSWER_STOP_WORDS)))
    df = df.withColumn("relevant", relevant)
    marks = F.array_join(F.transform("relevant", lambda c: F.concat(F.lit("["), c["id"].cast("string"), F.lit("]"))), "")
    lead = F.get("relevant", F.lit(0))
    # fixed values: the wording of the offline answers
    told = F.concat(F.lit("Based on "), F.size("relevant").cast("string"), F.lit(" retrieved review(s), customers raise points relevant to this question "), marks, F.lit('. For example, one review states: "'), F.coalesce(F.nullif(lead["quote"], F.lit("")), lead["evidence"]), F.lit('" ['), lead["id"].cast("string"), F.lit("]."))
    raw = F.when(F.size("citations") == 0, NO_EVIDENCE).when(F.size("relevant") == 0, f"{SENTINEL} None of the retrieved reviews mention anything relevant to this question.").otherwise(told)
    return guarded(df.withColumn("answer", raw), F.transform("citations", lambda c: c["id"]))


def guarded(answers: DataFrame, valid: Column) -> DataFrame:
    """Strips markers that no evidence stands behind. An answer is insufficient without evidence, or if it
    holds the sentinel, which is taken out."""
    said = F.col("answer").contains(SENTINEL)
    df = answers.withColumn("insufficient", said | (F.size(valid) == 0)).withColumn("answer", F.when(said, F.trim(F.replace("answer", F.lit(SENTINEL), F.lit("")))).otherwise(F.col("answer")))
    cited = cited_ids(F.col("answer"))
    df = df.withColumn("unsupported", F.array_sort(F.array_except(cited, valid))).withColumn("uncited", F.size(F.array_intersect(cited, valid)) == 0)
    return df.withColumn("answer", strip_unsupported(F.col("answer"), valid))
