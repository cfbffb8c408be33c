"""Quality rules as a learned decision list, with DataFrame functions only.

Statistics of every document are taken from its whole text. On the labelled ones a decision list is
learned by sequential covering: each rule is a conjunction of thresholds, grown literal by literal
by information gain on two thirds of the labelled rows and pruned on the rest; what it covers is set
aside and the next rule is learned, until a rule isn't precise enough on the rows it wasn't grown on.
The list comes out as one ordered Spark CASE expression, its rules as readable text.

Learning reads counts only: for each feature and bin, how many good and bad rows there are, from one
aggregation a step over all labelled rows; at most a row for each feature and bin reaches the driver.

A null or empty text has no words and fails the base rules. Labels that are null are left out; an id
with several labels is bad if any says so. Without labels of both classes no rule is learned and all
that the base rules pass is kept. Repeated rows are judged alike; other columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, materialize, words

#: The characters that n_symbols counts.
SYMBOLS = "#*$%&|<>"
BINS = 24
MAX_RULES, MAX_LITERALS = 8, 3
LEAST_PRECISION, LEAST_COVER = 0.8, 3


def _less(text: Column, pattern: str) -> Column:
    """How many characters match a class."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def repeat_words(df: DataFrame, w: str, out: str) -> DataFrame:
    """Adds how many words of array `w` lie in three-word windows that are found twice or more in it.

    Windows are sorted by a hash with their place packed in, which leaves the few whose neighbours look
    alike; those are compared by their words."""
    n = F.size(w)
    at = lambda c, i: F.get(F.col(c), i)
    h = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.pmod(F.xxhash64(at(w, i), at(w, i + 1), at(w, i + 2)), F.floor(F.lit(1 << 62) / n)) * n + i)
    df = df.withColumn("__h", F.sort_array(F.when(n >= 3, h).otherwise(F.array().cast("array<bigint>"))))
    df = df.withColumn("__n", F.greatest(n, F.lit(1)).cast("bigint"))
    near = lambda v, i: F.coalesce(_div(v) == _div(at("__h", i - 1)), F.lit(False)) | F.coalesce(_div(v) == _div(at("__h", i + 1)), F.lit(False))
    df = df.withColumn("__c", F.transform(F.filter("__h", near), lambda v: (v % F.col("__n")).cast("int")))
    gram = lambda i: F.concat_ws(" ", at(w, i), at(w, i + 1), at(w, i + 2))
    df = df.withColumn("__g", F.sort_array(F.transform("__c", lambda i: F.struct(gram(i).alias("g"), i.alias("i")))))
    same = lambda x, i: F.coalesce(x["g"] == at("__g", i - 1)["g"], F.lit(False)) | F.coalesce(x["g"] == at("__g", i + 1)["g"], F.lit(False))
    df = df.withColumn("__p", F.sort_array(F.transform(F.filter("__g", same), lambda x: x["i"])))
    gaps = F.transform("__p", lambda p, i: F.least(F.lit(3), F.coalesce(at("__p", i + 1) - p, F.lit(3))))
    df = df.withColumn(out, F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return df.drop("__h", "__n", "__c", "__g", "__p")


def _div(v: Column) -> Column:
    return F.call_function("div", v, F.col("__n"))


def statistics(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id with the statistics of each document."""
    t = F.col("__t")
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("__t")).withColumn("__w", words(t))
    df = repeat_words(df, "__w", "n_repeat_words")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("__l", lines)
    return df.select(
        "doc_id",
        F.size("__w").cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("__l").cast("long").alias("n_lines"),
        _less(t, "[A-Z]").alias("n_capitals"),
        (F.length(t) - F.length(F.translate(t, "!?", ""))).cast("long").alias("n_marks"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _per(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def features() -> dict[str, Column]:
    """What rules may test."""
    return {
        "n_words": F.col("n_words").cast("double"),
        "chars_per_word": _per("word_chars", "n_words"),
        "symbols_per_word": _per("n_symbols", "n_words"),
        "dup_lines_per_line": _per("n_dup_lines", "n_lines"),
        "repeat_words_per_word": _per("n_repeat_words", "n_words"),
        "capitals_per_char": _per("n_capitals", "word_chars"),
        "marks_per_char": _per("n_marks", "word_chars"),
    }


@dataclass(frozen=True)
class Literal:
    feature: str
    at_least: bool
    bin: int
    threshold: float

    def column(self) -> Column:
        x = features()[self.feature]
        return x >= self.threshold if self.at_least else x < self.threshold

    def binned(self) -> Column:
        b = F.col(f"b_{self.feature}")
        return b >= self.bin if self.at_least else b < self.bin

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Literal, ...]


def _all(columns: list[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def thresholds(train: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds of each feature: quantiles of the bad rows and of the good ones."""
    share = [i / (BINS // 2) for i in range(1, BINS // 2)]
    tails = [0.005, 0.995]
    picks = [F.percentile_approx(F.when(F.col("bad") == k, x), [*share, *tails], 1000).alias(f"{name}_{k}") for name, x in features().items() for k in (0, 1)]
    row = train.agg(*picks).first()
    # a value itself stays below the threshold that follows it
    return {name: sorted({float(v) for k in (0, 1) for v in (row[f"{name}_{k}"] or [])}) for name in features()}


def learn(train: DataFrame) -> list[Rule]:
    """Rules for bad rows, from statistics with `bad` (0 or 1) and `grow` (boolean)."""
    total = train.agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")).first()
    if not total["n"] or not total["bad"] or total["bad"] == total["n"]:
        return []
    cuts = thresholds(train)
    bins = [sum((F.lit(0) + (x >= t).cast("int") for t in cuts[name]), F.lit(0)).cast("tinyint").alias(f"b_{name}") for name, x in features().items()]
    rows = materialize(train.select("bad", "grow", *bins), "bins")
    names = [n for n in cuts if cuts[n]]

    def counts(where: Column) -> dict[str, dict[int, tuple[int, int]]]:
        """(bad, good) rows by feature and bin."""
        each = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(f"b_{n}").alias("b")) for n in names])).alias("x")
        found = rows.where(where).select("bad", each).groupBy("x.f", "x.b").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect()
        out: dict[str, dict[int, tuple[int, int]]] = {}
        for r in found:
            out.setdefault(r["f"], {})[r["b"]] = (r["bad"], r["good"])
        return out

    def both(where: Column) -> tuple[int, int]:
        r = rows.where(where).agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).first()
        return r["p"] or 0, r["n"] or 0

    rules: list[Rule] = []
    free = F.lit(True)
    while len(rules) < MAX_RULES:
        rule: list[Literal] = []
        p, n = both(free & F.col("grow"))
        if p < LEAST_COVER:
            break
        while len(rule) < MAX_LITERALS and n:
            table, best = counts(free & F.col("grow") & _all([x.binned() for x in rule])), None
            for name in names:
                by = table.get(name, {})
                bp = bn = 0
                for b in range(1, len(cuts[name]) + 1):
                    bp, bn = bp + by.get(b - 1, (0, 0))[0], bn + by.get(b - 1, (0, 0))[1]
                    for at_least, (cp, cn) in ((False, (bp, bn)), (True, (p - bp, n - bn))):
                        if cp < LEAST_COVER:
                            continue
                        gain = cp * (log2(cp / (cp + cn)) - log2(p / (p + n)))
                        if best is None or gain > best[0] + 1e-9:
                            best = (gain, Literal(name, at_least, b, cuts[name][b - 1]), cp, cn)
            if best is None or best[0] <= 0.5:
                break
            _, literal, p, n = best
            rule.append(literal)
        if not rule:
            break
        # pruned from the end by what the rule is worth on rows that it wasn't grown on
        scored = []
        for k in range(len(rule), 0, -1):
            hp, hn = both(free & ~F.col("grow") & _all([x.binned() for x in rule[:k]]))
            scored.append(((hp - hn) / (hp + hn) if hp + hn else -1.0, -k, hp, hn))
        worth, k, hp, hn = max(scored)
        rule = rule[:-k]
        if hp + hn == 0 or hp / (hp + hn) < LEAST_PRECISION:
            break
        rules.append(tuple(rule))
        free = free & ~_all([x.binned() for x in rule])
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one expression: 'rule 1', 'rule 2', ... for what a rule rejects, else 'keep'."""
    if not rules:
        return F.lit("keep")
    out = F
    for i, rule in enumerate(rules, 1):
        out = out.when(_all([x.column() for x in rule]), F.lit(f"rule {i}"))
    return out.otherwise(F.lit("keep"))


def describe(rules: list[Rule]) -> list[str]:
    return [f"rule {i}: reject if " + " and ".join(map(str, r)) for i, r in enumerate(rules, 1)]


def training_rows(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", label_col: str = "quality", seed: int = 11) -> DataFrame:
    given = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max((F.col(label_col) == 0).cast("int")).alias("bad"))
    rows = stats.where(~base_failed()).join(given, "doc_id")
    return rows.withColumn("grow", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(3)) > 0)


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: statistics, base_failed, rule, kept."""
    stats = materialize(statistics(docs, id_col=id_col, text_col=text_col), "statistics")
    rules = learn(materialize(training_rows(stats, labels), "labelled"))
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == "keep"))
