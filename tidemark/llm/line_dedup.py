"""Line dedup with levelled sorted runs of line hashes.

A line is known by its key: the line without ASCII white space at its ends, A-Z in lower case. The store of
lines already seen is a set of runs: tables of hashes, bucketed by hash and sorted in each bucket. A new batch
of documents is reduced to its distinct hashes, each with the smallest id that holds it; these are
merge-anti-joined with the runs, bucket by bucket, and what no run holds is the batch's own run, at level 0.
When a level holds `fanout` runs they are compacted into one run of the next level. Runs of a store hold different
hashes, so that compaction is a union, and a line is written once for each level it climbs.

A line of the batch stays if the batch's own run names its document as holder: one more anti-join, on hash
and id, so that a line which a third of all documents hold is dealt out by document. Only places of lines to
drop are gathered, by document; texts are cut by place, in time linear in the text.

Nothing but DataFrame expressions. Hashes are the first 128 bits of a SHA-256.

Defined results: a null or empty text is one empty line; keys below `least` code points never go; repeated
rows, and different rows with one id, are one document, so they keep each other's lines; documents with a null id
are one document that comes after all others; an empty table gives no rows. Other columns
are kept as they are, but for those that the counts are named after.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, shared_path

BLANK = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Code points a key has at least; runs of a level before they are compacted; buckets of a run.
LEAST, FANOUT, BUCKETS = 10, 4, 32
RUN = "line_run"


def _digest(x: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.substring(F.unhex(F.sha2(F.encode(x, "UTF-8"), 256)), 1, 16)


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n", -1)


def _place(id_col: str, text: str) -> list[Column]:
    """What names a document's rows: its id in order, null last, and (for rows that share one) a hash of its text."""
    return [F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id")).alias("d"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("t")]


def line_hashes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(d, t, pos, h): the hash of each line whose key is long enough, with its document, text and place."""
    # what names a document is found below the generator, once for all its lines
    rows = docs.select(*_place(id_col, text_col), _lines(text_col).alias("lines")).select("d", "t", F.posexplode("lines").alias("pos", "line"))
    keys = rows.select("d", "t", "pos", F.translate(F.btrim("line", F.lit(BLANK)), UPPER, UPPER.lower()).alias("key"))
    return keys.where(F.length("key") >= least).select("d", "t", "pos", _digest(F.col("key")).alias("h"))


class LineStore:
    """The runs of lines seen so far, in the shared folder: levels[0] holds the youngest."""

    def __init__(self, spark: SparkSession, *, fanout: int = FANOUT, buckets: int = BUCKETS) -> None:
        self.spark, self.fanout, self.buckets = spark, fanout, buckets
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        """A run: one sorted file a bucket."""
        name, path = f"{RUN}_{uuid.uuid4().hex}", shared_path(self.spark, RUN)
        rows.repartition(self.buckets, "h").write.bucketBy(self.buckets, "h").sortBy("h").format("parquet").option("path", path).saveAsTable(name)
        self.paths[name] = path
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def fresh(self, hashes: DataFrame) -> DataFrame:
        """Of (h, ...) the rows that no run holds."""
        for run in self.runs():
            hashes = hashes.join(run.select("h"), "h", "left_anti")
        return hashes

    def add(self, hashes: DataFrame) -> DataFrame:
        """Adds what is fresh as a run of its own, and compacts full levels. Returns the new run."""
        name = self._write(self.fresh(hashes))
        # by its files, not its buckets, so that a reader may deal it out by other columns as well
        own = self.spark.read.schema(hashes.schema).parquet(self.paths[name])
        self.levels[0].append(name)
        for at in range(len(self.levels)):
            self._compact(at)
        return own

    def _compact(self, at: int) -> None:
        level = self.levels[at]
        if len(level) < self.fanout:
            return
        union = self.spark.table(level[0]).select("h")
        for name in level[1:]:
            union = union.unionAll(self.spark.table(name).select("h"))
        if at + 1 == len(self.levels):
            self.levels.append([])
        self.levels[at + 1].append(self._write(union))
        # files stay until the shared folder is cleared: a reader of the old runs may still be at work
        self.levels[at] = []
        if at + 2 == len(self.levels):
            self._compact(at + 1)


def dedup_batch(store: LineStore, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """The batch's rows with the text that is left, n_lines (before) and n_dropped. A line goes if an earlier
    batch held it, or a smaller id of this one."""
    hashes = line_hashes(docs, id_col=id_col, text_col=text_col, least=least)
    run = store.add(hashes.groupBy("h").agg(F.min("d").alias("d")))
    # dealt out by hash and document, so that a frequent line is no hot key
    gone = hashes.join(run.select("h", "d"), ["h", "d"], "left_anti")
    places = gone.groupBy("d", "t").agg(F.array_sort(F.collect_set("pos")).alias("p"))
    # internal names that the table lacks
    tag = "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in docs.columns), default=0))
    marks = [c.alias(f"{tag}{n}") for c, n in zip(_place(id_col, text_col), "dt", strict=True)]
    rows = docs.select("*", *marks).join(places.select(F.col("d").alias(f"{tag}d"), F.col("t").alias(f"{tag}t"), F.col("p").alias(f"{tag}p")), [f"{tag}d", f"{tag}t"], "left")
    # columns of their own: inside a lambda the text would be split for every piece
    rows = rows.withColumn(f"{tag}l", _lines(text_col))
    lines, n = F.col(f"{tag}l"), F.size(f"{tag}l")
    p = F.coalesce(F.col(f"{tag}p"), F.array().cast("array<int>"))

    def between(i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(F.get(p, i - 1) + 1)
        return F.slice(lines, begin + 1, F.coalesce(F.get(p, i), n) - begin)

    left = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(p)), between)), "\n")
    text = F.when(F.col(f"{tag}p").isNull(), F.col(text_col)).otherwise(left)
    kept = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in (n_lines, n_dropped)]
    return rows.select(*kept, n.cast("long").alias(n_lines), F.size(p).cast("long").alias(n_dropped))


def dedup_lines(docs: DataFrame, *, batches: int = 4, fanout: int = 2, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """dedup_batch over a whole table, cut by id into batches of about the same number of documents. Ids are
    numbers; the result doesn't depend on where the table is cut."""
    cuts = docs.select(F.percentile_approx(F.col(id_col).cast("long"), [(i + 1) / batches for i in range(batches - 1)] or [1.0], 10000)).first()[0] or []
    cuts = sorted(set(cuts))[: batches - 1]
    i = F.col(id_col)
    store, out = LineStore(docs.sparkSession, fanout=fanout), None
    for lo, hi in zip([None, *cuts], [*cuts, None], strict=True):
        part = (i > lo if lo is not None else F.lit(True)) & (i <= hi if hi is not None else F.lit(True))
        batch = docs.where(part if hi is not None else part | i.isNull())
        done = materialize(dedup_batch(store, batch, id_col=id_col, text_col=text_col, least=least), "lines")
        out = done if out is None else out.unionAll(done)
    return out


def kept_digest(rows: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns of a report: doc_id, n_lines, n_dropped and the SHA-256 of the text that is left."""
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    return rows.select(F.col(id_col).alias("doc_id"), "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))
