"""N-gram Jaccard join by grouped prefixes, with components of the links.

Documents are sets of word n-grams. Two sets that are similar enough share a token among the first
few of each, in any order that is the same for all sets: here by hash, behind those that a count-min
sketch over all documents calls common, so that passages found everywhere seldom come up.

1. Equal sets are one class, its smallest document stands for it. Classes of the same size with the
   same prefix are one group; its smallest class stands for it when tokens are counted.
2. Prefix tokens that a second sketch puts in one group only are dropped: they lead to no pair. Of
   tokens that stand in the same groups one is kept.
3. Groups are expanded to their members. Pairs of classes that share a token are filtered by size and by a bound on what their sets differ
   in: each set has a bitmap of the parities of its tokens' places, and two bitmaps differ in no
   more bits than the sets differ in tokens. Short lists, most of them, are met whole: they give all their
   pairs, once, and need no further round. In a longer list each class meets a few classes picked by
   hash, never all, and keeps the one of the smallest component. Each member of a group meets its
   head. What the filter leaves is verified on the whole sets; the links give components.
4. Lists with one component are done: whatever else links there changes nothing. In the others, if any of
   their pairs may link, classes outside the list's main component meet other picks. Then, in each
   list that is still mixed, every such class meets all classes of the list that lie elsewhere, under the same
   filter, and so do the pairs of short lists that still lie in two components, so that no link between
   components is lost.

Of a short list too, a class has one pair verified first, with its smallest partner. Each class has one partner a round, and the join's filter drops the others before they become rows: a
family of near copies costs rows in proportion to its size. The bitmap of a set of many tokens would be
full and tell nothing, so long sets meet by parts: hash bits deal both sets into as many parts, and if
they differ in few enough tokens there is a part in which they differ in no more than its share. Each part
has a prefix and a bitmap of its own. How many parts there are follows from the smaller set; a set that may
be the larger one stands in the lists of both numbers. Pairs of long sets meet by larger bitmaps of the whole
before they are compared.

Rows that share an id are one document whose links are those of each. A null id links with nothing
and has a null component. A null or empty text has an empty set and links with nothing. An empty
table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import sketch
from tidemark.llm.common import materialize, mix64, rolling, scratch, word_hashes
from tidemark.llm.components import components

BASE = 0x9E3779B97F4A7C15
#: Ids up to which texts are picked by a broadcast: 8 MB.
BROADCAST_IDS = 500_000
#: Long columns of a set's bitmap: 1024 bits.
BITMAP = [f"m{i}" for i in range(16)]
#: Tokens above which a set has a larger bitmap too when it is verified, and the longs of that.
LONG_SET, LARGE = 1500, 256
#: The token of a part that has too few tokens for its prefix.
FEW = np.uint64(0xD1B54A32D192ED03)
FORMS = "doc_id long, n int, s1 long, s2 long, g long, prefix binary, slices binary, maps binary, large array<long>"
PARTS = "doc_id long, n int, s1 long, s2 long, g long, slice int, parts int, " + ", ".join(f"{m} long" for m in BITMAP)


def shingles(text: str, size: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct n-grams of words, ASCII letters lower-cased;
    of the whole sequence if it has fewer words."""
    tokens = text.encode().lower().split()
    if not tokens:
        return np.array([], np.uint64)
    if len(tokens) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
    return np.unique(rolling(word_hashes(tokens), size, BASE))


def least_common(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def bitmaps(s: np.ndarray, parts: int = 1, longs: int = len(BITMAP)) -> np.ndarray:
    """For each part a bitmap: for each of 64 places a long the parity of the tokens there."""
    places = (s >> np.uint64(20)).astype(np.int64) & (64 * longs - 1)
    odd = np.bincount(part_of(s, parts) * 64 * longs + places, minlength=64 * longs * parts) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").reshape(parts, longs)


def parts_of(n: int, percent: int, part: int) -> list[int]:
    """Into how many parts a set of n tokens is dealt when it is the larger or the smaller of a pair:
    powers of two that leave about `part` tokens a part of the smaller set."""
    lo, hi = (max(0, (-(-m // part) - 1).bit_length()) for m in (least_common(n, percent), n))
    return [1 << k for k in range(lo, hi + 1)]


def part_of(s: np.ndarray, parts: int) -> np.ndarray:
    return ((s >> np.uint64(40)) & np.uint64(parts - 1)).astype(np.int64)


def prefix_of(s: np.ndarray, level: np.ndarray, parts: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens by which a set meets others that are dealt into as many parts, and the part of each,
    numbered from `parts` on. Two sets that may link share one of a part in which near() lets them meet."""
    n = len(s)
    if parts == 1:
        first = s[np.lexsort((s, level))][: n - least_common(n, percent) + 1]
        return first, np.ones(len(first), np.int32)
    own = part_of(s, parts)
    order = np.lexsort((s, level, own))
    sizes = np.bincount(own, minlength=parts)
    apart = n * (100 - percent) // (percent * parts)  # tokens that a part may differ in, at most
    some = order[np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes) <= apart]
    few = np.flatnonzero(sizes <= apart)
    tokens = np.r_[mix64(s[some] ^ np.uint64(parts)), mix64((few + parts).astype(np.uint64) ^ FEW)]
    return tokens, np.r_[own[some] + parts, few + parts].astype(np.int32)


def near(percent: int, of: str = "", n_other: str = "ny", bitmap_other: str = "k") -> Column:
    """Whether classes of n and ny tokens, with bitmaps of a part in BITMAP and in columns k.., may link."""
    n, ny = F.col(f"{of}n").cast("long"), F.col(n_other).cast("long")
    apart = reduce(add, (F.bit_count(F.col(f"{of}{m}").bitwiseXOR(F.col(f"{bitmap_other}{i}"))) for i, m in enumerate(BITMAP)))
    return (F.least(n, ny) * 100 >= F.greatest(n, ny) * percent) & (apart * F.col(f"{of}parts").cast("long") * (100 + percent) <= (n + ny) * (100 - percent))


def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each part of each set, with its bitmap."""
    for batch in batches:
        found = [np.frombuffer(m, "<i8").reshape(-1, len(BITMAP) + 1) for m in batch.column("maps").to_pylist()]
        if found:
            rows, flat = np.repeat(np.arange(len(found)), [len(m) for m in found]), np.concatenate(found)
            kept = [batch.column(c).take(pa.array(rows)) for c in ("doc_id", "n", "s1", "s2", "g")]
            slices = flat[:, 0].astype(np.int32)
            parts = np.left_shift(1, np.floor(np.log2(slices)).astype(np.int32)).astype(np.int32)
            columns = [*kept, pa.array(slices), pa.array(parts), *(pa.array(np.ascontiguousarray(m)) for m in flat.T[1:])]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in PARTS.split(", ")])


def link_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85, rounds: int = 3, picks: int = 8, part: int = 1000, short: int = 64) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id. rounds, picks, part and short (lists met whole) change the work, not the result."""
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def all_keys(batch: pa.RecordBatch) -> np.ndarray:
        found = [shingles(t, size) for t in _texts(batch)]
        return np.concatenate(found) if found else np.array([], np.uint64)

    common = spark.sparkContext.broadcast(sketch.levels(named.select("text").mapInArrow(sketch.level_pass(all_keys), sketch.LEVEL_SCHEMA)))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sketch.sliced(batches):
            cols: list[list] = [[] for _ in range(8)]
            for text in _texts(batch):
                s = shingles(text, size)
                n = len(s)
                whole = xxhash.xxh3_128_intdigest(s.tobytes())
                level = sketch.level_of(common.value, s)
                dealt = parts_of(n, percent, part) if n else []
                first, slices = (np.concatenate(x) for x in zip(*(prefix_of(s, level, k, percent) for k in dealt), strict=True)) if n else (s, np.array([], np.int32))
                group = xxhash.xxh3_64_intdigest(first.tobytes(), seed=n)
                maps = [np.c_[np.arange(k, 2 * k), bitmaps(s, k)] for k in sorted({1, *dealt})]
                large = bitmaps(s, 1, LARGE)[0] if n > LONG_SET else None
                row = (n, (whole >> 64) - 2**63, (whole & (2**64 - 1)) - 2**63, group - 2**63, first.tobytes(), slices.tobytes(), np.concatenate(maps).astype("<i8").tobytes(), large)
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            columns = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], [x.split()[0] for x in FORMS.split(", ")])

    forms = materialize(named.mapInArrow(describe, FORMS), "forms")
    full = forms.where("doc_id IS NOT NULL AND n > 0")
    maps = full.select("doc_id", "n", "s1", "s2", "g", "maps").mapInArrow(unfold, PARTS).groupBy("s1", "s2", "slice")
    maps = materialize(maps.agg(F.min("doc_id").alias("cls"), *[F.first(c).alias(c) for c in ("n", "g", "parts", *BITMAP)]), "classes")
    classes = maps.where("slice = 1").select("s1", "s2", "cls", "n", "g")  # each set has one of its whole
    maps = maps.select("cls", "slice", "parts", "n", *BITMAP)
    heads = materialize(classes.groupBy("g", "n").agg(F.min("cls").alias("gid"), F.count(F.lit(1)).alias("size")), "heads")
    members = materialize(classes.join(heads, ["g", "n"]).drop("s1", "s2").withColumn("label", F.col("cls")), "members")

    own_head = heads.select(F.col("gid").alias("doc_id"), "n", "g", (F.col("size") > 1).alias("many"))
    firsts = materialize(full.join(own_head, ["doc_id", "n", "g"]).select("doc_id", "prefix", "slices", "many"), "prefixes")
    width = sketch.width_for((firsts.agg(F.sum(F.length("prefix"))).first()[0] or 0) / 8)
    prefix_keys = lambda batch: np.frombuffer(b"".join(batch.column("prefix").to_pylist()), np.uint64)
    bits = spark.sparkContext.broadcast(sketch.repeated(firsts.select("prefix").mapInArrow(sketch.sketch_pass(prefix_keys, width), sketch.SCHEMA), width))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(p) // 8 for p in batch.column("prefix").to_pylist()], np.int64)
            keys = prefix_keys(batch)
            hit = sketch.maybe_repeated(bits.value, keys, width)
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes)[hit])
            slices = np.frombuffer(b"".join(batch.column("slices").to_pylist()), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(keys[hit].view(np.int64)), batch.column("doc_id").take(rows), pa.array(slices[hit]), batch.column("many").take(rows)], ["token", "gid", "slice", "many"])

    def mixed(lists: DataFrame) -> DataFrame:
        """The lists that hold two labels or more, one of each set of classes. few: a short list."""
        sums = [F.bit_xor(F.xxhash64("cls", F.lit(s))).alias(f"x{s}") for s in (1, 2)]
        found = lists.groupBy("token", "slice").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("size"), *sums)
        found = found.where("lo < hi").groupBy("slice", "size", "x1", "x2").agg(F.min("token").alias("token"))
        found = found.select("token", (F.col("size") <= short).alias("few"))
        return materialize(lists.join(found, "token").select("token", "slice", "cls", "label", "few"), "lists")

    #: the other side of a pair: y, its size, and its bitmap in the columns k..
    facing = maps.select(F.col("cls").alias("y"), "slice", F.col("n").alias("ny"), *[F.col(m).alias(f"k{i}") for i, m in enumerate(BITMAP)])

    def met(lists: DataFrame, others: DataFrame) -> DataFrame:
        """The pairs of a class in lists and one in others, of the same list and of other labels, that may link."""
        pairs = lists.join(maps, ["cls", "slice"]).join(others.join(facing, ["y", "slice"]).drop("slice"), "token")
        return pairs.where((F.col("label") != F.col("ly")) & near(percent))

    def whole_lists(lists: DataFrame) -> DataFrame:
        """The pairs of classes of the same list that may link, all of them: for lists of a few classes."""
        side = lists.join(maps, ["cls", "slice"])
        l, r = side.alias("l"), side.alias("r")  # the same plan and columns, so that it is shuffled once
        pairs = l.join(r, (F.col("l.token") == F.col("r.token")) & (F.col("l.parts") == F.col("r.parts")) & (F.col("l.cls") < F.col("r.cls")) & near(percent, "l.", "r.n", "r.m"))
        return materialize(pairs.select(F.col("l.cls").alias("a"), F.col("r.cls").alias("b")).distinct(), "open")

    def partners(lists: DataFrame, some: DataFrame, salt: int, picks: int) -> tuple[DataFrame, DataFrame]:
        """For each class in some of the lists' rows the one of the smallest label among those picked in its lists that may link;
        and the lists where that happened."""
        order = F.xxhash64("cls", "token", F.lit(salt))  # other picks in each list
        picked = lists.groupBy("token", "slice", F.pmod(order, F.lit(picks)).alias("bucket"))
        picked = picked.agg(F.min_by("cls", order).alias("y"), F.min_by("label", order).alias("ly")).drop("bucket")
        found = met(some, picked).groupBy("token", F.col("cls").alias("a")).agg(F.min(F.struct("ly", "y")).alias("o"))
        found = materialize(found, "met")
        return found.groupBy("a").agg(F.min("o").alias("o")).select("a", F.col("o.y").alias("b")), found.select("token").distinct()

    def minor_of(lists: DataFrame) -> DataFrame:
        """The rows of lists outside the list's largest label."""
        main = lists.groupBy("token", "label").count().groupBy("token").agg(F.max_by("label", "count").alias("main"))
        return lists.join(main, "token").where("label <> main").drop("main")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found = [shingles(t, size).view(np.int64) for t in _texts(part)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], ["cls", "s"])

    def ids_of(pairs: DataFrame) -> DataFrame:
        """The ids in pairs; sent to every task if they are few."""
        ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets are similar enough."""
        pairs = materialize(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "pairs")
        # two long sets first meet by their larger bitmaps
        long = full.where("large IS NOT NULL").join(ids_of(pairs), "doc_id", "left_semi").select(F.col("doc_id").alias("cls"), "n", F.col("large").alias("m"))
        as_side = lambda df, c: df.select(F.col("cls").alias(c), *[F.col(x).alias(f"{x}{c}") for x in df.columns[1:]])
        apart = F.aggregate(F.zip_with("ma", "mb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
        may = F.col("ma").isNull() | F.col("mb").isNull() | (apart * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
        pairs = materialize(pairs.join(as_side(long, "a"), "a", "left").join(as_side(long, "b"), "b", "left").where(may).select("a", "b").distinct(), "likely")
        sets = materialize(named.join(ids_of(pairs), "doc_id", "left_semi").mapInArrow(sets_of, "cls long, s array<long>").where(F.size("s") > 0), "sets")
        both = pairs.join(as_side(sets, "a"), "a").join(as_side(sets, "b"), "b").withColumn("i", F.size(F.array_intersect("sa", "sb")))
        return both.where(F.col("i") * 100 >= (F.size("sa") + F.size("sb") - F.col("i")) * percent).select("a", "b")

    def joined(links: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The links with those among the pairs, and the classes labelled by their components."""
        with scratch(spark) as keep:
            links = keep(links.unionAll(verified(pairs)), "links")
            labels = components(links).withColumnRenamed("node", "cls")
            return links, keep(members.drop("label").join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls")), "labelled")

    def with_label(lists: DataFrame, state: DataFrame) -> DataFrame:
        return lists.select("token", "slice", "cls").join(state.select("cls", "label").distinct(), "cls")

    posts = materialize(firsts.mapInArrow(post, "token long, gid long, slice int, many boolean"), "posts")
    whole = lambda df: df.where("slice = 1").drop("slice")
    # each member stands in its group's lists, and groups of several are lists of their own
    several = members.where("size > 1")
    lists = posts.where("NOT many").select("token", "slice", F.col("gid").alias("cls"))
    lists = lists.unionAll(posts.where("many").join(several.select("gid", "cls"), "gid").select("token", "slice", "cls"))
    lists = lists.unionAll(several.select(F.xxhash64(F.lit("group"), "g", "n").alias("token"), F.lit(1).alias("slice"), "cls"))
    lists = mixed(lists.withColumn("label", F.col("cls")))
    # short lists are met whole, once: each class has its first partner verified now, and what is left of their pairs comes last
    opened = whole_lists(lists.where("few").drop("few"))
    first = opened.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    # members meet their head
    own = members.where("cls <> gid").select("cls", "gid").join(whole(maps), "cls").join(whole(facing).withColumnRenamed("y", "gid"), "gid").where(near(percent))
    own = own.select(F.col("gid").alias("a"), F.col("cls").alias("b"))
    lists = lists.where("NOT few").drop("few")
    pairs, active = partners(lists, lists, 0, picks)
    links, state = joined(spark.createDataFrame([], "a long, b long"), pairs.unionAll(own).unionAll(first))
    # long lists where some may link go on; where none of those picked may, all meet in the last step
    idle = lists.join(active, "token", "left_anti")
    lists = lists.join(active, "token", "left_semi")
    for salt in range(1, rounds):
        lists = mixed(with_label(lists, state))
        links, state = joined(links, partners(lists, minor_of(lists), salt, 4 * picks)[0])
    lists = mixed(with_label(lists.select("token", "slice", "cls").unionAll(idle.select("token", "slice", "cls")), state))
    minor = minor_of(lists).select("token", "slice", F.col("cls").alias("y"), F.col("label").alias("ly"))
    # the list's side comes first: the join holds a list's minor classes and streams the others past them
    rest = met(lists, minor).select(F.col("cls").alias("a"), F.col("y").alias("b"))
    label_of = lambda c: state.select(F.col("cls").alias(c), F.col("label").alias(f"l{c}")).distinct()
    rest = rest.unionAll(opened.join(first, ["a", "b"], "left_anti").join(label_of("a"), "a").join(label_of("b"), "b").where("la <> lb").select("a", "b"))
    with scratch(spark) as keep:
        found = keep(components(links.unionAll(verified(rest))), "found")

    light = forms.select("doc_id", "n", "s1", "s2")
    # each document to its class, each class to its component
    edges = full.select("s1", "s2", "doc_id").join(classes.select("s1", "s2", "cls"), ["s1", "s2"]).select("doc_id", "cls").where("doc_id <> cls")
    labels = edges.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("doc_id", F.coalesce("label", "cls").alias("label"))
    labels = labels.unionAll(found.select(F.col("node").alias("doc_id"), "label")).groupBy("doc_id").agg(F.min("label").alias("label"))
    out = light.join(labels, "doc_id", "left")
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id", keep: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """The documents but those that link to one with a smaller id; null ids stay. keep writes the ids that go."""
    gone = keep(found.where("component_id < doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", **options: object) -> DataFrame:
    """keep_one of link_documents. Of the tables written on the way only the ids that go are left."""
    with scratch(docs.sparkSession) as keep:
        return keep_one(docs, link_documents(docs, id_col=id_col, **options), id_col=id_col, keep=keep)
