"""Scalar expressions: coercion, dates, text, arrays, keys. All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Severity weights. Clusters and anomalies weigh severities differently.
CLUSTER_WEIGHTS = {"high": 3.0, "medium": 2.0, "low": 1.0}
ANOMALY_WEIGHTS = {"high": 4.0, "medium": 2.0, "low": 1.0}
#: Fixed value: the namespace of point ids.
POINT_NAMESPACE = "8d4e0e4e-9d4b-5e0e-9e7a-1a4e2b9c0c4a"


def coerce_int(x: Column, default: int | None = None) -> Column:
    """Whole part of a number given as text or number; default where it is none."""
    return F.coalesce(x.try_cast("double").try_cast("int"), F.lit(default).cast("int"))


def coerce_float(x: Column, default: float | None = None) -> Column:
    return F.coalesce(x.try_cast("double"), F.lit(default).cast("double"))


def coerce_bool(x: Column) -> Column:
    s = F.lower(strip(x.cast("string")))
    return F.when(s.isin("true", "1", "yes", "y"), True).when(s.isin("false", "0", "no", "n"), False)


def coerce_posted_at(x: Column) -> Column:
    """Epoch seconds, or milliseconds above 1e10, or ISO text whose offset is dropped, as a naive UTC time."""
    s = x.cast("string")
    n = s.try_cast("double")
    seconds = F.when(n > 1e10, n / 1000).otherwise(n)
    epoch = F.timestamp_micros((seconds * 1_000_000).cast("bigint")).cast("timestamp_ntz")
    iso = F.regexp_replace(F.regexp_replace(s, r"(?i)(?:z|[+-]\d{2}:?\d{2})$", ""), "T", " ")
    return F.coalesce(F.when(n.isNotNull(), epoch), F.try_to_timestamp(iso).cast("timestamp_ntz"))


def date_bucket(ts: Column, year: bool = False) -> Column:
    return F.coalesce(F.year(ts).cast("string") if year else F.to_date(ts).cast("string"), F.lit("unknown"))


def round_rating(x: Column, bounded: bool = False) -> Column:
    """Rounded half to even; null outside 1..5 if bounded."""
    r = F.rint(x.try_cast("double")).cast("int")
    return F.when(r.between(1, 5), r) if bounded else r


def strip(x: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def clean_text(x: Column) -> Column:
    return F.regexp_replace(strip(x), r"(?U)\s+", " ")


def title_and_body(title: Column, body: Column) -> Column:
    return F.concat_ws(". ", F.nullif(strip(title), F.lit("")), F.nullif(strip(body), F.lit("")))


def fallback_id(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def week_start(ts: Column) -> Column:
    """Monday of the ISO week."""
    return F.to_date(F.date_trunc("week", ts))


def severity_weight(severity: Column, weights: dict[str, float]) -> Column:
    s = F.lower(strip(severity))
    out = reduce(lambda acc, kv: acc.when(s == kv[0], kv[1]), weights.items(), F)
    return out.otherwise(1.0)


def tokens(x: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def content_tokens(x: Column, stop_words: Sequence[str]) -> Column:
    """Different words of three letters or more that aren't stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("[a-z0-9']+"), F.lit(0))
    return F.array_except(F.filter(found, lambda w: F.length(w) >= 3), F.array(*[F.lit(w) for w in stop_words]))


def snippet(x: Column, limit: int = 240) -> Column:
    flat = strip(F.regexp_replace(F.coalesce(x, F.lit("")), "\n", " "))
    return F.when(F.length(flat) > limit, F.concat(F.regexp_replace(F.substring(flat, 1, limit - 1), r"(?U)\s+$", ""), F.lit("…"))).otherwise(flat)


def ratio(a: Column, b: Column, digits: int = 4) -> Column:
    return F.coalesce(F.round(a / F.nullif(b, F.lit(0)), digits), F.lit(0.0))


def first_filled(quote: Column, text: Column) -> Column:
    return F.coalesce(F.nullif(strip(quote), F.lit("")), strip(text))


def first_quote(quotes: Column) -> Column:
    return F.try_element_at(F.filter(quotes, lambda q: strip(q) != ""), F.lit(1))


def embedding_text(text: Column, mentions: Column) -> Column:
    """`mentions` is an array of (code, sentiment, severity)."""
    one = lambda m: F.concat_ws(" ", m["code"], F.coalesce(m["sentiment"], F.lit("neutral")), m["severity"])
    listed = F.array_join(F.transform(mentions, one), "; ")
    return F.concat(F.lit("Review: "), F.coalesce(text, F.lit("")), F.lit("\nAspects: "), F.when(F.size(mentions) > 0, listed).otherwise("(none)"))


def uuid5(name: Column, namespace: str = POINT_NAMESPACE) -> Column:
    """RFC 4122 name-based id: the SHA-1 of namespace and name, with version and variant set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4) + 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def point_id(review_id: Column, version: Column, provider: Column, model: Column) -> Column:
    return uuid5(F.concat_ws("|", review_id.cast("string"), version, provider, model))


def dedup_key(source: Column, asin: Column, source_id: Column, posted_at: Column, text: Column) -> Column:
    filled = [F.coalesce(c.cast("string"), F.lit("None")) for c in (source, asin, source_id, posted_at)]
    return F.sha1(F.encode(F.concat_ws("|", *filled, F.sha1(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))), "UTF-8"))


def contains_any(text: Column, needles: Sequence[str]) -> Column:
    return reduce(lambda a, n: a | text.contains(n), needles, F.lit(False))


def first_contained(text: Column, needles: Sequence[str]) -> Column:
    """The first of the needles, in their order, that the text contains."""
    return F.coalesce(*[F.when(text.contains(n), F.lit(n)) for n in needles])


def like_any(text: Column, phrases: Sequence[str]) -> Column:
    """Case-insensitive LIKE %phrase%; % and _ in phrases are wildcards."""
    return reduce(lambda a, p: a | text.ilike(f"%{p}%"), phrases, F.lit(False))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def readable(text: Column) -> Column:
    """A text with what finding sentences in it takes: lower-cased; with ASCII letters alone lower-cased
    and with every end of a sentence as a point, both as long as the text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.struct(text.alias("text"), F.lower(text).alias("low"), F.translate(text, upper, upper.lower()).alias("plain"), F.translate(text, "!?\n", "...").alias("flat"))


def sentence_in(r: Column, needle: Column) -> Column:
    """The sentence of a readable text that holds a lower-cased needle first, with the character that ends
    it; '' without one, null without a needle. Found by position, in time linear in the text."""

    def cut(at: Column) -> Column:
        begin = at - F.length(F.substring_index(F.substring(r["flat"], F.lit(1), at - 1), ".", -1))
        end = F.call_function("locate", F.lit("."), r["flat"], at + F.length(needle))
        return F.when(at == 0, "").when(at > 0, strip(let(begin, lambda b: F.substring(r["text"], b, F.when(end > 0, end - b + 1).otherwise(F.length(r["text"]))))))

    return F.when(needle.isNotNull(), let(F.call_function("instr", r["plain"], needle), cut))


def sentence_with(text: Column, needle: Column) -> Column:
    """The sentence that holds the needle first; ASCII case doesn't count."""
    return let(readable(text), lambda r: sentence_in(r, F.lower(needle)))


def dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(x: Column) -> Column:
    """A vector at length 1, in doubles; null if it is null or zero or holds null or non-finite components."""
    sized = F.struct(x.alias("v"), F.sqrt(dot(x, x)).alias("n"))
    return let(sized, lambda r: F.when((r["n"] > 0) & (r["n"] < float("inf")), F.transform(r["v"], lambda c: c.cast("double") / r["n"])))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def hash_vector(text: Column, dim: int = 32) -> Column:
    """A deterministic unit vector: SHA-256 rounds cut into 32-bit words, mapped to [-1, 1] and normed."""
    rounds = -(-dim // 8)
    hexed = F.concat(*[F.sha2(F.concat(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), F.unhex(F.lit(f"{r:08x}"))), 256) for r in range(rounds)])
    words = lambda h: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.conv(F.substring(h, i * 8 + 1, F.lit(8)), 16, 10).cast("double") / 4294967295.0 * 2.0 - 1.0)
    # as elements of arrays the digest and the norm are computed once
    raw = F.transform(F.array(hexed), words)
    normed = F.transform(raw, lambda v: F.struct(v.alias("v"), F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)).alias("n")))
    return F.get(F.transform(normed, lambda r: F.transform(r["v"], lambda x: x / F.when(r["n"] == 0, 1.0).otherwise(r["n"]))), F.lit(0))


def json_object(text: Column) -> Column:
    """From the first { to the last } of noisy text; null without."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def details_brand(details: Column) -> Column:
    """The value of key `brand`, whatever its case, of a JSON object given as text."""
    pairs = F.map_entries(F.from_json(details, "map<string,string>"))
    return F.get(F.filter(pairs, lambda e: F.lower(e["key"]) == "brand"), F.lit(0))["value"]


def cited_ids(answer: Column) -> Column:
    """Different [n] markers, first seen first."""
    return F.array_distinct(F.transform(F.regexp_extract_all(answer, F.lit(r"\[(\d+)\]"), F.lit(1)), lambda x: x.cast("int")))


def strip_unsupported(answer: Column, valid: Column) -> Column:
    """Without markers that aren't among the valid ids; runs of blanks are collapsed."""
    bad = F.array_except(cited_ids(answer), valid)
    clean = F.aggregate(bad, answer, lambda acc, n: F.replace(acc, F.concat(F.lit("["), n.cast("string"), F.lit("]")), F.lit("")))
    return strip(F.regexp_replace(clean, r"[ \t]{2,}", " "))


def where_optional(**given: object) -> Column:
    """Conjunction of equalities for those that are given; name_min and name_max bound a range."""
    out = F.lit(True)
    for name, v in given.items():
        if v is None:
            continue
        if name.endswith("_min"):
            out = out & (F.col(name[:-4]) >= v)
        elif name.endswith("_max"):
            out = out & (F.col(name[:-4]) <= v)
        else:
            out = out & (F.col(name) == v)
    return out


def payload_filter(brand: str | None = None, aspect: str | None = None, sentiment: str | None = None, severity: str | None = None, rating_min: int | None = None, rating_max: int | None = None) -> Column:
    """Facets of a vector's payload; aspect, sentiment and severity match any element, each on its own."""
    out = where_optional(brand=brand, rating_min=rating_min, rating_max=rating_max)
    for col, v in (("aspect_codes", aspect), ("sentiments", sentiment), ("severities", severity)):
        if v is not None:
            out = out & F.array_contains(col, v)
    return F.coalesce(out, F.lit(False))
