"""PII surrogates, with DataFrame functions only.

Entities are found by patterns: mail addresses, secrets (access keys, hex tokens, values after
password= and the like), IBANs, IPv4 and IPv6 addresses, social security numbers, payment cards, phone
numbers, and names after a title or a salutation; words of such a name are found in all of its text.

Each is replaced by a surrogate of the same type and format. The surrogate is a keyed permutation of all
entities of that format: a Feistel network over the characters, each of which stays within its class
(digit, case, script; in names vowel or consonant). Network and country prefixes, top-level domains,
separators and titles stay; cards and IBANs whose check digits hold get check digits that hold; a
name's word that ends in a vowel keeps it, as that tells the gender.

Different entities therefore have different surrogates by construction, however many the corpus holds,
without a pass over it. The permutation is one cycle through all entities of a format (of one longer than
DIGITS, cycles as long as those of its first characters), so no entity is its own surrogate, and replacing
surrogates again leads back to an original only after as many rounds. A short format, as a mail name of one letter, has
a short cycle; a text column that holds surrogates is therefore marked in its metadata, which tables
keep, and replace_pii refuses a marked one. `collisions` checks it on a table. The same entity gets the same surrogate everywhere, whatever its spelling: a
phone number with and without its country code, a card with and without spaces, a name with another
title or without, each word of a name by itself (coreference). A surrogate may equal some other
entity's original. Characters outside the scripts in POOLS stay.

A null text stays null, an empty one empty; repeated rows get the same text. Texts are handled whole.
All other columns are kept; n_chars, where there is one, is counted anew for changed texts.
"""

from __future__ import annotations

from collections.abc import Callable
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_name

_L = r"\p{L}\p{N}"
_TITLE = "Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra?|Господин|Госпожа|Κύριος|Κυρία"
#: Salutations; what follows is a name unless it is one of the words after them.
_DEAR = r"(?:Dear|Liebe|Lieber|Cher|Chère|Querid[oa]|Estimad[oa]) (?!(?:Sirs?|Madam|Mada?me|Monsieur|All|Team|Customers?|Friends?|Kunden?|Kundin|Client|Cliente|Freunde?)(?![\p{L}]))"
#: A word of a name (Meier-Lang, O'Brien and McDonald are one each), or an initial before another word.
_WORD = r"(?:\p{Lu}(?:(?:-|['’])(?=\p{Lu})|[\p{L}\p{M}])++(?<=[\p{L}\p{M}])|\p{Lu}\.?(?= \p{Lu}))"
_HEX = "[0-9A-Fa-f]{1,4}"
#: The patterns of the entity types, tried in this order.
PATTERNS = {
    "email": rf"(?<![{_L}._%+-])[{_L}_%+-]++(?:\.[{_L}_%+-]++)*+@[{_L}-]++(?:\.[{_L}-]++)+",
    "login": rf"(?<![{_L}])(?i:password|passwd|pwd|api[_-]?key|secret|access[_-]?token)(?:=|: ?)[\"']?[^\s\"',;&]{{6,}}+",
    "secret": rf"(?<![{_L}])(?:AKIA[0-9A-Z]{{16}}|[0-9A-Fa-f]{{32,}}+|(?:ghp|sk|pk)_[A-Za-z0-9]{{20,}}+)(?![{_L}])",
    "iban": rf"(?<![{_L}])[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{3,7}}(?: [A-Z0-9]{{1,3}})?)(?![{_L}])",
    "ip": r"(?<![\d.])(?<![vV])(?<![vV]ersion )(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\d|\.\d)",
    "ip6": rf"(?<![{_L}:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![{_L}:])",
    "ssn": rf"(?<![{_L}-])\d{{3}}-\d{{2}}-\d{{4}}(?![\d-])",
    "card": rf"(?<![{_L}])(?:\d{{4}}[ -]\d{{4}}[ -]\d{{4}}[ -]\d{{1,7}}|\d{{4}}[ -]\d{{6}}[ -]\d{{5}}|\d{{13,19}})(?![{_L}])",
    "phone": rf"(?<![{_L}+])(?:\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{2,4}}(?:[ .-]\d{{2,4}}){{1,4}}|\+\d{{8,15}}|\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}})(?![{_L}])",
    "name": rf"(?<![{_L}])(?:(?:{_TITLE})\.? |{_DEAR}(?!(?:{_TITLE})(?![{_L}])))(?:(?:{_TITLE})\.? )*{_WORD}(?: (?!(?:{_TITLE})(?![{_L}])){_WORD})*(?![{_L}])",
}
#: Country codes of phone numbers; those not listed by their first digits have three.
COUNTRY = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_TITLED = r"(?:M(?:r|s|iss|me|onsieur|adame)|Dr|Prof|Herr|Frau|Señor|Sr|Госп|Κύρ|Κυρ|Dear|Liebe|Ch[eè]r|Querid|Estimad)"
#: Holds in every text that ANY is found in: all but names and secrets need an @ or a digit.
MAYBE = rf"[@0-9]|AKIA|(?:ghp|sk|pk)_|[A-Fa-f]{{32}}|(?i:password|passwd|pwd|key|secret|token)[=:]|{_TITLED}"
_LEAD = rf"^(?:(?:(?:{_TITLE})\.? |(?:Dear|Liebe|Lieber|Cher|Chère|Querid[oa]|Estimad[oa]) )+)?"
#: The classes of characters, each closed under replacement; in names vowels first.
HEX = ["0123456789", "abcdef", "ABCDEF"]
VOWELS = ["aeiou", "àáâãäåèéêëìíîïòóôõöøùúûü", "аеёиоуыэюя", "αεηιουωάέήίόύώ"]
SCRIPTS = ["abcdefghijklmnopqrstuvwxyz", "àáâãäåæçèéêëìíîïñòóôõöøùúûüýþ", "абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρσςτυφχψωάέήίόύώ", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "אבגדהוזחטיכלמנסעפצקרשת", "अआइईउऊएऐओऔकखगघचछजझटठडढणतथदधनपफबभमयरलवशषसह"]
POOLS = ["0123456789", *SCRIPTS, *[p.upper() for p in SCRIPTS[:4]]]
CONSONANTS = ["".join(c for c in p if c not in v) for p, v in zip(SCRIPTS, VOWELS, strict=False)]
NAME_POOLS = [*VOWELS, *[v.upper() for v in VOWELS], *CONSONANTS, *[c.upper() for c in CONSONANTS], *SCRIPTS[4:]]
_ENDINGS = "".join([*VOWELS, *[v.upper() for v in VOWELS]])
ROUNDS = 4
#: Sizes of all pools, of an octet's parts and of a first dialled digit; the product of their primes; how
#: many characters are added to as one number (their carries are walked, so they are bounded).
SIZES = {*map(len, (*HEX, *POOLS, *NAME_POOLS)), 156, 90, 10, 2, 8}
PRIMES = prod(p for p in range(2, max(SIZES) + 1) if all(p % q for q in range(2, p)) and any(n % p == 0 for n in SIZES))
DIGITS = 64
#: Key of the metadata of a text column with surrogates.
MARK = "surrogates"


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def kind_of(hit: Column) -> Column:
    """The type of a match; null for digits that are no card number: 15 or 16 of them are taken for one
    with a slip, other lengths have to pass the Luhn check."""
    digits = F.regexp_replace(hit, r"[ -]", "")
    card = _luhn(digits) | F.length(digits).isin(15, 16)
    out = F.when(hit.rlike(rf"^(?:{PATTERNS['login']})$"), "login").when(hit.contains("@"), "email")
    for k in ("secret", "iban", "ip", "ip6", "ssn"):
        out = out.when(hit.rlike(rf"^(?:{PATTERNS[k]})$"), k)
    return out.when(hit.rlike(rf"^(?:{PATTERNS['card']})$"), F.when(card, "card")).when(hit.rlike(r"^[+(\d]"), "phone").otherwise("name")


def canonical(hit: Column, kind: Column) -> Column:
    """Spellings of one entity have one canonical form. A name's is that of its words, without title; a
    phone number's its country code, if it has one, and a blank before the rest."""
    digits = F.regexp_replace(hit, r"\D", "")
    plus = F.concat(F.lit("+"), digits)
    country = F.regexp_extract(plus, COUNTRY, 1)
    phone = F.when(hit.startswith("+"), F.concat(country, F.lit(" "), F.substring(digits, F.length(country) + 1, F.length(digits)))).otherwise(F.concat(F.lit(" "), digits))
    out = F.when(kind.isin("email", "ip6"), F.lower(hit)).when(kind.isin("ssn", "card"), digits).when(kind == "phone", phone)
    return out.when(kind == "iban", F.regexp_replace(hit, " ", "")).when(kind == "name", F.regexp_replace(hit, _LEAD, "")).otherwise(hit)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _number(digest: Column, i: Column) -> Column:
    """The i-th 16-bit number of a hex digest, going round."""
    return F.conv(F.substring(digest, (F.pmod(i, F.lit(32)) * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def _added(values: Column, sizes: Column, first: Column, number: Column) -> Column:
    """`number` added to `values`, digits of the given sizes with the lowest first, with carry: to DIGITS
    of them from the `first` (from 1), which are a number of their own."""
    digits = F.zip_with(F.slice(values, first, F.lit(DIGITS)), F.slice(sizes, first, F.lit(DIGITS)), lambda v, m: F.struct(v.alias("v"), m.alias("m")))
    start = F.struct(F.array().cast("array<int>").alias("o"), number.cast("long").alias("c"))

    def add(a: Column, x: Column) -> Column:
        return _let(x["v"] + a["c"], lambda t: F.struct(F.concat(a["o"], F.array(F.pmod(t, x["m"]).cast("int"))).alias("o"), F.call_function("div", t, x["m"].cast("long")).alias("c")))

    end = first + DIGITS
    return F.concat(F.slice(values, F.lit(1), first - 1), F.aggregate(digits, start, add, lambda a: a["o"]), F.slice(values, end, F.greatest(F.size(values) - end + 1, F.lit(0))))


def permuted(values: Column, sizes: Column, tag: Column) -> Column:
    """The place of `values` in a keyed permutation of all arrays in which the i-th number is below the
    i-th size: with F a Feistel network whose halves are the even and the odd places, and S an addition
    to the number whose digits the values are, lowest first: F, then S, then the inverse of F. What S adds
    is keyed and shares no prime with the sizes, so S is one cycle, and so is the whole."""
    ops = []
    for r in range(ROUNDS):
        ops += [(0, r, 0), (1, r, 1)]
    ops += [(0, 9, 0), (2, 9, 0)]
    for r in reversed(range(ROUNDS)):
        ops += [(0, r, 0), (1, r, -1)]
    steps = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r).alias("r"), F.lit(sign).alias("sign")) for k, r, sign in ops])
    start = F.struct(values.alias("v"), sizes.alias("m"), F.lit("").alias("d"))

    def step(a: Column, op: Column) -> Column:
        # what a round is keyed with: the half that it leaves alone, and for the shift the sizes only
        rest = F.when(op["r"] == 9, F.array_join(a["m"], ",")).otherwise(F.array_join(F.transform(a["v"], lambda x, i: F.when(F.pmod(i, F.lit(2)) == F.pmod(op["r"], F.lit(2)), F.lit("")).otherwise(x.cast("string"))), ","))
        digest = F.sha2(F.concat_ws("|", tag, op["r"].cast("string"), rest), 512)
        moved = F.transform(a["v"], lambda x, i: F.when(F.pmod(i, F.lit(2)) == F.pmod(op["r"], F.lit(2)), F.pmod(x + op["sign"] * _number(a["d"], i), F.get(a["m"], i))).otherwise(x))
        first = F.greatest(F.array_position(F.transform(a["m"], lambda m: m > 1), F.lit(True)).cast("int"), F.lit(1))
        shifted = _added(a["v"], a["m"], first, 1 + F.lit(PRIMES).cast("long") * _number(a["d"], F.lit(0)))
        values = F.when(op["k"] == 0, a["v"]).when(op["k"] == 1, moved).otherwise(shifted)
        return F.struct(values.alias("v"), a["m"].alias("m"), F.when(op["k"] == 0, digest).otherwise(F.lit("")).alias("d"))

    return F.aggregate(steps, start, step, lambda a: a["v"])


#: Sets of classes that a piece of an entity may have.
PLAIN, HEXED, NAMED, DIALLED = range(4)


def _mapped(piece: Column) -> Column:
    """A piece (s string, k set of classes, t tag) with each character replaced by one of its class.
    Of numbers that are dialled the first digit stays a trunk digit or none; of names the last vowel."""
    sets = {PLAIN: POOLS, HEXED: HEX, NAMED: NAME_POOLS, DIALLED: ["0123456789"]}

    def pools(k: Column, i: Column) -> Column:
        out = F.when((k == DIALLED) & (i == 0), F.array(F.lit("01"), F.lit("23456789")))
        for n, of in sets.items():
            out = out.when(k == n, F.array(*map(F.lit, of)))
        return out

    def cell(c: Column, i: Column, n: Column) -> Column:
        own = F.get(F.filter(pools(piece["k"], i), lambda pool: pool.contains(c)), F.lit(0))
        kept = (piece["k"] == NAMED) & (i == n - 1) & (i > 0) & F.lit(_ENDINGS).contains(c)
        return F.struct(F.when(~kept, own).alias("p"), c.alias("c"))

    def whole(cells: Column) -> Column:
        at = F.transform(cells, lambda x: F.coalesce(F.call_function("instr", x["p"], x["c"]) - 1, F.lit(0)))
        values = permuted(at, F.transform(cells, lambda x: F.coalesce(F.length(x["p"]), F.lit(1))), piece["t"])
        return F.array_join(F.zip_with(cells, values, lambda x, v: F.coalesce(F.substring(x["p"], v + 1, F.lit(1)), x["c"])), "")

    return _let(_let(_chars(piece["s"]), lambda cs: F.transform(cs, lambda c, i: cell(c, i, F.size(cs)))), whole)


def _octets(value: Column, tag: Column) -> Column:
    """An IPv4 address to one whose parts have as many digits."""
    base = lambda o: F.when(F.length(o) == 3, 100).when(F.length(o) == 2, 10).otherwise(0)
    size = lambda o: F.when(F.length(o) == 3, 156).when(F.length(o) == 2, 90).otherwise(10)

    def whole(parts: Column) -> Column:
        new = permuted(F.transform(parts, lambda o: o.cast("int") - base(o)), F.transform(parts, size), tag)
        return F.array_join(F.zip_with(parts, new, lambda o, v: (base(o) + v).cast("string")), ".")

    return _let(F.split(value, r"\."), whole)


def _fill(hit: Column, symbols: Column, which: str) -> Column:
    """The hit with its characters of class `which` replaced by `symbols`, in order."""
    start = F.struct(F.lit("").alias("o"), F.lit(1).alias("k"))
    step = lambda a, c: F.when(c.rlike(which), F.struct(F.concat(a["o"], F.substring(symbols, a["k"], F.lit(1))).alias("o"), (a["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(a["o"], c).alias("o"), a["k"].alias("k")))
    return F.aggregate(_chars(hit), start, step, lambda a: a["o"])


def _luhn_digit(body: Column) -> Column:
    """The digit that makes body + digit pass the Luhn check."""
    total = F.aggregate(F.transform(F.reverse(_chars(body)), lambda c, i: F.when(i % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")).otherwise(c.cast("int"))), F.lit(0), lambda a, x: a + x)
    return F.pmod(-total, F.lit(10))


def _card(canon: Column, front: Column) -> Column:
    """With new digits but for the last, which is as far from the right check digit as it was."""
    old = F.substring(canon, F.lit(1), F.length(canon) - 1)
    return F.concat(front, F.pmod(_luhn_digit(front) + F.substring(canon, -1, 1).cast("int") - _luhn_digit(old), F.lit(10)).cast("string"))


def _iban_check(country: Column, body: Column) -> Column:
    n = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return 98 - F.aggregate(_chars(F.concat(body, country, F.lit("00"))), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + n(c)) % 97).otherwise((a * 100 + n(c)) % 97))


def _iban(canon: Column, body: Column) -> Column:
    """With a new body; the check digits are as far from the right ones as they were."""
    country, check, old = F.substring(canon, 1, 2), F.substring(canon, 3, 2).cast("int"), F.substring(canon, F.lit(5), F.length(canon))
    return F.concat(country, F.lpad(F.pmod(_iban_check(country, body) + check - _iban_check(country, old), F.lit(100)).cast("string"), 2, "0"), body)


def _pieces(kind: Column, canon: Column, key: str) -> Column:
    """The pieces of a canonical form that are replaced, each by itself."""
    piece = lambda s, k, t: F.struct(s.alias("s"), F.lit(k).alias("k"), F.lit(f"{key}|{t}").alias("t"))
    rest = lambda at: F.substring(canon, at if isinstance(at, Column) else F.lit(at), F.length(canon))
    domain = F.substring_index(canon, "@", -1)
    out = F.when(kind == "email", F.array(piece(F.substring_index(canon, "@", 1), PLAIN, "mail"), piece(F.regexp_extract(domain, r"^(.*)\.", 1), PLAIN, "site")))
    out = out.when(kind == "secret", F.array(F.when(_head(canon) == "", piece(canon, HEXED, "hex")).otherwise(piece(rest(F.length(_head(canon)) + 1), PLAIN, "token"))))
    out = out.when(kind == "login", F.array(piece(rest(F.length(_said(canon)) + 1), PLAIN, "login"))).when(kind == "ip6", F.array(piece(canon, HEXED, "ip6")))
    out = out.when(kind == "ssn", F.array(piece(canon, PLAIN, "ssn"))).when(kind == "card", F.array(piece(F.substring(canon, F.lit(2), F.length(canon) - 2), PLAIN, "card")))
    out = out.when(kind == "phone", F.array(piece(F.substring_index(canon, " ", -1), DIALLED, "phone"))).when(kind == "iban", F.array(piece(rest(5), PLAIN, "iban")))
    return out.when(kind == "name", F.transform(F.regexp_extract_all(canon, F.lit(r"[\p{L}\p{M}]+"), F.lit(0)), lambda w: piece(w, NAMED, "name")))


def _head(canon: Column) -> Column:
    return F.regexp_extract(canon, r"^(AKIA|ghp_|sk_|pk_)?", 1)


def _said(canon: Column) -> Column:
    return F.regexp_extract(canon, r"^([^=:]+(?:=|: ?)[\"']?)", 1)


def surrogate(hit: Column, kind: Column, canon: Column, key: str) -> Column:
    """The surrogate of a hit, from its type and canonical form, in the hit's spelling."""

    def spelled(new: Column) -> Column:
        one = F.get(new, F.lit(0))
        email = F.concat(one, F.lit("@"), F.get(new, F.lit(1)), F.lit("."), F.regexp_extract(canon, r"([^.]*)$", 1))
        name = F.concat(F.regexp_extract(hit, f"({_LEAD})", 1), F.array_join(F.zip_with(F.split(canon, r"[\p{L}\p{M}]+", -1), new, lambda s, w: F.concat(s, F.coalesce(w, F.lit("")))), ""))
        symbols = F.when(kind == "ssn", one).when(kind == "card", _card(canon, F.concat(F.substring(canon, 1, 1), one))).when(kind == "phone", F.concat(F.substring_index(canon, " ", 1), one)).when(kind == "iban", _iban(canon, one))
        out = F.when(kind == "email", email).when(kind == "login", F.concat(_said(canon), one)).when(kind == "secret", F.concat(_head(canon), one)).when(kind == "ip", _octets(canon, F.lit(f"{key}|ip")))
        out = out.when(kind == "ip6", F.when(hit.rlike("[A-F]"), F.upper(one)).otherwise(one)).when(kind == "name", name)
        return out.when(kind.isin("ssn", "card", "phone"), _fill(hit, symbols, "[0-9]")).when(kind == "iban", _fill(hit, symbols, "[A-Z0-9]")).otherwise(hit)

    return _let(F.transform(_pieces(kind, canon, key), _mapped), spelled)


def pattern_for(text: Column) -> Column:
    """ANY, and for a text with names after titles the words of these names wherever they stand."""
    names = F.regexp_extract_all(text, F.lit(PATTERNS["name"]), F.lit(0))
    words = F.flatten(F.transform(names, lambda n: F.filter(F.split(F.regexp_replace(n, _LEAD, ""), r"[ .]+"), lambda w: F.length(w) >= 3)))
    one = _let(F.array_join(F.array_sort(F.array_distinct(words)), "|"), lambda w: F.when(w != "", F.concat(F.lit(rf"{ANY}|(?<![{_L}])(?:"), w, F.lit(")(?: (?:"), w, F.lit(rf"))*(?![{_L}])"))))
    return F.coalesce(F.when(text.rlike(_TITLED), one), F.lit(ANY))


def _hits(text: Column, pattern: Column) -> Column:
    """All matches with their type and canonical form."""
    found = F.when(text.rlike(MAYBE), F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = F.transform(found, lambda h: F.struct(h.alias("hit"), kind_of(h).alias("kind")))
    return F.transform(found, lambda x: F.struct(x["hit"].alias("hit"), x["kind"].alias("kind"), canonical(x["hit"], x["kind"]).alias("canon")))


def collisions(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """Surrogates that stand for several entities of the table, or for themselves: kind, new, n, same."""
    text = F.col(text_col)
    found = docs.select(F.explode(_hits(text, pattern_for(text))).alias("x")).select("x.*").where("kind IS NOT NULL").groupBy("kind", "canon").agg(F.min("hit").alias("hit"))
    new = canonical(surrogate(F.col("hit"), F.col("kind"), F.col("canon"), key), F.col("kind"))
    made = found.select("kind", "canon", new.alias("new"))
    return made.groupBy("kind", "new").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("new") == F.col("canon")).alias("same")).where("n > 1 OR same")


def replace_pii(docs: DataFrame, key: str, *, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """The table with surrogates in its texts, and in count_col, if given, how many there are. A text
    column that is marked as one with surrogates is a ValueError."""
    if docs.schema[text_col].metadata.get(MARK):
        raise ValueError(f"{text_col} holds surrogates already")
    text, pattern, hits = F.col(text_col), own_name(docs, "pattern"), own_name(docs, "hits")
    keyed = docs.withColumn(pattern, pattern_for(text)).withColumn(hits, _hits(text, F.col(pattern)))
    new = F.transform(hits, lambda x: surrogate(x["hit"], x["kind"], x["canon"], key))
    joined = F.array_join(F.zip_with(F.split(text, F.col(pattern), -1), new, lambda p, s: F.concat(p, F.coalesce(s, F.lit("")))), "")
    columns = [F.when(F.size(hits) > 0, joined).otherwise(text).alias(c, metadata={**docs.schema[c].metadata, MARK: True}) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if count_col:
        columns.append(F.size(F.filter(hits, lambda x: x["kind"].isNotNull())).alias(count_col))
    out = keyed.select(*columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.length(text_col).isNotNull() & (F.col("n_chars").isNotNull()), F.length(text_col).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out
