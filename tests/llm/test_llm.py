"""Training-data operators against brute force on small inputs, and edge cases."""

import collections
import hashlib
import random
import re
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, embedding_dedup, html_extract, mixing, ngram_join, packing, pii, quality, sharding, substring_dedup, toxicity
from tidemark.llm.components import components

DOC = "doc_id long, text string, source string, size string"


def made(seed=1, n=60):
    """Documents with copies, near copies, shared passages, nulls, blanks and clashing columns."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdef") for _ in range(r.randint(2, 6)))
    texts = [" ".join(word() for _ in range(r.randint(1, 160))) for _ in range(n)]
    texts += [texts[3], texts[3], None, "", " \t", "one two", "one two"]
    passage = " ".join(word() for _ in range(70))
    texts += [f"{word()} {passage} {word()} {i}" for i in range(4)]
    base = [word() for _ in range(120)]
    for _ in range(12):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(120)] = word()
        texts.append(" ".join(copy))
    return [(i, t, None if i % 7 == 0 else f"s{i % 3}", "x") for i, t in enumerate(texts)]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


@pytest.fixture(scope="module")
def rows():
    return made()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def test_mixing(docs, rows):
    got = {r.doc_id: r for r in mixing.plan_mix(docs).collect()}
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for i, t, s, _ in rows:
        assert got[i].size == len(words(t)) and got[i].taken <= 3 * got[i].size
        by[s].append(got[i])
    total = sum(r.size for r in got.values())
    assert abs(sum(v[0].target for v in by.values()) - total) < 1e-6
    for v in by.values():
        assert abs(sum(r.taken for r in v) - v[0].target) <= 0.5 and v[0].target <= 3 * v[0].source_size + 1e-9
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and sum(len(words(r.text)) for r in mixed.collect()) == sum(r.taken for r in got.values())


def test_mixing_shuffles_texts_twice(spark, docs):
    """Once to meet their positions, once to stand in order, also where the plan is too large to be sent to all."""
    mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = mixing.mix(docs)._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
    assert len([x for x in moved if re.search(r"(whole|row|text)#", x)]) == 2


def test_mixing_of_rows_that_share_an_id(spark):
    rows = [(i, f"w{i}.{n} " * n, f"s{n % 2}") for i in (None, 1, 2) for n in range(1, 30)] + [(9, None, "s0"), (10, "alone " * 7, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = collections.Counter({(r.doc_id, r.size): r.taken for r in mixing.plan_mix(df).collect() if r.taken})
    got = collections.Counter()
    for r in mixing.mix(df).collect():
        size = next(n for i, t, _ in rows if i == r.doc_id and t and t.startswith(r.text.split()[0] + " ") for n in [len(t.split())])
        got[r.doc_id, size] += len(r.text.split())
    assert got == want


def test_substring_dedup(docs, rows):
    got = {r.doc_id: r for r in substring_dedup.kept_digest(substring_dedup.dedup_substrings(docs)).collect()}
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for j in range(len(w) - 49):
            first.setdefault(tuple(w[j : j + 50]), i)
    for i, t, *_ in rows:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - 49):
            if first[tuple(w[j : j + 50])] < i:
                gone[j : j + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        assert (got[i].n_words, got[i].n_removed, got[i].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("part", [1000, 20])
def test_ngram_join(docs, rows, part):
    sets = {}
    for i, t, *_ in rows:
        w = tuple(words((t or "").lower()))
        sets[i] = {w[j : j + 4] for j in range(len(w) - 3)} if len(w) >= 4 else ({w} if w else set())
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    found = ngram_join.link_documents(docs, part=part)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == {i: (len(s), root(i)) for i, s in sets.items()}
    assert ngram_join.keep_one(docs, found).count() == len({root(i) for i in sets})


@pytest.mark.parametrize("percent", [80, 85, 50])
def test_sets_that_link_meet_in_a_part(percent):
    """Sets just similar enough, of any sizes, share a token of a part whose bitmaps let them meet."""
    g = np.random.default_rng(percent)
    for n in [*range(1, 40), *range(40, 900, 17)]:
        small, large = n, int(g.integers(n, n * 100 // percent + 1))
        both = -(-(small + large) * percent // (100 + percent))
        s = np.unique(g.integers(0, 2**63, small + large - both).astype(np.uint64))
        cut = g.permutation(len(s))
        a, b = np.sort(s[cut[:small]]), np.sort(s[cut[len(s) - large :]])
        assert 100 * both >= percent * len(s) and len(np.intersect1d(a, b)) == both
        met = []
        for x, y in [(x, y) for x in ngram_join.parts_of(small, percent, 20) for y in ngram_join.parts_of(large, percent, 20) if x == y]:
            keys = [set(zip(*(v.tolist() for v in ngram_join.prefix_of(z, np.zeros(len(z), np.uint8), x, percent)), strict=True)) for z in (a, b)]
            maps = [ngram_join.bitmaps(z, x).view(np.uint64) for z in (a, b)]
            apart = [sum(int(v).bit_count() for v in m) for m in maps[0] ^ maps[1]]
            met += [k for k in keys[0] & keys[1] if apart[k[1] - x] * x * (100 + percent) <= (small + large) * (100 - percent)]
        assert met, (small, large)


def test_family_of_near_copies(spark, monkeypatch):
    """Pairs that are verified stay in proportion to a family's size; its components equal brute force."""
    r = random.Random(8)
    base, rows = [f"w{i}" for i in range(100)], []
    for i in range(2000):
        copy = list(base)
        for _ in range(r.randint(0, 4)):
            copy[r.randrange(100)] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    pairs, write = [], ngram_join.materialize

    def counted(df, name):
        out = write(df, name)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "materialize", counted)
    got = {x.doc_id: x.component_id for x in ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(t.split()[j : j + 4]) for j in range(97)} for _, t in rows]
    label = list(range(len(rows)))

    def root(v):
        while label[v] != v:
            v = label[v]
        return v

    for a in range(len(rows)):
        for b in range(a):
            if root(a) != root(b) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    assert got == {i: root(i) for i in range(len(rows))} and sum(pairs) <= 6 * len(rows)


def test_short_lists_are_met_once(spark, monkeypatch):
    """Documents that share passages with few others stand in the lists of one round only; links at the limit are found, whatever lists are met whole."""
    r, rows, rounds, write = random.Random(5), [], [], ngram_join.materialize
    for k in range(20):
        passage = [f"p{k}_{i}" for i in range(40)]
        rows += [(10 * k + j, " ".join(passage + [f"q{k}_{j}_{i}" for i in range(30)])) for j in range(4)]
        near = [f"n{k}_{i}" for i in range(60)]
        for j in range(4, 10):
            copy = list(near)
            for _ in range(r.randint(0, 3)):
                copy[r.randrange(60)] = f"x{r.randrange(10**6)}"
            rows.append((10 * k + j, " ".join(copy)))

    def counted(df, name):
        out = write(df, name)
        if name == "lists":
            rounds.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "materialize", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in ngram_join.link_documents(docs).collect()}
    assert rounds[0] > 0 and sum(rounds[1:]) == 0
    sets = {i: {tuple(t.split()[j : j + 4]) for j in range(len(t.split()) - 3)} for i, t in rows}
    label = {i: i for i in sets}
    for _ in range(10):  # smallest label along links, within the ten documents of a passage
        for a in sets:
            for b in range(a - a % 10, a - a % 10 + 10):
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert got == label and len(set(label.values())) < len(label)
    assert {x.doc_id: x.component_id for x in ngram_join.link_documents(docs, short=3).collect()} == label


def test_repeated_ids_and_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long), (2, long + " end"), (3, "a b c d e f"), (3, "p q r s t"), (4, "p q r s t"), (5, "a b c d e f"), (None, long)]
    got = sorted((x.doc_id, x.component_id) for x in ngram_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x.doc_id)
    assert got == [(1, 1), (2, 1), (3, 3), (3, 3), (4, 3), (5, 3)]
    out = {x.doc_id: x.n_removed for x in substring_dedup.dedup_substrings(spark.createDataFrame(rows[:2], "doc_id long, text string")).collect()}
    assert out == {1: 0, 2: 30_000}
    pii_rows = [(1, long + " mail a.b@c.example"), (2, None)]
    assert "a.b@c" not in pii.replace_pii(spark.createDataFrame(pii_rows, "doc_id long, text string"), "k").where("doc_id = 1").first().text
    assert {x.n_words for x in quality.statistics(spark.createDataFrame(rows[:2], "doc_id long, text string")).collect()} == {30_000, 30_001}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    ids = {i: [*Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids, 1] for i, t, *_ in rows}
    windows, cover = collections.defaultdict(list), collections.defaultdict(list)
    for r in packing.pack(docs, path, length=128).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        windows[r.sequence_id].append((r.offset, r.length))
        cover[r.doc_id].append((r.start, r.length))
    for parts, most in [*((v, 128) for v in windows.values()), *((cover[i], len(ids[i])) for i in ids)]:
        end = 0
        for a, n in sorted(parts):
            assert a == end
            end += n
        assert end <= most
    assert sum(sum(n for _, n in v) == 128 for v in windows.values()) >= len(windows) - 1


def test_dealer_with_very_many_sources():
    totals = [int(x) for x in np.random.default_rng(0).pareto(1.0, 700) * 300 + 1]
    dealer, windows = packing.Dealer(totals, 512), collections.defaultdict(list)
    for s, n in enumerate(totals):
        _, inner, size, window, offset = packing.cut_queue(dealer, s, np.array([0]), np.array([n]))
        assert size.sum() == n and inner[0] == 0
        for w, o, m in zip(window.tolist(), offset.tolist(), size.tolist(), strict=True):
            windows[w].append((o, m))
    for v in windows.values():
        end = 0
        for o, m in sorted(v):
            assert o == end
            end += m
    assert sum(sum(m for _, m in v) == 512 for v in windows.values()) >= len(windows) - 1


def test_products_over():
    g = np.random.default_rng(4)
    for m in (1, 7, 2**20 + 7, 10**13 + 37, 2**52 + 21, 2**59 + 55):
        x, y = g.integers(0, 2**42, 500), g.integers(0, m, 500)
        quotient, remainder = packing.product_over(x, y, m)
        # the quotient may be as large as x, never larger
        assert quotient.tolist() == [a * b // m for a, b in zip(x.tolist(), y.tolist(), strict=True)]
        assert remainder.tolist() == [a * b % m for a, b in zip(x.tolist(), y.tolist(), strict=True)]


def test_dealer_of_hundred_billion_tokens(monkeypatch):
    monkeypatch.setattr(packing, "CELLS", 600)
    totals = [10**11, 3 * 10**10 + 7, 9 * 10**6 + 1, 4 * 10**7]
    dealer, windows = packing.Dealer(totals, 2048), collections.defaultdict(list)
    whole = sum(totals)
    at = 10**7  # all tokens of a stretch of windows, from every source
    edges = [(at * 2048 * t // whole, (at + 500) * 2048 * t // whole) for t in totals]
    for s, (a, b) in enumerate(edges):
        _, _, size, window, offset = packing.cut_queue(dealer, s, np.array([a]), np.array([b - a]))
        assert size.sum() == b - a
        for w, o, m in zip(window.tolist(), offset.tolist(), size.tolist(), strict=True):
            windows[w].append((o, m))
    full = 0
    for w in range(at + 2, at + 498):
        end = 0
        for o, m in sorted(windows[w]):
            assert o == end
            end += m
        full += end == 2048
    assert full == 496


def test_rare_source_takes_little_memory():
    import tracemalloc

    totals = [10**6, 1950 * 10**6] + [10**6] * 98  # one token a window, about
    dealer = packing.Dealer(totals, 2048)
    tracemalloc.start()
    window, before, after, _ = dealer.table(0, 0, 10**6)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (after - before).sum() == 10**6 and len(window) >= 900_000 and peak < 200 << 20


def test_mixture_keeps_to_weights(spark):
    rows = [(i, " ".join(["of"] * 99), "a" if i % 4 else None, "x") for i in range(400)]
    df = spark.createDataFrame(rows, DOC)
    got = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), length=200, weights={"a": 1, None: 1}).collect()
    per = collections.defaultdict(lambda: collections.Counter())
    for r in got:
        per[r.sequence_id]["a" if r.doc_id % 4 else None] += r.length
    # half of each window from either, until the 100 documents without a source are used up: 100 windows
    order = sorted(per)
    assert order == list(range(len(order))) and all(per[w]["a"] == per[w][None] == 100 for w in order[:100])
    assert all(per[w] == {"a": 200} for w in order[100:]) and sum(sum(c.values()) for c in per.values()) == 40_000


def test_phases():
    r = random.Random(2)
    for _ in range(200):
        n = r.randint(1, 6)
        totals, weights, length = [r.randint(0, 900) for _ in range(n)], [r.choice([0, 1, 2, 5.5]) for _ in range(n)], r.choice([1, 7, 64])
        found = packing.phases(totals, weights, length)
        assert [sum(x) for x in zip(*found, strict=True)] == totals
        assert all(sum(p) % length == 0 and min(p) >= 0 for p in found[:-1])


def test_words_are_tokenized_as_whole_texts(rows):
    import pyarrow as pa

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [t for _, t, *_ in rows] + ["a\x01b \x01 c", "naïve café — don't 12,5 %\u00a0x", "<|endoftext|> x", "e\u0301 \u0301", " lead  and\tend\n", "漢字 かな", "w" * 3000, "many words " * 20_000]
    coder = packing.WordIds(path, 1)
    for _ in range(2):  # the second time words are remembered
        ids, counts = coder.ids(pa.array(texts, pa.string()))
        want = [[*e.ids, 1] for e in coder.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_embeddings(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(40, 8))
    near = np.concatenate([base, base[:20] + 0.05 * r.normal(size=(20, 8)), base[:5], base[:5]])
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(near)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 8, 0), (n + 2, [float("nan")] * 8, 0), (n + 3, rows[0][1], None), (n + 4, [], 1)]
    got = {x.vec_id: x for x in embedding_dedup.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), depth=8).collect()}
    unit = near / np.linalg.norm(near, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93) & (np.arange(n)[:, None] % 2 == np.arange(n)[None, :] % 2)
    np.fill_diagonal(links, False)
    true, found = links.sum(1), np.array([got[i].n_links for i in range(n)])
    assert (found <= true).all() and found.sum() >= 0.9 * true.sum()
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(n, n + 5))


def linked(spark, vectors):
    """n_links and component_id found, and by brute force."""
    got = embedding_dedup.link_vectors(spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int"), depth=8).collect()
    unit = [np.array(v) / np.linalg.norm(v) for v in vectors]
    near = [[j for j, b in enumerate(unit) if j != i and len(a) == len(b) and a @ b >= 0.93] for i, a in enumerate(unit)]
    label = list(range(len(unit)))
    for _ in label:
        label = [min([label[i], *(label[j] for j in near[i])]) for i in range(len(label))]
    return {r.vec_id: (r.n_links, r.component_id) for r in got}, {i: (len(near[i]), label[i]) for i in range(len(unit))}


@pytest.mark.parametrize("n", [2, 4, 7])
def test_fewer_vectors_than_depth(spark, n):
    r = np.random.default_rng(n)
    got, true = linked(spark, [np.ones(6) + 0.05 * r.normal(size=6) for _ in range(n - 1)] + [-np.ones(6)])
    assert got == true and (n == 2 or got[0][0] == n - 2)
    got, true = linked(spark, [np.ones(6) + 0.05 * r.normal(size=6) for _ in range(n)])
    assert got == true and got[0] == (n - 1, 0)


def test_rare_vector_lengths(spark):
    r = np.random.default_rng(9)
    common = list(r.normal(size=(400, 8)))
    rare = [np.ones(d) + 0.05 * r.normal(size=d) for d in (3, 5) for _ in range(6)]
    got, true = linked(spark, [*common, *rare])
    assert all(got[i] == true[i] and got[i][0] == 5 for i in range(400, 412))


def test_pii(spark):
    text = "Mail ann.b@mail.example.com or ANN.B@mail.example.com, +1 (987) 555-2485, 4111111111111111, 198.7.22.3. Frau Anna Smith, Mr. Smith."
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "clean 12 text"), (1, text)], "doc_id long, text string")
    out = sorted(pii.replace_pii(df, "k", count_col="n").collect(), key=lambda r: r.doc_id)
    new = out[0].text
    assert out[0] == out[1] and [r.n for r in out] == [7, 7, 0, 0, 0] and out[4].text == "clean 12 text" and out[2].text is None
    assert not [p for p in ("ann.b", "555-2485", "4111111111111111", "198.7.22.3", "Smith") if p in new]
    mails = re.findall(r"\S+@\S+\.com", new)
    assert len(mails) == 2 and mails[0] == mails[1]
    assert len({re.search(r"Frau \w+ (\w+),", new)[1], re.search(r"Mr\. (\w+)\.", new)[1]}) == 1
    assert len(re.sub(r"\w", "x", new)) == len(new) and re.search(r"Frau \w+a ", new) and re.search(r"\b4\d{15}\b", new)


def test_pii_secrets_names_and_phones(spark):
    secrets = ["AKIA" + "ABCDEFGHIJKLMNOP", "ghp_" + "abcdefghijKLMNOPQRSTuvwx", "sk_" + "a" * 90, "pk_" + "Zy" * 40, "abcdefAB" * 4, "a1" * 100, "DeadBeef" * 20]
    names = ["Mrs Mary Jane Watson", "Frau Meier-Lang", "Mr McDonald", "Mr O'Brien", "Herr Karl Otto Emil Lang", "Ms J. Watson"]
    texts = [f"the key {s} is here" for s in secrets] + [f"we met {n} today" for n in names]
    texts += ["call +1 555 123 4567 or +15551234567 or +1-555-123-4567 now", "call +49 30 1234 5678 or +493012345678 now", "call +351 21 123 4567 or +351211234567 now", "Mr Smith's car, Mr Smith, Mr Smith Mrs Jones"]
    got = [r.text for r in sorted(pii.replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").collect(), key=lambda r: r.doc_id)]
    for old, s, new in zip(texts, secrets, got, strict=False):
        # head, length and case of letters stay
        head = re.match(r"AKIA|ghp_|sk_|pk_|", s)[0]
        assert s not in new and len(new) == len(old) and f"the key {head}" in new and new.endswith(" is here")
        assert s != s.lower() or new == new.lower()
    for n, new in zip(names, got[len(secrets) :], strict=False):
        words_of = re.findall(r"\w\w+", n)
        assert new.startswith(f"we met {words_of[0]}") and new.endswith(" today")
        assert not [w for w in words_of[1:] if w in new] and len(new.split()) == len(n.split()) + 3 and ("-" in new) == ("-" in n)
    surname = re.findall(r"\w+", got[len(secrets)])[-2]
    assert surname in got[len(secrets) + len(names) - 1]
    for new, country in zip(got[-4:-1], ("1", "49", "351"), strict=True):
        numbers = {re.sub(r"\D", "", x) for x in re.split(" or ", new)}
        assert len(numbers) == 1 and numbers.pop().startswith(country)
    own = re.fullmatch(r"Mr (\w+)'s car, Mr (\w+), Mr (\w+) Mrs (\w+)", got[-1]).groups()
    assert own[0] == own[1] == own[2] != own[3] and not {"Smith", "Jones"} & set(own)


def test_surrogates_are_a_permutation(spark):
    # all addresses of one-digit parts: as many surrogates, none its own
    ips = spark.range(10_000).selectExpr("id", "concat_ws('.', id div 1000, (id div 100) % 10, (id div 10) % 10, id % 10) AS text")
    got = pii.replace_pii(ips, "k").collect()
    assert {r.text for r in got} == {r.text for r in ips.collect()}
    assert not [1 for r, o in zip(sorted(got), sorted(ips.collect()), strict=True) if r.text == o.text]
    names = [f"Mr {a}{b}a" for a in "BCDFG" for b in "aeiou"] + ["mail a@b.c", "mail b@b.c", "4111-1111-1111-1111", "4111 1111 1111 1112"]
    df = spark.createDataFrame(list(enumerate(names)), "doc_id long, text string")
    assert pii.collisions(df, "k").count() == 0 and pii.replace_pii(df, "k").select("text").distinct().count() == len(names)


@pytest.mark.parametrize("sizes", [[10, 10, 10], [26, 1, 10, 2], [1, 1, 5, 21, 6], [2], [156, 10], [1]])
def test_a_format_is_one_cycle(spark, sizes):
    n, values = int(np.prod(sizes)), []
    for k in range(n):
        values.append([])
        for m in sizes:
            k, v = divmod(k, m)
            values[-1].append(v)
    df = spark.createDataFrame([(v, sizes) for v in values], "v array<int>, m array<int>")
    to = {tuple(r.v): tuple(r.new) for r in df.select("v", pii.permuted(F.col("v"), F.col("m"), F.lit("k|x")).alias("new")).collect()}
    at, steps = to[tuple(values[0])], 1
    while at != tuple(values[0]):
        at, steps = to[at], steps + 1
    assert steps == n and set(to.values()) == set(to)


def test_only_the_first_digits_carry(spark):
    sizes = [1, *[10] * 200]
    df = spark.createDataFrame([([0] + [9] * 200, sizes), ([0] * 201, sizes), ([0] * 201, [1] * 201)], "v array<int>, m array<int>")
    got = [r.new for r in df.select(pii._added(F.col("v"), F.col("m"), F.lit(2), F.lit(1234)).alias("new")).collect()]
    assert got[0] == [0, 3, 3, 2, 1, *[0] * 60, *[9] * 136] and got[1] == [0, 4, 3, 2, 1, *[0] * 196] and got[2] == [0] * 201


def test_surrogates_of_surrogates(spark):
    r = random.Random(6)
    digits = lambda n: "".join(r.choices("0123456789", k=n))
    letters = lambda n: "".join(r.choices("bcdfghklmn", k=n))
    olds = [f"{letters(6)}@{letters(7)}.example" for _ in range(300)] + [f"{digits(3)}-{digits(2)}-{digits(4)}" for _ in range(300)]
    olds += [f"({digits(3)}) {digits(3)}-{digits(4)}" for _ in range(300)] + [f"4{digits(15)}" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(olds)), "doc_id long, text string")
    seen, now = [{o} for o in olds], df
    for _ in range(2):
        new = pii.replace_pii(now, "k")
        with pytest.raises(ValueError, match="surrogates already"):
            pii.replace_pii(new, "k")
        now = spark.createDataFrame([tuple(x) for x in new.collect()], "doc_id long, text string")  # without the mark
        for x in now.collect():
            assert x.text not in seen[x.doc_id], (olds[x.doc_id], x.text)
            seen[x.doc_id].add(x.text)


def test_one_person_one_surrogate(spark):
    text = "Frau Anna Smith wrote. Later Anna Smith came; Smith left, Anna stayed. Dr. Anna Smith (987) 555-2485 or +1 (987) 555-2485, version 1.2.3.4, 2001:db8::1, password=hunter2secret."
    new = pii.replace_pii(spark.createDataFrame([(1, text)], "hits long, text string").withColumn("pattern", F.lit("own")), "k")
    assert new.columns == ["hits", "text", "pattern"]
    row = new.first()
    assert (row.hits, row.pattern) == (1, "own")
    anna, smith = re.match(r"Frau (\w+) (\w+) wrote", row.text).groups()
    assert f"Later {anna} {smith} came; {smith} left, {anna} stayed. Dr. {anna} {smith} (" in row.text and anna.endswith("a")
    phones = re.findall(r"\((\d{3})\) (\d{3}-\d{4})", row.text)
    assert len(phones) == 2 and phones[0] == phones[1] and "version 1.2.3.4" in row.text
    assert not [x for x in ("Anna", "Smith", "555-2485", "2001:db8", "hunter2") if x in row.text]


def test_quality(spark, docs, rows):
    stats = {r.doc_id: r for r in quality.statistics(docs).collect()}
    for i, t, *_ in rows:
        w = words(t)
        seen = collections.Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
        hit = [False] * len(w)
        for j in range(len(w) - 2):
            if seen[tuple(w[j : j + 3])] > 1:
                hit[j : j + 3] = [True] * 3
        assert (stats[i].n_words, stats[i].word_chars, stats[i].n_repeat_words) == (len(w), sum(map(len, w)), sum(hit))
    # documents full of symbols are bad: the list finds that out
    texts = [(i, " ".join(f"w{j * 7 + i}{'###' if i % 3 == 0 else ''}" for j in range(80))) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(100)], "doc_id long, quality int")
    got = quality.judge(spark.createDataFrame(texts, "doc_id long, text string"), labels).collect()
    assert all(r.kept == (r.doc_id % 3 != 0) for r in got)


def test_toxicity(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 7)))
    common = [word() for _ in range(300)]
    rows = [(i, " ".join(r.choices(common, k=60) + (["vilexon", "grubbish"] if i % 4 == 0 else []))) for i in range(400)]
    df = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    chain = toxicity.train_chain(df, labels)
    got = {x.doc_id: x.is_toxic for x in toxicity.score(df, chain).collect()}
    assert sum(got[i] == (i % 4 == 0) for i in range(300, 400)) >= 97 and not got[900] and not got[901]
    assert toxicity.train_chain(df, labels.where("toxic = 0")) is None


def test_html(spark):
    page = "<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><div class='post-{n}'><h1>A &amp; B</h1><p>one\n two<p>three <b>four</b></div><div class=comments><p>nice</div><footer>f</footer></body></html>"
    rows = [(i, "http://h.example/x", page.replace("{n}", str(i))) for i in range(4)] + [(4, None, None), (5, "http://h.example/y", "<p>only this"), (6, "http://h.example/z", page[:150])]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i].text == "A & B\none two\nthree four" for i in range(4)) and got[0].path == "/html/body/div.post-#"
    assert got[4].text == "" and got[5].text == "only this" and got[6].text.startswith("A & B")


def test_html_names_and_attributes():
    text = lambda page: html_extract.Page(page).text(None)
    story = "<p>a long story of many words about a thing<p>and how it went on after that"
    plain = "a long story of many words about a thing\nand how it went on after that"
    for name in ("content has-sidebar", "no-header", "with-comments", "post-related"):
        for page in (f"<div class='{name}'>{story}</div>", f"<div id='{name}'>{story}</div>"):
            assert text(f"<body><nav>menu</nav>{page}<div class='site-footer'>foot</div><div class=comments>nice</div></body>") == plain
    # nothing but a marked container: names don't count, tags do
    assert text(f"<body><nav>menu</nav><div class='sidebar'>{story}</div></body>") == plain
    # a long discussion is none of the article
    assert text(f"<body><div class=post>{story}</div><div class=comments>{'<p>so it is indeed' * 30}</div></body>") == plain
    assert text(f"<body><svg viewBox='0 0 1 1' />{story}</body>") == text(f"<body><svg><text>x</text></svg>{story}</body>") == plain
    assert text(f"<body><div class=post data-class='ads' data-id='sidebar' title='a class=ads'>{story}</div></body>") == plain
    assert html_extract.Page(f"<body><div class=post data-class='x'>{story}</div></body>").best().path == "/body/div.post"


def test_html_names_that_may_be_topics():
    text = lambda page: html_extract.Page(page).text(None)
    story = "<p>" + "a long story of many words about a thing " * 8
    one = "how the engines find what they are asked for " * 5
    head = text(f"<body><div class=post><div class='post-header'><h1>Title of it</h1></div>{story}<div class='text-search-engines'><p>{one}</div></div></body>")
    assert head.startswith("Title of it\n") and head.endswith(one.strip())
    left = text(f"<body><div class=post>{story}<div class='box-search'><p>find it</div><div class='post-related'><p>{one}</div><div class='share-buttons'><a href=x>{one}</a></div></div></body>")
    assert "find it" not in left and one.strip() not in left
    assert text("<body><div class='text-search-engines'><p>engines</p></div></body>") == "engines"


def test_html_forms_and_headers_of_articles():
    text = lambda page: html_extract.Page(page).text(None)
    one = "how the engines find what they are asked for " * 5
    body = f"<h2>Title</h2><p>{one}</p><p>{one}</p>"
    plain = f"Title\n{one.strip()}\n{one.strip()}"
    # a form around the page, with forms' own things in it
    assert text(f"<body><form id=aspnetForm action=x><input type=hidden><nav>menu</nav><div class=post>{body}</div><select><option>a</select><button>go</button></form></body>") == plain
    assert text("<body><form><article><p>short story</article></form></body>") == "short story"
    # a form in the page, and a page that is one, are none of the article
    assert text(f"<body><div class=post>{body}</div><form><p>Your name<p>Your message<p>{one}</form></body>") == plain
    assert text("<body><form><label>User</label><div>Password</div></form></body>") == ""
    # the headings of an article's own header stay; those of the page's don't
    page = f"<body><header><h1>Site</h1></header><article><header><nav>a</nav><div><h1>The <i>title</i></h1></div><p>by x, 5 minutes</p></header><p>{one}</p></article></body>"
    assert text(page) == f"The title\n{one.strip()}"
    assert text(f"<body><nav><article><header><h1>A</h1></header></article></nav><p>{one}</p></body>") == one.strip()


def test_html_of_many_levels():
    import time

    story = "".join(f"<div class=l{chr(97 + i % 26)}><p>block {i}</p>" for i in range(1500)) + "</div>" * 1500
    start = time.process_time()
    got = html_extract.Page(f"<body>{story}</body>").text(None)
    assert got.split("\n") == [f"block {i}" for i in range(1500)] and time.process_time() - start < 1.5


def test_generated_pages(spark):
    """Articles of known text among menus, adverts and forms, in many layouts: each comes back whole."""
    r = random.Random(12)
    words_of = lambda n: " ".join("".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(n))
    rows, want = [], {}
    for i in range(120):
        blocks = [words_of(r.randint(4, 60)) for _ in range(r.randint(3, 12))]
        inner = "".join(f"<p>{b}</p>\n" if r.random() < 0.8 else f"<ul><li>{b}</li></ul>" for b in blocks)
        article = [f"<article>{inner}</article>", f"<div class='post-{i}'>{inner}</div>", f"<div id=content><div class=text>{inner}</div></div>"][i % 3]
        parts = ["<nav><a href=x>home</a></nav>", article, f"<div class='sidebar'><p>{words_of(9)}</p></div>", f"<form><p>{words_of(5)}</p></form>" if i % 2 else "", f"<div class='comments'><p>{words_of(30)}</p></div>", f"<footer>{words_of(6)}</footer>"]
        page = "".join(parts)
        rows.append((i, f"http://host{i % 3}.example/{i}", f"<html><body>{f'<form>{page}</form>' if i % 4 == 0 else page}</body></html>"))
        want[i] = "\n".join(blocks)
    got = {x.page_id: x.text for x in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_toxicity_learns_from_its_folds_only():
    feats = [np.array([i % 5, 7 + i % 3]) for i in range(60)]
    toxic = np.array([float(i % 5 == 0) for i in range(60)])
    assert toxicity.strong(feats, toxic).sum() == 0
    assert toxicity.strong([np.r_[f, 100 + f[0]] for f in feats], toxic).sum() == toxic.sum()
    # a probability, not its log-odds, goes on to the next model
    scorer = toxicity.Scorer({"places": [3], "weights": [2.0], "dense": [4.0, -1.0]})
    assert scorer.probability([3], [0.5]) == pytest.approx(1 / (1 + np.exp(-3.0)), abs=1e-6)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC)
    assert mixing.plan_mix(none).count() == 0 and substring_dedup.dedup_substrings(none).count() == 0
    assert ngram_join.link_documents(none).count() == 0 and pii.replace_pii(none, "k").count() == 0
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0 and quality.statistics(none).count() == 0
    assert embedding_dedup.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert toxicity.train_chain(none, spark.createDataFrame([], "doc_id long, toxic int")) is None and toxicity.score(none, None).count() == 0
    assert sharding.assign(none, limit=100).count() == 0 and html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_near_copies_leave_one_table(spark, docs, rows, tmp_path, monkeypatch):
    import corpus_pipeline

    found = ngram_join.link_documents(docs, size=corpus_pipeline.SHINGLE, percent=corpus_pipeline.PERCENT).collect()
    before = spark.conf.get(common.CLEANUP)
    monkeypatch.setattr(common, "shared_path", lambda _, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    kept = corpus_pipeline.without_near_copies(spark, docs, "")
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["gone"]
    ids = {r.doc_id for r in found if r.component_id is None or r.component_id == r.doc_id}
    assert len(ids) < len(rows) and sorted(r.doc_id for r in kept.collect()) == sorted(ids)
    assert spark.conf.get(common.CLEANUP) == before


CLASHING = ["shard", "shard_", "__row", "row", "whole", "__words", "nth", "cut", "position", "new_text", "is_toxic", "p_toxic"]


def test_clashing_columns(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rows = [(i, f"word{i} " * (i % 9 + 1), f"s{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in CLASHING:
        df = df.withColumn(c, F.lit(True) if c == "is_toxic" else F.lit(77))
    own = lambda r: all(r[c] == (c == "is_toxic" or 77) for c in CLASHING)
    sharding.shard_documents(df, str(tmp_path / "out"), limit=300)
    written = spark.read.parquet(str(tmp_path / "out"))
    assert set(written.columns) == {*df.columns, "shard__"}
    got = written.collect()
    assert sorted((r.doc_id, r.text, r.source) for r in got) == rows and all(map(own, got))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and all(map(own, mixed.collect()))
    # nothing is labelled toxic, so nothing is rejected, whatever the table's own column says
    monkeypatch.setattr(toxicity, "train_chain", lambda *_: None)
    kept = corpus_pipeline.without_toxic(spark, df, "/root/testdata/sf0.001")
    assert kept.columns == df.columns and sorted((r.doc_id, r.text, r.source) for r in kept.collect()) == rows


def test_sharding(spark, docs, rows):
    limit = 2000
    same = [(1000, "copy " * 60, None, "x")] * 40 + [(1001, "z" * 5000, None, "x"), (1002, None, None, "x")]
    df = docs.unionAll(spark.createDataFrame(same, DOC))
    got = sharding.assign(df, limit=limit).collect()
    assert len(got) == len(rows) + len(same)
    shards = collections.defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
        assert len(r.shard) == r.depth
    for bits, v in shards.items():
        total = sum(r.n_bytes for r in v)
        assert total == v[0].shard_bytes and (total <= limit or (len(v) == 1 and v[0].oversized))
        # only oversized buckets are split: the parent of each shard exceeds the limit
        if bits:
            assert sum(r.n_bytes for k, w in shards.items() if k.startswith(bits[:-1]) for r in w) > limit
        assert not any(k != bits and k.startswith(bits) for k in shards)
    assert sum(r.oversized for r in got) == 1


def test_written_shards_fit(spark, tmp_path):
    limit = 2000
    rows = [(7, f"one id {i} " * 10, "x") for i in range(60)] + [(8, "copy " * 60, "y")] * 40 + [(None, f"none {i} " * 12, None) for i in range(60)] + [(i, f"own {i}", "z") for i in range(100, 160)] + [(9, "z" * 5000, "x")]
    sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"), str(tmp_path / "out"), limit=limit)
    # the bits of a shard are a string
    got = spark.read.option("basePath", str(tmp_path / "out")).schema("doc_id long, text string, source string, shard string").parquet(str(tmp_path / "out")).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(key(r[:3]) for r in got) == sorted(map(key, rows))
    shards = collections.defaultdict(list)
    for r in got:
        shards[r.shard].append(len(r.text))
    assert all(sum(v) <= limit or len(v) == 1 for v in shards.values())
