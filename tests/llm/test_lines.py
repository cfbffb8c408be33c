"""Line dedup against a plain version, batch by batch, and the store's levels."""

import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import line_dedup

BLANK = " \t\n\x0b\f\r"
KIND = "doc_id long, text string, n_lines string, __d string"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def plain(rows):
    """(doc_id, text) -> kept text, lines, dropped; None comes last."""
    order = lambda i: (i is None, i or 0)
    holder = {}
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holder[key(line)] = min(holder.get(key(line), (True, 10**9)), order(i))
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or holder[key(x)] == order(i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def made(n=80):
    r = random.Random(4)
    pool = [f"{r.choice(['A common line', 'a longer line of words', 'Été on the road'])} {i}" for i in range(30)] + ["short", "", " \t ", "ninechars", "ten chars!", "TEN CHARS!", "　 ten chars! 　"]
    line = lambda: r.choice(["", " ", "\t"]) + r.choice(pool + [f"only here {r.random()}"] * 10) + r.choice(["", " ", "\r"])
    rows = [(i, "\n".join(line() for _ in range(r.randint(0, 12))), "x", "y") for i in range(n)]
    rows += [(5, rows[5][1], "x", "y"), (6, "a longer line of words 3\nanother one of six", None, "y"), (n, None, None, None), (n + 1, "", "x", None), (n + 2, "\n\n", "x", "y")]
    rows += [(None, "A common line 1\nnobody's own line", "x", "y"), (None, "nobody's own line\n" * 3, "x", "y")]
    rows += [(n + 3, "\n".join(["the very same line of it"] * 3000 + [f"own line number {i}" for i in range(3000)]), "x", "y"), (n + 4, "the very same line of it\nz", "x", "y")]
    return rows


def test_lines(spark):
    rows = made()
    df = spark.createDataFrame(rows, KIND).repartition(5)
    for batches, fanout in ((4, 2), (1, 4)):
        got = line_dedup.dedup_lines(df, batches=batches, fanout=fanout)
        assert got.columns == ["doc_id", "text", "__d", "n_lines", "n_dropped"]
        order = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
        assert sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect()), key=order) == sorted(plain(rows), key=order)
    digest = {r.doc_id: r.kept_sha256 for r in line_dedup.kept_digest(got.where("doc_id < 5")).collect()}
    assert digest == {i: hashlib.sha256(t.encode()).hexdigest() for i, t, *_ in plain(rows) if i is not None and i < 5}
    assert line_dedup.dedup_lines(spark.createDataFrame([], KIND)).count() == 0


def test_store_levels(spark):
    """Batches in any order: an earlier batch wins; runs climb levels and stay disjoint."""
    store = line_dedup.LineStore(spark, fanout=2, buckets=4)
    seen = set()
    for b in range(5):
        rows = [(10 - b, f"line of batch {b}\nline of all batches\nline of batch {b // 2} and its neighbour")]
        out = line_dedup.dedup_batch(store, spark.createDataFrame(rows, "doc_id long, text string")).first()
        kept = [x for x in rows[0][1].split("\n") if x not in seen]
        seen |= set(rows[0][1].split("\n"))
        assert out.text == "\n".join(kept) and out.n_dropped == 3 - len(kept)
    assert [len(level) for level in store.levels] == [1, 0, 1]
    held = [r.h for run in store.runs() for r in run.select("h").collect()]
    assert len(held) == len(set(held)) == len(seen)
    # a run is bucketed and sorted, so that the anti-join reads it without a shuffle
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {store.levels[2][0]}").collect()}
    assert described["Num Buckets"] == "4" and described["Sort Columns"] == "[`h`]"
    assert spark.table(store.levels[2][0]).agg(F.count("h")).first()[0] > 0
