"""Hard negatives and repair of conversations against plain versions."""

import functools
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives, turn_repair

VEC = "vec_id long, embedding array<float>, label int, cluster int, q string"


def plain_negatives(rows, every):
    have = {}
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not np.isfinite(x) or not np.isfinite(256 * float(np.float32(x))) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        have[i] = min(have.get(i, (str(label), q)), (str(label), q))
    out = []
    for a, (label, q) in have.items():
        if a % every:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, w, strict=True)), i) for i, (_, w) in have.items() if i != a and len(w) == len(q))
        for p, i in [x for x in scores if have[x[1]][0] == label][:5]:
            fit = [(s, j) for s, j in scores if have[j][0] != label and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, i, n + 1, j, -p, -s) for n, (s, j) in enumerate(fit)]
    return sorted(out)


def vectors(n=700, dim=12, seed=2):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(6, dim))
    rows = [(i, [float(x) for x in centre[i % 6] * r.uniform(0.2, 2) + r.normal(size=dim) * 0.3], int(r.integers(0, 4)), 7, "z") for i in range(n)]
    rows += [(n + i, rows[10][1], i % 3, 7, None) for i in range(60)]
    rows += [(1000, None, 1, 0, ""), (1005, [1.0] * dim, None, 0, ""), (1010, [None] + [1.0] * (dim - 1), 1, 0, ""), (1015, [float("nan")] * dim, 1, 0, ""), (1020, [float("inf")] * dim, 1, 0, ""), (None, [1.0] * dim, 1, 0, "")]
    rows += [(1025, [0.0] * dim, 1, 0, ""), (1030, [], 1, 0, ""), (1031, [], 2, 0, ""), (1035, [0.5, 0.5], 1, 0, ""), (1036, [0.5, 0.4], 1, 0, ""), (1037, [0.5, 0.3], 2, 0, ""), (50, rows[50][1], rows[50][2], 1, "again"), (51, rows[5][1], 0, 1, "other")]
    return rows


def test_negatives(spark):
    rows = vectors()
    df = hard_negatives.usable(spark.createDataFrame(rows, VEC).repartition(3))
    got = hard_negatives.mine(df, F.col("vec_id") % 5 == 0, clusters=3, slice_bits=5, chunk=40)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 5)
    none = hard_negatives.usable(spark.createDataFrame([], VEC))
    assert hard_negatives.mine(none, F.col("vec_id") % 5 == 0).count() == 0


def test_lists_stop_early(spark):
    """Tight clusters: most slices of a list are ruled out by the bound, and nothing is lost."""
    r = np.random.default_rng(1)
    centre = np.eye(8)
    rows = [(i, [float(x) for x in centre[i % 8] + r.normal(size=8) * 0.02], i // 8 % 2, 0, "") for i in range(2000)]
    lists = hard_negatives.SharedLists(hard_negatives.usable(spark.createDataFrame(rows, VEC)), F.col("vec_id") % 40 == 0, clusters=8, slice_bits=5)
    members = lists.anchors.withColumn("floors", F.array(F.lit(200 * 200).cast("long")))
    walked = members.join(lists.slices, "cluster").where("norm * top >= floors[0]").count()
    assert walked < 0.3 * members.join(lists.slices, "cluster").count()
    found = hard_negatives.mine(hard_negatives.usable(spark.createDataFrame(rows, VEC)), F.col("vec_id") % 40 == 0, clusters=8, slice_bits=5)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 40)


def test_large_products():
    a = np.array([[2.0**60, 3.0], [1.0, 2.0**40]])
    b = np.array([[2.0, 5.0], [2.0**60, 2.0**20]])
    assert hard_negatives.products(a, b).tolist() == [[2**61 + 15, 2**62], [2 + 5 * 2**40, 2**60 + 2**60]]


TURN = "conv_id long, turn long, role string, text string, c string, at string"


def plain_repair(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            cut = text.rstrip(" \t\n\x0b\f\r")
            faults.append("blank" if not cut.strip(" \t\n\x0b\f\r") else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[1] for r in own if r[0]]
        initial = [r[2][:1] for r in own]
        nxt = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}

        @functools.cache
        def rest(i, state, put=0):
            """The cheapest (cost, audit) from row i on."""
            turn = "a" if state == "U" else "u"
            found = [(0, "")] if i == len(own) and state in "0A" else []
            if put < 3:
                cost, audit = rest(i, nxt[state, turn], put + 1)
                found.append((cost + 3, "I" + audit))
            if i < len(own):
                more = 3 * (faults[i] == "truncated")
                cost, audit = rest(i + 1, state)
                found.append((cost + 4, "D" + audit))
                if faults[i] not in ("blank", "duplicate"):
                    if (state, initial[i]) in nxt:
                        cost, audit = rest(i + 1, nxt[state, initial[i]])
                        found.append((cost + more, "K" + audit))
                    cost, audit = rest(i + 1, nxt[state, turn])
                    found.append((cost + 3 + more, "R" + audit))
            return min(found, default=(10**6, ""))

        for i in range(len(own), -1, -1):
            for state in "0SUA":
                rest(i, state)  # from the end on, so that calls don't nest deeply
        cost, audit = rest(0, "0")
        lines, i, state = [], 0, "0"
        for x in audit:
            role = "assistant" if state == "U" else "user"
            if x == "I":
                lines.append(f"{role}:")
                state = nxt[state, role[0]]
                continue
            if x == "K":
                lines.append(f"{own[i][2]}:{own[i][3]}")
                state = nxt[state, initial[i]]
            if x == "R":
                lines.append(f"{role}:{own[i][3]}")
                state = nxt[state, role[0]]
            i += 1
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initial, initial[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talks(seed=3):
    r = random.Random(seed)
    said = ["yes.", "no", "what?", "", " \t", "it is so!", "very long " * 200 + ".", "Été", "a b .  "]
    role = lambda: r.choice(["user", "assistant"] * 4 + ["system", "tool", "unit", "", None, "User"])
    rows = []
    for conv in range(60):
        for turn in range(r.randint(1, 9)):
            rows.append((conv, r.choice([turn, turn, turn, turn + 2, None]), role(), r.choice(said + [None, f"own {r.random()}."]), "=1", "2"))
    rows += [(None, 1, "user", "whose?", "", ""), (None, 2, "assistant", "nobody's.", "", "")]
    # one conversation that many units hold
    rows += [(99, t, role() if t % 3 else ("user", "assistant")[t % 2], r.choice(said + [f"it is {t}."] * 6), "=1", "2") for t in range(400)]
    r.shuffle(rows)
    return rows


def report(rows):
    return {r.conv_id: tuple(r)[1:] for r in rows.collect()}


def test_repair(spark):
    rows = talks()
    df = spark.createDataFrame(rows, TURN)
    want = plain_repair(rows)
    for bits in (2, 5, None):
        done = turn_repair.Repair(df.repartition(5), bits=bits)
        found = {r.conv: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) for r in done.report().collect()}
        assert found == {k: v[:-1] for k, v in want.items()}
        shas = {r.c: r.repaired_sha256 for r in turn_repair.digests(done.repaired()).collect()}
        assert all(shas.get("" if k is None else f"={k}", hashlib.sha256(b"").hexdigest()) == v[-1] for k, v in want.items())
        assert bits is None or done.edits.groupBy("c").count().agg(F.max("count")).first()[0] > 400 / 2**bits - 1
    assert turn_repair.Repair(spark.createDataFrame([], TURN)).report().count() == 0


def test_conversations_without_rows(spark):
    rows = [(1, 0, "user", "a?", "", ""), (1, 1, "assistant", "b.", "", ""), (2, 5, "user", "c", "", "")]
    df = spark.createDataFrame(rows, TURN)
    got = report(turn_repair.audit(df, df.where("conv_id = 1")))
    assert got[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and got[1][-2:] == ("KK", hashlib.sha256(b"user:a?\nassistant:b.").hexdigest())
