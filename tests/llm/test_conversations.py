"""Conversation repair against a search through all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from provendar.llm import conversations as K
from provendar.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damaged(rows):
    """conv -> its rows (turn, role, text) after damage, in order."""
    by = {}
    for c, t, r, x in rows:
        here = by.setdefault(c, [])
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        here += [(t, "user" if fault == 4 else r, x)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    tie = lambda y: (y[0] is not None, y[0] or 0, hashlib.sha256(f"{len(y[1])}:{y[1]}{y[2]}".encode()).digest())
    return {c: sorted(d, key=tie) for c, d in by.items()}


def faults(rows):
    seen, out = set(), []
    for _, r, x in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", x)
        out.append("b" if not ink else "d" if (r, x) in seen else "t" if ink[-1] not in ".!?" else "")
        seen.add((r, x))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) among all edits of up to two rows inserted in a place."""
    kinds, best = faults(rows), (4 * len(rows), "D" * len(rows), [])

    def go(k, made, cost, audit, new):
        nonlocal best
        if cost > best[0]:
            return
        if k == len(rows) and (cost, audit) < best[:2] and re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in made)):
            best = cost, audit, made
        if k < len(rows):
            _, role, text = rows[k]
            if kinds[k] not in ("b", "d"):
                more = 3 * (kinds[k] == "t")
                go(k + 1, [*made, (role, text)], cost + more, audit + "K", 0)
                for r in ("user", "assistant"):
                    go(k + 1, [*made, (r, text)], cost + 3 + more, audit + "R", 0)
            go(k + 1, made, cost + 4, audit + "D", 0)
        if new < 2:
            for r in ("user", "assistant"):
                go(k, [*made, (r, "")], cost + 3, audit + "I", new + 1)

    go(0, [], 0, "", 0)
    return best


def slow(rows):
    out = []
    for c, d in damaged(rows).items():
        turns = [t for t, _, _ in d if t is not None]
        kinds = faults(d)
        cost, audit, made = cheapest(d)
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(d))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in made).encode()).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, True) for r in rows], "conv_id long, turn long, role string, text string, kind string, seg int, `_c` boolean").repartition(3)


def answer(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def odd_rows(seed, n):
    rnd = random.Random(seed)
    role = lambda t: rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]) if rnd.random() < 0.6 else ("user", "assistant")[t % 2]
    return [(c, None if rnd.random() < 0.05 else t * rnd.choice((1, 1, 1, 2)), role(t), rnd.choice(["a.", "b!", "c", "", " \n", "a.", None, "é? ", "dd.\x0b"])) for c in [None, *range(n)] for t in range(rnd.randint(1, 5))]


@pytest.mark.parametrize("parts", [1, 23])
def test_repair(spark, parts):
    rows = odd_rows(4, 120)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert answer(K.repair(K.damage(frame(spark, rows)))) == slow(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert K.repair(K.damage(frame(spark, rows).where("conv_id = -1"))).collect() == []


def test_a_long_conversation_is_repaired_by_many_tasks(spark):
    """A third of all rows in one conversation, with many copies: segments give the same as one range, and the rows that come out fit the form."""
    rnd = random.Random(8)
    long = [(7, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["a.", "b!", "c", "", f"d{t}.", f"e{t}.", f"f{t}"])) for t in range(600)]
    rows = frame(spark, long + odd_rows(5, 300))
    got, old = [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (17, 1):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(answer(K.repair(K.damage(rows))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]
    turns = sorted((r.position, r.role, r.text) for r in K.repaired_turns(K.damage(rows)).where("conv_id = 7").collect())
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in turns))
    mine = next(x for x in got[0] if x[0] == 7)
    assert hashlib.sha256("\n".join(f"{r}:{x}" for _, r, x in turns).encode()).hexdigest() == mine[8] and len(turns) == len(mine[7].replace("D", ""))


def test_segments_multiply_to_the_whole(spark):
    """The path over all rows against paths over their pieces from every role, joined as matrices."""
    rnd = random.Random(3)
    for _ in range(200):
        rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randint(1, 12))]
        whole = K.Path()
        for r in rows:
            whole.row(*r)
        cut = rnd.randint(0, len(rows))
        price, text = [0, K.FAR, K.FAR, K.FAR], ["", None, None, None]
        for part in (rows[:cut], rows[cut:]):
            paths = [K.Path(e) for e in range(4)]
            for p in paths:
                for r in part:
                    p.row(*r)
            new = []
            for f in range(4):
                ways = [(price[e] + paths[e].price[f] + paths[e].gone, text[e] + paths[e].audit(f)) for e in range(4) if price[e] < K.FAR and paths[e].price[f] < K.FAR // 2]
                new.append(min(ways, default=(K.FAR, None)))
            price, text = [w[0] for w in new], [w[1] for w in new]
        cost, end = whole.best()
        assert (cost, whole.audit(end) + "I" * K.CLOSING[end]) == min((price[f] + K.CLOSING[f] * K.INSERT, text[f] + "I" * K.CLOSING[f]) for f in range(4) if price[f] < K.FAR)


def test_registered_repair(spark):
    """All short conversations of the table against the search, all others by their form."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = answer(queries.op12_conversations(spark, SF))
    short = {c for c, d in damaged(rows).items() if len(d) <= 6}
    assert len(got) == len({r[0] for r in rows}) and len(short) > 10
    assert [g for g in got if g[0] in short] == slow([r for r in rows if r[0] in short])
    assert queries.op12_conversations(spark, SF).where(F.col("cost").isNull()).count() == 0
