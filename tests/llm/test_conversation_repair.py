"""The parse against all edit sequences of short conversations, faults and digests against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import functions as F

from attestor.llm import conversation_repair as cr


def cheapest(rows):
    """Least (cost, audit) over all edit sequences, shortest first; rows are (initial, fault)."""
    best = None
    most = 3 * len(rows) + 1
    todo = [(0, "", 0, "")]
    while todo:
        cost, audit, at, roles = todo.pop()
        if best is not None and cost > best[0] or cost > most:
            continue
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            best = min(best or (cost, audit), (cost, audit))
        if not re.fullmatch("s?(ua)*u?", roles):
            continue
        for new in "ua":
            todo.append((cost + 2, audit + "I", at, roles + new))
        if at < len(rows):
            initial, fault = rows[at]
            todo.append((cost + 3, audit + "D", at + 1, roles))
            if fault in (cr.NONE, cr.TRUNCATED):
                more = int(fault == cr.TRUNCATED)
                todo.append((cost + more, audit + "K", at + 1, roles + (initial or "?")))
                todo += [(cost + more + 2, audit + "R", at + 1, roles + new) for new in "ua"]
    return best


def plain(conv, rows):
    """The contract's columns of one conversation; rows are (turn, role, text) in order."""
    faults, seen, listed = [0, 0, 0, 0], set(), []
    for _, role, text in rows:
        solid = text.strip(" \t\n\v\f\r")
        fault = cr.BLANK if not solid else cr.DUPLICATE if (role, text) in seen else cr.TRUNCATED if solid[-1] not in ".!?" else cr.NONE
        seen.add((role, text))
        faults[fault] += 1
        listed.append((role[:1], fault))
    cost, audit = cheapest(listed)
    out, queue = [], list(rows)
    for e in audit:
        role, text = ("", "") if e == "I" else queue.pop(0)[1:]
        if e == "D":
            continue
        if e != "K":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        out.append((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(listed))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (conv, gaps, *faults[1:], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()), out


def damaged(rows):
    """Rows (conv, turn, role, text) of a table by conversation, after the contract's damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        h = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if h:
            row = (turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
            kept += [row] * (2 if h == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:])) for c, r in out.items()}


def test_chart_against_all_repairs():
    kinds = [(i, f) for i in ("s", "u", "a", "t", "") for f in range(4)]
    rng = random.Random(3)
    cases = [list(c) for n in range(3) for c in itertools.product(kinds, repeat=n)] + [[rng.choice(kinds) for _ in range(n)] for n in (3, 4) for _ in range(120)]
    for rows in cases:
        chart = cr.Chart()
        for row in rows:
            chart.scan(*row)
        assert chart.result() == cheapest(rows), rows


def test_settled_edits_do_not_change_the_result(monkeypatch):
    rng = random.Random(8)
    for _ in range(60):
        rows = [(rng.choice("suat"), rng.choice((0, 0, 0, 1, 3))) for _ in range(rng.randrange(150))]
        results = []
        for limit in (1, 10**9):
            monkeypatch.setattr(cr, "OPEN", limit)
            chart, audit = cr.Chart(), ""
            for row in rows:
                chart.scan(*row)
                audit += chart.settled()
            cost, rest = chart.result()
            results.append((cost, audit + rest))
        assert results[0] == results[1]


def test_long_conversations():
    whole = cr.Repair(1)
    for i in range(20_000):
        whole.add(i, ("user", "assistant")[i % 2], f"Turn {i}.", cr.NONE)
        assert len(whole.waiting) < 200
    assert whole.finish()[6:8] == (0, "K" * 20_000)
    foreign = cr.Repair(1)
    for i in range(3_000):
        foreign.add(i, "tool", f"Turn {i}.", cr.NONE)
    assert foreign.finish()[6:8] == (6_000, "R" * 3_000)


ROLES = ("system", "user", "assistant", "tool", "User", "", None)


def test_tables(spark):
    rng = random.Random(11)
    texts = ("Well.", "Well.", "So?", "cut off", "", " \t\n", None, "x! \r\n", "写真。", "A" * 5000 + ".")
    rows = [(rng.randrange(80), rng.choice((0, 1, 2, 2, 3, 9, None)), rng.choice(ROLES), rng.choice(texts)) for _ in range(260)]
    rows += [(None, 1, "user", "Null id."), (None, 2, "assistant", "It is."), (500, None, "user", "Only null turns."), (501, -(1 << 63), "user", "Far."), (501, (1 << 63) - 1, "assistant", "Apart.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as cost", "'x' as conv", "true as present")
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv), key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))
        if len(own) <= 6:
            want[conv] = plain(conv, own)
    got = {r[0]: tuple(r) for r in cr.audit(df).collect()}
    assert set(got) == {r[0] for r in rows}
    assert len(want) > 40
    for conv, (row, _) in want.items():
        assert got[conv] == (row[0], min(row[1], (1 << 63) - 1), *row[2:])
    turns = {}
    for r in sorted(cr.repair(df).collect(), key=lambda r: r["position"]):
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert all(turns.get(c, []) == out for c, (_, out) in want.items())


def test_absent_rows_and_empty_table(spark):
    df = spark.createDataFrame([("a", 1, "user", "Gone."), ("b", 1, "user", "Here.")], "conv_id string, turn int, role string, text string")
    got = {r["conv_id"]: tuple(r)[1:] for r in cr.audit(df, present=F.col("conv_id") != "a").collect()}
    assert got["a"] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got["b"][5:7] == (2, "KI")
    assert cr.audit(df.limit(0)).collect() == [] == cr.repair(df.limit(0)).collect()


def test_one_shuffle(spark):
    df = spark.range(100).selectExpr("id % 9 as conv_id", "id as turn", "'user' as role", "'x.' as text")
    plan = cr.audit(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
