"""Conversation repair against a plain search over all edits, and the query against a plain version of its contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest

from cladeworks.llm import conversation_repair as cr

CHARS = r"[^\x20\x09-\x0D]"
SPEECH = re.compile(r"(s?(ua)+)?\Z")


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 1:
            text = ""
        elif draw == 2:
            text = re.sub("[.!?]", "", text)
        elif draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (draw != 0) * (1 + (draw == 3))
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        last = re.findall(CHARS, text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit, repaired), over all ways to go through the rows, by states that are the string of roles so far."""
    ways = {"": (0, "", ())}  # roles, shortened to what can still matter -> best

    def short(roles):
        return roles if len(roles) < 3 else roles[:1] * (roles[0] == "s") + "ua" + ("u" if (len(roles) - (roles[0] == "s")) % 2 else "")

    def put(into, roles, way):
        if re.match(r"(s?(ua)*u?)\Z", roles) and (roles := short(roles)) is not None and (roles not in into or way[:2] < into[roles][:2]):
            into[roles] = way

    def with_inserts(ways):
        for _ in range(3):
            for roles, (cost, audit, kept) in list(ways.items()):
                for name in ("user", "assistant"):
                    put(ways, roles + name[0], (cost + 2, audit + "I", (*kept, f"{name}:")))
        return ways

    for (_, _, role, text), fault in zip(rows, found, strict=True):
        after = {}
        for roles, (cost, audit, kept) in with_inserts(ways).items():
            put(after, roles, (cost + 3, audit + "D", kept))
            if fault not in ("blank", "duplicate"):
                cost += fault == "truncated"
                put(after, roles + (role[:1] or "?"), (cost, audit + "K", (*kept, f"{role}:{text}")))
                for name in ("user", "assistant"):
                    put(after, roles + name[0], (cost + 2, audit + "R", (*kept, f"{name}:{text}")))
        ways = after
    return min(way for roles, way in with_inserts(ways).items() if SPEECH.match(roles))


def plain(conv, rows):
    """The contract's row of one conversation."""
    rows = after_damage(rows)
    if not rows:
        return (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found, turns, initials = faults(rows), {r[1] for r in rows} - {None}, [r[2][:1] for r in rows]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, audit, kept = cheapest(rows, found)
    return (conv, gaps, *map(found.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def expected(rows):
    by_conv = defaultdict(list)
    for r in rows:
        by_conv[r[0]].append(r)
    return {conv: plain(conv, some) for conv, some in by_conv.items()}


def talk(rng, conv, turns):
    roles = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant", "tool", None, "", "User", "sys"]])
    texts = ["Yes.", "No!", "cut", "", " \t", None, "Why?  ", "long. text", "é日本."]
    return [(conv, t if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}" + rng.choice([".", "", "!\n"])) for t in range(turns) if rng.random() < 0.9]


def test_dp_against_every_edit():
    rng = random.Random(5)
    for _ in range(25):
        symbols = [rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randint(0, 3))]
        best = None
        gaps = [""] + ["".join(x) for n in (1, 2) for x in product("ua", repeat=n)]
        for edits in product(*[[("D", 3, "")] + ([("K", s & 1, "sua?"[s >> 1]), ("R", 2 + (s & 1), "u"), ("R", 2 + (s & 1), "a")] if s != 8 else []) for s in symbols]):
            for between in product(gaps, repeat=len(symbols) + 1):
                roles = between[0] + "".join(e[2] + g for e, g in zip(edits, between[1:], strict=True))
                if SPEECH.match(roles):
                    cost = sum(e[1] for e in edits) + 2 * len("".join(between))
                    audit = "I" * len(between[0]) + "".join(e[0] + "I" * len(g) for e, g in zip(edits, between[1:], strict=True))
                    best = min(best, (cost, audit)) if best else (cost, audit)
        runs = cr.runs_of(symbols, [1] * len(symbols))
        audit, state = cr.unroll(runs, cr.AT_END, 0, True)
        cost = cr.onward([cr.matrix_of(runs)[4 * i : 4 * i + 4] for i in range(4)], cr.AT_END)[0]
        assert (cost, audit) == best and state in cr.ENDS


def test_long_runs():
    for symbol, n in product(range(9), (1, 5, 1000, 4097)):
        power = cr.run_matrix(symbol, n)
        ahead = cr.AT_END
        for _ in range(n):
            ahead = cr.onward(cr.power(symbol, 0), ahead)
        assert cr.onward(power, cr.AT_END) == ahead == cr.before_run(symbol, n, cr.AT_END)
        audit, _ = cr.unroll([[symbol, n]], cr.AT_END, 0, True)
        assert sum(c != "I" for c in audit) == n


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(8)
    rows = [r for conv in range(150) for r in talk(rng, conv, rng.randint(1, 12))]
    rows += talk(rng, None, 9) + talk(rng, 5000, 600)
    rows += [(6000, None, "user", "same."), (6000, None, "assistant", None), (6001, 2**62, "user", "far."), (6001, -(2**62), "user", "near.")]
    rows += [(6002, 3, "user", "again.")] * 7 + [(6003, 1, "assistant", "x" * 200_000 + ".")]
    gone = next(c for c in range(7000, 8000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (gone, 0, "user", "dropped.")]


@pytest.mark.parametrize("batch", [10000, 7])
def test_query(spark, tmp_path, conversations, batch):
    """Batches of seven rows cut conversations into many pieces."""
    docs = spark.createDataFrame(conversations, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as part", "1 as piece", "'y' as key", "2 as copies", "3 as draw")
    docs.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = cr.op13_conversation_repair(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = expected(conversations)
    assert len(got) == len(want)
    wrong = [(tuple(r), want[r.conv_id]) for r in got if tuple(r) != want[r.conv_id]]
    assert not wrong, wrong[:2]


def test_on_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r) for r in cr.op13_conversation_repair(spark, sf_dir).collect()}
    assert got == expected(rows)
