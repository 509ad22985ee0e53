"""Operator 13: conversation structure repair by a run-length min-plus DP over role/fault symbols."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeworks.llm.common import drop_materialized, materialize, read_table

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Roles go through these states: nothing yet, after the system row, after a user row, after an assistant row. Where a
#: user (1) or an assistant (2) row leads from each; a system row (0) may only come first. It may end in ENDS.
LEADS = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
ENDS = (0, 3)
#: The role that a rerole or an insert gives in each state: the only one that is legal there.
NEXT_ROLE = ("user", "user", "assistant", "user")
#: A symbol is 2 * (initial s, u, a, other) + truncated, or GONE for rows that must go.
INITIALS, GONE = "sua", 8
LEGAL = ("su", "ua", "au")
FAR = 1 << 60
#: Runs longer than this are unrolled by halves, whose ends come from the powers.
STEPWISE = 256
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def inserted(ahead: list[int]) -> list[int]:
    """Cost to go from each state, if inserts may come first; two change what is legal next, three never pay."""
    out = list(ahead)
    for _ in range(2):
        out = [min(out[i], INSERT + out[LEADS[i][1 if i != 2 else 2]]) for i in range(4)]
    return out


def times(x: tuple, y: tuple) -> tuple:
    """The min-plus product of two 4 x 4 matrices."""
    return tuple(tuple(min(FAR, *(x[i][k] + y[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def onward(x: tuple, ahead: list[int]) -> list[int]:
    return [min(FAR, *(x[i][j] + ahead[j] for j in range(4))) for i in range(4)]


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row of this symbol, but for inserts."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        extra = TRUNCATED * (symbol & 1)
        if (to := LEADS[state].get(symbol >> 1)) is not None:
            out.append(("K", extra, to))
        out.append(("R", REROLE + extra, LEADS[state][1 if state != 2 else 2]))
    return out


@lru_cache(maxsize=1024)
def power(symbol: int, k: int) -> tuple:
    """The min-plus transition of 2^k rows of one symbol: cost from each state to each state, inserts before a row included."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    columns = []
    for j in range(4):
        step = [min([cost for _, cost, to in choices(symbol, i) if to == j], default=FAR) for i in range(4)]
        columns.append(inserted(step))
    return tuple(tuple(min(FAR, columns[j][i]) for j in range(4)) for i in range(4))


IDENTITY = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
AT_END = inserted([0 if i in ENDS else FAR for i in range(4)])


@lru_cache(maxsize=65536)
def run_matrix(symbol: int, length: int) -> tuple:
    out = IDENTITY
    for k in range(length.bit_length()):
        if length >> k & 1:
            out = times(out, power(symbol, k))
    return out


def before_run(symbol: int, length: int, ahead: list[int]) -> list[int]:
    """Cost to go ahead of a run, from the cost to go behind it."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            ahead = onward(power(symbol, k), ahead)
    return ahead


def runs_of(symbols: list[int], counts: list[int]) -> list[list[int]]:
    """[symbol, length] of maximal runs; a row that is there ``counts`` times is followed by its own duplicates."""
    out = []
    for symbol, n in zip(symbols, counts, strict=True):
        for s, m in ((symbol, 1), (GONE, n - 1)):
            if m and out and out[-1][0] == s:
                out[-1][1] += m
            elif m:
                out.append([s, m])
    return out


def matrix_of(runs: list[list[int]]) -> list[int]:
    out = IDENTITY
    for symbol, n in runs:
        out = times(out, run_matrix(symbol, n))
    return [x for row in out for x in row]


def unroll_run(symbol: int, length: int, ahead: list[int], state: int, audit: list[str]) -> int:
    """Append the ASCII-least cheapest letters of a run to ``audit``; ``ahead`` is the cost to go behind it. Returns the state behind it."""
    if length > STEPWISE:
        half = length // 2
        state = unroll_run(symbol, half, before_run(symbol, length - half, ahead), state, audit)
        return unroll_run(symbol, length - half, ahead, state, audit)
    costs, step = [ahead], power(symbol, 0)
    for _ in range(length):
        costs.append(onward(step, costs[-1]))
    for k in range(length, 0, -1):
        here, behind = costs[k], costs[k - 1]
        while True:
            options = [(x, cost + behind[to], to) for x, cost, to in choices(symbol, state)]
            to = LEADS[state][1 if state != 2 else 2]
            options.append(("I", INSERT + here[to], to))
            letter, _, to = min(o for o in options if o[1] == here[state])
            audit.append(letter)
            state = to
            if letter != "I":
                break
    return state


def unroll(runs: list[list[int]], ahead: list[int], state: int, last: bool) -> tuple[str, int]:
    """(audit, state behind the runs); behind the last ones come the inserts that a legal end needs."""
    costs = [ahead]
    for symbol, n in reversed(runs):
        costs.append(before_run(symbol, n, costs[-1]))
    if costs[-1][state] >= FAR:  # no path from here: never entered
        return "", state
    audit: list[str] = []
    for k, (symbol, n) in enumerate(runs):
        state = unroll_run(symbol, n, costs[len(runs) - 1 - k], state, audit)
    while last and state not in ENDS:
        audit.append("I")
        state = LEADS[state][1 if state != 2 else 2]
    return "".join(audit), state


def repaired(audit: str, state: int, rows: list[tuple[str, str]]) -> list[str]:
    """``role:text`` of the rows that the edits leave or put in."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            out.append(f"{NEXT_ROLE[state]}:")
            state = LEADS[state][1 if state != 2 else 2]
            continue
        role, text = rows[at]
        at += 1
        if letter == "K":
            out.append(f"{role}:{text}")
            state = LEADS[state][INITIALS.index(role[0])]
        elif letter == "R":
            out.append(f"{NEXT_ROLE[state]}:{text}")
            state = LEADS[state][1 if state != 2 else 2]
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): the contract's damage, drawn by crc32 of ``conv_id:turn``; equal rows of a turn are one with a count."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    base = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), (F.crc32(F.encode(F.concat(name("conv_id"), F.lit(":"), name("turn")), "UTF-8")) % 20).alias("draw"))
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    rows = base.where("draw <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("draw") == 3, 2).otherwise(1).cast("long").alias("copies"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def place(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("known"), turn.alias("turn"))


def marked(rows: DataFrame) -> DataFrame:
    """``rows`` with their fault: blank, seen (role and text at an earlier turn) or cut (truncated), the first that holds."""
    keyed = rows.withColumn("key", F.md5(F.encode("text", "UTF-8")))
    first = keyed.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("key").alias("k")).agg(F.min(place(F.col("turn"))).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("key") == F.col("k"))
    told = keyed.join(first, same).withColumn("end", F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)))
    blank, seen = F.col("end") == "", place(F.col("turn")) > F.col("first")
    return told.select("conv_id", "turn", "role", "text", "copies", blank.alias("blank"), (~blank & seen).alias("seen"), (~blank & ~seen & ~F.col("end").isin(".", "!", "?")).alias("cut"))


PIECE = "part int, piece int, size long, roles array<string>, texts array<string>, symbols array<int>, copies array<long>, steps array<long>, blank long, duplicate long, truncated long, illegal long, first string, last string"


def pieces(rows: DataFrame) -> DataFrame:
    """(conv_id, part, piece, ...): stretches of a conversation in order of turn, each with the min-plus matrix of its rows.

    Rows are sorted over range partitions, so that a conversation of any size is spread; a stretch ends with its
    conversation, its Arrow batch or its partition.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, roles, texts = (batch.column(k).to_pylist() for k in (0, 2, 3))
            copies, blank, seen, cut = (batch.column(k).to_pylist() for k in (4, 5, 6, 7))
            starts = [0, *(k for k in range(1, len(ids)) if ids[k] != ids[k - 1])]
            out = []
            for a, b in zip(starts, [*starts[1:], len(ids)], strict=True):
                initials = [r[:1] for r in roles[a:b]]
                symbols = [GONE if blank[k] or seen[k] else 2 * (INITIALS.find(i) if i and i in INITIALS else 3) + cut[k] for k, i in zip(range(a, b), initials, strict=True)]
                n = copies[a:b]
                illegal = sum(x + y not in LEGAL for x, y in zip(initials, initials[1:], strict=False)) + sum(n) - len(n)
                blanks = sum(x for x, bad in zip(n, blank[a:b], strict=True) if bad)
                again = sum(x - 1 + bool(s) for x, bad, s in zip(n, blank[a:b], seen[a:b], strict=True) if not bad)
                out.append((part, count, sum(n), roles[a:b], texts[a:b], symbols, n, matrix_of(runs_of(symbols, n)), blanks, again, sum(cut[a:b]), illegal, initials[0], initials[-1]))
                count += 1
            names = [x.split()[0] for x in PIECE.split(", ")]
            kinds = [{"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}[x.split()[1]] for x in PIECE.split(", ")]
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(starts)), *columns], ["conv_id", *names])

    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role")]
    spread = rows.repartitionByRange(*keys, F.substring("text", 1, 100)).sortWithinPartitions(*keys, "text")
    return spread.select("conv_id", "turn", "role", "text", "copies", "blank", "seen", "cut").mapInArrow(run, f"conv_id {kind}, {PIECE}")


def ahead_of(parts: DataFrame) -> DataFrame:
    """(conv_id, totals, and of each piece: part, piece, head, tail, ahead): the cost to go behind each piece, from the matrices of those that follow."""
    kind = parts.schema["conv_id"].dataType.simpleString()
    fields = ("blank", "duplicate", "truncated", "illegal")

    def run(batches):
        for batch in batches:
            out = []
            for found in batch.column(1).to_pylist():
                ahead, behind = list(AT_END), []
                for x in reversed(found):
                    behind.append(ahead)
                    ahead = onward([x["steps"][4 * i : 4 * i + 4] for i in range(4)], ahead)
                joints = sum(x["last"] + y["first"] not in LEGAL for x, y in zip(found, found[1:], strict=False))
                totals = {f: sum(x[f] for x in found) for f in fields}
                totals["illegal"] += joints
                marks = [{"part": x["part"], "piece": x["piece"], "head": k == 0, "tail": k == len(found) - 1, "ahead": v} for k, (x, v) in enumerate(zip(found, reversed(behind), strict=True))]
                out.append((*totals.values(), ahead[0], marks))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            mark = pa.struct([("part", pa.int32()), ("piece", pa.int32()), ("head", pa.bool_()), ("tail", pa.bool_()), ("ahead", pa.list_(pa.int64()))])
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.list_(mark))], ["conv_id", *fields, "cost", "marks"])

    slim = F.struct("part", "piece", "steps", *fields, "first", "last")
    listed = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(slim)).alias("found"))
    mark = "struct<part: int, piece: int, head: boolean, tail: boolean, ahead: array<bigint>>"
    return listed.mapInArrow(run, f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, marks array<{mark}>")


def audits_of(parts: DataFrame, marks: DataFrame) -> DataFrame:
    """(conv_id, part, piece, audits, exits): each piece unrolled from every state that it may be entered in."""
    kind = parts.schema["conv_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            audits, exits = [], []
            symbols, copies, heads, tails, ahead = (batch.column(k).to_pylist() for k in range(3, 8))
            for s, n, head, tail, v in zip(symbols, copies, heads, tails, ahead, strict=True):
                found = [unroll(runs_of(s, n), v, state, tail) for state in range(1 if head else 4)]
                audits.append([a for a, _ in found])
                exits.append([e for _, e in found])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))], ["conv_id", "part", "piece", "audits", "exits"])

    both = parts.join(marks, ["part", "piece"]).select("conv_id", "part", "piece", "symbols", "copies", "head", "tail", "ahead")
    return both.mapInArrow(run, f"conv_id {kind}, part int, piece int, audits array<string>, exits array<int>")


def entered(audits: DataFrame) -> DataFrame:
    """(part, piece, entry): the state in which each piece is entered, by following the exits of those before it."""

    def run(batches):
        for batch in batches:
            out = []
            for found in batch.column(0).to_pylist():
                state = 0
                for x in found:
                    out.append((x["part"], x["piece"], state))
                    state = x["exits"][state]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in columns], ["part", "piece", "entry"])

    listed = audits.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "piece", "exits"))).alias("found"))
    return listed.select("found").mapInArrow(run, "part int, piece int, entry int")


def digests(parts: DataFrame, audits: DataFrame, entries: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): pieces written out where they are, then hashed in order, one after another in bounded memory."""
    kind = parts.schema["conv_id"].dataType.simpleString()

    def write(batches):
        for batch in batches:
            texts, chosen = [], []
            for roles, lines, copies, found, entry in zip(*(batch.column(k).to_pylist() for k in range(3, 8)), strict=True):
                audit = found[entry]
                rows = [(r, t) for r, t, n in zip(roles, lines, copies, strict=True) for _ in range(n)]
                chosen.append(audit)
                texts.append("\n".join(repaired(audit, entry, rows)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(chosen, pa.string()), pa.array(texts, pa.string())], ["conv_id", "part", "piece", "audit", "text"])

    def read(batches):
        now, digest, audit, some = None, None, [], False

        def told():
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], arrow), pa.array([x[1] for x in done], pa.string()), pa.array([x[2] for x in done], pa.string())], ["conv_id", "audit", "repaired_sha256"])

        done, arrow = [], None
        for batch in batches:
            arrow = batch.schema.field(0).type
            for conv, letters, text in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4)), strict=True):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append((now[0], "".join(audit), digest.hexdigest()))
                    now, digest, audit, some = (conv,), hashlib.sha256(), [], False
                audit.append(letters)
                if text:
                    digest.update((b"\n" if some else b"") + text.encode())
                    some = True
            if done:
                yield told()
                done = []
        if now is not None:
            done.append((now[0], "".join(audit), digest.hexdigest()))
            yield told()

    both = parts.join(audits.select("part", "piece", "audits"), ["part", "piece"]).join(entries, ["part", "piece"])
    chunks = both.select("conv_id", "part", "piece", "roles", "texts", "copies", "audits", "entry").mapInArrow(write, f"conv_id {kind}, part int, piece int, audit string, text string")
    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
    return ordered.mapInArrow(read, f"conv_id {kind}, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of rows (conv_id, turn, role, text, copies).

    The cheapest edits that leave roles of the form ``(s?(ua)+)?``, ties by the ASCII-least audit. Each row becomes a
    symbol of its role's initial and its first fault; equal neighbours form runs, which are advanced by cached binary powers of
    their min-plus transition. Stretches of a long conversation are worked on apart: their matrices give the cost to go behind each,
    their exits the state in which each is entered, so that no task holds a whole conversation. Only the hash reads
    one from end to end, stretch by stretch, because SHA-256 has no other way.

    Nulls of role and text are one space by then; a null conv_id is a conversation of its own; null turns come first and
    don't count for gaps; rows of one turn come in order of role, then text; equal rows are duplicates of the first; a role without a
    first letter s, u or a (the empty one too) is never legal and can be changed or deleted; very long texts count whole; an empty
    table gives an empty one; other columns are ignored. ``gaps`` is capped at the largest long.
    """
    parts = materialize(pieces(marked(rows)), "pieces")
    found = materialize(ahead_of(parts), "ahead")
    audits = materialize(audits_of(parts, found.select(F.explode("marks").alias("m")).select("m.*")), "audits")
    texts = digests(parts, audits, entered(audits))
    turns = rows.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count("turn").alias("n"), F.min("turn").cast("decimal(20,0)").alias("low"), F.max("turn").cast("decimal(20,0)").alias("high"))
    missing = F.least(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(2**63 - 1).cast("decimal(20,0)")).cast("long")
    gaps = turns.select(F.col("conv_id").alias("g"), F.when(F.col("n") > 0, missing).otherwise(0).alias("gaps"))
    totals = found.select(F.col("conv_id").alias("t"), "blank", "duplicate", "truncated", "illegal", "cost")
    out = texts.join(totals, F.col("conv_id").eqNullSafe(F.col("t"))).join(gaps, F.col("conv_id").eqNullSafe(F.col("g")))
    out = materialize(out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"), "repaired")
    drop_materialized(parts, found, audits)
    return out


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = read_table(spark, sf_dir, "conversations")
    fixed = repair(damaged(told))
    names = fixed.columns[1:]
    every = told.select(F.col("conv_id").alias("id")).distinct()
    both = every.join(fixed, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    empty = {n: F.lit(0).cast("long") for n in names} | {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return both.select(F.col("id").alias("conv_id"), *[F.coalesce(n, empty[n]).alias(n) for n in names])
