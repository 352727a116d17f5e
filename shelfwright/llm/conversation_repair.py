"""Conversation structure repair by Viterbi with rank convergence.

**Model.** The role initials of a repaired conversation read ``(s?(ua)+)?``. A row is kept, given the other role (cost 2) or deleted
(cost 3); rows without text (blank) and rows whose role and text came earlier (duplicate) must be deleted; a row that stays but whose
last character ends no sentence (truncated) costs 1 more; an empty row of the missing role can be inserted anywhere (cost 2). Four
states say what came last. From each state only one role can follow, so the edits' initials alone determine the repaired rows.

**Costs.** A backward pass gives each row the least cost of the rest from each state. From the first row on, the tracer then takes
the ASCII-least edit that lies on a cheapest path, so the audit is the least of all cheapest ones.

**Parallel.** Rows are exchanged once, by ranges of conversation and order, so a conversation with a third of all rows is spread over many
tasks. A conversation that lies within one task and has at most ``CHUNK`` rows is done there. The others are cut into chunks of
at most ``CHUNK`` rows. All chunks run backward at once, each from a speculative cost vector (the last one from the true one). In a
fix-up pass every chunk takes its successor's new vector and runs again, until a vector differs from the one of the run before only by a
constant: from there on all differences are right already. Passes end when no chunk gets another vector. Rows that must
be deleted change no differences; chunks of them are left out of the chain. If ``PASSES`` do not suffice (rows of no known role keep
their parity for ever), each chunk's whole transfer matrix is made and one sweep per conversation over these few numbers gives the vectors.
The tracer runs in all chunks from all four states; one sweep over the chunks' end states says which of them is the true one.

Only the hash of a repaired conversation is a matter of one task, which streams its lines in blocks; nothing is held.

Rows: one per ``conv_id`` (null is one too). A null role or text is one space. Rows are ordered by turn, nulls first; rows of equal turn by a
hash of role and text. A role's initial is its first character; an empty role has none, its row can stay anywhere. A conversation
without rows, or all of whose rows are marked ``dropped``, has zeros, an empty audit and the hash of nothing. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwright.llm.frames import small_batches, written

#: Rows of a chunk (a power of two: a row's number without its low bits names its chunk), passes before the exact sweep.
CHUNK_BITS, PASSES = 10, 6
CHUNK = 1 << CHUNK_BITS
#: Lines of a block of text for the hash, also a power of two.
BLOCK_BITS = 5

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: Least cost to end from each state.
END = (0, 4, 2, 0)
GUESS = (0, 0, 0, 0)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: The state after the only row that can follow, unless that is a system row.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Initial -> state before -> state after a row that is kept.
KEEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "": {s: s for s in STATES}}
INITIALS = ("s", "u", "a", "", "other")
FAULTS = ("", "truncated", "blank", "duplicate")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
DROPPED = len(INITIALS) * len(FAULTS)
SPACE = " \t\n\x0b\x0c\r"
FAR = 1 << 40

REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def code_of(role: str, fault: str) -> int:
    initial = role[:1] if role[:1] in KEEP else "other"
    return INITIALS.index(initial) * len(FAULTS) + FAULTS.index(fault)


def fault_of(text: str) -> str:
    """The first fault that a text has by itself."""
    solid = text.rstrip(SPACE)
    return "blank" if not solid else "" if solid[-1] in ".!?" else "truncated"


@cache
def edits(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """Edits of a row other than insertion: initial, cost, state after."""
    initial, fault = INITIALS[code // len(FAULTS)], FAULTS[code % len(FAULTS)]
    out = [("D", DELETE, state)]
    if fault in ("", "truncated"):
        more = TRUNCATED if fault else 0
        after = KEEP.get(initial, {}).get(state)
        out += [("K", more, after)] if after is not None else []
        out.append(("R", REROLE + more, NEXT[state]))
    return tuple(out)


def backward(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Least costs from each state before a row, from those after it."""
    if code == DROPPED:
        return after
    best = [min(cost + after[to] for _, cost, to in edits(code, s)) for s in STATES]
    user, assistant = best[USER], best[ASSISTANT]
    best[USER], best[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(best[START], INSERT + best[USER]), min(best[SYSTEM], INSERT + best[USER]), best[USER], best[ASSISTANT]


@cache
def levelled(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    """As ``backward``, less a constant: few vectors exist, so each step is looked up."""
    costs = backward(after, code)
    return tuple(c - costs[0] for c in costs)


@cache
def choice(after: tuple[int, ...], code: int, state: int) -> tuple[str, int, int]:
    """ASCII-least edits up to and with a row: initials, their cost, state after."""
    if code == DROPPED:
        return "", 0, state
    here, out, spent = backward(after, code), "", 0
    while True:
        on_path = {edit: (cost, to) for edit, cost, to in edits(code, state) if cost + after[to] == here[state]}
        if "D" not in on_path and INSERT + here[NEXT[state]] == here[state]:
            out, spent, state = out + "I", spent + INSERT, NEXT[state]
            continue
        edit = min(on_path)
        return out + edit, spent + on_path[edit][0], on_path[edit][1]


@cache
def ending(state: int) -> tuple[str, int]:
    """Insertions after the last row, and their cost."""
    out = ""
    while state not in (START, ASSISTANT):
        out, state = out + "I", NEXT[state]
    return out, INSERT * len(out)


def sweep(codes: list[int], entry: tuple[int, ...], known: list[tuple[int, ...]] | None = None) -> list[tuple[int, ...]]:
    """Cost vectors before each row and at the end. Those of a run before stay from where the two differ by a constant."""
    out = list(known) if known else [entry] * (len(codes) + 1)
    out[-1] = entry
    for i in range(len(codes) - 1, -1, -1):
        now = levelled(out[i + 1], codes[i])
        if known and now == out[i]:
            break
        out[i] = now
    return out


def trace(codes: list[int], vectors: list[tuple[int, ...]], state: int) -> tuple[list[str], int, int]:
    """Edits of each row, the state after the last and what they cost."""
    out, spent = [], 0
    for i, code in enumerate(codes):
        edit, cost, state = choice(vectors[i + 1], code, state)
        out.append(edit)
        spent += cost
    return out, state, spent


def lines_of(edit: str, state: int, role: str, text: str) -> tuple[list[tuple[str, str]], int]:
    """Rows that the edits of one row leave, and the state after them."""
    out = []
    for e in edit:
        if e in "IR":
            state = NEXT[state]
            out.append((ROLE[state], text if e == "R" else ""))
        elif e == "K":
            state = KEEP[role[:1]][state]
            out.append((role, text))
    return out, state


class Stats(NamedTuple):
    """What a run of rows adds to its conversation's report; runs in order add up."""

    low: int | None = None
    high: int | None = None
    turns: int = 0
    first: int = -1
    last: int = -1
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    cost: int = 0

    def __add__(self, other: Stats) -> Stats:
        if other.first < 0:
            return self._replace(cost=self.cost + other.cost)
        if self.first < 0:
            return other._replace(cost=self.cost + other.cost)
        turns = self.turns + other.turns - (self.turns > 0 and self.high == other.low)
        pair = (INITIALS[self.last], INITIALS[other.first])
        return Stats(other.low if self.low is None else self.low, self.high if other.high is None else other.high, turns, self.first, other.last,
                     *(a + b for a, b in zip(self[5:8], other[5:8], strict=True)), self.illegal + other.illegal + (pair not in LEGAL), self.cost + other.cost)

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def stats_of(turns: list[int | None], codes: list[int], cost: int) -> Stats:
    """Report figures of rows in order."""
    stay = [(t, c) for t, c in zip(turns, codes, strict=True) if c != DROPPED]
    if not stay:
        return Stats(cost=cost)
    seen = [t for t, _ in stay if t is not None]
    faults = [c % len(FAULTS) for _, c in stay]
    initials = [c // len(FAULTS) for _, c in stay]
    illegal = sum((INITIALS[a], INITIALS[b]) not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return Stats(seen[0] if seen else None, seen[-1] if seen else None, len(set(seen)), initials[0], initials[-1],
                 *(faults.count(FAULTS.index(f)) for f in ("blank", "duplicate", "truncated")), illegal, cost)


class Digest:
    """Hash of ``role:text`` lines, joined by line breaks."""

    def __init__(self) -> None:
        self.hash, self.empty = hashlib.sha256(), True

    def add(self, text: str) -> None:
        self.hash.update((text if self.empty else "\n" + text).encode())
        self.empty = False


def _report(conv_id: int | None, stats: Stats, audit: str, digest: Digest) -> dict:
    return {"conv_id": conv_id, "gaps": stats.gaps, "blank": stats.blank, "duplicate": stats.duplicate, "truncated": stats.truncated,
            "illegal": stats.illegal, "cost": stats.cost, "audit": audit, "repaired_sha256": digest.hash.hexdigest()}


def whole(conv_id: int | None, rows: list[dict]) -> dict:
    """Report and repaired rows of a conversation whose rows are all here, in order."""
    seen: set[bytes] = set()
    codes = []
    for row in rows:
        again = row["key"] is not None and row["key"] in seen
        seen.add(row["key"])
        codes.append(code_of(row["role"], "duplicate") if again else row["code"])
    choices, state, cost = trace(codes, sweep(codes, END), START)
    tail, more = ending(state)
    kept, state, digest = [], START, Digest()
    for row, edit in [*zip(rows, choices, strict=True), ({"role": "", "text": ""}, tail)]:
        lines, state = lines_of(edit, state, row["role"], row["text"])
        kept += lines
    for role, text in kept:
        digest.add(f"{role}:{text}")
    stats = stats_of([r["turn"] for r in rows], codes, cost + more)
    return _report(conv_id, stats, "".join(choices) + tail, digest) | {"uid": rows[0]["uid"], "lines": [{"role": r, "text": t} for r, t in kept]}


_ROWS = "conv_id long, uid long, turn long, role string, text string, code int, key binary"
_LINES = "lines array<struct<role: string, text: string>>"
_SPLIT = f"{_ROWS}, done boolean, {REPORT.removeprefix('conv_id long, ')}, {_LINES}"


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _mapped(df: DataFrame, make, ddl: str, size: int = 1000) -> DataFrame:
    """``df`` through a generator of rows (dicts) over the rows of each partition."""
    schema = _arrow(ddl)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                yield from batch.slice(start, size).to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(make(rows(batches)), schema, size)

    return df.mapInArrow(run, ddl)


def _split(rows: Iterator[dict]) -> Iterator[dict]:
    """Rows in order, as reports of the conversations that lie within this task and as numbered rows of the others."""
    base, place = TaskContext.get().partitionId() << 33, 0
    held: list[dict] = []
    first = spilled = True
    for row in rows:
        if held and held[0]["conv_id"] != row["conv_id"]:
            yield from held if first or spilled else [{"done": True, **whole(held[0]["conv_id"], held)}]
            first = first and not held
            held, spilled = [], False
        fault = fault_of(row["text"])
        code = DROPPED if row["dropped"] else code_of(row["role"], fault)
        key = None if row["dropped"] or fault == "blank" else hashlib.sha256(f"{len(row['role'])}:{row['role']}{row['text']}".encode()).digest()
        held.append({"conv_id": row["conv_id"], "uid": base | place, "turn": row["turn"], "role": row["role"], "text": row["text"], "code": code, "key": key})
        place += 1
        if len(held) > CHUNK:  # too long for one task's memory; the last row stays to tell the next one's conversation
            yield from held[:-1]
            held, spilled = held[-1:], True
    yield from held


_CHUNK = "conv_id long, cid long, next_cid long, uids array<long>, turns array<long>, codes array<int>, vectors binary"


def _packed(vectors: list[tuple[int, ...]]) -> bytes:
    return bytes(v & 255 for vector in vectors for v in vector)


def _unpacked(data: bytes) -> list[tuple[int, ...]]:
    values = [b - 256 if b > 127 else b for b in data]
    return [tuple(values[i:i + 4]) for i in range(0, len(values), 4)]


def _speculate(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        entry = END if row["next_cid"] is None else GUESS
        codes = [r["code"] for r in row["rows"]]
        yield {"conv_id": row["conv_id"], "cid": row["cid"], "next_cid": row["next_cid"], "uids": [r["uid"] for r in row["rows"]],
               "turns": [r["turn"] for r in row["rows"]], "codes": codes, "vectors": _packed(sweep(codes, entry))}


def _fix(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        given = row.pop("given")
        if given is not None and bytes(given) != bytes(row["vectors"][-4:]):
            row["vectors"] = _packed(sweep(row["codes"], _unpacked(given)[0], _unpacked(row["vectors"])))
        yield row


def _transfer(rows: Iterator[dict]) -> Iterator[dict]:
    """For each end state the costs from all states of a chunk."""
    for row in rows:
        matrix = []
        for end in STATES:
            costs = tuple(0 if s == end else FAR for s in STATES)
            for code in reversed(row["codes"]):
                costs = backward(costs, code)
            matrix += costs
        yield {"conv_id": row["conv_id"], "cid": row["cid"], "matrix": matrix}


def _entries(rows: Iterator[dict]) -> Iterator[dict]:
    """True vector at the end of each chunk; a conversation's chunks come last to first."""
    current, costs = None, END
    for row in rows:
        if current is None or current[0] != row["conv_id"]:
            current, costs = (row["conv_id"],), END
        yield {"cid": row["cid"], "given": _packed([tuple(c - costs[0] for c in costs)])}
        matrix = row["matrix"]
        costs = tuple(min(matrix[4 * end + s] + costs[end] for end in STATES) for s in STATES)


def _moves(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        vectors = _unpacked(row["vectors"])
        yield {"conv_id": row["conv_id"], "cid": row["cid"], "ends": [trace(row["codes"], vectors, s)[1] for s in STATES]}


def _starts(rows: Iterator[dict]) -> Iterator[dict]:
    """True first state of each chunk, and which chunk is the last."""
    before, state = None, START
    for row in rows:
        if before is not None:
            same = before["conv_id"] == row["conv_id"]
            yield {"cid": before["cid"], "start": state, "last": not same}
            state = before["ends"][state] if same else START
        before = row
    if before is not None:
        yield {"cid": before["cid"], "start": state, "last": True}


_TRACED = (f"conv_id long, cid long, stats array<long>, audit string, "
           f"edits array<struct<uid: long, edit: string, state: int, tail: string, after: int>>")


def _trace(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        codes = row["codes"]
        choices, end, cost = trace(codes, _unpacked(row["vectors"]), row["start"])
        tail, more = ending(end) if row["last"] else ("", 0)
        out, state = [], row["start"]
        for uid, code, edit in zip(row["uids"], codes, choices, strict=True):
            out.append({"uid": uid, "edit": edit, "state": state, "tail": ""})
            for e in edit:
                state = NEXT[state] if e in "IR" else KEEP[INITIALS[code // len(FAULTS)]][state] if e == "K" else state
        out[-1] |= {"tail": tail, "after": end}
        yield {"conv_id": row["conv_id"], "cid": row["cid"], "stats": list(stats_of(row["turns"], codes, cost + more)),
               "audit": "".join(choices) + tail, "edits": out}


def _apply(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        lines, _ = lines_of(row["edit"], row["state"], row["role"], row["text"])
        more, _ = lines_of(row["tail"], row["after"], "", "") if row["tail"] else ([], 0)
        if lines or more:
            yield {"conv_id": row["conv_id"], "uid": row["uid"], "lines": [{"role": r, "text": t} for r, t in lines + more]}


def _assemble(rows: Iterator[dict]) -> Iterator[dict]:
    """Reports from chunks and text blocks, in order."""
    current, stats, audit, digest = None, Stats(), [], Digest()
    for row in rows:
        if current is None or current[0] != row["conv_id"]:
            if current is not None:
                yield _report(current[0], stats, "".join(audit), digest)
            current, stats, audit, digest = (row["conv_id"],), Stats(), [], Digest()
        if row["block"] is not None:
            digest.add(row["block"])
        else:
            stats, audit = stats + Stats(*row["stats"]), [*audit, row["audit"]] if len(audit) < 64 else ["".join(audit), row["audit"]]
    if current is not None:
        yield _report(current[0], stats, "".join(audit), digest)


def _converged(spark: SparkSession, state: DataFrame) -> DataFrame:
    """``state`` with the true vectors, up to a constant each."""
    for _ in range(PASSES):
        heads = state.select(F.col("cid").alias("next_cid"), F.expr("substring(vectors, 1, 4)").alias("given"))
        joined = state.join(heads, "next_cid", "left").select(*state.columns, "given")
        if joined.where(F.col("given") != F.expr("substring(vectors, -4, 4)")).isEmpty():
            return state
        state = written(spark, _mapped(joined, _fix, _CHUNK, 16), "vectors")
    matrices = _mapped(state, _transfer, "conv_id long, cid long, matrix array<long>", 64)
    entries = _mapped(matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("cid")), _entries, "cid long, given binary")
    return written(spark, _mapped(state.join(entries, "cid").select(*state.columns, "given"), _fix, _CHUNK, 16), "vectors")


def repair(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A report per conversation (``REPORT``), and the repaired rows ``conv_id, uid, nth, role, text``, ordered by ``uid, nth``.

    A boolean column ``dropped``, if there is one, marks rows that only tell that their conversation exists.
    """
    small_batches(spark)
    dropped = F.col("dropped") if "dropped" in conversations.columns else F.lit(False)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role, text, F.coalesce(dropped, F.lit(False)).alias("dropped"))
    order = ["conv_id", "turn", "tie", "row"]
    ordered = (rows.withColumn("tie", F.xxhash64("role", "text")).withColumn("row", F.monotonically_increasing_id())
               .repartitionByRange(*order).sortWithinPartitions(*order).drop("tie", "row"))
    split = written(spark, _mapped(ordered, _split, _SPLIT), "split")
    done, opened = split.where("done"), split.where("done is null")

    firsts = opened.where("key is not null").groupBy("conv_id", "key").agg(F.min("uid").alias("first")).select("first")
    n = len(FAULTS)
    again = F.expr(f"case when key is not null and first is null then code - code % {n} + {FAULTS.index('duplicate')} else code end")
    codes = opened.select("conv_id", "uid", "turn", "code", "key").join(firsts, F.col("uid") == F.col("first"), "left").select(
        "conv_id", "uid", "turn", again.alias("code"))
    chunks = written(spark, codes.groupBy("conv_id", F.shiftright("uid", CHUNK_BITS).alias("chunk")).agg(
        F.min("uid").alias("cid"), F.array_sort(F.collect_list(F.struct("uid", "turn", "code"))).alias("rows")).drop("chunk"), "chunks")
    idle = F.forall("rows", lambda r: (r["code"] % n >= FAULTS.index("blank")) | (r["code"] == DROPPED))
    after = Window.partitionBy("conv_id").orderBy(F.desc("cid")).rowsBetween(Window.unboundedPreceding, -1)
    links = chunks.select("conv_id", "cid", idle.alias("idle")).select(
        "cid", F.when(~F.col("idle"), F.last(F.when(~F.col("idle"), F.col("cid")), ignorenulls=True).over(after)).alias("next_cid"))
    state = _converged(spark, written(spark, _mapped(chunks.join(links, "cid"), _speculate, _CHUNK, 16), "vectors"))

    moves = _mapped(state, _moves, "conv_id long, cid long, ends array<int>", 64)
    starts = _mapped(moves.repartition("conv_id").sortWithinPartitions("conv_id", "cid"), _starts, "cid long, start int, last boolean")
    traced = written(spark, _mapped(state.join(starts, "cid"), _trace, _TRACED, 16), "traced")
    choices = traced.select(F.inline("edits"))
    kept = written(spark, _mapped(opened.select("conv_id", "uid", "role", "text").join(choices, "uid"), _apply, f"conv_id long, uid long, {_LINES}"), "kept")

    block = F.expr("array_join(flatten(transform(array_sort(collect_list(struct(uid, lines))), x -> transform(x.lines, l -> concat(l.role, ':', l.text)))), '\n')")
    blocks = kept.groupBy("conv_id", F.shiftright("uid", BLOCK_BITS).alias("at")).agg(F.min("uid").alias("uid"), block.alias("block"))
    parts = traced.select("conv_id", F.col("cid").alias("uid"), "stats", "audit", F.lit(None).cast("string").alias("block")).unionByName(
        blocks.select("conv_id", "uid", "block"), allowMissingColumns=True)
    long = _mapped(parts.repartition("conv_id").sortWithinPartitions("conv_id", "uid"), _assemble, REPORT)
    report = done.select(*[f.split(" ")[0] for f in REPORT.split(", ")]).unionByName(long)
    messages = done.select("conv_id", "uid", F.posexplode("lines").alias("nth", "line")).unionByName(
        kept.select("conv_id", "uid", F.posexplode("lines").alias("nth", "line"))).select("conv_id", "uid", "nth", "line.role", "line.text")
    return report, messages


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults by a checksum of conversation and turn; a row that goes stays as a mark, ``dropped``."""
    def text(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("dropped"), F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")
