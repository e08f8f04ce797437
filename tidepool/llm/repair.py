"""Conversation structure repair by depth-first branch and bound.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``.
Rows may be kept (cost 0), given another role (1) or deleted (2, forced for blank
and repeated rows); an empty turn may be inserted anywhere (5); a truncated row
that stays costs 5.  The repair is the cheapest list of edits; of equally cheap
ones the one whose initials (the audit, of ``D I K R``) come first in ASCII.

``solve`` searches with an explicit stack of (row, last role, cost, audit):

* *lower bounds*: the cheapest way to finish from every (row, last role) if system
  rows were welcome anywhere and a conversation might end with any role, summed
  from the end backwards;
* *incumbent*: the best complete (cost, audit); a node goes when its cost and
  bound exceed it, or equal it while its audit is already later;
* *dominance*: per (row, last role) the best (cost, audit) that has reached it; a
  worse prefix goes.  This loses nothing: what follows depends on the node alone,
  and of two prefixes of one cost at one node neither begins the other (an audit
  that goes on with inserts costs more), so their order is settled.

The search ends when the stack is empty, which proves the incumbent.

A conversation of any length is searched in blocks of ``BLOCK`` rows, in any
number of tasks: a block is solved for every role before it and every role after
it, and the blocks' solutions are chained per conversation (at most 16 of them a
block).  The rows themselves pass through one task in order once, as the hash of
a repaired conversation needs them so; that task holds the audit and one Arrow
batch.

Edge cases: nulls in role or text read as one blank; a null turn comes first and
counts in no gap; rows of one turn are ordered by role, then text; repeated rows
are rows.  A null conversation id is a conversation.  An empty role, or one with
another initial, cannot be kept.  An empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import cut
from tidepool.operators.sequence import sequence_number

BLANKS = " \t\n\u000b\f\r"
BLOCK = 256
TURNS = 4096                       # turns of a conversation that are numbered together
SYSTEM, USER, ASSISTANT, OTHER = range(4)
START, AFTER_S, AFTER_U, AFTER_A = range(4)    # the last role of a prefix
ENDS = (START, AFTER_A)            # where a well-formed conversation may end
DELETE_ONLY, TRUNCATED = 4, 8      # added to a row's role in its code
KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
UNFINISHED = 5                     # for a truncated row that stays
ANY_END = -1

#: (last role, role of a kept row) -> last role
FOLLOWS = {(START, SYSTEM): AFTER_S, (START, USER): AFTER_U, (AFTER_S, USER): AFTER_U,
           (AFTER_U, ASSISTANT): AFTER_A, (AFTER_A, USER): AFTER_U}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def other_turn(last: int) -> int:
    """Last role after the only user or assistant turn that may follow ``last``."""
    return AFTER_A if last == AFTER_U else AFTER_U


def lower_bounds(codes: list[int]) -> list[list[int]]:
    """Per row and last role, a cost that no way to finish undercuts (see the module's docstring)."""
    ahead = [0] * 4
    out = [ahead]
    for code in reversed(codes):
        kind, stay = code & 3, UNFINISHED if code & TRUNCATED else 0
        row = []
        for last in range(4):
            best = DELETE + ahead[last]
            if not code & DELETE_ONLY:
                best = min(best, REROLE + stay + ahead[other_turn(last)])
                if kind == SYSTEM:
                    best = min(best, stay + ahead[AFTER_S if last == START else last])
                elif (last, kind) in FOLLOWS:
                    best = min(best, stay + ahead[FOLLOWS[last, kind]])
            row.append(best)
        row = [min(row[last], INSERT + row[other_turn(last)]) for last in range(4)]
        out.append(ahead := row)
    return out[::-1]


def solve(codes: list[int], entry: int = START, ends: tuple[int, ...] = ENDS,
          bounds: list[list[int]] | None = None) -> tuple[int, str] | None:
    """Cheapest ``(cost, audit)`` that leads over all rows from role ``entry`` to one of ``ends``; None if none does."""
    bounds = lower_bounds(codes) if bounds is None else bounds
    n, best = len(codes), None
    seen: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(n + 1)]
    seen[0][entry] = (0, "")
    stack = [(0, entry, 0, "")]

    def hopeless(at: int, last: int, cost: int, audit: str) -> bool:
        if best is None:
            return False
        f = cost + bounds[at][last]
        return f > best[0] or (f == best[0] and audit > best[1][:len(audit)])

    while stack:
        at, last, cost, audit = stack.pop()
        if seen[at][last] != (cost, audit) or hopeless(at, last, cost, audit):
            continue
        if at == n and last in ends and (best is None or (cost, audit) < best):
            best = (cost, audit)
        after = other_turn(last)
        steps = [(at, after, cost + INSERT, audit + "I")]
        if at < n:
            code = codes[at]
            stay = UNFINISHED if code & TRUNCATED else 0
            steps.append((at + 1, last, cost + DELETE, audit + "D"))
            if not code & DELETE_ONLY:
                steps.append((at + 1, after, cost + REROLE + stay, audit + "R"))
                kept = FOLLOWS.get((last, code & 3))
                if kept is not None:
                    steps.append((at + 1, kept, cost + KEEP + stay, audit + "K"))
        # the most promising goes on top
        steps.sort(key=lambda s: (s[2] + bounds[s[0]][s[1]], s[3]), reverse=True)
        for step in steps:
            i, role, c, a = step
            if (old := seen[i][role]) is not None and old <= (c, a) or hopeless(*step):
                continue
            seen[i][role] = (c, a)
            stack.append(step)
    return best


def block_solutions(codes: list[int], first: bool, last: bool) -> list[tuple[int, int, int, str]]:
    """``(entry, exit, cost, audit)`` of a block; ``exit`` is ``ANY_END`` in a conversation's last block."""
    bounds, out = lower_bounds(codes), []
    for entry in (START,) if first else range(4):
        for name, ends in [(ANY_END, ENDS)] if last else [(s, (s,)) for s in range(4)]:
            found = solve(codes, entry, ends, bounds)
            if found:
                out.append((entry, name, *found))
    return out


class Chain:
    """Best (cost, audit) of a conversation's blocks so far, for every last role."""

    def __init__(self):
        self.best = {START: (0, None)}      # last role -> cost, (chain before, audit of the block)

    def _earlier(self, a, b) -> bool:
        """Whether audit chain ``a`` sorts before ``b`` (of equal length in blocks)."""
        x, y = [], []
        while a is not b:
            x.append(a[1])
            y.append(b[1])
            a, b = a[0], b[0]
        return "".join(reversed(x)) < "".join(reversed(y))

    def add(self, solutions) -> None:
        new = {}
        for entry, exit, cost, audit in solutions:
            if entry in self.best:
                total, node = self.best[entry][0] + cost, (self.best[entry][1], audit)
                old = new.get(exit)
                if old is None or total < old[0] or (total == old[0] and self._earlier(node, old[1])):
                    new[exit] = (total, node)
        self.best = new

    def result(self) -> tuple[int, str]:
        ends = [v for k, v in self.best.items() if k in (*ENDS, ANY_END)]
        cost, node = ends[0]
        for c, other in ends[1:]:
            if c < cost or (c == cost and self._earlier(other, node)):
                cost, node = c, other
        parts = []
        while node is not None:
            parts.append(node[1])
            node = node[0]
        return cost, "".join(reversed(parts))


class Replay:
    """Repaired rows of a conversation, row by row, from its audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, START

    def inserts(self) -> Iterator[tuple[str, str]]:
        """Turns inserted before the next row, or after the last one."""
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.last = other_turn(self.last)
            yield ("assistant" if self.last == AFTER_A else "user"), ""

    def row(self, role: str, text: str, code: int) -> Iterator[tuple[str, str]]:
        """Inserted turns before the row, then the row unless it is deleted."""
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.last = FOLLOWS[self.last, code & 3]
            yield role, text
        elif edit == "R":
            self.last = other_turn(self.last)
            yield ("assistant" if self.last == AFTER_A else "user"), text


# --- on tables -------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, o_role, o_text, copy`` of the rows after the stated damage.

    By ``crc32(conv_id:turn) % 20``: 0 drops the row, 1 empties its text, 2 takes
    its ``.!?`` out, 3 repeats it, 4 sets role user.  Nulls read as one blank.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), blank))
    out = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("o_role"),
                      F.coalesce("text", blank).alias("o_text"), (F.crc32(name) % 20).alias("fate"))
    text = (F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("o_text", ".!?", ""))
            .otherwise(F.col("o_text")))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return out.filter("fate <> 0").select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("o_role")).alias("role"), text.alias("text"),
        "o_role", "o_text", F.explode(copies).alias("copy"))


def _code(role: Column, text: Column, repeated: Column) -> Column:
    body = F.btrim(text, F.lit(BLANKS))
    initial = F.substring(role, 1, 1)
    kind = (F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER))
    fault = (F.when((body == "") | repeated, DELETE_ONLY)
             .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0))
    return kind, fault, body == ""


def numbered_rows(rows: DataFrame, order: list[str]) -> DataFrame:
    """``conv_id, rn, turn, role, text, code, blank``: rows in order with their role and fault codes."""
    rows = rows.withColumn("turns", F.expr(f"turn div {TURNS}"))
    rows = sequence_number(rows, ["conv_id"], ["turn", *order], ["turns"], "rn")
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy("rn")
    rows = rows.withColumn("again", F.row_number().over(same) > 1)
    kind, fault, blank = _code(F.col("role"), F.col("text"), F.col("again"))
    return rows.select("conv_id", "rn", "turn", "role", "text", (kind + fault).alias("code"), blank.alias("blank"))


def audits(numbered: DataFrame) -> DataFrame:
    """``conv_id, cost, audit`` of every conversation that has rows."""
    kind = dict(numbered.dtypes)["conv_id"]
    blocks = (numbered.select("conv_id", F.expr(f"(rn - 1) div {BLOCK}").alias("blk"), "rn", "code")
              .groupBy("conv_id", "blk").agg(F.sort_array(F.collect_list(F.struct("rn", "code"))).alias("codes"))
              .select("conv_id", "blk", "codes.code"))
    solution = "array<struct<entry:int,exit:int,cost:long,audit:string>>"
    solution_type = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()),
                                        ("audit", pa.string())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple, list] = {}       # short conversations look alike
            out = []
            for blk, codes in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                key = (blk == 0, *codes)
                if key not in known:
                    known[key] = [dict(zip(("entry", "exit", "cost", "audit"), s))
                                  for s in block_solutions(codes, blk == 0, len(codes) < BLOCK)]
                out.append(known[key])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, solution_type)],
                                             names=["conv_id", "blk", "solutions"])

    solved = cut(blocks.mapInArrow(search, f"conv_id {kind}, blk long, solutions {solution}"), "repair-blocks")
    # a conversation of one block has its answer; the blocks of longer ones are chained in order
    rows = solved.repartition("conv_id").sortWithinPartitions("conv_id", "blk")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, open_ = None, None
        for batch in batches:
            out = []
            for conv, blk, solutions in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if blk == 0:
                    if open_:
                        out.append((now, *open_.result()))
                    now, open_ = conv, Chain()
                open_.add([(s["entry"], s["exit"], s["cost"], s["audit"]) for s in solutions])
            yield _audit_batch(out, batch.schema.field(0).type)
        if open_:
            yield _audit_batch([(now, *open_.result())], batch.schema.field(0).type)

    return rows.mapInArrow(chain, f"conv_id {kind}, cost long, audit string")


def _audit_batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    ids, cost, audit = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(cost, pa.int64()), pa.array(audit, pa.string())],
                                      names=["conv_id", "cost", "audit"])


def _in_order(conversations: DataFrame, numbered: DataFrame, found: DataFrame) -> DataFrame:
    """One sorted stream: each conversation's name (rn -1), its audit (rn 0), then its rows."""
    none = {"turn": "long", "role": "string", "text": "string", "code": "int", "blank": "boolean", "cost": "long"}

    def fill(df: DataFrame, **have: Column) -> DataFrame:
        return df.select("conv_id", *[have.get(c, F.lit(None).cast(t)).alias(c) for c, t in {"rn": "long", **none}.items()])

    stream = fill(conversations.select("conv_id").distinct(), rn=F.lit(-1).cast("long"))
    stream = stream.unionByName(fill(found, rn=F.lit(0).cast("long"), text=F.col("audit"), cost=F.col("cost")))
    stream = stream.unionByName(fill(numbered, **{c: F.col(c) for c in ("rn", "turn", "role", "text", "code", "blank")}))
    return stream.repartition("conv_id").sortWithinPartitions("conv_id", "rn")


class _Tally:
    """Counts and hash of the conversation that streams by."""

    def __init__(self, conv):
        self.conv, self.cost, self.audit = conv, 0, ""
        self.low = self.high = self.prev = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.lines = 0
        self.hash, self.replay = hashlib.sha256(), Replay("")

    def put(self, turns) -> None:
        for role, text in turns:
            self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self, rn, turn, role, text, code, blank, cost) -> None:
        if rn == 0:
            self.cost, self.audit, self.replay = cost, text, Replay(text)
        elif rn > 0:
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.turns += turn != self.high
                self.high = turn
            self.blank += blank
            self.duplicate += not blank and bool(code & DELETE_ONLY)
            self.truncated += bool(code & TRUNCATED)
            self.illegal += self.prev is not None and (self.prev, code & 3) not in LEGAL
            self.prev = code & 3
            self.put(self.replay.row(role, text, code))

    def end(self) -> tuple:
        self.put(self.replay.inserts())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, self.audit,
                self.hash.hexdigest())


RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repair(conversations: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """One row per conversation id of ``conversations``: faults, cost, audit and hash of the repaired ``rows``.

    ``rows`` has ``conv_id, turn, role, text`` and the columns ``order`` that settle
    the order of rows of one turn.
    """
    numbered = cut(numbered_rows(rows, order), "repair-rows")
    stream = _in_order(conversations, numbered, cut(audits(numbered), "repair-audits"))
    kind = dict(conversations.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, schema = None, None
        for batch in batches:
            out = []
            schema = schema or pa.schema([("conv_id", batch.schema.field(0).type), *[(c, pa.int64()) for c in RESULT[1:7]],
                                          ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] == -1:
                    if tally:
                        out.append(tally.end())
                    tally = _Tally(conv)
                tally.row(*row)
            yield pa.RecordBatch.from_pylist([dict(zip(RESULT, r)) for r in out], schema)
        if tally:
            yield pa.RecordBatch.from_pylist([dict(zip(RESULT, tally.end()))], schema)

    schema = f"conv_id {kind}, " + ", ".join(f"{c} long" for c in RESULT[1:7]) + ", audit string, repaired_sha256 string"
    return stream.mapInArrow(run, schema)


def repaired_rows(rows: DataFrame, order: list[str]) -> DataFrame:
    """``conv_id, place, role, text``: the repaired conversations themselves."""
    numbered = cut(numbered_rows(rows, order), "repair-rows")
    stream = _in_order(rows, numbered, cut(audits(numbered), "repair-audits"))
    kind = dict(rows.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, now, place, schema = Replay(""), None, 0, None
        for batch in batches:
            out = []
            schema = schema or pa.schema([("conv_id", batch.schema.field(0).type), ("place", pa.int64()),
                                          ("role", pa.string()), ("text", pa.string())])

            def put(turns) -> None:
                nonlocal place
                for role, text in turns:
                    out.append({"conv_id": now, "place": place, "role": role, "text": text})
                    place += 1

            for conv, rn, _, role, text, code, _, _ in zip(*(c.to_pylist() for c in batch.columns)):
                if rn == -1:
                    put(replay.inserts())
                    replay, now, place = Replay(""), conv, 0
                elif rn == 0:
                    replay = Replay(text)
                else:
                    put(replay.row(role, text, code))
            yield pa.RecordBatch.from_pylist(out, schema)
        if schema:
            out = []
            put(replay.inserts())
            yield pa.RecordBatch.from_pylist(out, schema)

    return stream.mapInArrow(run, f"conv_id {kind}, place long, role string, text string")


def damaged_repair(conversations: DataFrame) -> DataFrame:
    """Damage all rows (see ``damage``), then repair them."""
    return repair(conversations, damage(conversations), ["o_role", "o_text", "copy"])
