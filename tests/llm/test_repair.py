"""Conversation repair against plain searches: every edit list, uniform cost, blocks, whole tables, odd rows."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidepool.llm import queries, repair

CLASS = {"s": 0, "u": 1, "a": 2}
NEXT = {"su", "ua", "au"}


def well_formed(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (body != "" and len(body) % 2 == 0 and body == "ua" * (len(body) // 2))


def every_edit(codes, inserts=3):
    """Smallest (cost, audit) of all edit lists with at most ``inserts`` inserts."""
    best = None

    def go(at, left, initials, cost, audit):
        nonlocal best
        if at == len(codes) and well_formed(initials) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if left:
            for role in "ua":
                go(at, left - 1, initials + role, cost + 5, audit + "I")
        if at < len(codes):
            code = codes[at]
            stay = 5 if code & 8 else 0
            go(at + 1, left, initials, cost + 2, audit + "D")
            if not code & 4:
                go(at + 1, left, initials + "sua?"[code & 3], cost + stay, audit + "K")
                for role in "ua":
                    go(at + 1, left, initials + role, cost + 1 + stay, audit + "R")

    go(0, inserts, "", 0, "")
    return best


def uniform_cost(codes):
    """The same by a plain priority queue over (cost, audit)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, last = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(codes) and last in ("", "a"):
            return cost, audit
        follow = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, audit + "I", at, follow))
        if at < len(codes):
            code = codes[at]
            stay, role = 5 if code & 8 else 0, "sua?"[code & 3]
            heapq.heappush(heap, (cost + 2, audit + "D", at + 1, last))
            if not code & 4:
                heapq.heappush(heap, (cost + 1 + stay, audit + "R", at + 1, follow))
                if last + role in NEXT or (last == "" and role in "su"):
                    heapq.heappush(heap, (cost + stay, audit + "K", at + 1, role))


def some_codes(rng, n):
    return [rng.choice([0, 1, 1, 1, 2, 2, 2, 3]) + rng.choice([0, 0, 0, 0, 4, 8]) for _ in range(n)]


def test_search_equals_all_edit_lists():
    rng = random.Random(1)
    for _ in range(150):
        codes = some_codes(rng, rng.randint(0, 4))
        assert repair.solve(codes) == every_edit(codes) == uniform_cost(codes)


def test_search_equals_uniform_cost_on_long_rows():
    rng = random.Random(2)
    for n in (9, 30, 120, 250):
        for codes in (some_codes(rng, n), [1] * n, [2] * n, [0] * n, [9] * n, [5] * n):
            assert repair.solve(codes) == uniform_cost(codes)


def test_lower_bounds_are_lower():
    rng = random.Random(3)
    for _ in range(100):
        codes = some_codes(rng, rng.randint(1, 6))
        assert repair.lower_bounds(codes)[0][repair.START] <= repair.solve(codes)[0]


@pytest.mark.parametrize("size", [1, 3, 7])
def test_blocks_chain_to_the_whole(size):
    rng = random.Random(size)
    for n in (size, 2 * size, 20, 41):
        codes = some_codes(rng, n)
        chain = repair.Chain()
        for a in range(0, n, size):
            part = codes[a:a + size]
            chain.add(repair.block_solutions(part, a == 0, len(part) < size))
        assert chain.result() == repair.solve(codes)


def plain(rows):
    """The contract's result in plain Python from (conv_id, turn, role, text) rows."""
    after = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(name.encode()) % 20
        new = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        for copy in range(0 if fate == 0 else 2 if fate == 3 else 1):
            after[conv].append((turn is not None, turn or 0, role, text, copy, "user" if fate == 4 else role, new))
    out = {}
    for conv, kept in after.items():
        codes, seen, faults, turns = [], set(), [0, 0, 0], []
        kept = [(t if has else None, role, text) for has, t, _, _, _, role, text in sorted(kept)]
        for turn, role, text in kept:
            body = text.strip(" \t\n\v\f\r")
            kind = CLASS.get(role[:1], 3)
            if not body:
                faults[0], code = faults[0] + 1, kind + 4
            elif (role, text) in seen:
                faults[1], code = faults[1] + 1, kind + 4
            elif body[-1] not in ".!?":
                faults[2], code = faults[2] + 1, kind + 8
            else:
                code = kind
            seen.add((role, text))
            codes.append(code)
            turns += [turn] if turn is not None else []
        cost, audit = uniform_cost(codes)
        lines, last, i = [], "", 0
        for edit in audit:
            role, text = kept[i][1:] if edit != "I" else ("", "")
            i += edit != "I"
            if edit in "IR":
                role = "assistant" if last == "u" else "user"
            if edit != "D":
                lines.append(f"{role}:{text}")
                last = role[0]
        illegal = sum(a[1][:1] + b[1][:1] not in NEXT for a, b in zip(kept, kept[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def as_dict(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in repair.RESULT[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(queries.op11_conversation_repair(spark, SF_SMALL)) == plain(rows)


SCHEMA = "conv_id long, turn long, role string, text string, rn long, code int, turns long, cost long, audit string"


def odd_rows():
    rng = random.Random(5)
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, 1, "assistant", None), (1, None, None, "What?"),
            (2, 5, "", "no role."), (2, -3, "tool", "T."), (2, 9000, "user", "far away!"), (None, None, None, None),
            (None, 3, "user", "y" * 200_000 + "."), (3, None, "user", "a."), (3, None, "assistant", "b."),
            (4, 7, "system", "only."), (5, 0, "user", "ä" * 50 + "! "), (6, 2, "user", " \t\n\v\f\r")]
    rows += [(7, i, rng.choice(["user", "assistant", "system", "x"]), f"{rng.choice('abc')}{rng.choice('.?, ')}")
             for i in range(700)]
    rows += [(8, i // 3, "user", "Same.") for i in range(60)]
    return [(*r, 1, 2, 3, 4, "z") for r in rows]


def test_odd_rows_and_long_conversations(spark):
    rows = odd_rows()
    got = as_dict(repair.damaged_repair(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert got == plain([r[:4] for r in rows])
    none = repair.damaged_repair(spark.createDataFrame([], SCHEMA))
    assert none.columns == repair.RESULT and none.count() == 0


def test_a_conversation_that_loses_all_rows(spark):
    lost = next((c, 0, "user", "Hi.") for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = as_dict(repair.damaged_repair(spark.createDataFrame([(*lost, 1, 2, 3, 4, "z")], SCHEMA)))
    assert got == {lost[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_repaired_rows_are_well_formed_and_hash_alike(spark):
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    rows = repair.repaired_rows(repair.damage(df), ["o_role", "o_text", "copy"]).orderBy("conv_id", "place").collect()
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append(r)
    want = as_dict(repair.damaged_repair(df))
    for conv, kept in by.items():
        assert [r["place"] for r in kept] == list(range(len(kept)))
        assert well_formed("".join(r["role"][0] for r in kept))
        text = "\n".join(f"{r['role']}:{r['text']}" for r in kept)
        assert hashlib.sha256(text.encode()).hexdigest() == want[conv][-1]


def test_rows_are_split_over_tasks(spark):
    """The search runs on blocks of a conversation, not on whole conversations."""
    df = spark.createDataFrame([(7, i, "user", f"Text {i}.") for i in range(2000)], "conv_id long, turn long, role string, text string")
    numbered = repair.numbered_rows(df, ["role"])
    sizes = numbered.groupBy(F.expr(f"(rn - 1) div {repair.BLOCK}")).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) == repair.BLOCK
