"""Conversation repair against a search over whole repaired conversations."""

import hashlib
import random
import re
from zlib import crc32

import pytest

from panelkit.llm import conversation_repair as C
from panelkit.llm import queries

SEEN = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}
LEGAL = {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}


def damage(rows):
    out = {}
    for c, t, r, x in rows:
        k = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        own = out.setdefault(c, [])
        if k:
            own += [(t, "user" if k == 4 else r, "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x)] * (2 if k == 3 else 1)
    return out


def repair(rows):
    """The contract's columns; the least (cost, audit) among all repairs, with its lines."""
    rows = sorted(rows, key=lambda y: (y[0] is not None, y[0] or 0, y[1].encode(), y[2].encode()))
    seen, fault = set(), []
    for _, r, x in rows:
        b = SEEN.findall(x)
        fault.append("b" if not b else "d" if (r, x) in seen else "t" if b[-1] not in ".!?" else "")
        seen.add((r, x))
    ts = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))

    def inserted(best):
        for _ in range(4):
            for q, o in [(q, best[NEXT[q]]) for q in best]:
                if o and (not best[q] or (o[0] + 3, "I" + o[1]) < best[q][:2]):
                    best[q] = (o[0] + 3, "I" + o[1], (FULL[NEXT[q]] + ":",) + o[2])
        return best

    best = inserted({"": (0, "", ()), "s": None, "u": None, "a": (0, "", ())})
    for (_, r, x), f in zip(reversed(rows), reversed(fault)):
        now = {}
        for q, o in best.items():
            ways = [(o[0] + 4, "D" + o[1], o[2])]
            if f not in ("b", "d"):
                more = 3 if f == "t" else 0
                if (q, r[:1]) in LEGAL:
                    o = best[r[:1]]
                    ways.append((o[0] + more, "K" + o[1], (f"{r}:{x}",) + o[2]))
                o = best[NEXT[q]]
                ways.append((o[0] + 3 + more, "R" + o[1], (f"{FULL[NEXT[q]]}:{x}",) + o[2]))
            now[q] = min(ways, key=lambda z: z[:2])
        best = inserted(now)
    cost, audit, lines = best[""]
    return (max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.fixture(scope="module")
def rows():
    rng, out = random.Random(5), []
    for c in range(60):
        n = rng.choice([1, 2, 3, 7, 30, 200])
        for i in range(n):
            out.append((c or None, rng.choice([i, i, i, None, i // 2]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
                        rng.choice(["a.", "b!", "c", "", None, "\t x?  ", "dd.", "ee", f"{i}.", f"{i}.", "é "])))
    out += [(2**60 + 1, 0, "user", "long " * 50000 + "."), (2**60 + 1, 1, "user", "no end"), (2**60 + 2, 0, "user", "ok.")]
    return out


@pytest.mark.parametrize("block", [1, 4, 64, None])
def test_equals_the_search_whatever_the_blocks(spark, rows, block):
    """Conversations in one stretch and in many, NULLs, ties, repeats, foreign roles."""
    turns = C.placed(C.damaged(spark.createDataFrame([r + (1,) for r in rows], "conv_id bigint, turn bigint, role string, text string, code int").repartition(5)))
    solved = C.solve(turns, block)
    found = {r["conv"]: tuple(r)[1:] for r in C.audits(solved).collect()}
    sha = {r["conv"]: r["sha256"] for r in C.digests(C.repaired(turns, solved)).collect()}
    gaps = {r["conv"]: r["gaps"] for r in C.turn_gaps(turns).collect()}
    for c, given in damage(rows).items():
        k = None if c is None else str(c)
        got = (gaps.get(k, 0), *found.get(k, (0, 0, 0, 0, 0, "")), sha.get(k, hashlib.sha256(b"").hexdigest()))
        assert got == repair(given), c


def test_a_long_conversation_passes_through_many_checkpoints(spark):
    rng = random.Random(1)
    rows = [(7, i, rng.choice(["user", "assistant"]), rng.choice(["yes.", "no", f"{i}.", f"{i}"])) for i in range(5000)]
    turns = C.placed(spark.createDataFrame(rows, "conv bigint, turn bigint, role string, text string"))
    solved = C.solve(turns, 128)
    assert solved.count() > 30
    fixed = C.repaired(turns, solved).orderBy("place", "nth").collect()
    assert [r["role"] for r in fixed] == ["user", "assistant"] * (len(fixed) // 2)
    given = [(t, r, x) for _, t, r, x in rows]
    want = repair(given)
    got = C.audits(solved).first()
    assert (got["cost"], got["audit"]) == want[5:7]
    assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in fixed).encode()).hexdigest() == want[7]


def test_query_on_all_conversations_and_on_none(spark, tmp_dir, rows):
    own = "conv_id bigint, turn bigint, role string, text string, conv int, place string"
    more = rows + [(c, 0, "user", "gone.") for c in range(900, 1000)]  # of some, the only row is dropped
    spark.createDataFrame([r + (1, "x") for r in more], own).write.parquet(f"{tmp_dir}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, tmp_dir).collect()}
    given = damage(more)
    assert any(not v for v in given.values())
    assert got == {c: repair(v) for c, v in given.items()}
    spark.createDataFrame([], own).write.parquet(f"{tmp_dir}/none/conversations.parquet")
    assert queries.op12_conversation_repair(spark, f"{tmp_dir}/none").count() == 0
