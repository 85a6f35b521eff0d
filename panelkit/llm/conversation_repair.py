"""Conversation structure repair by a square-root checkpointed dynamic programme.

The roles of a conversation must read ``(s?(ua)+)?``: an optional system turn, then
pairs of user and assistant. The cheapest edits that bring it there, and of the
cheapest the ASCII-least, are a shortest path over four states (nothing yet, after
the system turn, after user, after assistant):

* Keep (0) a row whose role may follow, Rerole (3) it to the role due, Delete (4) it,
  Insert (3) an empty turn of the role due; blank and repeated rows must be deleted,
  and a truncated row that stays costs 3 more.

1. The rows are range-partitioned by (conversation, turn, role, text) and written once
   with their place. A conversation of a third of all rows is spread over many tasks.
2. The places fall into blocks of about sqrt(rows). A task turns each conversation's
   stretch of a block into one byte a row; a stretch that may go on in another block
   also gives its transfer costs (state in to state out).
3. Checkpoints: backward cost vectors are kept only at the stretches' ends, chained
   from a conversation's last stretch to its first (at most about sqrt(rows) small rows).
4. The stretches are walked forward, each recomputing its own vectors (again with
   checkpoints every sqrt(length) rows) and taking the ASCII-least tight edit.

A vector less its least entry takes few values, so a step is one lookup in a table
that fills as it is used.

Defined results: NULL role or text is one space; NULL turns come first; rows of the
same turn are ordered by role and text; rows equal in all are repeats of one another;
NULL conversations are one conversation; other columns are ignored; an empty table has
no conversations. A role counts by its first character.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, materialize, partitions, released

SPACE = " \t\n\x0b\x0c\r"
INSERT, REROLE, DELETE, TRUNCATED = 3, 3, 4, 3
MUST, CUT, REPEAT, BLANK = 4, 8, 16, 32  # bits of a row's byte above its role class (0 s, 1 u, 2 a, 3 other)
_BIG = 1 << 40
_DUE = (2, 2, 3, 2)  # the state an inserted or reroled turn leads to
_AFTER = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by role class: state in -> state out of a kept row


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by crc32(``conv:turn``) % 20: 0 dropped, 1 emptied, 2 without ``[.!?]``, 3 twice, 4 role user."""
    say = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.encode(F.concat(say(conv), F.lit(":"), say(turn)), "UTF-8")) % 20
    rows = conversations.select(col(conv).alias("conv"), col(turn).alias("turn"), say(role).alias("role"), say(text).alias("text"), k.alias("k"))
    return (rows.where("k <> 0").select(
        "conv", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy"))


class _Paths:
    """Backward vectors and tight edits by lookup."""

    def __init__(self):
        self.vectors, self.ids, self.steps, self.edits = [], {}, {}, {}

    def known(self, v) -> tuple[int, int]:
        """(number of the vector less its least entry, that entry)."""
        low = min(v)
        key = tuple(min(x - low, _BIG) for x in v)
        if key not in self.ids:
            self.ids[key] = len(self.vectors)
            self.vectors.append(key)
        return self.ids[key], low

    @staticmethod
    def relaxed(v) -> list:
        """With inserted turns: two suffice, a third would come back to the same state."""
        for _ in range(2):
            v = [min(x, INSERT + v[_DUE[q]]) for q, x in enumerate(v)]
        return v

    @staticmethod
    def costs(nxt, code: int) -> list:
        """Per state: (edit, cost with what follows, state out) of one row, without inserts."""
        out = []
        for q in range(4):
            ways = [("D", DELETE + nxt[q], q)]
            if not code & MUST:
                extra = TRUNCATED if code & CUT else 0
                kept = _AFTER[code & 3].get(q)
                if kept is not None:
                    ways.append(("K", extra + nxt[kept], kept))
                ways.append(("R", extra + REROLE + nxt[_DUE[q]], _DUE[q]))
            out.append(ways)
        return out

    def step(self, nxt: int, code: int) -> tuple[int, int]:
        """(vector before the row, what it adds) from the vector after it."""
        got = self.steps.get((nxt, code))
        if got is None:
            v = self.relaxed([min(w[1] for w in ways) for ways in self.costs(self.vectors[nxt], code)])
            got = self.steps[nxt, code] = self.known(v)
        return got

    def edit(self, nxt: int, code: int, q: int) -> tuple[str, int]:
        """(ASCII-least tight edits up to and with the row, state out)."""
        got = self.edits.get((nxt, code, q))
        if got is None:
            ways = self.costs(self.vectors[nxt], code)
            v, s, at = self.relaxed([min(w[1] for w in x) for x in ways]), "", q
            while got is None:
                options = [(e, to) for e, c, to in ways[at] if c == v[at]]
                if INSERT + v[_DUE[at]] == v[at]:
                    options.append(("I", _DUE[at]))
                e, to = min(options)
                s, at = s + e, to
                if e != "I":
                    got = self.edits[nxt, code, q] = (s, at)
        return got

    def backward(self, codes: bytes, v) -> list:
        """The vector before the first row, given that after the last."""
        i, total = self.known(v)
        for c in reversed(codes):
            i, more = self.step(i, c)
            total += more
        return [min(x + total, _BIG) for x in self.vectors[i]]

    def walk(self, codes: bytes, v, q: int) -> tuple[list[str], int]:
        """(edits of each row, state out): vectors are kept every sqrt(n) rows, the rest made again block by block."""
        n = len(codes)
        gap = max(1, math.isqrt(n))
        i = self.known(v)[0]
        marks = {n: i}
        for k in range(n - 1, -1, -1):
            i = self.step(i, codes[k])[0]
            if k % gap == 0:
                marks[k] = i
        out = []
        for lo in range(0, n, gap):
            hi = min(n, lo + gap)
            i, after = marks[hi], []
            for k in range(hi - 1, lo - 1, -1):
                after.append(i)
                i = self.step(i, codes[k])[0]
            for k, i in zip(range(lo, hi), reversed(after)):
                s, q = self.edit(i, codes[k], q)
                out.append(s)
        return out, q


END = (0, 2 * INSERT, INSERT, 0)  # what is still to insert when the rows are over


def _finish(q: int) -> str:
    return "I" * (END[q] // INSERT)


def _transfers(paths: _Paths, codes: bytes) -> list[int]:
    """Costs from state in to state out, row by row of the matrix."""
    cols = [paths.backward(codes, [0 if r == x else _BIG for x in range(4)]) for r in range(4)]
    return [cols[r][q] for q in range(4) for r in range(4)]


PIECES = ("conv string, block long, edge boolean, first long, n long, blank long, duplicate long, truncated long, "
          "illegal long, head int, tail int, codes binary, costs array<long>")


def _pieces(group: pd.DataFrame) -> pd.DataFrame:
    """One block: rows (place, conv, byte) and the places of first occurrences (byte NULL) -> its stretches."""
    seen = group.loc[group["code"].isna(), "place"].to_numpy(np.int64)
    rows = group[group["code"].notna()].sort_values("place")
    place, code = rows["place"].to_numpy(np.int64), rows["code"].to_numpy(np.int64).astype(np.uint8)
    repeat = ~np.isin(place, seen)
    code |= (repeat * REPEAT).astype(np.uint8)
    code |= (((code & BLANK) > 0) | repeat).astype(np.uint8) * np.uint8(MUST)
    conv = rows["conv"]
    null = conv.isna().to_numpy()
    values = conv.to_numpy()
    new = np.ones(len(rows), bool)
    new[1:] = (null[1:] != null[:-1]) | (~null[1:] & (values[1:] != values[:-1]))
    cuts = np.append(np.flatnonzero(new), len(rows))
    paths, out = _Paths(), []
    block = int(group["block"].iloc[0])
    for j, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        c = code[lo:hi]
        cls, edge = c & 3, j == 0 or hi == len(rows)
        pair = cls[:-1] * 4 + cls[1:]
        blank, dup = (c & BLANK) > 0, (c & REPEAT) > 0
        codes = (c & 15).tobytes()
        out.append((None if null[lo] else values[lo], block, edge, int(place[lo]), hi - lo, int(blank.sum()), int((dup & ~blank).sum()),
                    int(((c & CUT > 0) & ~blank & ~dup).sum()), int((~np.isin(pair, (1, 6, 9))).sum()), int(cls[0]), int(cls[-1]),
                    codes, _transfers(paths, codes) if edge else None))
    return pd.DataFrame(out, columns=["conv", "block", "edge", "first", "n", "blank", "duplicate", "truncated", "illegal", "head", "tail", "codes", "costs"])


def _back(group: pd.DataFrame) -> pd.DataFrame:
    """Checkpoints of one conversation: the cost vector after each stretch."""
    g = group.sort_values("first").reset_index(drop=True)
    v, out = list(END), []
    for k in range(len(g) - 1, -1, -1):
        m = g["costs"][k]
        after, v = v, _Paths.relaxed([min(int(m[4 * q + r]) + v[r] for r in range(4)) for q in range(4)])
        joint = int(k > 0 and g["tail"][k - 1] * 4 + g["head"][k] not in (1, 6, 9))
        out.append((g["first"][k], after, k == len(g) - 1, joint))
    return pd.DataFrame(out, columns=["first", "after", "last", "joint"])


def _exits(batches):
    """The state out of each stretch for every state in."""
    paths = _Paths()
    for b in batches:
        got = [[paths.walk(c, v, q)[1] for q in range(4)] for c, v in zip(b.column("codes").to_pylist(), b.column("after").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("first"), b.column("conv"), pa.array(got, pa.list_(pa.int32()))], ["first", "conv", "exits"])


def _forward(group: pd.DataFrame) -> pd.DataFrame:
    """The state in of each stretch of one conversation."""
    g, q, out = group.sort_values("first"), 0, []
    for first, exits in zip(g["first"], g["exits"]):
        out.append((first, q))
        q = int(exits[q])
    return pd.DataFrame(out, columns=["first", "entry"])


def _walked(batches):
    """The edits of each stretch, one string a row (trailing inserts are one string more), and their cost."""
    paths = _Paths()
    for b in batches:
        edits, costs, cols = [], [], b.to_pydict()
        for codes, v, q, last in zip(cols["codes"], cols["after"], cols["entry"], cols["last"]):
            own, q = paths.walk(codes, v if v is not None else END, q or 0)
            costs.append(sum(TRUNCATED for c, s in zip(codes, own) if c & CUT and s[-1] != "D"))
            edits.append(own + [_finish(q)] if last is not False else own)  # a stretch inside a block is a whole conversation
            costs[-1] += sum(INSERT * s.count("I") + REROLE * s.count("R") + DELETE * s.count("D") for s in edits[-1])
        keep = [x for x in b.schema.names if x not in ("after", "last")]
        yield pa.RecordBatch.from_arrays([*[b.column(x) for x in keep], pa.array(edits, pa.list_(pa.string())), pa.array(costs, pa.int64())],
                                         [*keep, "edits", "cost"])


def _edited(out: list) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), kinds)], ["place", "before", "role_now", "behind"])


def _turned(batches):
    """Stretches -> (place, roles inserted before the row, its role class now: -1 deleted, 3 as it was; roles inserted after it)."""
    out = []
    for b in batches:
        cols = b.to_pydict()
        for first, codes, q, edits in zip(cols["first"], cols["codes"], cols["entry"], cols["edits"]):
            if len(out) > 20000:
                yield _edited(out)
                out = []
            n, q = len(codes), q or 0
            for k, s in enumerate(edits):
                before = []
                for e in s:
                    if e == "I" or e == "R":
                        q = _DUE[q]
                        if e == "I":
                            before.append(q - 1)
                    elif e == "K":
                        q = _AFTER[codes[k] & 3][q]
                if k < n:
                    out.append([first + k, before, -1 if s[-1] == "D" else q - 1 if s[-1] == "R" else 3, []])
                elif before:
                    out[-1][3] = before
    if out:
        yield _edited(out)


def placed(rows: DataFrame) -> DataFrame:
    """``rows (conv, turn, role, text)`` written in order, with ``place`` (ascending, NULL turns first)
    and ``code`` (role class, blank, truncated); ``conv`` as a string. Equal rows are dealt by their place in the input: any order of them is the same."""
    end = F.rtrim("text", F.lit(SPACE))
    blank = F.length(end) == 0
    initial = F.substring("role", 1, 1)
    code = (F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
            + F.when(blank, BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(CUT))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("text"), F.asc("any")]
    out = (rows.select(F.col("conv").cast("string").alias("conv"), "turn", "role", "text", code.cast("int").alias("code"), F.monotonically_increasing_id().alias("any"))
           .repartitionByRange(partitions(rows), *order).sortWithinPartitions(*order).drop("any"))
    return materialize(out.withColumn("place", F.monotonically_increasing_id()), "turns")


def solve(turns: DataFrame, rows_per_block: int | None = None) -> DataFrame:
    """Stretches of ``turns`` (of :func:`placed`) with their counts, ``edits`` (a string a row) and ``cost``
    (at a conversation's first stretch). ``rows_per_block``: by default the power of two from sqrt(rows), 1024 at least."""
    n = turns.count()
    shift = max(10, math.ceil(math.log2(max(2, n)) / 2)) if rows_per_block is None else max(0, rows_per_block.bit_length() - 1)
    first = (turns.groupBy("conv", "role", F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("h")).agg(F.min("place").alias("place"))
             .select("place", "conv", F.lit(None).cast("int").alias("code")))
    rows = turns.select("place", "conv", "code").unionByName(first).withColumn("block", F.shiftright("place", shift))
    pieces = materialize(rows.groupBy("block").applyInPandas(_pieces, PIECES), "stretches")

    edges = pieces.where("edge")
    back = materialize(edges.select("conv", "first", "head", "tail", "costs").groupBy("conv").applyInPandas(
        _back, "first long, after array<long>, last boolean, joint long"), "checkpoints")
    exits = (edges.select("first", "conv", "codes").join(back.select("first", "after"), "first")
             .mapInArrow(released(_exits), "first long, conv string, exits array<int>"))
    entry = exits.groupBy("conv").applyInPandas(_forward, "first long, entry int")
    kept = {"first": "long", "conv": "string", "n": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long",
            "joint": "long", "codes": "binary", "entry": "int"}
    schema = ", ".join(f"{k} {t}" for k, t in kept.items()) + ", edits array<string>, cost long"
    whole = pieces.join(back, "first", "left").join(entry, "first", "left").withColumn("joint", F.coalesce("joint", F.lit(0)))
    return materialize(whole.select(*kept, "after", "last").mapInArrow(released(_walked), schema), "repairs")


def audits(solved: DataFrame) -> DataFrame:
    """Per conversation: ``blank, duplicate, truncated, illegal, cost, audit``."""
    return solved.withColumn("audit", F.array_join("edits", "")).groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.col("illegal") + F.col("joint")).alias("illegal"),
        F.sum("cost").alias("cost"),
        F.array_join(F.expr("transform(sort_array(collect_list(struct(first, audit))), x -> x.audit)"), "").alias("audit"))


def repaired(turns: DataFrame, solved: DataFrame) -> DataFrame:
    """The repaired rows ``(conv, place, nth, role, text)``: in order by ``place, nth`` (inserted turns share their row's place)."""
    edits = solved.select("first", "codes", "entry", "edits").mapInArrow(
        released(_turned), "place long, before array<int>, role_now int, behind array<int>")
    name = lambda k: f"if({k} = 1, 'user', 'assistant')"
    lines = F.expr(f"""concat(transform(before, k -> struct({name('k')} AS role, '' AS text)),
        if(role_now < 0, array(), array(struct(if(role_now = 3, role, {name('role_now')}) AS role, text AS text))),
        transform(behind, k -> struct({name('k')} AS role, '' AS text)))""")
    return (turns.select("conv", "place", "role", "text").join(edits, "place")
            .select("conv", "place", F.posexplode(lines).alias("nth", "line")).select("conv", "place", "nth", "line.role", "line.text"))


def _hashed(batches):
    """Rows in order -> one row a conversation; only the running hash is kept."""
    at, h = None, None
    digest = lambda rows: pa.RecordBatch.from_arrays([pa.array(list(x), pa.string()) for x in zip(*rows)], ["conv", "sha256"])
    for b in batches:
        done = []
        for conv, line in zip(b.column("conv").to_pylist(), b.column("line").to_pylist()):
            if h is not None and conv == at:
                h.update(b"\n" + line.encode())
            else:
                if h is not None:
                    done.append((at, h.hexdigest()))
                at, h = conv, hashlib.sha256(line.encode())
        if done:
            yield digest(done)
    if h is not None:
        yield digest([(at, h.hexdigest())])


def digests(fixed: DataFrame) -> DataFrame:
    """(conv, sha256) of a conversation's ``role:text`` lines. A SHA-256 is sequential: one task reads a conversation's rows, in order, as a stream."""
    rows = fixed.select("conv", "place", "nth", F.concat("role", F.lit(":"), "text").alias("line"))
    return (rows.repartition("conv").sortWithinPartitions("conv", "place", "nth").select("conv", "line")
            .mapInArrow(released(_hashed), "conv string, sha256 string"))


def turn_gaps(turns: DataFrame) -> DataFrame:
    """(conv, gaps): turns missing between the least and the greatest."""
    wide = lambda c: c.cast("decimal(38,0)")
    return turns.groupBy("conv").agg(F.coalesce((wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")).try_cast("bigint"), F.lit(0)).alias("gaps"))
