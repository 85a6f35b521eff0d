"""Exact top-k search by tiled matrix products.

Rows are dealt over shards by their id; every shard also receives every tile of
queries (queries x shards small blobs). A shard multiplies each query tile by
each of its row tiles, keeps the k best of every tile by partial selection, and
the per-query lists of the shards are merged in a tree (groups of ``fan``
shards first, then the groups).

Rules: vectors that are NULL or hold NULL or non-finite components, and rows
with a NULL id, take no part; vectors are compared only with vectors of the
same length; ties go to the smaller id; an id stands for one row, so a repeated
id enters a query's list once, with its best score, and rows with the query's
own id are not its candidates. An empty table gives an empty result. Scaled
components and scores that do not fit 64 bits are errors, never clipped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, partitions, released

ROW_TILE = 4096
QUERY_TILE = 1024
HELD_ROWS = 65536
_BLOB = "shard int, kind int, n int, dim int, ids binary, data binary"
_WHOLE = float(1 << 53)


def integer_vectors(df: DataFrame, id_col: str, vec_col: str, scale: int = 1024) -> DataFrame:
    """(id, v array<bigint>): floor(scale * x) of every usable vector."""
    x = col(vec_col).cast("array<double>")
    ok = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), F.lit(False)))

    def whole(c):
        y = c * F.lit(float(scale))
        return F.when(F.abs(y) < F.lit(float(1 << 63)), F.floor(y)).otherwise(
            F.raise_error(F.concat(F.lit("a component does not fit 64 bits: "), c.cast("string"))).cast("bigint"))

    return (df.select(col(id_col).cast("bigint").alias("id"), F.when(ok, x).alias("x"))
            .where("id is not null and x is not null").select("id", F.transform("x", whole).alias("v")))


def _blob(shard, kind, dim, ids, mat):
    return pa.RecordBatch.from_pydict({
        "shard": pa.array([shard], pa.int32()), "kind": pa.array([kind], pa.int32()),
        "n": pa.array([len(ids)], pa.int32()), "dim": pa.array([dim], pa.int32()),
        "ids": pa.array([ids.tobytes()], pa.binary()), "data": pa.array([mat.tobytes()], pa.binary())})


def _pack(kind: int, shards: int):
    """Blobs of rows: kind 0 dealt by id, kind 1 (queries) in tiles."""

    def flush(held):
        for dim, parts in held.items():
            ids, mat = (np.concatenate(x) for x in zip(*parts))
            if kind:
                for k in range(0, len(ids), QUERY_TILE):
                    yield _blob(0, 1, dim, ids[k:k + QUERY_TILE], mat[k:k + QUERY_TILE])
                continue
            with np.errstate(over="ignore"):
                to = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(shards)
            order = np.argsort(to, kind="stable")
            cut = np.searchsorted(to[order], np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(cut)):
                at = order[cut[s]:cut[s + 1]]
                yield _blob(int(s), 0, dim, ids[at], mat[at])

    @released

    def run(batches):
        held, n = {}, 0
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists = b.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = np.diff(lists.offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                mat = flat[(starts[at][:, None] + np.arange(dim)).ravel()].reshape(len(at), dim)
                held.setdefault(int(dim), []).append((ids[at], mat))
            n += len(ids)
            if n >= HELD_ROWS:
                yield from flush(held)
                held, n = {}, 0
        yield from flush(held)

    return run


def _scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Exact integer products: BLAS while every partial sum is a whole double."""
    hi = float(np.abs(q).max(initial=0)) * float(np.abs(m).max(initial=0)) * max(1, q.shape[1])
    if hi < _WHOLE:
        return (q.astype(np.float64) @ m.astype(np.float64).T).astype(np.int64)
    if hi < float(1 << 62):
        return q @ m.T
    out = q.astype(object) @ m.T.astype(object)
    if np.abs(out).max(initial=0) >= 1 << 63:
        raise OverflowError("an inner product does not fit 64 bits: use a smaller scale")
    return out.astype(np.int64)


def _best(row: np.ndarray, ids: np.ndarray, sc: np.ndarray, k: int):
    """The k best (score desc, id asc) of each row, an id once."""
    o = np.lexsort((-sc, ids, row))
    row, ids, sc = row[o], ids[o], sc[o]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
    row, ids, sc = row[new], ids[new], sc[new]
    o = np.lexsort((ids, -sc, row))
    row, ids, sc = row[o], ids[o], sc[o]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], ids[keep], sc[keep]


def _tile_best(q_ids, q, ids, mat, repeats, k):
    sc = _scores(q, mat)
    kk = min(k + repeats + 1, sc.shape[1])  # repeated ids and the query's own row may fall out
    thr = np.partition(sc, sc.shape[1] - kk, axis=1)[:, sc.shape[1] - kk]
    row, at = np.nonzero((sc >= thr[:, None]) & (q_ids[:, None] != ids[None, :]))
    return _best(row, ids[at], sc[row, at], k)


def _tiles(blobs: list) -> dict:
    """The shard's rows by vector length, in tiles sorted by id."""
    out: dict[int, list] = {}
    for dim in {d for d, _, _ in blobs}:
        ids = np.concatenate([i for d, i, _ in blobs if d == dim])
        mat = np.concatenate([m for d, _, m in blobs if d == dim])
        o = np.argsort(ids, kind="stable")
        ids, mat = ids[o], mat[o]
        for k in range(0, len(ids), ROW_TILE):
            t = ids[k:k + ROW_TILE]
            out.setdefault(dim, []).append((t, mat[k:k + ROW_TILE], len(t) - len(np.unique(t))))
    return out


def _search(k: int, fan: int):
    @released
    def run(batches):
        blobs, tiles = [], None
        for b in batches:
            for r in b.to_pylist():
                ids = np.frombuffer(r["ids"], np.int64)
                mat = np.frombuffer(r["data"], np.int64).reshape(r["n"], r["dim"])
                if r["kind"] == 0:
                    blobs.append((r["dim"], ids, mat))
                    continue
                if tiles is None:
                    tiles, blobs = _tiles(blobs), []
                got = [_tile_best(ids, mat, *t, k) for t in tiles.get(r["dim"], [])]
                if not got:
                    continue
                row, cand, sc = _best(*(np.concatenate(x) for x in zip(*got)), k)
                cut = np.searchsorted(row, np.arange(len(ids) + 1))
                lists = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(-sc, pa.int64()), pa.array(cand, pa.int64())], names=["neg", "vec_id"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([r["shard"] // fan] * len(ids), pa.int32()), lists],
                    names=["query_id", "block", "top"])

    return run


def exact_topk(rows: DataFrame, queries: DataFrame, k: int = 10, shards: int | None = None,
               fan: int = 16) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k largest integer inner
    products over all ``rows`` (both ``(id, v array<bigint>)``). ``shards``
    (default: the shuffle partitions) sets how much of the rows one task holds."""
    s = shards or partitions(rows)
    tiles = max(1, -(-queries.count() // QUERY_TILE))  # a count, not rows
    cand = rows.mapInArrow(_pack(0, s), _BLOB)
    qt = (queries.repartition(tiles, "id").mapInArrow(_pack(1, s), _BLOB)
          .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(s - 1)))))
    dealt = cand.unionByName(qt).repartitionById(s, "shard").sortWithinPartitions("kind")
    found = dealt.mapInArrow(_search(k, fan),
                             "query_id bigint, block int, top array<struct<neg:bigint,vec_id:bigint>>")

    def merged(df, *keys):  # ids are dealt by value, so the lists of a query share none
        alls = F.array_sort(F.array_distinct(F.flatten(F.collect_list("top"))))
        return df.groupBy(*keys).agg(F.slice(alls, 1, k).alias("top"))

    tree = merged(merged(found, "query_id", "block"), "query_id")
    return tree.select("query_id", F.posexplode("top").alias("p", "t")).select(
        "query_id", (F.col("p") + 1).alias("rank"), F.col("t.vec_id").alias("vec_id"),
        (-F.col("t.neg")).alias("score"))


def every_nth(n: int) -> Column:
    return F.pmod(F.col("id"), F.lit(n)) == 0
