"""Spark-vs-DuckDB parity for the registered queries.

    python -m tests.parity [--partitions N] [sf_dir] [key ...]

Compares row count, column names and the order-insensitive multiset of rows
(floats compared exactly, then with 1e-9 relative tolerance).
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


# Spark simpleString -> DuckDB type name, for the schema part of the check.
SPARK_TO_DUCK = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, repr(v)) for v in row)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return [columns[i] for i in order], sorted(out, key=_key)


def close(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y) for x, y in zip(a, b))
    return a == b


def compare(spark, sf_dir: str, keys=None, con=None, verbose=True) -> dict:
    sys.path.insert(0, ".")
    import __spark_entry__ as E

    qs, sqls = E.queries(), E.oracle_sql()
    con = con or duck(sf_dir)
    report = {}
    for k in keys or list(qs):
        t0 = time.time()
        sdf = qs[k](spark, sf_dir)
        srows = [tuple(r) for r in sdf.collect()]
        scols, srows = rows_of(list(sdf.columns), srows)
        st = time.time() - t0
        if k not in sqls:
            report[k] = {"rows": len(srows), "oracle": None, "spark_s": round(st, 2)}
            if verbose:
                print(f"{k:28s} rows={len(srows):7d} (no oracle) {st:.2f}s")
            continue
        t0 = time.time()
        rel = con.sql(sqls[k])
        dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        dcols, drows = rows_of(list(rel.columns), rel.fetchall())
        dt = time.time() - t0
        stypes = {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes}
        types_ok = stypes == dtypes
        exact = scols == dcols and srows == drows
        tol = scols == dcols and len(srows) == len(drows) and all(
            close(a, b) for a, b in zip(srows, drows))
        report[k] = {"rows": len(srows), "oracle_rows": len(drows), "cols": scols == dcols,
                     "types": types_ok, "exact": exact and types_ok, "tolerant": tol,
                     "spark_s": round(st, 2),
                     "duck_s": round(dt, 3)}
        if verbose:
            print(f"{k:28s} rows={len(srows):7d}/{len(drows):7d} cols={scols == dcols} "
                  f"types={types_ok} exact={exact} tol={tol} spark={st:.2f}s duck={dt:.3f}s")
            if not types_ok:
                print("   spark types", stypes, "\n   duck  types", dtypes)
            if scols != dcols:
                print("   spark cols", scols, "\n   duck  cols", dcols)
            elif not exact:
                bad = [(a, b) for a, b in zip(srows, drows) if a != b][:3]
                for a, b in bad:
                    print("   spark", a, "\n   duck ", b)
    return report


if __name__ == "__main__":
    from panelkit.session import get_spark

    args = sys.argv[1:]
    parts = 8
    if args[:1] == ["--partitions"]:
        parts, args = int(args[1]), args[2:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or None
    spark = get_spark("local[8]", shuffle_partitions=parts)
    rep = compare(spark, sf, keys)
    bad = [k for k, v in rep.items() if v.get("oracle_rows") is not None and not v["exact"]]
    print("NOT EXACT:", bad)
