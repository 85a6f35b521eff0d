"""Quality rules: base statistics of every document, and robust multivariate
outliers among documents that pass the base rules.

Each (language, source) group gets a minimum-covariance-determinant estimate of
centre and scatter of five transformed statistics, and documents whose
Mahalanobis distance from it exceeds a chi-square quantile are rejected.

The estimate is the deterministic MCD scheme run as Spark aggregations over all
rows: start from coordinate-wise medians and MADs (from fixed-grid histograms),
then concentration steps: each step bins the rows' distances, takes the
``support`` share with the smallest distances (whole bins), and replaces centre and
scatter by their mean and covariance, made consistent for normal data; a last
step reweights by the 97.5 % quantile. A step is one partially aggregated
group-by over (group, bin) with 21 sums, so a source with a third of all rows is
no hot key; the linear algebra sees one group's few bins at a time.

A group with fewer than ``min_rows`` usable rows takes its language's estimate,
then the whole corpus'. ``floor`` is added to every variance: it keeps the scatter
regular where most documents share a value (no symbols at all), and says that
differences of less than half a logarithmic unit are never an anomaly.

Rules: a NULL text has no words and fails the base rule; a NULL language or
source is a group of its own; copies and repeated rows count as rows; an empty table gives
no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import col, materialize, released

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
P = 5
GRID = 0.02
# log of words, letters per word, symbols, repeated lines and repeated words per word
FEATURES = ("ln(n_words)", "4 * ln(word_chars / n_words)", "ln(1 + 100 * n_symbols / n_words)",
            "ln(1 + 100 * n_dup_lines / n_words)", "ln(1 + 100 * n_repeat_words / n_words)")


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """The five base statistics of one text."""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return 0, 0, len(SYMBOL.findall(text)), 0, 0
    repeated = 0
    if n > 5:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
        if len(set(windows)) < len(windows):
            count, upto = Counter(windows), 0
            for i, w in enumerate(windows):
                if count[w] > 1:
                    repeated += i + 5 - max(i, upto)
                    upto = i + 5
    lines = Counter(text.split("\n"))
    dup = sum(c - 1 for line, c in lines.items() if c > 1 and WORD.search(line))
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), dup, repeated


def _stats(keep: int, names: list[str]):
    @released
    def run(batches):
        for b in batches:
            got = np.array([statistics(x.as_py() or "") for x in b.column(b.num_columns - 1)], np.int64).reshape(-1, P)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(keep)), *(pa.array(got[:, k]) for k in range(P))],
                                             names=[*names, *STATS])

    return run


def _chi2_cdf(x: float, df: int) -> float:
    """Series of the regularised lower incomplete gamma function."""
    a, x = df / 2, x / 2
    if x <= 0:
        return 0.0
    if x > 200:
        return 1.0
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))


def chi2_quantile(q: float, df: int) -> float:
    lo, hi = 0.0, 400.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, df) < q else (lo, mid)
    return (lo + hi) / 2


def _consistency(share: float) -> float:
    """What the scatter of the innermost ``share`` of normal data is too small by."""
    if share >= 1:
        return 1.0
    return share / _chi2_cdf(chi2_quantile(share, P), P + 2)


_PARAMS = ", ".join(["lang string", "source string", "level int", "n bigint", *(f"m{i} double" for i in range(P)),
                     *(f"w{i}{j} double" for i in range(P) for j in range(i, P))])


def _row(key, n, centre, cov, floor):
    inv = np.linalg.inv(cov + np.eye(P) * floor)
    out = {"lang": key[0], "source": key[1], "level": int(key[2]), "n": int(n)}
    out |= {f"m{i}": centre[i] for i in range(P)}
    return pd.DataFrame([out | {f"w{i}{j}": inv[i, j] * (1 if i == j else 2) for i in range(P) for j in range(i, P)}])


def _start(floor: float):
    def run(key, pdf):
        centre, spread, n = np.zeros(P), np.zeros(P), 0
        for i, g in pdf.groupby("i"):
            v, c = g["b"].to_numpy() * GRID, g["c"].to_numpy()
            n = c.sum()

            def median(x, w):
                o = np.argsort(x, kind="stable")
                return x[o][np.searchsorted(np.cumsum(w[o]), (w.sum() + 1) // 2)]

            centre[i] = median(v, c)
            spread[i] = 1.4826 * median(np.abs(v - centre[i]), c)
        return _row(key, n, centre, np.diag(spread**2), floor)

    return run


def _concentrate(support: float, floor: float, reweight: float | None):
    def run(key, pdf):
        pdf = pdf.sort_values("bin")
        c = pdf["c"].to_numpy()
        if reweight is None:
            upto = int(np.searchsorted(np.cumsum(c), support * c.sum())) + 1
            pdf, share = pdf[:upto], c[:upto].sum() / c.sum()
        else:
            inner = pdf[pdf["bin"] <= reweight]
            pdf, share = (inner if len(inner) else pdf[:1]), 0.975
        k = pdf["c"].sum()
        centre = np.array([pdf[f"s{i}"].sum() for i in range(P)]) / k
        cov = np.zeros((P, P))
        for i in range(P):
            for j in range(i, P):
                cov[i, j] = cov[j, i] = pdf[f"s{i}{j}"].sum() / k - centre[i] * centre[j]
        vals, vecs = np.linalg.eigh(cov * _consistency(min(1.0, share)))
        return _row(key, c.sum(), centre, (vecs * np.maximum(vals, 0)) @ vecs.T, floor)

    return run


def _bin(d2: float) -> int:
    return math.floor(16 * math.log2(1 + d2))


def _distance() -> str:
    return " + ".join(f"w{i}{j} * (x{i} - m{i}) * (x{j} - m{j})" for i in range(P) for j in range(i, P))


def _levels(x: DataFrame) -> DataFrame:
    """Every row for its (language, source), its language and the corpus."""
    return x.withColumn("level", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).withColumns({
        "lang": F.when(F.col("level") < 2, F.col("lang")), "source": F.when(F.col("level") < 1, F.col("source"))})


def _matched(x: DataFrame, params: DataFrame) -> DataFrame:
    p = params.withColumnsRenamed({"lang": "p_lang", "source": "p_source", "level": "p_level", "n": "p_n"})
    on = (F.col("level") == F.col("p_level")) & F.col("lang").eqNullSafe(F.col("p_lang")) & F.col("source").eqNullSafe(F.col("p_source"))
    return x.join(p, on).drop("p_lang", "p_source", "p_level")


def estimates(x: DataFrame, support: float = 0.75, steps: int = 3, floor: float = 0.2) -> DataFrame:
    """MCD centre and inverse scatter for each group of every level of
    ``x (lang, source, x0..x4)``: a stored table."""
    rows = _levels(x)
    tall = rows.select("lang", "source", "level", F.posexplode(F.array(*(f"x{i}" for i in range(P)))).alias("i", "v"))
    hist = tall.groupBy("lang", "source", "level", "i", F.floor(F.col("v") / GRID).alias("b")).agg(F.count(F.lit(1)).alias("c"))
    params = materialize(hist.groupBy("lang", "source", "level").applyInPandas(_start(floor), _PARAMS), "mcd")
    inner = _bin(chi2_quantile(0.975, P))
    for step in range(steps + 1):
        d = _matched(rows, params).withColumn("d2", F.expr(_distance()))
        sums = [F.count(F.lit(1)).alias("c"), *(F.sum(f"x{i}").alias(f"s{i}") for i in range(P)),
                *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i in range(P) for j in range(i, P))]
        binned = d.groupBy("lang", "source", "level", F.floor(16 * F.log2(1 + F.greatest("d2", F.lit(0.0)))).cast("int").alias("bin")).agg(*sums)
        f = _concentrate(support, floor, inner if step == steps else None)
        params = materialize(binned.groupBy("lang", "source", "level").applyInPandas(f, _PARAMS), "mcd")
    return params


def quality_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                  carry: list[str] | None = None, min_rows: int = 200, cutoff: float = 0.9999, scale: float = 2.0,
                  **options) -> DataFrame:
    """The ``carry`` columns (default: all but the text's own are kept as they are), the base
    statistics, ``base_failed``, ``distance`` (squared Mahalanobis, NULL where the base rule
    failed) and ``kept``. A document is rejected beyond ``scale`` times the ``cutoff`` quantile of
    chi-square with 5 degrees of freedom: ``scale`` leaves room for the heavier tails of real text."""
    carry = docs.columns if carry is None else carry
    inner = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[col(c).alias(n) for c, n in zip(carry, inner)], col(lang_col).cast("string").alias("lang"),
                       col(source_col).cast("string").alias("source"), col(text_col).cast("string").alias("_text"))
    names = [*inner, "lang", "source"]
    schema = ", ".join([*(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names), *(f"{s} bigint" for s in STATS)])
    s = rows.mapInArrow(_stats(len(names), names), schema)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    s = materialize(s.withColumn("base_failed", failed), "quality-stats")
    x = s.where("NOT base_failed").select("lang", "source", *(F.expr(f).alias(f"x{i}") for i, f in enumerate(FEATURES)))
    params = estimates(x, **options)

    own = params.where(F.col("n") >= min_rows).drop("n")
    own = own.unionByName(params.where((F.col("level") == 2) & (F.col("n") < min_rows)).drop("n"))
    # The most specific level that has enough rows, per (language, source) that occurs.
    seen = _levels(x.select("lang", "source").distinct().withColumns({"g_lang": F.col("lang"), "g_source": F.col("source")}))
    pick = _matched(seen, own.withColumn("n", F.lit(0))).drop("lang", "source", "p_n")
    rest = [c for c in pick.columns if c not in ("g_lang", "g_source", "level")]
    pick = pick.groupBy("g_lang", "g_source").agg(F.min_by(F.struct(*rest), "level").alias("p"))
    pick = materialize(pick.select("g_lang", "g_source", "p.*"), "mcd-pick")

    d = s.join(pick, s["lang"].eqNullSafe(pick["g_lang"]) & s["source"].eqNullSafe(pick["g_source"]), "left")
    d = d.withColumns({f"x{i}": F.when(~F.col("base_failed"), F.expr(f)) for i, f in enumerate(FEATURES)})
    d = d.withColumn("distance", F.expr(_distance()))
    limit = scale * chi2_quantile(cutoff, P)
    verdict = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(False))
    new = [*STATS, "base_failed", "distance", "kept"]
    out = d.withColumn("kept", verdict).select(*inner, *new)
    return out.toDF(*carry, *new)
