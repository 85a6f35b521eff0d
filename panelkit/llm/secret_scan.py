"""Secret scans: patterns, and random strings told from ordinary identifiers by two
character Markov models. DataFrame functions only.

* Patterns: ``assign`` (a password, token or key that is given a value), ``access``
  (AKIA keys), ``hex`` (runs of hexadecimal digits).
* Models: first-order Markov chains over 67 characters, one of ordinary identifiers and one for
  each notation of random strings (hexadecimal digits, capitals and digits, all others), counted on
  labelled samples (:func:`labelled_samples`, or any frame ``word, label``). A word's score is the
  sum of the log-likelihood ratios of its transitions, of the likeliest notation, in thousandths
  of a nat and whole numbers, so the order of summing cannot change it. Words of ``min_length`` characters whose score reaches ``threshold`` (the
  log of the odds against a word being random) are spans of kind ``random``, unless a
  pattern's span holds them.

The model is 3 x 68 x 68 whole numbers, whatever the corpus; it is the only thing that
reaches the driver. Matches become rows (document row, number, length of the text before
it), running sums per document row give their places, and nothing else is shuffled: no
text leaves its scan.

Defined results: a NULL text is empty and has no spans; every input row gives one output
row, repeated and NULL ids included; places count code points; columns other than those
named in ``carry`` are ignored. Without samples all ratios are 0 and nothing is random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelkit.functions.scalar import let
from panelkit.llm.common import col, materialize

KINDS = ("assign", "access", "hex", "random")
# Fixed by the contract; the lengths that a match must have are in the patterns where that changes no match.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
VALUE_LENGTH = 12
WORD = "[A-Za-z0-9+/_=-]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"  # other characters, and the start of a word, are 0
SIZE = len(ALPHABET) + 1
RANDOM = {1: "^[0-9a-f]+$", 2: "^[0-9A-Z]+$", 3: ""}  # labels of random strings by notation; 0: ordinary
NEVER = -1_000_000  # a transition of a notation without samples


def _text(text_col: str) -> Column:
    return F.coalesce(col(text_col).cast("string"), F.lit(""))


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def labelled_samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 2000, min_length: int = 8) -> DataFrame:
    """(word, label), each pair once, from the ``max_rows`` documents (a bounded sample of rows) with the least hashes.

    Labels 1 to 3, by notation: what the patterns find there, and the SHA-256 digests of those texts written as keys are
    (hexadecimal in either case, base64). Label 0: the other words of ``min_length`` characters."""
    rows = docs.select(col(id_col).cast("string").alias("id"), _text(text_col).alias("text"))
    rows = rows.withColumn("h", F.xxhash64(F.lit(7), "id", "text"))
    least = rows.select("h").distinct().orderBy("h").limit(max_rows).agg(F.max("h"))
    # equal rows have equal hashes: of each one is enough
    rows = rows.where(F.col("h") <= least.scalar()).dropDuplicates(["h"])
    text, sha = F.col("text"), F.sha2("text", 256)
    random = F.concat(F.array(sha, F.upper(sha), F.base64(F.unhex(sha))), _all(text, ACCESS), _all(text, HEX),
                      F.filter(_all(text, ASSIGN, 2), lambda v: F.length(v) >= VALUE_LENGTH))
    plain = text
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = F.regexp_replace(plain, pattern, " ")
    notation = lambda w: F.when(F.rlike(w, F.lit(RANDOM[1])), 1).when(F.rlike(w, F.lit(RANDOM[2])), 2).otherwise(3)
    words = F.concat(F.transform(random, lambda w: F.struct(w.alias("word"), notation(w).alias("label"))),
                     F.transform(_all(plain, f"{WORD}{{{min_length},}}"), lambda w: F.struct(w.alias("word"), F.lit(0).alias("label"))))
    return rows.select(F.inline(words)).distinct()


def _steps(word: str) -> Column:
    """Cells of the transition table that a word passes: 68 times the character before it and the character itself."""
    at = F.transform(F.split(col(word), ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.zip_with(F.concat(F.array(F.lit(0)), F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0)))), at, lambda a, b: a * SIZE + b)


def train(samples: DataFrame, smoothing: int = 1) -> DataFrame:
    """Labelled ``samples (word, label)`` -> one row ``r1, r2, r3``: for each notation and cell (before, after) the log of its
    probability there over that among ordinary words, in thousandths, rounded down. Unseen transitions count ``smoothing``."""
    labels = [0, *RANDOM]
    cells = (samples.where("word <> ''").select("label", F.explode(_steps("word")).alias("cell"))
             .groupBy("cell").agg(*[F.count_if(F.col("label") == k).alias(f"n{k}") for k in labels]))
    grid = samples.sparkSession.range(SIZE * SIZE).select(F.col("id").cast("int").alias("cell"))
    rows = grid.join(cells, "cell", "left").select("cell", *[F.coalesce(f"n{k}", F.lit(0)).alias(f"n{k}") for k in labels])
    before, all_cells = Window.partitionBy((F.col("cell") / SIZE).cast("int")), Window.partitionBy(F.lit(0))  # of 68 x 68 rows
    chance = {k: (F.col(f"n{k}") + smoothing).cast("double") / (F.sum(f"n{k}").over(before) + smoothing * SIZE).cast("double") for k in labels}
    ratio = {k: F.when(F.sum(f"n{k}").over(all_cells) > 0, F.floor(F.lit(1000.0) * F.log(chance[k] / chance[0])).cast("int")).otherwise(NEVER)
             for k in RANDOM}
    rows = rows.select("cell", *[x.alias(f"r{k}") for k, x in ratio.items()])
    return materialize(rows.agg(*[F.expr(f"transform(sort_array(collect_list(struct(cell, r{k}))), x -> x.r{k})").alias(f"r{k}") for k in RANDOM]), "markov")


def score(word: str, model: DataFrame) -> Column:
    """Log-likelihood ratio of a column of words, in thousandths of a nat: that of the likeliest notation."""
    row = model.select(*[F.array_join(F.col(f"r{k}").cast("array<string>"), ",") for k in RANDOM]).first()  # 3 x 68 x 68 whole numbers
    tables = [F.split(F.lit(x), ",").cast("array<int>") for x in row]
    total = lambda table, steps: F.aggregate(steps, F.lit(0).cast("bigint"), lambda s, c: s + table[c].cast("bigint"))
    return F.when(F.length(col(word)) > 0, let(_steps(word), lambda steps: F.greatest(*[total(t, steps) for t in tables]))).otherwise(
        F.when(col(word).isNotNull(), F.lit(0).cast("bigint")))


def find_spans(docs: DataFrame, model: DataFrame, carry: list[str], text_col: str = "text", min_length: int = 16,
               threshold: int = 10_000) -> DataFrame:
    """Every row's ``carry`` columns and ``spans``: (s: start, k: number of the kind, e: end, score), by start and kind."""
    inner = [f"c{j}" for j in range(len(carry))]
    rows = docs.select(F.monotonically_increasing_id().alias("row"), *[col(c).alias(n) for c, n in zip(carry, inner)], _text(text_col).alias("text"))
    text = F.col("text")
    patterns = (ASSIGN, ACCESS, HEX, f"{WORD}{{{min_length},}}")
    rows = rows.select("*", *[_all(text, p).alias(f"m{k}") if k != 1 else F.when(F.instr(text, "AKIA") > 0, _all(text, p)).alias("m1")
                              for k, p in enumerate(patterns)])
    rows = rows.select("*", F.when(F.size("m0") > 0, F.transform(_all(text, ASSIGN, 2), F.length)).alias("values"),
                       *[F.when(F.size(f"m{k}") > 0, F.transform(F.split(text, p, -1), F.length)).alias(f"gaps{k}") for k, p in enumerate(patterns)])

    def found(k: int) -> Column:
        return F.coalesce(F.transform(f"m{k}", lambda m, i: F.struct(
            F.lit(k).alias("k"), i.alias("i"), F.col(f"gaps{k}")[i].alias("gap"), F.length(m).alias("size"),
            (F.col("values")[i] >= VALUE_LENGTH if k == 0 else F.lit(True)).alias("ok"), (m if k == 3 else F.lit(None).cast("string")).alias("word"))),
            F.array().cast("array<struct<k:int,i:int,gap:int,size:int,ok:boolean,word:string>>"))

    found_rows = rows.select("row", *inner, F.explode_outer(F.concat(*[found(k) for k in range(4)])).alias("x")).select("row", *inner, "x.*")
    scored = found_rows.select("row", *inner, "k", "i", "gap", "size", "ok",
                               F.when(F.col("k") == 3, score("word", model)).alias("score")).repartition("row")
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("row", "k").orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    spans = scored.withColumn("e", end).withColumn("s", F.col("e") - F.col("size"))
    # the furthest that a pattern's span from here or before reaches
    reach = F.max(F.when((F.col("k") < 3) & F.col("ok"), F.col("e"))).over(
        Window.partitionBy("row").orderBy("s", "k").rowsBetween(Window.unboundedPreceding, 0))
    spans = spans.withColumn("reach", reach)
    held = F.coalesce(F.col("reach") >= F.col("e"), F.lit(False))
    keep = F.col("k").isNotNull() & F.col("ok") & ((F.col("k") < 3) | ((F.col("score") >= threshold) & ~held))
    span = F.when(keep, F.struct(F.col("s").cast("bigint").alias("s"), "k", F.col("e").cast("bigint").alias("e"), "score"))
    out = spans.groupBy("row").agg(*[F.first(n).alias(n) for n in inner], F.sort_array(F.collect_list(span)).alias("spans"))
    return out.select(*[F.col(n).alias(c) for n, c in zip(inner, carry)], "spans")


def digest(spans: str, base_only: bool = False) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    rows = F.filter(spans, lambda x: x["k"] < 3) if base_only else F.col(spans)
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", names[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")
