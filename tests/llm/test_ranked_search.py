"""Ranked search against the formula over all documents and items."""

import math
import random
import re
from collections import Counter

import pytest

from panelkit.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def ranking(docs, items, k=10):
    bags = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        scores = []
        for d, b in bags:
            n, s = sum(b.values()), 0
            for t in set(TERM.findall(text.translate(LOW))):
                if b[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((1000000000 * b[t]) // (1000 * b[t] + 8 * (100 - 90 + (90 * n * n_docs) // total)))
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def corpus(rng, n):
    """Words of very different frequency; copies, other scripts, NULLs, wordless and long texts."""
    words = [f"w{i}" for i in range(400)] + ["É", "été", "ΣΑ", "日本", "a1b2", "İ"]
    weight = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice(["", ".", "-", " "]).join(x.upper() if rng.random() < .1 else x for x in rng.choices(words, weight, k=rng.randint(1, 60)))
             if rng.random() < .1 else " ".join(rng.choices(words, weight, k=rng.randint(1, 60)))) for i in range(n)]
    docs += [(None, docs[0][1]), (3, docs[3][1]), (3, docs[4][1]), (-5, docs[3][1]), (n, None), (n + 1, ""), (n + 2, " .,;\x00\n"), (n + 3, "W1 w2 " * 40000)]
    items = [(i, " ".join(rng.choices(words, weight, k=rng.randint(1, 12)))) for i in range(40)]
    return docs, items + [(1, "w1, W2!"), (None, "w3 w5"), (50, None), (51, ""), (52, "nowhere"), (0, items[0][1])]


@pytest.mark.parametrize("shares,bundle,group", [((0.01, 0.05, 0.3), 256, 64), ((), 256, 8192), ((0.002, 0.004, 0.01, 0.02, 0.1, 0.5), 7, 50)])
def test_equals_the_formula(spark, monkeypatch, shares, bundle, group):
    monkeypatch.setattr(R, "GROUP_DOCS", group)
    docs, items = corpus(random.Random(3), 700)
    d = spark.createDataFrame([x + (1, "y") for x in docs], "doc_id bigint, text string, term int, grp string").repartition(3)
    i = spark.createDataFrame([x + (1,) for x in items], "item_id bigint, text string, docs int")
    got = sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in R.search(d, i, 10, shares=shares, bundle=bundle).collect()), key=repr)
    assert got == ranking(docs, items)


def test_empty_tables_and_wordless_ones(spark):
    docs, items = "doc_id bigint, text string", "item_id bigint, text string"
    some = spark.createDataFrame([(1, "a b")], docs)
    none = spark.createDataFrame([], docs)
    ask = spark.createDataFrame([(1, "a")], items)
    assert R.search(none, ask).count() == 0
    assert R.search(some, spark.createDataFrame([], items)).count() == 0
    assert R.search(spark.createDataFrame([(1, None), (2, " . ")], docs), ask).count() == 0
    assert [tuple(r)[1:] for r in R.search(some, ask).collect()] == [(1, 1, 1, ranking([(1, "a b")], [(1, "a")])[0][3])]


def test_equal_scores_by_id_across_groups(spark, monkeypatch):
    monkeypatch.setattr(R, "GROUP_DOCS", 5)
    docs = [(i, "same words here") for i in range(60)] + [(100, "other")]
    got = R.search(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4), spark.createDataFrame([(1, "words")], "item_id bigint, text string"))
    assert [(r["rank"], r["doc_id"]) for r in got.orderBy("rank").collect()] == [(k + 1, k) for k in range(10)]
