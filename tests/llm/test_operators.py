"""Each operator against brute force on small fixtures, and its rules for NULLs,
empty tables, repeated rows, ties and clashing column names."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import compact_windows, mcd, mil_quality, minhash_tensor, packing, sanitise, suffix_dedup, topk, warc, wfst

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, c0 int, key string, `_text` string, `a.b` int"


def frame(spark, rows, schema="doc_id bigint, text string", parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def awkward(spark):
    """NULLs in every column, repeated rows, an empty and a long text, names that clash."""
    long = "word and other words " * 3000
    rows = [(1, "plain text of some words here", "en", "s", 1, "k", "t", 1), (1, "plain text of some words here", "en", "s", 1, "k", "t", 1),
            (None, None, None, None, None, None, None, None), (2, "", "en", None, 2, "k", "t", 2), (3, long, None, "s", 3, "k", "t", 3),
            (1, "other text under the same id", "en", "s", 4, "k", "t", 4)]
    return spark.createDataFrame(rows, DOCS)


# -- 1 -----------------------------------------------------------------------

def test_warc_round_trip_and_revisits(spark):
    rows = [(1, "http://a/\r\nb", "x" * 1500), (2, None, "x" * 1500), (3, "u", "y"), (4, "u", "y"), (5, "é ü", None), (None, "n", "x" * 1500),
            (2, "again", "x" * 1500), (6, "z", "ß" * 700)]
    got = warc.roundtrip(frame(spark, rows, "page_id bigint, url string, html string")).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.page_id].append(r)
    assert [by[k][0].record_type for k in (1, 3, 4, 5, None)] == ["revisit", "response", "response", "response", "revisit"]
    assert by[1][0].refers_to == 2 and by[1][0].payload_bytes == 1500 and by[1][0].url == "http://a/\r\nb"
    assert [r.record_type for r in by[2]] == ["response"] * 2
    assert by[6][0].payload_bytes == 1400 and by[6][0].payload_digest == hashlib.sha1(("ß" * 700).encode()).hexdigest()
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.roundtrip(empty).count() == 0


def test_warc_dictionary_and_faults(spark, tmp_dir):
    pages = [(i, "u", None, None) for i in range(40)]
    records = [warc._record(i, u, f"<html>page number {i} of many pages</html>".encode() * 9, r, "2024-01-01T00:00:00Z") for i, u, _, r in pages]
    d = warc.dictionary(records, 2048)
    assert d
    import struct

    import zstandard

    c = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d))
    lead = struct.pack("<II", warc.DICT_MAGIC, len(d)) + d
    data = lead + b"".join(c.compress(r) for r in records)
    got = list(warc.frames(data))
    assert [g[2] for g in got] == records
    packed = zstandard.ZstdCompressor().compress(d)
    again = struct.pack("<II", warc.DICT_MAGIC, len(packed)) + packed + b"".join(c.compress(r) for r in records)
    assert [g[2] for g in warc.frames(again)] == records
    bad = [records[0][:-4], records[0].replace(b"Content-Length", b"Content-Size"), records[0].replace(b"number 0", b"number 1", 1), b"junk"]
    for x in bad:
        with pytest.raises(warc.WarcError):
            warc.parse_record(x)
    assert isinstance(list(warc.frames(data[:-5]))[-1][2], warc.WarcError)
    with open(f"{tmp_dir}/x.warc.zst", "wb") as f:
        f.write(lead + b"".join(c.compress(r) for r in [records[0], bad[0], records[1]]))
    rows = warc.read_archives(spark, tmp_dir, on_error="report").orderBy("offset").collect()
    assert [r.error is None for r in rows] == [True, False, True]
    with pytest.raises(Exception, match="Content-Length"):
        warc.read_archives(spark, tmp_dir).collect()


# -- 2 -----------------------------------------------------------------------

def repeats(rows):
    seen, out = set(), {}
    for k, t in sorted(rows):
        b = t.encode()
        hit = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 99):
            w = b[i:i + 100]
            if w in seen:
                hit[i] += 1
                hit[i + 100] -= 1
            seen.add(w)
        gone = np.cumsum(hit[:-1]) > 0
        out[k] = (int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), bytes(x for x, g in zip(b, gone) if not g))
    return out


@pytest.mark.parametrize("hot,parts", [(4096, 8), (2, 3)])
def test_suffix_dedup_is_exact(spark, hot, parts):
    rn = random.Random(hot)
    base = ["".join(rn.choice("abcd é\n") for _ in range(400)) for _ in range(5)]
    rows = []
    for i in range(80):
        a = rn.randint(0, 300)
        x = rn.choice(base)[a:a + rn.randint(0, 300)]
        x = "a" * rn.randint(0, 400) if rn.random() < 0.2 else "ab\x00" * rn.randint(0, 100) if rn.random() < 0.2 else x
        rows.append((i, x + "".join(rn.choice("xyz \x00") for _ in range(rn.randint(0, 120))) + rn.choice(base)[:rn.randint(0, 200)]))
    got = suffix_dedup.remove_repeats(frame(spark, rows, parts=5), carry=["doc_id"], hot=hot, parts=parts).collect()
    assert {r.doc_id: (sum(s.e - s.s for s in r.spans), len(r.spans), bytes(r.kept)) for r in got} == repeats(rows)


def test_loser_tree_shares_prefixes():
    rn = random.Random(3)
    runs = []
    for _ in range(7):
        s = sorted(bytes(rn.choice(b"ab") for _ in range(6)) for _ in range(rn.randint(0, 20)))
        h = [0] + [next((k for k in range(6) if x[k] != y[k]), 6) for x, y in zip(s, s[1:])]
        runs.append((s, h[:len(s)]))
    out = [(runs[r][0][i], h) for r, i, h in suffix_dedup.loser_tree(runs)]
    assert [x for x, _ in out] == sorted(x for s, _ in runs for x in s)
    for (x, _), (y, h) in zip(out, out[1:]):
        assert h == next((k for k in range(6) if x[k] != y[k]), 6)


def test_front_coding_round_trip():
    rn = np.random.default_rng(1)
    right, left = rn.integers(40, 101, 500), rn.integers(0, 61, 500)
    rows = rn.integers(0, 2, (500, 160)).astype(np.uint8)
    k = np.arange(160)
    rows[~np.where(k < 100, k < right[:, None], k - 100 < left[:, None])] = 0
    rows = rows[np.lexsort(rows.T[::-1])]
    real = (rows != 0) | True
    r = np.full(500, 100, np.uint8)
    e = np.full(500, 60, np.uint8)
    shared, own = suffix_dedup.front_code(rows, r, e)
    assert real.all() and (suffix_dedup.front_decode(shared, r, e, own) == rows).all()


def test_suffix_dedup_text_stage(spark):
    rows = [(1, "ü" * 80 + "tail"), (2, "ü" * 80 + "other"), (3, None)]
    got = {r.doc_id: r.text for r in suffix_dedup.without_repeats(frame(spark, rows)).collect()}
    assert got[2].strip("ü") == "other" and got[3] == ""


# -- 3 -----------------------------------------------------------------------

def test_compact_windows_partition_all_passages():
    rn = random.Random(2)
    for _ in range(100):
        n, t = rn.randint(1, 50), rn.randint(1, 12)
        v = np.array([rn.randint(0, rn.choice([3, 1000])) for _ in range(n)], np.uint64) << np.uint64(32)
        seen = set()
        for lo, c, hi in zip(*compact_windows.compact_windows(v, np.array([0]), np.array([n]), t)):
            assert v[c] == v[lo:hi + 1].min()
            for a in range(lo, c + 1):
                for b in range(max(c, a + t - 1), hi + 1):
                    assert (a, b) not in seen
                    seen.add((a, b))
        assert seen == {(a, b) for a in range(n) for b in range(a + t - 1, n)}


def test_near_passages(spark):
    rn = random.Random(5)
    word = lambda: "".join(rn.choice("the and ing tion er re st un ll oo gg".split()) for _ in range(3))
    base = [[word() for _ in range(120)] for _ in range(3)]
    rows = []
    for i in range(60):
        mid = []
        if (k := rn.randint(0, 4)) < 3:
            a = rn.randint(0, 50)
            mid = base[k][a:a + rn.choice([45, 60, 70])]
        rows.append((i, " ".join([word() for _ in range(rn.randint(0, 60))] + mid + [word() for _ in range(rn.randint(0, 60))])))
    found, members = compact_windows.near_passages(frame(spark, rows), carry=["doc_id"])
    text = [r[1].split() for r in rows]
    sets = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    for r in found.collect():
        a, b = sets(text[r.x][r.x_start:r.x_end]), sets(text[r.y][r.y_start:r.y_end])
        assert len(a & b) >= 0.8 * len(a | b) and r.x_end - r.x_start > 50 and r.shared == len(a & b)
    cls = {r.doc_id: r["class"] for r in members.collect()}
    windows = defaultdict(set)
    for i, w in enumerate(text):
        for j in range(len(w) - 50):
            windows[tuple(w[j:j + 51])].add(i)
    assert all(len({cls[i] for i in s}) == 1 for s in windows.values())


def test_near_passages_of_later_classes(spark):
    """A signature's first texts link with nothing; two pairs behind them do."""
    rn = random.Random(4)
    word = lambda: "".join(rn.choice("abcdefgh") for _ in range(9))
    line = [word() for _ in range(12)]
    twin = [[word() for _ in range(60)] for _ in range(2)]
    alone = [[word() for _ in range(60)] for _ in range(6)]
    bodies = [*alone, *twin, *[[word() for _ in range(60)] for _ in range(6)], *twin]
    # Every text repeats the line between its own words, so that the line's shingles are minima everywhere.
    rows = [(i, " ".join(line + w[:30] + line + w[30:] + line)) for i, w in enumerate(bodies)]
    found, members = compact_windows.near_passages(frame(spark, rows), carry=["doc_id"])
    cls = {r.doc_id: r["class"] for r in members.collect()}
    assert cls == {i: i - 8 if i >= 14 else i for i, _ in rows}


def test_near_passages_behind_an_edited_version(spark):
    """Two texts each: an edited version of a passage before the passage itself, and the passage."""
    rn = random.Random(7)
    word = lambda: "".join(rn.choice("abcdefgh") for _ in range(9))
    rows = []
    for i in range(40):
        good = [word() for _ in range(52)]
        at = rn.randrange(0, 36)
        edited = good[:at] + [word() for _ in range(14)] + good[at + 14:]
        rows += [(2 * i, " ".join(edited + [word() for _ in range(60)] + good)), (2 * i + 1, " ".join(good))]
    _, members = compact_windows.near_passages(frame(spark, rows), carry=["doc_id"])
    assert {r.doc_id: r["class"] for r in members.collect()} == {i: i - i % 2 for i, _ in rows}


def test_passages_beside_repeated_lines():
    rn = np.random.default_rng(3)
    own = lambda n: rn.integers(1, 1 << 60, n).astype(np.uint64)
    line, good = own(8), own(96)
    a, b = (np.concatenate([np.tile(line, 60), own(64), good]) for _ in range(2))
    got = compact_windows.passages(a, b, 80)
    assert any(x[0] <= 544 and x[1] >= 639 and x[2] <= 544 and x[3] >= 639 for x in got) and any(x[1] < 500 for x in got)
    edited = np.where(rn.random(96) < 0.6, own(96), good)  # an edited version first, then the passage
    got = compact_windows.passages(np.concatenate([edited, own(40), good]), good, 80)
    assert any(x[0] <= 136 and x[1] >= 231 for x in got)


def test_passages_against_brute_force():
    """Two texts have a passage where brute force over equal lengths finds one; all found are similar enough."""
    rn = random.Random(9)
    new = lambda n: [rn.randrange(1, 1 << 60) for _ in range(n)]
    hits = 0
    for _ in range(150):
        line, body = new(rn.randint(1, 6)), new(30)
        def text():
            out = []
            for _ in range(rn.randint(1, 4)):
                k = rn.randrange(3)
                out += line * rn.randint(1, 4) if k == 0 else new(rn.randint(1, 12)) if k == 1 else [x if rn.random() > 0.12 else new(1)[0] for x in body]
            return np.array(out, np.uint64)
        a, b = text(), text()
        got = compact_windows.passages(a, b, 80, 10)
        for ps, pe, qs, qe, shared, total in got:
            u, w = set(a[ps:pe + 1].tolist()), set(b[qs:qe + 1].tolist())
            assert (len(u & w), len(u | w)) == (shared, total) and 100 * shared >= 80 * total and min(pe - ps, qe - qs) >= 9
        want = False
        for n in (10, 12, 15, 18):
            u, w = ([set(t[i:i + n].tolist()) for i in range(len(t) - n + 1)] for t in (a, b))
            want = want or any(100 * len(x & y) >= 80 * len(x | y) for x in u for y in w)
        hits += want
        assert bool(got) >= want
    assert 20 < hits < 140


def test_dense_places_hold_all_similar_passages():
    rn = random.Random(8)
    for _ in range(200):
        pool = [rn.randrange(1 << 30) for _ in range(rn.choice([3, 20]))]
        a, b = (np.array([rn.choice(pool) if rn.random() < 0.85 else rn.randrange(1 << 40) for _ in range(40)]) for _ in range(2))
        _, at, times = np.unique(a, return_inverse=True, return_counts=True)
        dense = compact_windows._dense(compact_windows._before(at), times[at], np.isin(a, b), 80, 8)
        for n in (8, 11, 15):
            assert compact_windows._sliding(compact_windows._before(at), n).tolist() == [len(set(a[i:i + n].tolist())) for i in range(41 - n)]
            sets = [set(b[j:j + k].tolist()) for k in (8, 11, 15) for j in range(41 - k)]
            for i in range(41 - n):
                u = set(a[i:i + n].tolist())
                if any(100 * len(u & w) >= 80 * len(u | w) for w in sets):
                    assert dense[i:i + n].all()


def test_last_turn_leaves_out_windows_that_share_a_line_only(spark, monkeypatch):
    """Texts that have but a line in common are not paired, those that share a passage are."""
    rn = random.Random(12)
    word = lambda: "".join(rn.choice("abcdefgh") for _ in range(9))
    line, body = [word() for _ in range(30)], [word() for _ in range(60)]
    rows = [(i, " ".join([word() for _ in range(40)] + line + [word() for _ in range(40)])) for i in range(60)]
    rows += [(i, " ".join([word() for _ in range(40)] + body + [word() for _ in range(40)])) for i in (60, 61)]
    seen, whole = [], compact_windows._cross_pairs

    def counted(windows, p):
        pairs, tasks = whole(windows, p)
        seen.append(pairs.count())
        return pairs, tasks

    monkeypatch.setattr(compact_windows, "_cross_pairs", counted)
    _, members = compact_windows.near_passages(frame(spark, rows), carry=["doc_id"])
    assert {r.doc_id: r["class"] for r in members.collect()} == {i: min(i, 60) for i, _ in rows}
    assert seen == [0]


def test_passages_of_repeated_words_are_searched_once():
    """Regions within another are dropped, and runs of repeated words that share no passage need no search."""
    assert compact_windows._widest([(0, 90, 0, 80), (5, 60, 5, 50), (0, 90, 0, 80), (100, 200, 0, 80)]) == [(100, 200, 0, 80), (0, 90, 0, 80)]
    run = lambda *n: np.concatenate([np.full(k, v, np.uint64) for v, k in n])
    assert compact_windows.passages(run((1, 30), (2, 30), (3, 30)), run((4, 40), (2, 40), (5, 40)), 80) == []
    got = compact_windows.passages(run((1, 60), (2, 30)), run((3, 30), (1, 70)), 80)
    assert got and all(x[4] * 100 >= 80 * x[5] for x in got)


def test_crossed_pairs_are_all_pairs(spark, monkeypatch):
    rn = random.Random(6)
    monkeypatch.setattr(compact_windows, "CROSS", 40)
    rows = [(rn.choice([1, 1, 1, 2, 3]), i, 0, i, i + 3, i + 50, rn.choice([1, 1, 1, 2, 3])) for i in range(120)]
    windows = spark.createDataFrame(rows, "sig bigint, x bigint, f tinyint, lx int, cx int, rx int, class bigint")
    got = sorted((r.x, r.y) for r in compact_windows._cross_pairs(windows, 4)[0].collect())
    assert got == sorted((x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] > y[1] and x[6] != y[6])


def test_last_turn_in_rounds_gives_all_pairs(spark, monkeypatch):
    """Rounds of a few pairs meet every pair across classes once, and no round has many more than are stored at a time."""
    rn = random.Random(9)
    rows = [(rn.choice([1, 1, 1, 2, 3]), i, 0, i, i + 3, i + 50, rn.choice([1, 1, 1, 2, 3])) for i in range(120)]
    windows = spark.createDataFrame(rows, "sig bigint, x bigint, f tinyint, lx int, cx int, rx int, class bigint")
    monkeypatch.setattr(compact_windows, "DEALT", 200)
    got = [[(r.x, r.y) for r in compact_windows._cross_pairs(w, 2)[0].collect()] for w in compact_windows._rounds(windows, 2)]
    want = sorted((x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] > y[1] and x[6] != y[6])
    assert sorted(x for r in got for x in r) == want and len(want) > 1200
    assert max(map(len, got)) < 800
    monkeypatch.undo()
    assert [w for w in compact_windows._rounds(windows, 2)] == [windows]


def test_texts_of_no_class_are_not_shuffled_for_their_class(spark):
    """Of many texts those that a few keys name are shuffled, the others are worked on where they are read."""
    rows = spark.range(5000).selectExpr("id AS key", "encode(repeat(cast(id AS string), 3), 'UTF-8') AS text")
    keys = spark.range(3, 8).selectExpr("id AS key")
    some = compact_windows._squeezed_with(rows, keys)
    assert {r.key for r in some.collect()} >= set(range(3, 8)) and some.count() < 50
    back = some.mapInArrow(compact_windows._whole, "key bigint, text binary").collect()
    assert all(bytes(r.text).decode() == 3 * str(r.key) for r in back)
    rest = compact_windows.without_any_key(rows, keys, compact_windows._own_class, "key bigint, text binary, class bigint")
    assert "Exchange" not in rest._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.key for r in [*rest.collect(), *back]) == list(range(5000)) and rest.where("key <> class").count() == 0


def test_stored_leaves_no_shuffle_files(spark):
    """The shuffle files of a stage go when its table is written, so that the disk does not hold those of all stages."""
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f.rsplit("/", 1)[-1] for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(key)
    got = compact_windows._stored(spark.range(10_000).selectExpr("xxhash64(id) AS h").repartition(3, "h"), "test")
    assert not files() - before and spark.conf.get(key) == was
    assert got.count() == 10_000


# -- 4 -----------------------------------------------------------------------

def brute_statistics(t):
    w = WORD.findall(t)
    win = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    hit = {j for i, x in enumerate(win) if win.count(x) > 1 for j in range(i, i + 5)}
    lines = t.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit)


def test_statistics():
    rn = random.Random(1)
    for _ in range(300):
        t = "".join(rn.choice("ab  \n\t#é\x1f") for _ in range(rn.randint(0, 80)))
        assert mcd.statistics(t) == brute_statistics(t), t


def test_quality_rules_reject_outliers(spark):
    rn = random.Random(1)
    text = lambda: " ".join(rn.choice("abcdefgh") * rn.randint(2, 8) + str(rn.random()) for _ in range(rn.randint(50, 200)))
    rows = [(i, text(), "en", "s") for i in range(400)] + [(1000 + i, re.sub(" ", "### ", text()), "en", "s") for i in range(20)] + [(2000, "few words", "en", "s")]
    got = {r.doc_id: r for r in mcd.quality_rules(frame(spark, rows, "doc_id bigint, text string, lang string, source string"), carry=["doc_id"]).collect()}
    assert all(got[i].kept for i in range(400)) and not any(got[1000 + i].kept or got[1000 + i].base_failed for i in range(20))
    assert got[2000].base_failed and not got[2000].kept
    assert abs(mcd.chi2_quantile(0.975, 5) - 12.8325) < 1e-3


# -- 5 -----------------------------------------------------------------------

def test_packing(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rn = random.Random(1)
    rows = [(i, "".join(rn.choice(["word ", "é", "\n", " 12", "<|endoftext|>", "日本"]) for _ in range(rn.randint(0, 4000)))) for i in range(60)] + [(60, None)]
    got = packing.pack_documents(frame(spark, rows), path, max_segments=6).collect()
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.id].append(r)
        seqs[r.sequence_id].append(r)
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        pieces = sorted(docs[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == ids.tobytes() and all(r.doc_tokens == len(ids) for r in pieces)
        assert [r.start for r in pieces] == list(np.cumsum([0] + [r.length for r in pieces[:-1]]))
    pad = 0
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == list(np.cumsum([0] + [r.length for r in s[:-1]])) and len(s) <= 6
        n = sum(r.length for r in s)
        assert n <= 2048
        pad += 0 if n & (n - 1) == 0 else 2048 - n
    assert pad < 0.05 * sum(r.length for r in got)


def test_packing_ids_are_the_librarys(spark):
    """Special tokens as the library has them by default, and white space without end."""
    tokenizers = pytest.importorskip("tokenizers")
    path = P.path("byte_bpe_50k.json")
    t = tokenizers.Tokenizer.from_file(path)
    enc, own = packing.byte_bpe(path), packing.special_ids(path)
    rn = random.Random(2)
    texts = ["".join(rn.choice(["word ", "é", "\n", " 12", "<|endoftext|>", " ", "\u3000"]) for _ in range(rn.randint(0, 200))) for _ in range(200)]
    texts += ["a <|endoftext|> b", *(x + w + y for x in ("", "a") for w in (" " * 30_000, "\n \t" * 5_000, " " * 12_000 + "\x1c") for y in ("", "b", "<|endoftext|>"))]
    for x in texts:
        assert packing.encode(enc, x, own) == t.encode(x, add_special_tokens=False).ids
    rows = [(1, "a" + " " * 1_200_000 + "b"), (2, "a <|endoftext|> b")]
    got = defaultdict(bytes)
    for r in packing.pack_documents(frame(spark, rows), path, special=True).orderBy("id", "start").collect():
        got[r.id] += bytes(r.ids)
    assert np.frombuffer(got[2], "<u4").tolist() == [64, 220, 50256, 275, 1]
    assert enc.decode(np.frombuffer(got[1], "<u4")[:-1].tolist()) == rows[0][1]


def test_packing_prompts_bear_no_loss(spark):
    rows = [(i, "answer " * (i % 90), "question " * (i % 70)) for i in range(200)]
    got = packing.pack_documents(frame(spark, rows, "doc_id bigint, text string, ask string"), P.path("byte_bpe_50k.json"),
                                 prompt_col="ask", max_tokens=256, max_loss_tokens=100, max_segments=5).collect()
    seqs = defaultdict(lambda: [0, 0, 0])
    loss = defaultdict(int)
    for r in got:
        s = seqs[r.sequence_id]
        s[0] += r.length
        s[1] += 1
        s[2] += r.loss_tokens
        loss[r.id] += r.loss_tokens
    assert all(a <= 256 and b <= 5 and c <= 100 for a, b, c in seqs.values())
    enc = packing.byte_bpe(P.path("byte_bpe_50k.json"))
    assert all(loss[i] == len(enc.encode_ordinary(t)) + 1 for i, t, _ in rows)


# -- 6 -----------------------------------------------------------------------

def shingles(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)]) if w else frozenset()


def test_near_duplicates(spark):
    rn = random.Random(8)
    vocab = [f"w{i}" for i in range(500)]
    rows = []
    for f in range(8):
        base = [rn.choice(vocab) for _ in range(rn.choice([1, 6, 40, 120]))]
        for _ in range(20):
            w = [x if rn.random() > rn.choice([0, 0.02, 0.06]) else rn.choice(vocab) for x in base]
            rows.append((len(rows), " ".join(w).upper() if rn.random() < 0.2 else "  ".join(w)))
    rows += [(len(rows), ""), (len(rows) + 1, None)]
    sets = {k: shingles(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component, r.kept) for r in minhash_tensor.near_duplicates(frame(spark, rows), carry=["doc_id"]).collect()}
    assert got == {k: (len(sets[k]), find(k), find(k) == k) for k in sets}


# -- 7 -----------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def test_base_spans():
    def ok(k, x):
        d = re.sub("[^0-9]", "", x)
        luhn = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(d[::-1])) % 10 == 0 if d else False
        return [True, k == 1 and all(int(y) <= 255 for y in x.split(".")), 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15][k]

    rn = random.Random(5)
    for _ in range(8000):
        al = rn.choice(["a1.@-+ ", "12 -.+(", "a@.b", "0123456789 .-+@x"])
        t = "".join(rn.choice(al) for _ in range(rn.randint(0, 40)))
        want = sorted((m.start(), m.end(), k) for k, p in enumerate(PATTERNS) for m in re.finditer(p, t) if ok(k, m[0]))
        assert [x[:3] for x in sanitise.base_spans(t)] == want, t
    assert sanitise.base_spans("1" * 200_000 + "a" * 200_000) == []


def test_disclosing_terms(spark):
    rows = [(i, f"filler{i} Zorbly writes from zorb@x.org on day{i} with the usual words") for i in range(6)]
    rows += [(10 + i, f"the usual words with filler{i} writes from nobody on another day") for i in range(40)] + [(99, None)]
    got = {r.doc_id: r for r in sanitise.sanitise(frame(spark, rows)).collect()}
    assert all("[EMAIL]" in got[i].text and "Zorbly" not in got[i].text and "usual words" in got[i].text for i in range(6))
    assert all(got[10 + i].text == rows[6 + i][1] for i in range(40))
    spans = {r.doc_id: [s.k for s in r.spans] for r in sanitise.find_spans(frame(spark, rows), carry=["doc_id"]).collect()}
    assert spans[0].count(0) == 1 and spans[0].count(4) == 1 and spans[99] == []


def test_disclosing_terms_everywhere(spark):
    """Far from the entity, and in documents that do not name it."""
    far = "one two three four five six seven eight nine ten eleven"
    rows = [(i, f"filler{i} Zorbly writes from zorb@x.org on day{i} {far} (Zorbly) again and Quandle") for i in range(6)]
    rows += [(6 + i, f"nobody{i} knows Zorbly, {far}") for i in range(3)] + [(10 + i, f"{far} again writes from and on filler{i}") for i in range(40)]
    got = {r.doc_id: r.text for r in sanitise.sanitise(frame(spark, rows)).collect()}
    assert not any("Zorbly" in t for t in got.values()) and not any("Quandle" in t for t in got.values())
    assert "([NAME])" in got[0] and got[6] == f"nobody0 knows [NAME], {far}" and got[10] == rows[9][1]


# -- 8 -----------------------------------------------------------------------

def test_quality_model_on_held_out_rows(spark):
    rn = random.Random(1)
    good = lambda: " ".join(rn.choice("river stone house light paper green water".split()) for _ in range(rn.randint(5, 300))) + "."
    rows = [(i, good() if i % 2 else re.sub(" ", "$$ ", good())) for i in range(300)] + [(300, None), (301, "")]
    docs = frame(spark, rows)
    labels = frame(spark, [(i, i % 2) for i in range(300)] + [(5, None), (None, 1)], "doc_id bigint, quality int")
    model = mil_quality.train(docs, labels)
    got = {r.doc_id: r for r in mil_quality.score(docs, model, carry=["doc_id"]).withColumn("held", mil_quality.held_out("doc_id")).collect()}
    held = [i for i in range(300) if got[i].held]
    assert all(got[i].held == (crc32(str(i).encode()) % 3 == 1) for i in got) and len(held) > 50
    assert sum((got[i].score >= 0.5) == bool(i % 2) for i in held) >= 0.95 * len(held)
    assert all(0 <= got[i].score <= 1 for i in got)
    assert mil_quality.train(docs, labels.where("quality = 1")) == 1.0
    assert mil_quality.train(docs, labels.limit(0)) == 0.5


def test_gradient():
    rn = np.random.default_rng(0)
    m = mil_quality.GatedAttention(5, 4, 3, seed=1)
    x, bags, y = rn.normal(size=(9, 5)), np.array([2, 4, 3]), np.array([1.0, 0.0, 1.0])
    loss = lambda: -np.mean(np.log(np.where(y == 1, p := m.scores(x, bags), 1 - p)))
    g = m._gradient(x, bags, y)
    for k, v in m.p.items():
        i = tuple(0 for _ in v.shape)
        old, h = v[i], 1e-6
        v[i] = old + h
        up = loss()
        v[i] = old - h
        down = loss()
        v[i] = old
        assert abs((up - down) / (2 * h) - g[k][i]) < 1e-6


# -- 9 -----------------------------------------------------------------------

def test_wfst_equals_the_library(spark):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    t = wfst.compiled(P.path("piece_bpe_32k.model"))
    rn = random.Random(1)
    texts = ["".join(rn.choice("aeth in\n\t  ▁ßé日①💥0.1-'\x00") for _ in range(rn.randint(0, 30))) for _ in range(2000)]
    texts += ["".join(rn.choice("the and ing tion er re st un ll".split()) for _ in range(rn.randint(1, 60))) for _ in range(500)]
    for x in texts:
        ids = np.frombuffer(t.encode(x), "<u4").tolist()
        assert ids == sp.encode(x), x
        assert t.decode(ids) == sp.decode(ids)
    df = wfst.decode(wfst.encode(frame(spark, list(enumerate(["a b", "", None, "ü\n x"]))), P.path("piece_bpe_32k.model")), P.path("piece_bpe_32k.model"))
    assert all(r.decoded == r.text for r in df.collect())


# -- 10 ----------------------------------------------------------------------

def test_topk_is_exact(spark):
    rn = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rn.integers(-3, 4, 4) / 8]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (None, [1.0] * 4), (7, rows[7][1]), (303, [1.0, 2.0])]
    rows += [(304, [float("inf")] * 4)]
    v = topk.integer_vectors(frame(spark, rows, "vec_id bigint, e array<double>"), "vec_id", "e")
    got = defaultdict(list)
    for r in topk.exact_topk(v, v.where(topk.every_nth(50)), 10, shards=5, fan=2).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    ints = {i: np.floor(1024 * np.array(x)).astype(int) for i, x in rows[:300]}
    for q in range(0, 300, 50):
        want = sorted(((-int(ints[q] @ ints[i]), i) for i in ints if i != q))[:10]
        assert got[q] == [(i, -s) for s, i in want]
    big = topk._scores(np.array([[1 << 40, 1]]), np.array([[1 << 20, 3]]))
    assert big.tolist() == [[(1 << 60) + 3]]


def test_topk_overflow_is_an_error_and_ties_and_repeats_have_their_rule(spark):
    with pytest.raises(OverflowError):
        topk._scores(np.array([[1 << 40] * 8]), np.array([[1 << 40] * 8]))
    exact = topk._scores(np.array([[1 << 31, -(1 << 31)]]), np.array([[1 << 31, (1 << 31) - 1]]))
    assert exact.tolist() == [[(1 << 62) - (1 << 31) * ((1 << 31) - 1)]]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.integer_vectors(frame(spark, [(1, [1e17])], "vec_id bigint, e array<double>"), "vec_id", "e").collect()
    rows = [(0, [1.0]), *[(i, [2.0]) for i in (9, 3, 7)], (5, [3.0]), (5, [1.0]), (5, [3.0]), (None, [9.0]), (8, None), (6, [None])]
    v = topk.integer_vectors(frame(spark, rows, "vec_id bigint, e array<double>"), "vec_id", "e")
    got = topk.exact_topk(v, v.where("id = 0"), 3, shards=4, fan=2).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(5, 3 << 20), (3, 2 << 20), (7, 2 << 20)]
    assert topk.exact_topk(v, v.where("id = -1"), 3).count() == 0
    none = topk.integer_vectors(frame(spark, [], "vec_id bigint, e array<double>"), "vec_id", "e")
    assert topk.exact_topk(none, none).count() == 0


# -- all ---------------------------------------------------------------------

def test_awkward_rows_and_empty_tables(spark):
    for df, n in ((awkward(spark), 6), (awkward(spark).limit(0), 0)):
        assert suffix_dedup.remove_repeats(df).count() == n
        assert suffix_dedup.without_repeats(df).columns == df.columns
        dup = minhash_tensor.near_duplicates(df).collect()
        assert len(dup) == n
        assert compact_windows.near_passages(df)[1].count() == n
        q = mcd.quality_rules(df).collect()
        assert len(q) == n
        assert sanitise.sanitise(df).columns == df.columns and sanitise.sanitise(df).count() == n
        assert mil_quality.score(df, 0.5).count() == n
        assert wfst.encode(df, P.path("piece_bpe_32k.model")).count() == n
        pieces = packing.pack_documents(df, P.path("byte_bpe_50k.json")).collect()
        assert len({r.sequence_id for r in pieces}) >= min(n, 1)
        vec = df.select(F.col("doc_id").alias("vec_id"), F.array(F.col("c0").cast("double")).alias("e"))
        v = topk.integer_vectors(vec, "vec_id", "e")
        got = topk.exact_topk(v, v).collect()
        assert {r["query_id"] for r in got} <= {r["id"] for r in v.collect()} and all(r["query_id"] != r["vec_id"] for r in got)
