"""The registered queries of this subpackage, over whole tables, and the DuckDB
SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import compact_windows, conversation_repair, mcd, mil_quality, minhash_tensor, packing, ranked_search, sanitise, secret_scan, suffix_dedup, topk, warc, wfst
from panelkit.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through archives written and read back."""
    return warc.roundtrip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a repeated 100-byte string."""
    got = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"])
    gone = F.expr("aggregate(spans, 0L, (a, x) -> a + x.e - x.s)")
    return got.select("doc_id", (F.octet_length("kept") + gone).cast("bigint").alias("n_bytes"), gone.alias("n_removed"),
                      F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op3_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near-duplicate passages. How many texts a document shares a passage with is
    not counted: that takes all pairs of a class."""
    _, members = compact_windows.near_passages(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return members.select("doc_id", F.col("class").alias("class_id"), F.col("copies").alias("n_copies"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict on every document."""
    return mcd.quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", *mcd.STATS, "base_failed", "kept")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and where they lie."""
    got = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), special=True)
    return got.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


def op6_minhash_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component."""
    return minhash_tensor.near_duplicates(table(spark, sf_dir, "documents"), carry=["doc_id"]).select(
        "doc_id", F.col("n_shingles").cast("bigint").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def op7_sanitise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    got = sanitise.find_spans(table(spark, sf_dir, "documents"), carry=["doc_id"])
    counts = [F.expr(f"cast(size(filter(spans, x -> x.k = {k})) as bigint)").alias(f"n_{name}")
              for k, name in enumerate(sanitise.KINDS[:4])]
    return got.select("doc_id", *counts, F.sha2(F.encode(F.expr(sanitise.digest("spans", base_only=True)), "UTF-8"), 256).alias("base_sha256"),
                      F.expr(sanitise.digest("spans")).alias("spans"))


def op8_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = mil_quality.train(docs, table(spark, sf_dir, "labels"))
    got = mil_quality.score(docs, model, carry=["doc_id"])
    return got.select("doc_id", mil_quality.held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, and whether decoding gives the text back."""
    path = tokenizer_path("piece_bpe_32k.model")
    got = wfst.decode(wfst.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path), path)
    return got.select("doc_id", wfst.token_count("ids").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
                      F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows for every hundredth vector, over all rows."""
    rows = topk.integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.exact_topk(rows, rows.where(topk.every_nth(100)), 10)


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by patterns and by character models trained on a sample of the documents."""
    docs = table(spark, sf_dir, "documents")
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    got = secret_scan.find_spans(docs, model, ["doc_id"])
    counts = [F.expr(f"cast(size(filter(spans, x -> x.k = {k})) as bigint)").alias(f"n_{name}") for k, name in enumerate(secret_scan.KINDS[:3])]
    return got.select("doc_id", *counts, F.sha2(F.encode(secret_scan.digest("spans", base_only=True), "UTF-8"), 256).alias("base_sha256"),
                      secret_scan.digest("spans").alias("spans"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults and cheapest repair after the contract's damage."""
    given = table(spark, sf_dir, "conversations")
    turns = conversation_repair.placed(conversation_repair.damaged(given))
    solved = conversation_repair.solve(turns)
    out = given.select("conv_id").distinct()
    for got in (conversation_repair.turn_gaps(turns), conversation_repair.audits(solved),
                conversation_repair.digests(conversation_repair.repaired(turns, solved))):
        out = out.join(got, F.col("conv_id").cast("string").eqNullSafe(F.col("conv")), "left").drop("conv")
    return out.select("conv_id", *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item, over all documents."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10).select("item_id", "rank", "doc_id", "score")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_compact_windows": op3_compact_windows,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_minhash_tensor": op6_minhash_tensor,
    "op7_sanitise": op7_sanitise,
    "op8_mil_quality": op8_mil_quality,
    "op9_wfst": op9_wfst,
    "op10_topk": op10_topk,
    "op11_secret_scan": op11_secret_scan,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE = {
    "op1_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
     g AS (SELECT body, max(page_id) AS top FROM p WHERE octet_length(body) >= 1000 GROUP BY body)
SELECT page_id, octet_length(p.body) AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN g ON p.body = g.body""",
    "op6_minhash_tensor": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 80 * (a.n + b.n - i)),
r(x, y) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.c AS component_id, w.doc_id = c.c AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT x, min(y) AS c FROM r GROUP BY x) c ON c.x = w.doc_id""",
    "op10_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
      FROM v q JOIN v r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id),
o AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM o WHERE rank <= 10""",
    "op11_secret_scan": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
re AS (SELECT '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?' AS key_,
              '[A-Za-z0-9+/_.=-]+' AS val_, 'AKIA[A-Z0-9]+' AS access_, '[0-9a-f]+' AS hex_, '[A-Za-z0-9+/_=-]+' AS word_),
p AS (SELECT r, doc_id, text, k, pat FROM d, re, (VALUES (0), (1), (2), (3)) t(k),
        LATERAL (SELECT CASE k WHEN 0 THEN key_ || val_ WHEN 1 THEN access_ WHEN 2 THEN hex_ ELSE word_ END AS pat)),
m AS (SELECT r, doc_id, k, regexp_extract_all(text, pat) AS ms, list_transform(string_split_regex(text, pat), lambda x: length(x)) AS gaps,
        CASE WHEN k = 0 THEN list_transform(regexp_extract_all(text, pat), lambda x: length(regexp_replace(x, '^' || key_, ''))) END AS vals FROM p, re),
u AS (SELECT r, doc_id, k, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS word, unnest(gaps[1:len(ms)]) AS gap,
        unnest(CASE WHEN k = 0 THEN vals ELSE list_transform(ms, lambda x: length(x)) END) AS size_ FROM m),
e AS (SELECT r, doc_id, k, word, size_, sum(gap + length(word)) OVER (PARTITION BY r, k ORDER BY i) AS e FROM u),
f AS (SELECT r, doc_id, k, word, e - length(word) AS s, e FROM e
      WHERE size_ >= CASE k WHEN 0 THEN 12 WHEN 1 THEN 18 ELSE 16 END),
-- samples: every document (the sample holds 2000)
plain AS (SELECT regexp_replace(regexp_replace(regexp_replace(text, key_ || val_, ' ', 'g'), 'AKIA[A-Z0-9]{14,}', ' ', 'g'), '[0-9a-f]{16,}', ' ', 'g') AS text
          FROM (SELECT DISTINCT doc_id, text FROM d), re),
samples AS (SELECT DISTINCT word, 0 AS label FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9+/_=-]{8,}')) AS word FROM plain)
  UNION SELECT word, CASE WHEN regexp_matches(word, '^[0-9a-f]+$') THEN 1 WHEN regexp_matches(word, '^[0-9A-Z]+$') THEN 2 ELSE 3 END FROM (
    SELECT unnest([sha256(text), upper(sha256(text)), to_base64(from_hex(sha256(text)))]) AS word FROM d
    UNION ALL SELECT CASE WHEN k = 0 THEN regexp_replace(word, '^' || key_, '') ELSE word END FROM f, re WHERE k < 3)),
alphabet AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-' AS abc),
codes AS (SELECT label, list_transform(string_split(word, ''), lambda c: strpos(abc, c)) AS cs FROM samples, alphabet),
steps AS (SELECT label, unnest(list_zip(list_prepend(0, cs[1:len(cs) - 1]), cs)) AS ab FROM codes),
n AS (SELECT ab[1] AS a, ab[2] AS b, label, count(*) AS n FROM steps GROUP BY ALL),
grid AS (SELECT x.i AS a, y.i AS b, l.i AS label, coalesce(n, 0) AS n FROM range(68) x(i) CROSS JOIN range(68) y(i) CROSS JOIN range(4) l(i)
  LEFT JOIN n ON a = x.i AND b = y.i AND label = l.i),
chance AS (SELECT a, b, label, CAST(n + 1 AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY a, label) + 68 AS DOUBLE) AS p FROM grid),
model AS (SELECT r.a, r.b, r.label, CAST(floor(1000 * ln(r.p / o.p)) AS BIGINT) AS v FROM chance r JOIN chance o ON o.a = r.a AND o.b = r.b AND o.label = 0 AND r.label > 0),
words AS (SELECT DISTINCT word FROM f WHERE k = 3),
ws AS (SELECT word, unnest(list_zip(list_prepend(0, cs[1:len(cs) - 1]), cs)) AS ab
       FROM (SELECT word, list_transform(string_split(word, ''), lambda c: strpos(abc, c)) AS cs FROM words, alphabet)),
scores AS (SELECT word, max(score) AS score FROM (SELECT word, label, sum(v) AS score FROM ws JOIN model ON a = ab[1] AND b = ab[2] GROUP BY word, label) GROUP BY word),
kept AS (SELECT r, k, s, e FROM f WHERE k < 3
  UNION ALL SELECT r, k, s, e FROM f JOIN scores USING (word)
    WHERE k = 3 AND score >= 10000 AND NOT EXISTS (SELECT 1 FROM f b WHERE b.k < 3 AND b.r = f.r AND b.s <= f.s AND b.e >= f.e)),
named AS (SELECT *, ['assign', 'access', 'hex', 'random'][k + 1] || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS t FROM kept)
SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  sha256(coalesce(string_agg(t, ',' ORDER BY s, k) FILTER (k < 3), '')) AS base_sha256, coalesce(string_agg(t, ',' ORDER BY s, k), '') AS spans
FROM d LEFT JOIN named USING (r) GROUP BY r, doc_id""",
    "op12_conversation_repair": r"""
WITH RECURSIVE
bit8 AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(CAST(n AS BIGINT), CAST(range(8) AS BIGINT[])),
           lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS t),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key_ FROM conversations),
-- CRC-32 by its table, over the characters of the key (digits, sign, colon, space)
crc AS (SELECT key_, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key_, ''), lambda x: CAST(ascii(x) AS BIGINT))),
          lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295) % 20 AS k FROM (SELECT DISTINCT key_ FROM src), bit8),
hit AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
          CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
          unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy_ FROM src JOIN crc USING (key_) WHERE k <> 0),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM hit),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last_ FROM p),
r AS (SELECT *, CASE WHEN last_ = '' THEN 'b' WHEN again THEN 'd' WHEN last_ NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault, left(role, 1) AS c,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
            count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM r GROUP BY conv_id),
-- from the last row to the first: per state (after nothing, s, u, a) the least (cost, audit) of what follows, and its lines
best(conv_id, i, v0, v1, v2, v3) AS (
  SELECT conv_id, n, {c: 0, e: '', l: []::VARCHAR[]}, {c: 6, e: 'II', l: ['user:', 'assistant:']}, {c: 3, e: 'I', l: ['assistant:']}, {c: 0, e: '', l: []::VARCHAR[]} FROM stats
  UNION ALL
  SELECT conv_id, i, least(w0, {c: m2.c + 3, e: 'I' || m2.e, l: list_prepend('user:', m2.l)}), least(w1, {c: m2.c + 3, e: 'I' || m2.e, l: list_prepend('user:', m2.l)}),
    m2, least(w3, {c: m2.c + 3, e: 'I' || m2.e, l: list_prepend('user:', m2.l)})
  FROM (SELECT *, least(w2, {c: w3.c + 3, e: 'I' || w3.e, l: list_prepend('assistant:', w3.l)}) AS m2
    FROM (SELECT b.conv_id, b.i - 1 AS i,
        least({c: v0.c + 4, e: 'D' || v0.e, l: v0.l}, {c: v2.c + x + 3, e: 'R' || v2.e, l: list_prepend('user:' || text, v2.l)},
              CASE c WHEN 's' THEN {c: v1.c + x, e: 'K' || v1.e, l: list_prepend(role || ':' || text, v1.l)}
                     WHEN 'u' THEN {c: v2.c + x, e: 'K' || v2.e, l: list_prepend(role || ':' || text, v2.l)} END) AS w0,
        least({c: v1.c + 4, e: 'D' || v1.e, l: v1.l}, {c: v2.c + x + 3, e: 'R' || v2.e, l: list_prepend('user:' || text, v2.l)},
              CASE c WHEN 'u' THEN {c: v2.c + x, e: 'K' || v2.e, l: list_prepend(role || ':' || text, v2.l)} END) AS w1,
        least({c: v2.c + 4, e: 'D' || v2.e, l: v2.l}, {c: v3.c + x + 3, e: 'R' || v3.e, l: list_prepend('assistant:' || text, v3.l)},
              CASE c WHEN 'a' THEN {c: v3.c + x, e: 'K' || v3.e, l: list_prepend(role || ':' || text, v3.l)} END) AS w2,
        least({c: v3.c + 4, e: 'D' || v3.e, l: v3.l}, {c: v2.c + x + 3, e: 'R' || v2.e, l: list_prepend('user:' || text, v2.l)},
              CASE c WHEN 'u' THEN {c: v2.c + x, e: 'K' || v2.e, l: list_prepend(role || ':' || text, v2.l)} END) AS w3
      FROM best b JOIN (SELECT conv_id AS id, i AS at, role, text, c, CASE fault WHEN 'b' THEN 1000000 WHEN 'd' THEN 1000000 WHEN 't' THEN 3 ELSE 0 END AS x FROM r) y
        ON y.id IS NOT DISTINCT FROM b.conv_id AND y.at = b.i)))
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(v0.c, 0) AS BIGINT) AS cost, coalesce(v0.e, '') AS audit,
  sha256(coalesce(array_to_string(v0.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM ids.conv_id AND i = 0""",
    "op13_ranked_search": r"""
WITH t AS (SELECT rowid_, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM (SELECT *, row_number() OVER () AS rowid_ FROM documents)),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT rowid_, count(*) AS n FROM t GROUP BY rowid_),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
f AS (SELECT rowid_, doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term), total),
g AS (SELECT rowid_, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))) AS gain
      FROM f JOIN w USING (term) JOIN n USING (rowid_), total),
s AS (SELECT item_id, rowid_, doc_id, CAST(sum(gain) AS BIGINT) AS score FROM q JOIN g USING (term) GROUP BY ALL),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 10""",
}
