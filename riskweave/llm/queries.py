"""One query per training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.ann import ann_search
from riskweave.llm.chat import format_conversations, read_conversations
from riskweave.llm.common import reader
from riskweave.llm.dropout import decode_documents, encode_documents
from riskweave.llm.extraction import extract_main_text
from riskweave.llm.lines import dedup_lines
from riskweave.llm.merkle import folded, lower_ascii, manifest, proof_digest
from riskweave.llm.ngram_join import ngram_jaccard_join
from riskweave.llm.packing import pack_documents
from riskweave.llm.spelling import spelling_variants
from riskweave.llm.substrings import dedup_substrings, kept_sha256
from riskweave.llm.topk import exact_topk
from riskweave.llm.toxicity import toxicity
from riskweave.llm.warc import archive_pages, page_of, read_packages
from riskweave.session import shared_dir


def bpe_files() -> tuple[str, str]:
    """Rank file and split pattern of the public 50k byte-level BPE."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned outside the held-out fold."""
    return toxicity(reader(spark, sf_dir, "documents"), reader(spark, sf_dir, "labels"))


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one that imitates the marks, read back from their windows."""
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)],
                                  "conv_id long, turn long, role string, text string")
    turns = reader(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_conversations(format_conversations(turns, *bpe_files(), budget=512, history=128))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per document after removing 13-word runs that an earlier document holds."""
    out = dedup_substrings(reader(spark, sf_dir, "documents"), window=13)
    return out.select("doc_id", "n_words", "n_removed", kept_sha256().alias("kept_sha256"))


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document after keeping one of each component of similar lines."""
    out = dedup_lines(reader(spark, sf_dir, "documents"), threshold=0.8)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op5_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under merge-dropout, and the digest of the text they decode to."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    ids = encode_documents(reader(spark, sf_dir, "documents"), model, rate=0.1, seed=1)
    return decode_documents(ids, model).select(
        "doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector over all others."""
    return exact_topk(reader(spark, sf_dir, "embeddings"), every=20, k=20, scale=64.0)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document at 5-word Jaccard similarity 0.8."""
    return ngram_jaccard_join(reader(spark, sf_dir, "documents"), n=5, threshold=0.8)


def op8_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found for every 100th vector."""
    return ann_search(reader(spark, sf_dir, "embeddings"), every=100, k=10)


def op9_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in ZIP packages, read back by range."""
    packages = archive_pages(reader(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return read_packages(packages, with_payload=False).select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of("refers_to").alias("refers_to"))


def packed(docs: DataFrame) -> DataFrame:
    """Pieces in windows of 1024 tokens, with a checksum of their ids."""
    out = pack_documents(docs, *bpe_files(), size=1024)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens."""
    return packed(reader(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one letter of every 31st (document, word) lost, and their forms."""
    return spelling_variants(reader(spark, sf_dir, "documents"), drop_one_in=31)


LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and roots of every document, and whether its leaf, tampered
    with in every third document, still gives the root."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(third, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    tree = manifest(reader(spark, sf_dir, "documents"), "lang", "doc_id", LEAF_FIELDS, altered={"text": text})
    return (tree.withColumn("folded_root", folded(F.col("path"), F.col("tampered")))
            .select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = extract_main_text(reader(spark, sf_dir, "pages"), carry=("url",))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_chat_windows, op3_substring_dedup, op4_fuzzy_lines, op5_merge_dropout, op6_exact_topk,
        op7_ngram_jaccard, op8_cross_polytope, op9_warc_zip, op10_packing, op11_spelling_variants, op12_merkle_manifest,
        op13_html_extraction)
}

SQL: dict[str, str] = {}

SQL["op3_substring_dedup"] = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
p AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13),
h AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS w FROM p),
m AS (
  SELECT w, min(doc_id) AS source FROM h GROUP BY w HAVING min(doc_id) < max(doc_id)),
hit AS (
  SELECT DISTINCT h.doc_id, unnest(range(h.i, h.i + 13)) AS i FROM h JOIN m USING (w) WHERE m.source < h.doc_id),
gone AS (
  SELECT doc_id, list(i) AS gone FROM hit GROUP BY doc_id),
k AS (
  SELECT d.doc_id, d.ws, coalesce(g.gone, []) AS gone,
         list_filter(range(1, len(d.ws) + 1), lambda j: NOT list_contains(coalesce(g.gone, []), j)) AS stay
  FROM d LEFT JOIN gone g USING (doc_id))
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(stay))::BIGINT AS n_removed,
       sha256(array_to_string(list_transform(stay, lambda j: ws[j]), ' ')) AS kept_sha256
FROM k
"""

SQL["op6_exact_topk"] = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""

SQL["op9_warc_zip"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex,
         max(page_id) OVER (PARTITION BY html) AS top FROM p),
b AS (
  SELECT *, list_transform(range(0, 32), lambda i:
    (('0x' || substr(hex, (i * 5 // 4 + 1)::INT, 2))::BIGINT // [8, 4, 2, 1][(i % 4 + 1)::INT]) % 32) AS digits
  FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(digits, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v::INT + 1, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM b
"""

#: Unsigned crc32 of a text: the table comes from the polynomial, the bytes
#: from the hex of the text.
CRC32 = """
bits AS (
  SELECT 0 AS step, i AS c, i AS place FROM range(256) t(i)
  UNION ALL
  SELECT step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, place FROM bits WHERE step < 8),
crc AS (
  SELECT list(c ORDER BY place) AS t FROM bits WHERE step = 8)"""


def crc32_sql(text: str) -> str:
    """SQL of the crc32 of ``text``; the table ``crc`` must be in scope."""
    bytes_of = f"list_transform(range(0, octet_length(encode({text}))), lambda b: ('0x' || substr(hex(encode({text})), (2 * b + 1)::INT, 2))::BIGINT)"
    step = "xor(t[(xor(c, b) % 256 + 1)::INT], c // 256)"
    return f"xor(list_reduce({bytes_of}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295)"


SQL["op11_spelling_variants"] = rf"""
WITH RECURSIVE {CRC32.strip()},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
once AS (
  SELECT doc_id, run, count(*) AS times FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, times, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM once, crc),
made AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         times FROM hashed),
words AS (
  SELECT word, sum(times)::BIGINT AS n FROM made WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT w.word, w.n, c.word, c.n FROM words w JOIN cuts c ON c.rest = w.word
  UNION
  SELECT c.word, c.n, w.word, w.n FROM words w JOIN cuts c ON c.rest = w.word),
best AS (
  SELECT word, n, count(*) AS n_near, max(other_n) AS top,
         list(other ORDER BY other_n DESC, encode(other))[1] AS other FROM pairs GROUP BY word, n),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 10 * w.n THEN b.other END AS form,
         CASE WHEN b.top >= 10 * w.n THEN b.top END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT k.word, f.form FROM walk k JOIN forms f ON f.word = k.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk k ON k.word = f.word JOIN forms e ON e.word = k.at AND e.form IS NULL
"""

SQL["op12_merkle_manifest"] = rf"""
WITH RECURSIVE {CRC32.strip()},
d AS (
  SELECT doc_id, lang, source, n_chars, text,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0
              THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS other
  FROM documents, crc),
f AS (
  SELECT doc_id, lang, [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS a,
         [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, other] AS b FROM d),
g AS (
  SELECT doc_id, lang,
         sha256(array_to_string(list_transform(a, lambda x: coalesce(octet_length(encode(x)) || ':' || x, '-')), '')) AS leaf,
         sha256(array_to_string(list_transform(b, lambda x: coalesce(octet_length(encode(x)) || ':' || x, '-')), '')) AS other
  FROM f),
leaves AS (
  SELECT doc_id, leaf, other, coalesce('1' || lang, '0') AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY lang) AS n FROM g),
low AS (
  SELECT 0 AS level, tree, place, n, leaf AS hash FROM leaves
  UNION ALL
  SELECT level + 1, tree, place // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY place)) FROM low
  WHERE n > 1 GROUP BY level, tree, place // 8, n),
subroots AS (
  SELECT tree, hash AS subroot, level AS height,
         row_number() OVER (ORDER BY encode(tree)) - 1 AS nth, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, nth AS place, n, subroot AS hash FROM subroots
  UNION ALL
  SELECT level + 1, place // 8, (n + 7) // 8, sha256(string_agg(hash, '' ORDER BY place)) FROM high
  WHERE n > 1 GROUP BY level, place // 8, n),
top AS (
  SELECT hash AS root FROM high WHERE n = 1),
nodes AS (
  SELECT level, tree, place, hash FROM low WHERE n > 1
  UNION ALL
  SELECT s.height + h.level, s.tree, h.place, h.hash FROM subroots s JOIN high h ON h.n > 1
    AND h.place // 8 = s.nth // (8 ** (h.level + 1))::BIGINT),
sides AS (
  SELECT level, tree, place,
         coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(hash, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes WINDOW w AS (PARTITION BY level, tree, place // 8 ORDER BY place)),
steps AS (
  SELECT e.tree AS tree, e.place AS place, s.level, s.l, s.r FROM leaves e JOIN subroots t USING (tree) JOIN sides s
    ON s.tree = e.tree AND s.place = CASE WHEN s.level < t.height THEN e.place // (8 ** s.level)::BIGINT
                                          ELSE t.nth // (8 ** (s.level - t.height))::BIGINT END),
proofs AS (
  SELECT tree, place, string_agg(l || r, '' ORDER BY level) AS proof, list([l, r] ORDER BY level) AS steps
  FROM steps GROUP BY tree, place),
fold AS (
  SELECT 0 AS level, e.tree AS tree, e.place AS place, other AS h, coalesce(steps, []) AS steps FROM leaves e LEFT JOIN proofs USING (tree, place)
  UNION ALL
  SELECT level + 1, tree, place, sha256(steps[level + 1][1] || h || steps[level + 1][2]), steps FROM fold
  WHERE level < len(steps))
SELECT e.doc_id, e.leaf, t.subroot, top.root, sha256(coalesce(p.proof, '')) AS proof_sha256,
       f.h AS folded_root, f.h = top.root AS verified
FROM leaves e JOIN subroots t USING (tree) CROSS JOIN top LEFT JOIN proofs p USING (tree, place)
JOIN fold f ON f.tree = e.tree AND f.place = e.place AND f.level = len(f.steps)
"""
