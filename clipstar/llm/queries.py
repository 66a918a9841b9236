"""The thin ``opN_<name>`` queries: each applies its operator to its whole table and returns the whole result."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstar.llm import (
    collocations, decontaminate, deleted_interpolation, exact_dedup, flat_graph, hyperplane_tree, language, packing, pii,
    quality, simhash, urls, warc,
)
from clipstar.llm.common import read
from clipstar.session import pin_semantics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_semantics(spark)
            return fn(spark, sf_dir)
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return run
    return wrap


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM d
"""


@query(OP8_SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row of its equal texts that stays."""
    return exact_dedup.duplicate_groups(read(spark, sf_dir, "documents")) \
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id that links reach."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


OP10_SQL = r"""
WITH iw AS (
  SELECT item_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
dw AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
  FROM (SELECT DISTINCT doc_id, text FROM documents)),
si AS (
  SELECT DISTINCT item_id, text, array_to_string(w[i + 1:i + 5], ' ') AS s
  FROM (SELECT item_id, text, w, unnest(range(0, greatest(len(w) - 5, 0) + 1)) AS i FROM iw WHERE len(w) > 0)),
m AS (SELECT 5 AS m UNION SELECT DISTINCT len(w) FROM iw WHERE len(w) BETWEEN 1 AND 4),
sd AS (
  SELECT DISTINCT doc_id, text, array_to_string(w[i + 1:i + m], ' ') AS s
  FROM (SELECT doc_id, text, w, m, unnest(range(0, greatest(len(w) - m, 0) + 1)) AS i FROM dw, m WHERE len(w) > 0)),
n AS (SELECT item_id, text, count(*) AS item_shingles FROM si GROUP BY ALL),
x AS (
  SELECT sd.doc_id, si.item_id, sd.text AS dt, si.text AS it, count(*) AS shared
  FROM sd JOIN si ON sd.s = si.s GROUP BY ALL)
SELECT doc_id, x.item_id, item_shingles, shared, shared / item_shingles AS containment
FROM x JOIN n ON x.item_id IS NOT DISTINCT FROM n.item_id AND x.it = n.text
WHERE shared >= item_shingles * 0.8
"""


@query(OP10_SQL)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) of which the document contains 0.8 or more of the item's shingles."""
    return decontaminate.find_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id", "item_shingles", "shared", "containment")


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 4096 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its language by mixture inference, learnt from the folds that are not held out."""
    return language.identify(read(spark, sf_dir, "documents"))


@query()
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts, digest and offsets of its spans, with their scores."""
    return pii.find_pii(read(spark, sf_dir, "documents"), with_text=False).drop("redacted")


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (
  SELECT page_id, html, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM p),
f AS (
  SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 8), lambda g:
         array_to_string(list_transform([15, 10, 5, 0], lambda b:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((CAST('0x' || substr(hex, CAST(g * 5 + 1 AS INTEGER), 5) AS BIGINT) >> b) & 31)::INTEGER + 1, 1)), '')), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h JOIN f ON h.html = f.html
"""


@query(OP4_SQL)
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record of a dictionary-compressed archive, as read back from it."""
    return warc.archive_round_trip(spark, read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict: by the longest rule that fits its url, else by naive Bayes over its words."""
    return urls.judge(read(spark, sf_dir, "pages"))


@query()
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base score and its log10 probability under the interpolated model."""
    return deleted_interpolation.score(read(spark, sf_dir, "documents"))


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality and toxicity by co-training, and whether it is kept."""
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (
  SELECT lang, c, array_to_string(w[i + 1:i + c], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(len(w))) AS i FROM w), (SELECT unnest([1, 2, 3, 4]) AS c)
  WHERE i + c <= len(w)),
f AS (SELECT lang, phrase, c, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE c = 1 GROUP BY lang),
a AS (SELECT lang, phrase, c, f AS a, string_split(phrase, ' ') AS w FROM f WHERE c > 1 AND f >= 30),
k AS (
  SELECT lang, phrase, c, a, k, array_to_string(w[:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, c)) AS k FROM a)),
s AS (
  SELECT k.lang, k.phrase, k.a, x.f AS l, y.f AS r, (2000000::HUGEINT * k.a) // (x.f + y.f) AS score,
         row_number() OVER (PARTITION BY k.lang, k.phrase ORDER BY (2000000::HUGEINT * k.a) // (x.f + y.f), k) AS place
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = k.lp JOIN f y ON y.lang = k.lang AND y.phrase = k.rp),
i AS (
  SELECT lang, phrase, max(longer) AS longer
  FROM (SELECT lang, a AS longer, array_to_string(w[b + 1:b + m], ' ') AS phrase, b, m, c
        FROM (SELECT *, unnest(range(0, c)) AS b FROM a WHERE c > 2), (SELECT unnest([2, 3]) AS m)
        WHERE m < c AND b + m <= c)
  GROUP BY ALL),
q AS (
  SELECT s.* FROM s LEFT JOIN i ON s.lang = i.lang AND s.phrase = i.phrase
  WHERE place = 1 AND (longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)),
o AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE C) AS rank FROM q)
SELECT o.lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
"""


@query(OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 highest-scoring phrases of 2 to 4 words."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (
  SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM e
  WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
r AS (
  SELECT a AS node, a AS reached FROM l
  UNION
  SELECT r.node, l.b FROM r JOIN l ON r.reached = l.a),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node),
n AS (SELECT a AS node, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept, 1.0::DOUBLE AS audited_recall
FROM e LEFT JOIN c ON c.node = vec_id LEFT JOIN n ON n.node = vec_id
"""


@query(OP12_SQL)
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links, the smallest vec_id that links reach, and the index's audited recall."""
    return flat_graph.near_duplicates(read(spark, sf_dir, "embeddings"))


OP13_SQL = r"""
WITH r AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (
    SELECT anchor_id, id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same)
  WHERE place <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query(OP13_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive."""
    return hyperplane_tree.mine(read(spark, sf_dir, "embeddings"))
