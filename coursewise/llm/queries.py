"""The registered queries of the pipeline operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from coursewise.llm import byte_cnn, bpe, centroids, collocations, html_tree, language_id, mixing, nearest, pii, quality_rules, simhash, topk, url_filters
from coursewise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
#: Hosts with one of these in their name are on the list of op3_url_filters.
LISTED_TERMS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def tokenizer() -> str:
    return bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_table(table(spark, sf_dir, "documents"), tokenizer())


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge_urls(pages, url_filters.listed_hosts(pages, LISTED_TERMS))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "score")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_tree.extract(table(spark, sf_dir, "pages"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_table(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_table(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_quality_classifier,
        op2_bpe,
        op3_url_filters,
        op4_exact_topk,
        op5_quality_rules,
        op6_simhash,
        op7_mixing,
        op8_html_extraction,
        op9_pii,
        op10_language_id,
        op11_centroids,
        op12_collocations,
        op13_nearest,
        pipeline,
    )
}

URL_SQL = """
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM split)
), keyed AS (
  SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '(\\.html)?/*$', '') AS key FROM parts
), listed AS (
  SELECT DISTINCT key FROM keyed
  WHERE host LIKE '%ads-track%' OR host LIKE '%adult-x%' OR host LIKE '%casino-win%'
     OR host LIKE '%cheap-pills%' OR host LIKE '%free-bets%' OR host LIKE '%spam-farm%'
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), judged AS (
  SELECT p.page_id, p.host, p.path, p.key, (
    SELECT max_by({'rule': rule_host || rule_path, 'verdict': r.verdict}, length(rule_host || rule_path)) FROM rules r
    WHERE (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
  ) AS fit FROM keyed p
)
SELECT page_id, host, path, fit.rule AS rule,
  CASE WHEN fit IS NOT NULL THEN fit.verdict WHEN key IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""

TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

MIXING_SQL = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('7:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS draw
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS weight
  FROM sizes GROUP BY source
), ratios AS (  -- those with the smallest cap for their weight are clamped first
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS place FROM sources
), sums AS (
  SELECT *, coalesce(sum(2 * source_size) OVER before, 0) AS caps, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free,
    sum(source_size) OVER () * 150 AS budget
  FROM ratios WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stop AS (  -- the first place whose share fits its cap
  SELECT min_by({'left': budget - 100 * caps, 'free': free, 'place': place}, place) AS s FROM sums
  WHERE (budget - 100 * caps) * weight <= 200 * source_size * free
), targets AS (
  SELECT source, source_size, CASE WHEN s IS NULL OR place < s.place THEN (2 * source_size)::DOUBLE
    ELSE s.left::DOUBLE * weight / s.free / 100 END AS target
  FROM ratios, stop
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END AS whole FROM targets
), due AS (
  SELECT *, target - whole * source_size AS due FROM plan
), numbered AS (
  SELECT s.*, p.source_size, p.target, p.whole, p.due,
    row_number() OVER (PARTITION BY s.source ORDER BY size = 0, draw) AS place  -- those without words come last
  FROM sizes s JOIN due p ON s.source IS NOT DISTINCT FROM p.source
), pass AS (  -- document by document: one that fits into the room is taken, others are passed over
  SELECT source, 0::BIGINT AS place, floor(due)::BIGINT AS room, false AS taken FROM due
  UNION ALL
  SELECT n.source, n.place, CASE WHEN n.size <= p.room THEN p.room - n.size ELSE p.room END, n.size BETWEEN 1 AND p.room
  FROM pass p JOIN numbered n ON n.source IS NOT DISTINCT FROM p.source AND n.place = p.place + 1
), rest AS (
  SELECT d.source, min(p.room) + d.due - floor(d.due) AS missing FROM pass p JOIN due d ON p.source IS NOT DISTINCT FROM d.source GROUP BY d.source, d.due
), chosen AS (
  SELECT n.*, p.taken, NOT p.taken AND n.size > 0 AND n.size < 2 * r.missing AS spare
  FROM numbered n JOIN pass p ON n.source IS NOT DISTINCT FROM p.source AND n.place = p.place JOIN rest r ON n.source IS NOT DISTINCT FROM r.source
), marked AS (  -- the smallest document left, if it brings the source nearer
  SELECT *, spare AND row_number() OVER (PARTITION BY source ORDER BY spare DESC, size, draw, place) = 1 AS fill FROM chosen
)
SELECT doc_id, size, source_size, target, (size * least(whole + CASE WHEN taken OR fill THEN 1 ELSE 0 END, 2))::BIGINT AS taken FROM marked
"""

#: One round over the table c0 of centroids (c, vec); dist is exact in doubles for vectors of this size.
ASSIGN_SQL = """
nearest{0} AS MATERIALIZED (
  SELECT rid, arg_min(c, [d, c]) AS c, min(d) AS d FROM (
    SELECT v.rid, k.c, list_inner_product(v.vec, v.vec) - 2 * list_inner_product(v.vec, k.vec) + list_inner_product(k.vec, k.vec) AS d
    FROM v CROSS JOIN c{0} k
  ) GROUP BY rid
)"""
MOVE_SQL = """
c{1} AS MATERIALIZED (
  SELECT c, coalesce(m.vec, k.vec) AS vec FROM c{0} k LEFT JOIN (
    SELECT c, list(floor(s / n) ORDER BY i) AS vec FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n
      FROM (SELECT a.c, unnest(v.vec) AS x, generate_subscripts(v.vec, 1) AS i FROM nearest{0} a JOIN v USING (rid)) GROUP BY c, i
    ) GROUP BY c
  ) m USING (c)
)"""
CENTROID_SQL = (
    """
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS vec FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), vec) - 1 AS c, vec FROM v
  QUALIFY c < 8
),"""
    + ",".join(ASSIGN_SQL.format(i) + "," + MOVE_SQL.format(i, i + 1) for i in range(10))
    + ","
    + ASSIGN_SQL.format(10)
    + """
SELECT v.vec_id, a.c::INTEGER AS cluster, a.d::BIGINT AS distance,
  (sum(a.d::BIGINT) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(a.d::BIGINT) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(k.vec, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM nearest10 a JOIN v USING (rid) JOIN c10 k USING (c)
"""
)

COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, m, unnest([array_to_string(w[i : i + m - 1], ' ') FOR i IN range(1, len(w) - m + 2)]) AS phrase
  FROM words CROSS JOIN (VALUES (1), (2), (3), (4)) AS sizes(m)
), totals AS (
  SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang
), f AS MATERIALIZED (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase
), candidates AS MATERIALIZED (
  SELECT lang, m, phrase, f AS a, str_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 30
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 :], ' ') AS rest
  FROM candidates JOIN (VALUES (1), (2), (3)) AS places(k) ON k < m
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head JOIN f y ON y.lang = c.lang AND y.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates c
    WHERE c.lang = s.lang AND c.m > len(str_split(s.phrase, ' ')) AND 100 * c.a >= 80 * s.a AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')
  )
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op3_url_filters": URL_SQL,
    "op4_exact_topk": TOPK_SQL,
    "op7_mixing": MIXING_SQL,
    "op11_centroids": CENTROID_SQL,
    "op12_collocations": COLLOCATION_SQL,
}
