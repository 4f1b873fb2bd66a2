"""The operators' queries over the given tables, and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.audit import filter_audit, text_failures
from gleaner.llm.centroids import clustered
from gleaner.llm.common import table
from gleaner.llm.exact import exact_groups
from gleaner.llm.html import extracted
from gleaner.llm.jaccard import linked
from gleaner.llm.language import languages
from gleaner.llm.mixing import mixed
from gleaner.llm.packing import packed
from gleaner.llm.passages import without_repeated_bytes, without_repeated_words
from gleaner.llm.quality import judged
from gleaner.llm.search import nearest
from gleaner.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_words(table(spark, sf_dir, "documents")).drop("kept")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents")).drop("root", "text_hash")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).drop("source")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op9_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings")).drop("compared")


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(text_failures(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_search": op1_search,
    "op2_substrings": op2_substrings,
    "op3_jaccard": op3_jaccard,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_suffixes": op6_suffixes,
    "op7_language": op7_language,
    "op8_html": op8_html,
    "op9_exact": op9_exact,
    "op10_quality": op10_quality,
    "op11_centroids": op11_centroids,
    "op12_audit": op12_audit,
    "op13_toxicity": op13_toxicity,
}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"
_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

# One round of op11: r<n> are centroids, r<m> the next ones.
_ROUND = """r{n}_near AS MATERIALIZED (
  SELECT rid, k FROM (
    SELECT rid, k, row_number() OVER (PARTITION BY rid ORDER BY d, k) AS place FROM (
      SELECT rid, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
      FROM points, r{n})) WHERE place = 1),
r{m} AS MATERIALIZED (
  SELECT k, list(x ORDER BY dim) AS c FROM (
    SELECT k, dim, ((s - ((s % n + n) % n)) // n)::BIGINT AS x FROM (
      SELECT k, dim, sum(v[dim])::BIGINT AS s, count(*) AS n
      FROM r{n}_near JOIN points USING (rid), generate_series(1, 64) AS g(dim) GROUP BY k, dim)) GROUP BY k
  UNION ALL
  SELECT k, c FROM r{n} WHERE k NOT IN (SELECT k FROM r{n}_near)),
"""

ORACLES: dict[str, str] = {
    "op1_search": """
WITH vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS rank
  FROM vectors q JOIN vectors c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
WHERE rank <= 20
""",
    "op4_mixing": f"""
WITH docs AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT AS h
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT source, source_size, 2 * source_size AS cap,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sums),
levels AS (
  SELECT *, cap::DOUBLE / weight AS filled,
         (1.5::DOUBLE * (SELECT sum(source_size) FROM sums)::DOUBLE
          - coalesce(sum(cap) OVER before, 0)::DOUBLE)
         / ((SELECT sum(weight) FROM ranked)
            - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM ranked
  WINDOW before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT max(level) AS water FROM levels WHERE level <= filled),
targets AS (
  SELECT source, source_size,
         CASE WHEN water IS NULL OR filled <= water THEN cap::DOUBLE ELSE weight * water END AS target
  FROM levels, water),
plan AS (
  SELECT *, round(target)::BIGINT AS aim,
         CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS whole
  FROM targets)
SELECT doc_id, size, source_size, target,
       (whole * size + CASE WHEN room > 0 AND 2 * room >= size THEN size ELSE 0 END)::BIGINT AS taken
FROM (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         p.aim - p.whole * p.source_size - coalesce(
            sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
  FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
""",
    "op9_exact": f"""
WITH docs AS (SELECT doc_id, {_NORMAL} AS content FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(content) AS text_sha256
FROM docs WINDOW same AS (PARTITION BY content)
""",
    "op11_centroids": f"""
WITH points AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id,
         list_transform(embedding::DOUBLE[], lambda x: floor(64 * x)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r0 AS (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS k, v AS c
  FROM (SELECT sha256('1:' || vec_id::VARCHAR) AS h, v FROM points) ORDER BY h NULLS LAST, v LIMIT 16),
{_ROUND.format(n=0, m=1)}{_ROUND.format(n=1, m=2)}{_ROUND.format(n=2, m=3)}last AS (
  SELECT rid, k, d FROM (
    SELECT rid, k, d, row_number() OVER (PARTITION BY rid ORDER BY d, k) AS place FROM (
      SELECT rid, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
      FROM points, r3)) WHERE place = 1)
SELECT vec_id, k::INT AS cluster, d AS distance,
       (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM last JOIN points USING (rid) JOIN r3 USING (k)
""",
    "op12_audit": r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
docs AS (
  SELECT part,
         (len(words) < 200)::INT
         + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * len(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * len(body))::INT
         + 8 * regexp_matches(body, '[#$%&*|]')::INT
         + 16 * coalesce(doc_id > first, false)::INT AS fails,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM texts),
filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS name, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT '' AS filter_order, 0 AS used
  UNION ALL
  SELECT filter_order || name, used + bit FROM orders JOIN filters ON used & bit = 0),
steps AS (
  SELECT filter_order, step, bit,
         (SELECT coalesce(sum(f.bit), 0) FROM filters f
          WHERE instr(filter_order, f.name) BETWEEN 1 AND step - 1)::INT AS before
  FROM (SELECT filter_order FROM orders WHERE used = 31), generate_series(1, 5) AS s(step)
  JOIN filters ON name = substr(filter_order, step, 1)),
tallies AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM docs GROUP BY part, fails),
counts AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (fails & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (fails & bit > 0 AND fails & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails & bit > 0 AND fails & before > 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (fails & bit > 0 AND fails & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (fails & bit > 0 AND fails & before = 0), 0)::BIGINT AS toxic_lost
  FROM tallies, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counts
""",
}
