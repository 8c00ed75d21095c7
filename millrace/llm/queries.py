"""One query per corpus operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import language_id
from millrace.llm.centroids import Clustering, clustered
from millrace.llm.decontamination import contaminations
from millrace.llm.fixity import audited, warc_record
from millrace.llm.html_text import extract
from millrace.llm.license_scan import scan
from millrace.llm.packing import Packing, pack
from millrace.llm.part_enum import Join, grouped
from millrace.llm.prefix_trie import ordered_turns, prefix_trie
from millrace.llm.quality_rules import quality_rules
from millrace.llm.rule_ensemble import fit, held_out, score
from millrace.llm.secret_scan import digest, find_secrets
from millrace.llm.token_store import Store, read_store, write_store
from millrace.queries.registry import Query, table
from millrace.session import work_path

QUERIES: dict[str, Query] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its own name."""

    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[run.__name__] = Query(run, sql)
        return run

    return register


def fitted_on_labels(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality scores of ``docs``, learned from the labels that may be learned from."""
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return score(docs, fit(docs, labels.select("doc_id", F.col("quality").alias("label"))))


@query()
def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = fitted_on_labels(spark, table(spark, sf_dir, "documents"), sf_dir)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query()
def op8_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


@query()
def op2_elias_fano_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), folder, Store(public_tokenizers.path("word_bpe_49k.json")))
    return read_store(spark, folder)


@query()
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Packing(public_tokenizers.path("byte_bpe_50k.json")))


@query()
def op9_part_enum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(table(spark, sf_dir, "documents"), Join(shingle=3, percent=90))


@query()
def op6_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_rare_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


@query()
def op5_tree_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


FIXITY_SQL = """
WITH records AS (
  SELECT page_id, page_id // 2000 AS file,
    strlen('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
      || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Type: text/html' || chr(13) || chr(10)
      || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10))
      + strlen(coalesce(html, '')) + 4 AS n_bytes
  FROM pages),
placed AS (
  SELECT *, coalesce(sum(n_bytes) OVER (PARTITION BY file ORDER BY page_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
  FROM records)
SELECT page_id AS record_id, file, "offset", n_bytes,
  CASE WHEN page_id % 89 = 3 THEN 'missing' ELSE 'corrupt' END AS status
FROM placed WHERE page_id % 89 = 3 OR page_id % 53 = 7
"""


@query(FIXITY_SQL)
def op4_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive records against a replica that lacks some and has others with a byte changed."""
    pages = table(spark, sf_dir, "pages")
    records = pages.select(F.col("page_id").alias("record_id"), warc_record(F.col("url"), F.col("html")).alias("record"))
    damaged = F.concat(F.expr("left(record, octet_length('WARC/1.') )"), F.lit("0"), F.expr("substr(record, 9)"))
    replica = records.where("record_id % 89 <> 3").withColumn(
        "record", F.when(F.col("record_id") % 53 == 7, damaged).otherwise(F.col("record"))
    )
    return audited(records, replica)


@query()
def op3_viterbi_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.held_out()
    predicted = language_id.predict(docs, language_id.fit(docs.where(~held_out)))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query()
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_secrets(table(spark, sf_dir, "documents")))


def clusters_sql(how: Clustering = Clustering()) -> str:
    """All rounds written out: distances to every centroid, then floors of the means."""

    def assigned(number: int) -> str:
        return f"""
a{number} AS (
  SELECT vec_id, vec, list_position(ds, list_min(ds))::INTEGER - 1 AS cluster, list_min(ds)::BIGINT AS distance
  FROM (SELECT vec_id, vec, list_transform(cs, lambda c: list_sum(list_transform(list_zip(vec, c),
      lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS ds
    FROM kept, (SELECT list(c ORDER BY j) AS cs FROM c{number})))"""

    def moved(number: int) -> str:
        return f"""
s{number} AS (
  SELECT cluster, i, sum(v)::BIGINT AS s, count(*) AS n
  FROM (SELECT cluster, unnest(range(1, {how.dims + 1})) AS i, unnest(vec) AS v FROM a{number}) GROUP BY cluster, i),
c{number + 1} AS (
  SELECT j, coalesce(m, c) AS c FROM c{number} LEFT JOIN (
    SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY i) AS m FROM s{number} GROUP BY cluster) ON cluster = j)"""

    steps = [assigned(0)]
    for number in range(how.rounds):
        steps += [moved(number), assigned(number + 1)]
    last = how.rounds
    return f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({how.scale} * x::DOUBLE)::BIGINT) AS vec FROM embeddings
  WHERE len(embedding) = {how.dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {how.dims}),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('{how.seed}:' || coalesce(vec_id::VARCHAR, '')), vec) - 1 AS j, vec AS c
  FROM kept QUALIFY j < {how.k}),{",".join(steps)}
SELECT vec_id, cluster, distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} ON cluster = j
"""


@query(clusters_sql())
def op13_heap_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(table(spark, sf_dir, "embeddings"))


def rebuilt_turns(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The first ``crc32(conv_id) % 6`` turns of the conversation at the hundred below, then a conversation's own
    turns after as many of its own."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("bigint")
    base = F.col("conv_id") - F.col("conv_id") % 100
    sizes = turns.where("conv_id % 100 = 0 and place <= 5").groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("size"))
    own = turns.withColumns({"base": base, "head": head}).where("place > head").join(sizes, "base", "left")
    place = F.col("place") - F.col("head") + F.least("head", F.coalesce("size", F.lit(0)))
    own = own.select("conv_id", place.alias("place"), "key1", "key2", "chars")
    first = turns.where("conv_id % 100 = 0 and place <= 5").withColumnRenamed("conv_id", "base")
    lent = conversations.withColumns({"base": base, "head": head}).join(first, "base").where("place <= head")
    return own.unionByName(lent.select("conv_id", "place", "key1", "key2", "chars"))


TRIE_SQL = """
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base FROM ordered),
crc AS (SELECT i AS b, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END) AS v FROM range(256) t(i)),
crcs AS (SELECT list(v ORDER BY b) AS vs FROM crc),
convs AS (
  SELECT conv_id, base, (xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda x, y: xor(vs[(xor(x, y) & 255) + 1], x >> 8)), 4294967295::BIGINT) % 6)::BIGINT AS h
  FROM ids, crcs),
turns AS (
  SELECT c.conv_id, o.i AS k, role, text FROM convs c JOIN ordered o ON o.conv_id = c.base AND o.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1000000 + o.i, role, text FROM convs c JOIN ordered o ON o.conv_id = c.conv_id AND o.i > c.h),
placed AS (
  SELECT conv_id, length(text) AS chars, row_number() OVER w AS depth,
    md5(string_agg(md5(role || '|' || length(role) || '|' || text), '') OVER w) AS p
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
rows_ AS (
  SELECT conv_id, depth, chars, p, coalesce(lag(p) OVER (PARTITION BY conv_id ORDER BY depth), '') AS q FROM placed
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM convs),
lasts AS (SELECT conv_id, max(depth) AS depth, max_by(p, depth) AS p FROM rows_ GROUP BY conv_id),
ends AS (SELECT depth, p, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM lasts GROUP BY ALL),
nodes AS (SELECT depth, p, max(q) AS q, min(conv_id) AS conv_id, count(*) AS n, max(chars) AS chars FROM rows_ GROUP BY depth, p),
kids AS (SELECT depth - 1 AS depth, q AS p, count(*) AS kids FROM nodes WHERE depth > 0 GROUP BY ALL),
-- Each node with all that lies on the path of its own smallest member.
under AS (
  SELECT r.depth, r.p, x.n, x.chars, x.depth AS x_depth, x.p AS x_p
  FROM nodes x JOIN rows_ r ON r.conv_id = x.conv_id AND r.depth <= x.depth),
sums AS (
  SELECT u.depth, u.p, sum((u.n - 1) * u.chars) AS saved, count(*) FILTER (k.kids IS NULL) AS leaves
  FROM under u LEFT JOIN kids k ON k.depth = u.x_depth AND k.p = u.x_p GROUP BY ALL)
SELECT n.conv_id, n.depth, parent.conv_id AS parent_conv_id, n.n AS n_convs, coalesce(k.kids, 0) AS n_children,
  s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.p = n.p
LEFT JOIN kids k ON k.depth = n.depth AND k.p = n.p
LEFT JOIN ends e ON e.depth = n.depth AND e.p = n.p
LEFT JOIN nodes parent ON parent.depth = n.depth - 1 AND parent.p = n.q
"""


@query(TRIE_SQL)
def op12_truncation_peeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ordered_turns(table(spark, sf_dir, "conversations"))
    conversations = turns.select("conv_id").distinct()
    return prefix_trie(rebuilt_turns(turns, conversations), conversations).drop("p1", "p2")
