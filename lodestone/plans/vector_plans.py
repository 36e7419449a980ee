"""Vector and keyword search, ranking metrics, thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.catalog import load
from lodestone.operators import metrics, vector
from lodestone.plans.registry import query

#: Every row is searched; every fiftieth is a query.
QUERIES = "vec_id % 50 = 0"
DOT = "list_sum(list_transform(range(1, {n} + 1), lambda i: a.v[i] * b.v[i]))"
VECTORS = "v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
CUT = "h AS (SELECT vec_id, label, v[1:16] AS v FROM v), v16 AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM h)"


def _ranked(name, table, n):
    return f"""{name} AS (SELECT a.vec_id AS query_id, b.vec_id, round({DOT.format(n=n)}, 9) AS score, a.label = b.label AS hit, row_number() OVER (PARTITION BY a.vec_id ORDER BY round({DOT.format(n=n)}, 9) DESC, b.vec_id) AS rank
  FROM {table} a JOIN {table} b ON a.vec_id <> b.vec_id WHERE a.{QUERIES} QUALIFY rank <= 10)"""


def embeddings(spark, sf_dir):
    return load(spark, sf_dir, "embeddings")


def searched(spark, sf_dir):
    e = embeddings(spark, sf_dir)
    return vector.top_k(e, e.filter(QUERIES), 10, "vec_id", "vec_id", "embedding", exclude_self=True)


def truncated(spark, sf_dir):
    e = embeddings(spark, sf_dir).withColumn("embedding", vector.truncate(F.col("embedding"), 16))
    return vector.top_k(e, e.filter(QUERIES), 10, "vec_id", "vec_id", "embedding", exclude_self=True)


@query("unit_vectors", f"WITH {VECTORS} SELECT vec_id, len(v) = 64 AND abs(list_sum(list_transform(v, lambda x: x * x)) - 1) < 1e-3 AS valid FROM v")
def _(spark, sf_dir):
    return embeddings(spark, sf_dir).select("vec_id", vector.is_unit(F.col("embedding"), 64).alias("valid"))


@query("topk_cosine", f"WITH {VECTORS}, {_ranked('t', 'v', 64)} SELECT query_id, vec_id, round(score, 6) AS score, rank FROM t")
def _(spark, sf_dir):
    return searched(spark, sf_dir).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@query("topk_truncated", f"WITH {VECTORS}, {CUT}, {_ranked('t', 'v16', 16)} SELECT query_id, vec_id, round(score, 6) AS score, rank FROM t")
def _(spark, sf_dir):
    return truncated(spark, sf_dir).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@query("topk_overlap", f"WITH {VECTORS}, {CUT}, {_ranked('t', 'v', 64)}, {_ranked('u', 'v16', 16)} SELECT t.query_id, count(u.vec_id) / 10 AS overlap FROM t LEFT JOIN u ON t.query_id = u.query_id AND t.vec_id = u.vec_id GROUP BY t.query_id")
def _(spark, sf_dir):
    return vector.overlap(searched(spark, sf_dir), truncated(spark, sf_dir), "vec_id", 10)


METRICS = """r AS (SELECT query_id, sum(CASE WHEN rank <= 5 AND hit THEN 1 ELSE 0 END) / 5 AS p5, sum(hit::INT) / 10 AS p10, coalesce(1 / min(CASE WHEN hit THEN rank END), 0) AS rr, max(CASE WHEN rank = 1 THEN hit::INT END) AS h1,
  sum(hit::INT / log2(rank + 1)) AS dcg, sum(hit::INT) AS hits FROM t GROUP BY query_id), base AS (SELECT label, count(*) / (SELECT count(*) FROM v) AS rate, count(*) - 1 AS wanted FROM v GROUP BY label)"""


@query(
    "ranking_metrics",
    f"""WITH {VECTORS}, {_ranked('t', 'v', 64)}, {METRICS} SELECT r.query_id, p5 AS precision_at_5, p10 AS precision_at_10, round(rr, 6) AS reciprocal_rank, h1 AS hit_at_1,
  round(CASE WHEN wanted > 0 THEN dcg / list_sum(list_transform(range(1, least(10, wanted) + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 6) AS ndcg_at_10, round(p10 / rate, 6) AS lift_at_10 FROM r JOIN v ON r.query_id = v.vec_id JOIN base ON v.label = base.label""",
)
def _(spark, sf_dir):
    return ranked(spark, sf_dir)


def ranked(spark, sf_dir):
    labels = embeddings(spark, sf_dir).select("vec_id", "label")
    total = labels.agg(F.count(F.lit(1)).alias("n"))
    base = labels.groupBy("label").agg(F.count(F.lit(1)).alias("c")).join(total).select("label", (F.col("c") / F.col("n")).alias("base"), (F.col("c") - 1).alias("relevant"))
    hits = searched(spark, sf_dir).join(labels, "vec_id").join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("wanted")), "query_id")
    hits = hits.join(base.withColumnRenamed("label", "wanted"), "wanted").withColumn("hit", (F.col("label") == F.col("wanted")).cast("int"))
    out = metrics.ranking_metrics(hits, "query_id", "rank", "hit", "base", "relevant")
    return out.select("query_id", "precision_at_5", "precision_at_10", F.round("reciprocal_rank", 6).alias("reciprocal_rank"), "hit_at_1", F.round("ndcg_at_10", 6).alias("ndcg_at_10"), F.round("lift_at_10", 6).alias("lift_at_10"))


@query(
    "score_threshold",
    f"WITH {VECTORS}, {_ranked('t', 'v', 64)}, s AS (SELECT rank = 1 AS on_topic, CASE WHEN rank = 1 THEN score + 1 ELSE score END AS score FROM t) SELECT min_on, max_off, round((min_on + max_off) / 2, 4) AS threshold FROM (SELECT round(min(score) FILTER (on_topic), 6) AS min_on, round(max(score) FILTER (NOT on_topic), 6) AS max_off FROM s)",
)
def _(spark, sf_dir):
    s = searched(spark, sf_dir).select((F.col("rank") == 1).alias("on_topic"), F.round(F.col("score") + F.when(F.col("rank") == 1, 1.0).otherwise(0.0), 6).alias("score"))
    return vector.threshold(s, "score", F.col("on_topic"))


#: The words that this search leaves out, so that its SQL can name them.
STOP = ["the", "a", "an", "of", "and", "in", "to", "is", "that", "it", "on", "for", "was", "with", "as", "at", "by", "be", "this", "or"]
_STOP = ", ".join(f"'{w}'" for w in STOP)
TFIDF = f"""words AS (SELECT doc_id AS id, unnest(regexp_extract_all(lower(text), '[\\pL\\pN\\pM_]{{2,}}')) AS term FROM documents),
tf AS (SELECT id, term, count(*) AS tf FROM words WHERE term NOT IN ({_STOP}) GROUP BY ALL),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term HAVING count(*) >= 2),
dw AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (term)), dn AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM dw),
qwords AS (SELECT item_id AS q, unnest(regexp_extract_all(lower(text), '[\\pL\\pN\\pM_]{{2,}}')) AS term FROM benchmark),
qtf AS (SELECT q, term, count(*) AS tf FROM qwords WHERE term NOT IN ({_STOP}) GROUP BY ALL),
qw AS (SELECT q, term, (1 + ln(tf)) * idf AS w FROM qtf JOIN idf USING (term)), qn AS (SELECT q, term, w / sqrt(sum(w * w) OVER (PARTITION BY q)) AS w FROM qw),
sc AS (SELECT q AS query_id, id AS doc_id, round(sum(qn.w * dn.w), 9) AS score FROM qn JOIN dn USING (term) GROUP BY ALL)"""


@query("tfidf_topk", f"WITH {TFIDF} SELECT query_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc QUALIFY rank <= 10")
def _(spark, sf_dir):
    out = vector.tfidf_top_k(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"), 10, "doc_id", "item_id", "text", stop=STOP)
    return out.select("query_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@query("nearest_by_label", f"WITH {VECTORS}, {_ranked('t', 'v', 64)} SELECT query_id, count(*) FILTER (hit) AS same_label FROM t GROUP BY query_id")
def _(spark, sf_dir):
    labels = embeddings(spark, sf_dir).select("vec_id", "label")
    pairs = searched(spark, sf_dir).join(labels, "vec_id").join(labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("wanted")), "query_id")
    return pairs.groupBy("query_id").agg(F.count_if(F.col("label") == F.col("wanted")).alias("same_label"))


