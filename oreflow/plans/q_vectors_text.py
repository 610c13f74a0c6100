"""Registered vector-search and text queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from oreflow.functions.numeric import round_half_up as rh
from oreflow.operators import text as tx
from oreflow.operators import profile as pr
from oreflow.operators import vectors as vx
from oreflow.plans.registry import query
from oreflow.plans.sqlfmt import rnd
from oreflow.sources.tables import read

TOKENS_SQL = "list_filter(regexp_split_to_array(lower({t}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '')"


def _tok(t: str) -> str:
    return TOKENS_SQL.format(t=t)


CENTROIDS_SQL = """
u AS (SELECT label, i, avg(x) AS x FROM (
        SELECT label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
      GROUP BY ALL),
c AS (SELECT label, list(x ORDER BY i) AS centroid FROM u GROUP BY label)"""


def label_centroids(spark, d):
    return vx.centroids(read(spark, d, "embeddings"), "label", "embedding")


@query("vec_similarity_metrics", ops=("VEC-01", "VEC-02", "VEC-03"), sql=f"""
WITH {CENTROIDS_SQL}
SELECT e.vec_id, {rnd("list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centroid)", 5)} AS cosine,
       {rnd("list_distance(CAST(e.embedding AS DOUBLE[]), c.centroid)", 5)} AS l2,
       {rnd("list_inner_product(CAST(e.embedding AS DOUBLE[]), c.centroid)", 5)} AS dot
FROM embeddings e JOIN c USING (label)
""")
def vec_similarity_metrics(spark, d):
    e = read(spark, d, "embeddings")
    j = e.join(label_centroids(spark, d), "label")
    return j.select("vec_id", rh(vx.cosine("embedding", "centroid"), 5).alias("cosine"),
                    rh(vx.l2("embedding", "centroid"), 5).alias("l2"),
                    rh(vx.dot("embedding", "centroid"), 5).alias("dot"))


TOPK_SQL = f"""
WITH {CENTROIDS_SQL},
s AS (SELECT c.label AS query_id, e.vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centroid) AS score
      FROM c, embeddings e {{where}}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, vec_id, {rnd("score", 4)} AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
"""


@query("vec_exact_topk", ops=("VEC-04", "WN-11"), sql=TOPK_SQL.format(where=""))
def vec_exact_topk(spark, d):
    q = label_centroids(spark, d).select(F.col("label").alias("query_id"), F.col("centroid").alias("embedding"))
    t = vx.exact_topk(read(spark, d, "embeddings"), q, 5, "cosine")
    return t.select("query_id", "vec_id", rh("score", 4).alias("score"), "rank")


@query("vec_topk_filtered", ops=("VEC-05",), sql=TOPK_SQL.format(where="WHERE e.label = c.label"))
def vec_topk_filtered(spark, d):
    q = label_centroids(spark, d).select(F.col("label").alias("query_id"), F.col("centroid").alias("embedding"),
                                         "label")
    t = vx.exact_topk(read(spark, d, "embeddings"), q, 5, "cosine", same_label="label")
    return t.select("query_id", "vec_id", rh("score", 4).alias("score"), "rank")


@query("vec_ivf_all_cells", ops=("VEC-06", "VEC-07"), sql=TOPK_SQL.format(where=""))
def vec_ivf_all_cells(spark, d):
    # with every cell probed the cell search is the exact one
    q = label_centroids(spark, d).select(F.col("label").alias("query_id"), F.col("centroid").alias("embedding"))
    cells, cents = vx.ivf_index(read(spark, d, "embeddings"), "embedding", nlist=8)
    t = vx.ivf_search(cells, cents, q, k=5, nprobe=8)
    return t.select("query_id", "vec_id", rh("score", 4).alias("score"), "rank")


SUB = "list_slice({v}, 8 * j + 1, 8 * j + 8)"


@query("vec_pq_label_books", ops=("VEC-08",), sql=f"""
WITH {CENTROIDS_SQL},
j AS (SELECT unnest(range(8)) AS j),
book AS (SELECT j, label, {SUB.format(v="centroid")} AS b FROM c, j),
near AS (SELECT e.vec_id, j.j, arg_min(book.label, {{'d': list_distance({SUB.format(v="CAST(e.embedding AS DOUBLE[])").replace("j ", "j.j ")}, book.b), 'l': book.label}}) AS code
         FROM embeddings e, j JOIN book USING (j) GROUP BY ALL),
tab AS (SELECT c.label AS query_id, book.j, book.label AS code, list_distance({SUB.format(v="c.centroid").replace("j ", "book.j ")}, book.b) ** 2 AS d
        FROM c, book),
s AS (SELECT query_id, vec_id, sum(d) AS score FROM near JOIN tab USING (j, code) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {rnd("score", 9)}, vec_id) AS rank FROM s)
SELECT query_id, vec_id, {rnd("score", 6)} AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5
""")
def vec_pq_label_books(spark, d):
    """Product quantisation with codebooks that follow from the data (parts of the
    labels' mean vectors, one row per label), so codes and distances are known."""
    e, c = read(spark, d, "embeddings"), label_centroids(spark, d)
    mat = np.array([r["centroid"] for r in c.orderBy("label").collect()])
    books = [mat[:, 8 * j:8 * j + 8] for j in range(8)]
    q = c.select(F.col("label").alias("query_id"), F.col("centroid").alias("embedding"))
    t = vx.pq_search(vx.pq_encode(e, books), books, q, k=5, digits=9)
    return t.select("query_id", "vec_id", rh("score", 6).alias("score"), "rank")


@query("vec_ivf_recall", ops=("VEC-06", "VEC-07"))
def vec_ivf_recall(spark, d):
    # approximate search over k-means cells: no SQL twin (iterative
    # training); the output is the recall against the exact search
    e = read(spark, d, "embeddings")
    q = label_centroids(spark, d).select(F.col("label").alias("query_id"), F.col("centroid").alias("embedding"))
    cells, cents = vx.ivf_index(e, "embedding", nlist=8)
    approx = vx.ivf_search(cells, cents, q, k=5, nprobe=2)
    exact = vx.exact_topk(e, q, 5, "cosine")
    return vx.recall_at_k(approx, exact)


@query("vec_pq_recall", ops=("VEC-08", "VEC-07"))
def vec_pq_recall(spark, d):
    e = read(spark, d, "embeddings")
    q = label_centroids(spark, d).select(F.col("label").alias("query_id"), F.col("centroid").alias("embedding"))
    books = vx.pq_train(e, "embedding", dim=64, m=8, ks=16)
    codes = vx.pq_encode(e, books)
    approx = vx.pq_search(codes, books, q, k=5)
    exact = vx.exact_topk(e, q, 5, "l2")
    return vx.recall_at_k(approx, exact)


def bm25_sql(docs_cte: str, k: int, queries_cte: str = "SELECT item_id AS qid, text FROM benchmark") -> str:
    return f"""
docs AS ({docs_cte}),
toks AS (SELECT doc, unnest({_tok("text")}) AS term FROM docs),
post AS (SELECT term, doc, count(*) AS tf FROM toks GROUP BY ALL),
dl AS (SELECT doc, count(*) AS dl FROM toks GROUP BY doc),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
qq AS (SELECT qid, unnest({_tok("text")}) AS term FROM ({queries_cte})),
qt AS (SELECT qid, term, count(*) AS qtf FROM qq GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM post WHERE term IN (SELECT term FROM qt) GROUP BY term),
idf AS (SELECT term, ln((n - df + 0.5) / (df + 0.5) + 1) AS idf FROM dfs, stats),
sc AS (SELECT qt.qid, post.doc,
              sum(idf.idf * tf * (1.2 + 1) / (tf + 1.2 * (1 - 0.75 + 0.75 * dl.dl / stats.avgdl)) * qtf) AS score
       FROM qt JOIN post USING (term) JOIN idf USING (term) JOIN dl USING (doc), stats GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY {rnd("score", 9)} DESC, doc) AS rank FROM sc),
bm AS (SELECT * FROM ranked WHERE rank <= {k})"""


@query("tx_bm25_search", ops=("VEC-09", "DOC-18"), bench=True, sql=f"""
WITH {bm25_sql("SELECT doc_id AS doc, text FROM documents", 10)}
SELECT qid AS item_id, doc AS doc_id, {rnd("score", 4)} AS score, CAST(rank AS INTEGER) AS rank FROM bm
""")
def tx_bm25_search(spark, d):
    r = tx.bm25(read(spark, d, "documents"), read(spark, d, "benchmark"), "doc_id", "text", "item_id", "text",
                k=10)
    return r.select("item_id", "doc_id", rh("score", 4).alias("score"), "rank")


@query("tx_rrf_fusion", ops=("VEC-10", "WN-11"), sql=f"""
WITH {bm25_sql("SELECT doc_id AS doc, text FROM documents", 20)},
qd AS (SELECT DISTINCT qid, term FROM qt),
cov AS (SELECT qd.qid, post.doc, count(*) AS coverage FROM qd JOIN post USING (term) GROUP BY ALL),
cr AS (SELECT cov.*, row_number() OVER (PARTITION BY qid ORDER BY coverage DESC, dl.dl, cov.doc) AS rank
       FROM cov JOIN dl USING (doc)),
u AS (SELECT qid, doc, 1.0 / (60 + rank) AS s FROM bm UNION ALL SELECT qid, doc, 1.0 / (60 + rank) FROM cr WHERE rank <= 20),
f AS (SELECT qid, doc, sum(s) AS rrf FROM u GROUP BY ALL),
fr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY {rnd("rrf", 9)} DESC, doc) AS rank FROM f)
SELECT qid AS item_id, doc AS doc_id, {rnd("rrf", 6)} AS rrf_score, CAST(rank AS INTEGER) AS rank FROM fr WHERE rank <= 10
""")
def tx_rrf_fusion(spark, d):
    from pyspark.sql import Window
    docs, qs = read(spark, d, "documents"), read(spark, d, "benchmark")
    a = tx.bm25(docs, qs, "doc_id", "text", "item_id", "text", k=20)
    b = tx.term_coverage_rank(docs, qs, "doc_id", "text", "item_id", "text", k=20)
    f = vx.reciprocal_rank_fusion([a, b], 60, "item_id", "doc_id")
    w = Window.partitionBy("item_id").orderBy(rh("rrf_score", 9).desc(), "doc_id")
    return (f.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 10)
            .select("item_id", "doc_id", rh("rrf_score", 6).alias("rrf_score"), "rank"))


@query("tx_fixed_chunks", ops=("TX-01",), sql="""
WITH s AS (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 50 - 1, 0), 462)) AS start
           FROM documents),
c AS (SELECT doc_id, start, substring(text, start + 1, 512) AS chunk FROM s)
SELECT doc_id, count(*) AS n_chunks, CAST(sum(length(chunk)) AS BIGINT) AS chunk_chars,
       CAST(arg_max(length(chunk), start) AS INTEGER) AS last_len, md5(string_agg(chunk, '|' ORDER BY start)) AS chunks_md5
FROM c GROUP BY doc_id
""")
def tx_fixed_chunks(spark, d):
    c = tx.fixed_chunks(read(spark, d, "documents"), "doc_id", "text", 512, 50)
    return c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"),
                                   F.sum(F.length("text")).cast("bigint").alias("chunk_chars"),
                                   F.max_by(F.length("text"), "start").alias("last_len"),
                                   # a text's chunks are bounded by the text
                                   F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))),
                                                                  lambda x: x["text"]), "|")).alias("chunks_md5"))


@query("tx_recursive_chunks", ops=("TX-01",))
def tx_recursive_chunks(spark, d):
    c = tx.recursive_chunks(read(spark, d, "documents"), "doc_id", "text", 512, 50)
    return c.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_chunks"), F.max(F.length("text")).alias("max_len"))


@query("tx_corpus_table", ops=("TX-02",), sql="""
SELECT d.doc_id, len(list_filter(string_split_regex(d.text, '\\s+'), lambda x: x <> '')) AS token_count,
       d.lang, d.source, l.quality AS quality_score
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def tx_corpus_table(spark, d):
    docs, lab = read(spark, d, "documents"), read(spark, d, "labels")
    j = docs.join(lab, "doc_id", "left")
    return j.select("doc_id", tx.token_count("text").alias("token_count"), "lang", "source",
                    F.col("quality").alias("quality_score"))


@query("tx_exact_dedup", ops=("TX-03",), sql="""
WITH h AS (SELECT doc_id, md5(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS h FROM documents)
SELECT doc_id, h, min(doc_id) OVER (PARTITION BY h) AS rep, count(*) OVER (PARTITION BY h) AS copies FROM h
""")
def tx_exact_dedup(spark, d):
    return tx.exact_duplicates(read(spark, d, "documents"), "doc_id", "text")


@query("tx_near_dedup", ops=("TX-03",))
def tx_near_dedup(spark, d):
    # MinHash-LSH near duplicates (no SQL twin; tested against brute-force
    # Jaccard on a small fixture) and the unique share of the corpus
    cl = tx.near_duplicate_clusters(read(spark, d, "documents"), "doc_id", "text", threshold=0.8)
    sizes = cl.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n_clusters"))


@query("tx_quality_filter", ops=("TX-04",), sql=f"""
SELECT d.source, count(*) AS n_docs, count(l.doc_id) AS n_labelled,
       {rnd("count(*) FILTER (WHERE l.quality = 1 AND l.toxic = 0) / nullif(count(l.doc_id), 0)", 4)} AS pass_share,
       {rnd("count(*) FILTER (WHERE l.toxic = 1) / nullif(count(l.doc_id), 0)", 4)} AS toxic_share
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source
""")
def tx_quality_filter(spark, d):
    j = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    lab = F.count("quality")
    return j.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), lab.alias("n_labelled"),
        rh(F.try_divide(F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0)), F.nullif(lab, F.lit(0))), 4)
        .alias("pass_share"),
        rh(F.try_divide(F.count_if(F.col("toxic") == 1), F.nullif(lab, F.lit(0))), 4).alias("toxic_share"))


@query("tx_language_balance", ops=("TX-05", "AG-12"), sql=f"""
SELECT lang, count(*) AS n_docs, {rnd("100.0 * count(*) / sum(count(*)) OVER ()", 3)} AS share_pct,
       count(DISTINCT source) AS n_sources, {rnd("avg(n_chars)", 2)} AS avg_chars,
       {rnd("100.0 * count(DISTINCT source) / (SELECT count(DISTINCT source) FROM documents)", 3)} AS domain_coverage_pct
FROM documents GROUP BY lang
""")
def tx_language_balance(spark, d):
    from pyspark.sql import Window
    docs = read(spark, d, "documents")
    domains = docs.select(F.count_distinct("source")).scalar()
    g = docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_distinct("source").alias("n_sources"),
        rh(F.avg("n_chars"), 2).alias("avg_chars"))
    g = g.withColumn("domain_coverage_pct", rh(F.col("n_sources") * 100.0 / domains, 3))
    return g.withColumn("share_pct", rh(F.col("n_docs") * 100.0 / F.sum("n_docs").over(Window.partitionBy()), 3))


@query("tx_sft_records", ops=("TX-06",), sql="""
WITH m AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev FROM conversations),
g AS (SELECT conv_id, count(*) AS n_messages, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role,
             bool_or(prev IS NOT NULL AND prev = role) AS bad, md5(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS messages_md5
      FROM m GROUP BY conv_id)
SELECT conv_id, CAST(n_messages AS INTEGER) AS n_messages, first_role, messages_md5,
       first_role IN ('user', 'system') AND last_role = 'assistant' AND NOT bad AS valid
FROM g
""")
def tx_sft_records(spark, d):
    r = tx.sft_records(read(spark, d, "conversations"))
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return r.select("conv_id", "n_messages", "first_role", F.md5(said).alias("messages_md5"), "valid")


@query("tx_preference_pairs", ops=("TX-07",), sql="""
WITH a AS (SELECT conv_id, text, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS score
           FROM conversations WHERE role = 'assistant'),
g AS (SELECT conv_id, max(score) AS chosen_score, min(score) AS rejected_score, count(*) AS n_answers,
             md5(arg_max(text, {'s': score, 't': text})) AS chosen_md5,
             md5(arg_min(text, {'s': score, 't': text})) AS rejected_md5 FROM a GROUP BY conv_id)
SELECT * FROM g WHERE n_answers > 1 AND chosen_score - rejected_score > 5
""")
def tx_preference_pairs(spark, d):
    a = read(spark, d, "conversations").where(F.col("role") == "assistant").select(
        "conv_id", "text", tx.token_count("text").alias("score"))
    p = tx.preference_pairs(a, "conv_id", "text", "score", min_gap=5)
    return p.select("conv_id", "chosen_score", "rejected_score", "n_answers",
                    F.md5("chosen").alias("chosen_md5"), F.md5("rejected").alias("rejected_md5"))


@query("tx_rag_context", ops=("TX-08", "WN-05"), sql=f"""
WITH ch AS (SELECT doc_id, start, substring(text, start + 1, 512) AS chunk FROM
              (SELECT doc_id, text, unnest(generate_series(0, greatest(length(text) - 50 - 1, 0), 462)) AS start
               FROM documents)),
{bm25_sql("SELECT CAST(doc_id AS VARCHAR) || ':' || CAST(start AS VARCHAR) AS doc, chunk AS text FROM ch", 8)},
t AS (SELECT bm.qid, bm.doc, bm.rank, ch.chunk, len(list_filter(string_split_regex(ch.chunk, '\\s+'), lambda x: x <> '')) AS ntok
      FROM bm JOIN ch ON CAST(ch.doc_id AS VARCHAR) || ':' || CAST(ch.start AS VARCHAR) = bm.doc),
run AS (SELECT *, sum(ntok) OVER (PARTITION BY qid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tot FROM t)
SELECT qid AS item_id, count(*) AS n_chunks, sum(ntok) AS tokens_used, md5(string_agg(chunk, chr(10) || chr(10) ORDER BY rank)) AS context_md5 FROM run WHERE tot <= 300 GROUP BY qid
""")
def tx_rag_context(spark, d):
    ch = tx.fixed_chunks(read(spark, d, "documents"), "doc_id", "text", 512, 50).select(
        F.concat_ws(":", F.col("doc_id").cast("string"), F.col("start").cast("string")).alias("chunk_id"), "text")
    top = tx.bm25(ch, read(spark, d, "benchmark"), "chunk_id", "text", "item_id", "text", k=8)
    ranked = top.join(ch.select("chunk_id", "text", tx.token_count("text").alias("ntok")), "chunk_id")
    ctx = tx.context_under_budget(ranked, "item_id", "rank", "ntok", "text", budget=300)
    return ctx.select("item_id", "n_chunks", F.col("tokens_used").cast("bigint").alias("tokens_used"), F.md5("context").alias("context_md5"))


# Price per 1000 tokens by message role (parameters of the cost report).
ROLE_RATES = {"system": 0.5, "user": 0.5, "assistant": 1.5}


@query("tx_interaction_analytics", ops=("TX-09",), sql=f"""
WITH m AS (SELECT role, len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')) AS tok FROM conversations)
SELECT role, count(*) AS n_messages, sum(tok) AS tokens,
       {rnd("sum(tok) / 1000.0 * CASE role WHEN 'assistant' THEN 1.5 ELSE 0.5 END", 4)} AS cost,
       CAST(quantile_disc(tok, 0.5) AS INTEGER) AS p50_tokens, CAST(quantile_disc(tok, 0.9) AS INTEGER) AS p90_tokens
FROM m GROUP BY role
""")
def tx_interaction_analytics(spark, d):
    m = read(spark, d, "conversations").select("role", tx.token_count("text").alias("tok"))
    rate = F.create_map(*[x for k, v in ROLE_RATES.items() for x in (F.lit(k), F.lit(v))])[F.col("role")]
    g = m.groupBy("role").agg(F.count(F.lit(1)).alias("n_messages"), F.sum("tok").alias("tokens"))
    q = pr.exact_quantiles(m, "tok", [0.5, 0.9], ["role"]).groupBy(F.col("role").alias("__r")).agg(
        F.max_by("value", "q").alias("p90_tokens"), F.min_by("value", "q").alias("p50_tokens"))
    g = g.join(q, F.col("role").eqNullSafe(F.col("__r")), "left").drop("__r")
    return g.withColumn("cost", rh(F.col("tokens") / 1000.0 * rate, 4))


@query("tx_eval_metrics", ops=("TX-10",), sql=f"""
SELECT d.source AS evaluator, count(*) AS n_evals, {rnd("avg(l.quality)", 4)} AS relevance,
       {rnd("avg(1 - l.toxic)", 4)} AS harmlessness, avg(l.quality) >= 0.80 AS relevance_ok,
       avg(1 - l.toxic) >= 0.85 AS harmlessness_ok
FROM labels l JOIN documents d USING (doc_id) GROUP BY d.source
""")
def tx_eval_metrics(spark, d):
    j = read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", "source"), "doc_id")
    g = j.groupBy(F.col("source").alias("evaluator")).agg(
        F.count(F.lit(1)).alias("n_evals"), F.avg("quality").alias("rel"), F.avg(1 - F.col("toxic")).alias("harm"))
    return g.select("evaluator", "n_evals", rh("rel", 4).alias("relevance"), rh("harm", 4).alias("harmlessness"),
                    (F.col("rel") >= 0.80).alias("relevance_ok"), (F.col("harm") >= 0.85).alias("harmlessness_ok"))
