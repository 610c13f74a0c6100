"""Vector similarity, exact/approximate top-k, fusion and text operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreflow.operators import text as tx
from oreflow.operators import vectors as vx


def test_similarity_edge_cases(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0]),
                                ([0.0, 0.0], [1.0, 1.0])], "a array<double>, b array<double>")
    r = df.select(vx.cosine("a", "b").alias("c"), vx.l2("a", "b").alias("d"), vx.dot("a", "b").alias("p")).collect()
    assert [x.c for x in r] == [1.0, -1.0, 0.0, None]          # zero vector -> NULL
    assert r[1].d == 2.0 and r[3].p == 0.0


def test_exact_topk_matches_numpy(spark):
    rng = np.random.default_rng(0)
    corpus = rng.normal(size=(200, 8)).astype(np.float32)
    queries = rng.normal(size=(5, 8))
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(corpus)], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, embedding array<double>")
    for metric in ("cosine", "l2", "dot"):
        got = {}
        for r in vx.exact_topk(c.repartition(4), q, 3, metric).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        cc = corpus.astype(np.float64)
        for qi, qv in enumerate(queries):
            if metric == "cosine":
                s = -(cc @ qv) / (np.linalg.norm(cc, axis=1) * np.linalg.norm(qv))
            elif metric == "dot":
                s = -(cc @ qv)
            else:
                s = np.linalg.norm(cc - qv, axis=1)
            assert [v for _, v in sorted(got[qi])] == list(np.argsort(s, kind="stable")[:3])


def test_exact_topk_slices_blocks_ties_and_nulls(spark, monkeypatch):
    c = spark.createDataFrame([(i, [1.0, 0.0]) for i in (9, 8, 7, 1, 2, 3)] + [(0, None)], "vec_id int, embedding array<double>")
    q = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(40)] + [(99, None)], "query_id int, embedding array<double>")
    monkeypatch.setattr(vx, "QUERY_BYTES", 100)
    for metric in ("cosine", "l2", "dot"):
        got = {(r.query_id, r.vec_id, r["rank"]) for r in vx.exact_topk(c, q, 2, metric).collect()}
        assert got == {(i, v, v) for i in range(40) for v in (1, 2)}
    assert vx.exact_topk(c, q.limit(0), 2).count() == 0


def test_topk_over_many_blocks_equals_sorting(spark, monkeypatch):
    rng = np.random.default_rng(1)
    n, nq, k = 500, 7, 5
    x, ids, qs = rng.integers(0, 9, n).astype(float), rng.permutation(n), rng.integers(0, 9, nq).astype(float)
    c = spark.createDataFrame([(int(i), [float(v)]) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(3)
    q = spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(qs)], "query_id long, embedding array<double>")
    monkeypatch.setattr(vx, "QUERY_BYTES", 16)
    got = {}
    for r in vx.exact_topk(c, q, k, "l2").orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {j: ids[np.lexsort((ids, np.abs(qs[j] - x)))[:k]].tolist() for j in range(nq)}


def test_cells_and_codes_equal_the_exact_search_where_they_must(spark):
    rng = np.random.default_rng(2)
    vec = rng.normal(size=(120, 4))
    c = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vec)], "vec_id long, embedding array<double>")
    q = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(6)] + [(9, None)], "query_id long, embedding array<double>")
    rows = lambda d: {(r.query_id, r["rank"], r.vec_id) for r in d.collect()}
    cells, cents = vx.ivf_index(c, "embedding", nlist=4)
    assert rows(vx.ivf_search(cells, cents, q, 3, nprobe=4)) == rows(vx.exact_topk(c, q, 3, "cosine"))
    plan = vx.ivf_search(cells, cents, q.limit(1), 3, nprobe=1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # a codebook that holds every sub-vector codes without loss
    books = [vec[:, :2], vec[:, 2:]]
    codes = vx.pq_encode(c, books)
    assert {r.vec_id: r.codes for r in codes.collect()} == {i: [i, i] for i in range(120)}
    assert rows(vx.pq_search(codes, books, q, 3)) == rows(vx.exact_topk(c, q, 3, "l2"))


def test_rrf_item_in_one_list(spark):
    a = spark.createDataFrame([(1, "d1", 1), (1, "d2", 2)], "query_id int, doc_id string, rank int")
    b = spark.createDataFrame([(1, "d2", 1)], "query_id int, doc_id string, rank int")
    r = {x.doc_id: x.rrf_score for x in vx.reciprocal_rank_fusion([a, b]).collect()}
    assert r["d1"] == pytest.approx(1 / 61) and r["d2"] == pytest.approx(1 / 62 + 1 / 61)


def test_fixed_chunks_cover_every_character(spark):
    text = "".join(chr(97 + i % 26) for i in range(1300))
    df = spark.createDataFrame([(1, text), (2, "short")], "id int, text string")
    ch = tx.fixed_chunks(df, "id", "text", 512, 50).orderBy("id", "chunk_index").collect()
    c1 = [r for r in ch if r.id == 1]
    assert [r.start for r in c1] == [0, 462, 924]
    rebuilt = c1[0].text + "".join(r.text[50:] for r in c1[1:])
    assert rebuilt == text and len(c1[-1].text) < 512
    assert [r.text for r in ch if r.id == 2] == ["short"]


def test_recursive_chunks_respect_size(spark):
    text = "\n\n".join(" ".join(f"w{i}{j}" for j in range(60)) for i in range(5))
    df = spark.createDataFrame([(1, text)], "id int, text string")
    ch = tx.recursive_chunks(df, "id", "text", 100, 10).collect()
    assert ch and all(len(r.text) <= 100 for r in ch)
    words = set(text.split())
    assert words == set(" ".join(r.text for r in ch).split())      # nothing lost


def test_near_duplicates_match_brute_force(spark):
    base = "the quick brown fox jumps over the lazy dog near the old mill by the river bank today"
    docs = [(1, base), (2, base + " again"), (3, "completely different words about mining ore trucks and drills"),
            (4, base.replace("lazy", "sleepy")), (5, "completely different words about mining ore trucks and drills")]
    df = spark.createDataFrame(docs, "id int, text string")
    cl = {r.id: r.cluster for r in tx.near_duplicate_clusters(df, "id", "text", threshold=0.6, num_perm=128,
                                                              bands=32).collect()}

    def shingles(t):
        w = t.lower().split()
        return {" ".join(w[i:i + 3]) for i in range(len(w) - 2)}
    jac = {(a, b): len(shingles(x) & shingles(y)) / len(shingles(x) | shingles(y))
           for a, x in docs for b, y in docs if a < b}
    assert jac[(3, 5)] == 1.0 and jac[(1, 3)] == 0.0
    assert cl[3] == cl[5] and cl[1] != cl[3]
    assert cl[1] == cl[2]                                          # Jaccard 0.88


def test_exact_duplicates_normalised(spark):
    df = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c")], "id int, text string")
    r = {x.id: (x.rep, x.copies) for x in tx.exact_duplicates(df, "id", "text").collect()}
    assert r == {1: (1, 2), 2: (1, 2), 3: (3, 1)}


def test_bm25_hand_computed(spark):
    docs = spark.createDataFrame([(1, "ore ore truck"), (2, "truck drill"), (3, "drill")], "id int, text string")
    q = spark.createDataFrame([(9, "ore")], "qid int, text string")
    r = tx.bm25(docs, q, "id", "text", "qid", "text", k=3).collect()
    n, df_, avgdl, tf, dl = 3, 1, 6 / 3, 2, 3
    idf = math.log((n - df_ + 0.5) / (df_ + 0.5) + 1)
    want = idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))
    assert [(x.id, x["rank"]) for x in r] == [(1, 1)] and r[0].score == pytest.approx(want)


def test_sft_records_and_preference_pairs(spark):
    conv = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "assistant", "x"),
                                  (3, 0, "user", "q"), (3, 1, "user", "q2"), (3, 2, "assistant", "a")],
                                 "conv_id int, turn int, role string, text string")
    v = {r.conv_id: r.valid for r in tx.sft_records(conv).collect()}
    assert v == {1: True, 2: False, 3: False}
    ans = spark.createDataFrame([("p", "good answer", 5.0), ("p", "bad", 1.0), ("p", "ok", 3.0), ("q", "only", 2.0)],
                                "prompt string, answer string, score double")
    pp = tx.preference_pairs(ans, "prompt", "answer", "score").collect()
    assert [(r.prompt, r.chosen, r.rejected) for r in pp] == [("p", "good answer", "bad")]


def test_context_under_budget(spark):
    r = spark.createDataFrame([(1, 1, 100, "a"), (1, 2, 150, "b"), (1, 3, 100, "c")],
                              "q int, rank int, ntok int, text string")
    c = tx.context_under_budget(r, "q", "rank", "ntok", "text", 300).first()
    assert (c.n_chunks, c.tokens_used, c.context) == (2, 250, "a\n\nb")


def test_keyword_ranks_keep_ids_and_ties_and_meet_no_pair_table(spark, monkeypatch):
    # repeated and NULL ids, equal texts, more queries than one block holds
    monkeypatch.setattr(tx, "QUERY_TERMS", 3)
    monkeypatch.setattr(tx, "CELLS", 4)
    docs = spark.createDataFrame([(i, "ore truck") for i in range(40, 0, -1)] + [(50, "ore ore drill"), (50, "ore"), (None, "drill"),
                                                                                 (51, None), (52, "...")], "id int, text string")
    q = spark.createDataFrame([("a", "ore drill"), ("b", "truck"), ("c", "drill drill"), (None, "truck truck"), ("d", "none")],
                              "qid string, text string")
    r = tx.bm25(docs, q, "id", "text", "qid", "text", k=3)
    got = {}
    for x in r.orderBy("qid", "rank").collect():
        got.setdefault(x.qid, []).append(x.id)
    assert got == {None: [1, 2, 3], "a": [None, 50, 1], "b": [1, 2, 3], "c": [None, 50]}
    n, avgdl = 43, (40 * 2 + 3 + 1 + 1) / 43
    idf = lambda df: math.log((n - df + 0.5) / (df + 0.5) + 1)
    part = lambda df, tf, dl: idf(df) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))
    scores = {(x.qid, x.id): x.score for x in r.collect()}
    assert scores["a", 50] == pytest.approx(part(42, 2, 3) + part(42, 1, 1) + part(2, 1, 3))
    assert scores["c", None] == pytest.approx(2 * part(2, 1, 1))
    cov = {(x.qid, x["rank"]): (x.id, x.coverage) for x in tx.term_coverage_rank(docs, q, "id", "text", "qid", "text", k=2).collect()}
    assert cov == {(None, 1): (1, 1), (None, 2): (2, 1), ("a", 1): (50, 2), ("a", 2): (None, 1), ("b", 1): (1, 1), ("b", 2): (2, 1),
                   ("c", 1): (None, 1), ("c", 2): (50, 1)}
    # no join of postings with queries and no table of their pairs
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
