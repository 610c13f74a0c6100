"""Vector search operators on ``array<float>`` columns.

Similarity functions are JVM-side higher-order functions.  Exact top-k for
a set of query vectors never pairs vectors by rows: blocks of queries are joined
with blocks of the corpus, a task computes a block's distances with numpy and
keeps only its k best per query; a final grouped top-k merges the partial lists
(k x tasks rows per query).  No vector passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from oreflow.session import checkpoint_dir, scratch_path

QUERY_BYTES = 1 << 20   # of vectors in one query block
ROWS = 4096             # vectors in one corpus block, at most
HELD = 1 << 20          # candidates that a task keeps before it gives them out


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _packed(batches, first: int) -> Iterator[pa.RecordBatch]:
    """Batches (id, vector, other columns; ``first`` columns of the block's number
    before them) as one row each: ids, their vectors' bytes, the others as lists."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            part = b.slice(at, ROWS)
            cols = [part.column(i) for i in range(first, part.num_columns)]
            raw = np.ascontiguousarray(_matrix(cols[1]), np.float64 if pa.types.is_floating(cols[1].type.value_type) else np.int32).tobytes()
            lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), c) for c in (cols[0], *cols[2:])]
            block = [pa.array([part.column(0)[0].as_py()], pa.int32())] if first else []
            yield pa.RecordBatch.from_arrays([*block, lists[0], pa.array([raw], pa.binary()), *lists[1:]],
                                             names=[*(["qb"] if first else []), "ids", "mat", *[f"l{i}" for i in range(len(cols) - 2)]])


def _blocks(df: DataFrame, id_col: str, vec: str, others: Sequence[str], block: bool = False) -> DataFrame:
    """Rows (ids, mat, others) of many vectors each; of one ``qb`` if ``block``."""
    kinds = {c: df.schema[c].dataType.simpleString() for c in (id_col, *others)}
    schema = ("qb int, " if block else "") + f"ids array<{kinds[id_col]}>, mat binary" + \
        "".join(f", l{i} array<{kinds[c]}>" for i, c in enumerate(others))
    cols = (["qb"] if block else []) + [id_col, vec, *others]
    if block:
        # a block's queries lie in one partition, next to each other
        df = df.repartition("qb").sortWithinPartitions("qb")

        def runs(batches):
            for b in batches:
                q = b.column(0).to_numpy()
                edges = [0, *(np.flatnonzero(q[1:] != q[:-1]) + 1).tolist(), len(q)]
                yield from (b.slice(x, y - x) for x, y in zip(edges, edges[1:]) if y > x)
        return df.select(*cols).mapInArrow(lambda it: _packed(runs(it), 1), schema)
    return df.select(*cols).mapInArrow(lambda it: _packed(it, 0), schema)


def _keep_best(k: int, q: np.ndarray, ids: np.ndarray, key: np.ndarray):
    """Of flat candidates each query's k with the smallest key (ties: smallest id)."""
    order = np.lexsort((ids, key, q))
    q, ids, key = q[order], ids[order], key[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
    return q[keep], ids[keep], key[keep]


def _topk(corpus: DataFrame, queries: DataFrame, k: int, keys_of, id_type: str, query_type: str) -> DataFrame:
    """(query_id, id, key): candidates that hold each query's k smallest keys.

    Blocks of queries meet blocks of the corpus in tasks: Spark joins them on the
    query block's number (it broadcasts the queries when they are few, and
    shuffles blocks when not).  ``keys_of(queries' matrix, corpus's matrix,
    queries' others, corpus's others)`` gives the keys; a task keeps each query's
    k best over the blocks that it sees."""
    n = queries.agg(F.max("qb")).first()[0]
    if n is None:
        return corpus.sparkSession.createDataFrame([], f"query_id {query_type}, id {id_type}, key double")
    q = queries.withColumnsRenamed({c: f"q_{c}" for c in queries.columns if c != "qb"})
    pairs = corpus.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n)))).join(q, "qb")
    own = [c for c in corpus.columns if c.startswith("l")]
    cols = ["q_ids", "q_mat", "ids", "mat", *[f"q_{c}" for c in own], *own]

    def run(batches):
        held: dict = {}
        size = 0

        def out():
            for ids, (row, vid, key) in held.values():
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), pa.array(vid), pa.array(key)], names=["query_id", "id", "key"])
        for b in batches:
            for i in range(b.num_rows):
                q_ids, ids = b.column(0)[i].values, b.column(2)[i].values.to_numpy(zero_copy_only=False)
                q_mat, mat = (np.frombuffer(b.column(j)[i].as_buffer(), np.float64 if j == 1 or not own_codes else np.int32) for j in (1, 3))
                more = [b.column(j)[i].values.to_numpy(zero_copy_only=False) for j in range(4, b.num_columns)]
                half = len(more) // 2
                key = keys_of(q_mat.reshape(len(q_ids), -1), mat.reshape(len(ids), -1), more[:half], more[half:])
                kk = min(k, len(ids))
                worst = np.partition(key, kk - 1, axis=1)[:, kk - 1]
                row, col = np.nonzero((key <= worst[:, None]) & np.isfinite(key))
                name = tuple(q_ids.to_pylist())
                before = held.get(name, (q_ids, (np.zeros(0, np.int64), ids[:0], np.zeros(0))))[1]
                best = _keep_best(k, *(np.concatenate(x) for x in zip(before, (row, ids[col], key[row, col]))))
                size += len(best[0]) - len(before[0])
                held[name] = (q_ids, best)
                if size > HELD:
                    yield from out()
                    held, size = {}, 0
        yield from out()
    own_codes = getattr(keys_of, "codes", False)
    return pairs.select(*cols).mapInArrow(run, f"query_id {query_type}, id {id_type}, key double")


def _query_blocks(queries: DataFrame, query_id: str, vec: str, others: Sequence[str] = ()) -> DataFrame:
    """Blocks of about QUERY_BYTES of queries; those without a vector have no neighbours."""
    q = queries.where(F.col(vec).isNotNull()).select(query_id, F.col(vec).cast("array<double>").alias(vec), *others)
    size = q.agg(F.sum(F.size(vec).cast("long") * 8)).first()[0] or 0
    n = max(1, -(-size // QUERY_BYTES))
    return _blocks(q.withColumn("qb", F.pmod(F.xxhash64(query_id), F.lit(n)).cast("int")), query_id, vec, others, True)


# ------------------------------------------------------------ similarities
def dot(a, b) -> Column:
    """VEC-03: inner product."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v))


def cosine(a, b) -> Column:
    """VEC-01: cosine similarity; NULL for a zero vector."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def l2(a, b) -> Column:
    """VEC-02: Euclidean distance."""
    return F.sqrt(F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                              F.lit(0.0), lambda acc, v: acc + v))


def normalise(a) -> Column:
    """Unit-length copy (pre-normalised columns make cosine a dot product)."""
    n = norm(a)
    return F.when(n > 0, F.transform(_c(a), lambda x: x / n))


def centroids(df: DataFrame, key: str, vec: str, out: str = "centroid") -> DataFrame:
    """Mean vector per key: element-wise average via posexplode + groupBy
    (partial aggregation per (key, position))."""
    e = df.select(key, F.posexplode(vec).alias("pos", "x"))
    g = e.groupBy(key, "pos").agg(F.avg("x").alias("x"))
    return g.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))),
                                          lambda s: s["x"]).alias(out))


# -------------------------------------------------------------- exact top-k
def _distances(metric: str, filtered: bool):
    def keys_of(q, corpus, q_others, others):
        if metric == "cosine":
            with np.errstate(divide="ignore", invalid="ignore"):
                x = (q @ corpus.T) / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(corpus, axis=1))
            key = np.where(np.isfinite(x), -x, np.inf)
        elif metric == "dot":
            key = -(q @ corpus.T)
        else:  # l2 via |q|^2 + |c|^2 - 2 q.c
            key = np.sqrt(np.maximum((q ** 2).sum(1)[:, None] + (corpus ** 2).sum(1)[None, :] - 2.0 * (q @ corpus.T), 0.0))
        return np.where(q_others[0][:, None] == others[0][None, :], key, np.inf) if filtered else key
    return keys_of


def _ranked(part: DataFrame, k: int, query_id: str, id_col: str, score: Column, best_first: Column) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(best_first, "id")
    return part.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select(F.col("query_id").alias(query_id), F.col("id").alias(id_col), score.alias("score"), "rank")


def exact_topk(corpus: DataFrame, queries: DataFrame, k: int, metric: str = "cosine",
               id_col: str = "vec_id", vec_col: str = "embedding", query_id: str = "query_id",
               query_vec: str = "embedding", same_label: str | None = None) -> DataFrame:
    """VEC-04 / VEC-05: exact k nearest corpus vectors for every query.
    ``same_label`` restricts each query to corpus rows with its label (the
    metadata filter is applied before ranking).  Output: query_id, vec_id,
    score, rank (1 = best; ties by vec_id)."""
    others = [same_label] if same_label else []
    rows = corpus.where(F.col(vec_col).isNotNull()).withColumn(vec_col, F.col(vec_col).cast("array<double>"))
    part = _topk(_blocks(rows, id_col, vec_col, others), _query_blocks(queries, query_id, query_vec, others), k,
                 _distances(metric, bool(same_label)), corpus.schema[id_col].dataType.simpleString(),
                 queries.schema[query_id].dataType.simpleString())
    return _ranked(part, k, query_id, id_col, F.col("key") if metric == "l2" else -F.col("key"), F.col("key"))


# --------------------------------------------------------------- IVF and PQ
def train_kmeans(df: DataFrame, vec_col: str, k: int, seed: int = 42, max_iter: int = 20):
    """Distributed k-means (Spark ML) on the vector column."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    data = df.select(array_to_vector(F.col(vec_col)).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(data)


def ivf_index(corpus: DataFrame, vec_col: str, nlist: int, seed: int = 42, path: str | None = None):
    """VEC-06: coarse quantiser (nlist centroids) and the corpus with its cell id,
    stored by cell (a folder each, below ``path`` or the scratch folder).
    Returns (cells DataFrame, centroids array)."""
    from pyspark.ml.functions import array_to_vector
    model = train_kmeans(corpus, vec_col, nlist, seed)
    cents = np.array([c for c in model.clusterCenters()])
    path = path or scratch_path(corpus.sparkSession, "ivf")
    (model.transform(corpus.withColumn("features", array_to_vector(F.col(vec_col))))
     .withColumnRenamed("prediction", "cell").drop("features").hint("rebalance", F.col("cell")).write.partitionBy("cell").parquet(path))
    return corpus.sparkSession.read.parquet(path), cents


def ivf_search(cells: DataFrame, cents: np.ndarray, queries: DataFrame, k: int, nprobe: int,
               id_col: str = "vec_id", vec_col: str = "embedding", query_id: str = "query_id") -> DataFrame:
    """VEC-06: probe the ``nprobe`` cells nearest to each query, rank only
    the vectors in those cells (an equi join on cell id), keep top-k.  Folders of
    cells that no query probes are not read."""
    def nearest(batches):
        for b in batches:
            q = _matrix(b.column(1))
            d = (q ** 2).sum(1)[:, None] + (cents ** 2).sum(1)[None, :] - 2 * (q @ cents.T) if len(q) else np.zeros((0, len(cents)))
            probe = np.argsort(d, axis=1, kind="stable")[:, :nprobe].astype(np.int32)
            at = pa.array(np.repeat(np.arange(len(q)), probe.shape[1]))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array(probe.reshape(-1)), b.column(1).take(at)],
                                             names=[query_id, "cell", "__q"])
    qtype = queries.schema[query_id].dataType.simpleString()
    probes = queries.where(F.col(vec_col).isNotNull()).select(query_id, F.col(vec_col).cast("array<double>").alias(vec_col)) \
        .mapInArrow(nearest, f"{query_id} {qtype}, cell int, __q array<double>")
    checkpoint_dir(probes.sparkSession)
    probes = probes.checkpoint()
    wanted = [r["cell"] for r in probes.select("cell").distinct().collect()]      # at most nlist numbers
    cand = cells.where(F.col("cell").isin(wanted)).select(id_col, vec_col, "cell").join(probes, "cell")
    scored = cand.select(query_id, id_col, cosine(vec_col, "__q").alias("score"))
    w = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(id_col))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def recall_at_k(approx: DataFrame, exact: DataFrame, query_id: str = "query_id",
                id_col: str = "vec_id") -> DataFrame:
    """VEC-07: per query, the share of the exact top-k found by the
    approximate search, and the mean over queries."""
    hits = exact.join(approx.select(query_id, id_col).withColumn("__hit", F.lit(1)), [query_id, id_col], "left")
    per_q = hits.groupBy(query_id).agg((F.count("__hit") / F.count(F.lit(1))).alias("recall"))
    return per_q


def pq_train(corpus: DataFrame, vec_col: str, dim: int, m: int, ks: int, seed: int = 42):
    """VEC-08: product quantisation: split vectors into ``m`` sub-vectors and
    train one k-means codebook (``ks`` centroids) per sub-space."""
    sub = dim // m
    books = []
    for j in range(m):
        part = corpus.select(F.slice(F.col(vec_col), j * sub + 1, sub).alias("__s"))
        books.append(np.array(train_kmeans(part, "__s", ks, seed + j).clusterCenters()))
    return books


def pq_encode(corpus: DataFrame, books: list[np.ndarray], id_col: str = "vec_id",
              vec_col: str = "embedding") -> DataFrame:
    """VEC-08: codes array (one centroid index per sub-space; ties: the first),
    with numpy against the codebooks (their size is that of the model)."""
    itype = corpus.schema[id_col].dataType.simpleString()

    def enc(batches):
        sub = books[0].shape[1]
        for b in batches:
            x = _matrix(b.column(1))
            codes = np.stack([((x[:, j * sub:(j + 1) * sub][:, None, :] - book[None, :, :]) ** 2).sum(-1).argmin(1)
                              for j, book in enumerate(books)], axis=1).astype(np.int32) if len(x) else np.zeros((0, len(books)), np.int32)
            to = pa.array(np.arange(len(x) + 1) * len(books), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(to, pa.array(codes.reshape(-1)))], names=[id_col, "codes"])
    src = corpus.where(F.col(vec_col).isNotNull()).select(id_col, F.col(vec_col).cast("array<double>"))
    return src.mapInArrow(enc, f"{id_col} {itype}, codes array<int>")


def pq_search(codes: DataFrame, books: list[np.ndarray], queries: DataFrame, k: int,
              id_col: str = "vec_id", query_id: str = "query_id", vec_col: str = "embedding",
              digits: int | None = None) -> DataFrame:
    """VEC-08: asymmetric distance computation: per query block a table of squared
    distances (sub-space x centroid), summed over the codes of a corpus block.
    Vectors with the same codes tie (smallest id first); ``digits`` rounds
    distances so that the order of summation can't part them."""
    sub = books[0].shape[1]

    def keys_of(q, c, q_others, others):
        tab = [((q[:, j * sub:(j + 1) * sub][:, None, :] - b[None, :, :]) ** 2).sum(-1) for j, b in enumerate(books)]
        key = sum(t[:, c[:, j]] for j, t in enumerate(tab))
        return key if digits is None else np.round(key, digits)
    keys_of.codes = True
    part = _topk(_blocks(codes, id_col, "codes", []), _query_blocks(queries, query_id, vec_col), k, keys_of,
                 codes.schema[id_col].dataType.simpleString(), queries.schema[query_id].dataType.simpleString())
    return _ranked(part, k, query_id, id_col, F.col("key"), F.col("key"))


# ------------------------------------------------------------------- fusion
def reciprocal_rank_fusion(rankings: Sequence[DataFrame], k: int = 60, query_id: str = "query_id",
                           item: str = "doc_id", rank: str = "rank") -> DataFrame:
    """VEC-10: RRF score = sum over lists of 1 / (k + rank); an item present
    in one list only gets that list's term."""
    u = None
    for r in rankings:
        x = r.select(query_id, item, (1.0 / (F.lit(k) + F.col(rank))).alias("__s"))
        u = x if u is None else u.unionByName(x)
    return u.groupBy(query_id, item).agg(F.sum("__s").alias("rrf_score"))
