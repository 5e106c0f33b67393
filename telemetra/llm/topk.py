"""Exact top-k inner-product search by the threshold algorithm.

Candidates are dealt into blocks of like length (range-partitioned by norm, ties by
hash), and the least and greatest value of every dimension in a block are kept.  They
bound any score in the block, so a query first searches the block of its highest bound,
and then only blocks whose bound reaches the k-th score found there; the others are
never copied to it.  The queries of a block are dealt into groups of bounded size, each
with the block's candidates.

In a group each dimension has its list of candidates sorted by value; a query reads the
lists from the end its sign favours, scores what it meets in full, and stops when the
bound on everything unmet (the query times the values last read) cannot beat its k-th
score.  Ties go to the smaller id, so reading goes on, and blocks are searched, while a
bound equals the k-th score.  A window over the blocks' best keeps the k best of each
query.

Defined results: vectors that are null or hold a null or non-finite component take
no part; shorter vectors are filled with zeros; a row whose id equals a query's is
the query's own; of rows that repeat a query's id the one with the greatest vector
asks; null ids never ask and lose ties; an empty table gives no rows; a component
beyond the range of a long is held at its end, and so is a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, default_partitions, pick, ship_package

#: Rows of a candidate block and of a query group at most, and of a block at least.
CANDIDATES = 32_768
QUERIES = 8_192
LEAST = 1_024
#: Bytes of block bounds that are sent to tasks; beyond it every block is searched.
BOUND_BYTES = 1 << 27
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    scale: int = 1024) -> DataFrame:
    """vec_id, v (array<long>): floor(scale * x) of every usable vector."""
    x = pick(vector_col).cast("array<double>")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return table.where(usable).select(
        pick(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score for ``vectors`` (vec_id, v); queries are the
    rows for which ``is_query`` holds."""
    spark = vectors.sparkSession
    ship_package(spark)
    vectors = cut_lineage(vectors)
    queries = vectors.where(is_query & F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.max("v").alias("v"))
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"),
                       F.max(F.array_max(F.transform("v", lambda c: F.abs(c.cast("double"))))).alias("top")).first()
    n_blocks = max(1, min(default_partitions(spark), size["n"] // LEAST), -(-size["n"] // CANDIDATES))
    width, top = size["d"] or 0, float(size["top"] or 0)
    bound = top * top * max(1, width)
    dtype = "float64" if bound < 2.0 ** 53 else "int64" if bound < 2.0 ** 62 else "object"
    queries = cut_lineage(queries)
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    keyed = vectors.withColumns({"norm": norm, "h": F.xxhash64("vec_id", "v")})
    dealt = keyed.repartitionByRange(n_blocks, "norm", "h") if n_blocks > 1 else keyed.coalesce(1)
    offered = cut_lineage(dealt.select(F.spark_partition_id().alias("cb"), "vec_id", "v"))

    def searched(asked: DataFrame) -> DataFrame:
        return _search(cut_lineage(asked), offered, k, width, dtype)

    bounds = _bounds(offered, width)
    if bounds is None:                                   # too many blocks to send their bounds
        blocks = offered.select("cb").distinct()
        found = searched(queries.join(blocks))
    else:
        first = cut_lineage(searched(_asks(queries, bounds, None)))
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        least = (first.withColumn("_n", F.row_number().over(order)).where(F.col("_n") == k)
                 .select(F.col("query_id").alias("vec_id"), F.col("score").alias("kth")))
        rest = searched(_asks(queries.join(least, "vec_id", "left"), bounds, "kth"))
        found = first.unionByName(rest)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _bounds(offered: DataFrame, width: int):
    """(block numbers, least, greatest) per block and dimension; None if too large.  A
    shorter vector counts as filled with zeros."""
    sizes = offered.groupBy("cb").agg(F.min(F.size("v")).alias("d")).collect()
    if len(sizes) * max(1, width) * 16 > BOUND_BYTES:
        return None
    at = {r["cb"]: i for i, r in enumerate(sorted(sizes))}
    low, high = np.full((len(at), width), np.inf), np.full((len(at), width), -np.inf)
    rows = (offered.select("cb", F.posexplode("v").alias("d", "x")).groupBy("cb", "d")
            .agg(F.min("x").alias("low"), F.max("x").alias("high")).toLocalIterator())
    for r in rows:
        low[at[r["cb"]], r["d"]], high[at[r["cb"]], r["d"]] = r["low"], r["high"]
    for r in sizes:
        low[at[r["cb"]], r["d"]:] = np.minimum(low[at[r["cb"]], r["d"]:], 0)
        high[at[r["cb"]], r["d"]:] = np.maximum(high[at[r["cb"]], r["d"]:], 0)
    return np.array(list(at), np.int64), low, high


def _asks(queries: DataFrame, bounds, kth: str | None) -> DataFrame:
    """(vec_id, v, cb): without ``kth`` each query and the block of its highest bound;
    with it the other blocks whose bound reaches that score (all, where it is null)."""
    blocks, low, high = bounds
    width = low.shape[1]

    def run(batches):
        for batch in batches:
            x = _matrix(pa.chunked_array([batch.column("v")]), width, "float64")
            for a in range(0, len(x), 1024):
                q = x[a:a + 1024]
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                # rounding may only raise a bound
                most = up @ high.T + down @ low.T
                most += np.abs(most) * 1e-9
                best = most.argmax(axis=1)
                if kth is None:
                    row, at = np.arange(len(q)), best
                else:
                    reached = batch.column(kth).slice(a, len(q))
                    score = np.where(reached.is_null().to_numpy(zero_copy_only=False), -np.inf,
                                     reached.fill_null(0).to_numpy(zero_copy_only=False).astype(float))
                    open_ = most >= score[:, None]
                    open_[np.arange(len(q)), best] = False
                    row, at = np.nonzero(open_)
                for i in range(0, len(row), 1 << 14):
                    own = pa.array(row[i:i + (1 << 14)] + a)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id").take(own), batch.column("v").take(own), pa.array(blocks[at[i:i + (1 << 14)]])],
                        names=["vec_id", "v", "cb"])

    return queries.mapInArrow(run, "vec_id long, v array<long>, cb long")


def _search(asked: DataFrame, offered: DataFrame, k: int, width: int, dtype: str) -> DataFrame:
    """The best of the asked blocks: a block's queries in groups of ``QUERIES``, each
    with the block's candidates; a block that nobody asks for is not copied."""
    groups = cut_lineage(asked.groupBy("cb").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("groups")))
    left = asked.join(groups, "cb").withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.col("groups")).cast("int"))
    right = offered.join(groups, "cb").withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))

    def search(asked: pa.Table, offered: pa.Table) -> pa.Table:
        return search_block(asked, offered, k, width, dtype)

    return (left.select("cb", "qb", "vec_id", "v").groupBy("cb", "qb")
            .cogroup(right.select(F.col("cb").cast("long").alias("cb"), "qb", "vec_id", "v").groupBy("cb", "qb"))
            .applyInArrow(search, FOUND))


def _matrix(column: pa.ChunkedArray, width: int, dtype: str) -> np.ndarray:
    lists = column.combine_chunks()
    flat = np.asarray(lists.flatten(), dtype=np.int64)
    sizes = np.diff(np.asarray(lists.offsets))
    out = np.zeros((len(lists), width), dtype=object if dtype == "object" else dtype)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def search_block(asked: pa.Table, offered: pa.Table, k: int, width: int, dtype: str) -> pa.Table:
    parts = []
    if len(asked) and len(offered):
        x, q = _matrix(offered["v"], width, dtype), _matrix(asked["v"], width, dtype)
        ids = offered["vec_id"].combine_chunks()
        key = np.where(ids.is_null().to_numpy(zero_copy_only=False), np.iinfo(np.int64).max,
                       ids.fill_null(0).to_numpy(zero_copy_only=False))
        lists = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        for query, vector in zip(asked["vec_id"].to_pylist(), q):
            rows, score = threshold_search(x, lists, vector, key, k, query)
            parts.append((np.full(len(rows), query), rows, score))
    if not parts:
        return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score")})
    query, rows, score = (np.concatenate([p[i] for p in parts]) for i in range(3))
    score = np.clip(score, -(1 << 63), (1 << 63) - 1) if score.dtype == object else score
    return pa.table({"query_id": pa.array(query.astype(np.int64)), "vec_id": ids.take(pa.array(rows)),
                     "score": pa.array(score.astype(np.int64))})


def threshold_search(x: np.ndarray, lists: np.ndarray, q: np.ndarray, key: np.ndarray, k: int, own: int):
    """Rows of the k best candidates for ``q`` and their scores."""
    n, dims = len(x), np.flatnonzero(q != 0)
    seen = key == own
    seen &= key != np.iinfo(np.int64).max
    rows, score = np.zeros(0, np.int64), np.zeros(0, x.dtype)
    up = q > 0
    depth, step = 0, 32
    while depth < n:
        upto = min(n, depth + step)
        if len(dims):
            met = np.concatenate([lists[n - upto:n - depth, dims[up[dims]]].ravel(),
                                  lists[depth:upto, dims[~up[dims]]].ravel()])
        else:
            met, upto = np.arange(n), n
        new = np.zeros(n, bool)
        new[met] = True
        new = np.flatnonzero(new & ~seen)
        seen[new] = True
        rows = np.concatenate([rows, new])
        score = np.concatenate([score, x[new] @ q])
        if len(rows) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            keep = score >= least
            rows, score = rows[keep], score[keep]
            best = np.lexsort((key[rows], -score))[:k]
            rows, score = rows[best], score[best]
        depth, step = upto, step * 2
        if len(rows) >= k and depth < n:
            last = np.where(up, n - depth, depth - 1)[dims]
            bound = (x[lists[last, dims], dims] * q[dims]).sum()
            if score.min() > bound:
                break
    return rows, score
