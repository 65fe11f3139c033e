"""Exact top-k inner products by pivot-table elimination.

Components become floor(256 x), so scores are integers. A table of distances
from the candidates to ``PIVOTS`` pivots gives each pair the lower bound
max over pivots |d(q, p) - d(x, p)| of its distance, and with the norms an
upper bound of its score, (|q|^2 + |x|^2 - bound^2) / 2. Candidates are
evaluated in descending order of that bound until it is below the k-th score,
so the result is exact whatever the pivots. A query starts with its k-th best
score among the pivots, which are rows themselves.

Queries are taken in blocks of ``BLOCK``, each one pass over the candidates
where they lie; a block is all that is broadcast, so its size is fixed. A task
gives k rows a query at most, and the best k of those are the answer.

Only vectors of the query's length are compared. Vectors that are null, or hold
a null or a component that is not finite, take no part; nor do null ids. An
empty vector scores 0 with others. Repeated ids: each row is a query of its own
(with its own ranks) and a candidate of all other rows. Ties go to the smaller
id. No queries or no candidates: no rows. Scores are exact for components of
any size; one that does not fit a long raises ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, prepare

PIVOTS = 32
BLOCK = 16_384      # queries of one pass
ROWS = 4_096        # candidates of one pivot table
CHUNK = 256         # candidates evaluated between two looks at the bound
LENGTHS = 64        # vector lengths, the most common ones, that have pivots
EXACT = 1 << 52     # products below it are exact in floating point


def scaled(vectors: DataFrame, id_column: str, vector_column: str, scale: int = 256) -> DataFrame:
    """``vec_id``, ``v`` (the components times ``scale``, a power of two, before
    they are rounded down), ``row`` (a number) of the rows that take part."""
    whole = F.col(vector_column).cast("array<double>")
    usable = F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & F.forall(
        whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(usable).select(
        F.col(id_column).cast("long").alias("vec_id"), F.transform(whole, lambda x: x * float(scale)).alias("v"),
        F.monotonically_increasing_id().alias("row"))


def _matrices(ids: np.ndarray, own: np.ndarray, vectors: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, row numbers and a matrix of whole numbers of the vectors of each length."""
    lengths = np.array([len(v) for v in vectors], np.int64)
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield ids[at], own[at], np.floor(np.array([vectors[i] for i in at], np.float64).reshape(len(at), n))


def _exact(a: np.ndarray, b: np.ndarray) -> int:
    score = sum(int(x) * int(y) for x, y in zip(a.tolist(), b.tolist()))
    if not -(1 << 63) <= score < 1 << 63:
        raise OverflowError(f"a score of {score} does not fit a long")
    return score


def _products(a: np.ndarray, b: np.ndarray, wanted: np.ndarray | bool = True) -> np.ndarray:
    """Inner products of whole numbers; by floats where those are exact, else
    (if ``wanted``) by integers of any size."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    x, y = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
    if x.max() * y.max() * a.shape[1] < EXACT:
        return (a @ b.T).astype(np.int64)
    with np.errstate(over="ignore", invalid="ignore"):
        large = ~(np.outer(x, y) * a.shape[1] < EXACT)
        out = np.where(large, 0.0, a @ b.T).astype(np.int64)
    for i, j in np.argwhere(large & wanted).tolist():
        out[i, j] = _exact(a[i], b[j])
    return out


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0.0))


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    return table["vec_id"].to_numpy(), table["row"].to_numpy(), [v for c in table["v"].chunks for v in c.to_numpy(zero_copy_only=False)]


class Block:
    """Queries of one pass with the pivots, by vector length."""

    def __init__(self, queries: pa.Table, pivots: pa.Table, k: int):
        self.k, self.parts = k, {}
        with np.errstate(over="ignore", invalid="ignore"):
            piv = {m.shape[1]: (r, m) for _, r, m in _matrices(*_rows(pivots))}
            for ids, own, m in _matrices(*_rows(queries)):
                prow, pm = piv.get(m.shape[1], (np.zeros(0, np.int64), np.zeros((0, m.shape[1]))))
                scores = _products(m, pm, own[:, None] != prow)
                floor = np.full(len(ids), np.iinfo(np.int64).min)
                for r in range(len(ids)):
                    other = np.sort(scores[r][prow != own[r]])
                    if len(other) >= k:
                        floor[r] = other[-k]
                self.parts[m.shape[1]] = ids, own, m, pm, _distances(m, pm), floor

    def search(self, cid: np.ndarray, crow: np.ndarray, c: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(query, its row, candidate, score): all of the k best that are not surely beaten elsewhere."""
        if c.shape[1] not in self.parts:
            return
        ids, own, m, pm, dq, floor = self.parts[c.shape[1]]
        dc = _distances(c, pm)                                  # the pivot table
        norm_c, norm_q = (c * c).sum(axis=1), (m * m).sum(axis=1)
        for r, (qid, qrow) in enumerate(zip(ids.tolist(), own.tolist())):
            low = np.abs(dc - dq[r]).max(axis=1) if dc.shape[1] else np.zeros(len(c))
            # Rounding of the distances is far below this margin.
            margin = 1.0 + 1e-9 * (norm_q[r] + norm_c)
            bound = (norm_q[r] + norm_c - low * low) / 2 + margin
            bound[np.isnan(bound)] = np.inf                     # beyond floating point: to be evaluated
            bound[crow == qrow] = -np.inf
            least = floor[r]
            at = np.flatnonzero(bound >= least)
            at = at[np.argsort(-bound[at], kind="stable")]
            best: list[tuple[int, int]] = []
            for start in range(0, len(at), CHUNK):
                some = at[start: start + CHUNK]
                if bound[some[0]] < least or bound[some[0]] == -np.inf:
                    break
                some = some[bound[some] > -np.inf]
                scores = _products(c[some], m[r: r + 1])[:, 0]
                take = scores >= least
                best += zip((-scores[take]).tolist(), cid[some][take].tolist())
                best = sorted(best)[: self.k]
                if len(best) == self.k:
                    least = max(least, -best[-1][0])
            for negative, vec in best:
                yield qid, qrow, vec, -negative


_FOUND = "query_id long, query_row long, vec_id long, score long"


def _search(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore", invalid="ignore"):
            for batch in batches:
                ids, own, vectors = batch.column("vec_id").to_numpy(), batch.column("row").to_numpy(), batch.column("v")
                for start in range(0, batch.num_rows, ROWS):
                    here = slice(start, start + ROWS)
                    lists = list(vectors.slice(start, ROWS).to_numpy(zero_copy_only=False))
                    found = [x for part in _matrices(ids[here], own[here], lists) for x in block.value.search(*part)]
                    columns = list(zip(*found)) if found else [[]] * 4
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns],
                                                     names=["query_id", "query_row", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
          pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best rows
    other than itself. ``is_query`` is a column over ``vec_id``."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = materialize(scaled(vectors, id_column, vector_column), "vectors")
    # Pivots: the rows whose ids hash lowest, of each of the commonest lengths.
    n = F.size("v")
    common = [r[0] for r in rows.groupBy(n.alias("n")).count().orderBy(F.desc("count"), "n").limit(LENGTHS).collect()]
    lowest = Window.partitionBy(n).orderBy(F.xxhash64("vec_id"), "vec_id", "row")
    table = rows.filter(n.isin(common)).withColumn("at", F.row_number().over(lowest)).filter(F.col("at") <= pivots)
    chosen = table.select("vec_id", "row", "v").toArrow()
    # Blocks of queries by a hash of their rows; a block's size is at most about BLOCK.
    queries = rows.filter(is_query)
    n_blocks = -(-queries.count() // block)
    found = None
    for b in range(n_blocks):
        own = queries.filter(F.pmod(F.xxhash64("row", F.lit("block")), F.lit(n_blocks)) == b)
        held = Block(own.select("vec_id", "row", "v").toArrow(), chosen, k)
        part = rows.select("vec_id", "row", "v").mapInArrow(_search(spark.sparkContext.broadcast(held)), _FOUND)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], _FOUND)
    best = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
