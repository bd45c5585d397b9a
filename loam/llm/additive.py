"""Operator 1: nearest neighbours by additive quantisation.

A vector is the sum of one full-dimensional codeword from each codebook. Codebooks start
as k-means of residuals and are refitted together by least squares; codes are found by a
beam search that works on inner products with the codewords and their Gram matrix. Each
row stores its codes and norms. A query's table of inner products with all codewords scores
every row by look-ups, from codes and norms alone; the best of all rows, a fixed number for
each query, are reranked with their vectors.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loam.llm.shared import stage

BOOKS, WORDS, BEAM, ROUNDS = 16, 64, 8, 2
#: Vectors the codebooks are fitted on: the index's bounded sample. Every row is indexed.
SAMPLE = 8192
#: Rows and queries that meet in one task, and queries scored at once.
ROWS, QUERIES, AT_ONCE = 16384, 4096, 64
#: Rows that are reranked for a query, of however many.
RERANK = 1024
NEIGHBOURS = 20


@dataclass
class Codebooks:
    words: np.ndarray  # books x words x dimensions

    @property
    def flat(self) -> np.ndarray:
        return self.words.reshape(-1, self.words.shape[2])


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        count = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        full = np.flatnonzero(count)
        starts = np.concatenate(([0], np.cumsum(count)[:-1]))[full]
        centres[full] = np.add.reduceat(x[order], starts) / count[full, None]
    return centres


def encode(books: Codebooks, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """Codes (rows x books, uint8) by beam search over partial sums of codewords."""
    m, k, _ = books.words.shape
    flat = books.flat
    gram, norms = flat @ flat.T, (flat**2).sum(1)
    out = np.empty((len(x), m), np.uint8)
    for at in range(0, len(x), 1024):
        dots = x[at : at + 1024] @ flat.T
        n = len(dots)
        codes, cost = np.zeros((n, 1, 0), np.int64), np.zeros((n, 1))
        for b in range(m):
            own = slice(b * k, (b + 1) * k)
            grown = cost[:, :, None] + norms[own] - 2 * dots[:, None, own]
            for j in range(b):
                grown = grown + 2 * gram[codes[:, :, j], own]
            grown = grown.reshape(n, -1)
            keep = min(beam, grown.shape[1])
            best = np.argpartition(grown, keep - 1, axis=1)[:, :keep]
            cost = np.take_along_axis(grown, best, 1)
            parent = np.take_along_axis(codes, (best // k)[:, :, None], 1)
            codes = np.concatenate((parent, (best % k + b * k)[:, :, None]), 2)
        win = cost.argmin(1)
        out[at : at + 1024] = codes[np.arange(n), win] - np.arange(m) * k
    return out


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = ROUNDS, seed: int = 1) -> Codebooks:
    """Codebooks from a sample: residual k-means, then joint least squares on beam-search codes."""
    rng = np.random.default_rng(seed)
    rest, parts = x.astype(np.float64), []
    for _ in range(books):
        parts.append(_kmeans(rest, words, rng))
        near = ((parts[-1] ** 2).sum(1) - 2 * rest @ parts[-1].T).argmin(1)
        rest = rest - parts[-1][near]
    found = Codebooks(np.stack(parts))
    for _ in range(rounds):
        at = encode(found, x).astype(np.int64) + np.arange(books) * words
        rows = np.zeros((len(x), books * words), np.float32)
        rows[np.arange(len(x))[:, None], at] = 1
        left = (rows.T @ rows).astype(np.float64) + 1e-2 * np.eye(books * words)
        # The small prior holds codewords that no row of the sample uses where they are.
        right = (rows.T @ x.astype(np.float32)).astype(np.float64) + 1e-2 * found.flat
        found = Codebooks(np.linalg.solve(left, right).reshape(found.words.shape))
    return found


def rebuilt(books: Codebooks, codes: np.ndarray) -> np.ndarray:
    return sum(books.words[b][codes[:, b]] for b in range(books.words.shape[0]))


def usable(vector: Column, dim: int) -> Column:
    """True for vectors of ``dim`` finite components that aren't all zero."""
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(vector) == dim) & whole & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def top(scores: np.ndarray, count: int) -> np.ndarray:
    """Positions of the ``count`` largest; of ties at the border the first positions."""
    if len(scores) <= count:
        return np.arange(len(scores))
    border = np.partition(scores, len(scores) - count)[len(scores) - count]
    sure = np.flatnonzero(scores > border)
    return np.concatenate((sure, np.flatnonzero(scores == border)[: count - len(sure)]))


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, embedding, codes, norms) of every usable row, and the codebooks.

    The dimension is the commonest length (of ties the smaller). Rows without an id, and
    vectors that are null, zero, of another length, or hold null or non-finite
    components, take no part; of rows that share an id the one with the smallest vector does.
    """
    named = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("embedding")).where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    common = named.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "vec_id long, embedding array<float>, codes binary, norm double, norm_rebuilt double"
    if common is None or common["n"] < 1:
        return vectors.sparkSession.createDataFrame([], schema), None
    good = named.where(usable(F.col("embedding"), common["n"])).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    good = stage(good.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding")) if dict(vectors.dtypes)[vector_col] == "array<float>" else good, "vectors")
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toArrow()
    if not sample.num_rows:
        return vectors.sparkSession.createDataFrame([], schema), None
    books = fit(_matrix(sample["embedding"]).astype(np.float64))
    kind = dict(good.dtypes)["embedding"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch["embedding"]).astype(np.float64)
                codes = encode(books, x)
                norms = np.linalg.norm(x, axis=1), np.linalg.norm(rebuilt(books, codes), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["embedding"], pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms[0]), pa.array(norms[1])],
                    names=["vec_id", "embedding", "codes", "norm", "norm_rebuilt"],
                )

    return stage(good.mapInArrow(run, schema.replace("array<float>", kind)), "index"), books


def quota(rerank: int, blocks: int) -> int:
    """Candidates of one block: rows are dealt to blocks at random, so hardly one of the best ``rerank`` is beyond it."""
    mean = rerank / blocks
    return min(rerank, int(np.ceil(mean + 6 * np.sqrt(mean) + 10)))


def search(index: DataFrame, books: Codebooks | None, queries: Column, count: int = NEIGHBOURS, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``count`` largest inner products found for each query row.

    Codes and queries are dealt into blocks; every pair of blocks is one task of bounded size
    that sees no other vectors than the queries'. Then the ``rerank`` best guesses of each
    query meet their vectors. Scores are exact double-precision inner products; ties go to
    the smaller vec_id.
    """
    if books is None:
        return index.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, q = index.count(), index.where(queries).count()
    blocks, groups = max(1, -(-n // ROWS)), max(1, -(-q // QUERIES))
    per_block = quota(rerank, blocks)
    deal = lambda df, own, k, other, m: df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(k)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))
    gain = (F.col("norm") / F.greatest("norm_rebuilt", F.lit(1e-12))).cast("float")  # undoes the shrinking of a rebuilt vector
    rows = deal(index.select("vec_id", "codes", gain.alias("gain")), "block", blocks, "batch", groups)
    asked = deal(index.where(queries).select("vec_id", "embedding"), "batch", groups, "block", blocks)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, vecs, score = [], [], []
        if left.num_rows and right.num_rows:
            left, right = left.sort_by("vec_id"), right.sort_by("vec_id")
            y, own, wanted = _matrix(right["embedding"]).astype(np.float64), left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
            codes = np.frombuffer(b"".join(left["codes"].to_pylist()), np.uint8).reshape(len(own), -1).T.astype(np.intp)
            scale = left["gain"].to_numpy()
            for at in range(0, len(wanted), AT_ONCE):
                tables = np.einsum("qd,bkd->bqk", y[at : at + AT_ONCE], books.words).astype(np.float32)
                guess = tables[0][:, codes[0]]
                for b in range(1, len(codes)):
                    guess += tables[b][:, codes[b]]
                guess *= scale
                for k in range(len(guess)):
                    chosen = top(guess[k], per_block + 1)
                    chosen = chosen[own[chosen] != wanted[at + k]]
                    ids.append(np.full(len(chosen), wanted[at + k]))
                    vecs.append(own[chosen])
                    score.append(guess[k][chosen])
        join = lambda parts, t: pa.array(np.concatenate(parts) if parts else np.zeros(0), t)
        return pa.table({"query_id": join(ids, pa.int64()), "vec_id": join(vecs, pa.int64()), "guess": join(score, pa.float32())})

    found = rows.groupBy("block", "batch").cogroup(asked.groupBy("block", "batch")).applyInArrow(meet, "query_id long, vec_id long, guess float")
    best = Window.partitionBy("query_id").orderBy(F.desc("guess"), "vec_id")
    chosen = stage(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= rerank).select("query_id", "vec_id"), "candidates")

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _matrix(batch["embedding"]).astype(np.float64), _matrix(batch["asked"]).astype(np.float64)
            score = (x * y).sum(1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch["query_id"], batch["vec_id"], pa.array(score)], names=["query_id", "vec_id", "score"])

    asking = index.where(queries).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("asked"))
    both = chosen.join(index.select("vec_id", "embedding"), "vec_id").join(asking, "query_id").select("query_id", "vec_id", "embedding", "asked")
    scored = both.mapInArrow(exact, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
