"""Operator 1 against brute force on 50,000 vectors that the test makes itself."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loam.llm import additive

N = 50_000


@pytest.fixture(scope="module")
def vectors(spark):
    """Rows of the given table, each with many neighbours around it, as float32."""
    base = np.array([r[0] for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").select("embedding").collect()], np.float32)
    rng = np.random.default_rng(8)
    return (base[rng.integers(0, len(base), N)] + rng.normal(0, base.std() * 0.5, (N, base.shape[1]))).astype(np.float32)


@pytest.mark.parametrize("rerank, least", [(256, 0.9), (additive.RERANK, 0.98)])
def test_recall_on_a_table_made_here(spark, vectors, rerank, least):
    """Of 50,000 rows at most 256, or about 2 %, are reranked for a query."""
    table = spark.createDataFrame([(k, v) for k, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>")
    index, books = additive.build(table)
    got = defaultdict(set)
    for r in additive.search(index, books, F.col("vec_id") % 500 == 0, rerank=rerank).collect():
        got[r.query_id].add(r.vec_id)
    x, hit = vectors.astype(np.float64), 0
    for q, near in got.items():
        score = x @ x[q]
        score[q] = -np.inf
        hit += len(near & set(np.lexsort((np.arange(N), -score))[:20].tolist()))
    recall = hit / (20 * len(got))
    print(f"recall {recall:.4f} with {rerank} reranked")
    assert len(got) == N // 500 and recall >= least
