"""Nearest neighbours by inner product with randomly rotated one-bit codes and exact reranking."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import staged


def rotation(size: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, size]).standard_normal((size, size)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, centre, length of each residual over its alignment, error scale) of a block of vectors.

    A residual from the block's centre is turned and kept as the signs of its components; alignment is the
    inner product of the unit residual with its own unit code. For a query q the inner product with the
    residual is estimated by <code, turned q> x length / alignment, off by at most scale x |q| but for a
    small probability that the confidence factor of the search sets.
    """
    size = vectors.shape[1]
    centre = vectors.mean(0)
    turned = (vectors - centre) @ turn.T.astype(np.float64)
    length = np.linalg.norm(turned, axis=1)
    alignment = np.abs(turned).sum(1) / np.where(length > 0, length, 1) / math.sqrt(size)
    alignment[length == 0] = 1
    scale = length * np.sqrt(np.maximum(0, 1 - alignment**2)) / alignment / math.sqrt(max(1, size - 1))
    return np.packbits(turned > 0, axis=1), centre, length / alignment, scale


def clean(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v ARRAY<DOUBLE>, size) of the vectors that take part.

    Left out: null ids, null, empty or zero vectors, and those with null or non-finite components. Of rows
    with the same id the one with the smallest vector in array order counts.
    """
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()).where(fine & F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("size", F.size("v"))


def build_index(rows: DataFrame, block: int = 16384, seed: int = 7) -> DataFrame:
    """Blocks of about `block` vectors as one row each, for every row of `clean`; staged.

    (size, part, n, ids, bits, centre, lengths, scales, vectors): packed codes and correction scalars for the
    estimate, original vectors for reranking. Vectors are dealt to blocks by a hash of their id.
    """
    parts = max(1, math.ceil(rows.count() / block))

    def pack(key, group: pd.DataFrame) -> pd.DataFrame:
        v = np.array(group["v"].tolist(), np.float64).reshape(len(group), -1)
        bits, centre, lengths, scales = encode(v, rotation(v.shape[1], seed))
        return pd.DataFrame([{
            "size": key[0], "part": key[1], "n": len(group), "ids": group["id"].to_numpy("<i8").tobytes(),
            "bits": bits.tobytes(), "centre": centre.astype("<f8").tobytes(), "lengths": lengths.astype("<f4").tobytes(),
            "scales": scales.astype("<f4").tobytes(), "vectors": v.astype("<f8").tobytes()}])

    return staged(rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).groupBy("size", "part").applyInPandas(
        pack, "size int, part int, n int, ids binary, bits binary, centre binary, lengths binary, scales binary, vectors binary"))


PLANES = 6  # bits of a query's components in the estimate


def code_words(bits: np.ndarray) -> np.ndarray:
    """Packed codes as columns of 64-bit words, (words, rows)."""
    rows, size = bits.shape
    wide = np.zeros((rows, -(-size // 8) * 8), np.uint8)
    wide[:, :size] = bits
    return np.ascontiguousarray(wide.view(np.uint64).T)


def bit_planes(turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turned queries as whole numbers of `PLANES` bits: (planes (queries, planes, words), least component, width of a step)."""
    low, high = turned.min(1), turned.max(1)
    step = np.where(high > low, (high - low) / (2**PLANES - 1), 1)
    whole = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    planes = [code_words(np.packbits((whole >> b) & 1, axis=1)).T for b in range(PLANES)]
    return np.stack(planes, 1), low, step


def estimates(words: np.ndarray, ones: np.ndarray, planes: np.ndarray, low: float, step: float, total: float, size: int) -> np.ndarray:
    """Inner products of one query with all unit codes, by counting bits of code and plane together."""
    counts = np.bitwise_count(words[None] & planes[:, :, None]).reshape(-1, words.shape[1]).astype(np.float32)
    weights = np.repeat(2.0 ** np.arange(PLANES), len(words)).astype(np.float32)
    return (2 * (low * ones + step * (weights @ counts)) - total) / math.sqrt(size)


def search_block(queries: np.ndarray, query_ids: np.ndarray, block: dict, k: int, confidence: float, seed: int, reached: dict[int, float]):
    """Nearest k in one block for each query: (query number, id, exact score, how many were scored exactly).

    Bits give every vector's estimate and bounds. The best estimates are scored first; then those whose upper bound reaches
    the k-th best exact score so far, in this block or in another that `reached` knows of.
    """
    size, n = block["size"], block["n"]
    ids = np.frombuffer(block["ids"], "<i8")
    vectors = np.frombuffer(block["vectors"], "<f8").reshape(n, size)
    words = code_words(np.frombuffer(block["bits"], np.uint8).reshape(n, -1))
    ones = np.bitwise_count(words).sum(0).astype(np.float32)
    lengths, scales = np.frombuffer(block["lengths"], "<f4"), np.frombuffer(block["scales"], "<f4")
    centre = np.frombuffer(block["centre"], "<f8")
    turned = queries.astype(np.float32) @ rotation(size, seed).T
    norms, about = np.linalg.norm(queries, axis=1), queries @ centre
    planes, low, step = bit_planes(turned)
    floor = 1e-5 * np.linalg.norm(vectors, axis=1).max(initial=0)  # rounding of single precision
    for i, q in enumerate(queries):
        estimate = estimates(words, ones, planes[i], low[i], step[i], turned[i].sum(), size) * lengths + about[i]
        error = confidence * (norms[i] * scales + step[i] / math.sqrt(12) * lengths) + norms[i] * floor
        own = np.flatnonzero(ids == query_ids[i])
        estimate[own], error[own] = -np.inf, 0
        best = np.argpartition(estimate, n - min(n, 2 * k))[n - min(n, 2 * k):]
        scores = vectors[best] @ q
        scores[np.isin(best, own)] = -np.inf
        least = max(reached.get(int(query_ids[i]), -np.inf), np.partition(scores, len(best) - k)[len(best) - k] if len(best) >= k else -np.inf)
        chosen = estimate + error >= least - 1e-9 * abs(least) if np.isfinite(least) else np.ones(n, bool)
        chosen[best], chosen[own] = True, False
        found = np.flatnonzero(chosen)
        scored = len(found)
        scores = vectors[found] @ q
        if len(found) > k:
            last = np.partition(scores, len(found) - k)[len(found) - k]
            found = found[scores >= last - 1e-9 * (abs(last) + norms[i] * floor)]
        scores = np.cumsum(vectors[found] * q, axis=1)[:, -1]  # summed in order, as a plain loop does
        order = np.lexsort((ids[found], -scores))[:k]
        if len(order) == k:
            reached[int(query_ids[i])] = max(least, scores[order[-1]])
        yield i, ids[found][order], scores[order], scored


def search(index: DataFrame, queries: DataFrame, k: int = 20, confidence: float = 2.0, query_block: int = 1024, seed: int = 7) -> DataFrame:
    """The k nearest rows of an index for each row of `queries` (as from `clean`): (query_id, rank, vec_id, score).

    Nearness is the inner product in double precision, larger first, ties to the smaller id; a query's own id is
    not among its candidates, and fewer than k candidates are all returned. Vectors meet those of their own
    size only. Blocks of queries are dealt to every block of the index, so a task holds one pair of blocks.
    In it the one-bit estimate and its error bounds leave the vectors whose upper bound reaches the k-th best
    exact score so far; those are scored exactly, and of each block k rows per query are merged by a window.
    `confidence` is the bound's width in standard deviations. Empty tables give an empty result.
    """
    sizes = queries.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(max(1, math.ceil(queries.count() / query_block)))).cast("int"))

    def pack(key, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"size": key[0], "q_ids": group["id"].to_numpy("<i8").tobytes(),
                              "q": np.array(group["v"].tolist(), "<f8").tobytes()}])

    blocks = sizes.groupBy("size", "part").applyInPandas(pack, "size int, q_ids binary, q binary")
    parts = index.agg(F.coalesce(F.max("part"), F.lit(0))).first()[0]
    dealt = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts))))
    pairs = dealt.join(index, ["size", "part"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[int, float] = {}  # of the queries that this task has met
        for batch in batches:
            for pair in batch.to_pylist():
                q_ids = np.frombuffer(pair["q_ids"], "<i8")
                q = np.frombuffer(pair["q"], "<f8").reshape(len(q_ids), pair["size"])
                out = list(search_block(q, q_ids, pair, k, confidence, seed, reached))
                if not out:
                    continue
                query = np.concatenate([np.full(len(ids), q_ids[i]) for i, ids, *_ in out])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(np.concatenate([x for _, x, *_ in out]), pa.int64()),
                     pa.array(np.concatenate([x for _, _, x, _ in out]), pa.float64())], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(scan, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
