"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors are cut into segments, coarse to fine. With the mean m and the length s of the deviations from it of each
segment of w components, ``x.q <= sum(w m_x m_q + s_x s_q)`` (a lower bound of the distance, as
``|x-q|^2 = |x|^2 + |q|^2 - 2 x.q``). Candidates whose bound stays below a score that k others reach are dropped, the
survivors go to the next resolution, and what is left is computed exactly.

The work is a grid: queries in blocks of about ``QUERY_BLOCK``, all vectors in blocks of about ``ROW_BLOCK``, one cell
per pair of blocks, spread over the cluster. A first pass over one cell per query block finds for each query a score
that k of its candidates reach; the second pass over all cells drops what is below. A cell returns at most k rows a
query, and a window with a map-side limit merges them.

Components become floor(scale * x) as integers. Vectors that are null, empty, hold null or non-finite components, or
components so large that a score would not fit a long, take no part; nor do rows without an id. Shorter vectors count
as padded with zeros. Query rows that share an id and differ in vector each get their own k results; equal ones get them
once. Ties go to the smaller id; rows of equal id are candidates each on its own, except for the query
itself (all rows of the query's id are left out). With fewer candidates than k, all are returned. An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookfold.llm.common import only, stored

QUERY_BLOCK, ROW_BLOCK = 1024, 8192
_LEVELS = (4, 16)


def _padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Scaled means and deviation lengths side by side: the dot product of two such rows bounds the vectors' own from above."""
    width = -(-x.shape[1] // segments)
    cut = np.zeros((len(x), segments * width))
    cut[:, : x.shape[1]] = x
    cut = cut.reshape(len(x), segments, width)
    mean = cut.mean(axis=2)
    rest = np.sqrt(((cut - mean[:, :, None]) ** 2).sum(axis=2))
    return np.concatenate([mean * np.sqrt(width), rest], axis=1)


def search_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, row number and score of each query's k best rows of the block that reach its floor."""
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1] < 2**52
    wide_q, wide_x = (queries, rows) if exact else (queries.astype(np.int64), rows.astype(np.int64))
    stats = [(segment_statistics(queries, s), segment_statistics(rows, s)) for s in _LEVELS]
    bounds = stats[0][0] @ stats[0][1].T
    slack = 1e-9 * (1 + np.abs(bounds).max(initial=0)) + 1e-6
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for i in range(len(queries)):
        bound, floor = bounds[i], float(floors[i])
        # The rows of largest coarse bound first: k of them give a floor that all others must reach.
        if len(bound) > 4 * k:
            first = np.argpartition(-bound, 4 * k)[: 4 * k]
            first = first[row_ids[first] != query_ids[i]]
            scores = wide_x[first] @ wide_q[i]
            if len(scores) >= k:
                floor = max(floor, float(np.partition(scores, -k)[-k]))
        alive = np.flatnonzero((bound + slack >= floor) & (row_ids != query_ids[i]))
        for q, x in stats[1:]:
            alive = alive[x[alive] @ q[i] + slack >= floor]
        scores = wide_x[alive] @ wide_q[i]
        reach = scores >= floor
        alive, scores = alive[reach], scores[reach].astype(np.int64)
        best = np.lexsort([row_ids[alive], -scores])[:k]
        found.append((np.full(len(best), i), alive[best], scores[best]))
    return tuple(np.concatenate(c) if found else np.empty(0, np.int64) for c in zip(*found)) if found else (np.empty(0, np.int64),) * 3


def _blocks(rows: DataFrame, count: int, size: int, name: str) -> tuple[DataFrame, int]:
    """Rows of ids and vectors packed into blocks; a block holds about ``size`` rows however many there are."""
    n = max(1, -(-count // size))
    # The row's hash, not its id alone: rows of one id spread too.
    block = F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    packed = rows.groupBy(block.alias(name)).agg(F.collect_list(F.struct("id", "v")).alias(f"{name}_rows"))
    return packed.select(name, F.col(f"{name}_rows.id").alias(f"{name}_ids"), F.col(f"{name}_rows.v").alias(f"{name}_vectors")), n


def quantized(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    rows = only(vectors, id=id_column, x=vector_column).select(F.col("id").cast("long").alias("id"), F.col("x").cast("array<double>").alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))
    # A score is a sum of size(x) products, each below 2^62 / size(x).
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) + 1 < F.sqrt(F.lit(2.0**62) / F.size("x")))
    usable = rows.filter(F.forall("x", fits))
    return usable.select("id", F.transform("x", lambda c: F.floor(c * scale)).cast("array<bigint>").alias("v"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Columns query_id, rank (from 1), vec_id and score; ``is_query`` is a condition on the column ``id``."""
    rows = stored(quantized(vectors, scale, id_column, vector_column), "vectors")
    # Repeated rows of a query ask the same question.
    queries = rows.filter(is_query).dropDuplicates(["id", "v"])
    q_blocks, n_q = _blocks(queries, queries.count(), QUERY_BLOCK, "q")
    r_blocks, n_r = _blocks(rows, rows.count(), ROW_BLOCK, "r")
    q_blocks, r_blocks = stored(q_blocks, "queries"), stored(r_blocks, "rows")

    def cells(frames: Iterator[pd.DataFrame], floors_only: bool) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for cell in frame.itertuples():
                width = max(max(map(len, cell.q_vectors)), max(map(len, cell.r_vectors)))
                q, x = _padded(cell.q_vectors, width), _padded(cell.r_vectors, width)
                q_ids, r_ids = np.asarray(cell.q_ids), np.asarray(cell.r_ids)
                floors = np.full(len(q), -np.inf) if floors_only else np.asarray(cell.floors, np.float64)
                at, row, score = search_block(q, q_ids, x, r_ids, k, floors)
                if floors_only:
                    reached = [(s[-1] if len(s := score[at == i]) >= k else -np.inf) for i in range(len(q))]
                    yield pd.DataFrame({"q": [cell.q], "floors": [np.array(reached, np.float64)]})
                else:
                    yield pd.DataFrame({"q": cell.q, "at": at, "query_id": q_ids[at], "vec_id": r_ids[row], "score": score})

    home = q_blocks.withColumn("r", F.col("q") % n_r).repartition(n_q, "q").join(r_blocks, "r")
    floors = home.mapInPandas(lambda frames: cells(frames, True), "q int, floors array<double>")
    # An empty row block leaves a query block without floors; then nothing is dropped early.
    none = F.transform("q_ids", lambda _: F.lit(float("-inf")))
    asked = q_blocks.join(floors, "q", "left").withColumn("floors", F.coalesce("floors", none))
    grid = asked.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(n_r - 1)))).repartition(max(1, n_q * n_r), "q", "r")
    scored = grid.join(r_blocks, "r").mapInPandas(lambda frames: cells(frames, False), "q int, at int, query_id long, vec_id long, score long")
    # By block and place: query rows that share an id and differ in vector are queries of their own.
    rank = F.row_number().over(Window.partitionBy("q", "at").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
