"""Exact top-k search by inner product.

Queries and candidates are packed into tiles, every query tile meets every candidate tile in one matrix product,
which keeps the best ``k`` of the tile, and a tree of aggregations merges the short lists of each query. The tiles
of a lane meet by an equi-join on the lane; memory of a task is two tiles and their scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

QUERY_TILE, CANDIDATE_TILE = 512, 4096
#: Candidate tiles in a lane, and short lists that one step of the tree merges.
LANE_TILES, MERGED = 8, 32
LONGEST = np.iinfo(np.int64).max

TILES = "tile long, query boolean, dim int, ids binary, vectors binary"
LISTS = "query_row long, query_id long, tile long, best array<struct<cost: bigint, id: bigint>>"


def quantise(vectors: np.ndarray, scale: int) -> np.ndarray:
    """The whole parts of all components times ``scale``; those beyond a double stay at its ends."""
    with np.errstate(over="ignore"):
        scaled = scale * vectors.astype(np.float64)
    most = np.finfo(np.float64).max
    return np.floor(np.clip(scaled, -most, most))


def _tiles(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Pack rows ``(id, query, vector)``; rows without an id, and vectors that are null or hold null or non-finite parts, go."""
    number = TaskContext.get().partitionId() << 32
    open_tiles: dict[tuple[bool, int], list[tuple[np.ndarray, np.ndarray]]] = {}

    def packed(query: bool, dim: int, parts: list) -> pa.RecordBatch:
        nonlocal number
        ids, vectors = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.argsort(ids, kind="stable")
        kind = np.float32 if np.abs(vectors).max(initial=0) < 1 << 24 else np.float64
        number += 1
        row = [number, query, dim, ids[order].tobytes(), vectors[order].astype(kind).tobytes()]
        return pa.RecordBatch.from_pylist([dict(zip(("tile", "query", "dim", "ids", "vectors"), row, strict=True))], schema=SCHEMA)

    for batch in batches:
        ids = batch.column(0)
        lists = batch.column(2)
        use = ids.is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(use)
        if not len(rows):
            continue
        lists = lists.take(pa.array(rows))
        ids, queries = ids.take(pa.array(rows)).to_numpy(), batch.column(1).take(pa.array(rows)).to_numpy(zero_copy_only=False)
        flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null parts become NaN
        sizes = lists.value_lengths().to_numpy()
        starts = np.cumsum(sizes) - sizes
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
        sound = bad[starts + sizes] == bad[starts]
        for dim in np.unique(sizes[sound]):
            at = np.flatnonzero(sound & (sizes == dim))
            vectors = quantise(flat[starts[at][:, None] + np.arange(dim)], scale)
            for query, size in ((False, CANDIDATE_TILE), (True, QUERY_TILE)):
                own = queries[at] if query else np.ones(len(at), bool)
                parts = open_tiles.setdefault((query, int(dim)), [])
                parts.append((ids[at][own], vectors[own]))
                while (n := sum(len(p[0]) for p in parts)) >= size:
                    a, v = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                    yield packed(query, int(dim), [(a[:size], v[:size])])
                    parts[:] = [(a[size:], v[size:])] if n > size else []
    for (query, dim), parts in open_tiles.items():
        if sum(len(p[0]) for p in parts):
            yield packed(query, dim, parts)


SCHEMA = pa.schema([("tile", pa.int64()), ("query", pa.bool_()), ("dim", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows, exact: in the smallest type that holds them; beyond a long they stay at its ends."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])  # at worst infinite
    if most < 1 << 24:
        return (q.astype(np.float32) @ c.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q) @ whole(c).T, -LONGEST, LONGEST).astype(np.int64)


def best_of_tile(scores: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query its best ``k`` columns with another id; columns stand in order of id, so ties go to the smaller."""
    width = scores.shape[1]
    if np.abs(scores).max(initial=0) < LONGEST // (4 * width):
        keys = scores * width + (width - 1 - np.arange(width))
        keys[query_ids[:, None] == ids[None, :]] = -LONGEST
        if width > k:
            chosen = np.argpartition(keys, width - k, axis=1)[:, width - k :]
        else:
            chosen = np.broadcast_to(np.arange(width), keys.shape)
        for r, columns in enumerate(chosen):
            columns = columns[keys[r, columns] != -LONGEST]
            yield ids[columns], scores[r, columns]
    else:
        for r in range(len(scores)):
            columns = np.flatnonzero(ids != query_ids[r])
            columns = columns[np.lexsort((ids[columns], -scores[r, columns]))][:k]
            yield ids[columns], scores[r, columns]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("tile", pa.int64()), ("best", pa.list_(pa.struct([("cost", pa.int64()), ("id", pa.int64())])))])
    for batch in batches:
        for pair in range(batch.num_rows):
            q_tile, tile, dim, q_ids, q, ids, c = (batch.column(i)[pair].as_py() for i in range(7))
            q_ids, ids = np.frombuffer(q_ids, np.int64), np.frombuffer(ids, np.int64)
            q, c = (np.frombuffer(x, np.float32 if len(x) == 4 * n * dim else np.float64).reshape(n, dim) for x, n in ((q, len(q_ids)), (c, len(ids))))
            found = list(best_of_tile(products(q, c), q_ids, ids, k))
            sizes = [len(x[0]) for x in found]
            flat = pa.StructArray.from_arrays([pa.array(-np.concatenate([x[1] for x in found])), pa.array(np.concatenate([x[0] for x in found]))], ["cost", "id"])
            best = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)
            rows = np.arange(len(q_ids)) + (q_tile * QUERY_TILE)
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(q_ids), pa.array(np.full(len(q_ids), tile)), best], schema=schema)


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``(query_id, rank, <id_col>, score)``: the ``k`` highest inner products of each query row with all rows of another id.

    Each part x of a vector counts as floor(``scale`` * x), and what is beyond a double, or in a score beyond a long, as its end. Vectors that are null or hold null or non-finite parts, and
    rows without an id, take no part; vectors of different lengths do not meet. Ties go to the smaller id. Rows with the
    same id are each a candidate, and each a query with a list of its own. An empty table gives no rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("query"), F.col(vector).alias("vector"))
    path = scratch_path(spark, "tiles")
    rows.mapInArrow(lambda batches: _tiles(batches, scale), TILES).write.parquet(path)
    tiles = spark.read.schema(TILES).parquet(path)
    candidates = tiles.where("NOT query")
    count = candidates.count()
    lanes = max(1, -(-count // LANE_TILES))
    c = candidates.select("dim", "tile", "ids", "vectors", F.expr(f"pmod(xxhash64(tile), {lanes})").alias("lane"))
    q = tiles.where("query").select(
        F.col("dim").alias("q_dim"), F.col("tile").alias("q_tile"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("q_lane"),
    )
    pairs = q.join(c, (F.col("q_lane") == F.col("lane")) & (F.col("q_dim") == F.col("dim")))
    pairs = pairs.select("q_tile", "tile", "dim", "q_ids", "q_vectors", "ids", "vectors")
    lists = pairs.mapInArrow(lambda batches: _search(batches, k), LISTS)
    groups = count
    while groups > 1:
        groups = -(-groups // MERGED)
        merged = F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
        lists = lists.groupBy("query_row", "query_id", F.expr(f"pmod(xxhash64(tile, {groups}), {groups})").alias("tile")).agg(merged)
    ranked = lists.select("query_row", "query_id", F.posexplode(F.slice(F.sort_array("best"), 1, k)).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias(id_col), (-F.col("hit.cost")).alias("score"))
