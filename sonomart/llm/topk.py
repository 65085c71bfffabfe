"""Exact top-k search by inner product, as tiled matrix products.

Vectors are quantised to integers and packed into shards; queries are packed into blocks. Each (block,
shard) tile is one matrix product with a partial selection, and the k best of each tile are merged up a
tree whose nodes join at most ``FAN_IN`` lists. A tile holds a bounded number of vectors on either side and
knows nothing of sources or copies, so equal vectors cannot crowd a task. Shards and blocks are dealt to the cells of a
grid, about ``CELL`` of each to a cell, so a shard moves once for every ``CELL`` blocks of the stated query set; never does
every vector move as a row.

Products are exact: they run in doubles while all partial sums stay below 2**53, else in Python integers.

Defined results
---------------
* Vectors that are null, empty, or hold null or non-finite components take no part, as queries or candidates.
* Vectors meet only vectors of their own length.
* A query never meets rows with its own id. Rows that repeat a query id: the least vector is the query.
* Equal scores are ordered by id; rows that repeat a candidate id count once each.
* Null ids take no part. Empty tables give an empty result. Scores must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomart.operators.staging import stage

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
FAN_IN = 16
# Shards and blocks on either side of a cell, on average: some 30 MB of shards, less of blocks.
CELL = 32
SCALE = 256.0
_EXACT = float(1 << 53)

_PACK = "dim int, part long, ids binary, values binary, top double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (vec_id, v) with finite components, quantised to floor(SCALE * x) as doubles."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # Doubles keep integers of any magnitude; F.floor would overflow its long.
    return rows.select("vec_id", v)


def _packed(rows: int):
    """Vectors of a partition as packs of one length and at most ``rows`` vectors, ordered by id."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[int, list] = {}
        made = 0

        def emit(dim, items):
            nonlocal made
            ids = np.concatenate([i for i, _ in items])
            values = np.concatenate([x for _, x in items])
            out = []
            for at in range(0, len(ids), rows):
                some_ids, some = ids[at:at + rows], values[at:at + rows]
                order = np.argsort(some_ids, kind="stable")
                some = np.floor(some[order] * SCALE)
                top = float(np.abs(some).max())
                narrow = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
                out.append((dim, made, some_ids[order].tobytes(), narrow.encode() + some.astype(narrow).tobytes(), top))
                made += 1
            return pd.DataFrame(out, columns=["dim", "part", "ids", "values", "top"])

        for batch in batches:
            lengths = batch["v"].map(len)
            for dim, some in batch.groupby(lengths, sort=True):
                held = waiting.setdefault(int(dim), [])
                held.append((some["vec_id"].to_numpy(np.int64), np.array(some["v"].tolist(), dtype=np.float64)))
                if sum(len(i) for i, _ in held) >= rows:
                    yield emit(int(dim), waiting.pop(int(dim)))
        for dim, held in sorted(waiting.items()):
            yield emit(dim, held)
    return pack


def _numbered(packs: DataFrame, label: str) -> DataFrame:
    """Packs with a number of their own: the task and the place in it, fixed by storing them."""
    return stage(packs.withColumn("part", F.monotonically_increasing_id()), label)


def _matrix(values: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(values, dtype=values[:3].decode(), offset=3).reshape(-1, dim).astype(np.float64)


def tile_best(q_ids, q, c_ids, c, k: int, exact: bool):
    """The k best candidates of every query in one tile: (query, candidate, score) arrays.

    Candidates come ordered by id, so of equal scores the earlier column wins.
    """
    if exact:
        scores = q @ c.T
    else:
        scores = np.array([[int(x) for x in row] for row in q], dtype=object) @ np.array(
            [[int(x) for x in row] for row in c], dtype=object).T
    n = len(c_ids)
    queries, candidates, values = [], [], []
    if exact and (np.abs(scores).max() + 1) * n < _EXACT:
        # Score and place in one integer: all distinct, so a partial selection is right.
        keys = scores * n + (n - 1 - np.arange(n))
        keys[q_ids[:, None] == c_ids[None, :]] = -np.inf
        take = min(k, n)
        best = np.argpartition(keys, n - take, axis=1)[:, n - take:]
        rows = np.repeat(np.arange(len(q_ids)), take)
        best = best.ravel()
        alive = np.isfinite(keys[rows, best])
        rows, best = rows[alive], best[alive]
        return q_ids[rows], c_ids[best], scores[rows, best].astype(np.int64)
    for r in range(len(q_ids)):
        left = [(-int(scores[r, j]), j) for j in range(n) if c_ids[j] != q_ids[r]]
        for s, j in sorted(left)[:k]:
            queries.append(q_ids[r]), candidates.append(c_ids[j]), values.append(-s)
    return np.array(queries, np.int64), np.array(candidates, np.int64), np.array(values, np.int64)


def _cell(k: int):
    """All tiles of one cell of the grid: its shards against its blocks."""
    def run(shards: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "node": [], "vec_id": [], "score": []}, dtype=np.int64)]
        queries = [(np.frombuffer(b.ids, np.int64), _matrix(b.values, b.dim), b.top) for b in blocks.itertuples(index=False)]
        for s in shards.itertuples(index=False):
            ids, values = np.frombuffer(s.ids, np.int64), _matrix(s.values, s.dim)
            for q_ids, q, q_top in queries:
                best = tile_best(q_ids, q, ids, values, k, s.top * q_top * s.dim < _EXACT)
                found.append(pd.DataFrame({"query_id": best[0], "node": s.node, "vec_id": best[1], "score": best[2]}))
        return pd.concat(found, ignore_index=True)
    return run


def search(queries: DataFrame, candidates: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best candidates of every query."""
    asked = usable(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = _numbered(asked.mapInPandas(_packed(block_rows), _PACK), "topk-blocks")
    shards = _numbered(usable(candidates, id_col, vector_col).mapInPandas(_packed(shard_rows), _PACK), "topk-shards")
    n_shards, n_blocks = shards.count(), blocks.count()
    rows, columns = max(1, -(-n_shards // CELL)), max(1, -(-n_blocks // CELL))
    place = lambda n: F.pmod(F.xxhash64("part"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    shards = shards.select("dim", "ids", "values", "top", F.pmod(F.xxhash64("part"), F.lit(1 << 30)).alias("node"),
                           place(rows).alias("row"), every(columns).alias("column"))
    blocks = blocks.select("dim", "ids", "values", "top", place(columns).alias("column"), every(rows).alias("row"))
    cells = [d.withColumn("column", F.col("column").cast("long")).withColumn("row", F.col("row").cast("long")).groupBy("dim", "row", "column")
             for d in (shards, blocks)]
    found = cells[0].cogroup(cells[1]).applyInPandas(_cell(k), "query_id long, node long, vec_id long, score long")
    return merge_tree(found, n_shards, k)


def merge_tree(found: DataFrame, lists: int, k: int) -> DataFrame:
    """Merge per-tile lists up a tree: each level folds FAN_IN nodes into one."""
    best = lambda: F.slice(F.sort_array(F.collect_list(F.struct(
        (-F.col("score")).alias("down"), F.col("vec_id").alias("vec_id")))), 1, k)
    while lists > FAN_IN:
        lists = -(-lists // FAN_IN)
        level = found.withColumn("node", F.pmod(F.col("node"), F.lit(lists)))
        found = level.groupBy("query_id", "node").agg(best().alias("best")).select(
            "query_id", "node", F.explode("best").alias("b")).select(
            "query_id", "node", F.col("b.vec_id").alias("vec_id"), (-F.col("b.down")).alias("score"))
    top = found.groupBy("query_id").agg(best().alias("best"))
    return top.select("query_id", F.posexplode("best").alias("p", "b")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("b.vec_id").alias("vec_id"),
        (-F.col("b.down")).alias("score"))
