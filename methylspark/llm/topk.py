"""Exact top-k search: tiled matrix products of queries and shards, partial selection per tile, tree merging."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from methylspark.llm.common import Workspace, shuffle_partitions, table

#: Queries x dimensions that may be broadcast (32 MB); more meet the candidates in tiles.
BROADCAST_VALUES = 4_000_000
#: Values of a block of queries and of a shard of candidates in a tile: 2 M are 16 MB.
BLOCK_VALUES, SHARD_VALUES = 2_000_000, 1_000_000
#: Rows of a shard, and queries, in one tile: 1024 x 4096 scores are 32 MB.
TILE_ROWS, TILE_QUERIES = 1024, 4096
#: Partial lists that one merging step brings together.
FAN_IN = 16

_EXACT = 2.0**53
_LOW = -(2**63 - 1)


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double. An exact long where it fits, else the nearest long."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))


def usable(vector: Column) -> Column:
    """No null vector, no null, NaN or infinite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & F.coalesce(~bad, F.lit(False))


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles where no partial sum can pass 2^53, else in Python's integers, cut to a long."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if bound < _EXACT:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in q], dtype=object).reshape(q.shape)
    other = np.array([[int(x) for x in row] for row in c], dtype=object).reshape(c.shape)
    out = exact.dot(other.T) if q.shape[1] else np.zeros((len(q), len(c)), dtype=object)
    return np.clip(out, _LOW + 1, 2**63 - 1).astype(np.int64)


def _merge(s1, i1, s2, i2, k):
    """Two top lists per query into one: score descending, then id ascending."""
    s, i = np.concatenate([s1, s2], axis=1), np.concatenate([i1, i2], axis=1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def _tile_top(q, qids, c, cids, floor, k):
    """Best k of one tile for each query; (rows, scores, ids) of the queries for which the tile has something to add.

    ``floor``: the k-th best score so far. cids ascend, so among equal scores the earlier column wins.
    """
    s = _scores(q, c)
    s[qids[:, None] == cids[None, :]] = _LOW
    rows = np.flatnonzero((s.max(axis=1) >= floor) & (s.max(axis=1) > _LOW))
    s = s[rows]
    k = min(k, s.shape[1])
    if not len(rows):
        return rows, s[:, :k], np.empty((0, k), dtype=np.int64)
    if k < s.shape[1]:
        kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        over = s > kth[:, None]
        need = k - over.sum(axis=1)
        ties = s == kth[:, None]
        keep = over | (ties & (np.cumsum(ties, axis=1) <= need[:, None]))
        cols = np.nonzero(keep)[1].reshape(len(rows), k)
    else:
        cols = np.broadcast_to(np.arange(k), (len(rows), k))
    top = np.take_along_axis(s, cols, 1)
    return rows, top, np.where(top == _LOW, np.int64(2**63 - 1), cids[cols])


class _Lists:
    """The best k so far of some queries, over any number of shards."""

    def __init__(self, qids: np.ndarray, qkeys: np.ndarray, matrix: np.ndarray, k: int):
        self.qids, self.qkeys, self.matrix, self.k = qids, qkeys, matrix, k
        self.s = np.full((len(qids), k), _LOW, dtype=np.int64)
        self.i = np.full((len(qids), k), 2**63 - 1, dtype=np.int64)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        for c0 in range(0, len(ids), TILE_ROWS):
            c, cids = vectors[c0 : c0 + TILE_ROWS], ids[c0 : c0 + TILE_ROWS]
            for q0 in range(0, len(self.qids), TILE_QUERIES):
                part = slice(q0, q0 + TILE_QUERIES)
                rows, s, i = _tile_top(self.matrix[part], self.qids[part], c, cids, self.s[part, -1], self.k)
                if len(rows):
                    rows = rows + q0
                    self.s[rows], self.i[rows] = _merge(self.s[rows], self.i[rows], s, i, self.k)

    def batches(self, part: int) -> Iterator[pa.RecordBatch]:
        for q0 in range(0, len(self.qids), TILE_QUERIES):
            at = np.arange(q0, min(q0 + TILE_QUERIES, len(self.qids)))
            at = at[(self.s[at] > _LOW).any(axis=1)]
            have = self.s[at] > _LOW
            offsets = np.concatenate([[0], np.cumsum(have.sum(axis=1))]).astype(np.int32)
            top = pa.StructArray.from_arrays([pa.array(self.s[at][have]), pa.array(self.i[at][have])], names=["score", "vec_id"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.qids[at]), pa.array(self.qkeys[at]), pa.array(np.full(len(at), part, dtype=np.int64)), pa.ListArray.from_arrays(pa.array(offsets), top)],
                names=["query_id", "qkey", "part", "top"],
            )


_TOPS = "query_id long, qkey long, part long, top array<struct<score: long, vec_id: long>>"


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, indices of rows, vectors) of a batch whose column 1 holds lists, for each of their lengths."""
    lists = batch.column(1)
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        yield dim, rows, (flat if len(rows) == len(lengths) else flat[np.repeat(lengths == dim, lengths)]).reshape(len(rows), dim)


def _search(queries, k: int):
    """mapInArrow over candidates where they are read: every batch is a shard for the queries that were broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {matrix.shape[1]: _Lists(qids, qkeys, matrix, k) for qids, qkeys, matrix in queries.value}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for dim, rows, vectors in _vectors(batch):
                if dim in lists:
                    lists[dim].meet(ids[rows], vectors)
        for found in lists.values():
            yield from found.batches(TaskContext.get().partitionId())

    return run


def _packed(values: str, with_keys: bool):
    """mapInArrow: (i, v, h) -> blocks of vectors of one dimension as bytes, of at most ``values`` values: nr, dim, ids, keys, matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most, number = {"block": BLOCK_VALUES, "shard": SHARD_VALUES}[values], TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64) if with_keys else ids
            for dim, rows, vectors in _vectors(batch):
                step = max(1, most // max(1, dim))
                for at in range(0, len(rows), step):
                    own = rows[at : at + step]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], t) for v, t in ((number, pa.int64()), (dim, pa.int32()), (ids[own].tobytes(), pa.binary()), (keys[own].tobytes(), pa.binary()), (vectors[at : at + step].tobytes(), pa.binary()))],
                        names=["nr", "dim", "ids", "keys", "matrix"],
                    )
                    number += 1

    return run


_BLOCK = "nr long, dim int, ids binary, keys binary, matrix binary"


def _tiles(k: int):
    """mapInArrow over tiles (block of queries, shard of candidates), those of a block one after another: lists of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lists = None, None
        part = TaskContext.get().partitionId()
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n] for name in batch.schema.names}
                block, dim = row["block"].as_py(), row["dim"].as_py()
                if block != at:
                    if lists is not None:
                        yield from lists.batches(part)
                    qids, qkeys = (np.frombuffer(row[c].as_buffer(), dtype=np.int64) for c in ("qids", "qkeys"))
                    at, lists = block, _Lists(qids, qkeys, np.frombuffer(row["queries"].as_buffer(), dtype=np.float64).reshape(len(qids), dim).copy(), k)
                ids = np.frombuffer(row["ids"].as_buffer(), dtype=np.int64)
                lists.meet(ids, np.frombuffer(row["matrix"].as_buffer(), dtype=np.float64).reshape(len(ids), dim))
        if lists is not None:
            yield from lists.batches(part)

    return run


def _tiled(rows: DataFrame, queries: DataFrame, k: int, space: Workspace) -> DataFrame:
    """All tiles in one job: blocks of queries and shards of candidates meet by an equi-join on (dimension, block, group).

    Shards are dealt into groups, so that there are about as many (block, group) as twice the shuffle's partitions; a block
    goes to each group once and a shard to each block once.
    """
    spark = rows.sparkSession
    blocks = space.put(queries.mapInArrow(_packed("block", True), _BLOCK), "blocks")
    groups = max(1, -(-2 * shuffle_partitions(spark) // max(1, blocks.count())))
    shards = rows.withColumn("h", F.lit(0).cast("long")).mapInArrow(_packed("shard", False), _BLOCK)
    shards = shards.select("dim", "ids", "matrix", F.pmod(F.xxhash64("nr"), F.lit(groups)).alias("group"))
    named = blocks.select(F.col("nr").alias("block"), "dim", F.col("ids").alias("qids"), F.col("keys").alias("qkeys"), F.col("matrix").alias("queries"))
    dims = named.groupBy("dim").agg(F.collect_list("block").alias("blocks"))  # a number for each block
    shards = shards.join(dims, "dim").select("dim", "group", "ids", "matrix", F.explode("blocks").alias("block"))
    named = named.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    tiles = shards.join(named.hint("merge"), ["dim", "block", "group"]).select("block", "dim", "qids", "qkeys", "queries", "ids", "matrix")
    return tiles.mapInArrow(_tiles(k), _TOPS)


def _best(tops: Column, k: int) -> Column:
    """The k best of an array of (score, vec_id): score descending, then id ascending."""
    ordered = F.array_sort(
        F.transform(tops, lambda x: F.struct((-x["score"]).alias("minus"), x["vec_id"].alias("vec_id")))
    )
    return F.transform(F.slice(ordered, 1, k), lambda x: F.struct((-x["minus"]).alias("score"), x["vec_id"].alias("vec_id")))


def top_k(
    candidates: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256
) -> DataFrame:
    """For each row of ``candidates`` with ``is_query``, the k other rows with the highest integer inner product.

    Components become floor(scale * x). Returns query_id long, rank int (from 1), vec_id long, score long; ties go to
    the smaller id. Queries of at most BROADCAST_VALUES values in all are broadcast, and candidates are searched where they
    are read, without a shuffle. More queries meet the candidates in tiles of blocks and shards, all in one job; only the
    number of blocks comes to the driver. No id, vector or bucket can be hot: shards have equal sizes. A task keeps one
    list of k for each query that it has met and gives it out at the end; lists are merged FAN_IN at a time, then once for
    all.

    Vectors that are null or hold null, NaN or infinite components, and rows with a null id, take no part. Only vectors
    of the same length meet. Empty vectors score 0 with each other. Repeated rows: a row never meets another of its own
    id; as candidates, repeated rows count each; as queries, equal rows give one list, and rows of one id with different
    vectors one list each. Scores past a long's range are cut to it. Extra columns have no effect.
    """
    spark = candidates.sparkSession
    clean = candidates.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    rows = clean.select(F.col(id_col).cast("long").alias("i"), quantised(F.col(vector_col), scale).alias("v"))
    queries = (
        clean.where(is_query)
        .select(F.col(id_col).cast("long").alias("i"), quantised(F.col(vector_col), scale).alias("v"))
        .dropDuplicates(["i", "v"])
        .select("i", "v", F.xxhash64("v").alias("h"))
        .orderBy(F.size("v"), "i", "h")
    )
    space = Workspace(spark, "topk")
    queries = space.put(queries, "queries")
    held = queries.agg(F.coalesce(F.sum(F.greatest(F.size("v"), F.lit(1))), F.lit(0))).first()[0]
    if held <= BROADCAST_VALUES:
        by: dict[int, list] = {}
        for r in queries.collect():
            by.setdefault(len(r.v), []).append(r)
        sent = spark.sparkContext.broadcast([
            (np.array([r.i for r in some], dtype=np.int64), np.array([r.h for r in some], dtype=np.int64), np.array([r.v for r in some], dtype=np.float64).reshape(len(some), dim))
            for dim, some in by.items()
        ])
        parts, found = rows.rdd.getNumPartitions(), rows.mapInArrow(_search(sent, k), _TOPS)
    else:
        parts, found = shuffle_partitions(spark), _tiled(rows, queries, k, space)
    step = 1
    while parts > step * FAN_IN:
        step *= FAN_IN
        found = found.groupBy("query_id", "qkey", F.floor(F.col("part") / step).alias("part0")).agg(
            _best(F.flatten(F.collect_list("top")), k).alias("top")
        ).select("query_id", "qkey", (F.col("part0") * step).alias("part"), "top")
    found = found.groupBy("query_id", "qkey").agg(_best(F.flatten(F.collect_list("top")), k).alias("top"))
    out = space.put(found, "found")
    return out.select("query_id", F.posexplode("top").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )


def op10_topk_search(spark, sf_dir: str) -> DataFrame:
    """Top 5 of every embedding for the rows whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256e0 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
