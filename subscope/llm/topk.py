"""Exact inner-product search over a bit-sliced index.

Vectors are quantised to integers. A block of rows stores, for every component, the upper
bits of its offset value as bitmaps over the rows. For a query, the slices are added up by
carry-save adders to the bitmaps of a coarse score: all slices of one weight meet as
bitmaps, three of a weight give a sum bitmap and a carry of the next weight. What the lower
bits can add is bounded per query. Rows are then selected from the most significant slice
of the coarse score downward, which gives the k-th best coarse score and the rows above it;
every row whose coarse score is within the bound of it is a boundary row and is scored
exactly from its integers.

Each row travels once, to the task of its block, which indexes the block once; queries, of
which there are far fewer, are copied for every block and stream past its index. Only k rows
per query and block are shuffled for the final rank. Of rows that repeat an id and its vector
at most k can be among k results, so no more of them travel.

Defined cases: vectors that are NULL or hold NULL, NaN or infinite components take no part,
nor do rows with a NULL id; missing trailing components count as zero; equal scores are
ranked by the smaller id; repeated rows of one id are separate candidates of any other id,
and separate queries are not (an id is asked once, with its row that is largest as an
array); fewer candidates than k give fewer rows; an empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import plain
from . import common

SCALE = 256
ROWS = 8192  # rows of an index block
UPPER_BITS = 5  # slices kept per component

RESULT = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and the quantised vector of the rows that take part."""
    x = plain(vector_col).cast("array<double>")
    df = vectors.select(plain(id_col).cast("long").alias("vec_id"), x.alias("x"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    df = df.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(sound)
    return df.select("vec_id", F.transform("x", lambda v: F.floor(v * SCALE)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as integers, short ones filled up with zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten()).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _pad(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


class SlicedBlock:
    """Bitmaps of the upper bits of each component of a block of rows."""

    def __init__(self, rows: np.ndarray, upper_bits: int = UPPER_BITS):
        self.rows = rows
        self.low = rows.min(axis=0) if rows.size else np.zeros(rows.shape[1], np.int64)
        offset = rows - self.low
        bits = max(int(offset.max()).bit_length() if offset.size else 0, 1)
        self.shift = max(0, bits - upper_bits)
        self.bits = bits - self.shift
        coarse = offset >> self.shift
        self.top = (1 << self.bits) - 1
        # slices[j][b] holds bit b of component j of all rows, 64 rows to a word.
        self.slices = [[self._pack((coarse[:, j] >> b) & 1) for b in range(self.bits)] for j in range(rows.shape[1])]
        self.full = self._pack(np.ones(len(rows), dtype=np.uint8))

    @staticmethod
    def _pack(flags: np.ndarray) -> np.ndarray:
        packed = np.packbits(flags.astype(np.uint8), bitorder="little")
        return np.pad(packed, (0, -len(packed) % 8)).view(np.uint64)

    def coarse_score(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of a score, least significant first, and its greatest error.

        The score of a row is the sum of |q| times the component's coarse value, taken from
        the top down where q is negative (the complement of its slices). It orders rows as
        the exact score does, up to the part of the lower bits: |q| times what they hold.
        """
        waiting: dict[int, list[np.ndarray]] = {}
        for j, q in enumerate(query.tolist()):
            weight, at = abs(q), 0
            while weight:
                if weight & 1:
                    for b, bitmap in enumerate(self.slices[j]):
                        waiting.setdefault(at + b, []).append(bitmap if q > 0 else bitmap ^ self.full)
                weight >>= 1
                at += 1
        out, level = [], 0
        while waiting:
            maps = waiting.pop(level, [])
            carry = waiting.setdefault(level + 1, [])
            while len(maps) > 2:
                a, b, c = maps.pop(), maps.pop(), maps.pop()
                half = a ^ b
                maps.insert(0, half ^ c)
                carry.append((a & b) | (half & c))
            if len(maps) == 2:
                a, b = maps
                maps = [a ^ b]
                carry.append(a & b)
            out.append(maps[0] if maps else np.zeros_like(self.full))
            level += 1
            if not any(waiting.values()):
                break
        error = int(np.abs(query).sum()) * ((1 << self.shift) - 1)
        return out, error

    def threshold(self, score: list[np.ndarray], allowed: np.ndarray, k: int) -> int:
        """The k-th largest score among ``allowed`` rows; from the top slice downward."""
        value, tied, need = 0, allowed, k
        for level in range(len(score) - 1, -1, -1):
            high = tied & score[level]
            found = int(np.bitwise_count(high).sum())
            if found >= need:
                tied, value = high, value | 1 << level
            else:
                need -= found
                tied = tied & ~score[level]
        return value

    def at_least(self, score: list[np.ndarray], allowed: np.ndarray, bound: int) -> np.ndarray:
        """Rows of ``allowed`` whose score is at least ``bound``, as row numbers."""
        if bound <= 0:
            chosen = allowed
        elif bound.bit_length() > len(score):
            chosen = np.zeros_like(allowed)
        else:
            above, tied = np.zeros_like(allowed), allowed
            for level in range(len(score) - 1, -1, -1):
                if bound >> level & 1:
                    tied = tied & score[level]
                else:
                    above = above | (tied & score[level])
                    tied = tied & ~score[level]
            chosen = above | tied
        return np.flatnonzero(np.unpackbits(chosen.view(np.uint8), bitorder="little"))

    def best(self, query: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and exact scores of the k best rows; rows flagged ``own`` excluded."""
        allowed = self.full if not own.any() else self.full & ~self._pack(own)
        n = int(np.bitwise_count(allowed).sum())
        if n > k:
            score, error = self.coarse_score(query)
            bound = self.threshold(score, allowed, k) - (error >> self.shift) - 1
            rows = self.at_least(score, allowed, bound)
        else:
            rows = np.flatnonzero(~own)
        exact = self.rows[rows] @ query
        order = np.lexsort((ids[rows], -exact))[:k]
        return rows[order], exact[order]


def _answers(block: SlicedBlock, ids: np.ndarray, asked: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """The k best rows of a block for each query of a batch."""
    found = [(np.zeros(0, np.int64),) * 3]
    width = block.rows.shape[1]
    # Components that no row of the block has meet zeros.
    wanted = _pad(_matrix(asked.column("x"))[:, :width], width)
    for query, name in zip(wanted, asked.column("vec_id").to_numpy()):
        at, score = block.best(query, ids == name, ids, k)
        found.append((np.full(len(at), name), ids[at], score))
    columns = [np.concatenate(c) for c in zip(*found)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ("query_id", "vec_id", "score"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Pieces of batches that belong to one block and are rows or queries."""
    for batch in batches:
        blocks, asks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row_block", "asks"))
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(asks) != 0)) + 1
        for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(blocks)]):
            if end > start:
                yield int(blocks[start]), bool(asks[start]), batch.slice(start, end - start)


def search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Answers to the queries of each block, whose rows come first. One block and one batch
    of queries are in memory."""
    current, parts, block, ids = None, [], None, None
    for number, asks, piece in _runs(batches):
        if number != current:
            current, parts, block = number, [], None
        if not asks:
            parts.append(piece.select(["vec_id", "x"]))
        elif parts or block is not None:
            if block is None:
                table = pa.Table.from_batches(parts).combine_chunks()
                block, ids, parts = SlicedBlock(_matrix(table.column("x").chunk(0))), table.column("vec_id").to_numpy(), []
            yield _answers(block, ids, piece, k)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = ROWS) -> DataFrame:
    """The k best rows of each query: query_id, rank, vec_id, score.

    Both frames hold vec_id and integer vectors. Rows are dealt to blocks of about
    ``block_rows`` by a hash, to at least as many as there are cores.
    """
    copies = rows.groupBy("vec_id", "x").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.select("vec_id", "x", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)))).alias("copy"))
    blocks = max(-(-rows.count() // block_rows), rows.sparkSession.sparkContext.defaultParallelism)
    at = F.pmod(F.xxhash64("vec_id", "x", "copy"), F.lit(blocks)).cast("int").alias("row_block")
    left = copies.select(at, F.lit(False).alias("asks"), "vec_id", "x")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("row_block")
    right = queries.select(every, F.lit(True).alias("asks"), "vec_id", "x")
    dealt = left.unionByName(right).repartitionById(blocks, F.col("row_block"))
    local = dealt.sortWithinPartitions("row_block", "asks").mapInArrow(lambda batches: search(batches, k), RESULT)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(common.table(spark, sf_dir, "embeddings"))
    queries = rows.where("vec_id % 50 = 0").groupBy("vec_id").agg(F.max("x").alias("x"))
    return top_k(rows, queries, 5)


OP5_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as x
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, r.vec_id,
    list_sum(list_transform(range(1, len(q.x) + 1), lambda i: q.x[i] * r.x[i]))::bigint as score
  from v q, v r where q.vec_id % 50 = 0 and q.vec_id <> r.vec_id
), k as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s
)
select query_id, rank, vec_id, score from k where rank <= 5
"""
