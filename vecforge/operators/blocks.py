"""Block layout for all-pairs work between a query side and a reference side.

Exact kNN must score every (query, reference) pair, but it must never *emit* every pair.
Both sides are cut into hash blocks of bounded size; the (query block, reference block)
grid is the unit of work. Each query row is replicated once per reference block and each
reference row once per query block, so the shuffle is ``n_q * B_ref + n_ref * B_q`` rows and
every task holds at most two bounded blocks. Keys are hashes of unique ids, so blocks are
uniform whatever the data looks like (no hot key).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Block sizing bounds.
# A block's bytes, not its rows, are bounded: the cells' shuffle is n_q * B_ref + n_ref * B_q rows, and
# for two blocks that share one memory bound equal sizes make it least.
MAX_BLOCK_BYTES = 32 << 20     # of doubles in one block
MAX_NATIVE_ROWS = 2048         # of a block that one row value holds as an array
PARTITION_BYTES = 256 << 20    # of cell input that one task reads, if it has several cells
MIN_QUERY_BLOCK_ROWS = 16
# Multiply-adds one grid cell should at least carry before the grid is split further for
# parallelism: BLAS scores ~1e9/s per core, interpreted higher-order functions ~1e7/s.
MIN_CELL_WORK = {"block": 1 << 27, "native": 1 << 20}
MIN_PARTITIONS_PER_SLOT = 4


@dataclass(frozen=True)
class BlockGrid:
    query_blocks: int
    ref_blocks: int
    shuffle_bytes: int = field(default=0, compare=False)  # estimated, of both sides' copies

    @property
    def cells(self) -> int:
        return self.query_blocks * self.ref_blocks

    def partitions(self, parallelism: int) -> int:
        """Shuffle partitions for the cell exchange: a few per task slot and no more bytes each
        than ``PARTITION_BYTES`` (whatever the parallelism is now), at most one per cell."""
        by_bytes = math.ceil(self.shuffle_bytes / PARTITION_BYTES)
        return max(1, min(self.cells, max(by_bytes, MIN_PARTITIONS_PER_SLOT * max(1, parallelism))))


def plan_grid(n_query: int, n_ref: int, dims: int, parallelism: int,
              max_block_rows: int | None = None, method: str = "block") -> BlockGrid:
    """Choose block counts from row counts, width and the work per cell, not constants.

    Blocks hold at most ``max_block_rows`` rows (memory per task). If the whole product is
    cheap it stays in one cell (fewest tasks); if it is expensive but has fewer cells than
    about four per task slot (cells hash onto partitions, so a few per slot even out the
    load), the query side is split further - each extra query block costs one more copy of a
    reference block, and no merge step.
    """
    cap = max_block_rows or max(MIN_QUERY_BLOCK_ROWS, MAX_BLOCK_BYTES // (8 * max(dims, 1)))
    if method == "native":
        cap = min(cap, MAX_NATIVE_ROWS)
    bq = max(1, math.ceil(n_query / cap))
    br = max(1, math.ceil(n_ref / cap))
    work = n_query * n_ref * max(dims, 1)
    wanted = max(1, min(MIN_PARTITIONS_PER_SLOT * parallelism, math.ceil(work / MIN_CELL_WORK[method])))
    if bq * br < wanted:
        most_q = max(1, math.ceil(n_query / MIN_QUERY_BLOCK_ROWS))
        bq = max(bq, min(most_q, math.ceil(wanted / br)))
    return BlockGrid(bq, br, (8 * dims + 24) * (n_query * br + n_ref * bq))


def block_of(id_col: Column, blocks: int, *spread: Column) -> Column:
    """Deterministic block id from the row's key (safe to recompute after executor loss).

    ``spread`` columns join the hash so that rows sharing a key value still scatter.
    """
    if blocks == 1:
        return F.lit(0)
    return F.pmod(F.xxhash64(id_col, *spread), F.lit(blocks)).cast("int")


def replicate(blocks: int) -> Column:
    """One output row per block id ``0 .. blocks-1``."""
    if blocks == 1:
        return F.lit(0)
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def lay_out(query: DataFrame, ref: DataFrame, grid: BlockGrid,
            query_id: str, ref_id: str, partitions: int,
            spread: tuple[Column, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Tag both sides with ``(qb, rb)`` grid coordinates and co-partition them by cell.

    The explicit partition count keeps adaptive execution from merging cells whose shuffle
    bytes are small but whose compute is not; both sides share it, so the cogroup or join
    that follows needs no further exchange.
    """
    q = (query.withColumn("qb", block_of(F.col(query_id), grid.query_blocks))
         .withColumn("rb", replicate(grid.ref_blocks)))
    r = (ref.withColumn("rb", block_of(F.col(ref_id), grid.ref_blocks, *spread))
         .withColumn("qb", replicate(grid.query_blocks)))
    return q.repartition(partitions, "qb", "rb"), r.repartition(partitions, "qb", "rb")
