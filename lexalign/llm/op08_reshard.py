"""Resharding that moves the fewest bytes, by a minimum-cost flow from old shards to new capacities."""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import table

OLD_SHARDS, NEW_SHARDS = 12, 16
#: Blocks an old shard is cut into; the plan sees OLD_SHARDS * BLOCKS sizes, whatever the table holds.
BLOCKS = 1024


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """flow[i][j] of least total cost that ships all of supply within capacity; sum(supply) <= sum(capacity).

    Successive shortest paths with potentials on the bipartite graph of old and new shards.
    """
    n, m = len(supply), len(capacity)
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    pot = [0] * n + [min((cost[i][j] for i in range(n)), default=0) for j in range(m)]
    while any(left):
        far = float("inf")
        dist = [far] * (n + m)
        prev = [-1] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                dist[i] = 0
                heapq.heappush(heap, (0, i))
        while heap:
            d, x = heapq.heappop(heap)
            if d > dist[x]:
                continue
            if x < n:
                steps = ((n + j, cost[x][j] + pot[x] - pot[n + j]) for j in range(m))
            else:
                steps = ((i, -cost[i][x - n] + pot[x] - pot[i]) for i in range(n) if flow[i][x - n])
            for y, w in steps:
                if d + w < dist[y]:
                    dist[y], prev[y] = d + w, x
                    heapq.heappush(heap, (d + w, y))
        ends = [n + j for j in range(m) if room[j] and dist[n + j] < far]
        if not ends:
            raise ValueError("the capacities are less than the supply")
        end = min(ends, key=lambda y: (dist[y] + pot[y], y))
        for x in range(n + m):
            if dist[x] < far:
                pot[x] += dist[x]
        path, x = [], end
        while prev[x] >= 0:
            path.append((prev[x], x))
            x = prev[x]
        most = min([left[x], room[end - n], *(flow[b][a - n] for a, b in path if a >= n)])
        for a, b in path:
            if a < n:
                flow[a][b - n] += most
            else:
                flow[b][a - n] -= most
        left[x] -= most
        room[end - n] -= most
    return flow


def assign_blocks(blocks: list[tuple[int, int, int]], n_old: int, n_new: int) -> dict[tuple[int, int], int]:
    """New shard of each block, from (old shard, block, bytes); old shard i goes on as new shard i where there is one.

    The flow says how many bytes go from where to where. Blocks follow it, largest first, each to the place with the
    most bytes still due; what whole blocks leave uneven is evened out by single blocks from the fullest shard.
    """
    total = sum(b for *_, b in blocks)
    capacity = [total // n_new + (j < total % n_new) for j in range(n_new)]
    supply = [0] * n_old
    for i, _, b in blocks:
        supply[i] += b
    flow = min_cost_flow(supply, capacity, [[int(i != j) for j in range(n_new)] for i in range(n_old)])
    to: dict[tuple[int, int], int] = {}
    load = [0] * n_new
    own: list[list[tuple[int, int, int]]] = [[] for _ in range(n_new)]
    for i in range(n_old):
        due = [(-x, j != i, j) for j, x in enumerate(flow[i]) if x] or [(0, False, i if i < n_new else 0)]
        heapq.heapify(due)
        for b, k in sorted(((b, k) for o, k, b in blocks if o == i), reverse=True):
            x, moved, j = heapq.heappop(due)
            heapq.heappush(due, (x + b, moved, j))
            to[i, k] = j
            load[j] += b
            own[j].append((b, i, k))
    for _ in range(4 * n_new * n_new):
        hi, lo = max(range(n_new), key=load.__getitem__), min(range(n_new), key=load.__getitem__)
        gap = load[hi] - load[lo]
        fit = min((x for x in own[hi] if x[0] < gap), key=lambda x: (abs(2 * x[0] - gap), x), default=None)
        if fit is None:
            break
        own[hi].remove(fit)
        own[lo].append(fit)
        load[hi] -= fit[0]
        load[lo] += fit[0]
        to[fit[1], fit[2]] = lo
    return to


def reshard(docs: DataFrame, old_shard: Column | None = None, n_old: int = OLD_SHARDS, n_new: int = NEW_SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """All columns of docs with size, old_shard, shard and slot (gapless from 0 in each shard).

    size is the UTF-8 bytes of text (null: none) plus 1; new shards have nearly equal bytes, and documents leave
    their old shard (old_shard: 0 to n_old - 1, by default a hash of doc_id) only as the flow asks. Repeated rows and
    null ids are documents like others, in a shard's block ordered by id, size and hash of the text; an empty table gives no rows. Columns of docs named as the result's are
    replaced.

    Only the n_old * blocks block sizes reach the driver, and the broadcast table of their new shards has as many
    rows. Slots are numbered within blocks and offset by the blocks before, so no task orders a whole shard.
    """
    spark = docs.sparkSession
    old_shard = F.pmod(F.xxhash64("doc_id"), F.lit(n_old)) if old_shard is None else old_shard
    kept = [c for c in docs.columns if c not in ("size", "old_shard", "shard", "slot", "_block", "_from")]
    own = docs.select(
        *kept,
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        old_shard.cast("int").alias("old_shard"),
        F.pmod(F.xxhash64(F.lit("block"), "doc_id", "text"), F.lit(blocks)).cast("int").alias("_block"),
    )
    rows = own.groupBy("old_shard", "_block").agg(F.sum("size").alias("b"), F.count("*").alias("n")).orderBy("old_shard", "_block").collect()
    to = assign_blocks([(r[0], r[1], r["b"]) for r in rows], n_old, n_new)
    begin, known = [0] * n_new, []
    for r in rows:
        j = to[r[0], r[1]]
        known.append((r[0], r[1], j, begin[j]))
        begin[j] += r["n"]
    schema = T.StructType([T.StructField("old_shard", T.IntegerType()), T.StructField("_block", T.IntegerType()), T.StructField("shard", T.IntegerType()), T.StructField("_from", T.LongType())])
    placed = own.join(F.broadcast(spark.createDataFrame(known, schema)), ["old_shard", "_block"])
    rank = F.row_number().over(Window.partitionBy("old_shard", "_block").orderBy("doc_id", "size", F.xxhash64("text")))
    return placed.select(*kept, "size", "old_shard", "shard", (F.col("_from") + rank - 1).alias("slot"))


def rewrite(resharded: DataFrame, folder: str) -> list[int]:
    """Writes the shards that gain or lose documents as Parquet, one folder each; the others' files stay valid.

    A shard's folder is replaced whole, so a run that is repeated leaves the same files; without a move nothing is
    written. resharded is what reshard() gives. Returns the shards written, at most as many as there are.
    """
    moved = resharded.where("shard <> old_shard").select(F.explode(F.array("shard", "old_shard")).alias("s")).distinct()
    shards = sorted(r[0] for r in moved.collect())  # at most as many as there are shards
    if shards:
        resharded.where(F.col("shard").isin(shards)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(folder)
    return shards


def op8_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of reshard() over documents, by the law of bytes; rows, nulls and ties as there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    out = reshard(docs)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
