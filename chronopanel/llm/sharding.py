"""Resharding by minimum-cost flow.

``lay_out`` stores rows in their present shards, each shard sorted from its
largest row to its smallest and cut into blocks. ``solve`` takes the shards'
rows by size class and the new capacities and finds the block transfers that
move the fewest bytes: a flow network old shard -> (stays | size class ->
pool) -> new shard, solved by successive shortest paths. ``apply`` rewrites
only the blocks from which rows leave; the others stay in their files and get
their new positions from the transfer table.

Law: ``rows``. Capacities are row counts that differ by one at most, so the
counts of the new shards do. Moving a row costs its bytes, so shards with too
many rows send their smallest rows.

Defined cases: a null text has size 8 (its row's overhead); a null placement
key goes to old shard 0; rows that repeat or share an id are each placed (they
are ordered by id and text hash, and take consecutive positions); an empty
table gives an empty result and an empty plan; all columns of the input are
carried in one struct, so their names cannot clash with this module's.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import shared_folder, written

BLOCK_BYTES = 32 << 20
#: the plan has a row for each block, which every task holds
MOST_BLOCKS = 200_000

OVERHEAD = 8
SIZE_CLASSES = 48  # a row's class is the bit length of its size


class Flow:
    """Minimum-cost flow by successive shortest paths with potentials. The
    graph has a node per shard and an arc per shard and size class: its size
    does not grow with the rows."""

    def __init__(self, nodes: int):
        self.to, self.cap, self.cost, self.out = [], [], [], [[] for _ in range(nodes)]

    def arc(self, a: int, b: int, cap: int, cost: float) -> int:
        for src, dst, c, w in ((a, b, cap, cost), (b, a, 0, -cost)):
            self.out[src].append(len(self.to))
            self.to.append(dst)
            self.cap.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def flow(self, k: int) -> int:
        return self.cap[k ^ 1]

    def run(self, source: int, sink: int) -> tuple[int, float]:
        n, total, paid = len(self.out), 0, 0.0
        height = [0.0] * n
        while True:
            dist, via, queue = [float("inf")] * n, [-1] * n, [(0.0, source)]
            dist[source] = 0.0
            while queue:
                d, v = heapq.heappop(queue)
                if d > dist[v] + 1e-9:
                    continue
                for k in self.out[v]:
                    step = d + self.cost[k] + height[v] - height[self.to[k]]
                    if self.cap[k] and step < dist[self.to[k]] - 1e-9:
                        dist[self.to[k]], via[self.to[k]] = step, k
                        heapq.heappush(queue, (step, self.to[k]))
            if via[sink] < 0:
                return total, paid
            height = [h + d if d < float("inf") else h for h, d in zip(height, dist)]
            push, v = float("inf"), sink
            while v != source:
                push, v = min(push, self.cap[via[v]]), self.to[via[v] ^ 1]
            v = sink
            while v != source:
                self.cap[via[v]] -= push
                self.cap[via[v] ^ 1] += push
                paid += push * self.cost[via[v]]
                v = self.to[via[v] ^ 1]
            total += push


def solve(classes: list[tuple[int, int, int, int]], shards: int) -> dict:
    """``classes``: (old shard, size class, rows, bytes). Returns the rows each
    old shard keeps (``stay``), the transfers (old, new, rows), the new counts
    and the bytes moved. Every new shard holds the floor or the ceiling of the
    mean number of rows."""
    rows = {}
    for old, _, n, _ in classes:
        rows[old] = rows.get(old, 0) + n
    total = sum(rows.values())
    low, extra = divmod(total, shards)
    olds = sorted(rows)
    source, sink, pool = 0, 1, 2
    new_at, old_at = 3, 3 + shards
    spare = old_at + len(olds)
    net = Flow(spare + 1)
    stays = {}
    for i, old in enumerate(olds):
        net.arc(source, old_at + i, rows[old], 0)
        if 0 <= old < shards:
            stays[old] = net.arc(old_at + i, new_at + old, rows[old], 0)
    for old, _, n, size in classes:
        net.arc(old_at + olds.index(old), pool, n, size / n)
    for j in range(shards):
        net.arc(pool, new_at + j, total, 0)
        net.arc(new_at + j, sink, low, 0)
        net.arc(new_at + j, spare, 1, 0)
    net.arc(spare, sink, extra, 0)
    placed, moved = net.run(source, sink)
    assert placed == total
    stay = {old: net.flow(k) for old, k in stays.items()}
    give = [[old, rows[old] - stay.get(old, 0)] for old in olds]
    counts = {j: sum(net.flow(k) for k in net.out[new_at + j] if k % 2 == 0 and net.to[k] in (sink, spare)) for j in range(shards)}
    transfers = []
    for j in range(shards):
        need = counts[j] - stay.get(j, 0)
        while need:
            while not give[0][1]:
                give.pop(0)
            n = min(need, give[0][1])
            transfers.append((give[0][0], j, n))
            give[0][1] -= n
            need -= n
    return {"stay": stay, "transfers": transfers, "counts": counts, "moved_bytes": moved}


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _block_cuts(steps: list[tuple], target: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Blocks of about ``target`` bytes from (old, step, bytes), largest steps
    first within a shard: small steps share a block, a large one takes several.
    Returns (old, step, first block, blocks) and the number of blocks."""
    cuts, n, held, last = [], 0, 0, None
    for old, step, size in sorted(steps, key=lambda s: (s[0], -s[1])):
        parts = -(-size // target)
        if old != last or parts > 1 or held + size > target:
            first, held = n, 0 if parts == 1 else target
            n += max(parts, 1)
        cuts.append((old, step, first, max(parts, 1)))
        held, last = held + size, old
    return cuts, n


def lay_out(df: DataFrame, old_shard: Column, size: Column, order: list[Column], partitions: int | None = None,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The present layout: ``row`` (all columns), old, size, block (one file
    each) and at (position inside the file). Blocks are cut by bytes, from the
    bytes of each shard's size steps (1/64 of a power of two wide), so no block
    is much larger than ``block_bytes`` unless a row is, or rows that are equal
    in size and ``order`` are; the rows of a step that alone exceeds that are
    dealt to several blocks by their hash. ``partitions`` instead asks for
    about so many blocks."""
    spark = df.sparkSession
    names = [f"k{i}" for i in range(len(order))]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.coalesce(old_shard, F.lit(0)).cast("int").alias("old"),
                     size.alias("size"), *[k.alias(n) for n, k in zip(names, order)])
    rows = rows.withColumn("step", F.expr("cast(64 * length(bin(size)) + shiftright(64 * size, length(bin(size)) - 1) as long)"))
    steps = [tuple(r) for r in rows.groupBy("old", "step").agg(F.sum("size")).collect()]   # at most 4096 a shard
    total = sum(s[2] for s in steps)
    target = max(-(-total // partitions) if partitions else block_bytes, -(-total // MOST_BLOCKS), 1)
    cuts, n = _block_cuts(steps, target)
    cut = F.broadcast(spark.createDataFrame(cuts, "old int, step long, first int, parts int"))
    block = (F.col("first") + F.pmod(F.xxhash64(*names), F.col("parts"))).cast("int")
    laid = (rows.join(cut, ["old", "step"]).select("row", "old", "size", *names, block.alias("block")).repartitionById(max(n, 1), "block")
            .sortWithinPartitions("block", F.col("size").desc(), *names)
            .select("row", "old", "size", "block", F.monotonically_increasing_id().alias("id")))
    return written(laid.select("row", "old", "size", "block", F.col("id").bitwiseAND((1 << 33) - 1).alias("at")), "shard-blocks")


def plan(layout: DataFrame, shards: int) -> tuple[dict, DataFrame, DataFrame]:
    """The solution, the blocks (old, block, at0, before: rows of the shard
    before the block) and the intervals of each old shard's order (old, lo, hi,
    new, slot0). Only one row per shard and size class reaches the driver."""
    spark = layout.sparkSession
    per = written(layout.groupBy("old", "block", F.length(F.bin("size")).alias("class"))
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.min("at").alias("at0")), "shard-sizes")
    classes = [tuple(r) for r in per.groupBy("old", "class").agg(F.sum("n"), F.sum("bytes")).orderBy("old", "class").collect()]
    found = solve(classes, shards)
    earlier = Window.partitionBy("old").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    blocks = (per.groupBy("old", "block").agg(F.sum("n").alias("n"), F.min("at0").alias("at0"))
              .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    lines, filled = [], {}
    for old, n in found["stay"].items():
        if n:
            lines.append((old, 0, n, old, 0))
        filled[old] = n
    start = dict(found["stay"])
    for old, new, n in found["transfers"]:
        lo = start.get(old, 0)
        lines.append((old, lo, lo + n, new, filled.get(new, 0)))
        start[old], filled[new] = lo + n, filled.get(new, 0) + n
    return found, blocks, spark.createDataFrame(lines, "old int, lo long, hi long, new int, slot0 long")


def placed(layout: DataFrame, blocks: DataFrame, intervals: DataFrame) -> DataFrame:
    """Every row with its new shard and slot, read from the rows' order."""
    # at most (old shards + new shards) intervals, one row per old shard and block
    rows = (layout.join(F.broadcast(blocks.select("old", "block", "at0", "before")), ["old", "block"])
            .withColumn("rank", F.col("before") + F.col("at") - F.col("at0")))
    i = intervals.withColumnRenamed("old", "i_old")
    return (rows.join(F.broadcast(i), (F.col("old") == F.col("i_old")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
            .select("row", "old", "size", "block", F.col("new").alias("shard"), (F.col("rank") - F.col("lo") + F.col("slot0")).alias("slot")))


def reshard(layout: DataFrame, shards: int) -> tuple[dict, DataFrame]:
    """Solve and apply. Returns the solution and all rows in their new shards
    (row, old, size, block, shard, slot), read from the files: blocks that only
    hold rows which stay are read where they were, the others from their
    rewritten files."""
    spark = layout.sparkSession
    found, blocks, intervals = plan(layout, shards)
    kept = [(old, n) for old, n in found["stay"].items()]
    stay = spark.createDataFrame(kept, "old int, stay long")
    marked = written(blocks.join(F.broadcast(stay), "old", "left")
                     .withColumn("whole", F.col("before") + F.col("n") <= F.coalesce(F.col("stay"), F.lit(0))), "shard-plan")
    every = lambda whole: placed(layout.join(F.broadcast(marked.where(F.col("whole") == whole).select("old", "block")), ["old", "block"], "left_semi"),
                                 marked, intervals)
    path = shared_folder(spark, "shards")
    every(False).write.partitionBy("shard").option("compression", "zstd").parquet(path)
    moved = spark.read.schema(every(False).schema).parquet(path)
    return found, every(True).unionByName(moved)


def sharded_documents(spark: SparkSession, documents: DataFrame, shards: int = 24) -> DataFrame:
    """The documents, at first placed by their source, over ``shards`` shards."""
    old = F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(shards))
    layout = lay_out(documents, old, size_of(F.col("text")), [F.col("doc_id"), F.xxhash64("text")])
    _, rows = reshard(layout, shards)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "size",
                       F.crc32(F.coalesce(F.col("row.text"), F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                       F.col("old").alias("old_shard"))
