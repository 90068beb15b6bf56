"""Resharding by minimum-cost flow.

Documents lie in ``old`` shards by a hash of their text, in a fixed number of blocks; equal texts share a
block. From the shards' sizes in bytes and the capacities of the new shards (as near to equal as whole
bytes allow, unless capacities are given) a minimum-cost flow says how many bytes go from which old shard to
which new one: a byte that stays costs nothing, a moved one costs 1, or what ``cost`` says. Each old shard's
blocks are then dealt along its row of the flow, largest first, each to where most bytes of the flow are still
open, so every transfer is met up to about a block, and only shards that gain or lose blocks are rewritten.

The driver holds sizes of blocks and shards only: at most ``blocks`` rows, and for blocks that are too
large for an even deal (a hot group of equal texts) the sizes of parts, as many as the block's share of all
bytes calls for: at most FINE + 8 for each shard, whatever the corpus. Rows are dealt to parts by their id, text and
place in the table (``rewrite``, which reads twice, by id and text alone). Documents are never gathered: a
document's slot is its part's offset within the shard plus its rank within the part, so windows run over
small parts, not over whole shards.

A null text has no bytes. Null ids and repeated rows are placed like others, each row in a slot of its
own. An empty table gives no rows. Extra columns are ignored; ``rewrite`` keeps them, but for one named shard.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, remove, saved, settled

ROW_BYTES, FINE, SUBS = 16, 64, 1 << 20
PLAN = "block int, sub int, old_shard int, shard int, first long"


def min_cost_flow(supply: list[int], room: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest flow[i][j] that ships all supplies into the rooms: successive shortest paths with potentials.
    sum(room) must not be below sum(supply)."""
    n, m = len(supply), len(room)
    source, sink = n + m, n + m + 1
    graph: list[list[list]] = [[] for _ in range(n + m + 2)]

    def edge(a: int, b: int, cap: int, c: int) -> None:
        graph[a].append([b, cap, c, len(graph[b])])
        graph[b].append([a, 0, -c, len(graph[a]) - 1])

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, cost[i][j])
    for j, r in enumerate(room):
        edge(n + j, sink, r, 0)
    potential = [0] * len(graph)
    left = sum(supply)
    while left:
        far, via = {source: 0}, {}
        heap, done = [(0, source)], set()
        while heap:
            d, a = heapq.heappop(heap)
            if a in done:
                continue
            done.add(a)
            for k, (b, cap, c, _) in enumerate(graph[a]):
                e = d + c + potential[a] - potential[b]
                if cap and e < far.get(b, 1 << 62):
                    far[b], via[b] = e, (a, k)
                    heapq.heappush(heap, (e, b))
        if sink not in far:
            raise ValueError("the rooms are too small")
        top = max(far.values())
        potential = [p + far.get(k, top) for k, p in enumerate(potential)]
        push, b = left, sink
        while b != source:
            a, k = via[b]
            push, b = min(push, graph[a][k][1]), a
        b = sink
        while b != source:
            a, k = via[b]
            graph[a][k][1] -= push
            graph[b][graph[a][k][3]][1] += push
            b = a
        left -= push
    flow = [[0] * m for _ in range(n)]
    for i in range(n):
        for b, cap, _, back in graph[i]:
            if n <= b < n + m:
                flow[i][b - n] = graph[b][back][1]
    return flow


def deal(parts: list[tuple[tuple[int, int], int, int]], flow: list[list[int]]) -> dict[tuple[int, int], int]:
    """Part -> new shard, from (part, old shard, bytes): along the flow from the part's old shard, largest part first, each
    to the shard to which most bytes are still to go; of equal ones to the old shard itself, then to the first."""
    place: dict[tuple[int, int], int] = {}
    to_go = [[(-size, int(i != j), j) for j, size in enumerate(row) if size] for i, row in enumerate(flow)]
    for heap in to_go:
        heapq.heapify(heap)
    for part, old, size in sorted(parts, key=lambda p: (-p[2], p[0])):
        open_bytes, away, j = to_go[old][0]
        place[part] = j
        heapq.heapreplace(to_go[old], (open_bytes + size, away, j))
    return place


def labels(id_col: str, text_col: str, blocks: int, *more: Column) -> tuple[Column, Column]:
    """A row's block, and what deals it to a part if the block is hot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sub = F.xxhash64(F.lit(3), F.col(id_col), F.col(text_col), *more)
    return F.pmod(F.xxhash64(text), F.lit(blocks)).cast("int"), F.pmod(sub, F.lit(SUBS)).cast("int")


def sized(docs: DataFrame, id_col: str, text_col: str, blocks: int) -> DataFrame:
    """(doc_id, size, text_crc32, block, sub), to be written before it is used: the place of a row depends on the read."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    block, sub = labels(id_col, text_col, blocks, F.monotonically_increasing_id())
    return docs.select(F.col(id_col).alias("doc_id"), size_of(text_col).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), block.alias("block"), sub.alias("sub"))


def size_of(text_col: str) -> Column:
    return (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + ROW_BYTES).cast("long")


def in_parts(rows: DataFrame, hot: dict[int, int], block: str = "block", sub: str = "sub") -> DataFrame:
    """rows with their part within the block: 0, but for hot blocks, which are dealt to as many parts as ``hot`` says."""
    count = F.lit(1)
    if hot:  # at most 8 * shards entries
        table = F.create_map(*(F.lit(x) for pair in hot.items() for x in pair))
        count = F.coalesce(F.try_element_at(table, F.col(block)), F.lit(1))
    return rows.withColumn(sub, F.pmod(F.col(sub), count))


def plan(sizes: DataFrame, shards: int, old: int, room: list[int] | None = None, cost: list[list[int]] | None = None) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int], list[list[int]]]:
    """((block, part, old shard, new shard, first slot) rows, hot blocks with their number of parts, the flow)."""
    sums = [F.sum("size").alias("bytes"), F.count("*").alias("n")]
    stats = sizes.groupBy("block").agg(*sums).collect()  # at most as many rows as blocks
    total = sum(r["bytes"] for r in stats)
    hot = {r["block"]: -(-r["bytes"] * shards * FINE // total) for r in stats if r["bytes"] * 8 * shards > total}
    parts = [((r["block"], 0), r["block"] % old, r["bytes"], r["n"]) for r in stats if r["block"] not in hot]
    if hot:
        split = in_parts(sizes.where(F.col("block").isin(list(hot))), hot).groupBy("block", "sub").agg(*sums).collect()
        parts += [((r["block"], r["sub"]), r["block"] % old, r["bytes"], r["n"]) for r in split]
    room = room or [total // shards + (j < total % shards) for j in range(shards)]
    supply = [0] * old
    for _, i, size, _ in parts:
        supply[i] += size
    flow = min_cost_flow(supply, room, cost or [[int(i != j) for j in range(shards)] for i in range(old)])
    place = deal([p[:3] for p in parts], flow)
    slots: dict[int, int] = defaultdict(int)
    out = []
    for part, i, _, n in sorted(parts):
        out.append((*part, i, place[part], slots[place[part]]))
        slots[place[part]] += n
    return out, hot, flow


def reshard(docs: DataFrame, shards: int = 40, old: int = 32, blocks: int = 8192, id_col: str = "doc_id", text_col: str = "text", room: list[int] | None = None, cost: list[list[int]] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, old_shard, shard, slot, grown_shard."""
    sizes = settled(sized(docs, id_col, text_col, blocks), "sizes")
    moves, hot, _ = plan(sizes, shards, old, room, cost)
    # The plan has at most blocks + (FINE + 8) * shards rows, whatever the corpus.
    joined = in_parts(sizes, hot).join(F.broadcast(docs.sparkSession.createDataFrame(moves, PLAN)), ["block", "sub"])
    within = Window.partitionBy("block", "sub").orderBy("doc_id", "text_crc32", "size")
    return joined.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.row_number().over(within) - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


def lay_out(docs: DataFrame, path: str, old: int = 32, blocks: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the old layout below ``path``, as shard=N folders."""
    block, _ = labels(id_col, text_col, blocks)
    docs.withColumn("shard", (block % old).cast("int")).write.partitionBy("shard").parquet(path)


def rewrite(docs: DataFrame, path: str, shards: int = 40, old: int = 32, blocks: int = 8192, id_col: str = "doc_id", text_col: str = "text", room: list[int] | None = None) -> list[int]:
    """Turn the old layout below ``path`` (that of ``lay_out``) into the new one and return the numbers of the shards that
    were written. Only shards that gain or lose blocks are: the rows of blocks in them are first saved in the shared folder,
    so ``docs`` may be read from ``path`` itself; other shards' files stay as they are, and shards that are empty now go."""
    spark = docs.sparkSession
    block, sub, size = fresh(docs.columns, "_block", "_sub", "_size")
    of = labels(id_col, text_col, blocks)
    keyed = docs.withColumns({block: of[0], sub: of[1], size: size_of(text_col)})
    stats = settled(keyed.select(F.col(block).alias("block"), F.col(sub).alias("sub"), F.col(size).alias("size")), "sizes")
    moves, hot, _ = plan(stats, shards, old, room)
    moved = [(i, j) for _, _, i, j, _ in moves if i != j]
    touched = {i for i, _ in moved} | {j for _, j in moved}
    if not touched:
        return []
    full = sorted({j for _, _, _, j, _ in moves if j in touched})
    table = spark.createDataFrame(moves, PLAN).where(F.col("shard").isin(full)).select(F.col("block").alias(block), F.col("sub").alias(sub), "shard")
    placed = in_parts(keyed.drop("shard"), hot, block, sub).join(F.broadcast(table), [block, sub]).drop(block, sub, size)
    saved(placed, "reshard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    for j in touched - set(full):
        remove(spark, f"{path}/shard={j}")
    return full


def digest(placed: DataFrame) -> DataFrame:
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
