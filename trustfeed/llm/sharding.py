"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring. A row's key (doc_id with the CRC-32 of its text) hashes to
one of ``cells`` equal arcs of the ring, which belongs to the first virtual node clockwise. A shard is full at
``(1 + slack) * total bytes / shards``; a cell that its shard can't take continues clockwise to the next
shard with room, and to the emptiest one if none has room for it. So no shard exceeds the bound by more than one
cell, and a further shard moves few rows besides those it takes.

The walk round the ring needs only the bytes per cell: a histogram of fixed size (``cells`` rows, however
many documents there are). Cells are walked from the heaviest to the lightest, so the small ones fill the gaps. The
documents themselves are never moved whole: only (doc_id, size, crc, cell) is written and sorted within its cell,
and the place in the shard is the number of rows in the shard's earlier cells plus the place within the cell.

Edge cases: a null text has no bytes and counts as size 1, its CRC is 0; null doc_ids are spread by their text;
identical rows (same doc_id and text) share a cell and so a shard, with different slots, unless they are so many
that they fill a cell: then they are spread over all cells by their row number, so neither a task nor a shard takes them all; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustfeed.session import materialize

CELLS = 1 << 16
VNODES = 128
SLACK = 0.001
# A cell is heavy with more than HEAVY_ROWS rows and more than HEAVY_TIMES the mean cell's.
HEAVY_ROWS, HEAVY_TIMES = 64, 16


def ring_owners(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes in ring order; a shard's points don't depend on the other shards."""
    def place(s: int, v: int) -> int:
        return int.from_bytes(hashlib.sha256(f"{s}:{v}".encode()).digest()[:8], "big")
    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def place_cells(loads: list[tuple[int, int, int]], shards: int, cells: int = CELLS, vnodes: int = VNODES,
                slack: float = SLACK) -> list[tuple[int, int, int]]:
    """(cell, bytes, rows) -> (cell, shard, rows of the shard in earlier cells). At most ``cells`` entries."""
    nodes = ring_owners(shards, vnodes)
    points = [p for p, _ in nodes]
    limit = (1 + slack) * sum(b for _, b, _ in loads) / shards
    filled, homes = [0] * shards, {}
    for cell, size, _ in sorted(loads, key=lambda x: (-x[1], x[0])):
        at = bisect.bisect_left(points, (cell << 64) // cells)
        for step in range(len(nodes)):
            shard = nodes[(at + step) % len(nodes)][1]
            if filled[shard] + size <= limit:
                break
        else:
            shard = min(range(shards), key=lambda s: (filled[s], s))
        filled[shard] += size
        homes[cell] = shard
    before, out = [0] * shards, []
    for cell, _, rows in sorted(loads):
        out.append((cell, homes[cell], before[homes[cell]]))
        before[homes[cell]] += rows
    return out


def spread_heavy(rows: DataFrame, loads: list, cells: int) -> DataFrame:
    """Rows of cells with very many rows are dealt to all cells by their number.

    Different rows hash evenly, so such a cell holds repeated rows, which may go anywhere.
    """
    most = max(HEAVY_ROWS, HEAVY_TIMES * sum(n for _, _, n in loads) // cells)
    heavy = [cell for cell, _, n in loads if n > most]
    again = F.pmod(F.xxhash64("row_no", F.lit(1)), F.lit(cells)).cast("int")
    return rows.withColumn("cell", F.when(F.col("cell").isin(heavy), again).otherwise(F.col("cell"))) if heavy else rows


def shard_documents(docs: DataFrame, shards: int = 16, slack: float = SLACK, cells: int = CELLS,
                    vnodes: int = VNODES) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``bytes``)."""
    spark = docs.sparkSession
    body = F.col("text").cast("binary")
    crc = F.coalesce(F.crc32(body), F.lit(0)).cast("bigint")
    rows = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
                       crc.alias("text_crc32"))
    cell = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells)).cast("int")
    rows = materialize(rows.withColumns({"cell": cell, "row_no": F.monotonically_increasing_id()}), "ring-rows")

    def histogram(df):      # at most ``cells`` rows
        return [tuple(r) for r in df.groupBy("cell").agg(F.sum("size"), F.count(F.lit(1))).collect()]
    loads = histogram(rows)
    spread = spread_heavy(rows, loads, cells)
    if spread is not rows:
        rows, loads = spread, histogram(spread)
    plan = spark.createDataFrame(place_cells(loads, shards, cells, vnodes, slack), "cell int, shard int, base bigint")
    order = Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size", "row_no")
    placed = rows.withColumn("at", F.row_number().over(order)).join(F.broadcast(plan), "cell")
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         (F.col("base") + F.col("at") - 1).cast("bigint").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
