"""Best-fit packing into sequences of several permitted lengths.

Documents longer than the largest capacity are cut into pieces of it. Pieces are dealt to
shards by a hash; the number of shards follows the token total, so a shard is bounded
(about ``shard_tokens``) at any size. Within a shard pieces go longest first. A piece goes to the open
bin that it leaves the least room in, whatever the bin's capacity. If none has room, a bin
is opened with the capacity of least cost per token it can come to hold: the piece and as
many of the shorter pieces still to come as fit. At the end each bin shrinks to the smallest
permitted capacity that holds its contents.

A document without tokens (null or 0) gives one row without a bin. Rows that repeat an
identifier are packed one by one; equal lengths go in the order of their rows. Only the identifier is kept beside the lengths,
so other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

CAPACITIES = (512, 1024, 2048, 4096, 8192)


def sequence_cost(capacity: int) -> float:
    """A sequence costs its positions and, for attention, a part that grows with the square."""
    return capacity + capacity**2 / 32768


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...], cost=sequence_cost
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it) of each length, given in descending order, and final capacities."""
    n = len(lengths)
    ascending = lengths[::-1]
    total = np.concatenate(([0], np.cumsum(ascending)))
    after = total[::-1][1:]  # tokens of the pieces behind each one
    room: list[int] = []  # distinct amounts of room, ascending
    with_room: dict[int, list[int]] = {}
    held: list[int] = []
    opened: list[int] = []
    where, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    for k in range(n):
        length = int(lengths[k])
        at = bisect_left(room, length)
        if at < len(room):
            space = room[at]
            own = with_room[space].pop()
            if not with_room[space]:
                del with_room[space], room[at]
        else:
            best = None
            for c in capacities:
                if c >= length:
                    free = c - length
                    ahead = after[k] if free >= length else total[np.searchsorted(ascending, free, "right")]
                    price = cost(c) / (length + min(free, int(ahead)))
                    if best is None or price < best[0]:
                        best = (price, c)
            own, space = len(held), best[1]
            held.append(0)
            opened.append(space)
        where[k], offset[k] = own, held[own]
        held[own] += length
        space -= length
        if space:
            if space not in with_room:
                with_room[space] = []
                insort(room, space)
            with_room[space].append(own)
    final = np.array(capacities)[np.searchsorted(capacities, held)] if held else np.empty(0, np.int64)
    return where, offset, final


def pack(docs: DataFrame, length: Column, id_column: str = "doc_id",
         capacities: tuple[int, ...] = CAPACITIES, cost=sequence_cost,
         shard_tokens: int = 1_000_000, seed: int = 5) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin, bin_offset, capacity."""
    capacities = tuple(sorted(capacities))
    largest = capacities[-1]
    sized = materialise(docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(length.cast("long"), F.lit(0)).alias("total"),
        F.monotonically_increasing_id().alias("row")), "lengths")
    tokens = sized.agg(F.sum("total").alias("tokens")).first()["tokens"] or 0
    shards = max(1, -(-tokens // shard_tokens))
    pieces = (sized.where("total > 0")
              .select("doc_id", "row", "total", F.explode(F.sequence(
                  F.lit(0), F.expr(f"(total - 1) div {largest}").cast("int"))).alias("piece"))
              .withColumn("start", F.col("piece").cast("long") * largest)
              .withColumn("length", F.least(F.col("total") - F.col("start"), F.lit(largest)))
              .withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "row", "piece"), F.lit(shards)))
              .drop("total"))
    kind = docs.schema[id_column].dataType.simpleString()

    def pack_shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "row", "piece"], ascending=[False, True, True], kind="stable")
        where, offset, final = best_fit(part["length"].to_numpy(), capacities, cost)
        return pd.DataFrame({
            "doc_id": part["doc_id"], "piece": part["piece"], "start": part["start"],
            "length": part["length"], "bin": (part["shard"].to_numpy() << 32) + where,
            "bin_offset": offset, "capacity": final[where]})

    packed = pieces.groupBy("shard").applyInPandas(
        pack_shard, f"doc_id {kind}, piece int, start bigint, length bigint, bin bigint, "
        "bin_offset bigint, capacity bigint")
    nothing = sized.where("total <= 0").select(
        "doc_id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.lit(0).cast("long").alias("length"), F.lit(None).cast("long").alias("bin"),
        F.lit(None).cast("long").alias("bin_offset"), F.lit(None).cast("long").alias("capacity"))
    return packed.unionByName(nothing)
