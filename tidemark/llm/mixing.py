"""Mixing overlapping sources to target weights by a min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A flow
routes token capacity from patterns to source quotas: every copy of a pattern's documents is
an arc of its own whose cost rises with the repetition, so no document is repeated while a
fresh one could serve, and no quota is missed that some routing can fill. Costs depend on
the repetition alone, so successive shortest paths are one maximum flow per repetition
level, each continuing the last. Then documents are selected: in a seeded order of each
pattern, whole documents are taken while they fit the routed tokens, and the one document
nearest to what is left closes the gap.

Only patterns (sets of sources, at most ``max_patterns``, else an error) and their token
sums come to the driver. Positions within a pattern are prefix sums over cells of a hash, two
levels of 1024, so that a pattern with most of the rows is never one task.

Null and empty membership is a pattern of its own that no quota reaches; a null source is a
source like any other, ordered last. Documents of size 0 or null are taken no times. Repeated rows are
documents of their own; ties in the seeded order go by row. A text is only measured, however long. Columns other
than the named and carried ones are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

CELLS = 10  # bits per level of the position cells


def water_filled(sizes: dict, weights: dict, total: float, cap: float) -> dict:
    """Share ``total`` by weight; a source stops at ``cap`` times its size, the excess is reshared."""
    targets, open_, rest = {}, [s for s in sizes], float(total)
    while open_:
        weight = sum(weights[s] for s in open_)
        full = [s for s in open_ if rest * weights[s] > cap * sizes[s] * weight]
        if not full:
            return targets | {s: rest * weights[s] / weight for s in open_}
        for s in full:
            targets[s] = float(cap * sizes[s])
            rest -= targets[s]
        open_ = [s for s in open_ if s not in targets]
    return targets


def route(capacity: dict, quotas: dict, levels: int) -> dict:
    """Tokens of the cheapest flow: {pattern: [{source: tokens} per repetition level]}.

    ``capacity`` maps a pattern (tuple of sources) to its tokens, ``quotas`` a source to its tokens.
    """
    flow = {p: dict.fromkeys((s for s in p if s in quotas), 0) for p in capacity}
    left = dict(quotas)
    sent = {p: [0] * levels for p in capacity}
    holders: dict = {s: [] for s in quotas}
    for p in flow:
        for s in flow[p]:
            holders[s].append(p)
    for level in range(levels):
        spare = dict(capacity)
        while True:
            seen, queue, end = {}, deque(), None
            for p in spare:
                if spare[p] > 0 and flow[p]:
                    seen["p", p] = None
                    queue.append(("p", p))
            while queue and end is None:
                kind, x = queue.popleft()
                if kind == "p":
                    step = [("s", s) for s in flow[x]]
                else:
                    if left[x] > 0:
                        end = (kind, x)
                        break
                    step = [("p", p) for p in holders[x] if flow[p][x] > 0]
                for y in step:
                    if y not in seen:
                        seen[y] = (kind, x)
                        queue.append(y)
            if end is None:
                break
            path = [end]
            while seen[path[-1]] is not None:
                path.append(seen[path[-1]])
            path.reverse()
            amount = min(spare[path[0][1]], left[end[1]])
            for (kind, x), (_, y) in zip(path, path[1:], strict=False):
                if kind == "s":
                    amount = min(amount, flow[y][x])
            for (kind, x), (_, y) in zip(path, path[1:], strict=False):
                if kind == "p":
                    flow[x][y] += amount
                else:
                    flow[y][x] -= amount
            first = path[0][1]
            spare[first] -= amount
            left[end[1]] -= amount
            sent[first][level] += amount
    routes = {}
    for p in capacity:
        rest = dict(flow[p])
        routes[p] = []
        for level in range(levels):
            part, room = {}, sent[p][level]
            for s in rest:
                own = min(room, rest[s])
                if own:
                    part[s] = own
                    rest[s] -= own
                    room -= own
            routes[p].append(part)
    return routes


def sized_documents(docs: DataFrame, id_column: str, size: Column, members: Column, seed: int,
                    carry: dict | None = None) -> DataFrame:
    """doc_id, size, sorted members and place in the seeded order, written once."""
    carried = [c.alias(name) for name, c in (carry or {}).items()]
    rows = docs.select(F.col(id_column).alias("doc_id"), size.cast("long").alias("size"),
                       F.array_sort(F.array_distinct(F.coalesce(members, F.array()))).alias("members"),
                       F.monotonically_increasing_id().alias("row"), *carried)
    place = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    cell = F.shiftrightunsigned(place, 64 - 2 * CELLS)
    return materialise(
        rows.withColumn("size", F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)))
        .withColumns({"place": place, "cell": F.shiftright(cell, CELLS).cast("int"),
                      "part": cell.bitwiseAND((1 << CELLS) - 1).cast("int")}), "sized")


def pattern_sizes(sized: DataFrame, max_patterns: int) -> dict:
    """Tokens of every membership pattern."""
    rows = sized.groupBy("members").agg(F.sum("size").alias("tokens")).limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns: merge sources or raise the bound")
    return {tuple(r["members"]): r["tokens"] for r in rows}


def positions(sized: DataFrame) -> DataFrame:
    """``end`` of each document in its pattern's seeded order, from three levels of prefix sums."""
    parts = sized.groupBy("members", "cell", "part").agg(F.sum("size").alias("tokens"))
    cells = parts.groupBy("members", "cell").agg(F.sum("tokens").alias("tokens"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    cell_base = cells.select("members", "cell", F.coalesce(F.sum("tokens").over(
        before.partitionBy("members").orderBy("cell")), F.lit(0)).alias("cell_base"))
    part_base = parts.select("members", "cell", "part", F.coalesce(F.sum("tokens").over(
        before.partitionBy("members", "cell").orderBy("part")), F.lit(0)).alias("part_base"))
    bases = (part_base.join(cell_base, ["members", "cell"])
             .select("members", "cell", "part", (F.col("cell_base") + F.col("part_base")).alias("base")))
    upto = Window.partitionBy("members", "cell", "part").orderBy("place", "row").rowsBetween(
        Window.unboundedPreceding, 0)
    return (sized.withColumn("within", F.sum("size").over(upto))
            .join(bases, ["members", "cell", "part"])
            .withColumn("end", F.col("base") + F.col("within"))
            .drop("base", "within", "cell", "part", "place"))


def select_documents(sized: DataFrame, routes: dict) -> DataFrame:
    """``copies`` of each document and ``assigned``, the source each copy is taken for."""
    spark = sized.sparkSession
    plan = []
    for pattern, levels in routes.items():
        spans, tops = [], []
        for level, part in enumerate(levels):
            at = 0
            for source, tokens in part.items():
                spans.append((level, at, at + tokens, source))
                at += tokens
            tops.append(at)
        plan.append((list(pattern), tops, spans))
    table = spark.createDataFrame(
        plan, "members array<string>, tops array<bigint>, "
        "spans array<struct<level:int,low:bigint,high:bigint,source:string>>")
    placed = materialise(positions(sized).join(F.broadcast(table), "members", "left"), "placed")
    # the one level that a pattern fills in part, and the gap its whole documents leave
    filled = placed.where("size > 0").select(
        "members", "size", "end", F.explode("tops").alias("top"))
    gaps = (filled.where("top > 0").groupBy("members", "top")
            .agg(F.max(F.when(F.col("end") <= F.col("top"), F.col("end"))).alias("last"),
                 F.max("end").alias("all"))
            .where("top < all")
            .select("members", "top", (F.col("top") - F.coalesce("last", F.lit(0))).alias("gap")))
    closing = (placed.where("size > 0").join(F.broadcast(gaps), "members").where("end > top")
               .groupBy("members", "top", "gap")
               .agg(F.min(F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), "row")).alias("best"))
               .where("best.off < gap").select(F.col("best.row").alias("row"), F.col("top").alias("closes")))
    rows = placed.join(closing, "row", "left")
    taken = lambda s: (F.col("end") <= F.element_at("tops", s["level"] + 1)) & (
        F.col("end") - F.col("size") >= s["low"]) & (F.col("end") - F.col("size") < s["high"])
    whole = F.transform(F.filter("spans", taken), lambda s: s["source"])
    last = F.transform(F.filter("spans", lambda s: s["high"] == F.col("closes")), lambda s: s["source"])
    assigned = F.when(F.col("size") > 0, F.concat(
        F.coalesce(whole, F.array().cast("array<string>")),
        F.when(F.col("closes").isNotNull(), F.slice(last, -1, 1)).otherwise(F.array().cast("array<string>")))) \
        .otherwise(F.array().cast("array<string>"))
    return rows.withColumn("assigned", assigned).withColumn("copies", F.size("assigned")) \
        .drop("tops", "spans", "closes", "end")


def mix_sources(docs: DataFrame, quotas, id_column: str = "doc_id", size: Column | None = None,
                members: Column | None = None, repeats: int = 2, seed: int = 11,
                max_patterns: int = 20_000, carry: dict | None = None) -> tuple[DataFrame, dict, dict]:
    """(documents with copies and assigned sources, tokens of each source, quota of each source).

    ``quotas`` maps {source: tokens} to {source: quota}. ``size`` defaults to the words of
    ``text``, ``members`` to the one ``source`` column.
    """
    size = size if size is not None else words_of("text")
    members = members if members is not None else F.array("source")
    sized = sized_documents(docs, id_column, size, members, seed, carry)
    capacity = pattern_sizes(sized, max_patterns)
    sizes: dict = {}
    for pattern, tokens in capacity.items():
        for source in pattern:
            sizes[source] = sizes.get(source, 0) + tokens
    wanted = quotas(sizes)
    routes = route(capacity, {s: int(q) for s, q in wanted.items()}, repeats)
    return select_documents(sized, routes), sizes, wanted


def words_of(text_column: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text_column), F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))


def cycled_weights(sizes: dict, cycle: tuple = (3, 1, 2), share: float = 1.5, cap: float = 2) -> dict:
    """Targets of sources that weigh ``cycle`` in code-point order, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: cycle[k % len(cycle)] for k, s in enumerate(order)}
    return water_filled(sizes, weights, share * sum(sizes.values()), cap)
