"""Resharding by minimum-cost flow.

Old shards and new capacities meet on the driver as two short lists of byte counts,
never as rows: the flow says how many bytes each old shard hands to each new one at
the least total of moved bytes. Each old shard is then cut along its running byte
count into one run of documents per receiver. Stored rows carry their place in that
count from the task that wrote them, so the files are written again straight from the
old ones: no text is shuffled.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from lexlake.llm.common import fresh, map_texts, running, text_of
from lexlake.workspace import materialize, new_dir

#: A document over 1/BIG of a shard's share is placed by itself; there are at most BIG x shards such.
BIG = 64
#: Of shard files; they hold all text twice, before and after.
CODEC = "zstd"


def min_cost_flow(supply: dict[int, int], capacity: dict[int, int], cost) -> dict[tuple[int, int], int]:
    """Bytes from each supplier to each receiver, all supply placed, at the least cost.

    Successive shortest paths with potentials; the totals must be equal.
    """
    src, dst = ("s", 0), ("t", 0)
    edges: dict = {}

    def add(u, v, cap, c):
        edges.setdefault(u, {})[v] = [cap, c]
        edges.setdefault(v, {})[u] = [0, -c]

    for i, n in supply.items():
        add(src, ("o", i), n, 0)
        for j in capacity:
            add(("o", i), ("n", j), n, cost(i, j))
    for j, n in capacity.items():
        add(("n", j), dst, n, 0)
    left = sum(supply.values())
    price = dict.fromkeys(edges, 0)
    while left > 0:
        far, came, heap = {src: 0}, {}, [(0, src)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for v, (cap, c) in edges[u].items():
                e = d + c + price[u] - price[v]
                if cap > 0 and e < far.get(v, float("inf")):
                    far[v], came[v] = e, u
                    heapq.heappush(heap, (e, v))
        if dst not in far:
            raise ValueError("the capacities do not hold the supply")
        for u in price:
            price[u] += far.get(u, far[dst])
        path, v = [], dst
        while v != src:
            path.append((came[v], v))
            v = came[v]
        push = min(left, *(edges[u][v][0] for u, v in path))
        for u, v in path:
            edges[u][v][0] -= push
            edges[v][u][0] += push
        left -= push
    return {(i, j): n for i in supply for j in capacity if (n := edges[("n", j)][("o", i)][0]) > 0}


def place_big(big: list[tuple], room: list[int]) -> list[int]:
    """A shard for each (old, bytes): its own while that has room, else the emptiest. Lowers ``room``."""
    out = []
    for old, size in big:
        j = old if old < len(room) and room[old] >= size else max(range(len(room)), key=lambda k: room[k])
        room[j] -= size
        out.append(j)
    return out


def level(room: list[int], total: int) -> list[int]:
    """Share ``total`` out so that what is left of each room is as equal as can be."""
    order = sorted(range(len(room)), key=lambda j: -room[j])
    share, n, used = [0] * len(room), 0, 0
    for n in range(1, len(order) + 1):  # noqa: B007  the n emptiest take part
        used += room[order[n - 1]]
        if n == len(order) or used - n * room[order[n]] >= total:
            break
    rest = total
    for k, j in enumerate(order[:n]):
        share[j] = max(0, room[j] - (used - total) // n) if k < n - 1 else rest
        share[j] = min(share[j], rest)
        rest -= share[j]
    return share


def flow_cuts(supply: dict[int, int], share: list[int], shards: int) -> dict[int, list[tuple[int, int]]]:
    """For each old shard, (bytes up to which, new shard): its own first, then the others it hands some to."""
    flow = min_cost_flow(supply, dict(enumerate(share)), lambda i, j: int(i != j))
    out: dict[int, list[tuple[int, int]]] = {}
    for i in sorted(supply):
        at, ends = 0, []
        for j in sorted((j for k, j in flow if k == i), key=lambda j: (j != i, j)):
            at += flow[i, j]
            ends.append((at, j))
        out[i] = ends or [(0, i % shards)]
    return out


def reshard(docs: DataFrame, old_shard, shards: int, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Put every document into one of ``shards`` shards of near equal bytes, moving the
    fewest bytes from the old ones.

    ``old_shard`` is a column giving the present shard, a number of a small range.
    Returns id, size (UTF-8 bytes of the text plus 8), text_crc32, old_shard, shard and
    slot, which counts gaplessly from 0 in each shard. Rows that repeat id and text
    count each by itself but lie together if they are big. A null id or text is a value
    like others; an empty table gives an empty result. ``carry`` names columns of
    ``docs`` to return as well.
    """
    rows = materialize(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text_of(text_col)) + 8).cast("long").alias("size"),
            F.crc32(text_of(text_col)).alias("crc"),
            F.coalesce(old_shard.cast("int"), F.lit(0)).alias("old"),
            *carry,
        ),
        "reshard-sizes",
    )
    sizes = {r["old"]: r["n"] for r in rows.groupBy("old").agg(F.sum("size").alias("n")).collect()}
    total = sum(sizes.values())
    room = [total // shards + (j < total % shards) for j in range(shards)]
    least = total // (shards * BIG) + 1
    same = ["id", "crc", "old"]
    blocks = rows.groupBy(*same, "size").agg((F.count("*") * F.col("size")).alias("n"), F.count("*").alias("c"))
    big = sorted(blocks.where((F.col("size") >= least)).drop("c").collect(), key=lambda r: (-r["n"], r["old"], r["crc"], str(r["id"])))
    homes = place_big([(r["old"], r["n"]) for r in big], room)
    supply = dict(sizes)
    for r in big:
        supply[r["old"]] -= r["n"]
    share = level(room, sum(supply.values()))
    cuts = [(i, upto, j) for i, ends in flow_cuts(supply, share, shards).items() for upto, j in ends]
    spark = docs.sparkSession
    table = spark.createDataFrame(cuts, "old int, upto long, shard int")
    # at most old x new rows
    table = table.groupBy("old").agg(F.sort_array(F.collect_list(F.struct("upto", "shard"))).alias("cuts"))
    kind = rows.schema["id"].dataType.simpleString()
    placed = spark.createDataFrame([(r["id"], r["crc"], r["old"], j) for r, j in zip(big, homes, strict=True)], f"id {kind}, crc long, old int, shard int")
    alike = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.crc") == F.col("r.crc")) & (F.col("l.old") == F.col("r.old"))
    large = rows.where(F.col("size") >= least).alias("l").join(F.broadcast(placed).alias("r"), alike).select("l.*", "r.shard")
    small = running(rows.where(F.col("size") < least), ["old"], ["id", "crc"], "size", "at")
    middle = F.col("at") + F.col("size") / 2
    small = small.join(F.broadcast(table), "old")
    fit = F.filter("cuts", lambda c: middle < c["upto"])
    small = small.withColumn("shard", F.coalesce(F.try_element_at(fit, F.lit(1)), F.element_at("cuts", -1))["shard"])
    done = numbered(large.unionByName(small.select(*large.columns)))
    return done.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("old").alias("old_shard"), "shard", "slot", *carry)


def numbered(rows: DataFrame) -> DataFrame:
    """Add slot, the place of each row (id, crc, shard) in its shard."""
    return running(rows.withColumn("__one", F.lit(1)), ["shard"], ["id", "crc"], "__one", "slot").drop("__one")


#: Columns a stored table has beside its own: shard, task that wrote the row, bytes of that
#: task and shard in front of it, and its own bytes.
NAMES = ("__shard", "__task", "__at", "__size")


def store(docs: DataFrame, old_shard, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """Write ``docs`` as a table of shards, one folder each, and read it back: all columns
    and four more, whose names (``NAMES``, or others if those are taken) are returned."""
    names = fresh(docs.columns, *NAMES)
    shard, task, at, size = names
    rows = docs.withColumns({shard: F.coalesce(old_shard.cast("int"), F.lit(0)), size: (F.octet_length(text_of(f"`{text_col}`")) + 8).cast("long")})
    schema = StructType([*rows.schema.fields, StructField(task, IntegerType()), StructField(at, LongType())])

    def make():
        number, seen = TaskContext.get().partitionId(), defaultdict(int)

        def apply(cols):
            of, sizes = cols[shard].to_numpy(), cols[size].to_numpy()
            before = np.zeros(len(of), dtype=np.int64)
            for k in np.unique(of):
                mine = of == k
                ends = np.cumsum(sizes[mine])
                before[mine] = seen[k] + ends - sizes[mine]
                seen[k] += int(ends[-1])
            return cols | {task: pa.array([number] * len(of), pa.int32()), at: pa.array(before)}

        return apply

    path = new_dir(docs.sparkSession, "shards")
    map_texts(rows, make, schema).write.partitionBy(shard).option("compression", CODEC).parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path), names


def reshard_stored(docs: DataFrame, old_shard, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store ``docs`` in its old shards, reshard it and write the affected shards again.

    Returns what ``reshard`` does, read from the shard files as they then are: the
    rewritten ones and those that no document left or joined.
    """
    stored, names = store(docs, old_shard, text_col)
    shard, old, new = names[0], *fresh([*stored.columns], "__old", "__new")
    path, affected = rewrite(planned(stored, names, shards, new), new, id_col, shard, old_col=old)
    kept = stored.where(~F.col(shard).isin(affected)).withColumn(old, F.col(shard))
    again = docs.sparkSession.read.schema(kept.schema).parquet(path)
    text = text_of(f"`{text_col}`")
    now = kept.unionByName(again).select(
        F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("crc"), F.col(old).alias("old"), F.col(shard).alias("shard")
    )
    done = numbered(materialize(now, "reshard-digests"))
    return done.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("old").alias("old_shard"), "shard", "slot")


def planned(stored: DataFrame, names: list[str], shards: int, new: str) -> DataFrame:
    """``stored`` with column ``new``: the shard each row goes to.

    Big documents (over 1/BIG of a share) find a home first, one by one; each that does
    not stay moves at most its own bytes more than a flow that could split it. The rest
    is cut where the flow says, at its running byte count, a document going where its
    middle lies: so each cut is off by at most half a document. What is broadcast is
    one row for each old shard and task that wrote some of it, and the big documents,
    at most BIG times the shards.
    """
    spark = stored.sparkSession
    shard, task, at, size = names
    sizes = stored.select(F.col(shard).alias("old"), F.col(task).alias("task"), F.col(at).alias("at"), F.col(size).alias("size"))
    pieces = materialize(sizes.groupBy("old", "task").agg(F.sum("size").alias("n")), "reshard-pieces")
    supply = {r["old"]: r["n"] for r in pieces.groupBy("old").agg(F.sum("n").alias("n")).collect()}
    total = sum(supply.values())
    room = [total // shards + (j < total % shards) for j in range(shards)]
    least = total // (shards * BIG) + 1
    big = sorted(sizes.where(F.col("size") >= least).collect(), key=lambda r: (-r["size"], r["old"], r["task"], r["at"]))
    homes = place_big([(r["old"], r["size"]) for r in big], room)
    placed = defaultdict(list)
    for r, j in zip(big, homes, strict=True):
        supply[r["old"]] -= r["size"]
        placed[r["old"], r["task"]].append((r["at"], r["size"], j))
    cuts = flow_cuts(supply, level(room, sum(supply.values())), shards)
    entry = "array<struct<at:long,size:long,shard:int>>"
    bigs = spark.createDataFrame([(*k, v) for k, v in placed.items()], f"old int, task int, bigs {entry}")
    ends = spark.createDataFrame([(i, c) for i, c in cuts.items()], "old int, cuts array<struct<upto:long,shard:int>>")
    plan = pieces.join(F.broadcast(bigs), ["old", "task"], "left").withColumn("bigs", F.coalesce("bigs", F.array().cast(entry)))
    small = F.col("n") - F.aggregate("bigs", F.lit(0).cast("long"), lambda a, b: a + b["size"])
    before = Window.partitionBy("old").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    plan = plan.withColumn("base", F.coalesce(F.sum(small).over(before), F.lit(0)).cast("long"))
    joined = {c: f"{c}{new}" for c in ("old", "task", "base", "bigs", "cuts")}
    plan = plan.select(*(F.col(c).alias(joined[c]) for c in ("old", "task", "base", "bigs")))
    ends = ends.select(*(F.col(c).alias(joined[c]) for c in ("old", "cuts")))
    o, t, base, big_ones, upto = (F.col(joined[c]) for c in ("old", "task", "base", "bigs", "cuts"))
    place, bytes_ = F.col(f"`{at}`"), F.col(f"`{size}`")
    met = stored.join(F.broadcast(plan), (F.col(f"`{shard}`") == o) & (F.col(f"`{task}`") == t)).drop(joined["old"], joined["task"])
    met = met.join(F.broadcast(ends), F.col(f"`{shard}`") == o).drop(joined["old"])
    skipped = F.aggregate(F.filter(big_ones, lambda b: b["at"] < place), F.lit(0).cast("long"), lambda a, b: a + b["size"])
    middle = base + place - skipped + bytes_ / 2
    home = F.try_element_at(F.filter(big_ones, lambda b: b["at"] == place), F.lit(1))["shard"]
    fit = F.coalesce(F.try_element_at(F.filter(upto, lambda c: middle < c["upto"]), F.lit(1)), F.element_at(upto, -1))["shard"]
    return met.withColumn(new, F.coalesce(home, fit)).drop(joined["base"], joined["bigs"], joined["cuts"])


def rewrite(stored: DataFrame, moves: DataFrame | str, id_col: str = "doc_id", shard_col: str = "shard", old_col: str | None = None) -> tuple[str, list[int]]:
    """Write again the shards of a stored table that lose or gain a document.

    ``stored`` holds rows with their present shard. ``moves`` names a column with each
    row's new shard, which is not written itself; or it is a table of id, old_shard and shard,
    where ids must be unique in a shard, a null one is a value like others, and a row
    without a move stays. ``old_col`` names a column to add with the shard a row came
    from. Returns the folder with the new files (one subfolder per affected shard) and
    the affected shards; files of other shards stay as they are.
    """
    now = F.col(f"`{shard_col}`")
    by_column = isinstance(moves, str)
    moved = stored.select(now.alias("old_shard"), F.col(f"`{moves}`").alias("shard")) if by_column else moves
    touched = moved.where("old_shard <> shard").select("old_shard", "shard").distinct()
    affected = sorted(r["s"] for r in touched.select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct().collect())
    path = new_dir(stored.sparkSession, "reshard")
    rows, target, given = stored.where(now.isin(affected)), moves, []
    if not by_column:
        given = fresh(rows.columns, "__id", "__from", "__new")
        new = moves.select(*(F.col(c).alias(g) for c, g in zip((id_col, "old_shard", "shard"), given, strict=True)))
        rows = rows.join(new, F.col(f"`{id_col}`").eqNullSafe(F.col(given[0])) & (now == F.col(given[1])), "left")
        target = given[2]
    if old_col:
        rows = rows.withColumn(old_col, now)
    rows = rows.withColumn(shard_col, F.coalesce(F.col(target), now)).drop(target, *given)
    # written where they are read: to gather a shard's rows first would send all text through a shuffle
    rows.write.partitionBy(shard_col).option("compression", CODEC).parquet(path)
    return path, affected
