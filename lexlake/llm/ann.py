"""Approximate nearest neighbours: a forest of random-projection trees, one queue, exact reranking.

Each tree splits space along a few orthonormal random directions, at the medians of a
bounded sample. A query walks all trees through one priority queue: whichever branch of
whichever tree lies nearest goes first, until the leaves taken hold a stated share of
the rows. Queries then meet the rows of their leaves in blocks, where every inner
product is worked out exactly and the best ones go on.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lexlake.llm.vectors import digest, finite, length
from lexlake.workspace import materialize

#: Vectors, and numbers in them, that the trees are fitted on at most; trees; splits on the way to a leaf.
SAMPLE, SAMPLE_ENTRIES, TREES, DEPTH = 20_000, 2_000_000, 2, 6
#: Share of the rows, summed over the trees, that the leaves of one query hold, and the least number of rows.
SHARE, LEAST = 1.0, 2000
#: Rows and queries in a block; blocks of either kind in a cell.
BLOCK, ASKED, CELL = 2048, 512, 32


class Forest:
    """Trees with one direction a level and a threshold a node.

    ``top`` is the largest length of a vector: with sqrt(top^2 - |x|^2) as one more
    coordinate, the row with the largest inner product is the nearest one.
    """

    def __init__(self, sample: np.ndarray, top: float, trees: int = TREES, depth: int = DEPTH, seed: int = 29):
        rng = np.random.default_rng(seed)
        points = self.lift(sample, top)
        dims = points.shape[1]
        depth = min(depth, dims)
        self.top, self.trees, self.depth = top, trees, depth
        self.axes = [np.linalg.qr(rng.normal(size=(dims, depth)))[0] for _ in range(trees)]
        self.cuts: list[list[np.ndarray]] = []
        self.weight = np.zeros((trees, 1 << depth))
        for t, axes in enumerate(self.axes):
            seen, node, levels = points @ axes, np.zeros(len(points), dtype=np.int64), []
            for level in range(depth):
                cut = np.zeros(1 << level)
                for k in np.unique(node):
                    cut[k] = np.median(seen[node == k, level])
                levels.append(cut)
                node = 2 * node + (seen[:, level] > cut[node])
            self.cuts.append(levels)
            self.weight[t] = np.bincount(node, minlength=1 << depth)
        self.fitted = len(points)

    @staticmethod
    def lift(x: np.ndarray, top: float) -> np.ndarray:
        x = np.asarray(x, dtype=np.float64)
        rest = np.sqrt(np.maximum(top * top - np.einsum("ij,ij->i", x, x), 0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        points = self.lift(x, self.top)
        out = np.zeros((len(points), self.trees), dtype=np.int64)
        for t in range(self.trees):
            seen, node = points @ self.axes[t], np.zeros(len(points), dtype=np.int64)
            for level in range(self.depth):
                node = 2 * node + (seen[:, level] > self.cuts[t][level][node])
            out[:, t] = node
        return out

    def search(self, queries: np.ndarray, share: float) -> list[list[tuple[int, int]]]:
        """For each query the (tree, leaf) pairs to look into, nearest first: one queue
        over all trees, by the squared distance to the splits that part it from a branch."""
        q = np.asarray(queries, dtype=np.float64)
        long = np.sqrt(np.einsum("ij,ij->i", q, q))
        # only the direction of a query matters: put it on the sphere the rows lie on
        points = np.concatenate([q * (self.top / np.maximum(long, 1e-300))[:, None], np.zeros((len(q), 1))], axis=1)
        seen = [points @ axes for axes in self.axes]
        enough = max(share * self.fitted, LEAST)
        out = []
        for i in range(len(q)):
            at = [s[i].tolist() for s in seen]
            queue = [(0.0, t, 0, 0) for t in range(self.trees)]
            got, found = 0.0, []
            while queue and got < enough:
                far, t, level, node = heapq.heappop(queue)
                while level < self.depth:
                    margin = at[t][level] - self.cuts[t][level][node]
                    near = 2 * node + (margin > 0)
                    heapq.heappush(queue, (far + margin * margin, t, level + 1, near ^ 1))
                    level, node = level + 1, near
                found.append((t, int(node)))
                got += self.weight[t][node]
            out.append(found)
        return out

    def asked_leaves(self, found: list[list[tuple[int, int]]]) -> np.ndarray:
        """One row for each query: which (tree, leaf) pairs it looks into."""
        out = np.zeros((len(found), self.trees, 1 << self.depth), dtype=bool)
        for i, pairs in enumerate(found):
            for t, leaf in pairs:
                out[i, t, leaf] = True
        return out


class Bound:
    """A score that a query's result surely reaches, from the fitted sample's own vectors.

    Of the sample, the vectors in the leaves of a query are among its candidates; the
    score of the ``keep``-th best of them is a floor under which nothing need go on.
    """

    def __init__(self, forest: Forest, sample: np.ndarray, keep: int):
        self.forest, self.sample, self.keep = forest, sample, keep
        self.home = forest.leaves(sample)

    def __call__(self, queries: np.ndarray, found: list[list[tuple[int, int]]]) -> np.ndarray:
        out = np.full(len(queries), -np.inf)
        if len(self.sample) < self.keep:
            return out
        sample = self.sample.astype(np.float64)
        for lo in range(0, len(queries), 256):
            part = slice(lo, lo + 256)
            asked = self.forest.asked_leaves(found[part])
            seen = np.zeros((len(asked), len(sample)), dtype=bool)
            for t in range(self.forest.trees):
                seen |= asked[:, t][:, self.home[:, t]]
            scores = np.where(seen, queries[part].astype(np.float64) @ sample.T, -np.inf)
            out[part] = np.partition(scores, -self.keep, axis=1)[:, -self.keep]
        # sums in another order may differ in the last digits
        return out - 1e-9 * (np.abs(np.where(np.isfinite(out), out, 0)) + 1e-300)


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def mapped(rows: DataFrame, run, schema: str) -> DataFrame:
    """mapInArrow where ``run`` turns a batch into columns."""
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            if batch.num_rows:
                out = run(batch)
                yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(out, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(batches, kind)


def distinct_vectors(rows: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """(key, vec, ids) of each distinct vector, ids being its ``keep`` smallest, and all (key, id).

    Nobody's nearest ones reach further into a group of copies, so however many rows
    are alike, ``keep`` of them stand for the group.
    """
    keyed = rows.withColumn("key", digest("vec"))
    pairs = materialize(keyed.groupBy("key", "id").agg(F.first("vec").alias("vec")), "ann-rows")
    smallest = pairs.withColumn("__n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("__n") <= keep)
    groups = smallest.groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("id")).alias("ids"))
    return materialize(groups, "ann-vectors"), pairs


def in_blocks(rows: DataFrame, entry: Column, size: int, name: str) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """(tree, leaf, name): the rows of each leaf in lists of about ``size``, and how many lists each has."""
    counts = rows.groupBy("tree", "leaf").count().collect()  # one line for each leaf of the forest
    lists = {(r["tree"], r["leaf"]): -(-r["count"] // size) for r in counts}
    plan = rows.sparkSession.createDataFrame([(t, k, n) for (t, k), n in lists.items()], "tree int, leaf int, lists int")
    dealt = rows.join(F.broadcast(plan), ["tree", "leaf"]).withColumn("block", F.pmod(F.xxhash64("key"), F.col("lists")).cast("int"))
    return dealt.groupBy("tree", "leaf", "block").agg(F.collect_list(entry).alias(name)), lists


def top_in_block(dims: int, keep: int):
    """For each (rows, queries) pair of blocks, each query's ``keep`` best rows above its floor."""

    def run(batch: pa.RecordBatch) -> list:
        out: list[list] = [[], [], [], []]
        for i in range(batch.num_rows):
            rows, asked = batch.column(0).slice(i, 1).flatten(), batch.column(1).slice(i, 1).flatten()
            r_key, r_id, r_vec = (rows.field(k) for k in range(3))
            q_key, q_floor, q_vec = (asked.field(k) for k in range(3))
            scores = matrix(q_vec, dims).astype(np.float64) @ matrix(r_vec, dims).astype(np.float64).T
            floor = q_floor.to_numpy()
            if scores.shape[1] > keep:
                floor = np.maximum(floor, np.partition(scores, -keep, axis=1)[:, -keep])
            q, r = np.nonzero(scores >= floor[:, None])
            s, ids = scores[q, r], r_id.to_numpy()[r]
            order = np.lexsort((ids, -s, q))
            q, r, s = q[order], r[order], s[order]
            # a floor may be shared by many; of equal scores the smaller ids stay
            first = np.searchsorted(q, q)
            stay = np.arange(len(q)) - first < keep
            q, r, s = q[stay], r[stay], s[stay]
            out[0].append(q_key.take(pa.array(q)))
            out[1].append(r_key.take(pa.array(r)))
            out[2].append(r_id.take(pa.array(r)))
            out[3].append(pa.array(s))
        return [pa.concat_arrays(c) for c in out]

    return run


def nearest(
    rows: DataFrame,
    asks: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 20,
    share: float = SHARE,
    trees: int = TREES,
    depth: int = DEPTH,
    sample: int = SAMPLE,
    seed: int = 29,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row for which ``asks`` holds (a condition on
    column ``id``), the ``k`` rows found with the largest inner product, itself left out.

    Nearest first, equal scores by the smaller id. Rows without an id, and vectors that
    are null, empty, all zero, hold a null or an entry not finite, or have another
    length than the commonest, take no part. Rows alike in id and vector are one; rows
    that share an id but not the vector are rows of their own. Copies of a vector are
    searched once and each named. A table of no such rows gives an empty result.

    The trees are fitted on at most ``sample`` vectors (fewer if wide); every row is
    indexed. The share of rows a query looks at decides how many of the true ones it
    finds; ``LEAST`` rows are looked at in any case.
    """
    spark, keep = rows.sparkSession, k + 1
    found, dims = finite(rows, id_col, vec_col)
    found = found.where(F.col("id").isNotNull() & F.exists("vec", lambda e: e != 0)).select(F.col("id").cast("long").alias("id"), "vec")
    result = "query_id long, rank int, vec_id long, score double"
    if not dims:
        return spark.createDataFrame([], result)
    groups, pairs = distinct_vectors(found, keep)
    fitted = min(sample, max(1, SAMPLE_ENTRIES // dims))
    picked = groups.select("key", "vec").orderBy("key").limit(fitted).collect()  # at most SAMPLE_ENTRIES numbers
    if not picked:
        return spark.createDataFrame([], result)
    kind = np.float32 if groups.schema["vec"].dataType.elementType.typeName() == "float" else np.float64
    points = np.array([r["vec"] for r in picked], dtype=kind)
    top = groups.agg(F.max(length("vec"))).first()[0]
    forest = Forest(points, top, trees, depth, seed)
    floor = Bound(forest, points, keep)
    vec = "array<float>" if kind == np.float32 else "array<double>"

    def index(batch: pa.RecordBatch) -> list:
        x, n = matrix(batch.column(1), dims), batch.num_rows
        again = pa.array(np.repeat(np.arange(n), forest.trees))
        home = forest.leaves(x).ravel().astype(np.int32)
        first = pa.array([v[0] for v in batch.column(2).to_pylist()], pa.int64())
        return [batch.column(0).take(again), first.take(again), batch.column(1).take(again), np.tile(np.arange(forest.trees, dtype=np.int32), n), home]

    def search(batch: pa.RecordBatch) -> list:
        q = matrix(batch.column(1), dims)
        pairs = forest.search(q, share)
        again = pa.array(np.repeat(np.arange(len(q)), [len(p) for p in pairs]))
        flat = np.array([p for one in pairs for p in one], dtype=np.int32).reshape(-1, 2)
        return [batch.column(0).take(again), pa.array(floor(q, pairs)).take(again), batch.column(1).take(again), flat[:, 0].copy(), flat[:, 1].copy()]

    indexed = materialize(mapped(groups.select("key", "vec", "ids"), index, f"key binary, first long, vec {vec}, tree int, leaf int"), "ann-index")
    queries = pairs.where(asks).select("id", "key")
    asked = groups.join(queries.select("key").distinct(), "key", "left_semi").select("key", "vec")
    asked = materialize(mapped(asked, search, f"key binary, floor double, vec {vec}, tree int, leaf int"), "ann-asked")
    left, lists = in_blocks(indexed, F.struct("key", "first", "vec"), BLOCK, "rows")
    right, asking = in_blocks(asked, F.struct("key", "floor", "vec"), ASKED, "asked")
    # a leaf of many blocks is dealt over a grid of cells, so that none holds too many pairs of blocks
    grid = [(t, n, -(-lists[t, n] // CELL), -(-asking[t, n] // CELL)) for t, n in lists if (t, n) in asking]
    plan = F.broadcast(spark.createDataFrame(grid, "tree int, leaf int, across int, down int"))  # one line a leaf
    left = left.join(plan, ["tree", "leaf"]).withColumns({"a": F.pmod("block", "across"), "b": F.explode(F.sequence(F.lit(0), F.col("down") - 1))})
    right = right.join(plan, ["tree", "leaf"]).withColumns({"b": F.pmod("block", "down"), "a": F.explode(F.sequence(F.lit(0), F.col("across") - 1))})
    met = left.select("tree", "leaf", "a", "b", "rows").join(right.select("tree", "leaf", "a", "b", "asked"), ["tree", "leaf", "a", "b"])
    scored = mapped(met.select("rows", "asked"), top_in_block(dims, keep), "query binary, key binary, first long, score double")
    once = scored.groupBy("query", "key").agg(F.max("score").alias("score"), F.min("first").alias("first"))
    best = once.withColumn("__n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "first"))).where(F.col("__n") <= keep)
    named = best.join(groups.select("key", "ids"), "key")
    # at most keep vectors of keep ids each
    lists_of = named.groupBy("query").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "ids", "key")).alias("found"))
    flat = F.flatten(F.transform("found", lambda f: F.transform(f["ids"], lambda i: F.struct(f["far"].alias("far"), i.alias("id"), f["key"].alias("key")))))
    # written out, so that a vector that very many rows share can be split in the join
    answers = materialize(lists_of.select(F.col("query").alias("key"), F.slice(F.sort_array(flat), 1, keep).alias("found")), "ann-answers")
    met = materialize(queries, "ann-queries").join(answers, "key")
    others = F.slice(F.filter("found", lambda f: ~((f["id"] == F.col("id")) & (f["key"] == F.col("key")))), 1, k)
    out = met.select("id", F.posexplode(others).alias("at", "one"))
    return out.select(F.col("id").alias("query_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("one.id").alias("vec_id"), (-F.col("one.far")).alias("score"))
