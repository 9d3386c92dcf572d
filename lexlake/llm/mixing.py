"""Mixing sources to target weights by fixed-length blocks.

The documents of a source are laid end to end and cut into blocks of equal word count.
Each output shard draws how many blocks of each source it takes; the draws of a source
walk a pseudorandom permutation of its block numbers, epoch after epoch, and meet the
documents in a join on the block number.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import fresh, map_texts, running
from lexlake.workspace import materialize, new_dir

#: Words in a block; shards of the output; weights by rank; how often a source may be repeated.
BLOCK, SHARDS, WEIGHTS, REPEATS = 64, 16, (5, 2, 1), 3
SPACE = r"\x20\x09-\x0D"
#: Of the files of the mix; each task writes one for every shard it has rows of.
CODEC = "zstd"


def targets(sizes: list[int], weights: list[float], repeats: int = REPEATS) -> list[float]:
    """Share the sum of the sizes out by weight, none above ``repeats`` times its size."""
    out, total = [0.0] * len(sizes), float(sum(sizes))
    free, left = [i for i, n in enumerate(sizes) if n], total
    while free:
        scale = left / sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * scale > repeats * sizes[i]]
        for i in over or free:
            out[i] = float(repeats * sizes[i]) if over else weights[i] * scale
        if not over:
            break
        left -= sum(out[i] for i in over)
        free = [i for i in free if i not in over]
    return out


def draws(size: int, target: float, block: int) -> tuple[int, int]:
    """Blocks of a source, and how many draws bring its words closest to the target."""
    n = -(-size // block)
    full = int(target // size)
    return n, full * n + round((target - full * size) / size * n)


def multinomial_counts(wanted: list[int], shards: int, seed: int) -> np.ndarray:
    """Blocks of each source in each shard: multinomial draws from what is left, so that
    the shards together take exactly what is wanted."""
    rng, left = np.random.default_rng(seed), np.array(wanted, dtype=np.int64)
    out = np.zeros((shards, len(wanted)), dtype=np.int64)
    for k in range(shards):
        slots = int(left.sum()) // (shards - k)
        if slots:
            out[k] = np.minimum(rng.multinomial(slots, left / left.sum()), left)
            for i in np.argsort(-(left - out[k])):  # a source that ran out leaves slots to the others
                more = min(slots - int(out[k].sum()), int(left[i] - out[k][i]))
                out[k][i] += max(0, more)
        left -= out[k]
    return out


def permute(k: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of 0..n-1 applied to k: four Feistel rounds on the next even
    number of bits, walked again until the value is below n."""
    k, n, key = (np.asarray(x).astype(np.uint64) for x in (k, n, key))
    half = np.uint64(1) * np.ceil(np.log2(np.maximum(n.astype(float), 2)) / 2 + 1e-9).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = k.copy(), np.ones(len(k), dtype=bool)
    with np.errstate(over="ignore"):
        while todo.any():
            x, h, m, s = out[todo], half[todo], mask[todo], key[todo]
            left, right = x >> h, x & m
            for r in range(1, 5):
                f = (right + s + np.uint64(r)) * np.uint64(0x9E3779B97F4A7C15)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                left, right = right, left ^ ((f >> np.uint64(32)) & m)
            out[todo] = (left << h) | right
            todo &= out >= n
    return out.astype(np.int64)


def permuted(drawn: DataFrame) -> DataFrame:
    """(src, block, shard, draw) of rows that have k, n and key in place of the block. In
    Arrow batches as all other Python work: functions of another kind, and tables made of
    Python rows, get worker processes of their own, which stay beside the others."""

    def make():
        return lambda c: {"src": c["src"], "block": permute(*(c[x].to_numpy(zero_copy_only=False) for x in ("k", "n", "key"))), "shard": c["shard"], "draw": c["draw"]}

    return map_texts(drawn, make, "src string, block long, shard int, draw long")


def lines_of(spark, columns: dict[str, pa.Array]) -> DataFrame:
    """A small table, made without Python workers."""
    return spark.createDataFrame(pa.table(columns))


class Mix:
    """The plan of a mix: what each source has and takes. Holds one line per source."""

    def __init__(self, rows: DataFrame, seed: int, block: int, shards: int, weights=WEIGHTS):
        found = rows.groupBy("src").agg(F.sum("size").alias("n"), F.first("source").alias("source")).collect()
        found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        self.keys, sizes = [r["src"] for r in found], [int(r["n"]) for r in found]
        self.targets = targets(sizes, [weights[i % len(weights)] for i in range(len(found))])
        plan = [draws(s, t, block) if s else (0, 0) for s, t in zip(sizes, self.targets, strict=True)]
        counts = multinomial_counts([d for _, d in plan], shards, seed)
        self.sizes, self.block, self.seed, self.shards = sizes, block, seed, shards
        self.blocks, self.draws = [n for n, _ in plan], [d for _, d in plan]
        self.upto = counts.cumsum(axis=0).T.tolist()  # by source: the draws up to each shard

    def sources(self, spark) -> DataFrame:
        return lines_of(spark, {"src": pa.array(self.keys, pa.string()), "source_size": pa.array(self.sizes, pa.int64()), "target": pa.array(self.targets, pa.float64())})

    def slots(self, spark) -> DataFrame:
        """(src, block, shard, draw): every draw of every source."""
        ends = np.cumsum([0, *self.draws]).tolist()
        total = ends[-1]
        table = lines_of(spark, {
            "i": pa.array(range(len(self.keys)), pa.int32()),
            "src": pa.array(self.keys, pa.string()),
            "first": pa.array(ends[:-1], pa.int64()),
            "blocks": pa.array([max(n, 1) for n in self.blocks], pa.int64()),
            "key": pa.array([(self.seed * 1_000_003 + i * 7919) & 0x7FFFFFFF for i in range(len(self.keys))], pa.int64()),
            "upto": pa.array(self.upto, pa.list_(pa.int64())),
        })
        begins = F.array(*(F.lit(int(x)) for x in ends[1:])) if self.keys else F.array().cast("array<long>")
        all_draws = spark.range(total).withColumn("i", F.size(F.filter(begins, lambda e: e <= F.col("id"))))
        drawn = all_draws.join(F.broadcast(table), "i")  # one line per source
        drawn = drawn.withColumn("draw", F.col("id") - F.col("first"))
        shard = F.size(F.filter("upto", lambda e: e <= F.col("draw")))
        return permuted(drawn.select("src", F.expr("draw % blocks").alias("k"), F.col("blocks").alias("n"), F.expr("key + draw div blocks").alias("key"), shard.alias("shard"), "draw"))


def word_count(text):
    """Number of words; a word is a run without ASCII white space."""
    cleaned = F.regexp_replace(text, f"[^{SPACE}]+", "x")
    return F.length(F.regexp_replace(cleaned, f"[{SPACE}]+", "")).cast("long")


def prepare(docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: bool = False) -> DataFrame:
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    source = F.col(source_col).cast("string")
    return docs.select(
        F.col(id_col).alias("id"),
        source.alias("source"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("src"),
        F.coalesce(word_count(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("h"),
        *row,
    )


def take(rows: DataFrame, seed: int = 17, block: int = BLOCK, shards: int = SHARDS) -> tuple[DataFrame, DataFrame, Mix]:
    """(rows with their ``at`` in the source's stream, pieces taken, plan).

    A piece is (src, at, lo, hi, shard, draw): words lo to hi of the document that begins
    at ``at`` go to an output shard, by that draw of the source.
    """
    spark, rows = rows.sparkSession, materialize(rows, "mix-sizes")
    mix = Mix(rows, seed, block, shards)
    placed = running(rows, ["src"], ["id", "h"], "size", "at")
    spans = placed.where("size > 0").select("src", "at", "size", F.explode(F.expr(f"sequence(at div {block}, (at + size - 1) div {block})")).alias("block"))
    met = spans.join(mix.slots(spark), ["src", "block"])
    lo = F.greatest(F.col("block") * block - F.col("at"), F.lit(0))
    hi = F.least((F.col("block") + 1) * block - F.col("at"), F.col("size"))
    return placed, met.select("src", "at", lo.alias("lo"), hi.alias("hi"), "shard", "draw"), mix


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, block: int = BLOCK) -> DataFrame:
    """One row per document: id, size, source_size, target, taken.

    Sources in order of code point, null last, weigh 5, 2, 1 and so on again; together
    they take as many words as there are, none over three times its own. A document of
    no words takes none. Repeated rows are documents of their own. The same rows give
    the same mix. One line per source is held on the driver.
    """
    placed, pieces, mix = take(prepare(docs, id_col, text_col, source_col), seed, block)
    words = pieces.groupBy("src", "at", "shard").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
    words = words.groupBy("src", "at").agg(F.sum("taken").alias("taken"))
    some = placed.where("size > 0").join(words, ["src", "at"], "left")
    none = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    all_rows = some.unionByName(none).join(F.broadcast(mix.sources(docs.sparkSession)), "src")
    return all_rows.select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, block: int = BLOCK) -> DataFrame:
    """The mixed corpus itself, with the columns of ``docs``; see ``mixed_shards``."""
    return mixed_shards(docs, id_col, text_col, source_col, seed, block)[1].select(*docs.columns)


def mixed_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 17, block: int = BLOCK, shards: int = SHARDS) -> tuple[str, DataFrame]:
    """Write the mixed corpus by output shard; returns the folder (one subfolder per
    shard, __shard=0 and so on) and its rows: the columns of ``docs`` and __shard (with
    one more underscore in front if ``docs`` has a column of that name).

    A document comes once for each shard and epoch that take some of its blocks, with
    the words of those blocks as text, white space as it was; ``n_chars``, if there, is
    counted anew. Documents none of whose words are drawn are left out. A shard holds
    the blocks that its multinomial draw gives it.
    """
    name = fresh(docs.columns, "__shard")[0]
    rows = prepare(docs, id_col, text_col, source_col, carry=True)
    placed, pieces, mix = take(rows.drop("row"), seed, block, shards)
    plan = lines_of(docs.sparkSession, {"src": pa.array(mix.keys, pa.string()), "blocks": pa.array([max(n, 1) for n in mix.blocks], pa.int64())})
    pieces = pieces.join(F.broadcast(plan), "src").withColumn("epoch", F.expr("draw div blocks"))  # one line per source
    lists = pieces.groupBy("src", "at", "shard", "epoch").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("pieces"))
    lists = lists.groupBy("src", "at").agg(F.collect_list(F.struct("shard", "pieces")).alias("pieces"))
    # rows alike in id, text and source share their pieces: each list is one of them. One plain key,
    # so that the join and the grouping behind it need each text to be dealt once
    key = F.sha2(F.concat_ws("|", F.coalesce(F.concat(F.lit("="), F.col("id").cast("string")), F.lit("")), F.col("h").cast("string"), "src"), 256).alias("key")
    by_key = placed.where("size > 0").join(lists, ["src", "at"]).select(key, "pieces").groupBy("key").agg(F.collect_list("pieces").alias("all"))
    met = rows.where("size > 0").select(key, "row").join(by_key.hint("merge"), "key")
    met = met.groupBy("key").agg(F.first("row").alias("row"), F.first("all").alias("all"))
    words = F.regexp_extract_all(F.col("row")[text_col], F.lit(f"[^{SPACE}]+[{SPACE}]*"), F.lit(0))

    def piece(words, p):
        return F.array_join(F.slice(words, (p["lo"] + 1).cast("int"), (p["hi"] - p["lo"]).cast("int")), "")

    # the words are cut once for a row, as the variable of a lambda, and all its pieces from them
    cut = F.transform(
        F.array(words),
        lambda w: F.transform(F.flatten("all"), lambda one: F.struct(one["shard"].alias("shard"), F.array_join(F.transform(one["pieces"], lambda p: piece(w, p)), "").alias("text"))),
    )
    out = met.select("row", F.explode(cut[0]).alias("one"))
    fields = []
    for c in docs.columns:
        x = F.col("row")[c]
        x = F.col("one.text") if c == text_col else F.length("one.text").cast(docs.schema[c].dataType) if c == "n_chars" else x
        fields.append(x.alias(c))
    out = out.select(*fields, F.col("one.shard").alias(name))
    path = new_dir(docs.sparkSession, "mix")
    # written where the texts are: to gather a shard first would send the whole mix through a second shuffle
    out.write.partitionBy(name).option("compression", CODEC).parquet(path)
    return path, docs.sparkSession.read.schema(out.schema).parquet(path)
