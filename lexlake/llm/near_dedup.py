"""Near-duplicate components by HyperMinHash sketches, banded, with exact confirmation.

A sketch has one register per hash function: the number of leading zeros of the least
hash of the set and the bits after its leading one, sixteen bits in all. (Each register
has a hash function of its own; registers filled by a prefix of one hash stay empty in
short documents.) Runs of registers are bands; documents with an equal band are
candidates. They are never paired off: each band bucket first links its members to one
leader. Only buckets that then still hold several components compare members across
components, inside the join, by two longer bit sketches that ride along: bits of least
values, and parities of the shingles that fall into each of 4096 places (an odd sketch,
which counts the shingles in which two sets differ nearly exactly while they are few).
The estimate from the registers, corrected for chance agreement, throws out the clearly
unlike; the rest is confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import fresh, map_texts, text_of
from lexlake.workspace import materialize

#: Registers in a band and bands: a pair at likeness 0.8 is missed by all bands once in two million.
ROWS, BANDS = 6, 48
MANTISSA = 10
#: Chance that registers of different minima agree, by the published analysis of the sketch.
COLLISION = 0.169919487159739 / (1 << MANTISSA)
#: A candidate goes on to confirmation if its estimate is within this of the threshold (over 6 deviations).
SLACK = 0.15
#: For comparing across components: bits of least values and bits of parities.
BITS, PARITIES = 2048, 4096
#: Bytes of text hashed at once.
SLICE = 1 << 20

_rng = np.random.default_rng(20250101)
_TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(9, 14)]] = True
_TABLE[_SPACE] = 0
_TABLE[65:91] = _TABLE[97:123]  # A-Z as a-z
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MUL = (_rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint64).astype(np.uint32)
_BIT_MUL = (_rng.integers(0, 1 << 32, BITS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_BIT_ADD = _rng.integers(0, 1 << 32, BITS, dtype=np.uint64).astype(np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """A 64-bit hash of each word of each text, in order."""
    joined = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    space = _SPACE[joined]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    ends = np.cumsum([len(t) + 1 for t in texts])
    if not len(starts):
        return [np.zeros(0, dtype=np.uint64) for _ in texts]
    with np.errstate(over="ignore"):
        index = np.arange(len(joined), dtype=np.int64)
        index[: starts[0]] = 0
        spans = np.diff(np.append(starts, len(joined)))
        index[starts[0] :] -= np.repeat(starts, spans)
        powers = np.cumprod(np.full(int(index.max()) + 1, _STEP, dtype=np.uint64))
        hashes = _mix(np.add.reduceat(_TABLE[joined] * powers[index], starts))
    cut = np.searchsorted(starts, ends)
    return np.split(hashes, cut[:-1])


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words make one shingle."""
    out: list[np.ndarray] = []
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    at = 0
    while at < len(raw):
        end, size = at, 0
        while end < len(raw) and (end == at or size + len(raw[end]) <= SLICE):
            size += len(raw[end]) + 1
            end += 1
        for words in word_hashes(raw[at:end]):
            n = len(words)
            if n == 0:
                out.append(words)
                continue
            w = min(n, width)
            with np.errstate(over="ignore"):
                s = np.full(n - w + 1, w, dtype=np.uint64)
                for k in range(w):
                    s = _mix(s * _STEP + words[k : n - w + 1 + k])
            out.append(np.unique(s))
        at = end
    return out


def minima(s: np.ndarray, mul: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(mul), 0xFFFFFFFF, dtype=np.uint32)
    step = max(1, 36864 // len(mul))
    for at in range(0, len(x), step):
        np.minimum(least, (x[at : at + step, None] * mul + add).min(axis=0), out=least)
    return least


def registers(s: np.ndarray) -> np.ndarray:
    """The sketch of a set that isn't empty."""
    least = minima(s, _MUL, _ADD)
    part, exponent = np.frexp(least.astype(np.float64))
    mantissa = ((part * 2 - 1).clip(0, None) * (1 << MANTISSA)).astype(np.uint16)
    zeros = np.where(least == 0, 32, 32 - exponent).astype(np.uint16)
    return (zeros << np.uint16(MANTISSA)) | mantissa


def sketch(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, h, n, node, regs): hash of the text, the set's size, its 128-bit digest, registers."""

    def make():
        def apply(cols):
            sets = shingle_sets(cols["text"].to_pylist(), width)
            regs = [registers(s) if len(s) else None for s in sets]
            return {
                "id": cols["id"],
                "h": cols["h"],
                "n": [len(s) for s in sets],
                "node": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "regs": [None if r is None else r.tobytes() for r in regs],
            }

        return apply

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("h"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, make, f"id {kind}, h long, n long, node binary, regs binary")


def band_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): a 64-bit key of each band of each node."""
    size = 2 * ROWS
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.substring("regs", (b * size + 1).cast("int"), F.lit(size))),
    )
    return nodes.select("node", F.explode(keys).alias("key"))


def estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (u, v) whose sketches do not rule the threshold out."""

    def make():
        def apply(cols):
            u, v = (np.frombuffer(b"".join(cols[c].to_pylist()), dtype=np.uint16).reshape(-1, ROWS * BANDS) for c in ("ru", "rv"))
            share = ((u == v).mean(axis=1) - COLLISION) / (1 - COLLISION)
            keep = pa.array(share >= threshold - SLACK)
            return {"u": cols["u"].filter(keep), "v": cols["v"].filter(keep)}

        return apply

    r = nodes.select("node", "regs")
    met = pairs.join(r.select(F.col("node").alias("u"), F.col("regs").alias("ru")), "u")
    met = met.join(r.select(F.col("node").alias("v"), F.col("regs").alias("rv")), "v")
    return map_texts(met.select("u", "v", "ru", "rv"), make, "u binary, v binary")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets are alike: 100 * |common| >= percent * |all|.

    ``texts`` has the text of each node, again for each row alike in id and text; only
    those of candidates are hashed again.
    """

    def hashed():
        def apply(cols):
            return {"node": cols["node"], "items": [s.tobytes() for s in shingle_sets(cols["text"].to_pylist(), width)]}

        return apply

    def make():
        def apply(cols):
            keep = []
            for a, b in zip(cols["su"], cols["sv"], strict=True):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, type=pa.bool_())
            return {"u": cols["u"].filter(keep), "v": cols["v"].filter(keep)}

        return apply

    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    sets = materialize(map_texts(texts.join(ends, "node").select("node", "text").dropDuplicates(["node"]), hashed, "node binary, items binary"), "near-sets")
    met = pairs.join(sets.select(F.col("node").alias("u"), F.col("items").alias("su")), "u")
    met = met.join(sets.select(F.col("node").alias("v"), F.col("items").alias("sv")), "v")
    return map_texts(met.select("u", "v", "su", "sv"), make, "u binary, v binary")


def parities(s: np.ndarray) -> np.ndarray:
    """Whether the number of shingles in each place is odd, packed."""
    places = (_mix(s + _STEP) % np.uint64(PARITIES)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=PARITIES) & 1).astype(np.uint8)).view(np.int64)


def bit_sketches(texts: DataFrame, width: int) -> DataFrame:
    """(node, n, b0, b1, ..., p0, p1, ...): the set's size, one bit of the least value of
    each of 2048 hash functions, and the parities of 4096 places."""
    least, parity = [f"b{i}" for i in range(BITS // 64)], [f"p{i}" for i in range(PARITIES // 64)]

    def make():
        def apply(cols):
            sets = shingle_sets(cols["text"].to_pylist(), width)
            words = np.array([np.packbits((minima(s, _BIT_MUL, _BIT_ADD) >> np.uint32(12)).astype(np.uint8) & 1).view(np.int64) for s in sets])
            odd = np.array([parities(s) for s in sets])
            out = {"node": cols["node"], "n": [len(s) for s in sets]}
            for names, values in ((least, words), (parity, odd)):
                out |= {c: pa.array(values[:, i]) for i, c in enumerate(names)}
            return out

        return apply

    return map_texts(texts, make, "node binary, n long, " + ", ".join(f"{c} long" for c in [*least, *parity]))


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): one node of the component, the same for all, for every node that has an edge.

    Each round points every node to its least neighbour if that is less, follows the
    pointers once, and draws the edges anew between what is left, so that their number
    falls from round to round. Pointers and edges are written out after every round.
    """
    u, v = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    rest = materialize(edges.select(u, v).where("u <> v").distinct(), "links")
    labels = None
    while labels is None or not rest.isEmpty():
        both = rest.union(rest.select("v", "u"))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("up"))
        hop = near.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = materialize(near.join(hop, "up").select("node", F.col("top").alias("up")), "pointers")
        if labels is None:
            labels = step.withColumnRenamed("up", "comp")
        else:
            labels = relabelled(labels, step.withColumnRenamed("up", "comp"))
        ends = rest
        for c in ("u", "v"):
            ends = ends.join(step.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")), c).drop(c).withColumnRenamed(f"{c}_up", c)
        rest = materialize(ends.select(u, v).where("u <> v").distinct(), "links")
    return labels


def relabelled(labels: DataFrame, step: DataFrame) -> DataFrame:
    """The labels after components have been joined by ``step``, which may bring new nodes."""
    to = step.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    old = labels.join(to, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return materialize(old.unionByName(step.join(labels, "node", "left_anti").select("node", "comp")), "labels")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept, and text_xxhash64, which
    tells rows of one id apart.

    Documents whose sets of ``width``-word shingles are alike to ``percent`` of their
    union are linked; a component's id is its smallest document id, and that document
    stays (of several texts of that id, or if all ids are null, the one of least hash).
    A text without words (or null) has an empty set and is linked with nothing.
    Equal sets are one node. Rows that repeat an id are each judged by their own text.
    A null id is ignored in the minimum. An empty table gives an empty result.
    """
    sketches = materialize(sketch(docs, id_col, text_col, width), "sketches")
    some = sketches.where("n > 0")
    nodes = materialize(
        some.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("first"), F.first("regs").alias("regs")), "nodes"
    )
    labels = links(nodes, _one_text(docs, nodes, id_col, text_col), width, percent)
    owner = nodes.select("node", "first").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    tops = owner.groupBy("comp").agg(F.min("first").alias("top"))
    owner = owner.join(tops, "comp").select("node", F.col("top.id").alias("component_id"), F.col("top.h").alias("top_h"))
    kept = F.col("id").eqNullSafe(F.col("component_id")) & (F.col("h") == F.col("top_h"))
    linked = some.select("id", "h", "n", "node").join(owner, "node").select("id", "h", "n", "component_id", kept.alias("kept"))
    alone = sketches.where("n = 0").select("id", "h", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    done = linked.unionByName(alone)
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "kept", F.col("h").alias("text_xxhash64"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, as they are, that stay: one document of each component."""
    found = near_dedup(docs, id_col, text_col, width, percent)
    of, h = fresh(docs.columns, "__id", "__h")
    stay = found.where("kept").select(F.col(id_col).alias(of), F.col("text_xxhash64").alias(h)).distinct()
    return docs.join(stay, F.col(id_col).eqNullSafe(F.col(of)) & (F.xxhash64(text_of(text_col)) == F.col(h)), "left_semi")


def _one_text(docs, nodes, id_col, text_col) -> DataFrame:
    """(node, text): the text of each node's first row, which is found by id and hash of
    the text. Rows alike in both come again."""
    firsts = nodes.select("node", F.col("first.id").alias("__id"), F.col("first.h").alias("__h"))
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return texts.join(firsts, F.col("id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__h"))).select("node", "text")


def links(nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, comp) of all nodes that have a link."""
    keys = band_keys(nodes.select("node", "regs"))
    # the least member leads, so that buckets of one large group mostly share their leader
    heads = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("c")).where("c > 1").select("key", "leader")
    members = materialize(keys.join(heads, "key"), "members")
    u, v = F.least("node", "leader").alias("u"), F.greatest("node", "leader").alias("v")
    asked = materialize(members.where("node <> leader").select(u, v).distinct(), "candidates")

    def accept(pairs: DataFrame) -> DataFrame:
        close = materialize(estimated(pairs, nodes, percent / 100), "close")
        return materialize(confirmed(close, texts, width, percent), "confirmed")

    labels = components(accept(asked))
    open_rows = still_open(members.select("key", "node"), labels)
    open_texts = texts.join(open_rows.select("node").distinct(), "node", "left_semi").select("node", "text").dropDuplicates(["node"])
    bits = materialize(bit_sketches(open_texts, width), "open-bits")
    # another leader in each bucket first, which joins most of what belongs together; then all that is left
    for one_leader in (True, False):
        rows = open_rows.join(bits, "node")
        left = rows
        if one_leader:
            heads = open_rows.groupBy("key").agg(F.min_by("node", F.xxhash64("node", "key")).alias("node"))
            left = rows.join(heads, ["key", "node"], "left_semi")
        pairs = materialize(across(left, rows, one_leader, percent).join(asked, ["u", "v"], "left_anti"), "candidates")
        more = accept(pairs)
        asked = asked.unionByName(pairs)
        if not more.isEmpty():
            ends = more
            for c in ("u", "v"):
                of = labels.select(F.col("node").alias(c), F.col("comp").alias("of"))
                ends = ends.join(of, c, "left").withColumn(c, F.coalesce("of", c)).drop("of")
            labels = relabelled(labels, components(ends))
            if one_leader:
                open_rows = still_open(open_rows.select("key", "node"), labels)
    return labels


def still_open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, comp) of the buckets that hold more than one component."""
    named = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    still = named.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key")
    return materialize(named.join(still, "key", "left_semi"), "open")


def across(left: DataFrame, right: DataFrame, any_order: bool, percent: int) -> DataFrame:
    """Pairs (u, v) of one bucket and different components whose bit sketches are close.

    Sets that are alike enough differ in at most ``most`` shingles, and two sketches of
    parities never differ in more places than the sets do in shingles. In long sets
    several fall into a place, so there the expected number and five deviations (at
    most half the root of the places each) is less. Bits of least values may differ by
    the expected number at the threshold and 4.5 deviations.
    """
    left, right = left.alias("l"), right.alias("r")
    ell, r = F.col("l.node"), F.col("r.node")

    def differ(prefix: str, bits: int) -> Column:
        each = [F.bit_count(F.col(f"l.{prefix}{i}").bitwiseXOR(F.col(f"r.{prefix}{i}"))) for i in range(bits // 64)]
        return reduce(add, each)

    most = (F.col("l.n") + F.col("r.n")) * (100 - percent) / (100 + percent)
    seen = F.least(most, F.lit(PARITIES / 2) * (1 - F.exp(-2 * most / PARITIES)) + 2.5 * PARITIES**0.5)
    share = (1 - percent / 100) / 2
    bits = BITS * share + 4.5 * (BITS * share * (1 - share)) ** 0.5
    met = (F.col("l.key") == F.col("r.key")) & (F.col("l.comp") != F.col("r.comp"))
    # a hair of room for the division
    met = met & (differ("p", PARITIES) <= seen + 1e-6) & (differ("b", BITS) <= bits)
    met = left.join(right, met if any_order else met & (ell < r))
    return met.select(F.least(ell, r).alias("u"), F.greatest(ell, r).alias("v")).distinct()
