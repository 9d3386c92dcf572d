"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters run over the whole document, their answers are
max-pooled over overlapping chunks, and the chunks' vectors (their maximum and their
mean) are combined into one probability. It is fitted on the driver on a bounded sample
of labelled documents and then scores every document inside the tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import held_out, layout, map_texts, sample_texts, text_of

#: Labelled documents to fit on at most; their texts take part whole.
SAMPLE_ROWS = 5000
EPOCHS, BATCH, RATE = 5, 32, 0.01
THRESHOLD = 0.3
#: Embedding size, filter width and stride in bytes, number of filters.
DIM, WIDTH, STRIDE, FILTERS = 8, 8, 4, 48
#: Half a chunk in bytes: a chunk is two neighbouring halves, so chunks overlap by one.
HALF = 512
#: Bytes packed together; a longer text is packed by itself. Halves gone through at once.
SLICE, STEP = 1 << 18, 256


def pack(texts: list[bytes | np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each padded with zeros to whole halves; halves of each text."""
    halves = np.array([-(-(len(t) + WIDTH) // HALF) for t in texts])
    out = np.zeros(int(halves.sum()) * HALF + WIDTH, dtype=np.uint8)
    for t, at in zip(texts, (np.cumsum(halves) - halves) * HALF, strict=True):
        out[at : at + len(t)] = np.frombuffer(t, dtype=np.uint8) if len(t) else 0
    return out, halves


class ByteNet:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        f32 = np.float32
        self.p = {
            "embed": rng.normal(0, 0.5, (256, DIM)).astype(f32),
            "filters": rng.normal(0, (WIDTH * DIM) ** -0.5, (WIDTH * DIM, FILTERS)).astype(f32),
            "bias": np.zeros(FILTERS, f32),
            "out": rng.normal(0, 0.05, 2 * FILTERS).astype(f32),
            "base": np.zeros(1, f32),
        }
        self.p["embed"][0] = 0

    def answers(self, data: np.ndarray, last: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The filters' largest answer in each half, and the window it came from.

        Halves are taken a few at a time, and each by a product of its own of the same
        shape, so that an answer depends on nothing but the half and the bytes behind
        it. The window that would reach into the next text is left out; the one before
        it lies in the padding as that one should.
        """
        size, steps = len(last), HALF // STRIDE
        half = np.empty((size, FILTERS), np.float32)
        at = np.empty((size, FILTERS), np.int64) if keep else None
        for lo in range(0, size, STEP):
            hi = min(lo + STEP, size)
            x = self.p["embed"][data[lo * HALF : hi * HALF + WIDTH]]
            step = DIM * x.itemsize
            win = np.lib.stride_tricks.as_strided(x, (hi - lo, steps, WIDTH * DIM), (HALF * step, STRIDE * step, x.itemsize))
            act = np.matmul(win, self.p["filters"]) + self.p["bias"]
            act[last[lo:hi], -1] = -np.inf
            half[lo:hi] = act.max(axis=1)
            if keep:
                at[lo:hi] = act.argmax(axis=1)
        return np.maximum(half, 0, out=half), at

    def forward(self, data: np.ndarray, halves: np.ndarray, keep: bool = False):
        first = np.cumsum(halves) - halves
        last = np.zeros(int(halves.sum()), dtype=bool)
        last[first + halves - 1] = True
        half, at = self.answers(data, last, keep)
        # a chunk for each half and the next one of its text; the last half stands for itself only in one-half texts
        nxt = np.minimum(np.arange(len(half)) + 1, len(half) - 1)
        use = ~last | np.repeat(halves == 1, halves)
        chunk = np.where(last[:, None], half, np.maximum(half, half[nxt]))
        top = np.maximum.reduceat(half, first)
        mean = np.add.reduceat(chunk * use[:, None], first) / np.maximum(halves - 1, 1)[:, None]
        # row by row, so that neighbours in the batch do not change the order of the sums
        logit = (np.concatenate([top, mean], axis=1) * self.p["out"]).sum(axis=1) + self.p["base"]
        prob = 1 / (1 + np.exp(-logit.clip(-30, 30)))
        return (prob, half, at, use, nxt, last, top, mean, first) if keep else prob

    def gradients(self, data: np.ndarray, halves: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        prob, half, at, use, nxt, last, top, mean, first = self.forward(data, halves, keep=True)
        d = ((prob - labels) / len(labels)).astype(np.float32)
        g = {"out": d @ np.concatenate([top, mean], axis=1), "base": d.sum(keepdims=True)}
        w_top, w_mean = self.p["out"][:FILTERS], self.p["out"][FILTERS:]
        doc = np.repeat(np.arange(len(halves)), halves)
        to_chunk = (d / np.maximum(halves - 1, 1))[doc][:, None] * w_mean * use[:, None]
        own = last[:, None] | (half >= half[nxt])
        to_half = to_chunk * own
        np.add.at(to_half, nxt, to_chunk * ~own)
        winner = half >= top[doc]
        share = winner / np.maximum(np.add.reduceat(winner, first)[doc], 1)
        to_half = (to_half + d[doc][:, None] * w_top * share) * (half > 0)
        g["bias"] = to_half.sum(axis=0)
        g["filters"], g["embed"] = np.zeros_like(self.p["filters"]), np.zeros((256, DIM))
        for lo in range(0, len(half), STEP):
            hi = min(lo + STEP, len(half))
            begins = at[lo:hi] * STRIDE + np.arange(lo, hi)[:, None] * HALF
            where = data[begins[:, :, None] + np.arange(WIDTH)]  # half, filter, byte
            seen = self.p["embed"][where].reshape(hi - lo, FILTERS, WIDTH * DIM)
            g["filters"] += np.einsum("hfw,hf->wf", seen, to_half[lo:hi])
            into = (to_half[lo:hi, :, None] * self.p["filters"].T).reshape(-1, DIM)
            g["embed"] += np.stack([np.bincount(where.ravel(), into[:, k], 256) for k in range(DIM)], axis=1)
        g["embed"][0] = 0
        return g

    def fit(self, texts: list[bytes], labels: list[int]) -> ByteNet:
        rng, y = np.random.default_rng(11), np.array(labels, dtype=np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        if len(y):
            self.p["base"][:] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        steps, t = max(1, -(-len(y) // BATCH) * EPOCHS), 0
        for _ in range(EPOCHS if len(y) else 0):
            order = rng.permutation(len(y))
            for i in range(0, len(y), BATCH):
                part = order[i : i + BATCH]
                g = self.gradients(*pack([texts[k] for k in part]), y[part])
                t += 1
                for k, v in g.items():
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.99 * s[k] + 0.01 * v * v
                    rate = RATE * (1 - t / (steps + 1))
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
        return self

    def score(self, texts: list[str | None]) -> list[float]:
        raw = [(t or "").encode("utf-8", "replace") for t in texts]
        return self.score_bytes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))

    def score_bytes(self, data: np.ndarray, begins: np.ndarray) -> list[float]:
        """Scores of texts given as bytes end to end and the places where they begin."""
        out: list[float] = []
        sizes, at = np.diff(begins), 0
        while at < len(sizes):
            end, size = at, 0
            while end < len(sizes) and (end == at or size + sizes[end] <= SLICE):
                size += sizes[end]
                end += 1
            out.extend(self.forward(*pack([data[begins[k] : begins[k + 1]] for k in range(at, end)])).astype(float).tolist())
            at = end
        return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> ByteNet:
    """Fit on at most ``rows`` labelled documents outside the held-out fold, whole texts."""
    found = sample_texts(docs, labels, label, rows, id_col, text_col).collect()
    found.sort(key=lambda r: (str(r[id_col]), r["text"]))
    return ByteNet().fit([r["text"].encode("utf-8", "replace") for r in found], [int(r["label"]) for r in found])


def score_quality(docs: DataFrame, net: ByteNet, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Every byte of the text counts, in chunks as many as it takes, and nothing else: equal
    texts score equal wherever they lie. A null text scores as an empty one; a null id is not held out. An empty table gives an empty result, and
    without labels every score is that of an unfitted net.
    """

    def make():
        return lambda cols: {"id": cols["id"], "score": net.score_bytes(*layout(cols["text"]))}

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = map_texts(rows, make, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
