"""Toxicity: a weighted lexicon found by Aho-Corasick in folded text.

Folding brings look-alike letters, styled letters and digits put for letters back to
plain ones and drops invisible characters. Entries are beginnings of words; they and
their weights are learned from labelled documents as log-odds, as are the exception
phrases (an entry together with the next word, where it is met in clean documents).
The weights found are normalised by the length of the text and mapped to a probability.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import held_out, map_texts, sample_texts, text_of
from lexlake.workspace import materialize

#: Labelled documents to learn from at most; their texts take part whole.
SAMPLE_ROWS = 20_000
#: Letters in an entry.
SHORTEST, LONGEST = 2, 24
#: Characters of text counted at once.
SLICE = 1 << 20
THRESHOLD = 0.5

# Characters that look like a Latin letter and have no decomposition to it.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "α": "a", "β": "b",
    "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ı": "i",
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ø": "o", "đ": "d", "ł": "l", "ß": "s", "æ": "a", "œ": "o",
}
# Digits and signs written for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e"}
POINTS = 0x110000
_table: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """For each code point the plain letter, a space, or 0 to drop it. Letters and numbers
    of other scripts fold to their lower case."""
    if not _table:
        table = np.full(POINTS, ord(" "), dtype=np.uint32)
        for point in range(POINTS):
            ch = chr(point)
            kind = unicodedata.category(ch)
            if kind in ("Mn", "Me", "Cf"):
                table[point] = 0
            elif kind[0] in "LNS" or ch in DIGITS or not ch.isascii():
                parts = [c for c in unicodedata.normalize("NFKD", ch).lower() if unicodedata.category(c) not in ("Mn", "Me")]
                # a syllable of several letters that are not Latin stays whole
                base = parts[0] if len(parts) == 1 or parts and parts[0].isascii() else ch
                base = HOMOGLYPHS.get(base, DIGITS.get(base, base))
                if "a" <= base <= "z" or kind[0] in "LN":
                    table[point] = ord(base)
        _table.append(table)
    return _table[0]


def fold(text: str, table: np.ndarray) -> str:
    """The folded text, with one space in front and behind."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    plain = table[points]
    return " " + plain[plain != 0].tobytes().decode("utf-32-le") + " "


def slices(texts: list[str], labels: list[int]):
    """Texts and labels in parts of about SLICE characters."""
    part: list[tuple[str, int]] = []
    size = 0
    for text, label in zip(texts, labels, strict=True):
        part.append((text, label))
        size += len(text)
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    coef: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for word, weight in self.weights.items():
            found.add_word(" " + word, (len(word) + 1, weight, word))
        if self.weights:
            found.make_automaton()
        return found

    def measure(self, folded: str, automaton) -> tuple[float, float]:
        """(summed weight, the same per hundred words to the power of a half)."""
        if not self.weights:
            return 0.0, 0.0
        best: dict[int, tuple[float, str]] = {}
        for end, (size, weight, word) in automaton.iter(folded):
            at = end - size + 1
            if at not in best or weight > best[at][0]:
                best[at] = weight, word
        total = 0.0
        for at, (weight, word) in best.items():
            if self.exceptions and f"{word} {_next_word(folded, at + 1)}" in self.exceptions:
                continue
            total += weight
        words = folded.count(" ") - 1
        return total, total / math.sqrt(1 + max(words, 0) / 100)

    def score(self, folded: str, automaton) -> float:
        total, normed = self.measure(folded, automaton)
        a, b, c = self.coef
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * math.log1p(total) + c * math.log1p(normed)))))


def _next_word(folded: str, at: int) -> str:
    end = folded.find(" ", at)
    while end >= 0 and folded[end : end + 1] == " ":
        end += 1
    stop = folded.find(" ", end)
    return folded[end:stop] if end > 0 and stop > 0 else ""


def _entries(rows: DataFrame) -> DataFrame:
    """(entry, toxic, clean): documents of each kind with a word that begins so."""

    def make():
        table = fold_table()

        def apply(cols):
            for part in slices(cols["text"].to_pylist(), cols["label"].to_pylist()):
                seen = {0: Counter(), 1: Counter()}
                for text, label in part:
                    words = set(fold(text, table).split())
                    seen[label].update({w[:k] for w in words for k in range(SHORTEST, min(len(w), LONGEST) + 1)})
                keys = list(seen[0].keys() | seen[1].keys())
                yield {"entry": keys, "toxic": [seen[1][k] for k in keys], "clean": [seen[0][k] for k in keys]}

        return apply

    parts = map_texts(rows, make, "entry string, toxic long, clean long")
    return parts.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _phrases(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(phrase, toxic, clean): documents of each kind with an entry and that next word."""

    def make():
        table, automaton = fold_table(), lexicon.automaton()

        def apply(cols):
            for part in slices(cols["text"].to_pylist(), cols["label"].to_pylist()):
                seen = {0: Counter(), 1: Counter()}
                for text, label in part:
                    folded = fold(text, table)
                    seen[label].update({f"{w} {_next_word(folded, e - n + 2)}" for e, (n, _, w) in automaton.iter(folded)})
                keys = list(seen[0].keys() | seen[1].keys())
                yield {"phrase": keys, "toxic": [seen[1][k] for k in keys], "clean": [seen[0][k] for k in keys]}

        return apply

    parts = map_texts(rows, make, "phrase string, toxic long, clean long")
    return parts.groupBy("phrase").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> Lexicon:
    """Learn lexicon, exceptions and the final curve from labelled documents outside the
    held-out fold. What comes to the driver are the entries and phrases found significant
    in at most ``rows`` documents."""
    sample = sample_texts(docs, labels, label, rows, id_col, text_col).select("text", "label")
    sample = materialize(sample, "toxic-sample")
    count = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = count.get(1, 0), count.get(0, 0)
    if not n1 or not n0:
        return Lexicon({}, coef=(-4.0, 0.0, 0.0))
    counted = _entries(sample)
    base = n1 / (n1 + n0)
    t, c = F.col("toxic"), F.col("clean")
    share = t / (t + c)
    # the chance of so many toxic documents among those with the entry is at most exp(-sure)
    sure = (t + c) * (share * F.log(share / base) + F.when(c > 0, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    weight = F.log((t + 0.5) / (n1 + 1)) - F.log((c + 0.5) / (n0 + 1))
    counted = materialize(counted.where(t >= 3).withColumn("size", F.length("entry")), "toxic-entries")
    # as many tries as entries of that length: the longer the list, the surer an entry must be
    tries = counted.groupBy("size").agg((1.0 + F.log1p(F.count("*"))).alias("needed"))
    fit = counted.join(F.broadcast(tries), "size").where((share > max(0.5, base)) & (sure >= F.col("needed")))
    # of entries that begin alike and stand for the same documents, the longest says most
    longer = counted.select(F.expr("left(entry, size - 1)").alias("entry"), "toxic", "clean")
    best = (
        fit.join(longer, ["entry", "toxic", "clean"], "left_anti")
        .select("entry", weight.alias("weight"))
        .collect()
    )
    lexicon = Lexicon({r["entry"]: float(r["weight"]) for r in best if r["weight"] > 0})
    if lexicon.weights:
        fine = _phrases(sample, lexicon).where("clean >= 2 and clean > 4 * toxic")
        lexicon.exceptions = {r["phrase"] for r in fine.collect()}
    lexicon.coef = _curve(sample, lexicon)
    return lexicon


def _curve(sample: DataFrame, lexicon: Lexicon) -> tuple[float, float, float]:
    """Logistic curve over the two measures; three numbers for each sampled row are collected."""

    def make():
        table, automaton = fold_table(), lexicon.automaton()

        def apply(cols):
            found = [lexicon.measure(fold(t, table), automaton) for t in cols["text"].to_pylist()]
            return {"label": cols["label"], "total": [x for x, _ in found], "normed": [x for _, x in found]}

        return apply

    rows = sorted(map_texts(sample, make, "label int, total double, normed double").collect())
    x = np.array([[1.0, math.log1p(r["total"]), math.log1p(r["normed"])] for r in rows])
    y = np.array([float(r["label"]) for r in rows])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3) * len(y) / 1000 + 1e-6 * np.eye(3)
        w += np.linalg.solve(h, x.T @ (y - p) - 0.05 * len(y) / 1000 * w)
    return tuple(float(v) for v in w)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, held_out, score, predicted. A null text scores as an
    empty one, a null id is not held out; an empty table gives an empty result."""

    def make():
        table, automaton = fold_table(), lexicon.automaton()
        return lambda cols: {"id": cols["id"], "score": [lexicon.score(fold(t, table), automaton) for t in cols["text"].to_pylist()]}

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    scored = map_texts(rows, make, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, as they are, whose text scores below the threshold."""
    import pyarrow as pa

    names = docs.columns

    def make():
        table, automaton = fold_table(), lexicon.automaton()

        def apply(cols):
            fine = pa.array([lexicon.score(fold(t or "", table), automaton) < threshold for t in cols[text_col].to_pylist()])
            return {c: cols[c].filter(fine) for c in names}

        return apply

    return map_texts(docs, make, docs.schema)
