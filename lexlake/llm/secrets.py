"""Secret scan: fixed patterns, and a battery of randomness tests with false-discovery control.

Every run of 16 or more token characters is a hypothesis. Its encoding is inferred (the
smallest alphabet that holds it); chi-squared uniformity, runs and serial correlation are
tested over that alphabet and combined by Fisher's rule. How often ordinary text of the
same length class falls into the encoding and does at least as well there is the p-value
of the run. A run is a secret if it passes the Benjamini-Hochberg limit of its encoding
and length class, taken over all runs of all documents. Random runs are rare: one that the uniform
alphabet does not explain ``ODDS`` times as well as ordinary text is not looked at further;
it counts as tested, and the p-values are those of passing both.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import map_texts, text_of
from lexlake.workspace import materialize

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # AKIA[A-Z0-9]+ of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Lengths at which classes begin; share of false discoveries allowed in each encoding and class.
CLASSES = (16, 24, 32, 48, 96)
FALSE_SHARE = 0.01
#: Odds taken against a run being random before its battery is looked at.
ODDS = 1e6
#: Share of a model's symbols from which on it is taken as wholly of an alphabet.
MOSTLY = 0.75
#: Levels of the combined battery at which ordinary text is compared; below the first a run is not random.
LEVELS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
#: Draws for each of the eleven bridges from ordinary text to the uniform alphabet.
DRAWS, BRIDGES = 200, 11
#: p-values are kept in steps of half a power of ten, rounded up; the last step is open.
STEPS = 80

ALPHABETS = (
    "0123456789",
    "0123456789abcdef",
    "0123456789ABCDEF",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=",
)
_SETS = [frozenset(a) for a in ALPHABETS]

# Letters of European prose by frequency, in tenths of a percent.
LETTERS = dict(zip("etaoinsrhldcumfpgwybvkxjqz", (120, 85, 80, 72, 72, 72, 65, 65, 45, 42, 40, 30, 30, 26, 21, 20, 20, 19, 18, 15, 11, 8, 4, 3, 3, 3), strict=True))


def _models() -> np.ndarray:
    """Log chances of a byte in ordinary runs: prose, capitals, numbers, names with signs."""
    total = sum(LETTERS.values())
    out = np.full((4, 128), math.log(1e-4))
    for c, n in LETTERS.items():
        share = n / total
        out[0, ord(c)], out[0, ord(c.upper())] = math.log(0.93 * share), math.log(0.04 * share)
        out[1, ord(c.upper())], out[1, ord(c)] = math.log(0.93 * share), math.log(0.04 * share)
        out[2, ord(c)], out[2, ord(c.upper())] = math.log(0.04 * share), math.log(0.04 * share)
        out[3, ord(c)], out[3, ord(c.upper())] = math.log(0.62 * share), math.log(0.16 * share)
    for c in "0123456789":
        out[0, ord(c)] = out[1, ord(c)] = math.log(0.002)
        out[2, ord(c)] = math.log(0.088)
        out[3, ord(c)] = math.log(0.007)
    for c in "+/_=-":
        out[0, ord(c)] = out[1, ord(c)] = math.log(0.002)
        out[2, ord(c)] = math.log(0.008)
        out[3, ord(c)] = math.log(0.03)
    return out


_MODELS = _models()
#: Symbols in the order of their use in names, so that neighbours in it are alike in ordinary text.
_ORDERS = [np.array(sorted(map(ord, a), key=lambda c: (-_MODELS[3, c], c))) for a in ALPHABETS]
_PLACES = [{chr(c): i for i, c in enumerate(o)} for o in _ORDERS]

_erfc = np.vectorize(math.erfc, otypes=[float])


def _tail(z: np.ndarray) -> np.ndarray:
    return 0.5 * _erfc(z / math.sqrt(2))


def chi_squared(x: np.ndarray, size: int, least: int) -> np.ndarray:
    """p-values of equal use of the alphabet, one for each row of ``x``; symbols are taken in
    two to eight groups, as many as runs of the ``least`` length fill."""
    groups = max(2, min(8, least // 5, size))
    n = x.shape[1]
    group = x * groups // size
    share = np.bincount(np.arange(size) * groups // size, minlength=groups) / size
    stat = sum(((group == g).sum(axis=1) - n * share[g]) ** 2 / (n * share[g]) for g in range(groups))
    free = groups - 1
    return _tail(((stat / free) ** (1 / 3) - (1 - 2 / (9 * free))) / math.sqrt(2 / (9 * free)))


def runs(x: np.ndarray, size: int) -> np.ndarray:
    """p-values of the number of runs in the upper and the lower half of the alphabet."""
    high = x * 2 >= size
    n = x.shape[1]
    a = high.sum(axis=1).astype(float)
    b = n - a
    found = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + 2 * a * b / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    p = np.where(var > 0, 2 * _tail(np.abs(found - mean) / np.sqrt(np.where(var > 0, var, 1.0))), 1.0)
    return np.where((a == 0) | (b == 0), 2.0 ** (1 - n), p)


def serial(x: np.ndarray) -> np.ndarray:
    """p-values of the correlation of a symbol with the next."""
    n = x.shape[1]
    y = x - x.mean(axis=1, keepdims=True)
    total = (y * y).sum(axis=1)
    ratio = (y[:, 1:] * y[:, :-1]).sum(axis=1) / np.where(total > 0, total, 1.0)
    return np.where(total > 0, 2 * _tail(np.abs(ratio + 1 / n) * math.sqrt(n)), 0.0)


def battery(x: np.ndarray, size: int, least: int) -> np.ndarray:
    """The three p-values of each row combined by Fisher's rule: equal on 0 to 1 for random runs."""
    h = -sum(np.log(np.clip(p, 1e-300, 1.0)) for p in (chi_squared(x, size, least), runs(x, size), serial(x)))
    return np.exp(-h) * (1 + h + h * h / 2)


def alphabet_of(run: str) -> int:
    chars = set(run)
    return next(k for k, s in enumerate(_SETS) if chars <= s)


def passes(explained: np.ndarray | float, length: np.ndarray | int, size: int):
    """Whether the uniform alphabet explains a run so much better than ordinary text does."""
    return -length * math.log(size) - explained > math.log(ODDS)


def ordinary_tail(alphabet: int, least: int) -> list[float]:
    """For each level, how often ordinary text of this length is of this alphabet, passes the odds and reaches it.

    Rare events need draws that look random, frequent ones draws that look ordinary, so
    symbols are drawn from bridges between both and weighted back (balance heuristic). Of
    the models of ordinary text the one that reaches a level most often counts; a model
    that is mostly of the alphabet is taken as wholly of it. Decimal numbers prove nothing.
    """
    order = _ORDERS[alphabet]
    rng = np.random.default_rng(alphabet * 1000 + least)
    size, out = len(order), np.zeros(len(LEVELS))
    if size <= 10:
        return [1.0] * len(LEVELS)
    for model in _MODELS:
        plain = model[order]
        mass = float(np.exp(plain).sum())
        plain = plain - math.log(mass)
        inside = mass**least if mass < MOSTLY else 1.0
        bridges = (1 - np.linspace(0, 1, BRIDGES))[:, None] * plain
        bridges -= np.log(np.exp(bridges).sum(axis=1, keepdims=True))
        x = np.concatenate([rng.choice(len(order), (DRAWS, least), p=np.exp(b)) for b in bridges])
        chance = np.stack([b[x].sum(axis=1) for b in bridges])
        top = chance.max(axis=0)
        weight = np.exp(plain[x].sum(axis=1) - top - np.log(np.exp(chance - top).mean(axis=0)))
        explained = np.max([m[order][x].sum(axis=1) for m in _MODELS], axis=0)
        reached = np.where(passes(explained, least, size), battery(x, size, least), -1.0)
        out = np.maximum(out, [inside * float((weight * (reached >= level)).mean()) for level in LEVELS])
    return np.where(out > 0, np.minimum(out, 1.0), 1.0).tolist()  # a level that no draw reached proves nothing


@functools.lru_cache(maxsize=1)
def calibration() -> list[list[int]]:
    """By alphabet and length class, the p-value step of each level (0: no evidence)."""
    tails = [ordinary_tail(a, least) for a in range(len(ALPHABETS)) for least in CLASSES]
    return [[max(0, min(STEPS, int(-2 * math.log10(max(p, 1e-300))))) for p in tail] for tail in tails]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def hypotheses(texts: list[str], steps: list[list[int]]) -> tuple[list[list[tuple[int, int, int, int]]], np.ndarray]:
    """For each text its runs that may be random (start, end, cell, step); runs tested by text and length class.

    A cell is an encoding and a length class; ``steps`` is the calibration.
    """
    found = [(d, m.start(), m.group()) for d, t in enumerate(texts) for m in RUN.finditer(t)]
    tested = np.zeros((len(texts), len(CLASSES)), dtype=np.int64)
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    if not found:
        return out, tested
    lengths = np.array([len(r) for _, _, r in found])
    classes = np.searchsorted(CLASSES, lengths, side="right") - 1
    np.add.at(tested, (np.array([d for d, _, _ in found]), classes), 1)
    data = np.frombuffer("".join(r for _, _, r in found).encode("ascii"), dtype=np.uint8)
    plain = np.maximum.reduce([np.add.reduceat(m[data], np.cumsum(lengths) - lengths) for m in _MODELS])
    # no alphabet is smaller than ten symbols: runs that fail even with it need no closer look
    for i in np.flatnonzero(passes(plain, lengths, 10)):
        d, start, run = found[i]
        alphabet, k = alphabet_of(run), int(classes[i])
        size, cell = len(ALPHABETS[alphabet]), alphabet * len(CLASSES) + k
        if not passes(plain[i], len(run), size):
            continue
        place = _PLACES[alphabet]
        reached = float(battery(np.array([[place[c] for c in run]]), size, CLASSES[k])[0])
        level = int(np.searchsorted(LEVELS, reached, side="right")) - 1
        if level >= 0 and steps[cell][level] > 0:
            out[d].append((start, start + len(run), cell, steps[cell][level]))
    return out, tested


def limits(tested: dict[int, int], found: dict[tuple[int, int], int], share: float = FALSE_SHARE) -> dict[int, int]:
    """By cell, from the runs tested by length class and those found by cell and step, the least step at which runs are discoveries (beyond the last step if none are)."""
    out = {}
    for cell in range(len(ALPHABETS) * len(CLASSES)):
        out[cell], above = STEPS + 1, 0
        for step in range(STEPS, 0, -1):
            above += found.get((cell, step), 0)
            if above and 10 ** (-step / 2) <= share * above / max(1, tested.get(cell % len(CLASSES), 0)):
                out[cell] = step
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans count code points of the whole text, ends exclusive. Runs inside a base span
    are not given again. A null text has no spans. Rows that repeat are scanned each by
    itself. An empty table gives an empty result. The limits come from two small counts
    over all documents (one row for each encoding, length class and step).
    """
    levels = calibration()

    def make():
        def apply(cols):
            texts = [t or "" for t in cols["text"].to_pylist()]
            base = [base_spans(t) for t in texts]
            random, tested = hypotheses(texts, levels)
            free = [[r for r in rs if not any(s <= r[0] and r[1] <= e for s, _, e in bs)] for rs, bs in zip(random, base, strict=True)]
            return {
                "id": cols["id"],
                **{f"n_{KINDS[k]}": [sum(x[1] == k for x in b) for b in base] for k in range(3)},
                "base_sha256": [hashlib.sha256(joined(b).encode()).hexdigest() for b in base],
                "base": [[{"start": s, "kind": k, "end": e} for s, k, e in b] for b in base],
                "random": [[{"start": s, "kind": 3, "end": e, "cell": c, "step": p} for s, e, c, p in f] for f in free],
                "steps": [[{"cell": c, "step": p} for _, _, c, p in r] for r in random],
                "tested": tested.tolist(),
            }

        return apply

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    span = "start: int, kind: int, end: int"
    schema = (
        f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, base array<struct<{span}>>, "
        f"random array<struct<{span}, cell: int, step: int>>, steps array<struct<cell: int, step: int>>, tested array<long>"
    )
    first = materialize(map_texts(rows, make, schema), "secrets")
    totals = first.select(F.posexplode("tested").alias("class", "n")).groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = first.select(F.explode("steps").alias("s")).groupBy("s.cell", "s.step").count().collect()
    least = limits({r["class"]: r["n"] for r in totals}, {(r["cell"], r["step"]): r["count"] for r in counts})
    bound = F.array(*(F.lit(least[k]) for k in range(len(least))))
    added = F.filter("random", lambda r: r["step"] >= F.get(bound, r["cell"]))
    plain = F.transform(added, lambda r: F.struct(r["start"].alias("start"), r["kind"].alias("kind"), r["end"].alias("end")))
    spans = F.sort_array(F.concat("base", plain))
    names = F.array(*map(F.lit, KINDS))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    return first.select(F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"))
