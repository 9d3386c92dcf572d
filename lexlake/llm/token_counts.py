"""Token counts by a tokenizer compiled to finite-state transducers.

The vocabulary is read as a trie over bytes, the last byte of a word being a symbol of
its own. Two tokens may stand side by side only if no merge across their border would
come first; so of all ways to cut a word into tokens, one is left. A state of the word
transducer is the set of cuts still open: the last whole token and the place in the
trie of the next one. States are made when first reached; each transition carries the
number of tokens that it emits, and is computed once in a worker. A second machine over
character classes cuts text into words.

A text is read in chunks. White space resets the machine, so the state map of a chunk is
constant behind its first blank: it is held as (text up to there, tokens in between,
text behind the last one), and the maps of a text's chunks compose pairwise.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import map_texts, text_of

#: Characters of a chunk; words and transitions a worker remembers at most; tokens over which a text is long.
CHUNK, REMEMBERED, TRANSITIONS, LIMIT = 1 << 16, 700_000, 1_500_000, 2048
#: White space as the library sees it; Python's own split also takes the four separators below a blank.
BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"
SPLIT = re.compile(f"[{BLANK}]+")
ODD = re.compile("[\x1c-\x1f]")
# What an apostrophe takes along.
CLITICS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in the vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}


class WordTransducer:
    """Counts the tokens of a word given as bytes."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        letter = byte_letters()
        symbol = {c: b for b, c in letter.items()} | {c + suffix: 256 + b for b, c in letter.items()}
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.made = {a + b: (a, b) for a, b in merges}
        self.names: list[str] = []
        self.next: list[dict[int, int]] = [{}]  # trie
        self.token: list[int] = [-1]
        for name in vocabulary:
            core, end = (name[: -len(suffix)], True) if name.endswith(suffix) and len(name) > len(suffix) else (name, False)
            if not all(c in symbol for c in core):
                continue
            parts = [symbol[c] + (256 if end and i == len(core) - 1 else 0) for i, c in enumerate(core)]
            node = 0
            for s in parts:
                if s not in self.next[node]:
                    self.next[node][s] = len(self.next)
                    self.next.append({})
                    self.token.append(-1)
                node = self.next[node][s]
            self.token[node] = len(self.names)
            self.names.append(name)
        self.edges: dict[int, tuple[list, list]] = {}
        self.side: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states and transitions; they are made again as needed."""
        start = ((-1, 0, 0),)
        self.states, self.number = [start], {start: 0}
        self.arcs: dict[int, tuple[int, int]] = {}

    def border(self, t: int) -> tuple[list, list]:
        """Nodes on the right and on the left edge of a token's merge tree, each with the rank of the merge that ends it."""
        if t not in self.edges:
            out = []
            for side in (1, 0):
                name, ends, nodes = self.names[t], float("inf"), []
                while True:
                    nodes.append((name, ends))
                    pair = self.made.get(name)
                    if pair is None:
                        break
                    name, ends = pair[side], self.rank[pair]
                out.append(nodes)
            self.edges[t] = out[0], out[1]
        return self.edges[t]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether token ``b`` may stand behind ``a``: no merge across comes before those that made them."""
        key = a << 20 | b
        if key not in self.side:
            rank = self.rank
            self.side[key] = not any(
                (r := rank.get((x, y))) is not None and r < x_ends and r <= y_ends for x, x_ends in self.border(a)[0] for y, y_ends in self.border(b)[1]
            )
        return self.side[key]

    def move(self, state: int, symbol: int) -> tuple[int, int]:
        """(next state, tokens emitted). A cut in the state is (last token, place in the trie, tokens so far over the least)."""
        opened, ended = [], []
        for last, node, count in self.states[state]:
            to = self.next[node].get(symbol)
            if to is None:
                continue
            if self.next[to]:
                opened.append((last, to, count))
            t = self.token[to]
            if t >= 0 and (last < 0 or self.may_follow(last, t)):
                ended.append((t, 0, count + 1))
        if symbol >= 256:
            if len(ended) != 1:
                raise ValueError("a word has no tokens in this vocabulary")
            arc = 0, ended[0][2]
        else:
            cuts = opened + ended
            least = min(c for _, _, c in cuts)
            new = tuple(sorted((a, n, c - least) for a, n, c in cuts))
            if new not in self.number:
                self.number[new] = len(self.states)
                self.states.append(new)
            arc = self.number[new], least
        self.arcs[state << 9 | symbol] = arc
        return arc

    def count(self, word: bytes) -> int:
        if len(self.arcs) > TRANSITIONS:
            self.reset()
            self.side.clear()
        state, total, arcs = 0, 0, self.arcs
        for b in word[:-1]:
            state, n = arcs.get(state << 9 | b) or self.move(state, b)
            total += n
        b = 256 + word[-1]
        return total + (arcs.get(state << 9 | b) or self.move(state, b))[1]


class Counter:
    """Token counts of whole texts as the library gives them for this vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.words = WordTransducer(model["vocab"], pairs, model["end_of_word_suffix"])
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.classes: dict[str, str] = {}
        self.known: dict[str, int] = {"": 0}

    def class_of(self, ch: str) -> str:
        kind = self.classes.get(ch)
        if kind is None:
            kind = self.classes[ch] = {"L": "L", "N": "N"}.get(unicodedata.category(ch)[0], "O")
        return kind

    def words_of(self, text: str):
        """The words of a text without white space, by a machine over character classes."""
        at, n, class_of = 0, len(text), self.class_of
        while at < n:
            end = at + 1
            if text[at] == "'" and (took := next((c for c in CLITICS if text.startswith(c, at)), "")):
                end = at + len(took)
            elif (kind := class_of(text[at])) != "N":
                while end < n and class_of(text[end]) == kind:
                    end += 1
            yield text[at:end]
            at = end

    def plain(self, text: str) -> int:
        """Tokens of a piece of text without white space and special strings."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case by character, no final sigma
        count = self.words.count
        return sum(count(w.encode("utf-8", "replace")) for w in self.words_of(text.lower()))

    def segment(self, text: str) -> int:
        """Tokens of a run without white space; special strings are tokens."""
        n = self.known.get(text)
        if n is None:
            if self.special and "<|" in text:
                n = sum(1 if i % 2 else self.plain(p) for i, p in enumerate(self.special.split(text)) if p)
            else:
                n = self.plain(text)
            self.known[text] = n
        return n

    def chunk_map(self, text: str) -> tuple[str, int | None, str]:
        """(head, tokens, tail) of a chunk; a chunk without white space is all head, with None."""
        parts = SPLIT.split(text) if ODD.search(text) else None
        if parts is None:
            if not (parts := text.split()):
                return ("", 0, "") if text else ("", None, "")
            parts = [""] * text[0].isspace() + parts + [""] * text[-1].isspace()
        if len(parts) == 1:
            return parts[0], None, ""
        known = self.known
        middle = parts[1:-1]
        try:
            total = sum(map(known.__getitem__, middle))
        except KeyError:
            for s in middle:
                if s not in known:
                    self.segment(s)
            total = sum(map(known.__getitem__, middle))
        return parts[0], total, parts[-1]

    def compose(self, a, b):
        """The map of two chunks, one behind the other."""
        if a[1] is None:
            return a[0] + b[0], b[1], b[2]
        if b[1] is None:
            return a[0], a[1], a[2] + b[0]
        return a[0], a[1] + self.segment(a[2] + b[0]) + b[1], b[2]

    def count(self, text: str) -> int:
        if len(self.known) > REMEMBERED:
            self.known = {"": 0}
        maps = [self.chunk_map(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)] or [("", None, "")]
        while len(maps) > 1:
            paired = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
            maps = paired + maps[len(maps) - len(maps) % 2 :]
        head, total, tail = maps[0]
        return self.segment(head) + (total or 0) + self.segment(tail)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this worker process for a vocabulary file."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit.

    ``path`` is the vocabulary file, at the same place on every executor. A null text
    has no bytes and no tokens. Repeated rows are counted each; an empty table gives an
    empty result. No special tokens are added; special strings inside a text are one
    token each.
    """

    def make():
        machine = counter(path)

        def apply(cols):
            gc.disable()
            try:
                return {"id": cols["id"], "n_bytes": cols["n_bytes"], "n_tokens": [machine.count(t) for t in cols["text"].to_pylist()]}
            finally:
                gc.enable()

        return apply

    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text_of(text_col)).cast("long").alias("n_bytes"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counted = map_texts(rows, make, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
