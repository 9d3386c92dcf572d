"""Byte-level BPE by recursive DuckDB queries, one database per worker.

Texts are cut in front of words, where the tokenizer's pattern always begins a piece;
each distinct cut is split by the pattern. A recursive query turns the tokens of every
piece into rows (piece, position, token), joins neighbours with the merge table and
contracts each piece's leftmost pair of least rank, until no pair is left. Ordered
aggregation then spells out ids and bytes. Spark partitions the documents; what a
task has met before is looked up, and its database ends with it.

Long pieces (runs of signs, strings without blanks) keep their tokens as rows: where
merging a pair can not bring forth a pair of lower rank (known for each entry of the
merge table from the table itself), its other occurrences in the piece would be next
anyway and are contracted in the same round.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import map_texts, text_of

#: Bytes of pieces in a query, rows its rounds may bring forth, tokens decoded in a query.
BYTES, GROWTH, DECODED = 2_000_000, 6_000_000, 1_000_000
#: Bytes that the segments a task remembers may take, and a database of its own beside; those of an executor's cores share DATABASES.
REMEMBERED, DATABASES, DATABASE = 48 << 20, 400 << 20, 120 << 20
#: Bytes that two strings and their places in a dictionary take besides their letters.
TAKES = 220
#: Pieces up to so many bytes are contracted one pair a round.
SHORT = 40
#: From one place to the next where a piece always begins, whatever lies around: at a blank in
#: front of other than white space, and at a stop or comma behind a letter or number.
CUT = re.compile(r"[\s\S](?:[^ .,]+|(?<![^\W_])[.,]| (?!\S))*")

SHORT_STEPS = """
WITH RECURSIVE step(w, toks, round) AS (
  SELECT w, toks, 0 FROM short_start
  UNION ALL
  (WITH pair AS (SELECT w, unnest(range(1, len(toks))) AS pos, unnest(toks[:-2]) AS l, unnest(toks[2:]) AS r FROM step WHERE len(toks) > 1),
        best AS (SELECT w, min(merged * 1024 + pos) AS least FROM pair JOIN merges ON key = pair.l::BIGINT * 1048576 + pair.r GROUP BY w)
   SELECT w, toks[:least % 1024 - 1] || [(least // 1024)::INT] || toks[least % 1024 + 2:], round + 1 FROM step JOIN best USING (w))
)
SELECT w, arg_max(toks, round) AS toks FROM step GROUP BY w
"""
LONG_STEPS = """
WITH RECURSIVE step(w, pos, tok, round) AS (
  SELECT w, pos, tok, 0 FROM long_start
  UNION ALL
  (WITH pair AS (SELECT w, pos, tok, round, lead(tok) OVER ahead AS nxt, row_number() OVER ahead AS i
                 FROM step WINDOW ahead AS (PARTITION BY w ORDER BY pos)),
        hit AS (SELECT p.*, m.merged, m.alone, min(m.merged) OVER (PARTITION BY w) AS least
                FROM pair p LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nxt),
        due AS (SELECT *, coalesce(merged = least, false) AS fits FROM hit WHERE least IS NOT NULL),
        nth AS (SELECT *, row_number() OVER (PARTITION BY w, fits ORDER BY i) AS k FROM due),
        go AS (SELECT *, fits AND (k = 1 OR (alone AND row_number() OVER (PARTITION BY w, fits, i - k ORDER BY i) % 2 = 1)) AS goes FROM nth),
        eat AS (SELECT *, coalesce(lag(goes) OVER (PARTITION BY w ORDER BY i), false) AS eaten FROM go)
   SELECT w, pos, CASE WHEN goes THEN merged::INT ELSE tok END, round + 1 FROM eat WHERE NOT eaten AND round < $rounds)
)
SELECT w, pos, tok, round FROM step QUALIFY round = max(round) OVER (PARTITION BY w)
"""
SPELL = """
WITH toks AS (SELECT w, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM short_done UNION ALL SELECT w, tok, pos FROM long_done)
SELECT string_agg(tok::VARCHAR, ' ' ORDER BY w::BIGINT * 4294967296 + pos) AS ids FROM toks JOIN pieces USING (w) GROUP BY segment ORDER BY segment
"""
DECODE = "SELECT w, string_agg(hex, '' ORDER BY pos) AS hex FROM given JOIN vocabulary USING (tok) GROUP BY w ORDER BY w"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def read_merges(ranks: dict[bytes, int]) -> pa.Table:
    """(l, r, merged): every way in which two tokens make a third."""
    left, right, merged = [], [], []
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                merged.append(rank)
    return pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "merged": pa.array(merged, pa.int32())})


_read: dict[str, tuple[dict[bytes, int], pa.Table]] = {}


def vocabulary(path: str) -> tuple[dict[bytes, int], pa.Table]:
    """Ranks and merges of a file, a few megabytes that a worker process reads once."""
    if path not in _read:
        ranks = read_ranks(path)
        _read[path] = ranks, read_merges(ranks)
    return _read[path]


class Encoder:
    """An in-memory database with the vocabulary, and the pieces it has met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, merges: pa.Table | None = None, memory: int = DATABASES):
        import duckdb
        import regex

        self.ranks, self.pieces = ranks, regex.compile(pattern)
        self.db = duckdb.connect()
        self.db.execute(f"SET threads = 1; SET memory_limit = '{memory >> 20}MB'; SET preserve_insertion_order = false")
        self.db.register("table_m", merges if merges is not None else read_merges(ranks))
        self.db.register("table_v", pa.table({"tok": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]}))
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM table_v")
        # a merge is alone if no merge of lower rank takes what it makes
        self.db.execute(
            """CREATE TABLE merges AS WITH uses AS (SELECT l AS tok, merged AS use FROM table_m UNION ALL SELECT r, merged FROM table_m),
            lowest AS (SELECT tok, min(use) AS use FROM uses GROUP BY tok)
            SELECT l, r, l::BIGINT * 1048576 + r AS key, merged::BIGINT AS merged, coalesce(use > merged, true) AS alone FROM table_m LEFT JOIN lowest ON tok = merged"""
        )
        self.base = np.array([ranks[bytes([k])] for k in range(256)], dtype=np.int32)
        self.ids: dict[str, str] = {}
        self.held = 0

    def close(self) -> None:
        self.ids.clear()
        self.db.close()

    def arrow(self, sql: str) -> pa.Table:
        return self.db.sql(sql).to_arrow_table()

    def contract_long(self, numbers: list[int], pieces: list[bytes]) -> pa.Table:
        """(w, pos, tok) of pieces of any length, in as many queries as their rounds take."""
        lengths = np.array([len(p) for p in pieces])
        start = pa.table({
            "w": np.repeat(np.array(numbers, np.int32), lengths),
            "pos": (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32),
            "tok": self.base[np.frombuffer(b"".join(pieces), np.uint8)],
        })
        done = []
        while start.num_rows:
            rounds = max(6, min(64, GROWTH // start.num_rows))
            self.db.register("long_start", start)
            self.db.execute("CREATE OR REPLACE TEMP TABLE reached AS " + LONG_STEPS.replace("$rounds", str(rounds)))
            # pieces that used up the rounds go on from where they are
            start = self.arrow(f"SELECT w, pos, tok FROM reached WHERE round >= {rounds}")
            done.append(self.arrow(f"SELECT w, pos, tok FROM reached WHERE round < {rounds}"))
        return pa.concat_tables(done)

    def contract(self, segments: list[list[str]]) -> pa.Table:
        """(ids, the same joined by blanks) of lists of pieces, in order."""
        raw = [p.encode("utf-8", "replace") for s in segments for p in s]
        of = np.repeat(np.arange(len(segments), dtype=np.int32), [len(s) for s in segments])
        # a piece that is a token is that token, as in the library
        whole = [self.ranks.get(p, -1) for p in raw]
        short = [w for w, t in enumerate(whole) if t < 0 and len(raw[w]) <= SHORT]
        long = [w for w, t in enumerate(whole) if t < 0 and len(raw[w]) > SHORT]
        lengths = np.fromiter((len(raw[w]) for w in short), np.int32, len(short))
        toks = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()),
            pa.array(self.base[np.frombuffer(b"".join(raw[w] for w in short), np.uint8)], pa.int32()),
        )
        known = np.array(whole, dtype=np.int32)
        at = np.flatnonzero(known >= 0)
        self.db.register("short_start", pa.table({"w": pa.array(short, pa.int32()), "toks": toks}))
        self.db.execute("CREATE OR REPLACE TEMP TABLE short_done AS " + SHORT_STEPS)
        rows = pa.table({"w": pa.array(at.astype(np.int32)), "pos": pa.array(np.zeros(len(at), np.int32)), "tok": pa.array(known[at])})
        if long:
            rows = pa.concat_tables([rows, self.contract_long(long, [raw[w] for w in long]).cast(rows.schema)])
        self.db.register("long_done", rows)
        self.db.register("pieces", pa.table({"w": pa.array(np.arange(len(raw), dtype=np.int32)), "segment": pa.array(of)}))
        return self.arrow(SPELL)

    def learn(self, segments: list[str]) -> None:
        """Encode segments not met yet."""
        at = 0
        while at < len(segments):
            end, size = at, 0
            while end < len(segments) and (end == at or size + len(segments[end]) <= BYTES):
                size += len(segments[end])
                end += 1
            part = segments[at:end]
            found = self.contract([self.pieces.findall(s) for s in part])["ids"].to_pylist()
            self.ids.update(zip(part, found, strict=True))
            self.held += sum(map(len, part)) + sum(map(len, found)) + TAKES * len(part)
            at = end

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of lists of ids, put together by ordered aggregation."""
        lengths = np.array([len(i) for i in ids], dtype=np.int64)
        of = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        toks = np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)
        parts: list[list[bytes]] = [[] for _ in ids]
        for lo in range(0, len(toks), DECODED):
            part = slice(lo, lo + DECODED)
            given = pa.table({"w": of[part], "pos": np.arange(len(of[part]), dtype=np.int32), "tok": toks[part]})
            self.db.register("given", given)
            found = self.arrow(DECODE)
            for w, text in zip(found["w"].to_pylist(), found["hex"].to_pylist(), strict=True):
                parts[w].append(bytes.fromhex(text))
        return [b"".join(p) for p in parts]

    def encode(self, texts: list[str]) -> list[tuple[str, bytes]]:
        """Ids joined by blanks and the bytes that they decode to, of each text."""
        gc.disable()  # a million live strings and no cycles: collections only cost time
        try:
            joined = self.join_ids(texts)
        finally:
            gc.enable()
        return list(zip(joined, self.decode([as_ids(j) for j in joined]), strict=True))

    def join_ids(self, texts: list[str]) -> list[str]:
        cut = [CUT.findall(t) for t in texts]
        met = set().union(*cut)
        if self.held > REMEMBERED:
            # what is met again stays, mostly words that are frequent
            self.ids = {s: i for s, i in self.ids.items() if s in met}
            self.held = sum(map(len, self.ids)) + sum(map(len, self.ids.values())) + TAKES * len(self.ids)
        self.learn(sorted(s for s in met if s not in self.ids))
        ids = self.ids.__getitem__
        return [" ".join(map(ids, c)) for c in cut]


def as_ids(joined: str) -> np.ndarray:
    return np.fromstring(joined, dtype=np.int32, sep=" ")


def in_slices(texts: list[str], size: int = 1 << 20):
    """The texts in order, in lists of about that many characters."""
    part: list[str] = []
    total = 0
    for t in texts:
        if part and total + len(t) > size:
            yield part
            part, total = [], 0
        part.append(t)
        total += len(t)
    if part:
        yield part


def encoder(path: str, pattern: str, memory: int = DATABASES) -> Encoder:
    return Encoder(vocabulary(path)[0], pattern, vocabulary(path)[1], memory)


def memory_of(docs: DataFrame) -> int:
    """What the database of one task may take, with as many tasks at a time as an executor has cores."""
    cores = int(docs.sparkSession.conf.get("spark.executor.cores", "1"))
    return max(DATABASE, DATABASES // max(cores, 1))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256, and the ids
    themselves as an array if ``with_ids``.

    ``path`` is the rank file, at the same place on every executor. A null text is an
    empty one and has no tokens; special strings are ordinary text. Repeated rows are
    encoded each. An empty table gives an empty result.
    """

    memory = memory_of(docs)

    def make():
        machine = encoder(path, pattern, memory)

        def apply(cols):
            found = [x for part in in_slices([t or "" for t in cols["text"].to_pylist()]) for x in digested(machine.encode(part))]
            out = {
                "id": cols["id"],
                "n_tokens": [f[0] for f in found],
                "ids_sha256": [f[1] for f in found],
                "decoded_sha256": [f[2] for f in found],
            }
            if with_ids:
                out["ids"] = pa.array([f[3] for f in found], pa.list_(pa.int32()))
            return out

        def digested(encoded):
            return [
                (
                    ids.count(" ") + 1 if ids else 0,
                    hashlib.sha256(ids.encode()).hexdigest(),
                    hashlib.sha256(decoded).hexdigest(),
                    as_ids(ids) if with_ids else None,
                )
                for ids, decoded in encoded
            ]

        apply.close = machine.close
        return apply

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_texts(rows, make, schema).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per document: id and text, put together from its ids by ordered aggregation."""

    memory = memory_of(tokens)

    def make():
        machine = encoder(path, pattern, memory)

        def apply(cols):
            ids = [np.array(i or [], dtype=np.int32) for i in cols["ids"].to_pylist()]
            return {"id": cols["id"], "text": [b.decode("utf-8", "replace") for b in machine.decode(ids)]}

        apply.close = machine.close
        return apply

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, make, f"id {kind}, text string").withColumnRenamed("id", id_col)
