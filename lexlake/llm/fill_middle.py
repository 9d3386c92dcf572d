"""Fill-in-middle by displacement scatter.

The texts of a batch lie end to end in one byte array. A scan over the starts of code
points turns the cuts of each text into byte places. Differences at those places add up
to the shift of every byte, and one scatter writes all outputs of the batch; the inverse
gather builds the texts again from the outputs alone. Both go through the bytes in
slices, so that a very long text takes no more memory than a short one beside itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexlake.llm.common import layout, map_texts, text_of

#: Marks of the parts, three bytes each; shares out of 100 left plain and written suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
#: Bytes gone through at once.
SLICE = 1 << 20
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ["plain", "psm", "spm"]


def slices(size: int) -> Iterator[tuple[int, int]]:
    for lo in range(0, size, SLICE):
        yield lo, min(lo + SLICE, size)


def char_starts(data: np.ndarray) -> np.ndarray:
    """Code points that begin before each slice of the data; the last entry is their number."""
    counts = [int(np.count_nonzero((data[lo:hi] & 0xC0) != 0x80)) for lo, hi in slices(len(data))]
    return np.cumsum([0, *counts])


def byte_of(data: np.ndarray, before: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Byte where the given code points of the whole array begin; one past the last is its end."""
    out = np.full(len(chars), len(data), dtype=np.int64)
    home = np.searchsorted(before, chars, side="right") - 1
    for k, (lo, hi) in enumerate(slices(len(data))):
        here = np.flatnonzero(home == k)
        if len(here):
            starts = np.flatnonzero((data[lo:hi] & 0xC0) != 0x80)
            out[here] = lo + starts[chars[here] - before[k]]
    return out


def chars_before(data: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points that begin before the given bytes."""
    out = np.full(len(at), before[-1], dtype=np.int64)
    for k, (lo, hi) in enumerate(slices(len(data))):
        here = np.flatnonzero((at >= lo) & (at < hi))
        if len(here):
            seen = np.concatenate([[0], np.cumsum((data[lo:hi] & 0xC0) != 0x80)])
            out[here] = before[k] + seen[at[here] - lo]
    return out


def marks(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes where a mark stands inside one text, and the text it is in."""
    found = []
    for lo, hi in slices(len(data)):
        part = data[lo : hi + 2]
        at = np.flatnonzero((part[:-2] == PREFIX[0]) & (part[2:] == PREFIX[2])) if len(part) > 2 else np.zeros(0, np.int64)
        kind = part[at + 1]
        found.append(lo + at[(kind == PREFIX[1]) | (kind == SUFFIX[1]) | (kind == MIDDLE[1])])
    at = np.concatenate([np.zeros(0, np.int64), *found])
    text = np.searchsorted(begins, at, side="right") - 1
    inside = at + 3 <= begins[text + 1]
    return at[inside], text[inside]


def shifts(where: np.ndarray, by: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lo, hi, shift of each byte): from byte ``where[i]`` on the shift is ``by[i]``.

    ``where`` does not fall. Its steps go into a difference array, whose running sum
    is the shift; the sum is carried from slice to slice.
    """
    steps, carry = np.diff(by, prepend=0), 0
    for lo, hi in slices(size):
        a, b = np.searchsorted(where, [lo, hi])
        diff = np.zeros(hi - lo, dtype=np.int64)
        np.add.at(diff, where[a:b] - lo, steps[a:b])
        diff[0] += carry
        shift = np.cumsum(diff)
        carry = int(shift[-1])
        yield lo, hi, shift


def transform(data: np.ndarray, begins: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Outputs of the texts, where each begins, and their figures.

    ``draws`` has four columns: two cuts, plain or not, order of the parts.
    """
    before = char_starts(data)
    first = chars_before(data, before, begins)
    n = np.diff(first)
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    form = np.where(draws[:, 3] % 100 < SUFFIX_FIRST_BELOW, SPM, PSM)
    form[(n == 0) | (draws[:, 2] % 100 >= PLAIN_FROM)] = PLAIN
    form[marks(data, begins)[1]] = PLAIN
    start, end = begins[:-1], begins[1:]
    one, two = (byte_of(data, before, first[:-1] + cuts[:, i]) for i in (0, 1))
    cut = form != PLAIN
    one, two = np.where(cut, one, end), np.where(cut, two, end)
    pre, mid, suf = one - start, two - one, end - two
    ends = np.cumsum(end - start + 9 * cut)
    out_begins = np.concatenate([[0], ends])
    base = out_begins[:-1]
    spm, psm = form == SPM, form == PSM
    to_pre = base + np.where(psm, 3, 0) + np.where(spm, 6 + suf, 0)
    to_suf = base + np.where(psm, 6 + pre, np.where(spm, 3, pre))
    to_mid = base + np.where(cut, 9 + pre + suf, pre)
    where = np.stack([start, one, two], axis=1).ravel()
    by = np.stack([to_pre - start, to_mid - one, to_suf - two], axis=1).ravel()
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for lo, hi, shift in shifts(where, by, len(data)):
        out[np.arange(lo, hi) + shift] = data[lo:hi]
    for mark, at in ((PREFIX, to_pre - 3), (SUFFIX, to_suf - 3), (MIDDLE, to_mid - 3)):
        for k, byte in enumerate(mark):
            out[at[cut] + k] = byte
    return out, out_begins, {"n": n, "form": form, "prefix_chars": cuts[:, 0], "middle_chars": cuts[:, 1] - cuts[:, 0]}


def restore(data: np.ndarray, begins: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts built again from outputs and forms, and where each begins.

    An output that is not plain holds its three marks and no others; their places give
    the parts, and every byte of a text is gathered from its place in the output.
    """
    at, text = marks(data, begins)
    at = at[form[text] != PLAIN].reshape(-1, 3)
    cut = form != PLAIN
    start, end = begins[:-1], begins[1:]
    pre, mid, suf = (end - start).copy(), np.zeros_like(start), np.zeros_like(start)
    from_pre, from_mid, from_suf = start.copy(), end.copy(), end.copy()
    for kind, (p, s) in ((PSM, (0, 1)), (SPM, (1, 0))):
        rows = form[cut] == kind
        own = np.flatnonzero(form == kind)
        a, stop = at[rows], end[own]
        from_pre[own], from_suf[own], from_mid[own] = a[:, p] + 3, a[:, s] + 3, a[:, 2] + 3
        pre[own] = a[:, p + 1] - a[:, p] - 3
        suf[own] = a[:, s + 1] - a[:, s] - 3
        mid[own] = stop - a[:, 2] - 3
    ends = np.cumsum(pre + mid + suf)
    text_begins = np.concatenate([[0], ends])
    base = text_begins[:-1]
    where = np.stack([base, base + pre, base + pre + mid], axis=1).ravel()
    by = np.stack([from_pre - base, from_mid - base - pre, from_suf - base - pre - mid], axis=1).ravel()
    size = int(ends[-1]) if len(ends) else 0
    out = np.empty(size, dtype=np.uint8)
    for lo, hi, shift in shifts(where, by, size):
        out[lo:hi] = data[np.arange(lo, hi) + shift]
    return out, text_begins


def as_texts(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(begins, dtype=np.int32)), pa.py_buffer(data)]
    return pa.StringArray.from_buffers(len(begins) - 1, buffers[1], buffers[2])


def digests(data: np.ndarray, begins: np.ndarray) -> list[str]:
    whole = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(whole[a:b]).hexdigest() for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]


def seeds(id_col: str):
    """The four draws of a document: the first four groups of eight hex digits of a SHA-256."""
    sha = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.array(*(F.conv(F.substring(sha, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests_only: bool = False) -> DataFrame:
    """One row per document: id, n (code points), form, prefix_chars, middle_chars, and
    the output; with ``digests_only`` its SHA-256 and that of the text restored from it.

    A null text counts as empty and, like a text that holds a mark, stays plain; so does
    about a tenth of the others. Cuts, and thus the output, follow from id and text:
    repeated rows and reruns give the same; a null id draws like an empty one. An empty
    table gives an empty result. Further columns are not looked at.
    """

    def make():
        def apply(cols):
            data, begins = layout(cols["text"])
            draws = cols["draws"].flatten().to_numpy().reshape(-1, 4)
            out, out_begins, figures = transform(data, begins, draws)
            plain = figures["form"] == PLAIN
            result = {"id": cols["id"], "n": pa.array(figures["n"]), "form": [FORMS[k] for k in figures["form"]]}
            result |= {k: pa.array(figures[k], mask=plain) for k in ("prefix_chars", "middle_chars")}
            if digests_only:
                result["output_sha256"] = digests(out, out_begins)
                result["restored_sha256"] = digests(*restore(out, out_begins, figures["form"]))
            else:
                result["output"] = as_texts(out, out_begins)
            return result

        return apply

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{text_col}`").alias("text"), seeds(f"`{id_col}`").alias("draws"))
    kind = rows.schema["id"].dataType.simpleString()
    end = "output_sha256 string, restored_sha256 string" if digests_only else "output string"
    done = map_texts(rows, make, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, {end}")
    return done.withColumnRenamed("id", id_col)


def restore_texts(rows: DataFrame, id_col: str = "doc_id", output_col: str = "output", form_col: str = "form") -> DataFrame:
    """(id, text) from the outputs and forms of ``fill_in_middle``; a null output gives an empty text."""

    def make():
        def apply(cols):
            form = np.array([FORMS.index(f or "plain") for f in cols["form"].to_pylist()], dtype=np.int64)
            return {"id": cols["id"], "text": as_texts(*restore(*layout(cols["output"]), form))}

        return apply

    given = rows.select(F.col(f"`{id_col}`").alias("id"), text_of(f"`{output_col}`").alias("output"), F.col(f"`{form_col}`").alias("form"))
    kind = given.schema["id"].dataType.simpleString()
    return map_texts(given, make, f"id {kind}, text string").withColumnRenamed("id", id_col)


ORACLE = """
WITH given AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, t, length(t) AS n,
                 ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
                 ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM given),
cut AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1, n - b) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
