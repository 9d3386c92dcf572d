"""Fill-in-middle against strings cut by hand."""

import hashlib
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import sf_dir, spark  # noqa: E402,F401

from lexlake.llm import fill_middle as fim  # noqa: E402
from lexlake.llm.common import documents  # noqa: E402

SCHEMA = "doc_id long, text string, id int, n int, form string, output string, draws int"


def by_hand(text, doc_id):
    sha = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(sha[8 * k : 8 * k + 8], 16) for k in range(4)]
    text, n = text or "", len(text or "")
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    rng = random.Random(3)
    some = ["".join(rng.choice("ab<PSM>é世🙂\n") for _ in range(rng.choice([1, 2, 3, 9, 40]))) for _ in range(300)]
    return [None, "", "<", "<P", "<P>", "a<S>b", "<<M>>", "é", "🙂" * 5, "same", "same", "word é " * 200_000, *some]


@pytest.fixture(scope="module")
def odd():
    return list(enumerate(odd_texts())) + [(None, "no id here"), (9, "same"), (9, "same")]


def table(spark, rows):  # noqa: F811
    return spark.createDataFrame([(i, t, 1, 2, "x", "y", 3) for i, t in rows], SCHEMA)


def test_outputs_and_restored_texts(spark, odd):  # noqa: F811
    made = fim.fill_in_middle(table(spark, odd))
    got = sorted((r.doc_id is None, r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect())
    assert got == sorted((i is None, i, *by_hand(t, i)) for i, t in odd)
    assert {r[3] for r in got} == {"plain", "psm", "spm"}
    back = fim.restore_texts(made)
    assert sorted(map(str, back.collect())) == sorted(map(str, [type(back.first())(doc_id=i, text=t or "") for i, t in odd]))


def test_digests(spark, odd):  # noqa: F811
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = fim.fill_in_middle(table(spark, odd), digests_only=True).collect()
    want = sorted(str((i, sha(by_hand(t, i)[4]), sha(t or ""))) for i, t in odd)
    assert sorted(str((r.doc_id, r.output_sha256, r.restored_sha256)) for r in got) == want


def test_slices_do_not_matter(monkeypatch):
    texts, rng = [t or "" for t in odd_texts() if not t or len(t) < 100], np.random.default_rng(1)
    draws = rng.integers(0, 1 << 32, (len(texts), 4))
    whole = fim.transform(*fim.layout(pa.array(texts)), draws)
    for size in (1, 5, 64):
        monkeypatch.setattr(fim, "SLICE", size)
        out, begins, figures = fim.transform(*fim.layout(pa.array(["x", *texts])[1:]), draws)
        assert out.tobytes() == whole[0].tobytes() and (begins == whole[1]).all()
        assert all((figures[k] == whole[2][k]).all() for k in figures)
        text, at = fim.restore(out, begins, figures["form"])
        assert [bytes(text[a:b]).decode() for a, b in zip(at[:-1], at[1:], strict=True)] == texts


def test_empty_table(spark):  # noqa: F811
    assert fim.fill_in_middle(table(spark, [])).collect() == []
    assert fim.restore_texts(fim.fill_in_middle(table(spark, []))).collect() == []


def test_documents(spark, sf_dir):  # noqa: F811
    docs = documents(spark, sf_dir)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in fim.fill_in_middle(docs).collect()}
    assert got == {i: by_hand(t, i) for i, t in rows}
