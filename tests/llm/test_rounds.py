"""Scores of equal texts, clashing names, long texts, and the stages of the pipeline by brute force."""

import collections
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import sf_dir, spark  # noqa: E402,F401

import corpus_pipeline  # noqa: E402
from lexlake.llm import bpe, mixing, near_dedup, quality, resharding, toxicity  # noqa: E402
from lexlake.llm.common import documents, fresh, layout  # noqa: E402
from lexlake.workspace import materialize  # noqa: E402


def test_equal_texts_score_equal_in_any_order():
    rng = random.Random(1)
    net = quality.ByteNet(2)
    texts = ["".join(rng.choice("abcdefg é\n") for _ in range(rng.choice([0, 1, 500, 512, 1016, 1020, 3000]))) for _ in range(120)]
    texts += texts[:40] + [texts[5] * 300]
    first = dict(zip(texts, net.score(texts), strict=True))
    for seed in range(3):
        order = random.Random(seed).sample(texts, len(texts))
        assert net.score(order) == [first[t] for t in order]
    assert net.score([texts[-1]]) == [first[texts[-1]]]


def test_long_texts_score_in_steps(monkeypatch):
    net, text = quality.ByteNet(2), "some words of a text " * 3000
    whole = net.score([text, "short"])
    monkeypatch.setattr(quality, "STEP", 7)
    assert net.score([text, "short"]) == whole


def test_layout_of_a_sliced_batch():
    texts = pa.array(["no", "é", "", None, "abc"])
    data, begins = layout(texts.slice(1, 4))
    assert [bytes(data[a:b]).decode() for a, b in zip(begins[:-1], begins[1:], strict=True)] == ["é", "", "", "abc"]


def test_fresh_names():
    assert fresh(["a", "__X", "___x"], "__x", "b", "b") == ["____x", "b", "_b"]


def test_letters_of_other_scripts_are_kept():
    table = toxicity.fold_table()
    assert toxicity.fold("ばか ПЛОХОЙ", table) == toxicity.fold("ばか плохой", table)
    assert toxicity.fold("ば か", table).split() != toxicity.fold("ね こ", table).split()
    assert toxicity.fold("id\U000e0001iot", table) == " idiot "
    assert len({toxicity.fold(c, table) for c in "한학국군"}) == 4
    lexicon = toxicity.Lexicon({toxicity.fold("ばか", table).strip(): 5.0})
    assert lexicon.measure(toxicity.fold("この ばかもの", table), lexicon.automaton())[0] == 5.0


def test_the_fit_takes_whole_long_texts_and_rare_labels(spark):  # noqa: F811
    from lexlake.llm.common import sample_texts

    rows = [(i, "w " * (200_000 if i == 1 else 3), int(i < 40)) for i in range(2000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = sample_texts(docs, labels, "toxic", 200).collect()
    count = collections.Counter(r.label for r in got)
    assert len(got) == 200 and count[1] == 20
    assert {r.doc_id: len(r.text) for r in sample_texts(docs, labels, "toxic", 5000).collect()}[1] == 400_000


def test_decoded_bytes_come_from_the_ids():
    import public_tokenizers as P

    path = P.path("byte_bpe_50k.tiktoken")
    machine = bpe.encoder(path, P.PATTERN)
    text = "Some words, 12 of them: ééé 世界 🙂\n\n  end"
    (ids, back), (none, empty) = machine.encode([text, ""])
    assert back == text.encode() and (none, empty) == ("", b"")
    # a wrong id shows in the decoded bytes
    wrong = bpe.as_ids(ids)
    wrong[0] += 1
    assert machine.decode([wrong])[0] != text.encode()
    machine.close()


def test_decoding_goes_on_over_the_end_of_a_query(monkeypatch):
    import public_tokenizers as P

    monkeypatch.setattr(bpe, "DECODED", 5)
    machine = bpe.encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    texts = ["a longer text than five tokens, by far", "", "b", "and another one that is long enough"]
    assert [b for _, b in machine.encode(texts)] == [t.encode() for t in texts]
    machine.close()


def test_remembered_segments_are_bounded(monkeypatch):
    import public_tokenizers as P

    monkeypatch.setattr(bpe, "REMEMBERED", 5000)
    machine = bpe.encoder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    for k in range(20):
        assert machine.encode([f"w{k}x{i} " * 3 for i in range(20)])[0][1] == f"w{k}x0 ".encode() * 3
        assert machine.held < 5000 + 20_000
    machine.close()


# --- clashing names ----------------------------------------------------------------------

CLASH = "doc_id long, text string, lang string, source string, n_chars long, __shard int, __task int, __id long, __h long, __size long, __at long, __old int, __new int"


@pytest.fixture(scope="module")
def clashing(spark):  # noqa: F811
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 5) for _ in range(rng.randrange(0, 80))) for _ in range(60)]
    texts += [texts[3], None, "", texts[4] + " more"]
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", 0, 7, 7, 7, 7, 7, 7, 7, 7) for i, t in enumerate(texts)], CLASH)


def test_names_that_clash(clashing):
    from pyspark.sql import functions as F

    done = resharding.reshard_stored(clashing, F.col("doc_id") % 5, 4).collect()
    assert sorted(r.doc_id for r in done) == list(range(64))
    stay = near_dedup.drop_near_copies(clashing, width=2)
    assert stay.columns == clashing.columns and 0 < stay.count() < 64
    path, mixed = mixing.mixed_shards(clashing, shards=2)
    assert mixed.columns == [*clashing.columns, "___shard"] and {r["__shard"] for r in mixed.collect()} == {7}
    assert mixing.mixed_documents(clashing).columns == clashing.columns


# --- resharding --------------------------------------------------------------------------


def test_resharding_moves_the_least_without_a_text_in_a_shuffle(spark, sf_dir):  # noqa: F811
    from pyspark.sql import functions as F

    docs = documents(spark, sf_dir)
    old = F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(16))
    rows = resharding.reshard_stored(docs, old, 24).collect()
    sizes = collections.Counter()
    for r in rows:
        sizes[r.old_shard] += r["size"]
    total = sum(sizes.values())
    share = [total // 24 + (j < total % 24) for j in range(24)]
    # what does not fit into a shard's new share has to leave it, and nothing else
    must = sum(max(0, n - (share[i] if i < 24 else 0)) for i, n in sizes.items())
    moved = sum(r["size"] for r in rows if r.shard != r.old_shard)
    largest = max(r["size"] for r in rows)
    assert abs(moved - must) <= 40 * largest / 2
    got = collections.Counter()
    for r in rows:
        got[r.shard] += r["size"]
    assert max(got.values()) - min(got.values()) <= 2 * largest
    stored, names = resharding.store(docs, old)
    plan = resharding.planned(stored, names, 24, "__n")._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "text" in plan and not any("text" in line for line in shuffled)


def test_running_bytes_of_stored_rows(spark):  # noqa: F811
    from pyspark.sql import functions as F

    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id % 37 as int))").alias("text")).repartition(3)
    stored, (shard, task, at, size) = resharding.store(docs, F.col("doc_id") % 4)
    seen = collections.defaultdict(list)
    for r in stored.collect():
        seen[r[shard], r[task]].append((r[at], r[size]))
        assert r[size] == len(r.text) + 8
    for rows in seen.values():
        ends = np.cumsum([s for _, s in sorted(rows)])
        assert [a for a, _ in sorted(rows)] == [0, *ends[:-1].tolist()]


# --- the pipeline ------------------------------------------------------------------------


def words(t):
    import re

    return re.findall(r"[^\x20\x09-\x0d]+", t or "")


def test_stages_by_brute_force(spark):  # noqa: F811
    """Which rows each stage keeps, worked out without the operators."""
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables hold too few labels to learn from
    docs = documents(spark, sf_dir)
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}
    toxic = {r.doc_id for r in documents(spark, sf_dir, "labels").collect() if r.toxic == 1}

    one = materialize(stages["toxicity"](spark, docs, sf_dir), "test-stage")
    kept = {r.doc_id: r for r in one.collect()}
    assert all(kept[i] == rows[i] for i in kept)
    # some fifty toxic documents in four languages teach most of the lexicon, not all of it
    clean = {r.doc_id for r in documents(spark, sf_dir, "labels").collect() if r.toxic == 0}
    assert sum(i in kept for i in toxic) <= 0.3 * len(toxic)
    assert sum(i not in kept for i in clean) <= 0.02 * len(clean)

    two = materialize(stages["exact_dedup"](spark, one, sf_dir), "test-stage")
    best = {}
    for i, r in kept.items():
        best[r.text or ""] = max(i, best.get(r.text or "", i))
    assert sorted(r.doc_id for r in two.collect()) == sorted(best.values())

    three = materialize(stages["near_dedup"](spark, two, sf_dir), "test-stage")
    ids = sorted(best.values())
    sets = []
    for i in ids:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in rows[i].text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    comp = list(range(len(ids)))

    def top(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for a in range(len(ids)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                comp[y] = x
    assert sorted(r.doc_id for r in three.collect()) == [i for k, i in enumerate(ids) if top(k) == k]

    four = materialize(stages["source_mixing"](spark, three, sf_dir), "test-stage")
    assert four.columns == docs.columns
    sizes, taken = collections.Counter(), collections.Counter()
    for r in three.collect():
        sizes[r.source] += len(words(r.text))
    total = sum(sizes.values())
    for r in four.collect():
        assert r.n_chars == len(r.text) and r.source == rows[r.doc_id].source
        taken[r.source] += len(words(r.text))
        own, piece = words(rows[r.doc_id].text), words(r.text)
        assert len(piece) <= len(own) and set(piece) <= set(own)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = dict(zip(order, mixing.targets([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))]), strict=True))
    assert abs(sum(want.values()) - total) < 1e-6 * total and all(want[s] <= 3 * sizes[s] for s in order)
    assert all(abs(taken[s] - want[s]) <= 64 + 0.02 * want[s] for s in order)

    import public_tokenizers as P
    import tiktoken

    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    five = stages["byte_bpe"](spark, four, sf_dir)
    want = sorted((r.doc_id, ref.encode_ordinary(r.text)) for r in four.collect())
    assert sorted((r.doc_id, r.ids) for r in five.collect()) == want


def test_run_applies_the_stages(spark, sf_dir):  # noqa: F811
    done = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"} <= set(done.columns) and done.count() > 0
