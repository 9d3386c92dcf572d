"""What Python workers hold and do, beside the results."""

import re

import public_tokenizers
from pyspark.sql import functions as F

from lexlake.llm import bpe, mixing


def test_mixing_starts_no_second_kind_of_python_worker(spark):
    docs = spark.createDataFrame([(i, "a b c d " * 40, f"s{i % 3}", 1) for i in range(30)], "doc_id long, text string, source string, n_chars int")
    mix = mixing.Mix(mixing.prepare(docs, "doc_id", "text", "source"), 17, 8, 4)
    slots = mix.slots(spark)
    for df in (slots, mix.sources(spark)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "ExistingRDD" not in plan
    taken = slots.groupBy("src").agg(F.count("*").alias("n"), F.countDistinct("draw").alias("d"), F.max("block").alias("b")).collect()
    assert {r.src: (r.n, r.d) for r in taken} == {k: (n, n) for k, n in zip(mix.keys, mix.draws, strict=True)}
    assert all(r.b < n for r in taken for k, n in zip(mix.keys, mix.blocks, strict=True) if r.src == k)


def test_segments_are_cut_where_pieces_begin():
    begins = re.compile(r"(?= \S)|(?<=[^\W_])(?=[.,])")
    parts = ["", " ", "  ", "a", "1", ".", ",", "\n", "\t", "_", "漢", "é", "　", "..", " ."]
    for text in (a + b + c + d for a in parts for b in parts for c in parts for d in parts):
        assert bpe.CUT.findall(text) == [s for s in begins.split(text) if s], repr(text)


def test_segments_met_again_stay_when_others_are_forgotten(monkeypatch):
    machine = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    asked, learn = [], machine.learn
    monkeypatch.setattr(machine, "learn", lambda segments: asked.append(segments) or learn(segments))
    texts = [" common qzxv1", " common qzxv2", " common qzxv3"]
    first = machine.encode(texts[:2])
    monkeypatch.setattr(bpe, "REMEMBERED", 0)
    second = machine.encode([texts[2], texts[0]])
    machine.encode([texts[1]])
    assert [" common" in a for a in asked] == [True, False, False]
    assert " qzxv" in " ".join(machine.ids) and all(s in (" common", " qzxv", "2", " qzxv2") for s in machine.ids)
    assert second[1] == first[0] and [d.decode() for _, d in first + second] == [*texts[:2], texts[2], texts[0]]
    machine.close()
