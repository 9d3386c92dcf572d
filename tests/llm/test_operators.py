"""The document operators on awkward rows, against brute force and against the libraries."""

import collections
import hashlib
import os
import random
import re
import sys
import zlib

import numpy as np
import public_tokenizers as P
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import sf_dir, spark  # noqa: E402,F401

import corpus_pipeline  # noqa: E402
from lexlake.llm import bpe, exact_dedup, fingerprints, mixing, near_dedup, quality, resharding, secrets, token_counts, toxicity  # noqa: E402
from lexlake.llm.common import documents  # noqa: E402

SPACE = re.compile(r"[\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
TEXTS = [
    None, "", "  \n", "one", "Same words here and there now", "Same words here and there now", "SAME words here and there now",
    "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o q", "password = hunter2222 and AKIA" + "A1" * 10, LONG, LONG + " end",
    "=" * 3000, "ééé 世界 🙂 it's", "x\x1cy \x85 z", "deadbeef" * 4,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, h int, node int, row int, size int, score int, kept int, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, 2, 3, 4, 5, 6, 7, 8) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(TEXTS)]
    return out + [(None, "no id", "s0"), (4, TEXTS[4], "s1"), (4, TEXTS[4], "s1")]  # repeated rows


@pytest.fixture(scope="module")
def odd(spark, rows):  # noqa: F811
    return table(spark, rows)


@pytest.fixture(scope="module")
def none(spark):  # noqa: F811
    return table(spark, [])


@pytest.fixture(scope="module")
def docs(spark, sf_dir):  # noqa: F811
    return documents(spark, sf_dir)


@pytest.fixture(scope="module")
def labels(spark, sf_dir):  # noqa: F811
    return documents(spark, sf_dir, "labels")


def words(t):
    return [w for w in SPACE.split(t or "") if w]


def test_exact_dedup(odd, none, rows):
    got = exact_dedup.exact_dedup(odd).collect()
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    assert len(got) == len(rows)
    for r in got:
        g = groups[r.text_sha256]
        assert (r.group_size, r.keep_id) == (len(g), max((i for i in g if i is not None), default=None))
    assert collections.Counter(r.text_sha256 for r in got if r.kept) == collections.Counter(list(groups))
    assert exact_dedup.exact_dedup(none).count() == 0
    # a full filter sends every row through the shuffle and changes nothing
    assert sorted(map(str, exact_dedup.exact_dedup(odd, max_bits=1).collect())) == sorted(map(str, got))
    assert exact_dedup.exact_dedup(odd, carry=True).select("row.*").columns == odd.columns


def brute_components(rows, width):
    sets = []
    for _, t, _ in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    first = {}
    for k, c in enumerate(comp):
        if rows[k][0] is not None:
            first[c] = min(first.get(c, rows[k][0]), rows[k][0])
    return [(rows[k][0], len(sets[k]), first.get(c)) for k, c in enumerate(comp)]


@pytest.mark.parametrize("width", [2, 5])
def test_near_dedup_on_odd_rows(odd, none, rows, width):
    got = near_dedup.near_dedup(odd, width=width).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(brute_components(rows, width), key=str)
    assert near_dedup.near_dedup(none).count() == 0


def test_near_dedup_loses_no_link_in_chains_and_hot_groups(spark):  # noqa: F811
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, base = [], [word() for _ in range(120)]
    for i in range(60):  # each a few words from the one before: the ends are unlike
        for _ in range(2):
            base[rng.randrange(120)] = word()
        rows.append((i, " ".join(base), "s"))
    hot = [word() for _ in range(100)]
    for i in range(60, 160):
        w = list(hot)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(100)] = word()
        rows.append((i, " ".join(w), "s"))
    got = near_dedup.near_dedup(table(spark, rows), width=2).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows, 2))


def test_near_copies_with_null_and_repeated_ids(spark):  # noqa: F811
    rng = random.Random(8)

    def copies(n):
        base = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(100)]
        return [" ".join([*base[:-1], f"end{k}"]) for k in range(n)]

    both_null, one_null, repeated = copies(2), copies(2), copies(1)
    apart = repeated[0].split()
    apart = " ".join([*apart[:-25], *(f"x{k}" for k in range(25))])  # same id, likeness under 0.8
    rows = [(None, both_null[0], "s"), (None, both_null[1], "s"), (None, both_null[1], "s"), (7, one_null[0], "s"), (None, one_null[1], "s"), (9, repeated[0], "s"), (9, apart, "s"), (5, apart + " more", "s")]
    df = table(spark, rows)
    got = near_dedup.near_dedup(df, width=2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(brute_components(rows, 2), key=str)
    stay = collections.Counter((r.doc_id, r.text) for r in near_dedup.drop_near_copies(df, width=2).collect())
    assert len([t for i, t in stay if t in both_null]) == 1 and (None, one_null[1]) not in stay
    assert {k for k in stay if k[1] not in both_null} == {(7, one_null[0]), (9, repeated[0]), (5, apart + " more")}


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for common in (500, 450, 300):
        b = np.concatenate([a[:common], rng.integers(0, 1 << 63, 500 - common, dtype=np.uint64)])
        share = (near_dedup.registers(a) == near_dedup.registers(b)).mean()
        assert abs((share - near_dedup.COLLISION) / (1 - near_dedup.COLLISION) - common / (1000 - common)) < 0.12


def test_parities_never_differ_in_more_places_than_sets():
    rng = np.random.default_rng(2)
    for size in (1, 20, 150, 3000):
        a, other = (np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64)) for _ in range(2))
        for share in (0.0, 0.1, 0.5, 1.0):
            b = np.unique(np.concatenate([a[int(len(a) * share) :], other[: int(len(a) * share)]]))
            apart = len(np.setxor1d(a, b))
            seen = int(np.bitwise_count((near_dedup.parities(a) ^ near_dedup.parities(b)).view(np.uint64)).sum())
            assert seen <= apart
            assert abs(seen - near_dedup.PARITIES / 2 * (1 - np.exp(-2 * apart / near_dedup.PARITIES))) <= 2.5 * near_dedup.PARITIES**0.5


def test_resharding(odd, none, docs, rows):
    from pyspark.sql import functions as F

    for df, n in ((odd, 4), (docs, 24)):
        got = resharding.reshard(df, F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(16)), n).collect()
        sums, slots = collections.Counter(), collections.defaultdict(list)
        for r in got:
            sums[r.shard] += r["size"]
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if df is docs:
            assert len(got) == docs.count() and set(sums) == set(range(n))
            assert max(sums.values()) - min(sums.values()) <= 2 * max(r["size"] for r in got)
        else:
            assert sorted((zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for _, t, _ in rows) == sorted((r.text_crc32, r["size"]) for r in got)
    assert resharding.reshard(none, F.lit(0), 4).count() == 0


def test_flow_moves_the_least():
    flow = resharding.min_cost_flow({0: 10, 1: 2, 2: 0}, {0: 4, 1: 4, 2: 4}, lambda i, j: int(i != j))
    assert sum(n for (i, j), n in flow.items() if i != j) == 6
    assert [sum(n for (_, j), n in flow.items() if j == k) for k in range(3)] == [4, 4, 4]
    with pytest.raises(ValueError):
        resharding.min_cost_flow({0: 5}, {0: 4}, lambda i, j: 0)
    assert resharding.level([10, 0, 5], 9) == [7, 0, 2]


def test_rewrite_touches_only_what_moves(spark, docs):  # noqa: F811
    from pyspark.sql import functions as F

    old = F.when(F.col("doc_id") % 2 == 0, 0).otherwise(F.lit(1))
    stored = docs.withColumn("shard", old)
    moves = stored.select("doc_id", F.col("shard").alias("old_shard"), F.when(F.col("doc_id") < 20, 2).otherwise(F.col("shard")).alias("shard"))
    path, affected = resharding.rewrite(stored, moves.where("doc_id % 2 = 0 or doc_id >= 20"))
    assert affected == [0, 2]
    written = spark.read.parquet(path)
    assert written.where("shard = 2").count() == 10
    assert written.where("shard = 0").count() == docs.where("doc_id % 2 = 0").count() - 10


def test_rewrite_keeps_rows_of_null_ids_and_rows_without_a_move(spark):  # noqa: F811
    stored = spark.createDataFrame([(None, "a", 0), (1, "b", 0), (2, "c", 0), (3, "d", 1)], "doc_id long, text string, shard int")
    moves = spark.createDataFrame([(None, 0, 2), (1, 0, 0)], "doc_id long, old_shard int, shard int")
    path, affected = resharding.rewrite(stored, moves)
    assert affected == [0, 2]
    assert sorted((r.text, r.shard) for r in spark.read.parquet(path).collect()) == [("a", 2), ("b", 0), ("c", 0)]


def test_reshard_stored_gives_what_the_files_hold(spark, odd, none, docs, sf_dir, monkeypatch):  # noqa: F811
    from pyspark.sql import functions as F

    from lexlake.llm import queries

    paths, whole = [], resharding.rewrite
    monkeypatch.setattr(resharding, "rewrite", lambda *a, **k: paths.append(whole(*a, **k)) or paths[-1])
    old = F.pmod(F.crc32(F.coalesce("source", F.lit(""))), F.lit(16))
    for df, got in ((odd, resharding.reshard_stored(odd, old, 4)), (docs, queries.op3_resharding(spark, sf_dir))):
        got = got.collect()
        path, affected = paths.pop(0)
        held = spark.read.parquet(path)
        assert set(df.columns) <= set(held.columns) and affected
        name = lambda t: zlib.crc32((t or "").encode())
        texts = sorted(((r.doc_id, name(r.text)) for r in df.collect()), key=str)
        assert sorted(((r.doc_id, r.text_crc32) for r in got), key=str) == texts
        files = sorted(((r.doc_id, name(r.text), r["__old"], r["__shard"]) for r in held.collect()), key=str)
        assert sorted(((r.doc_id, r.text_crc32, r.old_shard, r.shard) for r in got if r.shard in affected), key=str) == files
        assert all(r.shard == r.old_shard for r in got if r.shard not in affected)
        slots = collections.defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert resharding.reshard_stored(none, old, 4).count() == 0


def test_mixing(odd, none, docs):
    for df in (odd, docs):
        got = mixing.mix_counts(df).collect()
        assert len(got) == df.count() and all(r.taken <= 3 * r["size"] for r in got)
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix_counts(df).collect()))
    source = {r.doc_id: r.source for r in docs.collect()}
    taken, target = collections.Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - t) <= 0.02 * t + 64 for s, t in target.items())
    mixed = collections.Counter()
    for r in mixing.mixed_documents(docs).collect():
        mixed[r.doc_id] += len(words(r.text))
    assert all(mixed[r.doc_id] == r.taken for r in got)
    assert mixing.mix_counts(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert mixing.targets([10, 1000, 0], [5, 2, 1]) == [30.0, 980.0, 0.0]
    k = np.arange(1000)
    assert sorted(mixing.permute(k, np.full(1000, 1000), np.full(1000, 9))) == list(range(1000))


def test_each_shard_of_the_mix_has_the_drawn_composition(spark):  # noqa: F811
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(64 * (1 + i % 3))), f"s{i % 3}") for i in range(90)]
    df = table(spark, rows)
    path, mixed = mixing.mixed_shards(df, shards=4)
    assert mixed.columns == [*df.columns, "__shard"] and len([d for d in os.listdir(path) if d.startswith("__shard=")]) == 4
    got = collections.Counter()
    for r in spark.read.parquet(path).collect():
        got[r["__shard"], r.source] += len(words(r.text))
    sizes = [sum(len(words(t)) for _, t, s in rows if s == f"s{k}") for k in range(3)]
    wanted = [mixing.draws(n, t, 64)[1] for n, t in zip(sizes, mixing.targets(sizes, [5, 2, 1]), strict=True)]
    counts = mixing.multinomial_counts(wanted, 4, 17)
    assert got == {(k, f"s{i}"): 64 * int(n) for k, line in enumerate(counts) for i, n in enumerate(line) if n}
    other = mixing.mixed_shards(df, shards=2)[1]
    assert {r["__shard"] for r in other.collect()} == {0, 1}


def test_bpe(odd, none, docs):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    machine = bpe.Encoder(bpe.read_ranks(path), P.PATTERN)
    rng = random.Random(3)
    odd_texts = ["".join(rng.choice("abe  \n\t'sé世🙂.,-_01\x1c\x85") for _ in range(rng.randrange(80))) for _ in range(500)]
    for t, (ids, spelled) in zip(odd_texts, machine.encode(odd_texts), strict=True):
        assert list(map(int, ids.split())) == ref.encode_ordinary(t) and spelled == t.encode()
    for df in (odd, docs):
        texts = collections.defaultdict(list)
        for r in df.collect():
            texts[r.doc_id].append(r.text or "")
        encoded = bpe.encode(df, path, P.PATTERN)
        for r in encoded.collect():
            t = next(t for t in texts[r.doc_id] if r.ids == ref.encode_ordinary(t))
            assert r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode(encoded, path, P.PATTERN).collect()}
    assert all(back[i] == ts[0] for i, ts in texts.items())
    assert bpe.encode(none, path, P.PATTERN).count() == 0


def test_token_counts(odd, none, docs):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    ref = Tokenizer.from_file(path)
    expect = lambda t: len(ref.encode(t, add_special_tokens=False).ids)
    machine = token_counts.Counter(path)
    rng = random.Random(4)
    parts = [*"abcdeABC  \n\t'é世🙂.,-_012\x1c\x85́ßΣσİ①Ⅷ", "'s", "'ll", "<|endoftext|>", "the", "ing"]
    for _ in range(800):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(90)))
        assert machine.count(t) == expect(t), t
    whole, token_counts.CHUNK = token_counts.CHUNK, 7  # state maps of small chunks compose to the same
    try:
        assert all(machine.count(t or "") == expect(t or "") for t in TEXTS if t is not LONG)
    finally:
        token_counts.CHUNK = whole
    for df in (odd, docs):
        want = sorted((r.doc_id or -1, len((r.text or "").encode()), expect(r.text or "")) for r in df.collect())
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(df, path).collect()) == want
    assert token_counts.count_tokens(none, path).count() == 0


def test_fingerprints(odd, none, docs):
    got = fingerprints.edited_fingerprints(odd).collect()
    assert len(got) == odd.count() and fingerprints.edited_fingerprints(none).count() == 0
    text = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(text, reverse=True)
    after = {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}
    sets = lambda t: {tuple(words(t)[k : k + 5]) for k in range(max(1, len(words(t)) - 4))}
    off = []
    for r in fingerprints.edited_fingerprints(docs).collect():
        t = text[r.doc_id]
        edited = t[: len(t) - len(t) // 2] + text[after[r.doc_id]][: len(t) // 2]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r.fingerprint) == fingerprints.BINS
        a, b = sets(t), sets(edited)
        off.append(r.near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.09


def patterns(text):
    """The base kinds by their definition, character by character with plain searches."""
    found = []
    for kind, pattern, part, least in (
        ("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        ("access", "AKIA[A-Z0-9]+", 0, 20),
        ("hex", "[0-9a-f]+", 0, 24),
    ):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group(part)) >= least]
    order = ["assign", "access", "hex"]
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(found, key=lambda x: (x[0], order.index(x[1]))))


def test_secrets(odd, none, docs):
    for df in (odd, docs):
        texts = collections.defaultdict(list)
        for r in df.collect():
            texts[r.doc_id].append(r.text or "")
        for r in secrets.scan(df).collect():
            wants = [hashlib.sha256(patterns(t).encode()).hexdigest() for t in texts[r.doc_id]]
            assert r.base_sha256 in wants
            base = [s for s in r.spans.split(",") if s and not s.startswith("random")]
            assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
            assert r.n_assign + r.n_access + r.n_hex == len(base)
    assert secrets.scan(none).count() == 0
    assert secrets.joined(secrets.base_spans("token=token=abc ſecret=abcdefgh")) == "assign:0:15"
    assert secrets.base_spans("x AKIA" + "B" * 15) == [] and len(secrets.base_spans("AKIA" + "B" * 16)) == 1
    rng = random.Random(2)
    noise = "".join(rng.choice(secrets.ALPHABETS[9]) for _ in range(40))
    plain = "thisisaverylongwordwithoutanyspacesinit"
    found, tested = secrets.hypotheses([f"{plain} {noise}"], secrets.calibration())
    assert tested.sum() == 2 and [(s, e) for s, e, _, _ in found[0]] == [(len(plain) + 1, len(plain) + 41)]
    assert secrets.limits({0: 100}, {(0, 20): 3})[0] <= 20 and secrets.limits({0: 10**6}, {(0, 2): 3})[0] > secrets.STEPS


def test_secrets_battery_is_level_on_random_runs():
    rng = np.random.default_rng(8)
    for alphabet, least in ((1, 32), (5, 48), (9, 48), (10, 96)):
        size = len(secrets.ALPHABETS[alphabet])
        p = secrets.battery(rng.integers(0, size, (4000, least)), size, least)
        for level in (0.1, 0.5):
            assert abs((p < level).mean() - level) < 0.08
    words = np.array([[secrets._PLACES[9][c] for c in "thisIsTheNameOfAnOrdinaryThingInText1"]])
    assert secrets.battery(words, 62, 32)[0] < 0.001


def test_secrets_planted(spark):  # noqa: F811
    """Planted keys by encoding and length: recall, and the share of false spans among those added."""
    rng = random.Random(5)
    words = "contract party agreement regulation article payment supplier invoice section transfer customer registry".split()
    shapes = ("".join, lambda ws: "".join(w.title() for w in ws), "_".join, lambda ws: "/".join(ws) + "/77", lambda ws: "-".join(ws).upper())
    kinds, lengths = {1: "hex", 2: "upper hex", 5: "base32", 6: "lower", 7: "upper", 9: "base62", 10: "base64"}, (24, 32, 64, 128)
    docs, truth = [], {}
    for d in range(1500):
        text = ""
        for _ in range(8):
            if rng.random() < 0.05:
                kind, n = rng.choice(list(kinds)), rng.choice(lengths)
                truth[d, len(text), len(text) + n] = kind, n
                text += "".join(rng.choice(secrets.ALPHABETS[kind]) for _ in range(n)) + " "
            else:
                text += rng.choice(shapes)([rng.choice(words) for _ in range(rng.randint(2, 8))]) + " "
        docs.append((d, text))
    rows = secrets.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {(r.doc_id, int(s), int(e)) for r in rows for k, s, e in (x.split(":") for x in r.spans.split(",") if x) if k != "assign"}
    assert len(got - set(truth)) <= 0.02 * len(got)
    hit, planted = collections.Counter(v for k, v in truth.items() if k in got), collections.Counter(truth.values())
    for kind in kinds:
        long = sum(hit[kind, n] for n in lengths[2:]) / sum(planted[kind, n] for n in lengths[2:])
        short = sum(hit[kind, n] for n in lengths[:2]) / sum(planted[kind, n] for n in lengths[:2])
        assert long >= 0.8 and short >= 0.5, (kinds[kind], short, long)


def held_out_accuracy(scored, labels, column):
    truth = {r.doc_id: r[column] for r in labels.collect()}
    pairs = [(truth[r.doc_id], r.predicted) for r in scored.collect() if r.held_out and r.doc_id in truth]
    return np.mean([a == b for a, b in pairs]), len(pairs)


def test_quality(spark, odd, none):  # noqa: F811
    d, lab = (documents(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    net = quality.fit(d, lab)
    share, n = held_out_accuracy(quality.score_quality(d, net), lab, "quality")
    assert n > 30 and share >= 0.88
    got = quality.score_quality(odd, net).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(none, net).count() == 0
    assert 0 <= quality.ByteNet().fit([], []).score([None, ""])[0] <= 1
    # gradients against differences
    data, halves = quality.pack([b"some text here" * 90, b"other"])
    y = np.array([1.0, 0.0], dtype=np.float32)
    small = quality.ByteNet(3)
    g = small.gradients(data, halves, y)
    loss = lambda: float(-np.mean(y * np.log(p := small.forward(data, halves).astype(float)) + (1 - y) * np.log(1 - p)))
    for name, at in (("out", (3,)), ("bias", (5,)), ("filters", (9, 4)), ("embed", (ord("e"), 2))):
        was = small.p[name][at]
        small.p[name][at] = was + 1e-2
        up = loss()
        small.p[name][at] = was - 1e-2
        assert abs((up - loss()) / 2e-2 - g[name][at]) < 2e-3
        small.p[name][at] = was


def test_toxicity(spark, odd, none):  # noqa: F811
    d, lab = (documents(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    lexicon = toxicity.learn(d, lab)
    share, n = held_out_accuracy(toxicity.score_toxicity(d, lexicon), lab, "toxic")
    assert n > 30 and share >= 0.95
    table_, machine = toxicity.fold_table(), lexicon.automaton()
    hidden = ["іdіоt", "1d10t", "ｉｄｉｏｔ", "id​iot", "IDIOT"]
    assert all(lexicon.score(toxicity.fold(t, table_), machine) > 0.5 for t in hidden)
    assert lexicon.score(toxicity.fold("a plain sentence", table_), machine) < 0.5
    assert len(toxicity.score_toxicity(odd, lexicon).collect()) == odd.count()
    assert toxicity.score_toxicity(none, lexicon).count() == 0
    assert toxicity.drop_toxic(odd, lexicon).columns == odd.columns
    spared = toxicity.Lexicon({"scum": 5.0}, {"scum line"})
    assert spared.measure(toxicity.fold("the scum line", table_), spared.automaton())[0] == 0
    assert toxicity.learn(d, lab.where("toxic = 0")).weights == {}


def test_pipeline(spark, sf_dir):  # noqa: F811
    docs = documents(spark, sf_dir)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        docs = after.cache()
        assert docs.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and corpus_pipeline.ORACLE_SQL is None
