from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from cases import documents, empty, prose, texts_of, with_clashes
from martloom.llm import grouped_prefix, induced, kd_shards, packing, pairwise_quality, prefix_join, sentencepiece_backend, suffix_dedup
from martloom.llm.frames import ROW
from martloom.llm.queries import QUERIES, tokenizer_file

BPE, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


# --- suffix-array dedup -------------------------------------------------------------------------------------------


def brute_removed(rows, length=50):
    key = lambda i: (i is None, i or 0)
    least = {}
    contents = sorted(((key(i), t.encode()) for i, t in rows), key=lambda r: r[0])
    for i, b in contents:
        for p in range(len(b) - length + 1):
            least.setdefault(b[p : p + length], i)
    found = []
    for i, b in contents:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if least[b[p : p + length]] < i:
                gone[p : p + length] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        found.append((None if i[0] else i[1], len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def awkward(spark):
    """Periodic texts, strings of 49, 50 and 51 bytes, zero bytes, matches at both ends."""
    s = prose(40, 50)
    texts = ["a" * 200, "b" + "a" * 120, "ab" * 90, "ba" * 60, s[:50], s[:49], "x" + s[:50] + "y", s[10:61], "\0" * 80, "q" + "\0" * 60, s + s, "é" * 40 + s]
    return documents(spark).union(spark.createDataFrame([(100 + i, t, "en", "s", 1) for i, t in enumerate(texts)], documents(spark).schema))


def test_suffix_dedup_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 8_000)
    docs = awkward(spark)
    got = suffix_dedup.measured(with_clashes(docs)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_removed(texts_of(docs))


def test_suffix_dedup_keeps_columns_and_whole_characters(spark):
    docs = with_clashes(documents(spark))
    kept = suffix_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == docs.count()
    want = {(r[0], r[4]) for r in brute_removed(texts_of(docs))}
    assert {(r["doc_id"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in rows} <= want
    assert {r["_row"] for r in rows} == {"x0"}


def test_suffix_dedup_of_no_rows(spark):
    assert suffix_dedup.measured(empty(spark)).collect() == []
    assert suffix_dedup.deduplicated(empty(spark)).collect() == []


@pytest.mark.parametrize(("rows", "held", "chunk"), [(0, 5, 7), (1, 5, 7), (60, 5, 7), (500, 10_000, 1 << 16)])
def test_induced_orders_and_prefixes(rows, held, chunk, monkeypatch):
    monkeypatch.setattr(induced, "CHUNK", chunk)
    texts = np.random.default_rng(3).integers(97, 99, (rows, 9)).astype(np.uint8)
    texts[rows // 2 :] = texts[: rows - rows // 2]
    for column, order in induced.suffix_orders(np.ascontiguousarray(texts.T), 9, held):
        tuples = np.concatenate([*order, np.empty(0, induced.TUPLE)])
        found = [texts[r, column:].tobytes() for r in induced.rows_of(tuples)]
        assert found == sorted(found)
        common = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a)) for a, b in zip(found, found[1:])]
        assert common[:rows] == list(induced.common_of(tuples))


# --- n-gram Jaccard join ------------------------------------------------------------------------------------------


def brute_components(rows, percent=90):
    def grams(text):
        words = [w.decode() for w in text.encode().lower().split()]
        if len(words) < 3:
            return frozenset([tuple(words)]) if words else frozenset()
        return frozenset(tuple(words[i : i + 3]) for i in range(len(words) - 2))

    sets = [grams(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)].append(name)
    return sorted(((name, len(s), min(least[root(i)], default=None)) for i, (name, s) in enumerate(zip([r[0] for r in rows], sets))), key=repr)


def near_copies(spark):
    """Chains of near copies whose ends are not alike, near copies at the edge of the threshold, short texts."""
    words = prose(140, 90).split()
    rows, rng = [], np.random.default_rng(5)
    for i in range(40):
        words = list(words)
        words[int(rng.integers(len(words)))] = f"new{i}"
        rows.append((200 + i, " ".join(words), "en", "s", 1))
    base = prose(100, 91).split()
    for i in range(40):
        changed = list(base)
        for at in rng.choice(100, int(rng.integers(1, 5)), replace=False):
            changed[at] = f"w{i}"
        rows.append((300 + i, " ".join(changed), "en", "s", 1))
    for n in range(1, 30):
        rows += [(400 + 2 * n, " ".join(f"k{i}" for i in range(n)), "", "", 0), (401 + 2 * n, " ".join(f"K{i}" for i in range(n)) + " z", "", "", 0)]
    return documents(spark).union(spark.createDataFrame(rows, documents(spark).schema))


def test_prefix_join_equals_brute_force(spark):
    docs = near_copies(spark)
    got = sorted((tuple(r) for r in grouped_prefix.linked(with_clashes(docs)).collect()), key=repr)
    assert got == brute_components(texts_of(docs))


def test_prefix_join_keeps_one_of_each(spark):
    docs = with_clashes(near_copies(spark))
    kept = grouped_prefix.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute_components(texts_of(docs))}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_prefix_join_of_no_rows(spark):
    assert grouped_prefix.linked(empty(spark)).collect() == []


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_prefix(percent):
    rng, counts = np.random.default_rng(1), np.random.default_rng(2).integers(0, 50, grouped_prefix.BUCKETS)
    for _ in range(400):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(2, 400))).astype(np.uint64))
        union = rng.permutation(np.concatenate([a, rng.integers(0, 1 << 63, len(a) // 8 + 1).astype(np.uint64)]))
        b = np.setdiff1d(union, union[: len(union) * (100 - percent) // 100])
        common = len(np.intersect1d(a, b))
        if 100 * common >= percent * (len(a) + len(b) - common):
            one, two = (grouped_prefix.prefix(x, counts, percent).tolist() for x in (a, b))
            assert set(one) & set(two)


@pytest.mark.parametrize("percent, words", [(80, 5), (60, 1)])
def test_prefix_join_at_other_thresholds(spark, percent, words):
    docs = near_copies(spark).union(documents(spark))
    sets = [(i, set(prefix_join.shingles(t, words).tolist())) for i, t in texts_of(docs) if i is not None]
    linked = [(i, j) for i, a in sets for j, b in sets if a and b and 100 * len(a & b) >= percent * len(a | b)]
    reach = {i: i for i, _ in sets}
    for _ in sets:
        for i, j in linked:
            reach[i] = reach[j] = min(reach[i], reach[j])
    got = grouped_prefix.linked(docs, percent, words).filter("doc_id IS NOT NULL").collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(reach.items())


def test_repeated_rows_are_reduced_to_one(spark):
    text = prose(80, 91)
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1)], documents(spark).schema)
    assert [tuple(r) for r in grouped_prefix.one_of_each(docs).collect()] == [(1, text, "en", "s", 1)]


# --- packing ------------------------------------------------------------------------------------------------------


def test_packing_places_every_id_once(spark):
    docs = with_clashes(documents(spark))
    rows = packing.sequences(docs, BPE, with_ids=True).collect()
    encoder = packing.Encoder(BPE)
    want = sorted(tuple(encoder.exact(t).tolist()) + (0,) for _, t in texts_of(docs))
    whole = defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        whole[r["doc_id"]].append(r)
    got = []
    for parts in whole.values():
        copies = len([p for p in parts if p["start"] == 0])
        joined = [i for p in sorted(parts, key=lambda p: p["start"])[::copies] for i in p["ids"]]
        assert len(joined) == parts[0]["doc_tokens"]
        got += [tuple(joined)] * copies
    assert sorted(got) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024


def test_patterns_use_every_length_and_waste_little():
    rng = np.random.default_rng(2)
    histogram = {int(k): int(v) for k, v in zip(range(1, 1025), rng.integers(0, 500, 1024), strict=True) if v}
    found = packing.patterns(histogram, 1024)
    used = defaultdict(int)
    for p in found:
        assert sum(p.lengths) <= 1024 and p.count > 0
        for length in p.lengths:
            used[length] += p.count
    assert used == histogram
    assert sum(k * v for k, v in histogram.items()) >= 0.98 * 1024 * sum(p.count for p in found)


def test_fast_ids_equal_the_library(spark):
    encoder = packing.Encoder(BPE)
    texts = [t for _, t in texts_of(documents(spark))] + ["don't  stop\t\n\n x ", "<|endoftext|> inside", "١٢٣ ½ \u00a0\u3000 z"]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in texts:
        assert np.array_equal(encoder.ids(text), encoder.exact(text))


@pytest.mark.parametrize("text", [" " * 2_000_000 + "a", "a" + "\n \t" * 700_000, "a" * 1_000_000, ("x" + " " * 9_999) * 50, "\u3000" * 20_000 + "é"])
def test_ids_of_long_runs_are_those_of_the_library(text):
    encoder = packing.Encoder(BPE)
    encoder.verified = True
    assert np.array_equal(encoder.ids(text), encoder.exact(text))


def test_packing_of_no_rows(spark):
    assert packing.sequences(empty(spark), BPE).collect() == []


# --- sharding -----------------------------------------------------------------------------------------------------


def sharded_rows(spark, docs, leaves, **options):
    return kd_shards.sharded(docs, ["n_chars", "doc_id", "source", "lang"], leaves=leaves, **options).collect()


def test_shards_hold_near_equal_bytes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharded_rows(spark, docs, 24)
    texts = dict(texts_of(docs))
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]].encode()) + 8, zlib.crc32(texts[r["doc_id"]].encode()))
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == docs.count() and set(sizes) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 3 * largest


def test_shards_split_repeated_rows(spark):
    docs = spark.createDataFrame([(7, "same text", "en", "s", 9)] * 400 + [(i, None, None, None, None) for i in range(100)], documents(spark).schema)
    rows = sharded_rows(spark, with_clashes(docs), 5)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(rows) == 500 and len(sizes) == 5
    assert max(sizes.values()) - min(sizes.values()) <= 60


def test_shards_of_a_target_and_of_no_rows(spark):
    docs = documents(spark)
    rows = kd_shards.sharded(docs, ["n_chars"], target_bytes=20_000).collect()
    total = sum(r["size"] for r in rows)
    assert len({r["shard"] for r in rows}) == -(-total // 20_000)
    assert sharded_rows(spark, empty(spark), 24) == []


def test_sharding_runs_no_python(spark):
    plan = QUERIES["op3_kd_shards"].build(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- classifier ---------------------------------------------------------------------------------------------------


def test_classifier_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op8_pairwise_quality"].build(spark, sf_dir).collect() if r["held_out"] and r["doc_id"] in labels]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    right = [r["predicted"] == labels[r["doc_id"]] for r in rows]
    assert len(right) > 500 and sum(right) >= 0.97 * len(right)


def test_classifier_takes_every_row(spark):
    docs = with_clashes(documents(spark))
    labels = spark.createDataFrame([(0, 1), (0, 1), (3, 1), (2, None), (18, 0), (19, 0), (999, 0)], "doc_id long, quality int")
    scored = pairwise_quality.scored(docs, pairwise_quality.learned(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    constant = pairwise_quality.scored(docs, pairwise_quality.learned(docs, labels.limit(0))).collect()
    assert {r["score"] for r in constant} == {0.5}
    assert pairwise_quality.scored(empty(spark), pairwise_quality.learned(empty(spark), labels)).collect() == []
    assert pairwise_quality.chosen_documents(docs, labels).columns == docs.columns


def test_every_labelled_document_is_learned_from(spark):
    labels = spark.range(24_000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 > 0).cast("int").alias("quality"))
    texts = F.when(F.col("id") % 3 > 0, F.concat(F.lit("good words "), F.hex("id"))).otherwise(F.concat(F.lit("#### $$ "), F.col("id")))
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), texts.alias("text"))
    rows, names = pairwise_quality._labelled(docs, labels)
    chosen = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(24_000))
    assert rows.count() == chosen
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    assert pairwise_quality._differences(rows, counts, 4).count() == 4 * max(counts.values())
    # The table gives what the same rows give in memory.
    ordered = rows.orderBy("at").collect()
    x, y = np.array([r["x"] for r in ordered]), np.array([r["label"] for r in ordered])
    one, two = pairwise_quality.fit(x, y, names, 0.3), pairwise_quality.learned(docs, labels)
    assert np.allclose(one.weights, two.weights, atol=1e-6) and abs(one.cut - two.cut) < 1e-5
    few = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(40)], "doc_id long, quality int")
    assert pairwise_quality.learned(docs, few).weights.any()


def test_newton_finds_the_order_of_strengths():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((600, 3))
    y = (x @ np.array([2.0, -1.0, 0.0]) + 0.3 * rng.standard_normal(600) > 0).astype(int)
    model = pairwise_quality.fit(x, y, ["a", "b", "c"], 0.3)
    assert ((model.raw(x) >= model.cut) == (y == 1)).mean() > 0.9


# --- sentencepiece ------------------------------------------------------------------------------------------------


def hand_made_model(path, kind):
    """A small model written field by field: unigram or BPE pieces with byte fallback."""
    marker = "▁"
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(p, -float(i), 1) for i, p in enumerate([f"{marker}the", "th", "he", f"{marker}t", "er", "re", "an", marker, *"therandlyo"], 1)]

    def field(number, content):
        head = number << 3 | 2
        size, out = len(content), b""
        while size > 127:
            out += bytes([size & 127 | 128])
            size >>= 7
        return bytes([head]) + out + bytes([size]) + content

    body = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + bytes([k])) for p, s, k in dict((x[0], x) for x in pieces).values())
    body += field(2, b"\x18" + bytes([kind]) + b"\x98\x02\x01")
    body += field(3, b"\x18\x01\x20\x00\x28\x01")
    path.write_bytes(body)
    return str(path)


@pytest.mark.parametrize("kind", [1, 2])
def test_parity_on_a_hand_made_model(tmp_path, kind):
    codec = sentencepiece_backend.Codec(hand_made_model(tmp_path / "m.model", kind))
    reference = codec.reference()
    texts = ["the other and", "", " the", "then  there", "zäh ☃", "the\nother", "antheran dly o"]
    assert codec.encode(texts) == [reference.encode(t) for t in texts]
    assert codec.decode(codec.encode(texts)) == [reference.decode(reference.encode(t)) for t in texts]


def test_parity_and_round_trip_on_documents(spark):
    docs = with_clashes(documents(spark)).unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), allowMissingColumns=True)
    rows = sentencepiece_backend.summary(docs, PIECES, parity_every=1).collect()
    assert len(rows) == docs.count() and all(r["round_trip"] and r["checked"] for r in rows)
    ids = sentencepiece_backend.encoded(docs, PIECES)
    back = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in sentencepiece_backend.decoded(ids, PIECES).collect())
    assert back == sorted((i is None, i or 0, t) for i, t in texts_of(docs))
    assert sentencepiece_backend.summary(empty(spark), PIECES).collect() == []


def test_row_struct_is_not_in_the_way(spark):
    assert ROW in with_clashes(documents(spark)).columns
