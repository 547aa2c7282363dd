"""Collocations, periodic runs and the MinHash join against brute force, and on bad input."""

from __future__ import annotations

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from cases import documents, empty, prose, with_clashes
from martloom.llm import collocations, minhash_hamming, periodic_runs
from martloom.llm.prefix_join import shingles


# Collocations


def best_phrases(rows, least, top, longest=4):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), longer in found.items():
        inside = {(lang, words[i : i + k]) for k in range(2, len(words)) for i in range(len(words) - k + 1)}
        covered |= {x for x in inside if 100 * longer >= 80 * found[x]}
    ranked = {}
    for (lang, words), a in found.items():
        if (lang, words) not in covered:
            cuts = [(2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            ranked.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score)
        for lang, every in ranked.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(every)[:top], 1)
    )


def spoken(n, seed):
    rng = random.Random(seed)
    phrases = ["new york city", "new york", "of the", "in the end", "the END of", "a a a", "Ünïcödé ☃", "york city hall new"]
    return " ".join(rng.choice(phrases) + rng.choice(["", "", ".", ",\t", "\n", "!"]) for _ in range(n))


@pytest.mark.parametrize("block_words", [50, 1 << 21])
def test_collocations_are_those_of_brute_force(spark, block_words):
    rows = [(i, spoken(40, i), ["en", "de", None, "und"][i % 4]) for i in range(60)] + [(None, None, "en"), (1, "", "fr"), (1, " \t ", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = collocations.collocations(docs, least=3, top=12, block_words=block_words)
    assert sorted(tuple(r) for r in got.collect()) == best_phrases([(lang, text) for _, text, lang in rows], 3, 12)


def test_collocations_of_awkward_tables(spark):
    docs = with_clashes(documents(spark))
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    got = collocations.collocations(docs, least=2)
    assert sorted(tuple(r) for r in got.collect()) == best_phrases(rows, 2, 2000)
    assert collocations.collocations(empty(spark)).collect() == []


# Periodic runs


def longest_lyndon_words(letters):
    found = []
    for i in range(len(letters)):
        ends = [e for e in range(i + 1, len(letters) + 1) if all(letters[i:e] < letters[j:e] for j in range(i + 1, e))]
        found.append(ends[-1] - i)
    return found


def test_lyndon_arrays_of_both_orders():
    rng = random.Random(5)
    for _ in range(400):
        letters = [rng.randint(0, rng.choice([1, 3])) for _ in range(rng.randint(1, 20))]
        for order in (letters, [-x for x in letters]):
            assert periodic_runs.lyndon_array(order) == longest_lyndon_words(order)


def all_runs(words):
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i - start + q >= max(24, 3 * q):
                found.setdefault((start, i - start + q), q)
            i += i == start
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def repetitive(seed):
    rng, words = random.Random(seed), []
    while len(words) < 150:
        words += [rng.choice("abc") for _ in range(rng.randint(1, 10))] * rng.randint(1, 9)
        if rng.random() < 0.4:
            words.pop(rng.randrange(len(words)))
    return words


def test_runs_and_collapsed_texts_are_those_of_brute_force(spark):
    texts = [" ".join(repetitive(i)) for i in range(40)] + ["x " * 24, "x " * 23, "a b c d e f g h " * 3, "a b c d e f g h i " * 3, prose(3000, 7)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, None, None, None, None), (3, "", None, None, None), (3, texts[3], None, None, None)]
    docs = with_clashes(spark.createDataFrame(rows, documents(spark).schema).repartition(3))
    got = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.periodic_runs(docs).collect()), key=repr)
    want = [(i, t.split() if t else []) for i, t, *_ in rows]
    assert got == sorted(((i, all_runs(w), collapsed(w, all_runs(w))) for i, w in want), key=repr)
    assert periodic_runs.summary(periodic_runs.periodic_runs(empty(spark))).collect() == []


def test_summary_names_the_greatest_run(spark):
    docs = spark.createDataFrame([(i, " ".join(repetitive(i))) for i in range(30)] + [(99, None)], "doc_id long, text string")
    for row in periodic_runs.summary(periodic_runs.periodic_runs(docs)).collect():
        runs = all_runs(repetitive(row["doc_id"])) if row["doc_id"] != 99 else []
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        assert (row["start"], row["length"], row["period"]) == (best or (None, None, None))
        assert row["n_runs"] == len(runs) and row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert len(row["runs_sha256"]) == len(row["collapsed_sha256"]) == 64


def test_long_text_of_one_word_and_of_nested_runs():
    one, two = [b"a"], [b"a", b"b"]
    while len(two) < 50_000:
        one, two = two, two + one
    same = [b"w"] * 100_000
    found = [runs for runs, _ in periodic_runs._worked([same, two])]
    assert found[0] == [(0, 100_000, 1)]
    assert all(n >= max(24, 3 * q) and two[s : s + n - q] == two[s + q : s + n] for s, n, q in found[1]) and found[1]


# MinHash and Hamming distance


def components_of(rows, words, percent):
    sets = [set(shingles(t, words).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def near_copies(spark, groups, copies):
    rng, rows = random.Random(9), []
    for g in range(groups):
        base = prose(rng.randint(20, 200), 500 + g).split()
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"changed{rng.random()}"
            rows.append((len(rows), " ".join(words), "en", "s", 0))
    return spark.createDataFrame(rows, documents(spark).schema)


@pytest.mark.parametrize("percent, words", [(85, 5), (70, 2), (95, 3), (100, 5)])
def test_hamming_join_finds_the_components_of_brute_force(spark, percent, words):
    docs = documents(spark).union(near_copies(spark, 12, 12))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = minhash_hamming.linked(with_clashes(docs), percent, words).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == components_of(rows, words, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_hamming_join_of_awkward_tables(spark):
    assert minhash_hamming.linked(empty(spark)).collect() == []
    kept = minhash_hamming.one_of_each(documents(spark))
    assert kept.columns == documents(spark).columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert max(ids.values()) == 1 and not {1, 2} & set(ids) and set(ids) >= {0, 3, 7, 8, 9}


def test_no_pair_within_the_radius_is_left_out():
    rng = np.random.default_rng(4)
    for percent in (60, 80, 85, 95, 100):
        errors, far = minhash_hamming.allowed_errors(percent), minhash_hamming.radius(percent)
        for _ in range(200):
            wrong = rng.choice(minhash_hamming.SYMBOLS, far, replace=False) // minhash_hamming.WIDTH
            found = np.bincount(wrong, minlength=minhash_hamming.CHUNKS)
            assert any(n <= e for n, e in zip(found, errors, strict=True))
