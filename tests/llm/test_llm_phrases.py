"""Phrase collocations against plain Python, the summaries and their encoding."""

import collections
import random
import re

import numpy as np
import pytest

from vitrine.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, threshold, best=2000):
    n, f = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    frequent = {k: v for k, v in f.items() if v >= threshold}
    out = collections.defaultdict(list)
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        inside = any(
            len(other) > len(words) and v >= a and any(other[i:i + len(words)] == words for i in range(len(other)))
            for (l, other), v in frequent.items() if l == lang)
        if inside:
            continue
        score, _, left, right = min(
            (1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
            for k in range(1, len(words)))
        out[lang].append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
        for lang, own in out.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:best]))


def corpus(seed, copies=30):
    rnd = random.Random(seed)
    words = ["a", "B", "of", "the", "été", "ÉTÉ", "x\xa0y", "c-d", "日本", "\x00", "long" * 30]
    line = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", " \t ", ", ", ".", "\n", "\r\n", "\x0b"]) for _ in range(n))
    hot = "One two three four five six seven"
    rows = [(rnd.choice(["en", "en", "en", "de", None, "und", ""]), line(rnd.randint(0, 60))) for _ in range(120)]
    rows += [("en", hot), ("en", hot + " " + hot)] * copies + [("fr", hot.upper())] * 8
    rows += [("en", t) for t in (None, "", "  \t\n ", "a", "a a a a a a a a", "A " * 500, "... . ,;")]
    return rows


@pytest.mark.parametrize("threshold, best", [(8, 2000), (5, 3), (1000, 2000)])
def test_collocations_equal_brute_force(spark, threshold, best):
    rows = corpus(threshold)
    names = ["row", "words", "n", "f", "a", "phrase", "size", "chunk", "p", "hits", "body", "mass", "rank"]
    docs = spark.createDataFrame([(l, t, *range(len(names))) for l, t in rows], "lang string, text string, " + ", ".join(f"{n} int" for n in names))
    got = [tuple(r) for r in phrases.collocations(docs.repartition(5), threshold, best).collect()]
    assert sorted(got) == brute_force(rows, threshold, best)


def test_small_chunks_and_wide_hashes(spark, monkeypatch):
    rows = corpus(11)
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = brute_force(rows, 6)
    monkeypatch.setattr(phrases, "CHUNK", 200)
    monkeypatch.setattr(phrases, "SEGMENT", 64)
    monkeypatch.setattr(phrases, "PART_MASS", 50)
    assert sorted(tuple(r) for r in phrases.collocations(docs, 6).collect()) == want


def test_many_languages_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 60)
    rows = [(f"l{i % 40}", "so it goes, so it goes") for i in range(400)]
    got = sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(rows, "lang string, text string").coalesce(1), 20).collect())
    assert got == brute_force(rows, 20) and len(got) == 40


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([("x", 1, "u", 4 * 10**12), ("x", 1, "v", 3 * 10**12), ("x", 2, "u v", 10**12)], "lang string, size int, phrase string, f long")
    totals = spark.createDataFrame([("x", 9 * 10**15)], "lang string, n long")
    assert phrases.scored(counts, totals).first()["score"] == 1000 * 10**12 * 9 * 10**15 // (12 * 10**24)


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_summaries_keep_every_frequent_key():
    rnd = np.random.default_rng(5)
    stream = np.concatenate([rnd.integers(0, 1 << 20, 60_000), np.repeat(rnd.integers(0, 1 << 20, 40), 300)]).astype(np.uint64)
    rnd.shuffle(stream)
    true = collections.Counter(stream.tolist())
    summary = phrases.MisraGries(2 * (len(stream) // 300 + 1))
    for part in np.array_split(stream, 37):
        summary.add(*np.unique(part, return_counts=True))
        summary.settle()
        assert len(summary.keys) <= summary.capacity
    assert 0 < summary.lost < 300
    kept = set(summary.at_least(300).tolist())
    assert kept >= {k for k, v in true.items() if v >= 300} and len(kept) < 1000


@pytest.mark.parametrize("top", [300, 1 << 16, 1 << 40])
def test_summary_encoding_round_trip(top):
    rnd = np.random.default_rng(top)
    for size in (1, 2, 50, 3000):
        keys = np.unique(rnd.integers(0, top, size).astype(np.uint64))
        counts = rnd.integers(1, 2000, len(keys))
        a, b = phrases.unpacked(phrases.packed(keys, counts))
        assert (a == keys).all() and (b == counts).all()


