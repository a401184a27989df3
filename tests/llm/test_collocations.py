"""Collocations against a direct count of all phrases; summaries against their guarantee."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from perfwatch.llm import collocations as co

DOCS = "doc_id long, text string, lang string, phrase string, a string, n string"
SPLIT, WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_force(docs, longest, least, within, top):
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in SPLIT.split((text or "").translate(LOWER)):
            words = tuple(WORD.findall(piece))
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, words[i : i + size]) for i in range(len(words) - size + 1))
    chosen = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    rows = {}
    for (lang, words), a in chosen.items():
        longer = [b for (m, w), b in chosen.items() if m == lang and len(w) > len(words)
                  and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * b >= within * a for b in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, w.decode(), -a, left, right, n[lang], -score)
        for lang, found in rows.items() for rank, (score, a, w, left, right) in enumerate(sorted(found)[:top], 1)
    )


def result(spark, docs, **settings):
    wide = [(i, t, lang, "p", "q", "r") for i, (t, lang) in enumerate(docs)]
    found = co.collocations(spark.createDataFrame(wide, DOCS).repartition(5), **settings)
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found.collect())


def corpus(seed, docs):
    rng = random.Random(seed)
    words = ["the", "of", "The", "OF", "ÉTÉ", "été", "a b", "x", "y", "z", "\x00q", *(f"w{i}" for i in range(30))]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = [(None, "en"), ("", None), ("  . ,, \n", "de"), ("one", "fr")]
    for i in range(docs):
        tokens = rng.choices(words, weights, k=rng.choice([1, 3, 30, 200]))
        if rng.random() < 0.4:
            tokens[len(tokens) // 2 : len(tokens) // 2] = ["New", "york", "City", "hall"]
        text = tokens[0]
        for token in tokens[1:]:
            text += rng.choice([" "] * 12 + ["\t", "  ", ". ", ",", "\n", " ;", "!?", "\x0b"]) + token
        out.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    return out


def test_equals_direct_count(spark):
    for seed, least, within, top in ((1, 20, 100, 2000), (2, 12, 90, 15)):
        docs = corpus(seed, 250)
        docs += docs[:20]
        found = result(spark, docs, least=least, within=within, top=top)
        expected = brute_force(docs, 5, least, within, top)
        assert len(expected) > 30
        assert found == expected


def test_same_rows_with_many_partitions_and_small_summaries(spark, monkeypatch):
    docs = corpus(3, 200)
    expected = brute_force(docs, 5, 10, 100, 2000)
    monkeypatch.setattr(co, "HELD", 64)
    monkeypatch.setattr(co.frequent_phrases, "__defaults__", (co.LONGEST, co.LEAST, 100))
    assert result(spark, docs, least=10) == expected


def test_full_bitmap_loses_nothing(spark, monkeypatch):
    docs = corpus(4, 60)
    monkeypatch.setattr(co, "FILTER_BITS", 64)
    assert result(spark, docs, least=8) == brute_force(docs, 5, 8, 100, 2000)


def test_one_word_is_most_of_the_corpus(spark):
    docs = [("buffalo " * 2000, "en")] * 3 + [("a rare pair", "en")] * 5
    assert result(spark, docs, least=5) == brute_force(docs, 5, 5, 100, 2000)


def test_long_text_is_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(co.tx, "SLICE_BYTES", 50)
    rng = random.Random(5)
    text = "".join(rng.choice(["new york ", "of the ", "x, ", "y. ", "z "]) for _ in range(3000))
    runs = list(co._runs(co.pa.array([text, "a b"])))
    assert len(runs) > 20
    assert b"".join(x[2].tobytes() for x in runs) == (text + "a b").encode()


def test_empty_table(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, None)]) == []


def test_products_beyond_64_bits(spark):
    """Counts of 2**40 words, through the scoring alone."""
    big = 1 << 40
    rows = [("en", "", 0, big * 8), ("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 3)]
    frame = spark.createDataFrame(rows, "lang string, phrase string, size int, a long")
    original = co.frequent_phrases
    try:
        co.frequent_phrases = lambda *_: frame
        found = co.collocations(frame).collect()
    finally:
        co.frequent_phrases = original
    assert [r["score"] for r in found] == [1000 * (big - 3) * big * 8 // (big * (big - 1))]


def test_summaries_keep_every_frequent_item():
    rng = np.random.default_rng(6)
    for _ in range(20):
        least = int(rng.integers(3, 30))
        items = np.concatenate([rng.integers(0, 2000, 5000), rng.integers(2000, 2020, 2000)])
        rng.shuffle(items)
        exact = Counter(items.tolist())
        capacity = len(items) // least + 1
        merged = co.Summary(capacity)
        for part in np.array_split(items, 9):
            summary = co.Summary(capacity)
            for chunk in np.array_split(part, 4):
                values, counts = np.unique(chunk, return_counts=True)
                summary.add(np.zeros(len(values), np.int64), values.astype(np.uint64), counts)
                assert len(summary.h) <= capacity
            merged.lost[0] = merged.lost.get(0, 0) + summary.lost.get(0, 0)
            merged.add(summary.p, summary.h, summary.c)
            assert len(merged.h) <= capacity
        held = dict(zip(merged.h.tolist(), merged.c.tolist(), strict=True))
        lost = merged.lost.get(0, 0)
        assert lost < least
        for item, count in exact.items():
            assert held.get(item, 0) <= count <= held.get(item, 0) + lost
            assert count < least or item in held
