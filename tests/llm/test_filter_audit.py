"""Filter audit against one pass over documents for each of the 120 orders."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from perfwatch.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, mask string, n string"
LABELS = "doc_id long, quality int, toxic int"
VALUES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute_force(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = defaultdict(list)
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and first[text] < i,
        }
        rows[source or ""].append(({f for f in fails if fails[f]}, i in good, i in toxic))
    out = {}
    for part, members in rows.items():
        total = Counter()
        for order in permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                gone, left = [m for m in left if f in m[0]], [m for m in left if f not in m[0]]
                failing = sum(f in m[0] for m in members)
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), failing - len(gone), sum(m[0] == {f} for m in members),
                    sum(m[1] for m in gone), sum(m[2] for m in gone), f,
                ]
        for (p, _, _), values in out.items():
            if p == part:
                values[-1] = total[values[-1]]
    return {k: tuple(v) for k, v in out.items()}


def result(spark, docs, labels):
    wide = [(i, t, s, "x", "y", "z") for i, t, s in docs]
    rows = filter_audit.audit(spark.createDataFrame(wide, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in VALUES) for r in rows}
    assert len(found) == len(rows)
    return found


def test_equals_one_pass_per_order(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = [None, "", "a b", "A" * 9, "x # y", "é" * 40 + " B"]
    for _ in range(60):
        few = rng.random() < 0.3
        text = " ".join(rng.choice(words[: 20 if few else 300]) for _ in range(rng.choice([150, 199, 200, 210, 400])))
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice("#$%&*|")
        texts.append(text)
    docs = []
    for i in range(200):
        docs.append((i, rng.choice(texts), rng.choice([None, "", "a", "b", "çé"])))
    docs += docs[:5] + [(7, texts[9], "b"), (None, texts[9], "a"), (None, None, None)]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(150)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (9999, 1, 1)]
    assert result(spark, docs, labels) == brute_force(docs, labels)


def test_one_text_a_third_of_the_table(spark):
    docs = [(i, "same text", "a") for i in range(300)] + [(1000 + i, f"text {i}", "b") for i in range(600)]
    found = result(spark, docs, [])
    assert found["a", "EABCD", 1] == (1, 299, 0, 0, 0, 0, found["a", "EABCD", 1][-1])
    assert found == brute_force(docs, [])


def test_empty_tables(spark):
    assert result(spark, [], []) == {}
    assert len(result(spark, [(1, None, None)], [])) == 600


def test_intervals_partition_the_ranks():
    for filters in range(1, 6):
        steps = Counter()
        for mask, _, lo, hi in filter_audit.intervals(filters):
            for rank in range(lo, hi):
                steps[mask, rank] += 1
        orders = len(list(permutations(range(filters))))
        assert len(steps) == ((1 << filters) - 1) * orders
        assert set(steps.values()) == {1}


def test_long_text_is_cut_at_white_space():
    text = ("ab cd\tef\n" * 300_000).encode()
    assert filter_audit.word_counts(text) == (900_000, 3)
    assert filter_audit.word_counts(b"x" * 3_000_000) == (1, 1)
    assert filter_audit.word_counts(b"") == (0, 0)
