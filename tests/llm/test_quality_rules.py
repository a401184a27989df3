"""Counts against brute force, the binomial bound, and the guarantee on held-out labels."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from perfwatch.llm import quality_rules as q
from perfwatch.llm import sql

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, text string, lang string, n_words int, good int, stratum string")


def labels(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, quality int, toxic int, lang string")


def brute(text):
    w = [x for x in SPACE.split(text or "") if x]
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(runs)
    covered = {j for i, r in enumerate(runs) if n[r] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


def test_counts_equal_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", " \n ", "a", "a b c", "a b c a b c", "a a a a a", "x\n\nx\n x\nx", "é|ü b\tc\x0bd\r\ne#", "\u2028x　y"]
    for _ in range(60):
        texts.append("".join(rng.choice(["a ", "b ", "c\n", "d\n", "é#* ", "\t"]) for _ in range(rng.randrange(120))))
    texts.append("long " + " ".join(str(rng.randrange(300)) for _ in range(60_000)))
    rows = frame(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = {r.doc_id: tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for r in q.counts(rows, "doc_id").collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_binomial_tail_is_exact(spark):
    cases = [(0, 0, 0.01), (1, 0, 0.5), (10, 0, 0.3), (10, 2, 0.3), (500, 3, 0.01), (20_000, 60, 0.004), (400_000, 300, 0.001), (50, 25, 0.4)]
    for n, k, p in cases:
        got = spark.range(1).select(q.binomial_tail(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("x")).first().x
        terms = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p) for j in range(k + 1)]
        assert got == pytest.approx(1.0 if k >= n * p else sum(map(math.exp, terms)), rel=1e-9)


def documents(spark, n, seed):
    rng = random.Random(seed)
    rows, marks = [], []
    for i in range(n):
        bad = rng.random() < 0.3
        words = [f"w{rng.randrange(5000)}" + ("***" if bad and rng.random() < 0.8 or rng.random() < 0.01 else "") for _ in range(70)]
        rows.append((i, " ".join(words), "aa" if i % 3 else "bb"))
        marks.append((i, 0 if bad else 1, 0))
    return frame(spark, rows), labels(spark, marks)


def test_bad_texts_go_and_few_good_ones_do(spark):
    docs, marks = documents(spark, 12_000, 1)
    got = q.judge(docs, marks).join(marks.select("doc_id", "quality"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()
    share = {r.quality: r.k for r in got}
    assert share[1] >= 1 - q.ALPHA and share[0] < 0.1


def test_few_labels_select_nothing(spark):
    docs, marks = documents(spark, 300, 2)
    assert q.judge(docs, marks).filter("NOT kept AND NOT base_failed").count() == 0


def test_nulls_repeats_and_empty_tables_as_in_sql(spark, tmp_path):
    docs, marks = documents(spark, 6_000, 3)
    odd = [(9001, None, None), (9002, "", "aa"), (None, "a b " * 60, "aa"), (9003, "| " * 80, None), (9003, "| " * 80, None)]
    docs = docs.union(frame(spark, odd))
    marks = marks.union(labels(spark, [(1, 0, 0), (9003, None, 1), (None, 1, 0), (77777, 1, 0)]))
    con = duckdb.connect()
    for name, table in (("documents", docs), ("labels", marks)):
        table.write.parquet(f"{tmp_path}/{name}")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    want = sorted(con.execute(sql.QUALITY_RULES).fetchall(), key=repr)
    assert sorted((tuple(r) for r in q.judge(docs, marks).collect()), key=repr) == want
    assert any(not r[-1] and not r[-2] for r in want)
    none = frame(spark, [])
    assert q.judge(none, marks).collect() == [] and q.judge(docs, labels(spark, [])).count() == docs.count()


def test_other_line_ends_are_words(spark):
    """U+0085, U+2028 and U+2029 at the end of a text are no white space of the rules."""
    texts = [f"abc {end}" for end in "\u0085\u2028\u2029"] + ["a b \u2028 ", "\u2029 a", "a\u2028", " a \n", "\u2028"]
    found = q.counts(frame(spark, [(i, t, "en") for i, t in enumerate(texts)]), "doc_id").collect()
    assert {r["doc_id"]: r["n_words"] for r in found} == {i: brute(t)[0] for i, t in enumerate(texts)}
