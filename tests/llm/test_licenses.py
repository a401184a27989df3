"""Spans against brute force and the SQL twin."""

from __future__ import annotations

import random
import re

import duckdb

from perfwatch.llm import licenses as lic
from perfwatch.llm import sql

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "l", 1, 2) for r in rows], "doc_id long, text string, label string, p int, text_hash int")


def base(text):
    w = WORD.findall((text or "").translate(LOWER))
    at, labels = [], set()
    for label, phrases in lic.PHRASES.items():
        for phrase in phrases:
            x = phrase.split()
            found = [i for i in range(len(w)) if w[i : i + len(x)] == x]
            at += found
            labels |= {label} if found else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def texts():
    rng = random.Random(8)
    mit, apache = lic.NOTICES["mit"][1], lic.NOTICES["apache-2.0"][1]
    filler = lambda n: " ".join(f"w{rng.randrange(50)}" for _ in range(n))
    out = [
        None, "", "cc", "CC-BY 4.0", "cc by cc by", "GNU General Public\nLicense; all rights reserved", "general public", "éall rights reserved",
        "All rights Kreserved", "all rİghts reserved all  RIGHTS  reserved", "acc by", filler(300), f"{filler(30)} {mit} {filler(20)} {mit}",
        f"{filler(5)} {apache.upper()}.", " ".join(w for i, w in enumerate(mit.split()) if i % 12) + filler(9), " ".join(mit.split()[:15]),
        "Released under the MIT License.", "released under a mit license", "Licensed under CC BY-NC 4.0", "cc by " * 40_000, f"{filler(60_000)} all rights reserved",
    ]
    return out + [" ".join(rng.choice("cc by general public license all rights reserved of the".split()) for _ in range(40)) for _ in range(30)]


def test_base_places_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in lic.scan(frame(spark, rows)).collect()}
    assert got == {i: base(t) for i, t in rows}


def test_notices_with_changes_are_found_and_others_are_not(spark):
    t = texts()
    got = {r.doc_id: (r.labels, r.score) for r in lic.scan(frame(spark, list(enumerate(t)))).collect()}
    assert got[12] == ("mit", 1.0) and got[13] == ("apache-2.0", 1.0) and got[16] == ("mit", 1.0)
    assert got[14][0] == "mit" and 0.6 <= got[14][1] < 1
    assert got[15] == ("", 0.0) and got[17] == ("", 0.0) and got[11] == ("", 0.0)
    assert got[18] == ("cc-by,cc-by-nc", 1.0)
    n = len(lic.NOTICES["mit"][1].split())
    spans = lic.spans(frame(spark, [(1, t[12])])).orderBy("first_word").collect()
    assert [(s.label, s.first_word, s.last_word) for s in spans] == [("mit", 30, 29 + n), ("mit", 50 + n, 49 + 2 * n)]


def test_nulls_and_repeated_rows_as_in_sql(spark, tmp_path):
    rows = list(enumerate(texts())) + [(3, "CC-BY 4.0"), (3, "other all rights reserved"), (None, "cc by"), (None, None)]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    want = sorted(con.execute(sql.LICENSES).fetchall(), key=repr)
    assert sorted((tuple(r) for r in lic.scan(docs).collect()), key=repr) == want
    assert lic.scan(frame(spark, [])).collect() == []


def test_added_words_anywhere_do_not_split_a_notice(spark):
    w = lic.NOTICES["apache-2.0"][1].split()
    rng = random.Random(3)
    rows = [" ".join([*w[:i], "added", *w[i:]]) for i in range(1, len(w))]
    for _ in range(150):
        i, j = sorted(rng.sample(range(1, len(w)), 2))
        rows.append(" ".join([*w[:i], "added", *w[i:j], "more", *w[j:]]))
    rows.append(" ".join(x for i, v in enumerate(w) for x in (["dnl", v] if i % 12 == 0 else [v])))
    got = {r.doc_id: (r.labels, r.score) for r in lic.scan(frame(spark, list(enumerate(rows)))).collect()}
    assert {i for i, (labels, _) in got.items() if labels != "apache-2.0"} == set()
    assert min(score for _, score in got.values()) > 0.85
