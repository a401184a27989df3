"""Findings against brute force; the ledger scans only what it has not seen."""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import replace

from perfwatch.llm import secret_scan as ss

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "b", "k", 1) for r in rows], "doc_id long, text string, blob string, kind string, start int")


def brute(text):
    text = text or ""
    any_case = re.compile(ASSIGN.pattern.replace("(password|passwd|secret|token|api_?key)", "(" + "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token", "api_?key")) + ")"))
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in any_case.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    spans = ",".join(s for *_, s in sorted(found))
    return (*(sum(f[1] == i for f in found) for i in range(3)), hashlib.sha256(spans.encode()).hexdigest())


def texts():
    rng = random.Random(4)
    parts = [
        "token", "TOKEN ", "Secret", ": ", "=", '"', "'", "abc", "abcdef", "AKIA", "ABCDEFGH01234567", "0123456789abcdef", "api_key", "APIKEY=", "é", "\n", " ",
        "passwd", "paſswd", "toKen=", "password:'x/y+z.1'", "x.y-z_1",
    ]
    out = [None, "", "no secrets here", "token=token=abcdefgh", 'secret: "token: abcdef"', "AKIAAKIA" * 4, "f" * 24, "f" * 23, "é" * 9 + "ab" * 12]
    out += ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300)]
    return out + ["word " * 50_000 + "token = 'abcdef0123456789abcdef0123456789'"]


def test_base_spans_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in ss.scan(frame(spark, rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}
    assert sum(v[0] for v in got.values()) > 20 and sum(v[1] for v in got.values()) > 5


def test_own_kinds_are_added(spark):
    text = "-----BEGIN RSA PRIVATE KEY-----\n ghp_" + "A1b2" * 9 + " https://bob:hunter2@host/x xoxb-1234567890-abc token=abcdef"
    (r,) = ss.scan(frame(spark, [(1, text)])).collect()
    kinds = [s.split(":")[0] for s in r.spans.split(",")]
    assert kinds == ["private_key", "github", "url_password", "slack", "assign"] and r.n_assign == 1
    assert r.base_sha256 == brute(text)[3]


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "token=abcdef"), (1, "token=abcdef"), (1, "other"), (2, "token=abcdef"), (None, "token=abcdef"), (None, None), (3, "")]
    got = sorted(((r.doc_id, r.n_assign, r.spans) for r in ss.scan(frame(spark, rows)).collect()), key=repr)
    hit = (1, "assign:0:12")
    assert got == sorted([(1, *hit), (1, *hit), (1, 0, ""), (2, *hit), (None, *hit), (None, 0, ""), (3, 0, "")], key=repr)
    assert ss.scan(frame(spark, [])).collect() == []


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    first, second = [(1, "token=abcdef"), (2, "plain")], [(3, "token=abcdef"), (4, "secret=ghijkl"), (2, "plain")]

    def scanned():
        return sorted((r.blob[:6], r.kind, r.version) for r in spark.read.parquet(f"{ledger}/scanned").collect())

    ss.scan(frame(spark, first), ledger).collect()
    assert len(scanned()) == 2 * len(ss.RULES)
    got = {r.doc_id: r.n_assign for r in ss.scan(frame(spark, second), ledger).collect()}
    assert got == {3: 1, 4: 1, 2: 0} and len(scanned()) == len(set(scanned())) == 3 * len(ss.RULES)
    newer = (replace(ss.RULES[0], version=2, least=7), *ss.RULES[1:])
    got = {r.doc_id: r.n_assign for r in ss.scan(frame(spark, second), ledger, newer).collect()}
    assert got == {3: 0, 4: 0, 2: 0} and len(scanned()) == 3 * len(ss.RULES) + 3
    # A run that died after its findings were written, and before the ledger was, is repeated without doubles.
    spark.read.parquet(f"{ledger}/findings").write.parquet(f"{ledger}-again/findings")
    got = {r.doc_id: r.n_assign for r in ss.scan(frame(spark, second), f"{ledger}-again").collect()}
    assert got == {3: 1, 4: 1, 2: 0}
