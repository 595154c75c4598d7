"""Registered corpus queries against their SQL, or against brute force and held-out rows."""

import hashlib
import re
import zlib

import pytest

import __spark_entry__ as contract
import oracle
from feedlake.llm.oracles import ORACLES
from feedlake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, sf, name):
    assert oracle.difference(QUERIES[name](spark, sf), duck, ORACLES[name]) is None


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_languages_of_held_out_rows(spark, duck, sf):
    rows = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, sf).collect()}
    true = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    assert set(rows) == set(true)
    for doc_id, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [d for d in rows if rows[d]["held_out"]]
    assert sum(rows[d]["lang_pred"] == true[d] for d in held) >= 0.98 * len(held)


def test_quality_of_held_out_rows(spark, duck):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, sf).collect()}
    con = oracle.connect(sf)
    labels = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    held = [(rows[d], q) for d, q in labels if rows[d]["held_out"]]
    good, bad = [r["score"] for r, q in held if q == 1], [r["score"] for r, q in held if q == 0]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    assert wins >= 0.97 * len(good) * len(bad)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())


def secrets_plainly(text):
    text, found = text or "", []
    letters = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password")
    words = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    assert letters in words
    for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            found.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            found.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            found.append((m.start(), 2, "hex", m.end()))
    return sorted(found)


def test_secrets_equal_plain_search(spark, duck, sf):
    rows = {r["doc_id"]: r for r in QUERIES["op10_secret_scan"](spark, sf).collect()}
    texts = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    assert len(rows) == len(texts)
    for doc_id, text in texts:
        found, r = secrets_plainly(text), rows[doc_id]
        assert [sum(f[2] == k for f in found) for k in ("assign", "access", "hex")] == [r["n_assign"], r["n_access"], r["n_hex"]]
        listed = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
