"""Periodic runs against brute force, and odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import queries, runs

SF = "/root/testdata/sf0.001"


def brute(words):
    """All runs, by extending every place for every period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= 12:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_every_residue_is_a_difference_of_the_cover():
    assert {(a - b) % runs.MODULUS for a in runs.COVER for b in runs.COVER} == set(range(runs.MODULUS))


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_extensions(letters):
    rng = np.random.default_rng(letters)
    ids = np.r_[rng.integers(0, letters, 900), letters, np.tile(rng.integers(0, letters, 37), 20), letters + 1]
    extend = runs.Extensions(ids)
    a = rng.integers(0, len(ids) - 1, 4000)
    b = (a + rng.integers(1, len(ids) - 1, 4000)) % len(ids)
    for x, y, n in zip(a, b, extend(a, b), strict=True):
        k = 0
        while max(x, y) + k < len(ids) and ids[x + k] == ids[y + k]:
            k += 1
        assert k == n


def test_runs_of_random_texts(monkeypatch):
    monkeypatch.setattr(runs, "PAIRS", 50)
    monkeypatch.setattr(runs, "TOGETHER", 300)
    rng = random.Random(5)
    texts = []
    for letters in (1, 2, 2, 2, 3, 30) * 12:
        words = [str(rng.randrange(letters)) for _ in range(rng.randrange(0, 90))]
        for _ in range(rng.randrange(3)):
            at, some = rng.randrange(len(words) + 1), rng.randrange(1, 12)
            words[at:at] = words[at : at + some] * rng.randrange(1, 6)
        texts.append(words)
    got = [pair for part in runs._together([" ".join(t).encode() for t in texts]) for pair in zip(*part, strict=True)]
    for words, (rows, text) in zip(texts, got, strict=True):
        want = brute(words)
        assert [tuple(r.values()) for r in rows] == want
        assert text.decode() == collapsed(words, want)


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_runs(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    planted = 0
    for r in rows:
        words = split(docs[r.doc_id])
        h = zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if n > 3000 and h % 10:
            continue  # brute force is quadratic
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        found = brute(words) if n <= 3000 else None
        if found is None:
            continue
        assert r.n_runs == len(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()
    assert planted > 5


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n "), (None, "a " * 40), (5, "a " * 40), (5, "a " * 40), (6, "lorem ipsum dolor sit amet " * 20_000), (7, "x y " * 6 + " \U0001f642 \x1c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("id", "runs", "n_kept", "collapsed", "start")})
    got = [(r.doc_id, r.n_kept, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(df).collect()]
    assert sorted(x for x in got if x[0] in (1, 2, 3)) == [(k, 0, [], "") for k in (1, 2, 3)]
    assert [x[1:] for x in got if x[0] in (None, 5)] == [(1, [(0, 40, 1)], "a")] * 3
    assert [x[1:] for x in got if x[0] == 6] == [(5, [(0, 100_000, 5)], "lorem ipsum dolor sit amet")]
    assert [x[1:] for x in got if x[0] == 7] == [(4, [(0, 12, 2)], "x y  \U0001f642 \x1c")]
    assert runs.periodic_runs(df.limit(0)).count() == 0
