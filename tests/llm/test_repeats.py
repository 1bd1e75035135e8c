"""Repeated byte strings against brute force, and odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import queries, repeats

SF = "/root/testdata/sf0.001"


def brute(texts, width):
    """Spans to remove of each text."""
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        spans = []
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + width
                else:
                    spans.append([i, i + width])
        out.append([tuple(s) for s in spans])
    return out


def kept(text, spans):
    edges = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def lcp(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("letters", [b"a", b"ab", b"ab\0", bytes(range(256))])
def test_deep_shallow_sorts_and_knows_what_neighbours_share(letters):
    rng = random.Random(len(letters))
    pool = [bytes(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(8)]
    strings = [rng.choice(pool)[: rng.randrange(200)] + rng.choice(pool)[: rng.randrange(90)] for _ in range(300)]
    group = np.array([rng.randrange(4) for _ in strings])
    order, common = repeats.deep_shallow(strings, group)
    assert sorted(order.tolist()) == list(range(300))
    for k, (at, n) in enumerate(zip(order.tolist(), common.tolist(), strict=True)):
        if k and group[order[k - 1]] == group[at]:
            before = strings[order[k - 1]]
            assert n == lcp(before, strings[at])
            # Up to the depth of the symbols, an end counts as a zero byte.
            assert before[:64].ljust(64, b"\0") <= strings[at][:64].ljust(64, b"\0")
        else:
            assert n == -1


def test_equal_windows_are_in_pieces_of_one_core():
    rng = random.Random(2)
    pool = [bytes(rng.choice(b"abcd") for _ in range(150)) for _ in range(6)]
    texts = [b"".join(rng.choice(pool)[: rng.randrange(150)] for _ in range(rng.randrange(9))) for _ in range(60)] + [b"x" * 300, b"", b"xy" * 90]
    cutter = repeats.Pieces(40, 8, 700)
    start, windows, anchor, key = cutter(b"".join(texts), np.cumsum([len(t) for t in texts]))
    data = b"".join(texts)
    cores = {}
    places = set()
    for s, n, a, k in zip(start.tolist(), windows.tolist(), anchor.tolist(), key.tolist(), strict=True):
        for i in range(s, s + n):
            places.add(i)
            assert cores.setdefault(data[i : i + 40], (a - i, k)) == (a - i, k)
    ends = np.cumsum([len(t) for t in texts])
    assert places == {i for e, t in zip(ends.tolist(), texts, strict=True) for i in range(e - len(t), e - 39)}


@pytest.mark.parametrize("together", [4096, 3])
def test_random_texts(spark, monkeypatch, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    monkeypatch.setattr(repeats, "SORTED", 20_000)
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdeé ") for _ in range(n))
    pool = [word(rng.randrange(30, 300)) for _ in range(12)]
    texts = []
    for _ in range(150):
        parts = [rng.choice(pool) if rng.random() < 0.5 else word(rng.randrange(80)) for _ in range(rng.randrange(8))]
        if rng.random() < 0.3:
            parts = [p[rng.randrange(20) :] for p in parts]
        texts.append("".join(parts))
    texts += texts[:10] + ["ab" * 300, "a" * 500, "a" * 100, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    bytes_ = [(t or "").encode() for t in texts]
    want = brute(bytes_, 50)
    assert sum(map(bool, want)) > 80 and sum(not w for w in want) > 5
    rows = {r.doc_id: r for r in repeats.remove_repeats(df, width=50, gram=12, segment=900).collect()}
    for k, (text, spans) in enumerate(zip(bytes_, want, strict=True)):
        assert [tuple(s) for s in rows[k].removed] == spans, k
        assert bytes(rows[k].kept) == kept(text, spans) and rows[k].n_bytes == len(text)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = [(r.text or "").encode() for r in docs]
    want = {r.doc_id: (len(t), sum(b - a for a, b in s), len(s), hashlib.sha256(kept(t, s)).hexdigest()) for r, t, s in zip(docs, texts, brute(texts, 400), strict=True)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_repeats(spark, SF).collect()}
    assert any(w[2] for w in want.values())
    assert got == want


def test_odd_rows(spark):
    long = "lorem ipsum dolor sit amet " * 20_000
    other = "".join(chr(0x3B1 + (i * i * 7 + i // 11) % 23) for i in range(700))
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (None, other), (None, other), (6, long), (7, other[:150])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("id", "print", "key", "begin", "spans", "kept", "bit")})
    got = sorted((r.doc_id or 0, r.n_bytes, len(r.removed), len(r.kept)) for r in repeats.remove_repeats(df).collect())
    assert got == [(0, 1400, 1, 0), (0, 1400, 1, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 5, 0, 5), (3, 5, 0, 5), (6, len(long), 1, 0), (7, 300, 0, 300)]
    assert repeats.remove_repeats(df.limit(0)).count() == 0
