"""Collocations against brute force, and odd rows."""

import glob
import os
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tickloom.llm import common, phrases, queries

SF = "/root/testdata/sf0.001"


def brute(rows, least, longest, best):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    often = {p: c for p, c in f.items() if c >= least and len(p[1]) > 1}
    gone = set()
    for (lang, longer), c in often.items():
        for k in range(2, len(longer)):
            for i in range(len(longer) - k + 1):
                part = lang, longer[i : i + k]
                if 100 * c >= 80 * f[part]:
                    gone.add(part)
    out = []
    by = {}
    for (lang, p), a in often.items():
        if (lang, p) in gone:
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        by.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    for lang, found in by.items():
        out += [(lang, i, p.decode(), -a, le, r, n[lang], -s) for i, (s, a, p, le, r) in enumerate(sorted(found)[:best], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = brute([(r.lang, r.text) for r in docs], 30, 4, 2000)
    assert want and rows_of(queries.op12_phrases(spark, SF)) == want


def test_random_texts_of_few_words(spark, monkeypatch):
    rng = random.Random(3)
    words = ["a", "B", "c", "\U0001f642", "é", "\x00", "z" * 30]
    rows = [(rng.choice(["en", None, "", "de"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ".", " , ", "\r\n", "  "]) for _ in range(rng.randrange(120)))) for _ in range(60)]
    df = spark.createDataFrame([(lang, text) for lang, text in rows], "lang string, text string").repartition(3)
    want = brute([("" if lang == "" else lang, text) for lang, text in rows if lang != ""], 4, 5, 50)
    got = rows_of(phrases.collocations(df.where("lang is null or lang != ''"), least=4, longest=5, best=50))
    assert {r[0] for r in want} == {"en", "de", "und"}
    assert got == want


def test_tiles_count_what_sorting_counts():
    rng = np.random.default_rng(1)
    a, b = (np.concatenate([rng.integers(0, 1024, 400_000), rng.integers(900, 70_000, 30_000)]) for _ in "ab")
    got = np.concatenate([np.stack(x, 1) for x in phrases.count_pairs(a, b)])
    pairs, n = np.unique(np.stack([a, b], 1), axis=0, return_counts=True)
    assert sorted(map(tuple, got)) == sorted(map(tuple, np.column_stack([pairs, n])))
    far = np.array([1 << 40, 1 << 40, 3]), np.array([1, 1, 1 << 33])
    assert [[x.tolist() for x in y] for y in phrases.count_pairs(*far)] == [[[3, 1 << 40], [1 << 33, 1], [1, 2]]]


def test_odd_rows(spark):
    rows = [("en", None), ("en", ""), (None, "x y " * 40), ("en", " \t . "), ("de", "lorem ipsum dolor sit amet " * 20_000)]
    df = spark.createDataFrame(rows, "lang string, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("block", "n", "ids", "word", "place", "phrase", "id", "rank")})
    assert rows_of(phrases.collocations(df)) == brute(rows, 30, 4, 2000)
    assert phrases.collocations(df.limit(0)).count() == 0
    assert phrases.collocations(df.where("lang = 'en'")).count() == 0


def test_shuffle_files_of_stored_tables_go_at_once(spark):
    top = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")
    there = lambda: {f for deep in ("", "*/") for f in glob.glob(f"{top}/{deep}blockmgr-*/*/shuffle_*")}
    spark.range(1000).repartition(7, "id").write.format("noop").mode("overwrite").save()
    before = there()
    assert before
    even = spark.range(100_000).groupBy((F.col("id") % 1000).alias("k")).count()
    stored = common.written(even.join(spark.range(2000).toDF("k").hint("merge"), "k"), "even")
    assert not there() - before
    assert stored.count() == 1000 and spark.conf.get(common.CLEANUP, None) is None
