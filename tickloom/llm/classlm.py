"""Brown class-based n-gram scoring.

Exchange clustering assigns words to classes so that the classes' bigrams are as likely as can be: the most frequent words
among each other first, then every other word that occurs twice, by the classes that stand around it. Words seen once make
the class of those never seen. A text's probability is the product of class transitions and of the words' emissions from
their classes, both smoothed. Which class a word has, and how often it occurs, is a table that grows with the corpus; a
bounded number of the most frequent words travels with the tasks, all others are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import discard, raw, remainder, written

#: Words that are exchanged among each other before all others, classes, and words that travel with the tasks.
HEAD, CLASSES, CARRIED = 20_000, 48, 200_000
#: A round that adds less than this to the log-likelihood of a token is the last.
LEAST_GAIN = 0.002
#: Words whose moves a task weighs at a time.
TOGETHER = 512
#: The seed of words' keys.
SEED = 42
#: Additive smoothing of words, and the weight of class frequencies in a transition.
DELTA, TRANSITION = 0.1, 20.0
#: Distinct words that a task counts before it passes them on.
FLUSH = 400_000
END = b""


def _words(text: bytes) -> list[bytes]:
    """A-Z in lower case, split at blanks; bytes methods know ASCII alone."""
    return text.lower().split()


def count_words(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(word, n) over all texts; every text also counts one end, which is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"])
        for batch in batches:
            for text in raw(batch.column(0)):
                seen.update(_words(text))
                seen[END] += 1
                if len(seen) >= FLUSH:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    part = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def key_of(word: bytes) -> int:
    """A word outside the head as a number below zero; `_key` is the same in SQL."""
    return -1 - (xxhash.xxh64_intdigest(word, SEED) >> 1)


def _key(word: str) -> Column:
    return -1 - F.shiftrightunsigned(F.xxhash64(word), 1)


def _codes(text: bytes, types: dict[bytes, int]) -> np.ndarray:
    """A text between two ends: types of the head's words, keys of all others."""
    words = _words(text)
    out = np.zeros(len(words) + 2, np.int64)
    out[1:-1] = np.fromiter((t if (t := types.get(w)) is not None else key_of(w) for w in words), np.int64, len(words))
    return out


def _types(head: list[bytes]) -> dict[bytes, int]:
    """The end is type 0, the head's words follow."""
    return {END: 0} | {w: i for i, w in enumerate(head, 1)}


def _lookup(values: np.ndarray, kind: str) -> Column:
    """The values as a literal array; one text, since an expression for each would take long to plan."""
    return F.split(F.lit(" ".join(map(str, values.tolist()))), " ").cast(f"array<{kind}>")


def count_bigrams(docs: DataFrame, head: list[bytes], text_column: str = "text") -> DataFrame:
    """(a, b, n): how often type b of the head follows type a; a text stands between two ends."""
    types, size = _types(head), len(head) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for text in raw(batch.column(0)):
                codes = np.fromiter(map(types.get, _words(text), repeat(-1)), np.int64)
                codes = np.concatenate([[0], codes, [0]])
                a, b = codes[:-1], codes[1:]
                both = (a >= 0) & (b >= 0)
                held.append(a[both] * size + b[both])
                n += len(held[-1])
                if n >= 4 * FLUSH:
                    yield _counted(held)
                    held, n = [], 0
        if held:
            yield _counted(held)

    part = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(run, "pair long, n long")
    pairs = part.groupBy("pair").agg(F.sum("n").alias("n"))
    return pairs.select(F.expr(f"int(pair div {size})").alias("a"), F.expr(f"int(pair % {size})").alias("b"), "n")


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    pairs, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_pydict({"pair": pairs, "n": n})


def count_around(docs: DataFrame, head: list[bytes], classes: np.ndarray, text_column: str = "text") -> DataFrame:
    """(key, other, side, n) of all words outside the head: how often a neighbour follows (side 0) or precedes (side 1).

    `other` is the class of a neighbour in the head, else the key of the word that follows (side 0 only).
    """
    types = _types(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[int, int, int]] = Counter()

        def out() -> pa.RecordBatch:
            key, other, side = np.array(list(seen), np.int64).T
            n = np.array(list(seen.values()), np.int64)
            seen.clear()
            return pa.RecordBatch.from_pydict({"key": key, "other": other, "side": side, "n": n})

        for batch in batches:
            for text in raw(batch.column(0)):
                codes = _codes(text, types)
                codes = np.where(codes >= 0, classes[np.maximum(codes, 0)], codes)
                a, b = codes[:-1], codes[1:]
                for x, y, pick, side in ((a, b, a < 0, 0), (b, a, (b < 0) & (a >= 0), 1)):
                    seen.update(zip(x[pick].tolist(), y[pick].tolist(), repeat(side), strict=False))
                if len(seen) >= FLUSH:
                    yield out()
        if seen:
            yield out()

    part = docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(run, "key long, other long, side long, n long")
    return part.groupBy("key", "other", "side").agg(F.sum("n").alias("n"))


def _table(sums: DataFrame, size: int) -> np.ndarray:
    """N(c, d) from rows (c, d, n), collected: as many figures as there are pairs of classes."""
    out = np.zeros((size, size))
    for r in sums.groupBy("c", "d").agg(F.sum("n").alias("n")).collect():
        out[r.c, r.d] = r.n
    return out


def _head_counts(bigrams: DataFrame, classes: np.ndarray, size: int) -> np.ndarray:
    of = _lookup(classes, "int")
    return _table(bigrams.select(of[F.col("a")].alias("c"), of[F.col("b")].alias("d"), "n"), size)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-12))


def likelihood(counts: np.ndarray) -> float:
    """What of the bigrams' log-likelihood depends on the classes."""
    return float(_xlogx(counts).sum() - _xlogx(counts.sum(0)).sum() - _xlogx(counts.sum(1)).sum())


def best_moves(counts: np.ndarray, old: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray, movable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes, gains) of the best class for each of several words, each moving alone out of its class in `old`.

    Rows of `after` and `before` count the classes of the words that follow and precede a word, `own` counts it after itself.
    """
    b, is_old = np.arange(len(old)), np.zeros(after.shape)
    is_old[b, old] = 1
    out, come = after - is_old * own[:, None], before - is_old * own[:, None]
    leaving, coming = after.sum(1)[:, None], before.sum(1)[:, None]
    rows, columns = counts.sum(1) - is_old * leaving, counts.sum(0) - is_old * coming
    corner = counts.diagonal() - is_old * (after[b, old] + before[b, old] - own)[:, None]
    # The class's own cell takes from both sides at once.
    value = _xlogx(corner + out + come + own[:, None]) + _xlogx(corner) - _xlogx(corner + out) - _xlogx(corner + come)
    value -= _xlogx(rows + leaving) - _xlogx(rows) + _xlogx(columns + coming) - _xlogx(columns)
    for moved, mine, others, cells in ((out, after, before, counts.T), (come, before, after, counts)):
        w, d = np.nonzero(moved)
        if not len(w):
            continue
        home = (d == old[w])[:, None]
        cell = cells[d] - is_old[w] * mine[w, d][:, None] - home * (others[w] - is_old[w] * own[w][:, None])
        gained = _xlogx(cell + moved[w, d][:, None]) - _xlogx(cell)
        words, first = np.unique(w, return_index=True)
        value[words] += np.add.reduceat(gained, first, axis=0)
    best = movable[value[:, movable].argmax(1)]
    return best, value[b, best] - value[b, old]


def best_move(counts: np.ndarray, old: int, after: np.ndarray, before: np.ndarray, own: float, movable: np.ndarray) -> tuple[int, float]:
    """`best_moves` for one word."""
    best, gain = best_moves(counts, np.array([old]), after[None], before[None], np.array([own]), movable)
    return int(best[0]), float(gain[0])


def _moves(near: DataFrame, table: np.ndarray, movable: np.ndarray) -> DataFrame:
    """(word, class, gain): the best class of each row (word, class, near), `near` listing (side, class, n, own)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, TOGETHER):
                words, now, lists = whole.slice(begin, TOGETHER).columns
                flat, row = lists.flatten(), np.repeat(np.arange(len(words)), lists.value_lengths().to_numpy(zero_copy_only=False))
                side, other, n, own = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                sums, same = np.zeros((2, len(words), len(table))), np.zeros(len(words))
                np.add.at(sums, (side, row, other), n)
                np.add.at(same, row, own)
                best, gain = best_moves(table, now.to_numpy(zero_copy_only=False), *sums, same, movable)
                yield pa.RecordBatch.from_pydict({"word": words, "class": pa.array(best, pa.int32()), "gain": pa.array(gain, pa.float64())})

    return near.select(F.col("word").cast("long"), F.col("class").cast("int"), "near").mapInArrow(run, "word long, class int, gain double")


def _near(word: str, other: Column, side: int, own: Column) -> list[Column]:
    return [F.col(word).alias("word"), F.lit(side).alias("side"), other.cast("int").alias("other"), "n", own.alias("own")]


def _listed(near: DataFrame) -> DataFrame:
    """(word, near): a word's neighbouring classes, at most two for each class."""
    sums = near.groupBy("word", "side", "other").agg(F.sum("n").alias("n"), F.sum("own").alias("own"))
    return sums.groupBy("word").agg(F.collect_list(F.struct("side", "other", "n", "own")).alias("near"))


def exchange(bigrams: DataFrame, head: int, classes: int = CLASSES) -> np.ndarray:
    """The class of every type of the head: 0 for the end, then 1 to `classes`.

    Spark gathers each word's neighbouring classes and tasks find each word's best class against the counts of the round;
    half of the words move in a round, so that two that belong together don't pass each other. When neither half's round
    adds LEAST_GAIN for a token, the best round stays.
    """
    classes = min(classes, max(1, head))
    assigned = np.array([0, *(1 + i % classes for i in range(head))])
    counts = _head_counts(bigrams, assigned, classes + 1)
    best, best_value, idle, at = assigned.copy(), likelihood(counts), 0, 0
    while idle < 2 and head > 1 and classes > 1:
        of = _lookup(assigned, "int")
        own = F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)
        sides = [bigrams.where((F.col(w) > 0) & (F.col(w) % 2 == at % 2)).select(*_near(w, of[F.col(o)], side, own if side == 0 else F.lit(0))) for w, o, side in (("a", "b", 0), ("b", "a", 1))]
        near = _listed(sides[0].unionByName(sides[1])).withColumn("class", of[F.col("word").cast("int")])
        for r in _moves(near, counts, np.arange(1, classes + 1)).where("gain > 1e-6").collect():  # at most half of the head
            assigned[r["word"]] = r["class"]
        counts = _head_counts(bigrams, assigned, classes + 1)
        idle = 0 if (value := likelihood(counts)) - best_value > LEAST_GAIN * counts.sum() else idle + 1
        if value > best_value:
            best, best_value = assigned.copy(), value
        at += 1
    return best


def place(around: DataFrame, words: DataFrame, head_counts: np.ndarray, rare: int) -> tuple[DataFrame, np.ndarray]:
    """((key, class) of `words`, N(c, d) of all words): the classes of the words outside the head.

    Every word begins in the class `rare`, where those stay that `words` lacks, and moves to its best class by the classes
    around it, in rounds until one adds less than LEAST_GAIN for a token; the best round stays.
    """
    size, movable = rare + 1, np.arange(1, rare) if rare > 1 else np.array([rare])
    fixed = around.where("other >= 0")
    beside = written(_listed(fixed.select(*_near("key", F.col("other"), 0, F.lit(0)), F.col("side").alias("s")).drop("side").withColumnRenamed("s", "side")), "beside")
    pairs = written(around.where("other < 0").select(F.col("key").alias("a"), F.col("other").alias("b"), "n"), "tail-pairs")
    discard(around)
    best, best_counts, best_value = None, head_counts, -np.inf
    now = written(words.select("key", F.lit(rare).alias("class")), "placed")
    while True:
        side = lambda c: now.select(F.col("key").alias(c), F.col("class").alias(f"of_{c}"))  # noqa: E731, B023
        joined = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
        joined = written(joined.select("a", "b", "n", F.coalesce("of_a", F.lit(rare)).alias("of_a"), F.coalesce("of_b", F.lit(rare)).alias("of_b")), "tail-classes")
        lists = beside.join(now, beside.word == now.key, "left").select("word", F.coalesce("class", F.lit(rare)).alias("class"), "near")
        entries = lists.select("class", F.inline("near"))
        c, d = (F.when(F.col("side") == 0, x).otherwise(y) for x, y in ((F.col("class"), F.col("other")), (F.col("other"), F.col("class"))))
        counts = head_counts + _table(entries.select(c.alias("c"), d.alias("d"), "n").unionByName(joined.select(F.col("of_a").alias("c"), F.col("of_b").alias("d"), "n")), size)
        value = likelihood(counts)
        rise = value - best_value
        if rise > 0:
            if best is not None:
                discard(best)
            best, best_counts, best_value = now, counts, value
        if rise <= LEAST_GAIN * counts.sum():
            discard(beside, pairs, joined)
            return best, best_counts
        own = F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)
        met = joined.select(*_near("a", F.col("of_b"), 0, own)).unionByName(joined.select(*_near("b", F.col("of_a"), 1, F.lit(0))))
        every = beside.unionByName(_listed(met)).groupBy("word").agg(F.flatten(F.collect_list("near")).alias("near"))
        near = every.join(now, every.word == now.key).select("word", "class", "near")
        moved = _moves(near, counts, movable)
        now = written(moved.select(F.col("word").alias("key"), "class"), "placed")
        discard(joined)


@dataclass
class ClassModel:
    """words: all training words with count and class; carried_*: the end and the most frequent ones; log10 figures by
    class, of which the last is the rare one's."""

    words: DataFrame
    tokens: int
    distinct: int
    carried: list[str]
    carried_classes: np.ndarray
    carried_counts: np.ndarray
    transition: np.ndarray
    emitted: np.ndarray


def fit(docs: DataFrame, text_column: str = "text", head: int = HEAD, classes: int = CLASSES, carried: int = CARRIED) -> ClassModel:
    """Counts the words of all `docs`, gives each a class and estimates the model."""
    spark = docs.sparkSession
    counts = written(count_words(docs, text_column), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    order = [F.desc("n"), "word"]
    first = [r.word for r in counts.where("word != '' and n > 1").orderBy(*order).limit(head).collect()]
    names = [w.encode() for w in first]
    bigrams = written(count_bigrams(docs, names, text_column), "bigrams")
    assigned = exchange(bigrams, len(names), classes)
    rare = int(assigned.max()) + 1
    known = spark.createDataFrame([("", 0), *zip(first, assigned[1:].tolist(), strict=True)], "word string, head int")
    words = counts.join(F.broadcast(known), "word", "left").withColumn("key", _key("word"))  # at most `head` rows
    around = written(count_around(docs, names, assigned, text_column), "around")
    placed, n = place(around, words.where("head is null and n > 1").select("key").distinct(), _head_counts(bigrams, assigned, rare + 1), rare)
    discard(bigrams)
    words = written(words.join(placed, "key", "left").select("word", "n", F.coalesce("head", "class", F.lit(rare)).alias("class")), "model")
    discard(counts, placed)

    share = (n.sum(0) + 1) / (n.sum() + len(n))
    transition = np.log10((n + TRANSITION * share) / (n.sum(1, keepdims=True) + TRANSITION))
    held, kinds = np.zeros(len(n)), np.zeros(len(n))
    for r in words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # a row for each class
        held[r["class"]], kinds[r["class"]] = r.n, r.v
    top = words.where("word != ''").orderBy(*order).limit(carried).toArrow()
    most = [top.column(c).to_numpy().astype(np.int64) for c in ("class", "n")]
    of, count = (np.concatenate([[x], y]) for x, y in zip((0, int(held[0])), most, strict=True))
    return ClassModel(words, total.n, total.v, [END.decode(), *top.column("word").to_pylist()], of, count, transition, np.log10(held + DELTA * (kinds + 1)))


def score(docs: DataFrame, model: ClassModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) for every row of `docs`, all in log10.

    A text is its words and one end; a null text is the end alone. Repeated rows give repeated rows, an empty table gives
    an empty one, further columns are ignored. `score` is the class model's, `base_score` that of smoothed word counts.
    """
    spark = docs.sparkSession
    carried = spark.sparkContext.broadcast((model.carried, model.carried_classes, model.carried_counts))
    transition, emitted, size = model.transition, model.emitted, len(model.emitted)
    base = float(np.log10(model.tokens + DELTA * (model.distinct + 1)))
    kinds = {"key": pa.string(), "next": pa.string(), "before": pa.int32(), "after": pa.int32(), "row": pa.int64(), "doc_id": pa.int64(), "n": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, class_of, count = carried.value
        types = {w.encode(): i for i, w in enumerate(known)}
        log_count = np.log10(count + DELTA)
        for batch in batches:
            out: list[tuple] = []
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2)), strict=True):
                words = _words(text)
                at = np.zeros(len(words) + 2, np.int64)
                at[1:-1] = np.fromiter(map(types.get, words, repeat(-1)), np.int64, len(words))
                cls = np.where(at < 0, -1, class_of[at])
                here, sure = at[1:][at[1:] >= 0], (cls[:-1] >= 0) & (cls[1:] >= 0)
                logs = float(log_count[here].sum())
                moves = float(transition[cls[:-1][sure], cls[1:][sure]].sum() - emitted[class_of[here]].sum())
                out.append((" " + str(row), None, -1, -1, row, doc_id, 0, len(at) - 1, int((count[here] > 0).sum()), logs - base * (len(at) - 1), logs + moves))
                rest = np.nonzero(at < 0)[0].tolist()
                seen = Counter((words[i - 1], words[i] if at[i + 1] < 0 else None, int(cls[i - 1]), int(cls[i + 1])) for i in rest)
                out += [(w.decode(), x and x.decode(), b, a, row, doc_id, n, 0, 0, 0.0, 0.0) for (w, x, b, a), n in seen.items()]
            columns = zip(*out, strict=True) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    parts = rows.mapInArrow(run, "key string, next string, before int, after int, row long, doc_id long, n long, n_tokens long, n_known long, base_score double, score double")
    moving, leaving = _lookup(transition.ravel(), "double"), _lookup(emitted, "double")
    at = lambda a, b: F.when((a >= 0) & (b >= 0), moving[F.greatest(a, F.lit(0)) * size + F.greatest(b, F.lit(0))]).otherwise(0.0)
    # A text's own figures go by a key that no word has; its other rows are words that did not travel.
    met = parts.join(model.words.select(F.col("word").alias("key"), F.col("n").alias("c"), F.col("class").alias("k")), "key", "left")
    met = met.withColumns({"c": F.coalesce("c", F.lit(0)), "k": F.coalesce("k", F.lit(size - 1))})
    c, k, n = F.col("c"), F.col("k"), F.col("n")
    count = F.log10(c + F.lit(DELTA))
    met = written(met.select(
        "row", "doc_id", "n_tokens", F.col("n_known") + F.when(c > 0, n).otherwise(0), F.col("base_score") + n * count,
        F.col("score") + n * (count - leaving[k] + at(F.col("before"), k) + at(k, F.col("after"))), "next", "k", "n",
    ).toDF("row", "doc_id", "n_tokens", "n_known", "base_score", "score", "next", "k", "n"), "scored")
    # Where two such words follow each other, the second one's class is joined as well.
    pairs = met.where("next is not null").join(model.words.select(F.col("word").alias("next"), F.col("class").alias("to")), "next", "left")
    more = pairs.select("row", "doc_id", *(F.lit(0).cast("long").alias(x) for x in ("n_tokens", "n_known")), F.lit(0.0).alias("base_score"), (n * at(k, F.coalesce("to", F.lit(size - 1)))).alias("score"))
    return met.drop("next", "k", "n").unionByName(more).groupBy("row").agg(F.max("doc_id").alias("doc_id"), *(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score"))).drop("row")


def held_out() -> Column:
    return remainder("doc_id", 10) == 0


def fold_scores(docs: DataFrame) -> DataFrame:
    """Learns from the documents outside the held-out fold and scores all."""
    model = fit(docs.where(~held_out()))
    scored = score(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
