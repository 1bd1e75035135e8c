"""Phrase collocations: counts of all frequent phrases, found by counting pairs of pairs, and a score for each.

A phrase of k + 1 words is a pair of overlapping phrases of k words, so one step, repeated, counts phrases of any length:
neighbouring ids are counted as pairs, pairs that are frequent get ids of their own, by falling frequency, and take the
place of the ids. As ids are ranks, pairs fall into square tiles of ids: crowded tiles are counted by direct address in
dense arrays, all others as sorted coordinates. Spark sums up what the tasks have counted.

Texts are held as blocks of word ids. What an id becomes travels to the blocks that hold it, once per block, so that no
dictionary is sent to every task. A bitmap of fixed size keeps most rare pairs from travelling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import bitmap, discard, in_bitmap, raw, written

#: Least occurrences and most words of a phrase, phrases of a language, and when a longer phrase stands for a shorter one.
LEAST, LONGEST, BEST, ABSORBED = 30, 4, 2000, 80
UNKNOWN = "und"
#: Bytes of text in a block, and pairs that are counted together.
BLOCK, TOGETHER = 2 << 20, 2 << 20
#: Ids along a side of a tile, tiles along a side of the part that may be dense, and pairs that make a tile dense.
SIDE, TILES, DENSE = 1024, 64, 1 << 17
#: Bits of the bitmap of frequent pairs: 8 MB at any size of the input.
BITS = 1 << 26
#: Parts of one frequency class that are ranked apart.
SALTS = 16

#: A-Z to lower case, ends of pieces to a line feed, tabs to blanks.
_CLEAN = bytes(0x0A if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c for c in bytes(range(256)).lower())


def _blocks(docs: DataFrame, lang_column: str, text_column: str) -> DataFrame:
    """(block, lang, n, vocabulary, tokens): texts of one language as places in the block's vocabulary; -1 ends a piece."""
    rows = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_column).cast("string").alias("text"))

    def block(lang: str, texts: list[bytes]) -> pa.RecordBatch:
        known = {b"": 0, b"\n": 1}
        ids = np.array([known.setdefault(w, len(known)) for w in b"\n".join(texts).translate(_CLEAN).replace(b"\n", b" \n ").split(b" ")], np.int32)
        tokens = ids[ids > 0] - 2
        words = pa.array(list(known)[2:], pa.binary()).cast(pa.string())
        counts = np.bincount(tokens[tokens >= 0], minlength=len(words))
        each = pa.StructArray.from_arrays([pa.array(np.arange(len(words), dtype=np.int32)), words, pa.array(counts, pa.int64())], ["place", "word", "n"])
        vocabulary = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), each)
        return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([int(counts.sum())], pa.int64()), vocabulary, pa.array([tokens.tobytes()], pa.binary())], ["lang", "n", "vocabulary", "tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), raw(batch.column(1)), strict=True):
                waiting.setdefault(lang, []).append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= BLOCK:
                    del sizes[lang]
                    yield block(lang, waiting.pop(lang))
            while sum(sizes.values()) > 8 * BLOCK:  # of many languages, each of them short
                lang = max(sizes, key=sizes.get)
                del sizes[lang]
                yield block(lang, waiting.pop(lang))
        for lang, texts in waiting.items():
            yield block(lang, texts)

    made = rows.mapInArrow(cut, "lang string, n long, vocabulary array<struct<place: int, word: string, n: long>>, tokens binary")
    return written(made.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _ranked(counted: DataFrame, purpose: str) -> DataFrame:
    """Adds `id`, 0, 1, ..., by falling frequency; frequencies within a factor of 1.4 count as the same."""
    salted = counted.withColumns({"class": F.floor(F.log2("n") * 2).cast("int"), "salt": F.pmod(F.hash(*[c for c in counted.columns if c != "n"]), F.lit(SALTS))})
    salted = written(salted, purpose)
    sizes = salted.groupBy("class", "salt").agg(F.count("*").alias("size"))
    upto = F.sum("size").over(Window.orderBy(F.desc("class"), "salt").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("class", "salt", F.coalesce(upto, F.lit(0)).alias("before"))
    keys = [c for c in counted.columns if c != "n"]
    place = F.row_number().over(Window.partitionBy("class", "salt").orderBy(F.desc("n"), *keys))
    placed = salted.withColumn("place", place).join(F.broadcast(offsets), ["class", "salt"])  # a row per class and salt: under 2,000
    out = written(placed.select((F.col("before") + F.col("place") - 1).alias("id"), *counted.columns), purpose)
    discard(salted)
    return out


def _squeezed(ids: np.ndarray) -> np.ndarray:
    """Ids that have a neighbour, with one -1 after each stretch of them."""
    known = ids >= 0
    beside = known & (np.r_[False, known[:-1]] | np.r_[known[1:], False])
    return np.where(beside, ids, -1)[beside | np.r_[False, beside[:-1]]]


def _packed(meanings: DataFrame, keys: list[str]) -> DataFrame:
    """(of, packed): the meanings of a block that lie in one partition, as one row of whole numbers."""
    names = ["block", *keys, "id"]

    def rows(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        table = np.stack([np.concatenate(x) for x in zip(*parts, strict=True)])
        table = table[:, np.argsort(table[0], kind="stable")]
        at = np.flatnonzero(np.r_[True, table[0, 1:] != table[0, :-1]])
        small = int(table.max()) < 1 << 31
        cut = [table[1:, a:b].astype(np.int32 if small else np.int64).tobytes() for a, b in zip(at, np.r_[at[1:], table.shape[1]], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(table[0, at]), pa.array([small] * len(at)), pa.array(cut, pa.binary())], ["of", "small", "packed"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[np.ndarray]] = []
        size = 0
        for batch in batches:
            kept.append([c.to_numpy().astype(np.int64) for c in batch.columns])
            size += batch.num_rows
            if size >= TOGETHER // 2:
                yield rows(kept)
                kept, size = [], 0
        if size:
            yield rows(kept)

    return meanings.select(*names).mapInArrow(pack, "of long, small boolean, packed binary")


def _replaced(blocks: DataFrame, meanings: DataFrame, keys: list[str], translate, purpose: str) -> DataFrame:
    """Blocks (block, ids) after `translate(ids, keys, new ids)`; meanings: (block, keys, id). The blocks given are deleted."""
    width = len(keys) + 1

    def run(block: pa.Table, meaning: pa.Table) -> pa.Table:
        if not block.num_rows:
            return block.select(["block", "ids"])
        parts = [np.frombuffer(p, np.int32 if small else np.int64).reshape(width, -1) for small, p in zip(meaning.column("small").to_pylist(), meaning.column("packed").to_pylist(), strict=True)]
        columns = np.concatenate(parts, axis=1).astype(np.int64) if parts else np.zeros((width, 0), np.int64)
        ids = _squeezed(translate(block.column("ids")[0].as_py(), *columns))
        return pa.table({"block": block.column("block"), "ids": pa.array([_bytes_of(ids)], pa.binary())})

    # Stored before blocks move: what was shuffled to find the meanings, most of all that moves, is gone by then.
    packed = written(_packed(meanings, keys), "meanings")
    both = blocks.select("block", "ids").groupBy("block").cogroup(packed.groupBy("of"))
    out = written(both.applyInArrow(run, "block long, ids binary"), purpose)
    discard(blocks, packed)
    return out


def _bytes_of(ids: np.ndarray) -> bytes:
    """Ids in four bytes each where that is enough for all of them; the first byte tells."""
    small = not len(ids) or int(ids.max()) < 1 << 31
    return bytes([4 if small else 8]) + ids.astype(np.int32 if small else np.int64).tobytes()


def _ids_of(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.int32 if packed[0] == 4 else np.int64, offset=1).astype(np.int64)


def _words_to_ids(tokens: bytes, place: np.ndarray, new: np.ndarray) -> np.ndarray:
    tokens = np.frombuffer(tokens, np.int32)
    table = np.full(int(tokens.max(initial=-1)) + 2, -1, np.int64)
    table[place] = new
    return table[tokens]  # -1 is the last of the table


def _pairs_to_ids(ids: bytes, first: np.ndarray, second: np.ndarray, new: np.ndarray) -> np.ndarray:
    ids = _ids_of(ids)
    if not len(new) or len(ids) < 2:
        return np.zeros(0, np.int64)
    a, b = ids[:-1], ids[1:]
    # Both halves become places among the ids that occur in the block, so that a pair fits in one integer.
    seen = np.unique(ids)
    place = lambda x: np.searchsorted(seen, x)
    code = place(a) * len(seen) + place(b)
    known = place(first) * len(seen) + place(second)
    order = np.argsort(known)
    known, new = known[order], new[order]
    at = np.minimum(np.searchsorted(known, code), len(known) - 1)
    return np.where((known[at] == code) & (a >= 0) & (b >= 0), new[at], -1)


def count_pairs(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct pairs and how often each occurs: crowded tiles by direct address, the rest as sorted coordinates."""
    rest = np.ones(len(a), bool)
    lead = np.nonzero((a < SIDE * TILES) & (b < SIDE * TILES))[0]
    tile = a[lead] // SIDE * TILES + b[lead] // SIDE
    for t in np.nonzero(np.bincount(tile, minlength=TILES * TILES) >= DENSE)[0].tolist():
        of = lead[tile == t]
        counts = np.bincount(a[of] % SIDE * SIDE + b[of] % SIDE, minlength=SIDE * SIDE)
        cells = np.nonzero(counts)[0]
        rest[of] = False
        yield t // TILES * SIDE + cells // SIDE, t % TILES * SIDE + cells % SIDE, counts[cells]
    a, b = a[rest], b[rest]
    if not len(a):
        return
    if max(int(a.max()), int(b.max())) < 1 << 31:
        code = a << 32 | b
        code.sort()
        at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        yield code[at] >> 32, code[at] & 0xFFFFFFFF, np.diff(np.r_[at, len(code)])
    else:
        pairs, counts = np.unique(np.stack([a, b], 1), axis=0, return_counts=True)
        yield pairs[:, 0], pairs[:, 1], counts


def _neighbours(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The block's number and all its pairs of neighbouring ids, for each row."""
    for block, ids in zip(batch.column(0).to_pylist(), batch.column(column), strict=True):
        ids = _ids_of(ids.as_py())
        both = (ids[:-1] >= 0) & (ids[1:] >= 0)
        yield block, ids[:-1][both], ids[1:][both]


def _frequent_pairs(blocks: DataFrame, least: int, purpose: str) -> DataFrame:
    """(id, first, second, n): pairs of neighbours that occur often enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            a, b = (np.concatenate(x) for x in zip(*kept, strict=True))
            kept.clear()
            for a, b, n in count_pairs(a, b):
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, n)], ["first", "second", "n"])

        for batch in batches:
            for _, a, b in _neighbours(batch, 1):
                kept.append((a, b))
                size += len(a)
                if size >= TOGETHER:
                    yield from counted()
                    size = 0
        if size:
            yield from counted()

    counts = blocks.select("block", "ids").mapInArrow(count, "first long, second long, n long")
    sums = counts.groupBy("first", "second").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return _ranked(sums, purpose)


def _bit(first, second):
    """The bit of a pair, for columns and for arrays alike; products stay below 2**63 as ids stay below 2**42."""
    return (first * 1_000_003 + second * 7_919) % BITS


def _meanings(blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """(block, first, second, id): frequent pairs of each block."""
    bits = bitmap(pairs.select(_bit(F.col("first"), F.col("second")).alias("bit")), BITS)
    shared = blocks.sparkSession.sparkContext.broadcast(bits)  # BITS / 8 bytes

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, a, b in _neighbours(batch, 1):
                open_ = in_bitmap(shared.value, _bit(a, b))
                for x, y, _ in count_pairs(a[open_], b[open_]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), block, np.int64)), pa.array(x.astype(np.int64)), pa.array(y.astype(np.int64))], ["block", "first", "second"])

    wanted = blocks.select("block", "ids").mapInArrow(held, "block long, first long, second long")
    return wanted.join(pairs.select("first", "second", "id"), ["first", "second"])


def _longer(pairs: DataFrame, shorter: DataFrame, purpose: str) -> DataFrame:
    """Phrases of one word more: (id, lang, phrase, last, n, heads, tails, x, y, n_x, n_y).

    heads[k] and tails[k] are how often the phrase's first and last k + 1 words occur.
    """
    x = shorter.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("x_phrase"), F.col("heads").alias("x_heads"), F.col("n").alias("n_x"))
    y = shorter.select(F.col("id").alias("second"), F.col("last"), F.col("tails").alias("y_tails"), F.col("n").alias("n_y"))
    both = pairs.join(x, "first").join(y, "second")
    own = F.array("n")
    return written(both.select(
        "id", "lang", F.concat_ws(" ", "x_phrase", "last").alias("phrase"), "last", "n",
        F.concat("x_heads", own).alias("heads"), F.concat("y_tails", own).alias("tails"), F.col("first").alias("x"), F.col("second").alias("y"), "n_x", "n_y",
    ), purpose)


def _absorbed(longer: DataFrame) -> DataFrame:
    """Ids of phrases for which a phrase of one word more stands.

    If one of two words more does, so does the one between, which occurs at least as often.
    """
    stands = lambda n: F.col("n").cast("decimal(20,0)") * 100 >= F.col(n).cast("decimal(20,0)") * ABSORBED
    return longer.where(stands("n_x")).select(F.col("x").alias("id")).unionByName(longer.where(stands("n_y")).select(F.col("y").alias("id"))).distinct()


def _weakest_cut(words: int) -> Column:
    """The cut of least score, earlier ones first: (score, k, l, r)."""
    cuts = []
    for k in range(1, words):
        left, right = f"heads[{k - 1}]", f"tails[{words - k - 1}]"
        score = f"cast(cast(n as decimal(20,0)) * 2000000 div (cast({left} as decimal(20,0)) + {right}) as bigint)"
        cuts.append(F.struct(F.expr(score).alias("score"), F.lit(k).alias("k"), F.expr(left).alias("l"), F.expr(right).alias("r")))
    return F.array_min(F.array(*cuts))


def _best(candidates: DataFrame, most: int) -> DataFrame:
    """The first `most` of each language: first of each of several parts, then of what these leave."""
    order = (F.desc("score"), F.desc("a"), "phrase")
    salted = candidates.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    first = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= most)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= most).drop("salt", "place")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, best: int = BEST, lang_column: str = "lang", text_column: str = "text"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that belong together most.

    Texts are lower-cased (A-Z only), cut into pieces at `.,;:!?` and line ends, pieces into words at blanks and tabs. A
    candidate is a phrase of 2 to `longest` words that occurs at least `least` times within pieces; its score is the least
    of floor(2,000,000 a / (l + r)) over its cuts in two. Candidates that lie in a longer one which occurs at least 80 % as
    often go. Every place of every text is counted; counts and scores are exact.

    A null language is `und`, a null or empty text has no words, repeated rows count as often as they stand there, ties go
    to the more frequent phrase and then by bytes, an empty table or one without a candidate gives an empty result. A text
    of any length is in one block. Other columns are not read, so their names do not matter.
    """
    blocks = _blocks(docs, lang_column, text_column)
    totals = written(blocks.groupBy("lang").agg(F.sum("n").alias("n_words")), "totals")
    held = blocks.select("block", "lang", F.inline("vocabulary"))
    counted = held.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    words = _ranked(counted, "words")
    meanings = held.drop("n").join(words.drop("n"), ["lang", "word"])
    blocks = _replaced(blocks.withColumnRenamed("tokens", "ids"), meanings, ["place"], _words_to_ids, "ids-1")
    phrases = words.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "n", F.array("n").alias("heads"), F.array("n").alias("tails"))
    found = []
    for length in range(2, longest + 1):
        pairs = _frequent_pairs(blocks, least, f"pairs-{length}")
        if length == longest:
            discard(blocks)
        longer = _longer(pairs, phrases, f"phrases-{length}")
        if found:
            found[-1] = found[-1].join(_absorbed(longer), "id", "left_anti")
        cut = _weakest_cut(length)
        found.append(longer.withColumn("cut", cut).select("id", "lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score"))
        phrases = longer
        if length < longest:
            blocks = _replaced(blocks, _meanings(blocks, pairs), ["first", "second"], _pairs_to_ids, f"ids-{length}")
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.unionByName(more)
    ranked = _best(candidates, best).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("n_words").alias("n"), "score")
