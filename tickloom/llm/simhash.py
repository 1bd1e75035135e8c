"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within Hamming distance r have a bit string between them that lies within half of r from either. So
every fingerprint emits all strings of its ball, equal strings meet in one shuffle, and whoever meets is linked. A ball
holds a fixed number of strings, hence a bucket holds a bounded number of different fingerprints however large a group of
copies is; copies have been folded into one row before.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import discard, fewest_parts, raw, written
from tickloom.llm.components import components

SEED = 42
HALVES = (0, 32)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of `size` words, joined by spaces; of all words if there are fewer; none without words."""
    if not words:
        return np.empty(0, np.uint64)
    runs = zip(*(words[i:] for i in range(size)), strict=False) if len(words) >= size else [words]
    return np.array([xxhash.xxh64_intdigest(x, SEED) for x in map(b" ".join, runs)], np.uint64)


def majority(hashes: np.ndarray) -> np.ndarray:
    """The bits, least first, that are set in over half of the hashes (one row of 64-bit words each)."""
    count = np.zeros(hashes.shape[1] * 64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.ascontiguousarray(hashes[at : at + 4096]).view(np.uint8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return count * 2 > len(hashes)


def fingerprint_bits(text: bytes, size: int) -> int:
    """The fingerprint of one text as an unsigned integer; zero without words."""
    hashes = shingle_hashes(text.lower().split(), size)
    bits = majority(hashes.reshape(-1, 1)) if len(hashes) else np.zeros(64, bool)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp) of every row, fp as a signed long. A null text has no words, so its fingerprint is zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint_bits(x, size)) for x in raw(batch.column(1))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(fps, pa.int64())})

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


def _masks(masks: list[int]) -> Column:
    return F.lit([_signed(x) for x in masks])


def _odd(x: Column) -> Column:
    return F.bit_count(x) % 2 == 1


def _half_ball(fp: Column, at: int) -> Column:
    """Strings of one half, tagged with the half: itself and, of odd ones, all at one bit's distance.

    Strings one bit apart differ in parity, so the odd one's ball reaches the even one.
    """
    half = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit(0xFFFFFFFF))
    near = F.transform(_masks([0, *(1 << i for i in range(32))]), lambda m: half.bitwiseXOR(m))
    strings = F.when(_odd(half), near).otherwise(F.array(half))
    return F.transform(strings, lambda s: F.struct(s.bitwiseOR(F.lit(at << 32)).alias("key"), (s == half).alias("own")))


def with_partner(fps: DataFrame) -> DataFrame:
    """The fingerprints that some other one meets in the ball of a half.

    Of at most three differing bits at most one lies in one of the halves, so nobody without a meeting there is within
    three bits of another. What is left is what the large ball is emitted for.
    """
    fps = fps.repartition(max(fewest_parts(fps), fps.count() // BALLS + 1), "fp")
    balls = F.concat(*(_half_ball(F.col("fp"), at) for at in HALVES))
    met = fps.select("fp", F.explode(balls).alias("x")).select("fp", "x.key", "x.own")
    shared = met.groupBy("key").agg(F.min("fp").alias("first"), F.max("fp").alias("last"), F.max("own").alias("own"))
    shared = written(shared.where("own and first != last").select("key"), "shared")
    return met.join(shared, "key", "left_semi").select("fp").distinct()


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect all fingerprints within three bits of each other; fps has distinct `fp`.

    Balls: all emit what is one bit away; even ones also themselves and all that is two bits of one half away, as two of
    three bits share a half and fingerprints three bits apart differ in parity. Those in a bucket at a distance of one or
    less are within three bits of everyone there, so links to the least of them connect the bucket: no list of pairs.
    """
    one = [1 << i for i in range(64)]
    two = [(1 << i) | (1 << j) for at in HALVES for i, j in combinations(range(at, at + 32), 2)]
    fp = F.col("fp")
    near, far = F.transform(_masks(one), lambda m: m), _masks([0, *one, *two])
    masks = F.when(_odd(fp), near).otherwise(far)
    met = fps.select("fp", F.explode(masks).alias("mask")).select(fp.bitwiseXOR(F.col("mask")).alias("key"), "fp", (F.bit_count("mask") < 2).alias("inner"))
    centre = F.min(F.when(F.col("inner"), fp)).over(Window.partitionBy("key"))
    met = met.select("fp", centre.alias("centre")).where("centre != fp")
    return met.select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b")).distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 3)


def simhash_components(docs: DataFrame, size: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, n_copies) for every row of `docs`.

    Rows link at three or fewer differing bits; component_id is the least doc_id reachable. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows give repeated rows, a null doc_id keeps its row (it is never
    the component's id unless all ids there are null), an empty table gives an empty one, further columns are ignored.
    """
    prints = written(fingerprints(docs, size, id_column, text_column), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies")), "classes")
    near = written(with_partner(classes.select("fp")), "partnered")
    roots = components(links(near))
    known = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", "n_copies", F.coalesce("root", "fp").alias("root"))
    known = written(known, "known")
    ids = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(known.join(written(ids, "ids"), "root").select("fp", "n_copies", "component_id"), "named")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_copies")


#: Near-duplicate documents: words in a shingle of the fingerprints and of the comparison, and the least Jaccard similarity.
PRINTED_WORDS, COMPARED_WORDS, SIMILAR = 3, 5, 0.8
#: Documents whose shingles tell which are common, in expectation, how often such a shingle occurs in them, and the most
#: that travel with the tasks. They order the shingles, nothing else: results are the same with any order.
ORDER_FROM, COMMON_SEEN, COMMON = 20_000, 3, 200_000
#: Buckets by which documents that no pair needs are left out of a join; a broadcast of so many numbers at most.
BUCKETS = 1 << 20
_REMEMBERED = 100_000
#: Rows of a batch in Python, and fingerprints whose balls a task emits, about.
ROWS, BALLS = 1_000, 20_000
#: 64-bit words of a parity sketch at least; longer texts have as many bits as shingles, up to the next power of two.
SKETCH = 8


def text_key(text_column: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))


class _Shingles:
    """The distinct hashes of a text's runs of COMPARED_WORDS words; of all its words if there are fewer."""

    def __init__(self) -> None:
        self.seen: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        seen, get = self.seen, self.seen.get
        if len(seen) > _REMEMBERED:
            seen.clear()
        of = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            h = get(w)
            if h is None:
                h = seen[w] = xxhash.xxh64_intdigest(w, SEED)
            of[i] = h
        size = min(COMPARED_WORDS, len(words))
        key = np.full(len(words) - size + 1 if size else 0, size, np.uint64)
        for k in range(size):
            key = (key ^ of[k : k + len(key)]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return np.unique(key.view(np.int64))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of the shingles falls on each of so many places, as 64-bit words.

    A shingle that only one of two texts has changes one place, so sketches never differ in more places than the texts do
    in shingles: what their difference rules out is unlike, at any size. The halves of a sketch, added, are the sketch of
    half as many places.
    """
    size = max(SKETCH * 64, 1 << max(0, len(shingles) - 1).bit_length())
    places = (shingles.view(np.uint64) % np.uint64(size)).astype(np.int64)
    odd = np.bincount(places, minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _common(docs: DataFrame, text_column: str) -> tuple[np.ndarray, np.ndarray]:
    """(shingles in order, how often each was seen) of the commonest shingles in a part of the documents."""
    n = docs.count()
    draw = F.pmod(F.xxhash64(text_column, F.lit("order")), F.lit(1 << 30))
    some = docs.where(draw < int((1 << 30) * ORDER_FROM / n)) if n > ORDER_FROM else docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _Shingles()
        for batch in batches:
            for text in set(raw(batch.column(0))):
                yield pa.RecordBatch.from_pydict({"token": shingles(text.lower().split())})

    tokens = some.select(F.col(text_column).cast("string").alias("text")).mapInArrow(run, "token long")
    top = tokens.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_SEEN).orderBy(F.desc("n"), "token").limit(COMMON).toArrow()
    token, seen = top.column("token").to_numpy().astype(np.int64), top.column("n").to_numpy().astype(np.int64)
    order = np.argsort(token)
    return token[order], seen[order]


def prefix(shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first of the shingles in the order that all texts share, rare ones first: so many that two similar texts have
    one of them in common."""
    token, seen = common
    rank = np.zeros(len(shingles), np.int64)
    if len(token):
        at = np.minimum(np.searchsorted(token, shingles), len(token) - 1)
        rank = np.where(token[at] == shingles, seen[at], 0)
    keep = len(shingles) - int(np.ceil(SIMILAR * len(shingles) - 1e-9)) + 1 if len(shingles) else 0
    return shingles[np.lexsort((shingles, rank))[:keep]]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows a thousand at a time: what is made of long texts stays small in a Python worker."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """All arrays but the first, which is empty, as a column of lists."""
    at = np.cumsum([len(x) for x in arrays])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(arrays)))


def _prefixes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, text_key, same, fp, size, prefix, sketch): a hash of each text's words, equal for exact copies, their
    fingerprint, how many shingles the comparison takes, the first of them and the sketch of all."""
    held = docs.sparkSession.sparkContext.broadcast(_common(docs, text_column))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, common = _Shingles(), held.value
        for batch in _parts(batches):
            same, fps, sizes, firsts, sketches = [], [], [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for text in raw(batch.column(2)):
                words = text.lower().split()
                same.append(xxhash.xxh3_128_digest(b" ".join(words)))
                fps.append(_signed(fingerprint_bits(text, PRINTED_WORDS)))
                found = shingles(words)
                sizes.append(len(found))
                firsts.append(prefix(found, common))
                sketches.append(sketch(found))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "text_key": batch.column(1), "same": pa.array(same, pa.binary()), "fp": pa.array(fps, pa.int64()), "size": pa.array(sizes, pa.int32()), "prefix": _lists(firsts), "sketch": _lists(sketches),
            })

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_key(text_column).alias("text_key"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, text_key long, same binary, fp long, size int, prefix array<long>, sketch array<long>")


def _first(*columns: str) -> Column:
    """The least of the rows, where a null id comes last."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), *columns))


def _shared(classes: DataFrame) -> DataFrame:
    """(token, class, size, at, weight): the places of the prefixes' shingles that several classes have; weight is how
    many a class meets over all its places."""
    every = classes.select("class", "size", F.posexplode("prefix").alias("at", "token"))
    # Counts are summed up before they move, and a join can split the rows of a shingle that a third of all texts have.
    often = every.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    met = written(every.join(often, "token").select("token", "class", "size", "at", "n"), "met")
    weights = written(met.groupBy("class").agg(F.sum("n").alias("weight")), "weights")
    shared = written(met.drop("n").join(weights, "class").select("token", "class", "size", "at", "weight"), "shared")
    discard(met, weights)
    return shared


def _may_be_similar(a: str, b: str) -> Column:
    """False for pairs that a shared shingle shows to be unlike, by the sizes and by its places among all shingles."""
    x, y, i, j = (F.col(f"{side}.{c}") for c in ("size", "at") for side in (a, b))
    most = F.least(i, j) + 1 + F.least(x - i, y - j) - 1
    return (F.least(x, y) >= SIMILAR * F.greatest(x, y) - 1e-9) & (most >= SIMILAR / (1 + SIMILAR) * (x + y) - 1e-9)


#: A sketch of 64 * SKETCH places, as columns.
SHORT = [f"bits_{i}" for i in range(SKETCH)]


def _short(sketch: str) -> list[Column]:
    """The sketch folded to SKETCH words, which again differ in no more places than the texts in shingles."""
    word = lambda i: F.aggregate(F.filter(sketch, lambda _, at: at % SKETCH == i), F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))
    return [word(i).alias(name) for i, name in enumerate(SHORT)]


def _short_not_unlike(a: str, b: str) -> Column:
    """False for classes whose short sketches show them to be unlike."""
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in SHORT), F.lit(0))
    return differ <= (1 - SIMILAR) / (1 + SIMILAR) * (F.col(f"{a}.size") + F.col(f"{b}.size")) + 1e-9


def _groups_may_be_similar(a: str, b: str) -> Column:
    """False where sizes, places or sketches rule out every pair of one group's classes with the other's.

    `size` is the least of a group, `largest`, `at` and `after` (what is left of a class from the shingle on) the greatest;
    the sketch counts where both have one class (`n`).
    """
    x, y, largest_x, largest_y, i, j, p, q = (F.col(f"{side}.{c}") for c in ("size", "largest", "at", "after") for side in (a, b))
    sizes = (largest_x >= SIMILAR * y - 1e-9) & (largest_y >= SIMILAR * x - 1e-9)
    places = F.least(i, j) + F.least(p, q) >= SIMILAR / (1 + SIMILAR) * (x + y) - 1e-9
    return sizes & places & ((F.col(f"{a}.n") > 1) | (F.col(f"{b}.n") > 1) | _short_not_unlike(a, b))


def _to_heaviest(shared: DataFrame) -> DataFrame:
    """Pairs (a, b) of each class with the one of a shingle's classes that meets most: what copies were made from has all
    of its shingles in common with some of them, while copies have shingles of their own."""
    heavy = shared.groupBy("token").agg(F.max(F.struct("weight", "class", "size", "at")).alias("h")).select("token", "h.*")
    pairs = shared.alias("x").join(written(heavy, "heavy").alias("y"), "token").where((F.col("x.class") != F.col("y.class")) & _may_be_similar("x", "y"))
    return pairs.select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b")).distinct()


def _across(shared: DataFrame, roots: DataFrame, sketches: DataFrame) -> DataFrame:
    """All pairs (a, b) of different groups that share a shingle and may be similar. Pairs within a group are not even
    listed: a shingle's groups are paired first, if the bounds of their sizes and places allow it, then their classes. Short
    sketches go with them, so that pairs which these rule out are not listed either, once for each shingle they share."""
    rooted = shared.drop("weight").join(roots.select(F.col("node").alias("class"), "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rooted = written(rooted, "rooted")
    several = rooted.groupBy("token").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("token")
    short = written(sketches.select("class", *_short("sketch")), "short")
    apart = written(rooted.join(several, "token").join(short, "class"), "apart")
    discard(rooted, short)
    rooted = apart
    bounds = [F.min("size").alias("size"), F.max("size").alias("largest"), F.max("at").alias("at"), F.max(F.col("size") - F.col("at")).alias("after"), F.count("*").alias("n"), *(F.min(c).alias(c) for c in SHORT)]
    groups = written(rooted.groupBy("token", "root").agg(*bounds), "groups")
    group = lambda r: groups.select("token", F.col("root").alias(r), F.struct("size", "largest", "at", "after", "n", *SHORT).alias(f"all_{r}"))
    both = group("x").join(group("y"), "token").where((F.col("x") < F.col("y")) & _groups_may_be_similar("all_x", "all_y")).select("token", "x", "y")
    side = lambda r: rooted.select("token", F.col("root").alias(r), F.struct("class", "size", "at", *SHORT).alias(f"of_{r}"))
    pairs = both.join(side("x"), ["token", "x"]).join(side("y"), ["token", "y"]).where(_may_be_similar("of_x", "of_y") & _short_not_unlike("of_x", "of_y"))
    pairs = written(pairs.select(F.least("of_x.class", "of_y.class").alias("a"), F.greatest("of_x.class", "of_y.class").alias("b")).distinct(), "open-pairs")
    discard(rooted, groups)
    return pairs


def _not_unlike(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs whose sketches leave open that they are similar: two sets of x and y shingles that reach the similarity s
    differ in (x + y) (1 - s) / (1 + s) of them at most."""
    of = lambda c: sketches.select(F.col("class").alias(c), F.struct("size", "sketch").alias(f"of_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    n = F.least(F.size("of_a.sketch"), F.size("of_b.sketch"))
    # Sizes of similar texts differ by a quarter at most, so one sketch is as long as the other or twice as long.
    folded = lambda s: F.when(F.size(s) == n, s).otherwise(F.zip_with(F.slice(s, 1, n), F.slice(s, n + 1, n), lambda x, y: x.bitwiseXOR(y)))
    apart = F.zip_with(folded(F.col("of_a.sketch")), folded(F.col("of_b.sketch")), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(apart, F.lit(0), lambda total, x: total + x)
    x, y = F.col("of_a.size"), F.col("of_b.size")
    return both.where((F.least(x, y) >= SIMILAR * F.greatest(x, y) - 1e-9) & (differ <= (1 - SIMILAR) / (1 + SIMILAR) * (x + y) + 1e-9)).select("a", "b")


def _printed(classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect the classes whose fingerprints are within three bits of each other."""
    of_print = written(classes.groupBy("fp").agg(F.min("class").alias("least")), "of-print")
    near = written(with_partner(of_print.select("fp")), "partnered")
    least = lambda c: of_print.select(F.col("fp").alias(c), F.col("least").alias(f"least_{c}"))
    apart = links(near).join(least("a"), "a").join(least("b"), "b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    equal = classes.join(of_print, "fp").where("class != least").select(F.col("least").alias("a"), F.col("class").alias("b"))
    found = written(apart.unionByName(equal), "printed")
    discard(of_print, near)
    return found


def _of_two_groups(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one group already."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    both = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _shingles(docs: DataFrame, text_column: str) -> DataFrame:
    """(class, shingles): the distinct shingle hashes that the comparison takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _Shingles()
        for batch in _parts(batches):
            found = [np.empty(0, np.int64), *(shingles(x.lower().split()) for x in raw(batch.column(1)))]
            yield pa.RecordBatch.from_pydict({"class": batch.column(0), "shingles": _lists(found)})

    return docs.select("class", F.col(text_column).cast("string").alias("text")).mapInArrow(run, "class long, shingles array<long>")


def _texts_of(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(class, text) of the classes in the pairs; a class has a row for each repetition of its first row."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = written(classes.join(ends, "class").select("class", F.col("first.doc_id").alias("_d"), F.col("first.text_key").alias("_k")), "ends")
    bucket = lambda c: F.pmod(c, F.lit(BUCKETS))
    few = docs.select(F.col(id_column).cast("long").alias("_i"), text_key(text_column).alias("_t"), F.col(text_column).alias("text"))
    few = few.withColumn("_b", bucket(F.col("_t"))).join(F.broadcast(wanted.select(bucket(F.col("_k")).alias("_b")).distinct()), "_b", "left_semi")
    return few.join(wanted, (F.col("_t") == F.col("_k")) & F.col("_i").eqNullSafe(F.col("_d"))).select("class", "text")


def _similar(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs whose shingle sets reach the least similarity."""
    of = lambda c: shingles.select(F.col("class").alias(c), F.col("shingles").alias(f"of_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(shared >= SIMILAR * (F.size("of_a") + F.size("of_b") - shared)).select("a", "b")


def near_duplicate_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_key, group, stays): one row for each row of `docs`; rows of a group are copies or near copies.

    Exact copies, by their words, are folded into a class first. Classes whose SimHash fingerprints are within three bits
    are linked, as `simhash_components` links them. Similar texts can lie further apart than that; for what the
    fingerprints leave in different groups an exact comparison follows. Two classes whose five-word shingles reach the
    least similarity share one of their first shingles, in any order that all classes follow; so nothing similar is missed.
    Sketches rule out most pairs that have but a passage in common, before any of their shingles move.
    For each such shingle all classes are compared with one of them first; then all pairs are compared that are not in one
    group by then. The document with the least id stays, a null id comes last, and of rows that repeat an id and a text
    all are marked alike. Texts without words are copies of each other.
    """
    prints = written(_prefixes(docs, id_column, text_column), "prefixes")
    classes = prints.groupBy("same").agg(_first("doc_id", "text_key").alias("first"), F.first(F.struct("fp", "size", "prefix", "sketch")).alias("print"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("class"), "same", "first", "print.*"), "classes")
    # Tables that hold prefixes make room as soon as the rest of them is stored.
    rows = written(prints.select("doc_id", "text_key", "same"), "rows")
    discard(prints)
    shared = _shared(classes)
    slim = written(classes.select("class", "same", "first"), "slim")
    sketches = written(classes.select("class", "size", "sketch"), "sketches")
    printed = written(classes.select("class", "fp"), "class-prints")
    discard(classes)
    classes = slim

    def compared(pairs: DataFrame) -> DataFrame:
        pairs = written(_not_unlike(pairs, sketches), "pairs")
        texts = _texts_of(pairs, classes, docs, id_column, text_column)
        shingles = written(_shingles(texts, "text").dropDuplicates(["class"]), "shingles")
        links = written(_similar(pairs, shingles), "links")
        discard(pairs, shingles)
        return links

    by_print = _printed(printed)
    links = by_print.unionByName(compared(_of_two_groups(_to_heaviest(shared), components(by_print))))
    rest = _across(shared, components(links), sketches)
    more = compared(rest)
    discard(shared, rest, sketches)
    roots = components(links.unionByName(more))
    grouped = written(classes.join(roots, F.col("class") == F.col("node"), "left").select("class", "same", "first", F.coalesce("root", "class").alias("group")), "grouped")
    firsts = written(grouped.groupBy("group").agg(F.min("first").alias("stays")), "firsts")
    named = written(grouped.select("same", "group").join(firsts, "group"), "named")
    out = rows.join(named, "same")
    stays = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_key") == F.col("stays.text_key"))
    return out.select("doc_id", "text_key", "group", stays.alias("stays"))


def keep_one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows of `docs`, one of each group of copies and near copies, with all their columns."""
    groups = written(near_duplicate_groups(docs, id_column, text_column), "groups")
    stay = groups.where("stays").groupBy(F.col("doc_id").alias("__stay_id"), F.col("text_key").alias("__stay_key")).agg(F.count("*").alias("__stay_n"))
    same = F.col(id_column).cast("long").eqNullSafe(F.col("__stay_id")) & (text_key(text_column) == F.col("__stay_key"))
    kept = docs.join(stay, same)
    if not stay.where("__stay_n > 1").isEmpty():  # of rows that repeat an id and its text, the first
        order = Window.partitionBy("__stay_id", "__stay_key").orderBy(F.lit(0))
        repeated = kept.where("__stay_n > 1").withColumn("__stay_n", F.row_number().over(order)).where("__stay_n = 1")
        kept = kept.where("__stay_n = 1").unionByName(repeated)
    return kept.drop("__stay_id", "__stay_key", "__stay_n")
