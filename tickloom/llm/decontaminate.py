"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

The CGK embedding walks along a sequence: at each step it writes the current symbol and a random bit of (step, symbol) says
whether to move on. Two sequences that differ by few edits soon walk in step again, so their embeddings differ in few
places. Bit sampling of the embeddings, repeated until the target recall is reached, finds windows of a document that may
match an item of their size; an exact edit distance decides.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import raw

#: Edits allowed, as a part of an item's words; items of fewer words are looked for word by word.
EDITS, LEAST_WORDS = 0.2, 5
#: Steps of the walk for each word, places sampled in a repetition, the recall that repetitions are chosen for, and the
#: trials that tell how far edits drive embeddings apart.
STRETCH, SAMPLED, RECALL, TRIALS = 3, 3, 0.98, 200
#: In how many items at most a word counts as rare, the first that gives an item enough rare words.
RARE = (1, 3, 10, 30)
#: Characters of the benchmark that travel with the tasks at a time, and words of text that a task looks at together.
BLOCK_CHARS, SLICE_WORDS = 4_000_000, 1_500_000
#: Words of windows whose edit distances a task finds at a time.
CELLS = 1 << 20
_WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())
#: First bytes of characters from U+0800; characters of scripts that have no blanks between words (Thai, Lao, Tibetan,
#: Myanmar, Khmer, Tai scripts, Javanese, kana, Han); punctuation of those scripts.
_HIGH = re.compile(rb"[\xe0-\xf4]")
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19ff\u1a20-\u1aaf\u3005-\u3007\u3040-\u30ff\u3100-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua980-\ua9ff\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_WIDE_BLANKS = dict.fromkeys([*range(0x3000, 0x3005), *range(0x3008, 0x3031), 0x30FB, *range(0xFF01, 0xFF10), *range(0xFF1A, 0xFF21), *range(0xFF3B, 0xFF41), *range(0xFF5B, 0xFF66)], " ")


def words_of(text: bytes) -> list[bytes]:
    """Words of ASCII letters and digits, in lower case, and of all other characters beyond ASCII.

    Scripts that are written without blanks have a word for each character.
    """
    if _HIGH.search(text):
        spread = _UNSPACED.sub(r" \g<0> ", text.decode("utf-8", "surrogateescape").translate(_WIDE_BLANKS))
        text = spread.encode("utf-8", "surrogateescape")
    return text.translate(_WORD_BYTES).split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def walk(flat: np.ndarray, start: np.ndarray, length: int | np.ndarray, reps: np.ndarray, steps: int) -> Iterator[np.ndarray]:
    """The CGK embeddings of flat[start : start + length], a step at a time: symbols by repetition and start, -1 beyond
    the end. The random bit of a repetition, step and symbol is a hash of the three, so that no table of them is held."""
    at = np.zeros(np.broadcast_shapes(reps.shape, start.shape), np.int64)
    for j in range(steps):
        inside = at < length
        symbol = np.where(inside, flat[np.minimum(start + at, len(flat) - 1)], -1)
        yield symbol
        salt = _mixed(reps.astype(np.uint64) << np.uint64(32) | np.uint64(j + 1))
        at += inside & (_mixed(symbol.astype(np.uint64) ^ salt) >> np.uint64(63)).astype(bool)


def edit_distances(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least edits, where that match ends) between each item and any stretch of its window; rows belong together."""
    n, width = windows.shape
    places = np.arange(width + 1)
    row = np.zeros((n, width + 1), np.int32)
    for i in range(items.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (windows != items[:, [i]]))
        row = np.minimum.accumulate(new - places, axis=1) + places
    return row.min(1), row.argmin(1)


def _add(key: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Takes one more sampled symbol into each key."""
    key = (key ^ (symbols.astype(np.int64) + 2).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return key ^ (key >> np.uint64(29))


def allowed(length: int, edits: float) -> int:
    return int(length * edits + 1e-9)


def repetitions(items: list[np.ndarray], edits: float, recall: float = RECALL) -> int:
    """How many repetitions find a pair with all allowed edits at the target recall, by trial on the items themselves."""
    rng, trials, edited = np.random.default_rng(7), [], []
    for _ in range(TRIALS):
        x = items[int(rng.integers(len(items)))]
        y = list(x)
        for _ in range(allowed(len(x), edits)):
            at, kind = int(rng.integers(max(1, len(y)))), int(rng.integers(3))
            if kind == 0:
                y.insert(at, 0)
            elif y and kind == 1:
                y.pop(at)
            elif y:
                y[at] = 0
        trials.append(x)
        edited.append(np.array((y + [0] * len(x))[: len(x)], np.int32))
    lengths, reps = np.array([len(x) for x in trials]), np.arange(TRIALS) % 8
    start, steps, equal = np.cumsum(lengths) - lengths, STRETCH * lengths, np.zeros(TRIALS)
    walks = (walk(np.concatenate(v), start, lengths, reps, int(steps.max())) for v in (trials, edited))
    for j, (a, b) in enumerate(zip(*walks, strict=True)):
        equal += (a == b) & (j < steps)
    met = float(((equal / steps) ** SAMPLED).sum())
    hit = min(0.999, max(0.01, met / TRIALS))
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - hit)))


@dataclass
class Sieve:
    """Distinct items of one benchmark block.

    ids: the items' ids, several where texts repeat. short: by how many words they have, the items of too few words to
    allow edits, with their ids. rare_*: for each word the items in which it is rare, as offsets into
    one array. need: rare words of an item that survive all allowed edits; of `open_items` no word is rare enough to need.
    """

    vocabulary: dict[bytes, int]
    ids: list[list[int | None]]
    items: list[np.ndarray]
    edits: float
    rare_at: np.ndarray
    rare_items: np.ndarray
    need: np.ndarray
    earliest: np.ndarray
    latest: np.ndarray
    reps: int
    short: dict[int, dict[tuple[int, ...], list[int | None]]]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(x) for x in self.items])
        self.slack = np.array([allowed(int(n), self.edits) for n in self.lengths])
        self.open_items = np.nonzero(self.need < 1)[0]
        self.of_length = {int(n): np.nonzero(self.lengths == n)[0] for n in np.unique(self.lengths)}
        self.longest = max([0, *self.lengths.tolist()])
        self.short_keys = {n: _keys_of(np.array(list(held), np.int32).reshape(-1), np.arange(len(held)) * n, n) for n, held in self.short.items()}
        self.places, self.keys = {}, {}
        if not self.items:
            return
        for length, group in self.of_length.items():
            rng, flat = np.random.default_rng(length), np.concatenate([self.items[i] for i in group])
            self.places[length] = rng.integers(0, STRETCH * length, (self.reps, SAMPLED))
            keys = self.sampled(flat, np.arange(len(group)) * length, length)
            orders = np.argsort(keys, axis=1, kind="stable")
            self.keys[length] = [(key[order], group[order]) for key, order in zip(keys, orders, strict=True)]

    def sampled(self, flat: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
        """Keys, by repetition and start, of the sampled places of the embeddings of flat[start : start + length]."""
        places, keys = self.places[length], np.zeros((self.reps, len(start)), np.uint64)
        for j, symbols in enumerate(walk(flat, start, length, np.arange(self.reps)[:, None], int(places.max()) + 1)):
            for rep, _ in zip(*np.nonzero(places == j), strict=True):
                keys[rep] = _add(keys[rep], symbols[rep])
        return keys


def _keys_of(flat: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    keys = np.zeros(len(start), np.uint64)
    for k in range(length):
        keys = _add(keys, flat[start + k])
    return keys


def build(texts: list[tuple[int | None, bytes]], edits: float = EDITS, least_words: int = LEAST_WORDS) -> Sieve | None:
    """The sieve of (item_id, text); None if no item has a word."""
    by_words: dict[tuple[bytes, ...], list[int | None]] = defaultdict(list)
    few_words: dict[tuple[bytes, ...], list[int | None]] = defaultdict(list)
    for i, text in texts:
        if words := words_of(text):
            (by_words if len(words) >= least_words else few_words)[tuple(words)].append(i)
    if not by_words and not few_words:
        return None
    vocabulary: dict[bytes, int] = {}
    items = [np.array([vocabulary.setdefault(x, len(vocabulary) + 1) for x in words], np.int32) for words in by_words]
    short: dict[int, dict[tuple[int, ...], list[int | None]]] = defaultdict(dict)
    for words, ids in few_words.items():
        short[len(words)][tuple(vocabulary.setdefault(x, len(vocabulary) + 1) for x in words)] = ids
    spread = Counter(w for x in items for w in set(x.tolist()))
    rare, need, earliest, latest = defaultdict(list), [], [], []
    for i, x in enumerate(items):
        slack, counts = allowed(len(x), edits), np.array([spread[w] for w in x.tolist()])
        places = next((at for cut in RARE if len(at := np.nonzero(counts <= cut)[0]) > 2 * slack), np.nonzero(counts <= RARE[-1])[0])
        need.append(len(places) - slack)
        earliest.append(int(places[0]) if len(places) else 0)
        latest.append(int(places[min(slack, len(places) - 1)]) if len(places) else 0)
        for w in set(x[places].tolist()) if need[-1] > 0 else ():
            rare[w].append(i)
    held = [rare.get(w, []) for w in range(len(vocabulary) + 1)]
    offsets = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    flat = np.array([i for h in held for i in h], np.int64)
    reps = repetitions(items, edits) if items else 0
    return Sieve(vocabulary, list(by_words.values()), items, edits, offsets, flat, np.array(need), np.array(earliest), np.array(latest), reps, dict(short))


def _covered(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The places from `first` to `last` of any range, each once; as many as there are, however the ranges overlap."""
    order = np.argsort(first, kind="stable")
    first, upto = first[order], np.maximum.accumulate(last[order])
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > upto[:-1]
    begins = first[new]
    n = upto[np.append(np.nonzero(new)[0][1:] - 1, len(first) - 1)] - begins + 1
    return np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _windows(sieve: Sieve, flat: np.ndarray) -> dict[int, np.ndarray]:
    """Starts of windows, by length, that may match an item; nothing that can match is left out.

    A match keeps at least `need` rare words of its item within the item's length and the allowed edits, and the first of
    them that is left tells where the window starts. Items without rare words take all windows in which no more words are
    foreign to the benchmark than edits are allowed; as many may lie before the text's first word or after its last.
    """
    starts: dict[int, list[np.ndarray]] = defaultdict(list)
    if not sieve.items:
        return {}
    known = np.maximum(flat, 0)
    n_items = sieve.rare_at[known + 1] - sieve.rare_at[known]
    at = np.nonzero(n_items)[0]
    n_items = n_items[at]
    before = np.cumsum(n_items) - n_items
    item = sieve.rare_items[np.repeat(sieve.rare_at[known[at]] - before, n_items) + np.arange(int(n_items.sum()))]
    place, stride = np.repeat(at, n_items), np.int64(2 * len(flat) + 1)
    key = np.sort(item * stride + place)
    item, place = key // stride, key % stride
    span = sieve.lengths[item] + sieve.slack[item]
    enough = np.searchsorted(key, key + span) - np.arange(len(key)) >= sieve.need[item]
    item, place = item[enough], place[enough]
    first, last = place - sieve.latest[item] - sieve.slack[item], place - sieve.earliest[item] + sieve.slack[item]
    for length in np.unique(sieve.lengths[item]).tolist():
        of_length = sieve.lengths[item] == length
        starts[length].append(_covered(first[of_length], last[of_length]))
    if len(sieve.open_items):
        unknown, outside = (np.concatenate([[0], np.cumsum(x)]) for x in (flat == 0, flat < 0))
        for length in np.unique(sieve.lengths[sieve.open_items]).tolist():
            foreign, beyond = (x[length:] - x[:-length] for x in (unknown, outside))
            starts[length].append(np.nonzero(np.maximum(foreign, beyond) <= allowed(length, sieve.edits))[0])
    longest = int(sieve.lengths.max())
    return {n: (s := np.unique(np.concatenate(x)))[(s >= longest) & (s < len(flat) - 2 * longest)] for n, x in starts.items()}


def _exact(sieve: Sieve, flat: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int | None, int, int, int]]:
    """(text, item_id, 0, first word, words of the item) for the items of few words, at the first place in a text."""
    for length, held in sieve.short.items():
        keys = _keys_of(flat, np.arange(len(flat) - length + 1), length)
        at = np.nonzero(np.isin(keys, sieve.short_keys[length]))[0]
        texts = np.searchsorted(begins, at, "right") - 1
        order = np.lexsort((at, keys[at], texts))
        at, texts = at[order], texts[order]
        new = np.ones(len(at), bool)
        new[1:] = (keys[at][1:] != keys[at][:-1]) | (texts[1:] != texts[:-1])
        for t, p in zip(texts[new].tolist(), at[new].tolist(), strict=True):
            for i in held.get(tuple(flat[p : p + length].tolist()), ()):
                yield t, i, 0, p - int(begins[t]), length


def find(sieve: Sieve, texts: list[np.ndarray]) -> list[tuple[int, int | None, int, int, int]]:
    """(text, item_id, edits, first word, words of the item) for every item found in a text, at its best place.

    Texts are their words' numbers in the sieve's vocabulary, 0 for words that it lacks.
    """
    gap = np.full(3 * max(sieve.longest, 1), -1, np.int32)
    sizes = np.array([len(x) for x in texts])
    begins = np.cumsum(sizes + len(gap)) - sizes
    flat = np.concatenate([gap, *(y for x in texts for y in (x, gap))])
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for length, windows in _windows(sieve, flat).items():
        slack = allowed(length, sieve.edits)
        pairs = [np.empty(0, np.int64)]
        for key, (keys, items) in zip(sieve.sampled(flat, windows, length), sieve.keys[length], strict=True):
            low, n = np.searchsorted(keys, key), np.searchsorted(keys, key, "right")
            n -= low
            met = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            pairs.append(np.repeat(windows, n) * len(sieve.items) + items[met])
        found = np.unique(np.concatenate(pairs))
        together = max(1, min(4096, CELLS // (length + 3 * slack)))
        for k in range(0, len(found), together):
            s, i = found[k : k + together] // len(sieve.items), found[k : k + together] % len(sieve.items)
            edits, ends = edit_distances(np.stack([sieve.items[j] for j in i]), flat[(s[:, None] - slack) + np.arange(length + 3 * slack)])
            for p, j, e, end in zip(s.tolist(), i.tolist(), edits.tolist(), ends.tolist(), strict=True):
                if e <= slack:
                    text = int(np.searchsorted(begins, p + length // 2, "right")) - 1
                    entry = (e, max(0, p - slack + end - length - int(begins[text])), length)
                    best[text, j] = min(best.get((text, j), entry), entry)
    found = [(t, i, *entry) for (t, j), entry in best.items() for i in sieve.ids[j]] + list(_exact(sieve, flat, begins))
    return sorted(found, key=lambda x: (x[0], x[1] is None, x[1] or 0, *x[2:]))


def _batches(sieve: Sieve, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
    """What `find` gives for many texts, some at a time."""
    begin, held, size, get = 0, [], 0, sieve.vocabulary.get
    for n, text in enumerate(texts):
        words = words_of(text)
        held.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
        size += len(words)
        if size >= SLICE_WORDS or n == len(texts) - 1:
            yield from ((begin + t, *x) for t, *x in find(sieve, held))
            begin, held, size = n + 1, [], 0


def sieves(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", edits: float = EDITS, least_words: int = LEAST_WORDS) -> list[Sieve]:
    """A sieve for every block of the benchmark. A block's size is bounded; a larger benchmark has more of them."""
    items = benchmark.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")).where("text is not null")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first().n
    blocks = max(1, math.ceil(2 * chars / BLOCK_CHARS))
    block: Column = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    built = []
    for b in range(blocks):
        built.append(build(sorted(((r.id, r.text.encode()) for r in items.where(block == b).collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1])), edits, least_words))
    return [x for x in built if x is not None]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", edits: float = EDITS, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, item_id, edits, first_word, item_words): every benchmark item that a row of `docs` holds.

    An item is held if a stretch of the text's words is within `edits` of its words, as a part of the item's length; a row
    for its best place, `first_word` counting from 0. Whole texts are looked through, in windows of each item's size. Null
    and empty texts hold nothing; items of fewer than `least_words` words are held where all their words follow each other;
    an item without an id is looked for like any other, one without a word is not; repeated rows each give their rows; an empty table gives an empty one; further columns are ignored.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, edits int, first_word long, item_words int"
    out = spark.createDataFrame([], schema)
    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    for sieve in sieves(benchmark, edits=edits, least_words=least_words):
        held = spark.sparkContext.broadcast(sieve)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, found = batch.column(0), list(_batches(held.value, raw(batch.column(1))))
                columns = list(zip(*found, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
                arrays = [ids.take(pa.array(columns[0], pa.int64())), *(pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "item_id", "edits", "first_word", "item_words"])

        out = out.unionByName(narrow.mapInArrow(run, schema))
    return out


def _is_clean(held: Broadcast) -> Callable[[str], Column]:
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        keep = np.ones(len(texts), bool)
        keep[sorted({t for t, *_ in _batches(held.value, raw(texts))})] = False
        return pa.array(keep)

    return clean


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", edits: float = EDITS, least_words: int = LEAST_WORDS) -> DataFrame:
    """Rows of `docs` that hold no item of the benchmark, with all their columns."""
    for sieve in sieves(benchmark, edits=edits, least_words=least_words):
        docs = docs.where(_is_clean(docs.sparkSession.sparkContext.broadcast(sieve))(text_column))
    return docs
