"""Periodic runs of words: every maximal repetition of a text, found on harmonic grids with constant-time extensions.

A run with period q that is at least 2q long covers two neighbours i, i + q of the grid 0, q, 2q, ... So for every q the
pairs of grid neighbours that hold the same word are extended both ways; all grids of a text have n log n points. How far
two places agree (LCE) comes from a difference cover: only suffixes at places whose residue lies in the cover are sorted,
any two places reach two of these in fewer than `MODULUS` equal words, and a sparse table over the sorted suffixes'
common prefixes has the rest. Texts are independent of each other, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickloom.llm.common import raw

#: A perfect difference set; each residue modulo 31 is a difference of two of its members.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
#: Least words in a run, and least repeats of its period.
LEAST_WORDS, LEAST_PERIODS = 12, 2
#: Words of texts that share one sorted cover, and grid pairs looked at in one go.
TOGETHER, PAIRS = 1 << 18, 1 << 21


def _meeting() -> np.ndarray:
    """[r, s]: the fewest steps after which residues r and s both lie in the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    steps = np.arange(MODULUS)
    r, s, d = np.ix_(steps, steps, steps)
    return (inside[(r + d) % MODULUS] & inside[(s + d) % MODULUS]).argmax(2)


MEETING = _meeting()


class Extensions:
    """Longest common extensions of places of an array of word ids in which every text ends in an id of its own."""

    def __init__(self, ids: np.ndarray) -> None:
        self.ids = ids
        at = np.arange(len(ids))
        self.places = at[np.isin(at % MODULUS, COVER)]
        self.index = np.full(len(ids), -1, np.int32)
        self.index[self.places] = np.arange(len(self.places), dtype=np.int32)
        levels = self._ranks()
        order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(len(order), np.int32)
        self.rank[order] = np.arange(len(order), dtype=np.int32)
        self.table = self._minima(self._neighbours(order, levels))

    def _ranks(self) -> list[np.ndarray]:
        """Ranks of the sampled suffixes by their first 31, 62, 124, ... words, until no two are equal."""
        bits = max(1, int(self.ids.max()).bit_length())
        each = 63 // bits
        padded = np.concatenate([self.ids.astype(np.int64), np.zeros(MODULUS + each, np.int64)])
        rank = np.zeros(len(self.places), np.int64)
        for first in range(0, MODULUS, each):
            tied = self._tied(rank)
            if not len(tied):
                break
            key = np.zeros(len(tied), np.int64)
            for k in range(first, first + each):
                key = key << bits | padded[np.minimum(self.places[tied] + k, len(padded) - 1)]
            rank = self._refined(rank, tied, key)
        levels, width = [rank], MODULUS
        while len(tied := self._tied(levels[-1])):
            # Equal ones have no end of a text in their first `width` words, so what follows these is a sampled suffix.
            key = levels[-1][self.index[self.places[tied] + width]]
            levels.append(self._refined(levels[-1], tied, key))
            width *= 2
        return levels

    @staticmethod
    def _tied(rank: np.ndarray) -> np.ndarray:
        """Those that share their rank with another."""
        return np.nonzero(np.bincount(rank, minlength=1)[rank] > 1)[0] if len(rank) else np.zeros(0, np.int64)

    @staticmethod
    def _refined(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Ranks with ties broken by the key; a rank is the number of smaller suffixes, so that others keep theirs."""
        order = np.lexsort((key, rank[tied]))
        r, k = rank[tied][order], key[order]
        new_group = np.r_[True, r[1:] != r[:-1]]
        new = new_group | np.r_[True, k[1:] != k[:-1]]
        at = np.arange(len(r))
        group_start = np.maximum.accumulate(np.where(new_group, at, 0))
        start = np.maximum.accumulate(np.where(new, at, 0))
        out = rank.copy()
        out[tied[order]] = r + start - group_start
        return out

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of each sorted suffix and the one before it."""
        a, b = self.places[order[:-1]], self.places[order[1:]]
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][self.index[a + common]] == levels[k][self.index[b + common]]
            common[same] += MODULUS << k
        self._walk(a, b, common, np.full(len(a), 2 * MODULUS))
        return np.r_[0, common].astype(np.int32)

    def _walk(self, a: np.ndarray, b: np.ndarray, common: np.ndarray, most: np.ndarray) -> None:
        """Counts equal words on from `common`, up to `most` more, in place."""
        open_ = np.arange(len(a))
        for step in range(int(most.max(initial=0))):
            open_ = open_[most[open_] > step]
            x, y = a[open_] + common[open_], b[open_] + common[open_]
            open_ = open_[self.ids[x] == self.ids[y]]
            if not len(open_):
                break
            common[open_] += 1

    @staticmethod
    def _minima(values: np.ndarray) -> list[np.ndarray]:
        table = [values]
        while (half := 1 << len(table) - 1) * 2 <= len(values):
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a[k] and b[k] on, two different places each, are the same."""
        common = np.zeros(len(a), np.int64)
        steps = MEETING[a % MODULUS, b % MODULUS]
        self._walk(a, b, common, steps)
        met = np.nonzero(common == steps)[0]
        r, s = self.rank[self.index[a[met] + steps[met]]], self.rank[self.index[b[met] + steps[met]]]
        low, high = np.minimum(r, s) + 1, np.maximum(r, s)
        level = np.frexp(high - low + 1)[1] - 1
        for k in np.unique(level):
            of = np.nonzero(level == k)[0]
            common[met[of]] += np.minimum(self.table[k][low[of]], self.table[k][high[of] - (1 << int(k)) + 1])
        return common


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places of a text of n words and their periods, in portions."""
    q = np.arange(1, n // LEAST_PERIODS + 1)
    points = (n - 1) // q
    upto = np.cumsum(points)
    first = 0
    while first < len(q):
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, "right")))
        some = points[first:last]
        period = np.repeat(q[first:last], some)
        place = np.arange(len(period)) - np.repeat(np.cumsum(some) - some, some)
        yield place * period, period
        first = last


def runs_of(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows (first word, end, period) of all runs of texts that lie at `starts` in one array, by first word, then period."""
    found, queries, waiting = [], [], 0
    forward = backward = None

    def extend() -> None:
        nonlocal forward, backward, waiting
        if waiting:
            forward = forward or Extensions(ids)
            backward = backward or Extensions(np.r_[ids[::-1][1:], ids[-1]])
            a, q = (np.concatenate(x) for x in zip(*queries, strict=True))
            end = a + q + forward(a, a + q)
            # The ending id moved to the other side of its text: place p has become len - 2 - p.
            first = a + 1 - backward(len(ids) - 2 - a, len(ids) - 2 - a - q)
            good = (end - first >= LEAST_PERIODS * q) & (end - first >= LEAST_WORDS)
            found.append(np.stack([first[good], end[good], q[good]], 1))
        queries.clear()
        waiting = 0

    for start, n in zip(starts.tolist(), lengths.tolist(), strict=True):
        if n < LEAST_WORDS:
            continue
        own = ids[start : start + n]
        for place, period in _grid(n):
            same = np.nonzero(own[place] == own[place + period])[0]
            if len(same):
                queries.append((place[same] + start, period[same]))
                waiting += len(same)
            if waiting >= PAIRS:
                extend()
    extend()
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    # A multiple of a run's period gives the same stretch; its smallest period is the run's.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(1)]] if len(rows) else rows
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _together(texts: list[bytes]) -> Iterator[tuple[list[list[dict]], list[bytes]]]:
    """Runs and collapsed text of each text; texts share an array as long as it stays short."""
    part: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = text.split()  # bytes split at \x20 and \x09-\x0D, and nowhere else
        if part and size + len(words) > TOGETHER:
            yield _solved(part)
            part, size = [], 0
        part.append(words)
        size += len(words) + 1
    if part:
        yield _solved(part)


def _solved(part: list[list[bytes]]) -> tuple[list[list[dict]], list[bytes]]:
    known: dict[bytes, int] = {}
    lengths = np.array([len(words) for words in part])
    starts = np.cumsum(lengths + 1) - lengths - 1
    ids = np.zeros(int(lengths.sum()) + len(part), np.int32)
    for start, words in zip(starts.tolist(), part, strict=True):
        ids[start : start + len(words)] = [known.setdefault(w, len(known)) for w in words]
    ids[starts + lengths] = len(known) + np.arange(len(part), dtype=np.int32)
    rows = runs_of(ids, starts, lengths)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, rows[:, 0] + rows[:, 2], 1)
    np.add.at(change, rows[:, 1], -1)
    stays = np.cumsum(change) == 0
    of = np.searchsorted(starts, rows[:, 0], "right") - 1
    bounds = np.searchsorted(of, np.arange(len(part) + 1))
    runs, collapsed = [], []
    for k, (start, words) in enumerate(zip(starts.tolist(), part, strict=True)):
        own = rows[bounds[k] : bounds[k + 1]]
        runs.append([{"start": s - start, "length": e - s, "period": q} for s, e, q in own.tolist()])
        kept = [w for w, stay in zip(words, stays[start : start + len(words)].tolist(), strict=True) if stay] if len(own) else words
        collapsed.append(b" ".join(kept))
    return runs, collapsed


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_kept, runs, collapsed): the runs of words of each text, and the text with each run's repeats taken out.

    A run is a stretch of consecutive words with smallest period q, at least max(12, 2q) words long, that no word beside it
    extends; `runs` has (start, length, period) by start, then period. `collapsed` joins with one blank the n_kept words
    that no run contains after its first q words. Words are stretches without ASCII white space, told apart byte by byte.

    Null and empty texts have no words and no runs; a null id stays null; repeated rows are rows of their own with equal
    results; an empty table gives an empty result; a text of any length is one array in one task. Other columns are not
    read, so their names do not matter.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for runs, collapsed in _together(raw(batch.column(1))):
                part = batch.slice(at, len(runs))
                text = pa.array(collapsed, pa.binary()).cast(pa.string())
                words = pa.array([c.count(b" ") + 1 if c else 0 for c in collapsed], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), words, pa.array(runs, run), text], ["id", "n_kept", "runs", "collapsed"])
                at += len(runs)

    solved = rows.mapInArrow(solve, f"id {kind}, n_kept long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return solved.withColumnRenamed("id", id_column)
