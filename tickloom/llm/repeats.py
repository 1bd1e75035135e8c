"""Repeated byte strings over a whole corpus: suffixes are sorted at anchors, deep-shallow, and their common prefixes tell
which strings of a given length start at more than one place.

All strings of `WIDTH` bytes (windows) that are equal have the same anchor, the place of their least-hashed gram. Windows
that follow each other and share their anchor are one piece of text, so that a text is a few hundred pieces per 100 kB. An
anchor lies in two halves of its windows' offsets, and all windows of a half hold the same core of bytes around it; only
pieces whose core occurs again are of interest, and equal pieces are told by their digests before any text is moved.

What is left, different pieces with the same core, is sorted by key of the core: suffixes from the anchor on and prefixes
backwards from it. Multikey quicksort on symbols of eight bytes orders them to a shallow depth; groups that still agree go
into blind tries, which compare one branching byte per level and whole strings only once. Two pieces share the window that
starts x bytes before the anchor if they agree on x bytes to its left and on the rest to its right.

Bitmaps of a fixed size, the same on every input, keep most pieces and texts that have no part in this from travelling.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import bitmap, in_bitmap, raw, written

#: Bytes of a repeated string, of the grams that anchors are chosen from, and grams in a window.
WIDTH, GRAM = 400, 64
#: Bytes that multikey quicksort orders, in symbols of eight bytes.
SHALLOW = 64
#: Window starts that are hashed in one go; below 2**20, as an anchor's place is packed into 20 bits.
SEGMENT = (1 << 20) - (1 << 11)
#: Bits of a bitmap (16 MB at any size of the input).
BITS = 1 << 27
#: Pieces of one core that are sorted together. Windows of cores with more of them are told by their digests, one by one.
TOGETHER = 4096
#: Bytes of pieces that are sorted in one go, whatever their cores.
SORTED = 4 << 20

_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Pieces:
    """Cuts texts into pieces: runs of windows with a common anchor, in one half of the anchor's offsets."""

    def __init__(self, width: int = WIDTH, gram: int = GRAM, segment: int = SEGMENT) -> None:
        self.width, self.gram, self.segment = width, min(gram, width), segment
        self.grams = width - self.gram + 1
        self.half = (self.grams + 1) // 2

    def _anchors(self, sums: np.ndarray, down: np.ndarray, starts: int) -> np.ndarray:
        """The place of the least-hashed gram of each window, the last of equal ones."""
        n = starts + self.grams - 1
        h = (sums[self.gram : self.gram + n] - sums[:n]) * down[:n]
        h = (h ^ h >> np.uint64(32)) * _MIX
        low = np.uint64((1 << 20) - 1)
        ranked = h & ~low | low - np.arange(n, dtype=np.uint64)
        # Least of any `grams` neighbours: of the rest of one row and the beginning of the next.
        rows = -(-n // self.grams)
        padded = np.full(rows * self.grams, np.iinfo(np.uint64).max, np.uint64)
        padded[:n] = ranked
        grid = padded.reshape(rows, self.grams)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:starts], ahead[self.grams - 1 : self.grams - 1 + starts])
        return (low - (least & low)).astype(np.int64)

    def __call__(self, data: bytes, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, windows, anchor and key of every piece of the texts that lie in `data` one after the other."""
        up, down = _powers(self.segment + self.width)
        found = []
        ends = ends[ends > 0]
        for at in range(0, max(0, len(data) - self.width + 1), self.segment):
            part = np.frombuffer(data, np.uint8, min(len(data) - at, self.segment + self.width - 1), at)
            starts = len(part) - self.width + 1
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
            anchor = self._anchors(sums, down, starts)
            place = np.arange(starts)
            text = np.searchsorted(ends, place + at, "right")
            inside = place + at + self.width <= ends[text]
            half = anchor - place >= self.half
            new = np.r_[True, (anchor[1:] != anchor[:-1]) | (half[1:] != half[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])]
            first = np.nonzero(new)[0]
            windows = np.diff(np.r_[first, starts])
            of = inside[first]
            first, windows = first[of], windows[of]
            a, late = anchor[first], half[first]
            # All windows of the half hold these bytes.
            begin = np.where(late, a - self.half, a)
            end = np.where(late, a + self.width - self.grams + 1, a + self.width - self.half + 1)
            core = (sums[end] - sums[begin]) * down[begin] + late.astype(np.uint64)
            core = (core ^ core >> np.uint64(32)) * _MIX
            found.append((first + at, windows, a + at, (core ^ core >> np.uint64(29)).view(np.int64)))
        if not found:
            return tuple(np.zeros(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length() + 7) // 8


class BlindTrie:
    """A trie that holds only branching bytes; a string is compared with one other when it is put in."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.root: list | None = None  # a leaf: [-1, numbers of equal strings]; a branch: [depth, children by byte]

    def _byte(self, number: int, depth: int) -> int:
        s = self.strings[number]
        return s[depth] if depth < len(s) else -1

    def put(self, number: int) -> None:
        if self.root is None:
            self.root = [-1, [number]]
            return
        node = self.root
        while node[0] >= 0:
            child = node[1].get(self._byte(number, node[0]))
            node = child if child is not None else next(iter(node[1].values()))
        other = node[1][0]
        common = common_prefix(self.strings[number], self.strings[other])
        if common == len(self.strings[number]) == len(self.strings[other]):
            node[1].append(number)
            return
        above, node = None, self.root
        while 0 <= node[0] < common:
            above, node = node, node[1][self._byte(number, node[0])]
        if node[0] == common:
            node[1][self._byte(number, common)] = [-1, [number]]
            return
        branch = [common, {self._byte(other, common): node, self._byte(number, common): [-1, [number]]}]
        if above is None:
            self.root = branch
        else:
            above[1][self._byte(number, above[0])] = branch

    def sorted(self) -> Iterator[tuple[int, int]]:
        """Numbers in the order of their strings, each with the bytes it shares with the one before (the first: -1)."""
        stack = [(-1, self.root)] if self.root else []
        while stack:
            common, node = stack.pop()
            if node[0] < 0:
                for k, number in enumerate(node[1]):
                    yield number, common if not k else len(self.strings[number])
                continue
            children = sorted(node[1])
            stack += [(node[0] if k else common, node[1][children[k]]) for k in range(len(children) - 1, -1, -1)]


def deep_shallow(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings within ascending groups, and the bytes each shares with the one before it in its group (the first: -1)."""
    m = len(strings)
    table = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), np.uint8).reshape(m, SHALLOW)
    symbols = table.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    bucket = np.searchsorted(group[order], group[order])  # each one's bucket is the place where it begins
    for depth in range(symbols.shape[1]):
        tied = np.nonzero(np.bincount(bucket, minlength=m)[bucket] > 1)[0] if m else np.zeros(0, np.int64)
        if not len(tied):
            break
        by = np.lexsort((symbols[order[tied], depth], bucket[tied]))
        order[tied] = order[tied][by]
        b, s = bucket[tied], symbols[order[tied], depth]
        new = np.r_[True, (b[1:] != b[:-1]) | (s[1:] != s[:-1])]
        bucket[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
    within = np.full(m, -1, np.int64)
    sizes = np.bincount(bucket, minlength=m)
    for at in np.nonzero(sizes > 1)[0].tolist():
        trie = BlindTrie(strings)
        for number in order[at : at + sizes[at]].tolist():
            trie.put(number)
        for k, (number, common) in enumerate(trie.sorted(), at):
            order[k], within[k] = number, common
    lcp = np.full(m, -1, np.int64)
    if m > 1:
        lengths = np.array([len(s) for s in strings], np.int64)
        a, b = order[:-1], order[1:]
        shallow = np.minimum((table[a] != table[b]).argmax(1), np.minimum(lengths[a], lengths[b]))
        lcp[1:] = np.where(group[a] != group[b], -1, np.where(bucket[1:] == bucket[:-1], within[1:], shallow))
    return order, lcp


def shared_windows(rights: list[bytes], lefts: list[bytes], group: np.ndarray, width: int = WIDTH) -> list[list[tuple[int, int]]]:
    """For each piece the ranges of offsets x (first, last) of the windows that another piece of its group holds too.

    A piece is what lies right of its anchor and, backwards, left of it; the window of offset x has x bytes to the left.
    """
    right_order, right_lcp = deep_shallow(rights, group)
    left_order, left_lcp = deep_shallow(lefts, group)
    right_len, left_len = (np.array([len(s) for s in x], np.int64) for x in (rights, lefts))
    out: list[list[tuple[int, int]]] = [[] for _ in rights]
    begins = np.nonzero(right_lcp < 0)[0]
    for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(rights)], strict=True):
        m = end - begin
        if m == 2:
            first, last = width - int(right_lcp[end - 1]), int(left_lcp[end - 1])
            if first <= last:
                for k in right_order[begin:end].tolist():
                    out[k].append((first, last))
        elif m > 2:
            ro, lo = right_order[begin:end], left_order[begin:end]
            rl, ll = right_lcp[begin:end], left_lcp[begin:end]
            members = np.sort(ro)
            rp, lp = np.searchsorted(members, ro), np.searchsorted(members, lo)
            rn, ln = right_len[members], left_len[members]
            # Offsets at which pieces part, begin or end.
            low, high = max(0, width - int(rn.max())), int(ln.max())
            steps = np.unique(np.r_[low, ll[1:] + 1, width - rl[1:], ln + 1, width - rn])
            steps = steps[(steps >= low) & (steps <= high)]
            for x, upto in zip(steps.tolist(), [*(steps[1:] - 1).tolist(), high], strict=True):
                right_class, left_class = np.empty(m, np.int64), np.empty(m, np.int64)
                right_class[rp] = np.cumsum(rl < width - x)
                left_class[lp] = np.cumsum(ll < x)
                holds = np.nonzero((ln >= x) & (rn >= width - x))[0]
                _, which, counts = np.unique(right_class[holds] * (m + 1) + left_class[holds], return_inverse=True, return_counts=True)
                for k in members[holds[counts[which] > 1]].tolist():
                    if out[k] and out[k][-1][1] == x - 1:
                        out[k][-1] = (out[k][-1][0], upto)
                    else:
                        out[k].append((x, upto))
    return out


def _bit(column: Column) -> Column:
    return F.pmod(column, F.lit(BITS))


def _pieces_of_texts(texts: DataFrame, pieces: Pieces) -> DataFrame:
    """(print, starts, windows, leads, keys, digests): the pieces of each text that has any, as packed arrays."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, all_texts = batch.column(0).to_pylist(), raw(batch.column(1))
            at = 0
            while at < len(all_texts):
                upto, size = at, 0
                while upto < len(all_texts) and (upto == at or size + len(all_texts[upto]) <= SEGMENT):
                    size += len(all_texts[upto])
                    upto += 1
                yield from rows(prints[at:upto], all_texts[at:upto])
                at = upto

    def rows(prints: list[bytes], some: list[bytes]) -> Iterator[pa.RecordBatch]:
        data = b"".join(some)
        ends = np.cumsum([len(t) for t in some])
        start, windows, anchor, key = pieces(data, ends)
        more = pieces.width - 1
        digests = [blake2b(data[s : s + n + more], digest_size=16).digest() for s, n in zip(start.tolist(), windows.tolist(), strict=True)]
        text = np.searchsorted(ends, start, "right")
        bounds = np.searchsorted(text, np.arange(len(some) + 1)).tolist()
        lead = (anchor - start).astype(np.int16)
        out = {n: [] for n in ("print", "starts", "windows", "leads", "keys", "digests")}
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
            if a < b:
                begin = int(ends[k]) - len(some[k])
                for name, value in zip(out, (prints[k], (start[a:b] - begin).astype(np.int64), windows[a:b].astype(np.int16), lead[a:b], key[a:b], b"".join(digests[a:b])), strict=True):
                    out[name].append(value if isinstance(value, bytes) else value.tobytes())
        if out["print"]:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in out.values()], list(out))

    return written(texts.mapInArrow(cut, ", ".join(f"{n} binary" for n in ("print", "starts", "windows", "leads", "keys", "digests"))), "pieces")


def _unpacked(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, dict[str, np.ndarray]]:
    """Texts' prints, each piece's text, and the pieces' columns."""
    kinds = {"starts": np.int64, "windows": np.int16, "leads": np.int16, "keys": np.int64, "digests": np.int64}
    joined = {n: np.frombuffer(b"".join(batch.column(n).to_pylist()), kind) for n, kind in kinds.items()}
    digests = joined.pop("digests").reshape(-1, 2)
    joined |= {"d1": digests[:, 0], "d2": digests[:, 1]}
    each = np.array([len(x) // 8 for x in batch.column("keys").to_pylist()], np.int64)
    return batch.column("print").to_pylist(), np.repeat(np.arange(len(each)), each), joined


def _small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _counted(pieces: DataFrame, only: Broadcast | None) -> DataFrame:
    """(key, d1, d2, copies, print, start, windows, lead): different pieces, each with one place where it stands.

    Summed up within batches; `only` is a bitmap of the keys wanted.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            prints, text, x = _unpacked(batch)
            if only is not None:
                open_ = in_bitmap(only.value, x["keys"] & (BITS - 1))
                text, x = text[open_], {n: v[open_] for n, v in x.items()}
            if not len(text):
                continue
            order = np.lexsort((x["d2"], x["d1"], x["keys"]))
            same = np.ones(len(order), bool)
            same[0] = False
            for n in ("keys", "d1", "d2"):
                v = x[n][order]
                same[1:] &= v[1:] == v[:-1]
            first = np.nonzero(~same)[0]
            copies = np.diff(np.r_[first, len(order)])
            at = order[first]
            columns = [x["keys"][at], x["d1"][at], x["d2"][at], copies]
            names = ["key", "d1", "d2", "copies"]
            if only is not None:
                columns += [x["starts"][at], x["windows"][at].astype(np.int64), x["leads"][at].astype(np.int64)]
                names += ["start", "windows", "lead"]
            arrays = [pa.array(c) for c in columns]
            if only is not None:
                arrays.append(pa.array(prints, pa.binary()).take(pa.array(text[at])))
                names.append("print")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "key long, d1 long, d2 long, copies long" + (", start long, windows long, lead long, print binary" if only is not None else "")
    return pieces.mapInArrow(count, schema)


def _repeated_keys(pieces: DataFrame) -> DataFrame:
    """(key, several): cores that occur more than once, and whether different pieces hold them."""
    keys = _counted(pieces, None).groupBy("key").agg(F.sum("copies").alias("copies"), *[f("d1").alias(n) for f, n in ((F.min, "low"), (F.max, "high"))], F.min("d2").alias("low2"), F.max("d2").alias("high2"))
    several = (F.col("low") != F.col("high")) | (F.col("low2") != F.col("high2"))
    return written(keys.where("copies >= 2").select("key", several.alias("several")), "keys")


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(print, text) of the wanted prints, once each."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(bitmap(wanted.select(_bit(F.xxhash64("print")).alias("bit")), BITS))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["print", "text"]).filter(pa.array(in_bitmap(shared.value, batch.column("bit").to_numpy())))

    some = texts.withColumn("bit", _bit(F.xxhash64("print"))).mapInArrow(held, "print binary, text string")
    return some.groupBy("print").agg(F.first("text").alias("text"))


def _contents(texts: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """(key, d1, d2, copies, lead, piece): the bytes of each piece, cut from the text where it stands."""
    wanted = written(places.groupBy("print").agg(F.collect_list(F.struct("key", "d1", "d2", "copies", "lead", "start", "windows")).alias("places")), "wanted")
    both = _texts_of(texts, wanted).join(wanted, "print").select("text", "places")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, 64):
            texts_ = raw(batch.column(0))
            flat = batch.column(1).flatten()
            start, windows = (flat.field(n).to_numpy() for n in ("start", "windows"))
            text = np.repeat(np.arange(len(texts_)), pc.list_value_length(batch.column(1)).to_numpy())
            piece = [texts_[t][s : s + n + width - 1] for t, s, n in zip(text.tolist(), start.tolist(), windows.tolist(), strict=True)]
            names = ["key", "d1", "d2", "copies", "lead"]
            yield pa.RecordBatch.from_arrays([*[flat.field(n) for n in names], pa.array(piece, pa.binary())], [*names, "piece"])

    return both.mapInArrow(cut, "key long, d1 long, d2 long, copies long, lead long, piece binary")


_SPANS = "array<struct<begin: int, upto: int>>"


def _sorted_spans(contents: DataFrame, width: int) -> DataFrame:
    """(key, d1, d2, spans): repeated bytes of each piece, found by sorting all pieces of a core."""
    span = pa.list_(pa.struct([("begin", pa.int32()), ("upto", pa.int32())]))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        size = 0
        for batch in _small(batches, TOGETHER):
            kept.append(batch)
            size += batch.column("piece").nbytes
            if size >= SORTED:
                rows = pa.Table.from_batches(kept).combine_chunks()
                keys = rows.column("key").to_numpy()
                whole = int(np.searchsorted(keys, keys[-1]))  # the last core may go on
                if whole:
                    yield from spans(rows.slice(0, whole))
                kept, size = rows.slice(whole).to_batches(), rows.slice(whole).nbytes
        if kept:
            yield from spans(pa.Table.from_batches(kept).combine_chunks())

    def spans(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        piece, lead = rows.column("piece").to_pylist(), rows.column("lead").to_pylist()
        _, group = np.unique(rows.column("key").to_numpy(), return_inverse=True)
        found = shared_windows([p[k:] for p, k in zip(piece, lead, strict=True)], [p[:k][::-1] for p, k in zip(piece, lead, strict=True)], group, width)
        at = [k for k, ranges in enumerate(found) if ranges]
        if not at:
            return
        out = [[{"begin": lead[k] - last, "upto": lead[k] - first + width} for first, last in found[k]] for k in at]
        table = rows.select(["key", "d1", "d2"]).take(at).append_column("spans", pa.array(out, span))
        yield from table.combine_chunks().to_batches()

    # Cores are dealt out by key and come one after the other, so that a task sorts many small ones at a time.
    return contents.repartition("key").sortWithinPartitions("key").mapInArrow(solve, f"key long, d1 long, d2 long, spans {_SPANS}")


def _told_spans(contents: DataFrame, width: int) -> DataFrame:
    """As `_sorted_spans`, for cores with so many pieces that no task may hold them: windows meet by their digests."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, 256):
            pieces = batch.column("piece").to_pylist()
            each = np.array([len(p) - width + 1 for p in pieces], np.int64)
            digests = b"".join(blake2b(p[s : s + width], digest_size=16).digest() for p, n in zip(pieces, each.tolist(), strict=True) for s in range(n))
            both = np.frombuffer(digests, np.int64).reshape(-1, 2)
            row = pa.array(np.repeat(np.arange(len(pieces)), each))
            begin = pa.array((np.arange(len(both)) - np.repeat(np.cumsum(each) - each, each)).astype(np.int32))
            names = ["key", "d1", "d2", "copies"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n).take(row) for n in names], begin, pa.array(both[:, 0]), pa.array(both[:, 1])], [*names, "begin", "w1", "w2"])

    windows = written(contents.mapInArrow(cut, "key long, d1 long, d2 long, copies long, begin int, w1 long, w2 long"), "windows")
    often = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("places")).where("places >= 2").select("w1", "w2")
    shared = windows.join(often, ["w1", "w2"])
    return shared.groupBy("key", "d1", "d2").agg(F.collect_list(F.struct("begin", (F.col("begin") + width).alias("upto"))).alias("spans"))


def repeated_spans(texts: DataFrame, width: int = WIDTH, gram: int = GRAM, segment: int = SEGMENT) -> DataFrame:
    """(print, spans): bytes [begin, upto) that strings of `width` bytes cover which start anywhere else too, by the text's print.

    texts: (print, text), a row for every text; the print tells texts apart. Spans of a text may overlap.
    """
    spark = texts.sparkSession
    cutter = Pieces(width, gram, segment)
    pieces = _pieces_of_texts(texts.select("print", "text"), cutter)
    repeated = _repeated_keys(pieces)
    share = lambda keys: spark.sparkContext.broadcast(bitmap(keys.select(_bit(F.col("key")).alias("bit")), BITS))  # noqa: E731  BITS / 8 bytes
    several = repeated.where("several").select("key")
    some = _counted(pieces, share(several)).groupBy("key", "d1", "d2").agg(F.sum("copies").alias("copies"), F.min(F.struct("print", "start", "windows", "lead")).alias("at"))
    different = written(some.join(several, "key").select("key", "d1", "d2", "copies", "at.*"), "different")
    # A core all of whose pieces stand somewhere twice has nothing to compare.
    sizes = different.groupBy("key").agg(F.count("*").alias("size"), F.min("copies").alias("least")).where("least < 2")
    contents = written(_contents(texts, different.join(sizes.select("key"), "key"), width), "contents")
    crowded = written(sizes.where(F.col("size") > TOGETHER).select("key"), "crowded")
    found = _sorted_spans(contents.join(crowded, "key", "left_anti"), width)
    if crowded.head(1):
        found = found.unionByName(_told_spans(contents.join(crowded, "key", "left_semi"), width))
    all_of = F.array(F.struct(F.lit(0).alias("begin"), (F.col("windows") + width - 1).cast("int").alias("upto")))
    twice = different.where("copies >= 2").select("key", "d1", "d2", all_of.alias("spans"))
    # Pieces that stand twice are covered whole, whatever sorting has found for them.
    once = found.join(twice.select("key", "d1", "d2"), ["key", "d1", "d2"], "left_anti")
    spans = written(twice.unionByName(once), "spans")
    placed = _placed(pieces, share(repeated.select("key")))
    known = placed.join(repeated, "key")
    whole = known.where(~F.col("several")).select("print", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + width - 1).alias("upto"))
    parts = known.where("several").join(spans, ["key", "d1", "d2"]).select("print", "start", F.inline("spans"))
    both = whole.unionByName(parts.select("print", (F.col("start") + F.col("begin")).alias("begin"), (F.col("start") + F.col("upto")).alias("upto")))
    return both.groupBy("print").agg(F.collect_set(F.struct("begin", "upto")).alias("spans"))


def _placed(pieces: DataFrame, only: Broadcast) -> DataFrame:
    """(key, d1, d2, print, start, windows): every piece whose key may be wanted, where it stands."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            prints, text, x = _unpacked(batch)
            at = np.nonzero(in_bitmap(only.value, x["keys"] & (BITS - 1)))[0]
            arrays = [pa.array(x[n][at]) for n in ("keys", "d1", "d2", "starts")] + [pa.array(x["windows"][at].astype(np.int64)), pa.array(prints, pa.binary()).take(pa.array(text[at]))]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "d1", "d2", "start", "windows", "print"])

    return pieces.mapInArrow(place, "key long, d1 long, d2 long, start long, windows long, print binary")


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans as one, in ascending order."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    upto = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > upto[:-1]] if len(spans) else np.zeros(0, bool)
    begin = np.nonzero(new)[0]
    return np.stack([spans[begin, 0], np.maximum.reduceat(spans[:, 1], begin)], 1) if len(spans) else spans


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_column: str = "doc_id", text_column: str = "text", gram: int = GRAM, segment: int = SEGMENT) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): each text without the bytes that a repeated string of `width` bytes covers.

    `removed` has the spans [begin, upto) of UTF-8 bytes, in order, none touching another; `kept` has what is left, as
    bytes, since a span may begin or end within a character. A string is repeated if it starts anywhere else in the
    corpus, its own text included; matches never cross texts, and all are judged on the input.

    Null and empty texts have no bytes; texts shorter than `width` lose nothing; repeated rows of at least `width` bytes
    lose everything, each of them; a null id stays null; an empty table gives an empty result; a text of any length is one
    row. Other columns are not read, so their names do not matter.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_column).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("print"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spans = written(repeated_spans(rows.select("print", "text"), width, gram, segment), "repeats")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(spans.select(_bit(F.xxhash64("print")).alias("bit")), BITS))
    rows = rows.withColumn("bit", _bit(F.xxhash64("print")))

    def apart(open_: bool):
        """Texts that may have repeats, or those that have none and never travel."""

        def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                wanted = batch.filter(pa.array(in_bitmap(shared.value, batch.column("bit").to_numpy()) == open_))
                yield wanted.select(["id", "print", "text"])

        return rows.mapInArrow(texts, f"id {kind}, print binary, text string").select("id", "print", F.col("text").cast("binary").alias("text"))

    none = F.array().cast("array<struct<begin: long, upto: long>>")
    clean = apart(False).select("id", F.length("text").cast("long").alias("n_bytes"), none.alias("removed"), F.col("text").alias("kept"))
    met = apart(True).join(spans, "print", "left").select("id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches):
            removed, kept, sizes = [], [], []
            for text_, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                gone = merged(np.array([(s["begin"], s["upto"]) for s in found or ()], np.int64).reshape(-1, 2)).tolist()
                removed.append([{"begin": a, "upto": b} for a, b in gone])
                sizes.append(len(text_))
                edges = [0, *(x for span in gone for x in span), len(text_)]
                kept.append(b"".join(text_[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("upto", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())], ["id", "n_bytes", "removed", "kept"])

    done = met.mapInArrow(cut, f"id {kind}, n_bytes long, removed array<struct<begin: long, upto: long>>, kept binary")
    return clean.unionByName(done).withColumnRenamed("id", id_column)

