"""SentencePiece encoding and decoding with batched numpy search.

Texts are cut where no piece can reach across, and each different chunk is encoded once. Chunks of equal length advance
together as rows of a matrix: hashes of their substrings probe the sorted keys of the pieces, and vectorised maxima choose.
Of a unigram model that is the Viterbi search, with a backpointer at every place. A BPE model defines its encoding by
merges instead, so there the maxima choose the best pair of neighbours to merge, one in every row at a time.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of text that are held as chunks at a time, chunks that a worker remembers, chunks in a matrix, and the longest
#: chunk that goes into one; longer ones are merged with a heap.
SLICE, REMEMBERED, MATRIX, LONG = 1_000_000, 500_000, 8192, 48
#: What an unknown character costs below the worst piece, as in unigram models.
UNKNOWN = 10.0
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """One 64-bit hash of each character."""
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _codes(chunks: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(chunks), length)


def _ragged(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices flat[start : start + size], one after another."""
    before = np.cumsum(size) - size
    return flat[np.repeat(start - before, size) + np.arange(int(size.sum()))]


@dataclass
class Pieces:
    """The table of a model: ids and scores by the hash of each piece, bytes by id."""

    texts: list[str]
    scores: np.ndarray
    usable: np.ndarray
    byte_ids: np.ndarray
    unk: int
    bpe: bool
    keys: np.ndarray = field(init=False)
    key_ids: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.longest = max((len(self.texts[i]) for i in self.usable), default=1)
        by_length = defaultdict(list)
        for i in self.usable:
            by_length[len(self.texts[i])].append(i)
        keys, ids = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for n, at in by_length.items():
            keys.append(self._hashes(_codes([self.texts[i] for i in at], n))[:, -1])
            ids.append(np.array(at))
        keys, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_ids = keys[order], ids[order]
        self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(LONG, self.longest) + 1, _BASE)]).astype(np.uint64))
        self.id_of = {self.texts[i]: int(i) for i in self.usable}
        raw = [x.replace(SPACE, " ").encode("utf-8", "surrogatepass") for x in self.texts]
        for value, i in enumerate(self.byte_ids):
            if i >= 0:
                raw[i] = bytes([value])
        self.sizes = np.array([len(x) for x in raw])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        multi = [self.texts[i] for i in self.usable if len(self.texts[i]) > 1]
        alone = "" if any("\n" in x for x in multi) else "\n"
        crossing = any(SPACE in x.lstrip(SPACE) for x in multi)
        self.cut = re.compile(r"(?s).+" if crossing else f"{alone}|{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" if alone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    @staticmethod
    def _hashes(codes: np.ndarray) -> np.ndarray:
        """Hashes of the prefixes of each row."""
        out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        mixed = _mixed(codes)
        for i in range(codes.shape[1]):
            out[:, i + 1] = out[:, i] * _BASE + mixed[:, i]
        return out

    def probe(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        if not len(self.keys):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.key_ids[at], -1)

    def _between(self, prefix: np.ndarray, rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ids of the pieces at prefix[row, start:end]."""
        size = end - start
        known = self.probe(prefix[rows, end] - prefix[rows, start] * self.powers[np.minimum(size, len(self.powers) - 1)])
        return np.where(size <= self.longest, known, -1)

    def _score(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.scores[ids], -np.inf)

    def fall_back(self, character: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown id."""
        ids = [int(self.byte_ids[b]) for b in character.encode("utf-8", "surrogatepass")]
        return ids if min(ids) >= 0 else [self.unk]

    def _spelled(self, chunk: str, bounds: list[int]) -> list[int]:
        out: list[int] = []
        for s, e in zip(bounds, bounds[1:], strict=False):
            i = self.id_of.get(chunk[s:e])
            out += self.fall_back(chunk[s:e]) if i is None else [i]
        return out

    def viterbi(self, chunks: list[str]) -> list[list[int]]:
        """Best sum of scores, for chunks of one length: at every place, the maximum over the pieces that end there."""
        length, n = len(chunks[0]), len(chunks)
        prefix, rows = self._hashes(_codes(chunks, length)), np.arange(n)
        best, back = np.full((n, length + 1), -np.inf), np.zeros((n, length + 1), np.int64)
        best[:, 0] = 0.0
        worst = float(self.scores[self.usable].min()) - UNKNOWN if len(self.usable) else -UNKNOWN
        for end in range(1, length + 1):
            sizes = np.arange(1, min(self.longest, end) + 1)
            pieces = self.probe(prefix[:, [end]] - prefix[:, end - sizes] * self.powers[sizes])
            gained = self._score(pieces)
            gained[:, 0] = np.where(pieces[:, 0] >= 0, gained[:, 0], worst)
            reached = best[:, end - sizes] + gained
            at = reached.argmax(1)
            best[:, end], back[:, end] = reached[rows, at], end - sizes[at]
        out = []
        for chunk, pointers in zip(chunks, back.tolist(), strict=True):
            bounds = [length]
            while bounds[-1]:
                bounds.append(pointers[bounds[-1]])
            out.append(self._spelled(chunk, bounds[::-1]))
        return out

    def merged(self, chunks: list[str]) -> list[list[int]]:
        """Merges of chunks of one length: in every row the pair of the highest score, leftmost among equals."""
        length, n = len(chunks[0]), len(chunks)
        prefix, rows = self._hashes(_codes(chunks, length)), np.arange(n)
        bounds = np.tile(np.arange(length + 1), (n, 1))
        out: list[list[int]] = [[]] * n
        pair = self._score(self._between(prefix, rows[:, None], bounds[:, :-2], bounds[:, 2:])) if length > 1 else np.empty((n, 0))
        while len(rows):
            at = pair.argmax(1) if pair.shape[1] else np.zeros(len(rows), int)
            going = pair[np.arange(len(rows)), at] > -np.inf if pair.shape[1] else np.zeros(len(rows), bool)
            ended, ends = rows[~going], bounds[~going]
            ids = self._between(prefix, ended[:, None], ends[:, :-1], ends[:, 1:])
            whole = (ids >= 0).all(1)
            for i, b, x, known in zip(ended.tolist(), ends.tolist(), ids.tolist(), whole.tolist(), strict=True):
                out[i] = x if known else self._spelled(chunks[i], b)
            rows, at, bounds, pair = rows[going], at[going], bounds[going], pair[going]
            if not len(rows):
                break
            here = np.arange(len(rows))
            gone = np.ones(bounds.shape, bool)
            gone[here, at + 1] = False
            bounds = bounds[gone].reshape(len(rows), -1)
            left = np.ones(pair.shape, bool)
            left[here, at] = False
            pair = pair[left].reshape(len(rows), -1)
            for shift in (-1, 0):
                p = at + shift
                fits = (p >= 0) & (p < pair.shape[1])
                h, p = here[fits], p[fits]
                pair[h, p] = self._score(self._between(prefix, rows[fits], bounds[h, p], bounds[h, p + 2]))
        return out

    def merged_long(self, chunk: str) -> list[int]:
        """The same merges for one long chunk, whose pairs wait in a heap."""
        n = len(chunk)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive, heap = [True] * n, []

        def push(s: int) -> None:
            if s >= 0 and after[s] < n:
                e = end[after[s]]
                i = self.id_of.get(chunk[s:e]) if e - s <= self.longest else None
                if i is not None:
                    heapq.heappush(heap, (-float(self.scores[i]), s, after[s], e))

        for s in range(n):
            push(s)
        while heap:
            _, s, m, e = heapq.heappop(heap)
            if not (alive[s] and m < n and alive[m] and after[s] == m and end[m] == e):
                continue
            alive[m] = False
            end[s], after[s] = e, after[m]
            if after[s] < n:
                before[after[s]] = s
            push(s)
            push(before[s])
        return self._spelled(chunk, [s for s in range(n) if alive[s]] + [n])

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(chunks)
        by_length = defaultdict(list)
        for i, x in enumerate(chunks):
            by_length[len(x)].append(i)
        for length, at in by_length.items():
            if self.bpe and length > LONG:
                for i in at:
                    out[i] = self.merged_long(chunks[i])
                continue
            step = max(1, MATRIX * LONG // (length + LONG))
            for j in range(0, len(at), step):
                part = at[j : j + step]
                found = (self.merged if self.bpe else self.viterbi)([chunks[i] for i in part])
                for i, ids in zip(part, found, strict=True):
                    out[i] = ids
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of a text's pieces, without the blank that encoding put first."""
        out = _ragged(self.raw, self.starts[ids], self.sizes[ids]).tobytes()
        return out[1:] if out.startswith(b" ") else out


def load_pieces(path: str = MODEL) -> Pieces:
    """The table of a SentencePiece model file with identity normalisation and a blank put first."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    plain = [i for i in range(n) if not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i) or m.is_byte(i))]
    texts, byte_ids = [m.id_to_piece(i) for i in range(n)], np.full(256, -1)
    for i in range(n):
        if m.is_byte(i):
            byte_ids[int(texts[i][3:-1], 16)] = i
    scores = np.array([m.get_score(i) for i in range(n)])
    return Pieces(texts, scores, np.array(plain), byte_ids, m.unk_id(), _is_bpe(scores[plain]))


def _is_bpe(scores: np.ndarray) -> bool:
    """BPE models score by rank, in whole numbers; a unigram model's are log probabilities."""
    return bool(len(scores)) and bool((scores == np.rint(scores)).all())


class Encoder:
    """Encodes texts and remembers the chunks it met, up to a bound."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.size = (np.empty(0, np.int64) for _ in range(3))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) > REMEMBERED:
            self._forget()
        cut = self.pieces.cut.findall
        chunked = [cut(SPACE + x.replace(" ", SPACE)) if x else [] for x in texts]
        new = list(dict.fromkeys(c for chunks in chunked for c in chunks if c not in self.index))
        if new:
            found = self.pieces.encode_chunks(new)
            size = np.array([len(x) for x in found])
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, np.fromiter((i for x in found for i in x), np.int64)])
        out = []
        for chunks in chunked:
            at = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
            out.append(_ragged(self.flat, self.start[at], self.size[at]))
        return out


#: The encoder of a worker process, by the model's path: tasks that follow each other share what it remembers.
_ENCODERS: dict[str, Encoder] = {}


def _encoder(model: str, pieces: Pieces) -> Encoder:
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = Encoder(pieces)
    return _ENCODERS[model]


def _slices(texts: list[str]) -> Iterator[slice]:
    begin = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= SLICE:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def encode(docs: DataFrame, model: str = MODEL, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, n_ids, round_trip) for every row of `docs`.

    round_trip tells whether decoding gives the text back, where a literal U+2581 counts as a blank. A null or empty text
    has no ids and makes the trip. Repeated rows give repeated rows, an empty table gives an empty one, further columns
    are ignored. Texts are encoded whole, chunk by chunk; the model is a file that the driver reads.
    """
    held = docs.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, held.value)
        for batch in batches:
            ids, texts = batch.column(0), [x or "" for x in batch.column(1).to_pylist()]
            for part in _slices(texts):
                found = encoder.encode(texts[part])
                same = [held.value.decode(f) == t.replace(SPACE, " ").encode() for f, t in zip(found, texts[part], strict=True)]
                sizes = np.array([len(f) for f in found], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_pydict({"doc_id": ids[part.start : part.stop], "ids": lists, "n_ids": sizes, "round_trip": pa.array(same, pa.bool_())})

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, ids array<int>, n_ids long, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give a null text, bytes that are no UTF-8 the replacement character."""
    held = encoded.sparkSession.sparkContext.broadcast(load_pieces(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else held.value.decode(np.array(x, np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select(F.col(id_column).cast("long").alias("doc_id"), F.col(ids_column).cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")
