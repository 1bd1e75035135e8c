"""Language identification by word-first backoff.

A known word is scored by its per-language log frequency. An unseen word falls back to the character n-grams it is made of:
at every place the longest known n-gram speaks, from four characters down to one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickloom.llm.common import remainder, written

#: Labelled documents of each language to learn from at most (in expectation, spread evenly over all by a hash of their
#: id), the longest n-gram, and the words whose rows a task remembers.
LEARN_FROM, LONGEST, REMEMBERED = 20_000, 4, 100_000
#: A word scores with at least this many occurrences; fewer leave it to its n-grams.
LEAST_SEEN, PRIOR = 2, 0.1
#: Scores of a word and of a text's words are scaled so: the words of a text are not independent.
TEMPER = 0.5
UND = "und"
_LETTERS = regex.compile(r"\p{L}+")


class Words:
    """Different words, found by hash and then compared: some 30 bytes for each, where a dictionary takes five times as many."""

    def __init__(self, words: list[str] | pa.Array):
        self.words = pa.array(words, pa.large_string()) if isinstance(words, list) else words.cast(pa.large_string())
        hashes = np.fromiter((self._hash(w) for w in self), np.uint64, len(self.words))
        self.rows = np.argsort(hashes).astype(np.int32)
        self.hashes = hashes[self.rows]

    @staticmethod
    def _hash(word: str) -> int:
        return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))

    def __iter__(self) -> Iterator[str]:
        return (w.as_py() for w in self.words)

    def __len__(self) -> int:
        return len(self.words)

    def find(self, words: list[str]) -> list[int]:
        """The place of each word, -1 where it is not held."""
        out = [-1] * len(words)
        if not len(self):
            return out
        wanted = np.fromiter(map(self._hash, words), np.uint64, len(words))
        low = np.searchsorted(self.hashes, wanted)
        for i in np.flatnonzero(self.hashes[np.minimum(low, len(self) - 1)] == wanted).tolist():
            at = int(low[i])
            while out[i] < 0 and at < len(self) and self.hashes[at] == wanted[i]:
                if self.words[int(self.rows[at])].as_py() == words[i]:
                    out[i] = int(self.rows[at])
                at += 1
        return out


@dataclass
class LanguageModel:
    """Log frequencies of words and n-grams: a row each, a column for every language."""

    languages: list[str]
    prior: np.ndarray
    words: Words | list[str]
    word_logs: np.ndarray
    grams: list[str]
    gram_logs: np.ndarray

    def __post_init__(self) -> None:
        if not isinstance(self.words, Words):
            self.words = Words(self.words)

    def __getstate__(self) -> dict:
        return {f.name: self.__dict__[f.name] for f in fields(self)}

    def _prepare(self) -> None:
        """Rows of known words, followed by room for words that n-grams spoke for."""
        self._at: dict[str, int] = {}
        self._gram_at = {g: i for i, g in enumerate(self.grams)}
        self._table = np.concatenate([self.word_logs, np.zeros((REMEMBERED, len(self.languages)))])
        self.word_logs = self._table[: len(self.words)]

    def of_grams(self, word: str) -> np.ndarray:
        """The mean over the word's places of the longest known n-gram that ends there."""
        marked, get = f"<{word}>", self._gram_at.get
        found = []
        for end in range(2, len(marked) + 1):
            for n in range(min(LONGEST, end), 0, -1):
                if (at := get(marked[end - n : end])) is not None:
                    found.append(at)
                    break
        return self.gram_logs[found].sum(0) / (len(marked) - 1)

    def _rows(self, words: list[str]) -> list[int]:
        """Rows of different words, which are no more than there is room for."""
        if len(self._at) + len(words) > REMEMBERED:
            self._at = {}
        new = [w for w in words if w not in self._at]
        for word, at in zip(new, self.words.find(new), strict=True):
            if at < 0:
                at = len(self.words) + len(self._at)
                self._table[at] = self.of_grams(word)
            self._at[word] = at
        return [self._at[w] for w in words]

    def of_word(self, word: str) -> np.ndarray:
        if not hasattr(self, "_at"):
            self._prepare()
        return self._table[self._rows([word])[0]]

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its probability between 0 and 1); `und` and 0 without a letter or without a model."""
        counts = Counter(_LETTERS.findall(text.lower())) if text else Counter()
        if not self.languages or not counts:
            return UND, 0.0
        if not hasattr(self, "_at"):
            self._prepare()
        scores, words = self.prior.copy(), list(counts)
        n = np.fromiter(counts.values(), float, len(counts))
        for at in range(0, len(words), REMEMBERED // 2):
            part = slice(at, at + REMEMBERED // 2)
            scores += TEMPER * (n[part] @ self._table[self._rows(words[part])])
        best = int(scores.argmax())
        return self.languages[best], float(1.0 / np.exp(np.maximum(scores - scores[best], -700.0)).sum())


def words_of(text: Column) -> Column:
    """Runs of letters in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def fit(labelled: DataFrame, learn_from: int = LEARN_FROM) -> LanguageModel:
    """Learns from (doc_id, text, lang). Counts are made by Spark; what reaches the driver is the model: every word and
    n-gram that the documents learned from have often enough, in whichever language."""
    docs = labelled.where("lang is not null and text is not null")
    n = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = {lang: min(1.0, learn_from / of) for lang, of in n.items()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 30))
    part = [F.when(F.col("lang") == lang, draw < int((1 << 30) * x)) for lang, x in share.items() if x < 1]
    chosen = docs.where(F.coalesce(*part, F.lit(True))) if part else docs
    counts = written(chosen.select("lang", F.explode(words_of(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n")), "lang-words")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()}
    languages = sorted(totals)
    if not languages:
        return LanguageModel([], np.empty(0), [], np.empty((0, 0)), [], np.empty((0, 0)))
    marked = F.concat(F.lit("<"), "word", F.lit(">"))
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(LONGEST)), lambda k: F.when(
        F.length(marked) >= k, F.transform(F.sequence(F.lit(1), F.length(marked) - k + 1), lambda i: F.substring(marked, i, k))
    ).otherwise(F.array().cast("array<string>"))))
    gram_counts = counts.select("lang", "n", F.explode(pieces).alias("word")).groupBy("lang", "word").agg(F.sum("n").alias("n"))

    def known_of(frame: DataFrame) -> tuple[pa.Array, np.ndarray]:
        """The keys that are seen often enough and their counts by language."""
        by = [F.sum(F.when(F.col("lang") == x, F.col("n")).otherwise(0)).alias(f"n{i}") for i, x in enumerate(languages)]
        keys = frame.groupBy("word").agg(F.sum("n").alias("n"), *by).where(F.col("n") >= LEAST_SEEN)
        top = keys.toArrow()
        return top.column("word").combine_chunks(), np.stack([top.column(f"n{i}").to_numpy() for i in range(len(languages))], axis=1).astype(float)

    def logs(seen: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Smoothed log frequencies within each group of keys."""
        out = np.zeros(seen.shape)
        for g in np.unique(group):
            part = seen[group == g]
            out[group == g] = np.log((part + PRIOR) / (part.sum(0) + PRIOR * (len(part) + 1)))
        return out

    known, seen = known_of(counts)
    pieces_known, pieces_seen = known_of(gram_counts)
    words = np.array([totals[x] / share[x] for x in languages])  # of all documents, also those not learned from
    prior = np.log(words / words.sum())
    grams = pieces_known.to_pylist()
    return LanguageModel(languages, prior, Words(known), logs(seen, np.zeros(len(known))), grams, logs(pieces_seen, np.array([len(g) for g in grams])))


def identify(docs: DataFrame, model: LanguageModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row of `docs`, from its text alone.

    A null text, or one without letters, is `und` with score 0; so is all of it if there was nothing to learn from.
    Repeated rows give repeated rows, an empty table gives an empty one, further columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = held.value.predict
        for batch in batches:
            found = [predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "lang_pred": pa.array([x[0] for x in found], pa.string()), "score": pa.array([x[1] for x in found], pa.float64())})

    narrow = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out() -> Column:
    return remainder("doc_id", 4) == 2


def fold_predictions(docs: DataFrame) -> DataFrame:
    """Learns from the documents outside the held-out fold and predicts all."""
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """Rows of `docs` whose language can be told, with all their columns: texts without letters go, and those for which
    no language reaches `least_score`."""
    model = fit(docs.select("doc_id", "text", "lang"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def told(texts: pa.Array) -> pa.Array:
        found = (held.value.predict(x.as_py()) for x in texts)
        return pa.array([lang != UND and score >= least_score for lang, score in found], pa.bool_())

    return docs.where(told("text"))
