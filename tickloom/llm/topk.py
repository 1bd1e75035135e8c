"""Exact top-k inner products over norm-sorted blocks, with SVD-rotated partial sums and Cauchy-Schwarz pruning.

Candidates lie in blocks by descending length, queries in blocks of their own; both are dealt to the cells of a grid, queries
to all cells of a row and candidates to all of a column, and a join on the cell brings every block of queries to every block of
candidates, where numpy does the products. A rotation to the singular vectors puts most of a product into its first
components, and |q_rest| |x_rest| bounds what the others can add. Whatever could still reach a query's k-th best score is
scored exactly, on integers.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tickloom.llm.common import fewest_parts, written

SCALE, EVERY, K = 64, 20, 20
#: Vectors of a block of candidates and of queries; about how many vectors the rotation is fitted on; part of the components
#: in a partial sum; full blocks of queries whose best a task remembers.
CANDIDATES, QUERIES, FITTED, HEAD, REMEMBERED = 2048, 512, 4096, 0.25, 64
#: Rounding errors that a bound allows for, as a part of the product of lengths.
SLACK = 1e-9


def _narrowest(low: int, high: int) -> str:
    """The integer type of fewest bytes that holds both."""
    return next(t for t in ("int8", "int16", "int32", "int64") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def _blocks(vectors: DataFrame, size: int, kind: str, purpose: str) -> DataFrame:
    """Packs the rows of each partition, in their order, into blocks (block, n, length, rows, ids, values of type `kind`)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []

        def block(part: list[tuple]) -> pa.RecordBatch:
            values = np.array([x[2] for x in part], np.int64)
            longest = float(np.sqrt((values.astype(float) ** 2).sum(1).max()))
            out = {"n": len(part), "length": longest, "rows": np.array([x[0] for x in part], np.int64).tobytes(), "ids": np.array([x[1] for x in part], np.int64).tobytes(), "xs": values.astype(kind).tobytes()}
            return pa.RecordBatch.from_pylist([out], schema=pa.schema([("n", pa.int64()), ("length", pa.float64()), ("rows", pa.binary()), ("ids", pa.binary()), ("xs", pa.binary())]))

        for batch in batches:
            kept += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            while len(kept) >= size:
                yield block(kept[:size])
                kept = kept[size:]
        if kept:
            yield block(kept)

    packed = vectors.select("row", "id", "xs").mapInArrow(pack, "n long, length double, rows binary, ids binary, xs binary")
    return written(packed.withColumn("block", F.monotonically_increasing_id()), purpose)


def _unpack(kind: str, n: int, rows: bytes, ids: bytes, xs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(rows, np.int64), np.frombuffer(ids, np.int64), np.frombuffer(xs, kind).astype(np.int64).reshape(n, -1)


def _rotation(ints: DataFrame, n: int, d: int) -> np.ndarray:
    """Singular vectors, as columns, of about FITTED of the n rows; one task sums their products, the driver gets d x d numbers."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, d).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"total": [total.tobytes()]}, schema=pa.schema([("total", pa.binary())]))

    chosen = ints.where(F.pmod(F.xxhash64("id", "row"), F.lit(n)) < FITTED).select("xs")
    total = chosen.repartition(1).mapInArrow(products, "total binary").first().total
    return np.linalg.eigh(np.frombuffer(total).reshape(d, d))[1][:, ::-1]


def _exact(q: np.ndarray, x: np.ndarray, qi: np.ndarray, xi: np.ndarray) -> np.ndarray:
    """Integer products of the given pairs."""
    out = np.empty(len(qi), np.int64)
    for at in range(0, len(qi), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[s] = np.einsum("ij,ij->i", q[qi[s]], x[xi[s]])
    return out


def _reaching(q: np.ndarray, x: np.ndarray, rotation: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, candidate) whose bound reaches the query's least score."""
    ql, xl = (np.sqrt((v.astype(float) ** 2).sum(1)) for v in (q, x))
    open_q = np.nonzero(ql * xl.max() * (1 + SLACK) >= least)[0]
    if not len(open_q):
        return open_q, open_q
    head = max(1, int(len(rotation) * HEAD))
    qr, xr = q[open_q] @ rotation, x @ rotation
    rest = lambda v: np.sqrt((v[:, head:] ** 2).sum(1))
    bound = qr[:, :head] @ xr[:, :head].T
    bound += np.outer(rest(qr), rest(xr))
    bound += SLACK * np.outer(ql[open_q], xl)
    at, xi = np.nonzero(bound >= least[open_q, None])
    if len(at) > bound.size // 8:  # most of the block is open: the rest of the components in one product
        bound = qr @ xr.T + SLACK * np.outer(ql[open_q], xl)
        at, xi = np.nonzero(bound >= least[open_q, None])
    return open_q[at], xi


def _best(found: np.ndarray, k: int) -> np.ndarray:
    """Rows (query, score, id, row) of the k best of each query, in order: higher scores, then smaller ids, then rows."""
    found = found[np.lexsort((found[:, 3], found[:, 2], -found[:, 1], found[:, 0]))]
    first = np.searchsorted(found[:, 0], found[:, 0])
    return found[np.arange(len(found)) - first < k]


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of highest integer inner product for each query.

    Components become floor(scale * x). Queries are rows whose id is divisible by `every`, candidates all rows but the
    query's own; ties go to the smaller id. Rows whose id or vector is null, whose vector is empty or holds a null or
    non-finite component take no part; shorter vectors count as padded with zeros; repeated rows are each candidates, and
    queries, of their own; an empty table gives an empty result, further columns are ignored. Scores must fit in 64 bits.
    """
    spark = vectors.sparkSession
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    ints = ints.where("id is not null and v is not null and size(v) > 0").where(usable)
    ints = written(ints.select(F.monotonically_increasing_id().alias("row"), "id", F.transform("v", lambda x: F.floor(x * float(scale)).cast("long")).alias("xs")), "vectors")
    schema = "query_id long, rank int, vec_id long, score long"
    size = ints.agg(
        F.count("*").alias("n"), F.max(F.size("xs")).alias("d"), F.min(F.size("xs")).alias("least"), F.count_if(F.col("id") % every == 0).alias("asked"),
        F.min(F.array_min("xs")).alias("low"), F.max(F.array_max("xs")).alias("high"),
    ).first()
    if not size.n:
        return spark.createDataFrame([], schema)
    if size.least < size.d:
        ints = ints.withColumn("xs", F.concat("xs", F.array_repeat(F.lit(0).cast("long"), F.lit(size.d) - F.size("xs"))))
    squared = F.aggregate("xs", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    ints = ints.withColumn("squared", squared)

    rotation, kind, parts = _rotation(ints, size.n, size.d), _narrowest(min(size.low, 0), max(size.high, 0)), fewest_parts(ints)
    candidates = _blocks(ints.repartitionByRange(parts, F.desc("squared"), "row").sortWithinPartitions(F.desc("squared"), "row"), CANDIDATES, kind, "candidates")
    queries = _blocks(ints.where(F.col("id") % every == 0).repartition(parts, "row"), QUERIES, kind, "queries")
    # Only numbers are sorted: of whole rows, every task would send one to the driver.
    longest = candidates.select("block", "length").orderBy(F.desc("length"), "block").first()
    seed = _unpack(kind, *candidates.where(F.col("block") == longest.block).select("n", "rows", "ids", "xs").collect()[0])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, tuple] = OrderedDict()

        def least_of(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
            """The k-th best score of each query among the longest candidates: no lower one can be in the result."""
            if len(seed[0]) <= k:
                return np.full(len(q), -np.inf)
            scores = q.astype(float) @ seed[2].T.astype(float)
            scores[rows[:, None] == seed[0]] = -np.inf
            found = np.partition(scores, -k, axis=1)[:, -k]
            return found - SLACK * (np.abs(found) + 1)

        def result(rows: np.ndarray, ids: np.ndarray, bar: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"query_row": rows[found[:, 0]], "query_id": ids[found[:, 0]], "vec_row": found[:, 3], "vec_id": found[:, 2], "score": found[:, 1]})

        for batch in batches:
            for r in batch.to_pylist():
                q_rows, q_ids, q = _unpack(kind, r["q_n"], r["q_rows"], r["q_ids"], r["q_xs"])
                rows, ids, x = _unpack(kind, r["n"], r["rows"], r["ids"], r["xs"])
                if r["q_block"] not in held:
                    while held and sum(len(entry[0]) for entry in held.values()) + len(q) > REMEMBERED * QUERIES:
                        yield result(*held.popitem(last=False)[1])
                    held[r["q_block"]] = q_rows, q_ids, least_of(q, q_rows), np.empty((0, 4), np.int64)
                held.move_to_end(r["q_block"])
                *_, bar, found = held[r["q_block"]]
                qi, xi = _reaching(q, x, rotation, bar)
                other = q_rows[qi] != rows[xi]
                qi, xi = qi[other], xi[other]
                if len(qi):
                    found = _best(np.concatenate([found, np.stack([qi, _exact(q, x, qi, xi), ids[xi], rows[xi]], 1)]), k)
                    n = np.bincount(found[:, 0], minlength=len(q))
                    full, last = n >= k, np.cumsum(n) - 1
                    bar[full] = np.maximum(bar[full], found[last[full], 1])
                    held[r["q_block"]] = q_rows, q_ids, bar, found
        for entry in held.values():
            yield result(*entry)

    # Queries are copied to `across` cells, candidates to `down`; with about `parts` cells this ratio moves the fewest rows.
    down = max(1, round((parts * size.asked / size.n) ** 0.5))
    across = max(1, min(parts // down, candidates.count()))
    cell = lambda row, column: (F.lit(across) * row + column).alias("cell")
    dealt = lambda count: F.pmod(F.xxhash64("block"), F.lit(count)).cast("int")
    every_of = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asked = queries.withColumn("row", dealt(down)).withColumn("column", every_of(across))
    asked = asked.select(*(F.col(c).alias(f"q_{c}") for c in ("block", "n", "rows", "ids", "xs")), cell(F.col("row"), F.col("column")))
    met = candidates.withColumn("column", dealt(across)).withColumn("row", every_of(down)).select("n", "rows", "ids", "xs", cell(F.col("row"), F.col("column")))
    # The size of a stored table says nothing of its copies: without the hint Spark broadcasts them, through the driver.
    met = asked.hint("merge").join(met, "cell").select("q_block", "q_n", "q_rows", "q_ids", "q_xs", "n", "rows", "ids", "xs")
    found = met.mapInArrow(scored, "query_row long, query_id long, vec_row long, vec_id long, score long")
    order = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id", "vec_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
