"""Secret scans with corpus-wide ownership frequency.

Patterns find candidates. How many owners hold a candidate's value tells an example that everybody copies from a
credential that looks live. All of it is DataFrame work: matches come from the text's own regular expressions, their
places from the lengths of what stands between them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.llm.common import written

#: The patterns and least lengths of the kinds, in the order in which kinds sort. Runs that are too short
#: for access and hex cannot hold a longer match, so their least length is in the pattern.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ISSUED = r"(?:ghp_|gho_|ghs_|glpat-|sk-|xox[abp]-)[A-Za-z0-9_-]{16,}"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "issued": ISSUED}
BASE, LEAST_ASSIGNED = ("assign", "access", "hex"), 6
KINDS = [*BASE, "live"]

#: A value that so many owners hold is an example that went around.
EXAMPLE_OWNERS = 3


def _matches(text: Column, pattern: str) -> Column:
    """All matches, each with the length of what stands between it and the one before."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.transform(F.split(text, pattern, -1), F.length)
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, gap: F.struct(m.alias("match"), gap.alias("gap")))
    return F.when(text.rlike(pattern), pairs)


def _rows(docs: DataFrame, doc_id: str, text: str, owner: str, repository: str) -> DataFrame:
    """Every row of `docs` without its text, with its matches; stored, so that its row numbers hold."""
    body = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"), F.col(repository).cast("string").alias("repository"),
    )
    found = [_matches(F.col("text"), p).alias(k) for k, p in PATTERNS.items()]
    return written(body.select("row", "doc_id", "owner", "repository", F.xxhash64("text").alias("text_key"), *found), "matches")


def _spans(rows: DataFrame) -> DataFrame:
    """A row for every candidate: its kind, its place and, of an assignment, the place of its value."""

    def of(kind: str) -> DataFrame:
        x = rows.where(F.col(kind).isNotNull()).select("row", "doc_id", "text_key", "owner", "repository", F.posexplode(kind).alias("nth", "x"))
        upto = Window.partitionBy("row").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
        x = x.withColumn("end", F.sum(F.col("x.gap") + F.length("x.match")).over(upto))
        value = F.regexp_extract("x.match", ASSIGN, 2) if kind == "assign" else F.col("x.match")
        return x.select("row", "doc_id", "text_key", "owner", "repository", F.lit(kind).alias("kind"), (F.col("end") - F.length("x.match")).alias("start"), "end", value.alias("value"))

    every = reduce(DataFrame.unionByName, map(of, PATTERNS))
    return every.where((F.col("kind") != "assign") | (F.length("value") >= LEAST_ASSIGNED))


def ownership(spans: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """(hash, n_repositories, n_owners, is_live) of every value found anywhere in the corpus."""
    held = spans.select(F.sha2("value", 256).alias("hash"), "owner", "repository")
    per_owner = held.distinct().groupBy("hash", "owner").agg(F.count("repository").alias("n"))
    counts = per_owner.groupBy("hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))
    return counts.withColumn("is_live", F.col("n_owners") < example_owners)


def _judged(docs: DataFrame, doc_id: str, text: str, owner: str, repository: str, example_owners: int) -> tuple[DataFrame, DataFrame]:
    rows = _rows(docs, doc_id, text, owner, repository)
    spans = written(_spans(rows), "spans")
    owned = written(ownership(spans, example_owners), "owned")
    return rows, spans.withColumn("hash", F.sha2("value", 256)).join(owned, "hash")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row for every row of `docs`: its counts, its base spans' digest, all spans, and how many are live or examples.

    Base spans are matches of the first three patterns, leftmost and without overlap within a kind. The method adds a span
    `live` around each value, of a base or an issued-token pattern, that fewer than `example_owners` owners hold in the
    whole corpus; equal places count once. A null text is empty, a null owner is one owner, repeated rows are each
    scanned, an empty table gives an empty one, further columns are ignored. A value that a third of all rows hold is
    summed up by owner before it is shuffled, and its rows join in a way that Spark can split.
    """
    rows, judged = _judged(docs, doc_id, text, owner, repository, example_owners)
    rank = F.array_position(F.lit(KINDS), F.col("kind"))
    base = judged.where(F.col("kind") != "issued").select("row", "kind", "start", "end", F.lit(None).cast("boolean").alias("is_live"))
    value = judged.select("row", F.lit("live").alias("kind"), (F.col("end") - F.length("value")).alias("start"), "end", "is_live").distinct()
    each = base.unionByName(value)
    shown = F.when(F.col("kind") != "live", True).otherwise(F.col("is_live"))
    entry = F.struct("start", rank.alias("rank"), F.concat_ws(":", "kind", "start", "end").alias("shown"))
    per_row = each.groupBy("row").agg(
        *(F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}") for k in BASE),
        F.sort_array(F.collect_list(F.when(F.col("kind") != "live", entry))).alias("base"),
        F.sort_array(F.collect_list(F.when(shown, entry))).alias("every"),
        F.count(F.when(F.col("is_live"), 1)).alias("n_live"), F.count(F.when(~F.col("is_live"), 1)).alias("n_examples"),
    )
    line = lambda c: F.coalesce(F.array_join(F.transform(c, lambda x: x.shown), ","), F.lit(""))
    out = rows.select("row", "doc_id").join(per_row, "row", "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", *(count(f"n_{k}") for k in BASE), F.sha2(line("base"), 256).alias("base_sha256"), line("every").alias("spans"), count("n_live"), count("n_examples"))


def redact_live(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", example_owners: int = EXAMPLE_OWNERS, by: str = "[REDACTED]") -> DataFrame:
    """`docs` with each live-looking value replaced where it was found; all rows and columns stay.

    The same letters elsewhere in the text are left alone. Values that overlap are replaced as one. Documents without a
    candidate pass straight through, so that only the few others are joined. Null and empty texts and examples that went
    around stay as they are; repeated rows are each redacted; an empty table gives an empty one.
    """
    _, judged = _judged(docs, doc_id, text, owner, repository, example_owners)
    place = F.struct((F.col("end") - F.length("value")).alias("start"), F.col("end").alias("stop"))
    places = judged.where("is_live").groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set(place)).alias("__secret_places"))
    places = places.select(F.col("doc_id").alias("__secret_id"), F.col("text_key").alias("__secret_key"), "__secret_places")
    suspect = reduce(Column.__or__, (F.coalesce(text, F.lit("")).rlike(p) for p in PATTERNS.values()))
    same = F.col(doc_id).eqNullSafe(F.col("__secret_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("__secret_key"))
    whole = F.col(text)
    part = lambda a, b: F.substring(whole, a + 1, b - a)
    start = F.struct(F.lit("").alias("said"), F.lit(0).cast("long").alias("upto"))

    def add(done: Column, p: Column) -> Column:
        said = F.when(p.start < done.upto, done.said).otherwise(F.concat(done.said, part(done.upto, p.start), F.lit(by)))
        return F.struct(said.alias("said"), F.greatest(done.upto, p.stop).cast("long").alias("upto"))

    cleaned = F.aggregate("__secret_places", start, add, lambda done: F.concat(done.said, part(done.upto, F.length(whole))))
    cleaned = F.when(F.col("__secret_places").isNull(), whole).otherwise(cleaned)
    redacted = docs.where(suspect).join(places, same, "left").withColumn(text, cleaned).select(*docs.columns)
    return docs.where(~suspect).unionByName(redacted)
