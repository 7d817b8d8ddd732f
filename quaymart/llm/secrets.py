"""Secrets in texts, told apart by who else has them.

Base spans come from three patterns. The method adds spans of any long mixed token and
judges every candidate by where it is found: candidates are hashed and counted over the
corpus by distinct repositories and owners. One that many owners share is a widely copied
example; one of few owners that is in more repositories than owners is a key that is reused;
any other is live-looking.

Everything is DataFrame code. Positions come from splitting a text at the matches, which
gives the gaps between them: the lengths of gaps and matches, summed in order, are the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cut import cut

# Kind, pattern, group whose length counts, least length, in listing order. A run
# of a class that must have 24 or 16 characters is written so, which finds the same runs.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Spans the method adds: long tokens with letters of both cases and digits.
MIXED = ("mixed", r"[A-Za-z0-9+/_-]{20,}", 0, 20)
KINDS = (*BASE, MIXED)
WIDELY_COPIED = 3  # distinct owners from which a candidate is a copied example


def _matches(text: Column, order: int) -> Column:
    """All leftmost matches of a kind, with the length of the gap before each; NULL without any."""
    kind, pattern, group, least = KINDS[order]
    # Splitting and matching go through the text in the same way, so gap i stands before match i.
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    rows = F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), value.alias("value"))
    listed = F.transform(rows, lambda m, at: F.struct(
        F.lit(order).alias("kind"), at.alias("at"), F.char_length(m["gap"]).alias("gap"),
        F.char_length(m["found"]).alias("size"), m["value"].alias("value"),
        (F.char_length(m["value"]) >= least).alias("long")))
    return F.when(text.rlike(pattern), listed)  # most texts have none


def candidates(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, hash, owner, repository) of every candidate in every whole text.

    ``kind`` is the place in ``KINDS``, offsets are in code points, ``hash`` stands for the
    value, which is not passed on.
    """
    empty = F.array().cast("array<struct<kind:int,at:int,gap:int,size:int,value:string,long:boolean>>")
    every = F.concat(*[F.coalesce(_matches(F.col("text"), order), empty) for order in range(len(KINDS))])
    found = docs.where("text IS NOT NULL").select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(owner, F.lit("")).alias("owner"),
        F.coalesce(repository, F.lit("")).alias("repository"), F.inline(every)
    ).withColumn("row", F.monotonically_increasing_id() - F.col("at"))
    # The offsets of a text are sums over its own matches, in order.
    before = Window.partitionBy("doc_id", "text_hash", "owner", "repository", "row", "kind").orderBy("at").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    end = F.sum((F.col("gap") + F.col("size")).cast("bigint")).over(before)
    value = F.col("value")
    varied = value.rlike("[a-z]") & value.rlike("[A-Z]") & value.rlike("[0-9]")
    return found.withColumn("end", end).where("long").where(varied | (F.col("kind") < len(BASE))).select(
        "doc_id", "text_hash", "kind", (F.col("end") - F.col("size")).alias("start"), "end",
        F.sha2("value", 256).alias("hash"), "owner", "repository")


def ownership(found: DataFrame, widely: int = WIDELY_COPIED) -> DataFrame:
    """(hash, owners, repositories, judged) over the corpus; copies in one repository count once."""
    places = found.select("hash", "owner", "repository").distinct()  # combined before the shuffle
    return places.groupBy("hash").agg(
        F.count_distinct("owner").alias("owners"), F.count_distinct("repository").alias("repositories")
    ).withColumn("judged", F.when(F.col("owners") >= widely, "example").when(
        F.col("repositories") > F.col("owners"), "reused").otherwise("live"))


def find_secrets(
    docs: DataFrame, *, owner: Column | None = None, repository: Column | None = None, widely: int = WIDELY_COPIED
) -> DataFrame:
    """(doc_id, base, added) of every row: lists of (start, kind, end, owners, repositories, judged).

    ``base`` has the base spans, whatever their ownership; ``added`` the mixed tokens that
    are no copied example and overlap no base span. Both are in order of start and kind. A
    null text is empty, null owners and repositories are one each, repeated rows are listed
    each with the same spans. ``owner`` is ``source`` unless given, the repository a
    source and language.
    """
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", F.col("source"), F.col("lang")) if repository is None else repository
    found = cut(candidates(docs, owner, repository))
    judged = found.join(ownership(found, widely), "hash")
    span = F.struct("start", "kind", "end", "owners", "repositories", "judged")
    lists = judged.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < len(BASE))
    added = F.filter("all", lambda s: (s["kind"] >= len(BASE)) & (s["judged"] != "example") & ~F.exists(
        base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    lists = lists.select("doc_id", "text_hash", base.alias("base"), added.alias("added"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("_hash")).withColumnRenamed("doc_id", "_id")
    none = F.array().cast(lists.schema["base"].dataType)
    return rows.join(lists, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash")), "left").select(
        F.col("_id").alias("doc_id"), F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added"))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*[F.lit(kind) for kind, *_ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
