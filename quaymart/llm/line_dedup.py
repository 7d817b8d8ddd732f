"""Removal of repeated and nearly repeated lines by an exact set-similarity join.

A line is the set of its distinct lower-cased words. Sets are ordered by rarity: the words
are counted over the whole corpus in a table of fixed size, by which every word sorts after
the rarer ones. Two sets of at least ``percent`` Jaccard similarity share a word among the
first of each (prefix filter; fewer of the smaller set's words do), are of similar length,
and the place of the shared word leaves room for the overlap (length and positional
filters). Each set also has the parities of its words in 128 bits, a larger one in 256 too,
which differ in no more bits than the sets differ in words. What passes is verified on the
whole sets, read again from the texts; rows that cannot be wanted are left out before a
join by a table of hash bits of fixed size.

A line goes if an earlier line, by (doc_id, line number), has the same set or a similar one,
whether or not that line stays. So it is enough to find one earlier match. Every set is
first compared with the earliest set of each of its prefix words, which is an aggregate that
goes back by a join; only for those that are still there are then all earlier sets of their
words joined. The filters are conditions of the joins, so that hardly anything but similar
pairs comes out of them, and no word's sets are gathered. Copies of a set are one set
throughout, named by a number in the order of its first line. Sets too small to be similar
to any but their equals skip these comparisons.

Everything is DataFrame code; words and sets are compared by 64-bit hashes (55 bits of a
word's, next to its rarity).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cut import cut, release
from .thinned import thinned, told

PERCENT = 85
LEAST_WORDS = 1  # lines without words are left alone
RARITY_BUCKETS = 1 << 16  # a power of two
SLICES = 2  # of the words' hashes, joined one after the other, so that only a part of the prefix rows is on disk at once
WIDE_WORDS = 192  # sets of more words also have their parities in WIDE numbers: 128 bits say little of them
WIDE = 4
PLACE = ["doc_id", "line_no", "text_hash"]


def _parts(line: Column) -> Column:
    """The lower-cased words of a line, cut at ASCII white space, and empty ones where it is repeated."""
    spaces = "\t\n\x0b\x0c\r"
    plain = F.when(line.rlike(r"[\x09-\x0D]"), F.translate(line, spaces, " " * len(spaces))).otherwise(line)
    return F.split(F.lower(plain), " ")


def _words(line: Column) -> Column:
    """Hashes of the distinct words of a line."""
    hashes = F.array_distinct(F.transform(_parts(line), lambda word: F.xxhash64(word)))
    return F.array_remove(hashes, F.xxhash64(F.lit("")))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, line) of rows with an id; equal rows are told apart by nothing and act as one."""
    # Not the inner explode: its condition that there are lines would have every text split twice.
    lines = F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line")
    return docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"), lines).where("line IS NOT NULL")


def rarity_table(lines: DataFrame, buckets: int = RARITY_BUCKETS) -> list[int]:
    """Quarter powers of two of the number of ``words`` in each hash bucket, over all lines.

    The table has ``buckets`` numbers whatever the corpus holds, so it may go to the driver.
    A bucket counts all its words: a frequent one is never taken for a rare one.
    """
    bucket = F.col("word").bitwiseAND(F.lit(buckets - 1)).cast("int")
    counts = lines.select(F.explode("words").alias("word")).groupBy(bucket.alias("bucket")).count().toArrow()
    table = [0] * buckets
    for bucket, count in zip(counts.column("bucket").to_pylist(), counts.column("count").to_pylist(), strict=True):
        table[bucket] = min(127, int(4 * math.log2(count + 1)))
    return table


def ordered_set(words: Column, table: list[int]) -> Column:
    """The set of a line as ascending numbers: rarity first, then the word's hash."""
    rarity = F.split(F.lit(",".join(map(str, table))), ",").cast("array<tinyint>")  # folded to a constant

    def number(word: Column) -> Column:
        bucket = word.bitwiseAND(F.lit(len(table) - 1)).cast("int")
        return F.shiftleft(F.get(rarity, bucket).cast("bigint"), 55).bitwiseOR(F.shiftrightunsigned(word, 9))

    return F.sort_array(F.transform(words, number))


def prefix_length(size: Column, percent: int) -> Column:
    """Two similar sets share a word among so many first ones of each."""
    return size - F.ceil(size * percent / 100) + 1


def short_prefix_length(size: Column, percent: int) -> Column:
    """Of the smaller of two similar sets, or of either of equal ones, so many first words are enough.

    The larger one shares at least ``percent / (100 + percent)`` of the words of both with it.
    """
    return size - F.ceil(size * (2 * percent) / (100 + percent)) + 1


def parities(words: Column, taken: Callable[[Column], Column] = lambda word: F.lit(1)) -> Column:
    """A bit of 64 for each place that an odd number of words falls on, of the words for which ``taken`` is 1 and not 0."""
    def flip(bits: Column, word: Column) -> Column:
        place = word.bitwiseAND(F.lit(63)).cast("int")
        return bits.bitwiseXOR(F.call_function("shiftleft", taken(word).cast("bigint"), place))
    return F.aggregate(words, F.lit(0).cast("bigint"), flip)


def high_parities(words: Column) -> Column:
    """The parities of half of the words; XOR with those of all gives the other half's."""
    return parities(words, lambda word: F.shiftrightunsigned(word, 6).bitwiseAND(F.lit(1)))


def wide_parities(words: Column) -> Column:
    """The parities in ``WIDE`` numbers, whose XOR is that of ``parities``."""
    def own(i: int) -> Callable[[Column], Column]:
        return lambda word: F.shiftrightunsigned(word, 6).bitwiseAND(F.lit(WIDE - 1)) == i
    return F.array(*[parities(words, own(i)) for i in range(WIDE)])


def _has_others(size: Column, percent: int) -> Column:
    """Whether a set may be similar to a different one: at best that is itself and one word more."""
    return size * 100 >= (size + 1) * percent


def _may_match(a: str, b: str, percent: int, wide: bool = False) -> Column:
    """Parity, length and positional filters for rows of one word whose columns begin with ``a`` and ``b``."""
    na, nb, pa, pb = F.col(f"{a}n"), F.col(f"{b}n"), F.col(f"{a}pos"), F.col(f"{b}pos")
    room = F.least(pa, pb) + 1 + F.least(na - pa - 1, nb - pb - 1)
    high, every = (F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}")) for c in ("high", "bits"))

    def close(*bits: Column) -> Column:
        apart = functools.reduce(Column.__add__, map(F.bit_count, bits))
        return apart * (100 + percent) <= (na + nb) * (100 - percent)

    passed = (close(high, every.bitwiseXOR(high)) & (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)
              & (room * 100 >= (na + nb - room) * percent))
    if not wide:
        return passed
    many = close(*[F.get(f"{a}wide", F.lit(i)).bitwiseXOR(F.get(f"{b}wide", F.lit(i))) for i in range(WIDE)])
    return passed & F.coalesce(many, F.lit(True))


def _named(rows: DataFrame, name: str) -> DataFrame:
    """The prefix rows with ``name`` before every column but the word."""
    return rows.select("word", *[F.col(c).alias(f"{name}{c}") for c in rows.columns if c != "word"])


def _prefixes(sets: DataFrame, percent: int, part: int) -> DataFrame:
    """A row (word, pos) with the columns of the set for each prefix word of one slice of the sets that may have similar ones."""
    rows = sets.where(_has_others(F.col("n"), percent)).select(
        *[c for c in sets.columns if c != "prefix"], F.posexplode("prefix").alias("pos", "word"))
    return rows.where(F.col("word").bitwiseAND(F.lit(SLICES - 1)) == part)


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """(id, other): each set with the earliest set of each of its words, where the filters let them."""
    first = rows.groupBy("word").agg(
        F.count(F.lit(1)).alias("sets"), F.min("id").alias("b_id"),
        *[F.min_by(c, "id").alias(f"b_{c}") for c in ("n", "pos", "bits", "high")]).where("sets > 1").drop("sets")
    joined = _named(rows, "a_").join(first, "word").where((F.col("a_id") != F.col("b_id")) & _may_match("a_", "b_", percent))
    return joined.select(F.col("a_id").alias("id"), F.col("b_id").alias("other"))


def _rest(rows: DataFrame, percent: int) -> DataFrame:
    """(id, other): sets still there with all earlier sets of their words, where the filters let them.

    ``code`` is the id of a set, of one that goes its complement, which is below zero. Of two sets
    still there the whole prefix of the larger one, by (n, id), meets the short one of the smaller.
    """
    code, b_code, n, b_n = (F.col(c) for c in ("a_code", "b_code", "a_n", "b_n"))
    b_id = F.when(b_code < 0, F.bitwise_not(b_code)).otherwise(b_code)
    smaller = (b_n < n) | ((b_n == n) & (b_code < code))
    met = rows.where((F.col("code") < 0) | (F.col("pos") < short_prefix_length(F.col("n"), percent)))
    joined = _named(rows.where("code >= 0"), "a_").join(_named(met, "b_"), "word").where(
        F.when(b_code < 0, b_id < code).otherwise(smaller) & _may_match("a_", "b_", percent, wide=True))
    return joined.select(F.greatest(code, b_id).alias("id"), F.least(code, b_id).alias("other"))


def _in_slices(made: Callable[[int], DataFrame]) -> DataFrame:
    """The distinct pairs of all slices, each slice written before the next is begun."""
    parts = [cut(made(part).distinct()) for part in range(SLICES)]
    pairs = cut(functools.reduce(DataFrame.union, parts).distinct())
    release(*parts)
    return pairs


def _with_codes(classes: DataFrame, found: DataFrame) -> DataFrame:
    """(code, n, bits, high, wide, prefix) of every set; ``found`` ones have the complement of their id."""
    sets = told(classes.select("id", "n", "bits", "high", "wide", "prefix"), ["id"], found)
    going = found.select("id", F.lit(True).alias("going")).distinct()
    asked = sets.where("perhaps").join(going, "id", "left")
    every = sets.where("NOT perhaps").withColumn("going", F.lit(None).cast("boolean")).unionByName(asked)
    return cut(every.select(F.when(F.col("going"), F.bitwise_not("id")).otherwise(F.col("id")).alias("code"),
                            "n", "bits", "high", "wide", "prefix"))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(id, other) of the pairs that are similar, on sets read again from the text."""
    needed = pairs.select("id").union(pairs.select("other")).distinct()
    places = cut(thinned(classes.select("id", *PLACE), ["id"], needed).join(needed, "id", "left_semi"))
    lines = thinned(_lines(thinned(docs, ["doc_id"], places)), PLACE, places)
    sets = cut(lines.join(places, PLACE).select("id", _words(F.col("line")).alias("words")).dropDuplicates(["id"]))
    both = pairs.join(sets, "id").join(sets.select(F.col("id").alias("other"), F.col("words").alias("others")), "other")
    # 100 shared >= percent (both - shared), with the intersection taken once.
    shared = F.size(F.array_intersect("words", "others"))
    similar = cut(both.where(
        shared * (100 + percent) >= (F.size("words") + F.size("others")) * percent).select("id", "other"))
    release(places, sets)
    return similar


def repeated_lines(
    docs: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = RARITY_BUCKETS
) -> DataFrame:
    """(doc_id, text_hash, line_no, match_doc_id, match_line_no) of every line to remove.

    The match is an earlier line with an equal set, else one with a similar set. Lines of
    fewer than ``least_words`` distinct words (blank ones too) are left alone. Null texts have
    no lines, rows without doc_id take no part, and rows with equal id and text are one.
    """
    docs = docs.select("doc_id", "text")
    taken = cut(_lines(docs).select(*PLACE, _words(F.col("line")).alias("words")))
    # Asked of the table: before it is written, the condition would have every line's words taken twice.
    parsed = taken.where(F.size("words") >= least_words)
    table = rarity_table(parsed, buckets)
    size = F.size("words")
    lines = cut(parsed.withColumn("words", ordered_set(F.col("words"), table)).select(
        *PLACE, F.xxhash64("words").alias("sig"), size.alias("n"), parities(F.col("words")).alias("bits"),
        high_parities(F.col("words")).alias("high"), F.when(size > WIDE_WORDS, wide_parities(F.col("words"))).alias("wide"),
        F.slice("words", F.lit(1), prefix_length(size, percent).cast("int")).alias("prefix")))
    release(taken)
    first = lines.groupBy("sig").agg(
        F.min(F.struct(*PLACE, "n", "bits", "high", "wide", "prefix")).alias("first"),
        F.count(F.lit(1)).alias("lines")).select("sig", "first.*", "lines")
    # Numbers in the order of first lines, as ranges are numbered one after the other.
    classes = cut(first.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE).withColumn(
        "id", F.monotonically_increasing_id()))
    narrow = cut(lines.select(*PLACE, "sig"))
    release(lines)
    narrower = classes.select("id", "n", "bits", "high", "prefix")
    short = F.slice("prefix", F.lit(1), short_prefix_length(F.col("n"), percent).cast("int"))
    stars = _in_slices(lambda part: _stars(_prefixes(narrower.withColumn("prefix", short), percent, part), percent))
    found = _verified(stars, classes, docs, percent)
    release(stars)
    sets = _with_codes(classes, found)
    rest = _in_slices(lambda part: _rest(_prefixes(sets, percent, part), percent))
    release(sets)
    found = found.union(_verified(rest, classes, docs, percent))
    release(rest)
    matched = cut(found.groupBy("id").agg(F.min("other").alias("other")))
    where = thinned(classes.select("id", *PLACE), ["id"], matched.select(F.col("other").alias("id"))).select(
        F.col("id").alias("other"), F.struct(*PLACE).alias("match"))
    # Sets of one line that has no match are of no use any more.
    asked = told(classes.select("sig", "id", F.struct(*PLACE).alias("first"), "lines"), ["id"], matched).where(
        "perhaps OR lines > 1")
    decided = cut(asked.join(matched.join(where, "other").select("id", "match"), "id", "left").where(
        "match IS NOT NULL OR lines > 1").select("sig", "first", "match"))
    place = F.struct(*PLACE)
    removed = thinned(narrow, ["sig"], decided).join(decided, "sig").where(
        F.col("match").isNotNull() | (place != F.col("first")))
    # The first line of a set has no equal one before it.
    match = F.when(place == F.col("first"), F.col("match")).otherwise(F.col("first"))
    return removed.select(
        "doc_id", "text_hash", "line_no", match["doc_id"].alias("match_doc_id"),
        match["line_no"].alias("match_line_no")).distinct()


def _marked(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """Rows of ``docs`` as ``d`` with the list of their removed lines as ``l.removed``, null if none."""
    lists = removed.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list("line_no")).alias("removed"))  # at most the lines of one text
    same = (F.col("d.doc_id") == F.col("l.doc_id")) & (F.xxhash64("d.text") == F.col("l.text_hash"))
    return docs.alias("d").join(lists.alias("l"), same, "left")


def _left_text() -> Column:
    """The text without the removed lines; one that loses none is passed on as it is."""
    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "l.removed")
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    # Bound by a lambda of its own: named inside the inner one, the text would be split again for every line.
    bound = F.transform(F.array(F.split("d.text", "\n")), rest)
    return F.when(F.col("l.removed").isNull(), F.col("d.text")).otherwise(F.get(bound, F.lit(0)))


def without_repeated_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with the removed lines gone from ``text``, ``n_chars`` with it.

    A document of which no word is left is dropped; one that had none stays.
    """
    text = _left_text()
    new = {"text": text, "n_chars": F.when(F.col("l.removed").isNull(), F.col("d.n_chars")).otherwise(
        F.char_length(text).cast("bigint"))} if "n_chars" in docs.columns else {"text": text}
    emptied = F.col("l.removed").isNotNull() & ~text.rlike(r"[^\x20\x09-\x0D]")
    return _marked(docs, removed).where(~emptied).select(
        *[new[c].alias(c) if c in new else F.col(f"d.`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """(doc_id, n_lines, removed, text) of every row: its removed lines in order, and the text left."""
    return _marked(docs.select("doc_id", "text"), removed).select(
        "d.doc_id", F.coalesce(F.size(F.split("d.text", "\n")), F.lit(0)).alias("n_lines"),
        F.coalesce("l.removed", F.array().cast("array<int>")).alias("removed"), _left_text().alias("text"))
