"""Documents cut and packed into training sequences of several lengths.

Every task tokenizes its documents and fills windows as the documents come, without a
shuffle: a document is routed to the shortest tier (a power of two) that holds it, long ones
to the longest, and a tier's window takes documents until it is exactly full, the last of
them cut there. What a task has left in unfinished windows at its end, less than a full window of
each tier, fills the gaps of the longest window first. The last gap of a task goes on to a
second level, where the remainders of many tasks are packed in the same way; a sequence that
is still not full there is cut to powers of two, so that only its last few tokens are padded.

Sequences of equal length make training steps: they are numbered across all tasks, from the
counts of the tasks before, and every ``step_tokens`` tokens of them are a group. So all groups of
a length are equally large but for its last one.
"""

from __future__ import annotations

import re
import string
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as Spec
from pyspark.sql import functions as F

from .cut import cut
from .recent import Recent
from .words import slices

TIERS = (2048, 1024, 512, 256, 128, 64)
END_ID = 1
STEP_TOKENS = 1 << 19
TASKS_PER_GROUP = 64
CACHED_WORDS = 300_000  # of a generation
KEPT_CHARS = 64  # longer parts are encoded each time
ENCODED_BYTES = 4 << 20  # of texts whose parts are looked up together

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint, padded bigint, turn bigint")
FIELDS = [part.split()[0] for part in PIECES.split(", ")]
LEFT = f"{PIECES}, rest binary, task bigint"


@dataclass
class Window:
    """An open window of a tier: pieces (doc_id, start, ids, doc_tokens) and its free places."""

    size: int
    pieces: list = field(default_factory=list)
    free: int = 0

    def __post_init__(self) -> None:
        self.free = self.size

    def add(self, doc_id, start: int, ids: np.ndarray, total: int) -> None:
        self.pieces.append((doc_id, start, ids, total))
        self.free -= len(ids)


class Packer:
    """The windows of one task; memory is one open window per tier."""

    def __init__(self, task: int, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.open = {size: Window(size) for size in tiers}
        self.task, self.made, self.per_length = task, 0, Counter()
        self.rows: list[tuple] = []

    def document(self, doc_id, ids: np.ndarray) -> None:
        """Route a document to the shortest tier that holds it; it is cut only where a window is full."""
        at, total = 0, len(ids)
        size = next((s for s in reversed(self.tiers) if s >= total), self.tiers[0])
        while at < total:
            window = self.open[size]
            take = min(total - at, window.free)
            window.add(doc_id, at, ids[at:at + take], total)
            at += take
            if not window.free:
                self.close(window, size)
                self.open[size] = Window(size)

    def close(self, window: Window, padded: int) -> None:
        """Number a sequence and write its pieces."""
        number = (self.task << 32) + self.made
        self.made += 1
        turn = self.per_length[padded]
        self.per_length[padded] += 1
        offset = 0
        for doc_id, start, ids, total in window.pieces:
            code = crc32(ids.astype("<u4").tobytes())
            self.rows.append((doc_id, start, len(ids), code, total, number, offset, padded, turn))
            offset += len(ids)

    def fill_gaps(self) -> list[tuple]:
        """Pour what is left of all tiers, longest first, into windows of the longest; return the last, unfinished one."""
        left = [piece for size in self.tiers for piece in self.open[size].pieces]
        window, size = Window(self.tiers[0]), self.tiers[0]
        for doc_id, start, ids, total in left:
            at = 0
            while at < len(ids):
                take = min(len(ids) - at, window.free)
                window.add(doc_id, start + at, ids[at:at + take], total)
                at += take
                if not window.free:
                    self.close(window, size)
                    window = Window(size)
        self.open = {s: Window(s) for s in self.tiers}
        return window.pieces

    def finish(self, pieces: list[tuple]) -> None:
        """Cut an unfinished sequence to the tiers' lengths; the last few tokens are padded to the longest."""
        rest = sum(len(p[2]) for p in pieces)
        queue = list(pieces)
        while rest:
            size = next((s for s in self.tiers if s <= rest), 0)
            power = rest & (rest - 1) == 0
            window = Window(size or rest)
            while window.free:
                doc_id, start, ids, total = queue.pop(0)
                take = min(len(ids), window.free)
                window.add(doc_id, start, ids[:take], total)
                if take < len(ids):
                    queue.insert(0, (doc_id, start + take, ids[take:], total))
            self.close(window, size or (rest if power else self.tiers[0]))
            rest -= window.size

    def take(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


class Encoder:
    """Token ids of texts by a public tokenizer, a white-space separated part at a time.

    The tokenizer drops white space and no token spans it, so the ids of a text are those of
    its parts. The distinct parts of many texts are found in their Arrow column and looked up
    once; the ids of the texts are gathered from theirs without an object per word. Parts of
    letters, with or without marks behind, go to the tokenizer in lower case and many at
    once: letters are one unit to it, whose last token is known by its ending, which gives the
    parts' ids apart again. Where that does not come out even, and for all other parts, each
    is encoded alone. Ids seen before are kept.
    """

    MARKS = "".join(c for c in string.punctuation if c != "'")  # that may begin an ending as in "it's"
    LETTERED = rf"\A\p{{L}}+[{re.escape(MARKS)}]*\z"
    PLACED = "[Σİ]"  # the lower case depends on the place, or ends in a combining mark, which would join a mark behind

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.units, self.others = Recent(cached), Recent(cached)

    def _encode_units(self, units: list[str]) -> Iterator[bytes]:
        for at in range(0, len(units), 4096):
            some = units[at:at + 4096]
            encoded, = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(encoded.ids, dtype="<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                yield from (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
            else:
                yield from self._encode_each(some)

    def _encode_each(self, parts: list[str]) -> Iterator[bytes]:
        for encoded in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False):
            yield np.array(encoded.ids, dtype="<u4").tobytes()

    @staticmethod
    def _looked_up(known: Recent, parts: list[str], encode: Callable[[list[str]], Iterator[bytes]]) -> list[bytes]:
        """Ids of distinct parts; those that are not known are encoded and remembered."""
        found = list(map(known.new.get, parts))
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = known.get(parts[i])
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, encode([parts[i] for i in missing]), strict=True):
            found[i] = ids
            if len(parts[i]) <= KEPT_CHARS:
                known.put(parts[i], ids)
        return found

    def _learned(self, parts: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids, and for each distinct part the places among them of its own ids and of those of the marks behind."""
        lettered = pc.and_not(pc.match_substring_regex(parts, self.LETTERED), pc.match_substring_regex(parts, self.PLACED))
        which = lettered.to_numpy(zero_copy_only=False)
        own, others = parts.filter(lettered), parts.filter(pc.invert(lettered)).to_pylist()
        units = pc.utf8_lower(pc.ascii_rtrim(own, self.MARKS)).dictionary_encode()
        marks = pc.replace_substring_regex(own, r"\A\p{L}+", "").dictionary_encode()
        ids = [b"", *self._looked_up(self.units, units.dictionary.to_pylist(), self._encode_units)]
        places = np.zeros((len(parts), 2), dtype=np.int64)
        places[which, 0] = 1 + units.indices.to_numpy()
        places[which, 1] = len(ids) + marks.indices.to_numpy()
        ids += self._looked_up(self.others, marks.dictionary.to_pylist(), self._encode_each)
        places[~which, 0] = len(ids) + np.arange(len(others))
        return ids + self._looked_up(self.others, others, self._encode_each), places

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, followed by the end id."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        parts = split.flatten().dictionary_encode()
        ids, places = self._learned(parts.dictionary)
        every = np.frombuffer(b"".join(ids), dtype="<u4")
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        used = places[parts.indices.to_numpy()].ravel()
        ends = np.cumsum(sizes[used])
        first = np.r_[0, ends][2 * (split.offsets.to_numpy() - split.offsets[0].as_py())]
        shift = starts[used] - (ends - sizes[used])
        flat = every[np.repeat(shift, sizes[used]) + np.arange(first[-1])]
        for at, stop in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            yield np.append(flat[at:stop], np.uint32(END_ID))


def _batch(rows: list[tuple], rest: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in FIELDS]
    out = [pa.array(list(column), pa.int64()) for column in columns]
    if rest:
        doc, start, ids, total = zip(*rest, strict=True)
        blank = [None] * len(rest)
        more = [doc, start, [len(x) for x in ids], blank, total, blank, blank, blank, blank]
        out = [pa.concat_arrays([a, pa.array(list(b), pa.int64())]) for a, b in zip(out, more, strict=True)]
    tail = pa.array([None] * len(rows) + [p[2].astype("<u4").tobytes() for p in rest], pa.binary())
    return pa.RecordBatch.from_arrays([*out, tail], [*FIELDS, "rest"])


def _packed(path: str, tiers: tuple[int, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder, packer = Encoder(path), Packer(task, tiers)

        def out(rest):
            made = _batch(packer.take(), rest)
            return pa.RecordBatch.from_arrays(
                [*made.columns, pa.array([task] * made.num_rows, pa.int64())], [*FIELDS, "rest", "task"])

        for batch in batches:
            for part in slices(batch, "text", ENCODED_BYTES):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text")), strict=True):
                    packer.document(doc_id, ids)
                yield out([])
        rest = packer.fill_gaps()
        yield out(rest)
    return run


def _repacked(tiers: tuple[int, ...]):
    """Pack the remainders of a group of tasks, which come sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packer = None, None
        pending: list[tuple] = []

        def finish():
            packer.open[tiers[0]].pieces.extend(pending)
            packer.finish(packer.fill_gaps())
            return _batch(packer.take(), [])

        for batch in batches:
            for row in batch.to_pylist():
                if row["task_group"] != group:
                    if packer is not None:
                        yield finish()
                    group, pending = row["task_group"], []
                    # Numbers that no task of the first level has.
                    packer = Packer(-1 - group, tiers)
                pending.append((row["doc_id"], row["start"], np.frombuffer(row["rest"], dtype="<u4"), row["doc_tokens"]))
        if packer is not None:
            yield finish()

    def columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.select(FIELDS)
    return columns


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    tasks_per_group: int = TASKS_PER_GROUP,
) -> DataFrame:
    """One row per piece of a document, as placed in its sequence.

    ``padded`` is the sequence's length with padding, ``step_group`` the training step it
    belongs to, as ``length-number`` (sequences of one length, ``step_tokens`` in all). A null or empty text is one
    end id; rows that repeat a doc_id are packed as documents of their own, and a null
    doc_id stays null. Only ``doc_id`` and ``text`` are read. The result depends on how the
    input is split into tasks, which a reread of the same files does not change.
    """
    first = cut(docs.select("doc_id", "text").mapInArrow(_packed(tokenizer_path, tiers), LEFT))
    left = first.where("rest IS NOT NULL").select(
        "doc_id", "start", "doc_tokens", "rest", "task", F.floor(F.col("task") / tasks_per_group).alias("task_group"))
    again = cut(left.repartition("task_group").sortWithinPartitions("task_group", "task", "doc_id", "start")
                .mapInArrow(_repacked(tiers), PIECES))
    made = first.where("rest IS NULL").select(*FIELDS).unionByName(again)
    return with_step_groups(made, step_tokens)


def with_step_groups(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """``step_group`` in place of ``turn``: the length of the sequence and its group of that length."""
    task = F.shiftright("sequence_id", 32)  # as numbers are given out
    # A row for each task and length.
    sizes = pieces.groupBy(task.alias("_task"), F.col("padded").alias("_padded")).agg((F.max("turn") + 1).alias("n"))
    before = Spec.partitionBy("_padded").orderBy("_task").rowsBetween(Spec.unboundedPreceding, -1)
    starts = sizes.select("_task", "_padded", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    placed = pieces.withColumn("_own", task).join(
        starts, (F.col("_own") == F.col("_task")) & (F.col("padded") == F.col("_padded")))
    group = F.floor((F.col("_start") + F.col("turn")) * F.col("padded") / step_tokens).cast("string")
    return placed.select(
        *[c for c in FIELDS if c != "turn"], F.concat_ws("-", F.col("padded").cast("string"), group).alias("step_group"))
