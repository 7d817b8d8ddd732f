"""Toxic spans and document scores by a linear-chain conditional random field.

The labels are of documents, the field tags words. Token labels come from the documents: a
greedy cover picks the word forms and word beginnings that tell toxic documents from clean
ones, each by the toxic documents it is the first to explain, so copies of one document vote
once; in toxic documents the words with a picked form are toxic, in clean ones none is. The
field is trained on the lines of a bounded sample of documents. Scoring takes the whole
text: forward and backward sums of every line give each word's marginal, and the largest
marginal and the sum of the marginals of a document give its score, calibrated on documents
the field was not trained on.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import slices

#: The sample the model is fitted on: so many labelled documents of each label at most, none longer than this.
TRAIN_DOCS = 1500
TRAIN_CHARS = 20_000
FEATURE_BITS = 18
LEAST_DOCS, LEAST_SHARE = 4, 0.01  # toxic documents that a form must be the first to explain
LEAST_PRECISION, PURE = 0.6, 0.97  # of a form's words, the share that is in toxic documents
COVERS = 6
EPOCHS = 4
CELLS = 1 << 17
CACHED_WORDS = 300_000
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1

_WORD = re.compile(r"\w+")


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def forms(word: str) -> list[str]:
    """The word and its beginnings."""
    word = word.lower()
    return [f"={word}", *[f"^{word[:size]}" for size in range(3, min(7, len(word) + 1))], f"${word[-3:]}"]


def _slots(word: str) -> list[int]:
    return [crc32(form.encode()) & ((1 << FEATURE_BITS) - 1) for form in forms(word)]


@dataclass
class Model:
    """Weights of the field (label 1 against 0) and of the document score."""

    weights: np.ndarray
    bias: float
    transitions: np.ndarray  # logarithms, [from, to]
    score: np.ndarray  # of the largest logit, of the logarithm of the sum, constant
    constant: float | None = None  # the score of every text where the labels show one class only

    def emission(self, word: str) -> float:
        return float(self.weights[_slots(word)].sum() + self.bias)


def _pass(values: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log of state 1 against 0 after a step, from that before it."""
    up = np.logaddexp(t[0, 1], values + t[1, 1])
    return up - np.logaddexp(t[0, 0], values + t[1, 0])


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log odds of every place of padded rows; their sum is the marginal's log odds."""
    rows, width = emissions.shape
    ahead, back = np.zeros((width, rows)), np.zeros((width, rows))
    e = np.ascontiguousarray(emissions.T)
    ahead[0] = e[0]
    for i in range(1, width):
        ahead[i] = e[i] + _pass(ahead[i - 1], t)
    turned = np.ascontiguousarray(t.T)
    for i in range(width - 2, -1, -1):
        back[i] = np.where(i + 1 < lengths, _pass(e[i + 1] + back[i + 1], turned), 0.0)
    return ahead.T, back.T


def _blocks(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of rows of similar length, of at most ``CELLS`` padded cells together; a longer row stands alone."""
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        # So many rows as the shortest would let in at most; their cells grow with every row taken.
        most = lengths[order[at:at + max(1, CELLS // int(lengths[order[at]]))]]
        fits = int(np.searchsorted(np.arange(1, len(most) + 1) * most, CELLS, side="right"))
        stop = at + max(1, fits)
        yield order[at:stop]
        at = stop


def _padded(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a flat array as a padded matrix, and which cells are real."""
    width = int(lengths.max())
    real = np.arange(width)[None, :] < lengths[:, None]
    place = np.minimum(starts[:, None] + np.arange(width)[None, :], len(flat) - 1)
    return np.where(real, flat[place], 0.0), real


def line_logits(emissions: np.ndarray, starts: np.ndarray, lengths: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Log odds of the marginal of every word; lines are rows of the flat emissions."""
    out = np.full(len(emissions), -30.0)
    for rows in _blocks(lengths):
        matrix, real = _padded(emissions, starts[rows], lengths[rows])
        ahead, back = forward_backward(matrix, lengths[rows], t)
        place = starts[rows][:, None] + np.arange(matrix.shape[1])[None, :]
        out[place[real]] = (ahead + back)[real]
    return np.clip(out, -30, 30)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _lines(texts) -> Iterator[tuple[int, list[str]]]:
    for number, text in enumerate(texts):
        for line in (text or "").split("\n"):
            words = _WORD.findall(line)
            if words:
                yield number, words


def copy_mark(text: str) -> int:
    """The smallest hash of the five-word runs of a text, which near copies mostly share."""
    words = _WORD.findall(text or "")
    return min((crc32(" ".join(words[i:i + 5]).encode()) for i in range(max(1, len(words) - 4))))


def pick_forms(texts: list[str], toxic: np.ndarray) -> set[str]:
    """Greedy covers of the toxic documents by forms that clean documents hardly have.

    The first cover takes what explains most; later ones, among the forms left, only what is
    nearly pure, so that a toxic word counts even where another one stands beside it.
    """
    names: dict[str, int] = {}
    per_doc, times = [], []
    for text in texts:
        own = Counter(form for word in _WORD.findall(text or "") for form in forms(word))
        per_doc.append(np.fromiter((names.setdefault(f, len(names)) for f in own), dtype=np.int64, count=len(own)))
        times.append(np.fromiter(own.values(), dtype=np.int64, count=len(own)))
    if not names:
        return set()
    words = np.zeros((2, len(names)))  # of a form, in clean and toxic documents
    gain = np.zeros(len(names))
    for own, count, label in zip(per_doc, times, toxic, strict=True):
        words[int(label)][own] += count
        if label:
            gain[own] += 1
    least = max(LEAST_DOCS, LEAST_SHARE * toxic.sum())
    share = words[1] / np.maximum(words.sum(axis=0), 1)
    candidates = (share >= LEAST_PRECISION) & (gain >= least)
    toxic_docs = np.flatnonzero(toxic).tolist()
    having: dict[int, list[int]] = {}
    for i in toxic_docs:
        for form in per_doc[i][candidates[per_doc[i]]].tolist():
            having.setdefault(form, []).append(i)
    label_of = list(names)
    picked = set()
    for number in range(COVERS):
        left = set(toxic_docs)
        pure = share >= (LEAST_PRECISION if number == 0 else PURE)
        # Of forms that explain as many documents the purer one, then the first seen.
        score = np.where(candidates & pure, gain + share, 0)
        while len(score):
            best = int(np.argmax(score))
            if score[best] < least:
                break
            picked.add(label_of[best])
            candidates[best] = False
            for i in set(having[best]) & left:
                left.discard(i)
                score[per_doc[i]] -= 1
            score[best] = 0
    return picked


def _train(lines: list[list[str]], tags: list[np.ndarray], epochs: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Adaptive gradient steps on the conditional likelihood of whole lines."""
    weights, bias, t = np.zeros(1 << FEATURE_BITS), np.zeros(1), np.zeros((2, 2))
    squares = [np.full_like(x, 1e-2) for x in (weights, bias, t)]
    cache: dict[str, list[int]] = {}
    for line in lines:
        for word in line:
            if word not in cache:
                cache[word] = _slots(word)
    lengths = np.array([len(x) for x in lines])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    flat_tags = np.concatenate(tags)
    words = [word for line in lines for word in line]
    counts = np.array([len(cache[word]) for word in words])
    slots = np.fromiter((s for word in words for s in cache[word]), dtype=np.int32, count=int(counts.sum()))
    slot_starts = np.r_[0, np.cumsum(counts)]
    order = np.random.default_rng(7).permutation(len(lines))
    for _ in range(epochs):
        for chunk in np.array_split(order, max(1, len(order) // 512)):
            rows = chunk[np.argsort(lengths[chunk], kind="stable")]
            for part in np.array_split(rows, 4):
                if not len(part):
                    continue
                places = np.concatenate([np.arange(starts[i], starts[i] + lengths[i]) for i in part])
                size = counts[places]
                own = np.concatenate([slots[slot_starts[p]:slot_starts[p + 1]] for p in places])
                owner = np.repeat(np.arange(len(places)), size)
                emission = np.bincount(owner, weights[own], len(places)) + bias[0]
                length = lengths[part]
                begin = np.r_[0, np.cumsum(length)[:-1]]
                matrix, real = _padded(emission, begin, length)
                ahead, back = forward_backward(matrix, length, t)
                marginal = _sigmoid(ahead + back)
                tag = np.zeros_like(matrix)
                tag[real] = flat_tags[places]
                error = (tag - marginal) * real
                flat = np.zeros(len(places))
                flat[:] = error[real]
                steps = [np.bincount(own, flat[owner], 1 << FEATURE_BITS), np.array([flat.sum()]), np.zeros((2, 2))]
                both = real[:, 1:]
                if both.any():
                    right = matrix[:, 1:] + back[:, 1:]
                    parts = np.stack([np.zeros_like(right) + t[0, 0], right + t[0, 1], ahead[:, :-1] + t[1, 0],
                                      ahead[:, :-1] + right + t[1, 1]])
                    parts = np.exp(parts - parts.max(axis=0))
                    parts /= parts.sum(axis=0)
                    state = (2 * tag[:, :-1] + tag[:, 1:])[both]
                    seen = np.bincount(state.astype(int), minlength=4)
                    steps[2] = (seen - (parts * both).sum(axis=(1, 2))).reshape(2, 2)
                for value, square, step in zip((weights, bias, t), squares, steps, strict=True):
                    step = step - 1e-4 * value
                    square += step * step
                    value += 0.2 * step / np.sqrt(square)
    return weights, float(bias[0]), t


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a ridge, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(np.clip(x @ w, -30, 30))
        gradient = x.T @ (weight * (y - p)) - 1e-1 * w
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-1 * np.eye(len(w))
        w += np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return w


def document_signs(logits: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """Per document: the largest log odds, and the logarithm of the sum of the marginals that stand out."""
    top = np.full(count, -30.0)
    np.maximum.at(top, owner, logits)
    marginal = _sigmoid(logits)
    total = np.bincount(owner, np.where(marginal > 0.05, marginal, 0), count)
    return np.c_[top / 10, np.log(total + 1e-2)]


def _logits_of(texts, emission, t) -> tuple[np.ndarray, np.ndarray]:
    """(log odds of every word, its text)."""
    owners, lengths, values = [], [], []
    for number, words in _lines(texts):
        owners.append(number)
        lengths.append(len(words))
        values.extend(map(emission, words))
    lengths = np.array(lengths, dtype=np.int64)
    starts = np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64)
    return line_logits(np.array(values), starts, lengths, t), np.repeat(np.array(owners, dtype=np.int64), lengths)


def fit(
    docs: DataFrame, labels: DataFrame, *, train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS,
    epochs: int = EPOCHS,
) -> Model:
    """A model from the labelled rows outside the held-out fold.

    The sample holds at most ``train_docs`` documents of each label, those with the smallest
    hash of the id among texts of at most ``train_chars`` characters; it is drawn per label,
    and the shares of the labels among all rows weigh it. Null ids, labels and texts are
    left out. Without rows of both labels every score is the share of label 1.
    """
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold(F.col("doc_id")) != HELD_OUT)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").where(F.char_length("text") <= train_chars)
    ids = texts.select("doc_id").distinct()
    known = known.join(ids, "doc_id", "left_semi")
    shares = {int(r[0]): r[1] for r in known.groupBy("toxic").count().collect()}
    if not (shares.get(0) and shares.get(1)):
        return Model(np.zeros(0), 0.0, np.zeros((2, 2)), np.zeros(3), float(shares.get(1, 0) > 0))
    drawn = [known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
             for label in (0, 1)]
    # At most 2 × train_docs ids, so the broadcast is bounded.
    chosen = F.broadcast(drawn[0].union(drawn[1]).withColumn("fold", fold(F.col("doc_id"))))
    rows = texts.select("doc_id", "text").join(chosen, "doc_id").orderBy("doc_id").collect()
    sample = {}
    for row in rows:  # near copies would vote more than once
        sample.setdefault((copy_mark(row["text"]), row["toxic"]), (row["text"], row["toxic"], row["fold"]))
    text, toxic, folds = (list(x) for x in zip(*sample.values(), strict=True))
    toxic, train = np.array(toxic), np.array(folds) != CALIBRATION
    if len(set(toxic[train])) < 2 or len(set(toxic[~train])) < 2:
        train[:] = True
    known_texts = [x for x, use in zip(text, train, strict=True) if use]
    picked = pick_forms(known_texts, toxic[train])
    lines, tags = [], []
    for number, words in _lines(known_texts):
        tag = np.array([toxic[train][number] == 1 and not picked.isdisjoint(forms(w)) for w in words], dtype=float)
        lines.append(words)
        tags.append(tag)
    weights, bias, t = _train(lines, tags, epochs)
    model = Model(weights, bias, t, np.zeros(3))
    rest = np.flatnonzero(~train) if not train.all() else np.arange(len(text))
    logits, owner = _logits_of([text[i] for i in rest], model.emission, t)
    signs = document_signs(logits, owner, len(rest))
    label = toxic[rest]
    weight = np.where(label == 1, shares[1] / max(1, label.sum()), shares[0] / max(1, (1 - label).sum()))
    model.score = _logistic(signs, label, weight * len(rest) / weight.sum())
    return model


class Scorer:
    """Scores of batches of texts; emissions of words seen before are kept, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def emission(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            value = self.known[word] = self.model.emission(word)
        return value

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score of each text, log odds of every word, number of words of each text)."""
        if self.model.constant is not None:
            words = np.array([len(_WORD.findall(x or "")) for x in texts], dtype=np.int64)
            return np.full(len(texts), self.model.constant), np.full(int(words.sum()), -30.0), words
        logits, owner = _logits_of(texts, self.emission, self.model.transitions)
        signs = np.c_[document_signs(logits, owner, len(texts)), np.ones(len(texts))]
        return _sigmoid(np.clip(signs @ self.model.score, -30, 30)), logits, np.bincount(owner, minlength=len(texts))


def _tagged(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                score, logits, words = scorer.score(texts)
                spans = [[] for _ in texts]
                first = np.r_[0, np.cumsum(words)]
                for row in np.unique(np.searchsorted(first, np.flatnonzero(logits >= 0), side="right") - 1).tolist():
                    spans[row] = _spans(texts[row], _sigmoid(logits[first[row]:first[row + 1]]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score), pa.array(words.astype(np.int64)), pa.array(spans, span)],
                    ["doc_id", "score", "n_words", "spans"])
    return run


def _clean(model, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                yield part.filter(pa.array(scorer.score(part.column("text").to_pylist())[0] < limit))
    return run


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    """Offsets in code points of runs of toxic words in a line, with the largest marginal."""
    found: list[dict] = []
    last = -2
    for number, match in enumerate(_WORD.finditer(text)):
        if marginals[number] < 0.5:
            continue
        value = float(marginals[number])
        if number == last + 1 and "\n" not in text[found[-1]["end"]:match.start()]:
            found[-1] |= {"end": match.end(), "marginal": max(value, found[-1]["marginal"])}
        else:
            found.append({"start": match.start(), "end": match.end(), "marginal": value})
        last = number
    return found


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, n_words, spans) of every row; a null text counts as empty.

    ``score`` is the probability that the document is toxic, ``spans`` the toxic stretches as
    offsets in code points, end exclusive. Only ``doc_id`` and ``text`` are read; the id is
    passed on and never looked at, so repeated or null ids change nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        _tagged(shared),
        "doc_id bigint, score double, n_words bigint, spans array<struct<start:bigint,end:bigint,marginal:double>>")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score is below ``limit``."""
    return docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(model), limit), docs.schema)
