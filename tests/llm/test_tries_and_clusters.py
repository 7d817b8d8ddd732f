"""Prefix BPE, the conversation trie and integer clustering against plain Python."""

import hashlib
import math
import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quaymart.llm import centroids, conversation_trie, prefix_bpe, queries

# --- byte-level BPE --------------------------------------------------------------------------------

VOCABULARY = queries.tokenizer_path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=prefix_bpe.read_ranks(VOCABULARY), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.encoder_of(VOCABULARY, PATTERN)


def flat(encoder, text):
    return [token for some in encoder.encoded(text) for token in some]


def random_text(draw, count):
    pieces = ["the ", "quay", "'s", " \n", "  ", "naïve", "東京都", "…!?", "12345", "aaaa", "'ll", "Ωμέγα", "😀", "\t", " x", "ing"]
    return "".join(draw.choice(pieces) for _ in range(count))


def test_ids_are_those_of_merging(encoder, library):
    draw = random.Random(4)
    tokens = list(encoder.vocabulary.ranks)
    for _ in range(3000):
        part = b"".join(draw.choice(tokens) for _ in range(draw.randint(1, 5)))
        if draw.random() < 0.4:
            part = bytes(draw.choice(b"abAB \n\xc3\xa9\xe4") for _ in range(draw.randint(1, 14)))
        assert list(prefix_bpe.Prefixes(encoder.vocabulary, part).ids()) == library._encode_single_piece(part)
    for _ in range(200):
        text = random_text(draw, draw.randint(0, 60))
        assert flat(encoder, text) == library.encode_ordinary(text)


def test_appends_and_cuts_keep_the_table_exact(encoder, library):
    draw, prefixes, data = random.Random(5), prefix_bpe.Prefixes(encoder.vocabulary), b""
    for _ in range(300):
        more = random_text(draw, 1).encode()[:draw.randint(0, 9)]
        prefixes.append(more)
        data += more
        if draw.random() < 0.1:
            data = data[:draw.randint(0, len(data))]
            prefixes.truncate(len(data))
        assert list(prefixes.ids()) == (library._encode_single_piece(data) if data else [])


def test_edits_encode_a_few_parts_again(encoder, library):
    draw = random.Random(6)
    document = prefix_bpe.Document(encoder, random_text(draw, 2000))
    again = []
    for _ in range(400):
        start = draw.randint(0, len(document.text))
        end = min(len(document.text), start + draw.choice([0, 0, 1, 3, 30]))
        again.append(document.replace(start, end, random_text(draw, draw.choice([0, 1, 4]))))
        assert document.ids == library.encode_ordinary(document.text)
    assert max(again) < 60
    document.append(" and more")
    assert document.ids == library.encode_ordinary(document.text)


def test_parts_are_forgotten_and_long_ones_walked(monkeypatch, library):
    monkeypatch.setattr(prefix_bpe, "KEPT_PARTS", 5)
    monkeypatch.setattr(prefix_bpe, "KEPT_PAIRS", 7)
    monkeypatch.setattr(prefix_bpe, "WALK", 16)
    small = prefix_bpe.Encoder(prefix_bpe.read_ranks(VOCABULARY), PATTERN)
    text = random_text(random.Random(7), 400) + "abcdefgh" * 20_000
    assert flat(small, text) == library.encode_ordinary(text)
    assert len(small.parts.new) <= 5 and len(small.parts.old) <= 5 and len(small.vocabulary.pairs.new) <= 7


def test_vocabularies_that_do_not_merge_in_order_are_refused():
    ranks = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError):
        prefix_bpe.Vocabulary(ranks | {b"abc": 300, b"ab": 301})
    with pytest.raises(ValueError):
        prefix_bpe.Vocabulary({b"a": 0})
    alone = prefix_bpe.Vocabulary(ranks | {b"xyz": 300})  # merging never makes it, but a part may be it
    assert list(prefix_bpe.Prefixes(alone, b"xyz").ids()) == [300]
    assert list(prefix_bpe.Prefixes(alone, b"xyzx").ids()) == [120, 121, 122, 120]


def test_documents_and_round_trip(spark, library):
    draw = random.Random(8)
    rows = [(i, random_text(draw, 40), "mine") for i in range(40)]
    rows += [(50, None, "x"), (51, "", "x"), (None, "no id", None), rows[0], (52, "a" * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = sorted(map(tuple, prefix_bpe.digests(docs, VOCABULARY, PATTERN).collect()), key=str)
    want = []
    for doc, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(want, key=str)
    encoded = prefix_bpe.encode(docs, VOCABULARY, PATTERN)
    texts = {(r["doc_id"], bytes(r["data"]).decode()) for r in prefix_bpe.decode(encoded, VOCABULARY, PATTERN).collect()}
    assert texts == {(doc, text or "") for doc, text, _ in rows}
    assert prefix_bpe.digests(docs.limit(0), VOCABULARY, PATTERN).count() == 0


# --- conversations -----------------------------------------------------------------------------------


def plain_trie(rows):
    own, nodes = defaultdict(list), {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort()
    for conv in sorted(own):
        h = crc32(str(conv).encode()) % 9
        rebuilt = tuple(t[2:] for t in own.get(conv - conv % 5, [])[:h] + own[conv][h:])
        for depth in range(len(rebuilt) + 1):
            node = nodes.setdefault(rebuilt[:depth], {"members": [], "ends": [], "children": set()})
            node["members"].append(conv)
            if depth:
                nodes[rebuilt[:depth - 1]]["children"].add(rebuilt[:depth])
        nodes[rebuilt]["ends"].append(conv)
    for key in sorted(nodes, key=len, reverse=True):
        node = nodes[key]
        size = len(key[-1][1].encode()) if key else 0
        node["saved"] = (len(node["members"]) - 1) * size + sum(nodes[c]["saved"] for c in node["children"])
        node["leaves"] = sum(nodes[c]["leaves"] for c in node["children"]) or 1
    return sorted(
        (min(n["members"]), len(key), min(nodes[key[:-1]]["members"]) if key else None, len(n["members"]),
         len(n["children"]), n["leaves"], n["saved"],
         hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest())
        for key, n in nodes.items())


def conversation_rows(draw, conversations, turns):
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randint(1, turns)):
            rows.append((conv, draw.choice([turn, turn, turn, None]), draw.choice(["user", "assistant", None]),
                         draw.choice(["hi", "", None, "é…", f"only {conv}"])))
    return rows


DDL = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("conversations,turns", [(120, 14), (1, 1), (3, 40)])
def test_trie_is_that_of_plain_python(spark, conversations, turns):
    rows = conversation_rows(random.Random(conversations), conversations, turns)
    rows += [rows[0], rows[0], (None, 1, "user", "nobody"), (conversations + 20, 5, "user", "no family")]
    found = conversation_trie.prefix_trie(spark.createDataFrame(rows, DDL))
    assert sorted(map(tuple, found.collect())) == plain_trie(rows)


def test_trie_with_hot_groups_small_ranges_and_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "IDS_PER_PIECE", 3)
    monkeypatch.setattr(conversation_trie, "NODES_PER_TASK", 20)
    draw = random.Random(3)
    rows = [(7, turn, "user", f"long {turn}") for turn in range(300)]  # one long conversation
    rows += [(conv, 0, "user", "same") for conv in range(100, 300)]  # one node with many ends
    rows += [(conv, turn, "user", f"own {conv}" if turn == 8 else "same") for conv in range(300, 420) for turn in range(12)]
    rows += conversation_rows(draw, 6, 9)
    frame = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], DDL + ", depth int, part string, x1 int")
    assert sorted(map(tuple, conversation_trie.prefix_trie(frame).collect())) == plain_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    empty = spark.createDataFrame([], DDL)
    assert conversation_trie.prefix_trie(empty).collect() == []
    conv = next(c for c in range(1, 100) if c % 5 and crc32(str(c).encode()) % 9 > 2)
    rows = [(conv, 0, "user", "a"), (conv, 1, "user", "b")]  # its family has no first conversation
    found = sorted(map(tuple, conversation_trie.prefix_trie(spark.createDataFrame(rows, DDL)).collect()))
    assert found == plain_trie(rows) and [r[1] for r in found] == [0]


# --- clustering ----------------------------------------------------------------------------------------


def plain_clusters(rows, rounds=3, clusters=16, width=64):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centers = [v for _, v in order[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centers]
            found.append((distances.index(min(distances)), min(distances)))
        return found

    for _ in range(rounds):
        labels = assign()
        for j in range(len(centers)):
            members = [v for (label, _), (_, v) in zip(labels, kept, strict=True) if label == j]
            if members:
                centers[j] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    labels = assign()
    inertia = defaultdict(int)
    for label, distance in labels:
        inertia[label] += distance
    return sorted(((i, label, distance, inertia[label], sum(inertia.values()),
                    hashlib.sha256(",".join(map(str, centers[label])).encode()).hexdigest())
                   for (label, distance), (i, _) in zip(labels, kept, strict=True)), key=str)


def vectors(count, seed, spread=0.1):
    draw = np.random.default_rng(seed)
    middles = draw.normal(size=(12, 64))
    return [(i, (middles[i % 12] + spread * draw.normal(size=64)).astype(np.float32).tolist()) for i in range(count)]


def embedded(spark, rows, more=()):
    return spark.createDataFrame([(i, v, *more) for i, v in rows], "vec_id bigint, embedding array<float>" + (
        ", ints string, cluster string, lead int" if more else ""))


def test_clusters_are_those_of_plain_python(spark):
    rows = vectors(300, 1)
    bad = list(rows[3][1])
    rows += [(900, None), (901, []), (902, bad[:63]), (903, [*bad, 1.0]), (904, [math.nan, *bad[1:]]),
             (905, [math.inf, *bad[1:]]), (906, [None, *bad[1:]]), (907, [0.0] * 64), (None, bad), rows[5], rows[5], (908, bad)]
    found = centroids.cluster(embedded(spark, rows, ("a", "b", 3)))
    assert sorted(map(tuple, found.collect()), key=str) == plain_clusters(rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], vectors(5, 2), [(i, [0.5] * 64) for i in range(40)],
                                  [(i, [float(i % 3)] * 64) for i in range(50)]])
def test_clusters_of_few_equal_and_no_vectors(spark, rows):
    found = centroids.cluster(embedded(spark, rows))
    assert sorted(map(tuple, found.collect()), key=str) == plain_clusters(rows)


def test_bounds_leave_few_centroids_and_never_the_nearest_out():
    draw = np.random.default_rng(3)
    for spread, offset, share in ((0.1, 0, 0.4), (1.0, 0, 1.0), (1.0, 1 << 26, 1.0)):
        x = np.floor(64 * (draw.normal(size=(16, 64))[draw.integers(0, 16, 3000)] + spread * draw.normal(size=(3000, 64))))
        x = x.astype(np.int64) + offset
        _, axes = np.linalg.eigh(np.cov(x.T.astype(float)))
        axes = axes[:, ::-1].T[:8]
        centers = x[:16]
        number, distance, measured = centroids.nearest(x, *centroids._rotated(x, axes), centers, axes)
        every = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
        assert np.array_equal(distance, every.min(axis=1)) and np.array_equal(number, every.argmin(axis=1))
        assert measured <= share * every.size


def test_components_and_sums_beyond_a_long_are_cut_off(spark):
    rows = [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [3e38] * 64)]
    found = centroids.cluster(embedded(spark, rows)).collect()
    assert len(found) == 3 and all(r["distance"] == 0 for r in found)
