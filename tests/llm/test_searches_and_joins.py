"""Similarity joins, decontamination and vector search against plain Python."""

import re
from itertools import combinations

import numpy as np
import pytest

from quaymart.llm import decontaminate, hilbert_search, line_dedup, shingle_join
from quaymart.llm.components import connected_components
from quaymart.llm.shingle_join import possible, verify
from quaymart.llm.thinned import thinned

SPACE = r"[^\x20\x09-\x0D]+"


def words(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(SPACE, text or "")]


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def prose(seed, count):
    draw = np.random.default_rng(seed)
    return [f"w{i}" for i in draw.integers(0, 4000, count)]


def edited(base, seed, changes):
    draw, text = np.random.default_rng(seed), list(base)
    for at in draw.choice(len(text), changes, replace=False):
        text[at] = f"x{seed}_{at}"
    return text


@pytest.fixture(scope="module")
def near_copies():
    """Groups of copies of many sizes, chains, tiny texts, a shared passage, nulls and repeats."""
    rows, number = [], 0

    def add(text):
        nonlocal number
        number += 1
        rows.append((number, text))

    for group in range(12):
        size = [4, 6, 7, 9, 12, 20, 40, 60, 90, 150, 300, 700][group]
        base = prose(group, size)
        add(" ".join(base))
        for copy in range(8):
            changes = [0, 1, 1, 2, 3, 5, 8, 12][copy] * size // 150 + (copy > 4)
            add(" ".join(edited(base, 100 * group + copy, min(changes, size))))
    chain = prose(77, 200)
    for step in range(6):  # neighbours are linked, the ends are not
        add(" ".join(chain[step * 15:step * 15 + 120]))
    passage = prose(55, 40)
    for i in range(30):
        add(" ".join(passage + prose(500 + i, 10 + i)))
    for text in ("", None, "   ", "one", "One", "one two", "ONE two\t", "a b c d", "a b c d e", "A b c d e f"):
        add(text)
    rows += rows[3:6] + [(None, rows[0][1]), (None, "nobody has this text at all")]
    return rows


def expected_groups(rows):
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
            parent[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(
        ((doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))),
        key=str)


def test_jaccard_groups_are_those_of_all_links(spark, near_copies):
    docs = spark.createDataFrame([(*r, "a", 1) for r in near_copies], "doc_id bigint, text string, node string, n int")
    found = shingle_join.jaccard_groups(docs).collect()
    assert sorted(map(tuple, found), key=str) == expected_groups(near_copies)


def test_jaccard_groups_of_nothing(spark):
    assert shingle_join.jaccard_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_linked_sets_share_a_key_whatever_their_sizes():
    draw = np.random.default_rng(3)
    ends = shingle_join.bands(4096)
    linked = 0
    for _ in range(1500):
        size = int(draw.integers(1, 120))
        a = np.unique(draw.integers(0, 2**63, size, dtype=np.uint64))
        keep = draw.random(len(a)) > draw.uniform(0, 0.25)
        more = draw.integers(0, 2**63, int(draw.integers(0, 1 + size // 3)), dtype=np.uint64)
        b = np.unique(np.r_[a[keep], more])
        shared = len(np.intersect1d(a, b))
        total = len(a) + len(b) - shared
        if shared and 100 * shared >= 75 * total and shared < total:
            linked += 1
            assert np.intersect1d(shingle_join.sketch_keys(a, ends), shingle_join.sketch_keys(b, ends)).size
            apart = shingle_join._bits_apart([shingle_join.bit_sketch(a).tobytes()], [shingle_join.bit_sketch(b).tobytes()])
            assert apart[0] <= total - shared
    assert linked > 200


def test_sets_that_meet_in_many_keys_are_joined_a_few_times(spark, monkeypatch):
    draw, made = np.random.default_rng(12), []
    held = [(key, int(node)) for key in range(400) for node in np.flatnonzero(draw.random(12) < 0.5)]
    lone = [(1000 + node, x) for node in range(11) for x in (node, 100 + node)]  # met in one key only
    shared = spark.createDataFrame(held + lone, "key bigint, node bigint")
    nodes = sorted({node for _, node in held + lone})
    sketches = spark.createDataFrame(
        [(node, 10_000, [0] * 8, bytes(128), *[0] * shingle_join.FOLDED) for node in nodes], shingle_join.SKETCH)
    links = spark.createDataFrame([], "a bigint, b bigint")
    plain = shingle_join._meetings
    monkeypatch.setattr(shingle_join, "_meetings", lambda *x: made.append(plain(*x).count()) or plain(*x))
    expected = set(combinations(range(12), 2)) | {(node, 100 + node) for node in range(11)}
    meetings = sum(len(x) * (len(x) - 1) // 2 for x in ([n for k, n in held if k == key] for key in range(400)))
    for most in (64, 2):  # partners beyond the bound meet again
        monkeypatch.setattr(shingle_join, "MOST_KNOWN", most)
        found = shingle_join._rest(shared, links, sketches, 75).collect()
        assert sorted((r["a"], r["b"]) for r in found) == sorted(expected)
    assert meetings > 5000 and sum(made[:2]) < meetings / 8 and len(made) == 4


def test_near_copies_linked_in_a_few_keys_do_not_meet_again(spark, monkeypatch):
    draw, made = np.random.default_rng(13), []
    held = [(key, int(node)) for key in range(300) for node in np.flatnonzero(draw.random(30) < 0.5)]
    shared = spark.createDataFrame([*held, (1000, 5), (1000, 200), (1001, 300), (1001, 301)], "key bigint, node bigint")
    sketches = spark.createDataFrame(
        [(node, 10_000, [0] * 8, bytes(128), *[0] * shingle_join.FOLDED) for node in (*range(30), 200, 300, 301)],
        shingle_join.SKETCH)
    links = spark.createDataFrame([(1, 2), (200, 1000)], "a bigint, b bigint")
    plain = shingle_join._meetings
    monkeypatch.setattr(shingle_join, "_meetings", lambda *x: made.append(plain(*x).count()) or plain(*x))
    monkeypatch.setattr(shingle_join, "MOST_KNOWN", 1)
    ties = shingle_join._rest(shared, links, sketches, 75, lambda pairs: pairs.where("b < 300"))
    groups = {r["node"]: r["component"] for r in connected_components(ties).collect()}
    assert groups == dict.fromkeys([*range(30), 200, 1000], 0)
    assert made[0] > 300 and made[1] <= 2


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7)]
    found = dict(map(tuple, connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert found == {i: 0 for i in range(41)} | {i: 1000 for i in range(1000, 1100)}


def expected_removed(rows, percent, least):
    lines = sorted({(doc, number, line) for doc, text in rows if doc is not None and text is not None
                    for number, line in enumerate(text.split("\n"))})
    sets = [frozenset(re.findall(SPACE, line.lower())) for _, _, line in lines]
    gone = set()
    for b in range(len(lines)):
        for a in range(b):
            if len(sets[a]) >= least and len(sets[b]) >= least:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    gone.add(lines[b][:2])
                    break
    return gone


def test_lines_go_if_an_earlier_one_is_similar(spark):
    draw, rows = np.random.default_rng(9), []
    pool = [prose(900 + i, int(draw.integers(1, 40))) for i in range(25)]
    for doc in range(60):
        lines = []
        for _ in range(int(draw.integers(1, 9))):
            base = pool[int(draw.integers(0, len(pool)))] if draw.random() < 0.6 else prose(int(draw.integers(1e6)), 15)
            lines.append(" ".join(edited(base, int(draw.integers(1e6)), min(len(base), int(draw.integers(0, 4))))))
        rows.append((doc, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "\n\n"), (None, rows[0][1]), rows[5]]
    docs = spark.createDataFrame([(*r, "s", 5) for r in rows], "doc_id bigint, text string, removed string, n_chars bigint")
    removed = line_dedup.repeated_lines(docs)
    gone = {(r["doc_id"], r["line_no"]) for r in removed.collect()}
    assert gone == expected_removed(rows, line_dedup.PERCENT, line_dedup.LEAST_WORDS) and len(gone) > 30
    report = {r["doc_id"]: r for r in line_dedup.line_report(docs, removed).collect()}
    assert report[70]["n_lines"] == 0 and report[70]["text"] is None and report[71]["n_lines"] == 1
    left = {}
    for row in line_dedup.without_repeated_lines(docs, removed).collect():
        assert row["removed"] == "s"
        left.setdefault(row["doc_id"], row)
    for doc, text in rows:
        if doc is None or text is None:
            continue
        kept = "\n".join(line for i, line in enumerate(text.split("\n")) if (doc, i) not in gone)
        assert report[doc]["text"] == kept
        if re.search(r"\S", kept) or not re.search(r"\S", text):
            assert left[doc]["text"] == kept
            assert left[doc]["n_chars"] == (len(kept) if kept != text else 5)
        else:
            assert doc not in left
    assert left[70]["text"] is None and left[None]["text"] == rows[0][1]


def test_lines_with_one_word_in_thirteen_replaced_are_repeats(spark):
    assert line_dedup.PERCENT == 85
    rows = []
    for size in (12, 13, 18, 19):  # one word replaced: 11/13, 12/14, 17/19 and 18/20 of the words are shared
        line = [f"w{size}_{i}" for i in range(size)]
        rows += [(10 * size, " ".join(line)), (10 * size + 1, " ".join([*line[:4], "other", *line[5:]]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"] for r in line_dedup.repeated_lines(docs).collect()} == {131, 181, 191}


def test_short_lines_are_removed_if_an_equal_one_is_before_them(spark):
    short = "All rights reserved.\n\nfin\nla la la la la la"
    rows = [(1, short), (2, f"own words here\n{short}"), (3, "reserved. all RIGHTS\n \nfinal\n\u5168\u6587\n\u5168\u6587")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    gone = {(r["doc_id"], r["line_no"]) for r in line_dedup.repeated_lines(docs).collect()}
    assert gone == {(2, 1), (2, 3), (2, 4), (3, 0), (3, 4)}


def test_a_text_of_many_lines_is_put_together_in_one_pass(spark):
    lines = [f"own{i} word" if i % 2 else "said before" for i in range(30_000)]
    docs = spark.createDataFrame([(1, "said before"), (2, "\n".join(lines))], "doc_id bigint, text string")
    again = [(2, f"{i}") for i in range(0, 30_000, 2)]
    removed = spark.createDataFrame(again, "doc_id bigint, line_no string").selectExpr("doc_id", "int(line_no) AS line_no")
    removed = removed.join(docs.selectExpr("doc_id", "xxhash64(text) AS text_hash"), "doc_id")
    report = {r["doc_id"]: r for r in line_dedup.line_report(docs, removed).collect()}
    assert report[2]["text"] == "\n".join(lines[1::2]) and len(report[2]["removed"]) == 15_000
    assert report[1]["text"] == "said before" and report[1]["removed"] == []


def test_long_lines_that_share_rare_words_only_are_no_pairs(spark, monkeypatch):
    pairs, plain = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda made, *rest: pairs.append(made.count()) or plain(made, *rest))
    rare = " ".join(f"rare{i}" for i in range(40))
    own = [" ".join(f"w{n}" for n in np.random.default_rng(i).choice(3000, 240, replace=False)) for i in range(40)]
    rows = [(i, f"{rare} {own[i]}") for i in range(40)]
    rows.append((40, " ".join(w if at % 40 else f"new{at}" for at, w in enumerate(rows[7][1].split()))))
    docs = spark.createDataFrame([*rows, *[(100 + i, text) for i, text in enumerate(own * 2)]], "doc_id bigint, text string")
    removed = {(r["doc_id"], r["match_doc_id"]) for r in line_dedup.repeated_lines(docs).collect() if r["doc_id"] < 100}
    assert removed == {(40, 7)} and sum(pairs) < 100


def test_lines_of_a_group_that_are_not_similar_are_hardly_ever_pairs(spark, monkeypatch):
    pairs, plain = [], line_dedup._verified
    monkeypatch.setattr(line_dedup, "_verified", lambda made, *rest: pairs.append(made.count()) or plain(made, *rest))
    rows = []
    for i in range(150):  # four of 60 words replaced: two lines share 52 of 68
        own = set(np.random.default_rng(i).choice(60, 4, replace=False).tolist())
        rows.append((i, " ".join(f"own{i}_{at}" if at in own else f"w{at}" for at in range(60))))
    rows.append((200, " ".join(w if at else "new" for at, w in enumerate(rows[60][1].split()))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    removed = {r["doc_id"] for r in line_dedup.repeated_lines(docs).collect()}
    assert removed == {doc for doc, _ in expected_removed(rows, line_dedup.PERCENT, line_dedup.LEAST_WORDS)} and 200 in removed
    assert sum(pairs) < 300


def test_rows_that_are_wanted_stay_and_hardly_any_others(spark):
    rows = spark.range(20_000).selectExpr("id AS a", "CAST(id % 7 AS int) AS b", "'t' AS text")
    wanted = rows.where("a % 50 = 0 OR a < 2").select("a", "b").union(spark.createDataFrame([(None, 1)], "a bigint, b int"))
    kept = {r["a"] for r in thinned(rows, ["a", "b"], wanted).collect()}
    assert {0, 1, *range(0, 20_000, 50)} <= kept and len(kept) < 500
    assert thinned(rows, ["a", "b"], wanted).columns == rows.columns
    assert thinned(rows, ["a", "b"], wanted.limit(0)).count() == 0


def test_texts_and_sketches_of_other_sets_do_not_go_to_the_joins(spark, monkeypatch):
    pairs = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    sets = spark.range(1, 3000).selectExpr(
        "id AS node", "CONCAT('one two three four five six ', id) AS text", "9L AS n", "UNHEX(REPEAT('00', 128)) AS bits")
    kept, plain = [], shingle_join.thinned

    def counted(*args):
        left = plain(*args)
        kept.append(left.count())
        return left

    monkeypatch.setattr(shingle_join, "thinned", counted)
    assert [tuple(r) for r in verify(pairs, sets).collect()] == [(1, 2, 2, 4)]
    assert [tuple(r) for r in possible(pairs, sets, 75).collect()] == [(1, 2)]
    assert len(kept) == 2 and all(2 <= n < 100 for n in kept)


def test_no_lines(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.repeated_lines(docs).count() == 0


def test_passages_are_found_with_words_replaced_and_clean_texts_are_not(spark):
    items = [(i, " ".join(prose(3000 + i, n))) for i, n in enumerate([15, 25, 50, 60, 8, 10, 12, 5])]
    items += [(20, None), (21, ""), (None, items[0][1])]
    rows, dirty = [], {}
    for i, text in items[:8]:
        passage = text.split()
        for kind in range(3):
            doc = 100 * kind + i
            inside = edited(passage, doc, [0, 1, len(passage) // 6][kind]) if len(passage) >= 15 else passage
            rows.append((doc, " ".join(prose(4000 + doc, 80) + inside + prose(5000 + doc, 70)).upper()))
            if len(passage) >= decontaminate.LEAST_WORDS:
                dirty[doc] = i
    rows += [(1000 + i, " ".join(prose(7000 + i, 300))) for i in range(40)]
    rows += [(2000, None), (2001, ""), (2002, " ".join(items[2][1].split()[10:35])), rows[0], (None, items[1][1])]
    dirty[2002] = 2
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, doc_id string")
    found = {r["doc_id"]: r for r in decontaminate.overlaps(docs, bench, bitmap_bits=1 << 20).collect()}
    assert {doc: r["item_id"] for doc, r in found.items()} == dirty
    assert (found[1]["doc_word"], found[1]["item_word"], found[1]["n_words"], found[1]["n_equal"]) == (80, 0, 25, 25)
    assert found[2002]["item_word"] == 10 and found[2002]["n_words"] == 25
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.overlaps(docs, none, bitmap_bits=1 << 20).count() == 0


def test_every_passage_that_qualifies_is_found(spark):
    for places in combinations(range(decontaminate.SPAN), 3):
        assert any(not set(places) & set(mask) for mask in decontaminate.MASKS)
    draw, items, rows, dirty = np.random.default_rng(17), [], [], set()
    for i, size in enumerate([12, 16, 20, 30, 8, 9, 10, 11, 5, 1]):
        item = prose(8000 + i, size)
        items.append((i, " ".join(item)))
        need = min(size, 12)
        for kind in range(40):
            if kind < 4:
                places = set(range(kind, size, 4))  # every fourth word
            else:
                places = set(draw.choice(size, min(size, int(draw.integers(1, 2 + size // 4))), replace=False).tolist())
            passage = [f"y{kind}_{p}" if p in places else word for p, word in enumerate(item)]
            best = max(sum(p not in places for p in range(a, a + need)) for a in range(size - need + 1))
            doc = 100 * i + kind
            rows.append((doc, " ".join([f"a{doc}"] * 5 + passage + [f"b{doc}"] * 5)))
            if best == need if size < 8 else best >= 0.75 * need:
                dirty.add((doc, i))
        rows.append((100 * i + 99, " ".join(["before", *item, "after"])))
        dirty.add((100 * i + 99, i))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.overlaps(docs, bench, bitmap_bits=1 << 20).collect()}
    assert {(doc, item) for doc, item in found if doc // 100 == item} == dirty and len(dirty) > 150


def test_hilbert_order_visits_neighbours():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = hilbert_search.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_search_reaches_brute_force_and_breaks_ties_by_id(spark):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(3000, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(5000 + i, vectors[100].tolist()) for i in range(40)] + [(5100 + i, vectors[7].tolist()) for i in range(3)]
    odd = [(9000, None), (9100, [0.0] * 16), (9200, [float("nan")] * 16), (9300, [1.0] * 15 + [float("inf")]),
           (9400, [None] * 16), (9500, [1.0, 2.0]), (None, vectors[5].tolist()), rows[200]]
    table = spark.createDataFrame([(*r, 3) for r in rows + odd], "vec_id bigint, embedding array<float>, point int")
    found = {}
    for r in hilbert_search.search(table).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    assert set(found) == {int(i) for i in ids if i % 100 == 0}
    hits = 0
    for query, listed in found.items():
        apart = np.sqrt(((matrix - matrix[ids == query][0]) ** 2).sum(axis=1))
        apart[ids == query] = np.inf
        listed.sort()
        assert [r[0] for r in listed] == list(range(1, 11))
        assert [r[1] for r in listed] == [v for _, v in sorted((s, v) for _, v, s in listed)]
        assert np.allclose([s for *_, s in listed], [apart[ids == v][0] for _, v, _ in listed], rtol=0, atol=1e-12)
        hits += len({v for _, v, _ in listed} & set(ids[np.lexsort((ids, apart))[:10]].tolist()))
    assert hits >= 0.9 * 10 * len(found)
    assert [v for _, v, _ in found[100]] == list(range(5000, 5010))


def test_windows_prune_where_vectors_have_neighbours(spark):
    """At the settings as shipped, on tables of many blocks: recall, and the share of brute force's distances."""
    draw = np.random.default_rng(77)
    middles = draw.normal(size=(600, 64))
    for size, spread, most in ((8_000, 0.15, 0.25), (16_000, 0.15, 0.15)):
        matrix = (middles[draw.integers(0, len(middles), size)] + spread * draw.normal(size=(size, 64))).astype(np.float32)
        table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], "vec_id bigint, embedding array<float>")
        found, compared = {}, {}
        for r in hilbert_search.search(table).collect():
            found.setdefault(r["query_id"], set()).add(r["vec_id"])
            compared[r["query_id"]] = r["compared"]
        exact, hits = matrix.astype(np.float64), 0
        for query, listed in found.items():
            apart = ((exact - exact[query]) ** 2).sum(axis=1)
            apart[query] = np.inf
            hits += len(listed & set(np.argsort(apart, kind="stable")[:10].tolist()))
        assert len(found) == size // 100 and hits >= 0.9 * 10 * len(found)
        assert sum(compared.values()) <= most * len(found) * (size - 1)
        assert max(compared.values()) < size  # nothing is measured twice


def test_search_with_fewer_candidates_than_results(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert [tuple(r)[:3] for r in hilbert_search.search(few).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert hilbert_search.search(few.limit(0)).count() == 0
