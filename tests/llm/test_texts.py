"""Scoring, secrets, token counts, packing and archives against plain Python."""

import base64
import hashlib
import re
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from quaymart.llm import packing, queries, secrets, token_counts, toxicity, url_rules, warc, words

ALPHABET = "stone river cloud amber quiet north field glass paper wheel honey lemon".split()


def text_of(draw, count):
    return " ".join("".join(draw.choice(ALPHABET, 2)) for _ in range(count))


def test_word_hashes_follow_words_across_chunks(monkeypatch):
    draw = np.random.default_rng(1)
    texts = [text_of(draw, int(n)) for n in draw.integers(0, 60, 50)] + ["", None, " \t", "Ab aB é É", "x" * 700 + " y\n" * 40]
    whole = words.word_hashes(pa.array(texts))
    monkeypatch.setattr(words, "CHUNK", 64)
    parts = words.word_hashes(pa.array(texts))
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts, strict=True))
    plain = [[re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] for t in texts]
    assert np.diff(whole[1]).tolist() == [len(w) for w in plain]
    names = {}
    for word, number in zip([w for p in plain for w in p], whole[0].tolist(), strict=True):
        assert names.setdefault(word, number) == number
    assert len(set(names.values())) == len(names)
    sliced = words.word_hashes(pa.array(texts).slice(7, 20))
    assert np.array_equal(sliced[0], whole[0][whole[1][7]:whole[1][27]])


def test_a_text_without_white_space_takes_little_memory():
    long = pa.array(["x" * 50_000_000 + " y", "z"])
    words.word_hashes(pa.array(["warm"]))
    tracemalloc.start()
    hashes, first = words.word_hashes(long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and first.tolist() == [0, 2, 3]
    assert hashes[0] == words.word_hashes(pa.array(["X" * 50_000_000]))[0][0] != words.word_hashes(pa.array(["x" * 49_999_999]))[0][0]


# --- toxicity ------------------------------------------------------------------------------------


def brute_marginals(emissions, t):
    n, total, marked = len(emissions), 0.0, np.zeros(len(emissions))
    for code in range(1 << n):
        states = [code >> i & 1 for i in range(n)]
        weight = np.exp(sum(e * s for e, s in zip(emissions, states, strict=True))
                        + sum(t[a, b] for a, b in zip(states, states[1:], strict=False)))
        total += weight
        marked += weight * np.array(states)
    return marked / total


def test_marginals_are_those_of_all_labellings():
    draw = np.random.default_rng(5)
    t = draw.normal(size=(2, 2))
    lengths = np.array([1, 5, 0, 8, 3])
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    emissions = draw.normal(size=lengths.sum())
    found = toxicity._sigmoid(toxicity.line_logits(emissions, starts, lengths, t))
    for start, length in zip(starts, lengths, strict=True):
        if length:
            assert np.allclose(found[start:start + length], brute_marginals(emissions[start:start + length], t))


def test_blocks_of_lines_are_bounded_however_lengths_jump():
    lengths = np.array([0, 3, 900, 3, 5, 0, 4000, 200_000] + [12] * 9000 + [300] * 40)
    blocks = list(toxicity._blocks(lengths))
    assert sorted(np.concatenate(blocks).tolist()) == np.flatnonzero(lengths).tolist()
    assert all(len(b) == 1 or len(b) * lengths[b].max() <= toxicity.CELLS for b in blocks)


@pytest.fixture(scope="module")
def labelled(spark):
    draw, rows, labels = np.random.default_rng(2), [], []
    for doc in range(600):
        text, toxic = text_of(draw, int(draw.integers(5, 60))).split(), int(doc % 4 == 0)
        for _ in range(2 * toxic):
            text.insert(int(draw.integers(0, len(text))), str(draw.choice(["vilgrub", "vilgrock", "vilgem", "snark"])))
        rows.append((doc, " ".join(text), 1.0))
        labels.append((doc, 1, toxic))
    rows += [(900, None, 2.0), (901, "", 2.0), (None, rows[0][1], 2.0), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    return docs, spark.createDataFrame(labels + [(None, 1, 1), (5000, 0, 1), (2, 1, None)], "doc_id bigint, quality int, toxic int")


def test_held_out_documents_and_unseen_forms_are_told_apart(spark, labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.tag(docs, model).collect()}
    held_out = [d for d in range(600) if crc32(str(d).encode()) % 5 == 0]
    right = sum((found[d]["score"] >= 0.5) == (d % 4 == 0) for d in held_out)
    assert right >= 0.95 * len(held_out)
    text = dict(r[:2] for r in docs.collect())
    for doc in (0, 4, 8):
        marked = [text[doc][s["start"]:s["end"]] for s in found[doc]["spans"]]
        assert marked and all(re.match("vilg|snark", w) for m in marked for w in m.split())
    fresh = spark.createDataFrame(
        [(1, "stoneriver vilgarten vilgoss cloudamber"), (2, "stoneriver vilgrub snark\nvilgem é vilgrub cloud")],
        "doc_id bigint, text string")
    new, seen = toxicity.tag(fresh, model).orderBy("doc_id").collect()
    assert new["score"] >= 0.5 and seen["score"] >= 0.5
    marked = ["stoneriver vilgrub snark\nvilgem é vilgrub cloud"[s["start"]:s["end"]] for s in seen["spans"]]
    assert {"vilgrub", "snark", "vilgem"} <= {w for m in marked for w in m.split()} and marked[0] == "vilgrub snark"
    assert found[900]["score"] == found[901]["score"] < 0.5 and found[900]["n_words"] == 0
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, r in found.items() if r["score"] < 0.5 and d is not None}


def test_labels_of_one_class_or_none(spark, labelled):
    docs, labels = labelled
    clean = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity.tag(docs, clean).collect()} == {0.0}
    assert toxicity.tag(docs, toxicity.fit(docs, labels.limit(0))).where("score > 0").count() == 0
    assert toxicity.tag(docs.limit(0), clean).count() == 0


# --- secrets -------------------------------------------------------------------------------------

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_base_spans_are_those_of_the_patterns_and_ownership_counts_owners(spark):
    key, copied, mixed = "AKIA" + "Q7" * 9, "0123456789abcdef" * 2, "aB3dE6gH9jK2mN5pQ8sT"
    texts = [
        f"é ü {key} then PASSWORD = 'hunter2hunter2' 𝒳 api_key:abcde api-key=nope", f"token=token=abc secret=token\":abcdefgh {copied}",
        "secret=short passwd: x", f"see {copied} and {mixed}", f"{mixed} again", None, "", "AKIA AKIAAKIA" + "Z" * 15 + "AKIA",
        f"x{copied}", f"password={mixed}", "apikey=123456token=abcdef", "\n".join(f"token: value{i:04d}x" for i in range(60)),
    ]
    rows = [(i, t, "en", f"owner{i % 3}", 1) for i, t in enumerate(texts)]
    rows += [(50 + i, f"copy of {copied}", "en", f"o{i}", 1) for i in range(4)] + [rows[1], (None, texts[0], None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, hash int")
    found = secrets.find_secrets(docs).collect()
    assert len(found) == len(rows)
    text = {doc: t or "" for doc, t, *_ in rows}
    for row in found:
        assert [(s["start"], s["kind"], s["end"]) for s in row["base"]] == base_spans(text[row["doc_id"]])
        for s in row["base"]:
            if s["kind"] == 2:
                assert s["judged"] == "example" and s["owners"] >= 4
    added = {row["doc_id"]: [text[row["doc_id"]][s["start"]:s["end"]] for s in row["added"]] for row in found}
    assert added[3] == [mixed] and added[4] == [mixed] and added[9] == []
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def test_candidates_are_judged_by_owners_and_repositories(spark):
    value = {name: hashlib.sha256(name.encode()).hexdigest()[:32] for name in "abcd"}
    rows = [(1, "s1", "en", "a"), (2, "s2", "en", "a"), (3, "s3", "en", "a"),  # many owners
            (4, "s1", "en", "b"), (5, "s1", "de", "b"),  # one owner's two repositories
            (6, "s2", "en", "c"), (7, "s2", "en", "c"),  # copies in one repository
            (8, "s1", "en", "d"), (9, "s2", "en", "d")]  # two owners, one repository each
    docs = spark.createDataFrame([(i, s, lang, f"key {value[v]} end") for i, s, lang, v in rows], "doc_id bigint, source string, lang string, text string")
    found = {r["doc_id"]: r["base"][0] for r in secrets.find_secrets(docs).collect()}
    want = {"a": ("example", 3, 3), "b": ("reused", 1, 2), "c": ("live", 1, 1), "d": ("live", 2, 2)}
    for i, _, _, v in rows:
        assert (found[i]["judged"], found[i]["owners"], found[i]["repositories"]) == want[v]


# --- token counts --------------------------------------------------------------------------------


def best_pieces(word, scores, least):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[a][0] + scores[word[a:end]], best[a][1] - 1) for a in range(end) if word[a:end] in scores]
        best.append(max(options) if options else (best[end - 1][0] + least, best[end - 1][1] - 1))
    return -best[-1][1]


def test_trie_counts_are_those_of_the_best_segmentation(spark):
    import public_tokenizers

    import regex

    path = queries.tokenizer_path("byte_bpe_50k.tiktoken")
    scores = token_counts.piece_scores(token_counts.load_ranks(path))
    trie = token_counts.PrefixTrie(scores, nodes=40)
    draw = np.random.default_rng(8)
    texts = [text_of(draw, int(n)) for n in draw.integers(0, 30, 20)] + [None, "", "naïve 𝒳 12,5 €\n\n  don't", "a" * 300]
    split = regex.compile(public_tokenizers.PATTERN)
    expected = []
    for doc, text in enumerate(texts):
        found = split.findall(text or "")
        counts = [best_pieces(w.encode(), scores, trie.least) for w in found]
        assert [trie.count(w) for w in found] == counts
        expected.append((doc, sum(counts), len(found), len(set(found)), len((text or "").encode())))
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int")
    got = token_counts.count_tokens(docs, path, public_tokenizers.PATTERN, nodes=500).collect()
    assert sorted(map(tuple, got)) == expected
    odd = token_counts.PrefixTrie({b"a": -1.0, b"ab": -1.5})
    assert [odd.count(w) for w in ("ab", "abb", "bb", "")] == [1, 2, 2, 0]


# --- packing -------------------------------------------------------------------------------------


def test_pieces_hold_every_id_once_and_sequences_are_gapless(spark):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tokenizer, draw = Tokenizer.from_file(path), np.random.default_rng(6)
    texts = [text_of(draw, int(n)) for n in draw.integers(0, 900, 120)]
    texts += [None, "", "  \x0b ", "É e\u0301 ΑΣ ΑΣ. \u00a0x\u2003y\x1cz don't <|endoftext|> \u0301a", text_of(draw, 6000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, length int").repartition(5)
    rows = packing.pack(docs, path, tasks_per_group=2).collect()
    ids = [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4") for t in texts]
    at = Counter()
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == at[r["doc_id"]] and r["doc_tokens"] == len(own) and r["length"] > 0
        assert r["ids_crc32"] == crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        at[r["doc_id"]] += r["length"]
    assert [at[i] for i in range(len(texts))] == [len(x) for x in ids]
    filled, padded = Counter(), {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
        padded[r["sequence_id"]] = r["padded"]
    loose = [s for s, n in filled.items() if n & (n - 1)]
    assert all(n <= padded[s] <= 2048 for s, n in filled.items())
    assert len(loose) <= 3 and all(filled[s] < 64 and padded[s] == 2048 for s in loose)
    steps = Counter()
    for r in rows:
        steps[r["step_group"], r["padded"]] += r["length"]
    assert max(steps.values()) <= packing.STEP_TOKENS


def test_step_groups_are_numbered_across_tasks(spark):
    draw = np.random.default_rng(16)
    docs = spark.createDataFrame([(i, text_of(draw, int(draw.integers(1, 400)))) for i in range(300)], "doc_id bigint, text string")
    rows = packing.pack(docs.repartition(9), queries.tokenizer_path(), tiers=(256, 128, 64), step_tokens=1024, tasks_per_group=3).collect()
    groups = {}
    for sequence, padded, group in {(r["sequence_id"], r["padded"], r["step_group"]) for r in rows}:
        assert group.split("-")[0] == str(padded)
        groups.setdefault(padded, Counter())[int(group.split("-")[1])] += padded
    assert sorted(groups)[-1] == 256 and len(groups[256]) > 9
    for padded, sizes in groups.items():
        assert sorted(sizes) == list(range(len(sizes)))
        assert all(n == 1024 for number, n in sizes.items() if number < len(sizes) - 1)


def test_a_pre_token_of_any_length_takes_no_more_memory():
    trie = token_counts.PrefixTrie({b"a": -1.0, b"ab": -1.5, b"b": -2.0})
    assert trie.count("ab" * 100_000) == 100_000 and len(trie.best) <= token_counts.DEPTH + 1
    assert trie.count("ab" * 30) == 30 and trie.count("ab" * 30 + "a") == 31


def test_words_with_marks_behind_are_encoded_many_at_once(monkeypatch):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain, encoder, alone = Tokenizer.from_file(path), packing.Encoder(path), []
    each = packing.Encoder._encode_each
    monkeypatch.setattr(packing.Encoder, "_encode_each", lambda self, parts: alone.extend(parts) or each(self, parts))
    texts = ["stone$$$ Stone. für, STONE.### naïve--  river", None, "", "it's <|endoftext|> a<|endoftext|> ΑΣ. İx a\"'s 4.5", "río%%% " * 50]
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    assert [ids.tolist() for ids in encoder.encode(column)] == [
        [*plain.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert not {"stone$$$", "für,", "STONE.###", "naïve--", "río%%%"} & set(alone)
    assert [len(x) for x in encoder.encode(column)] and len(alone) == len(set(alone))


def test_packing_of_repeats_and_nothing(spark):
    docs = spark.createDataFrame([(1, "stone river"), (1, "stone river"), (None, "cloud")], "doc_id bigint, text string")
    rows = packing.pack(docs, queries.tokenizer_path()).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 1) == 6 and sum(r["length"] for r in rows) == 8
    assert packing.pack(docs.limit(0), queries.tokenizer_path()).count() == 0


# --- urls and archives ---------------------------------------------------------------------------


def glob_pattern(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    return "".join({"**": "(?s:.*)", "*": "[^/]*", "?": "(?s:.)"}.get(p, re.escape(p)) for p in parts)


def test_automaton_agrees_with_regular_expressions():
    draw = np.random.default_rng(12)
    globs = ["".join(draw.choice(list("ab/.*?"), int(n))) for n in draw.integers(0, 12, 60)] + ["a" * 90 + "*" + "b" * 70, "**", "*"]
    texts = ["".join(draw.choice(list("ab/."), int(n))) for n in draw.integers(0, 14, 300)] + ["a" * 95 + "b" * 70, ""]
    found = url_rules.Automaton(globs).fits([t.encode() for t in texts])
    for i, text in enumerate(texts):
        assert found[i].tolist() == [bool(re.fullmatch(glob_pattern(g), text)) for g in globs]


def test_verdicts(spark):
    urls = [None, "", "no scheme", "http://net/", "http://A.NET", "http://a.net/x?y", "https://Example.Net/en/1", "https://example.net/EN/1",
            "http://notexample.net/en/", "ftp://x.example.com/de/a#b", "http://b.org/fr/", "http://b.org/fr", "://c.org/fr/x",
            "http://www.cheap-pills.example.com/en/", "http://spam-farm.example.org", "x://y://z.net/", "http://É.net/é", "http://" + "a" * 5000 + ".net/q",
            "http://a.com/b.net/c"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    found = {r["page_id"]: r for r in url_rules.judge(pages).collect()}
    for i, url in enumerate(urls):
        after = (url or "").partition("://")[2]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.split("[/?#]", after)[0])
        path = re.split("[?#]", after[len(host):])[0]
        fits = [r for r in url_rules.RULES if f".{host}".endswith(f".{r.host}") and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        bad = any(w in host for w in ("cheap-pills", "free-bets", "spam-farm"))
        verdict = best.verdict if best else "block" if bad else "allow"
        row = found[i]
        assert (row["host"], row["path"], row["rule"], row["verdict"]) == (host, path, best and best.name, verdict), url
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_archives_round_trip_and_do_not_depend_on_the_split(spark, tmp_path, monkeypatch):
    draw = np.random.default_rng(3)
    html = [text_of(draw, int(n)) for n in draw.integers(0, 400, 80)] + [None, "", "é\r\n\r\nWARC/1.1\r\n", "x" * 3_000_000]
    rows = [(7 * i % 1000, f"http://a.example/{i}", h) for i, h in enumerate(html)]
    rows += [(2000 + i, None, html[3]) for i in range(9)] + [(3000, "http://b.example/ü \r\n:", ""), rows[5], (None, "http://c.example/", html[4])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    options = {"shard_bytes": 40_000, "file_bytes": 9_000}
    folder, manifest = warc.write_archives(pages, str(tmp_path / "a"), **options)
    listed = {r["path"]: r["sha256"] for r in manifest.collect()}
    again, other = warc.write_archives(pages.repartition(7), str(tmp_path / "b"), **options)
    assert listed == {r["path"]: r["sha256"] for r in other.collect()} and len(listed) > 5
    names = {p.name for p in (tmp_path / "a").iterdir() if not p.name.endswith(".crc")}
    assert names == {*listed, "manifest"}
    assert all(hashlib.sha256((tmp_path / "a" / n).read_bytes()).hexdigest() == d for n, d in listed.items())
    largest = {}
    for page, _, text in rows:
        if page is not None:
            largest[text or ""] = max(page, largest.get(text or "", page))
    expected = []
    for page, _, text in rows:
        payload, first = (text or "").encode(), largest[text or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        same = page == first
        expected.append((page, len(payload), digest, "response" if same else "revisit", None if same else first,
                         (text or "") if same else None))
    found = warc.read_archives(folder, manifest, payloads=True).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html").collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    nothing, empty = warc.write_archives(pages.limit(0), str(tmp_path / "c"))
    assert warc.read_archives(nothing, empty).count() == 0
    assert warc.read_archives(folder, manifest, read_bytes=1).rdd.getNumPartitions() == len(listed)
    # Written by few tasks, several shards each: the same archive.
    monkeypatch.setattr(warc, "TASKS", 2)
    _, few = warc.write_archives(pages, str(tmp_path / "d"), **options)
    assert listed == {r["path"]: r["sha256"] for r in few.collect()}


def test_a_stopped_run_leaves_no_archive_and_its_rest_is_cleared(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(i, "http://a.example/", f"page {i}") for i in range(20)], "page_id bigint, url string, html string")

    def stop(*_args):
        raise RuntimeError("stopped")
    with monkeypatch.context() as patch:
        patch.setattr(warc, "_committed", stop)
        with pytest.raises(RuntimeError):
            warc.write_archives(pages, str(tmp_path), file_bytes=300)
    assert list(tmp_path.glob("*.warc.gz"))
    with pytest.raises(Exception, match="(?i)path"):
        warc.read_manifest(spark, str(tmp_path)).count()
    (tmp_path / "_temporary-shard-000000-00000.warc.gz-1").write_bytes(b"half")
    folder, manifest = warc.write_archives(pages, str(tmp_path), file_bytes=300)
    assert not list(tmp_path.glob("_temporary-*")) and not list(tmp_path.glob("_manifest-*"))
    assert warc.read_archives(folder, warc.read_manifest(spark, str(tmp_path))).count() == 20 == sum(r["records"] for r in manifest.collect())
