"""Each operator against brute force on whole small texts, and on the edge cases."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from minelake.llm import chat_format, common, decontaminate, language_id, license_scan, minhash_dedup, mixing, perfect_hash, pretokens, queries
from minelake.llm.components import components
from minelake.llm.fingerprints import fingerprints
from minelake.llm.substring_dedup import substring_dedup
from minelake.llm.token_counts import token_counts
from minelake.llm.token_store import write_tokens

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
WORD_FILE, BYTE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def brute_substring(rows, width):
    words = [(i, WORDS.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return Counter(out)


def test_substring_dedup_with_a_hot_passage(spark, monkeypatch):
    """A passage of most documents: its runs go by the broadcast of heavy runs, with the same result."""
    from minelake.llm import substring_dedup as sd

    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(k, f"a{k} b{k} {passage} c{k} " + (" ".join(f"q{k // 2}x{j}" for j in range(20)))) for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for share in (sd.HEAVY_SHARE, 5):
        monkeypatch.setattr(sd, "HEAVY_SHARE", share)
        monkeypatch.setattr(sd, "HEAVY_LEAST", 5 if share == 5 else sd.HEAVY_LEAST)
        got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(table, 10).collect())
        assert got == brute_substring(rows, 10)


def test_substring_dedup(spark, docs, none):
    for table, width in ((small(spark), 50), (docs, 50), (docs, 3)):
        got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(table, width).collect())
        assert got == brute_substring([(r.doc_id, r.text) for r in table.collect()], width)
    assert substring_dedup(none).count() == 0


def test_word_hashes_do_not_depend_on_the_block():
    texts = pa.array(["a bb  ccc", None, "", "bb aé ccc"])
    seen = {}
    for block in (1, 1 << 20):
        for i, j, data, off in common.text_blocks(texts, block):
            w = common.Words(data, off)
            for s, e, h in zip(w.starts, w.ends, w.hashes()):
                assert seen.setdefault(bytes(data[s:e]), int(h)) == int(h)
    assert set(seen) == {b"a", b"bb", b"ccc", "aé".encode()} and len(set(seen.values())) == 4


def brute_near(rows):
    sets = {}
    for i, t in rows:
        w = WORDS.findall(lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * len(sets[a] | sets[b]):
                p, q = sorted((top(a), top(b)))
                up[q] = p
    return {i: (len(sets[i]), top(i), top(i) == i) for i in ids}


def test_near_duplicates(spark, docs, none):
    for table in (small(spark), docs.where("doc_id IS NOT NULL")):
        rows = minhash_dedup.near_duplicates(table).collect()
        assert len(rows) == table.count()
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
        assert got == brute_near([(r.doc_id, r.text) for r in table.collect()])
    lost = [r for r in minhash_dedup.near_duplicates(docs).collect() if r.doc_id is None]
    assert [(r.component_id, r.kept) for r in lost] == [(None, True)]
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_chain_of_edits_is_one_group_and_blocks_find_links(spark):
    """Each text is near the next only; star centres cannot settle such buckets."""
    rng = np.random.default_rng(3)
    base = [f"t{k}" for k in rng.integers(0, 10**6, 400)]
    rows = []
    for k in range(60):
        rows.append((k, " ".join(base)))
        at = rng.integers(0, 400, 6)
        for x in at:
            base[x] = f"n{rng.integers(0, 10**6)}"
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), centres=1).collect()}
    assert got == brute_near(rows)


def test_components_of_a_long_path(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in components(edges).collect()} == {0}
    assert components(edges.where("1 = 0")).count() == 0


def test_decontaminate(spark, docs, none):
    rx = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    bench = spark.createDataFrame([(1, " ".join(f"Word{k}" for k in range(20, 45))), (2, "short, ONE!"), (3, None), (10, "..."), (None, "Y"),
                                   (20, " ".join(f"word{k}" for k in range(30, 42)))], "item_id long, text string")
    windows = {}
    for r in bench.collect():  # a row without item_id is an item too
        w = rx.findall(lower(r.text))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(r.item_id if r.item_id is not None else decontaminate.NO_ID))
    want = []
    for r in docs.collect():
        w, hit, items = rx.findall(lower(r.text)), set(), set()
        for k in range(len(w)):
            for win, ids in windows.items():
                if tuple(w[k:k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    items |= ids
        want.append((r.doc_id, len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit)))
    for size in (1 << 20, 100):
        rows = decontaminate.benchmark_hits(docs, bench, block_bytes=size).collect()
        assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows) == Counter(want)
        clean = decontaminate.clean_documents(docs.withColumn("bad_id", F.lit(1)), bench, block_bytes=size).drop("bad_id")
        assert clean.columns == docs.columns and clean.count() == sum(not w[-1] for w in want)
    hit = [r for r in decontaminate.benchmark_hits(docs, bench).collect() if r.doc_id == 8][0]
    assert [tuple(s) for s in hit.spans] == [(0, 9)]
    assert decontaminate.benchmark_hits(none, bench).count() == 0
    assert decontaminate.benchmark_hits(docs, bench.where("1 = 0")).where("contaminated").count() == 0


def test_language_weights_are_kernel_ridge():
    """With every text a landmark, the folded weights give plain kernel ridge regression."""
    rng = np.random.default_rng(2)
    rows = [("".join(rng.choice(list("abc de" if k % 3 else "xyz de"), 40)), "ab"[k % 3 == 0]) for k in range(36)]
    model = language_id.fit(rows)
    grams = language_id.Grams(model["letters"])

    def present(text):
        marks = np.zeros(grams.size, np.uint8)
        grams.present(text, marks)
        return np.flatnonzero(marks)

    sets = [present(t) for t, _ in rows]
    kernel = lambda x, y: len(np.intersect1d(x, y)) / np.sqrt(len(x) * len(y))
    k = np.array([[kernel(x, y) for y in sets] for x in sets])
    y = np.array([[1.0 if lang == other else -1.0 for other in model["langs"]] for _, lang in rows])
    alpha = np.linalg.solve(k + language_id.RIDGE * np.eye(len(rows)), y)
    for text in ("abcabc dede", "xyz xyz yy", "a", "zed bed"):
        own = present(text)
        marks = np.zeros(grams.size, np.float64)
        marks[own] = 1
        plain = np.array([kernel(own, x) for x in sets]) @ alpha
        assert np.allclose(marks[model["used"]] @ model["weights"] / np.sqrt(len(own)), plain, atol=1e-4)


def test_language_fit_rows_are_the_smallest_hashes(spark):
    """A language with most rows is cut to its smallest hashes without gathering it."""
    rows = [(k, f"text number {k % 900}", "en" if k % 50 else "fr") for k in range(3000)] + [(1, None, "en"), (2, "x", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for n in (3, 40):
        got = {(r.lang, r.text) for r in language_id.fit_sample(table, n).collect()}
        h = {r.text: r.h for r in table.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
        want = {(lang, t) for lang in ("en", "fr") for t in sorted({t for _, t, x in rows if x == lang and t}, key=h.get)[:n]}
        assert got == want


def test_language_id(spark, docs, none):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language_id.train(table.where(~queries.held_out()))
    got = language_id.predict(table.where(queries.held_out()), model, ["lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    odd = language_id.predict(docs, model, docs.columns).collect()
    assert len(odd) == docs.count() and all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in odd)
    assert language_id.predict(none, model, ["doc_id"]).count() == 0
    assert {r.lang_pred for r in language_id.predict(docs, language_id.train(none), ["doc_id"]).collect()} == {"und"}


def test_token_counts(spark, docs, none):
    tok = Tokenizer.from_file(BYTE_FILE)
    for table in (docs, small(spark)):
        want = Counter((r.doc_id, len((r.text or "").encode()), n, n > 512) for r in table.collect()
                       for n in [len(tok.encode(r.text or "", add_special_tokens=False).ids)])
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(table, BYTE_FILE).collect()) == want
    assert token_counts(none, BYTE_FILE).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=255), max_size=40))
def test_pretoken_patterns_match_the_library(text):
    for path, pattern, change in ((WORD_FILE, pretokens.LOWER_WORDS, str.lower), (BYTE_FILE, pretokens.BYTE_LEVEL, str)):
        if path not in _loaded:
            tok, model, _ = pretokens.load(path)
            _loaded[path] = tok, pretokens.Misses(model, lambda found: [t.id for t in found])
        tok, cache = _loaded[path]
        assert [i for w in pattern.findall(change(text)) for i in cache[w]] == tok.encode(text, add_special_tokens=False).ids


_loaded = {}


def test_token_store_round_trip(spark, docs, none):
    tok = Tokenizer.from_file(WORD_FILE)
    store = write_tokens(docs, WORD_FILE, 1, shard_ids=1000, index_keys=4)
    rows = store.fetch(store.catalogue, with_ids=True).collect()
    want = Counter((r.doc_id, tuple([*tok.encode(r.text or "", add_special_tokens=False).ids, 1])) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == [None] + sorted(i for i in ids if i is not None)
    unknown = store.find(spark.createDataFrame([(777, 0), (1, 5), (1, 0)], "doc_id long, occurrence long")).collect()
    assert {(r.doc_id, r.occurrence): r.n is not None for r in unknown} == {(777, 0): False, (1, 5): False, (1, 0): True}
    empty = write_tokens(none, WORD_FILE, 1)
    assert empty.fetch(empty.catalogue).count() == 0


def test_perfect_hash_is_minimal():
    keys = common.mix64(np.arange(5000, dtype=np.uint64))
    found, rest = perfect_hash.build(keys)
    assert len(rest) == 0 and sorted(found.lookup(keys)) == list(range(len(keys)))
    none, rest = perfect_hash.build(keys[:0])
    assert len(rest) == 0 and none.lookup(keys[:5]).tolist() == [-1] * 5


def test_perfect_hash_of_equal_keys_ends():
    keys = np.array([5, 5, 7, 9, 9, 9], np.uint64)
    found, rest = perfect_hash.build(keys)
    assert sorted(rest.tolist()) == [0, 1, 3, 4, 5] and found.lookup(keys[2:3]).tolist() == [0]


def test_keys_with_equal_hashes_are_told_apart(spark, monkeypatch):
    """Every key of the store hashes alike: the index falls back to the keys themselves."""
    from minelake.llm import token_store

    folder = common.shared_folder(spark, "equal")
    n = 50
    table = pa.table({"doc_id": pa.array([None, *range(1, n)], pa.int64()), "occurrence": [k % 3 for k in range(n)], "index_part": [0] * n,
                      "key": [77 if k % 2 else k for k in range(n)], "part": [0] * n, "shard": [k for k in range(n)], "offset": [10 * k for k in range(n)], "n": [k for k in range(n)]})
    built = token_store._build_index(folder)(table)
    asked = table.select(["doc_id", "occurrence", "key"]).append_column("index_file", pa.array([built["index_file"][0].as_py()] * n))
    found = token_store._find(folder)(asked)
    assert found["shard"].to_pylist() == list(range(n)) and found["offset"].to_pylist() == [10 * k for k in range(n)]
    unknown = pa.table({"doc_id": pa.array([1000], pa.int64()), "occurrence": [0], "key": [77], "index_file": [built["index_file"][0].as_py()]})
    assert token_store._find(folder)(unknown)["shard"].to_pylist() == [None]


def test_keyed_read_opens_byte_ranges(spark, docs, monkeypatch):
    store = write_tokens(docs, WORD_FILE, 1)
    every = {(r.doc_id, r.occurrence): r for r in store.fetch(store.catalogue, with_ids=True).collect()}
    one = store.catalogue.where("doc_id = 8")
    got = store.fetch(one, with_ids=True).collect()
    assert len(got) == 1 and got[0] == every[(8, 0)]
    from minelake.llm import token_store

    place = store.find(one).join(store.shards, ["part", "shard"]).first()
    read = []
    real = token_store._open

    class Counted:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def read(self, n=None):
            data = self.f.read(n)
            read.append(len(data))
            return data

        def __getattr__(self, name):
            return getattr(self.f, name)

    class System:
        def open_input_file(self, path):
            return Counted(real(store.folder)[0].open_input_file(path))

    monkeypatch.setattr(token_store, "_open", lambda folder: (System(), real(folder)[1]))
    ids = token_store._get_ids(store.folder, place.file, [place.offset], [place.n])
    assert ids[0].tolist() == got[0].ids and sum(read) == 16 + 2 * place.n


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_cut_pre_tokens_of_any_script(text):
    for path, pattern, low in ((WORD_FILE, pretokens.LOWER_WORDS, True), (BYTE_FILE, pretokens.BYTE_LEVEL, False)):
        if (path, "cut") not in _loaded:
            tok, model, specials = pretokens.load(path)
            _loaded[path, "cut"] = tok, pretokens.Cutter(tok, specials, pattern, low), pretokens.Misses(model, lambda found: [t.id for t in found])
        tok, cut, ids = _loaded[path, "cut"]
        found = cut(text)
        if found is not None:
            assert [i for w in found for i in ids[w]] == tok.encode(text, add_special_tokens=False).ids


def test_roles_with_line_feeds(spark):
    rows = [(1, 0, "us\ner", "hi"), (1, 1, "a&#10;b\n", "x\ny"), (1, 2, "\n", ""), (2, 0, "&amp;\n&lt;", "&#10;")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat_format.read_back(chat_format.format_chats(df)).collect()
    got = {(r.conv_id, k): (t.role, t.text) for r in back for k, t in enumerate(r.turns)}
    assert got == {(c, t): (role, text) for c, t, role, text in rows}


def test_a_doc_id_with_two_texts_keeps_both_links(spark):
    a, z = (" ".join(f"{p}{k}" for k in range(50)) for p in "az")
    rows = [(5, a), (5, z), (6, a + " one"), (7, z + " one"), (8, " ".join(f"q{k}" for k in range(50))), (9, z), (5, None)]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {5: 5, 6: 5, 7: 5, 8: 8, 9: 5}
    assert [r.kept for r in got if r.doc_id == 7] == [False] and len(got) == len(rows)
    # a repeated doc_id whose second set is the smaller node, and one that bridges two groups
    rows = [(50, z), (50, a), (40, a + " one"), (60, z + " one")]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.component_id, r.kept) for r in got} == {40: (40, True), 50: (40, False), 60: (40, False)}


def test_mixing(spark, docs, none):
    for table in (docs, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        rows = mixing.mix(table).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in table.collect())
        size = Counter()
        for r in table.collect():
            size[r.source] += len(WORDS.findall(r.text or ""))
        weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
        target, free = {}, set(size)
        while True:
            left, w = sum(size.values()) - sum(target.values()), sum(weight[s] for s in free)
            over = [s for s in free if weight[s] * left / w > 3 * size[s]]
            if not over:
                break
            target |= {s: 3.0 * size[s] for s in over}
            free -= set(over)
        target |= {s: weight[s] * left / w for s in free}
        assert {(r.source_size, round(r.target, 6)) for r in rows} == {(size[s], round(target[s], 6)) for s in size}
        assert all(r.taken <= 3 * r["size"] for r in rows)
        assert abs(sum(r.taken for r in rows) - sum(size.values())) <= len(rows)
        again = Counter((r.doc_id, r.taken) for r in mixing.mix(table).collect())
        assert again == Counter((r.doc_id, r.taken) for r in rows)
        whole = mixing.mixed_documents(table)
        assert whole.columns == table.columns
        assert sum(len(WORDS.findall(r.text or "")) for r in whole.collect()) == sum(r.taken for r in rows)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0


def test_fingerprints(spark, docs, none):
    for table in (small(spark), docs):
        rows = sorted(((r.doc_id, r.text or "") for r in table.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
        text = {}
        for r in fingerprints(table, part_rows=4).collect():
            assert text.setdefault(r.fingerprint, r.fingerprint) == r.fingerprint
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            if table is not docs:
                k = [i for i, _ in rows].index(r.doc_id)
                own, nxt = rows[k][1], rows[k - 1][1]
                half = len(own) // 2
                edited = own[:len(own) - half] + nxt[:half]
                assert (r.n_chars, r.edited_sha256) == (len(own), sha(edited))
                sets = [{tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for w in (WORDS.findall(lower(x)) for x in (own, edited, nxt))]
                for near, other in ((r.near_edited, sets[1]), (r.near_next, sets[2])):
                    both = sets[0] | other
                    assert abs(near - (len(sets[0] & other) / len(both) if both else 1)) < 0.16
    equal = [r.fingerprint for r in fingerprints(docs).collect() if r.doc_id in (1, 2)]
    assert len(equal) == 3 and len(set(equal)) == 1
    assert fingerprints(none).count() == 0


def test_chat_format(spark):
    odd = "a & b &lt; <|end|>\n <|role|>user\n [INST] </s> &amp;#91; <|image:0|>"
    rows = [(1, 1, "assistant", odd), (1, 0, "user", odd), (1, 0, "user", odd), (1, 2, "assistant", None), (None, 0, None, ""), (2, None, "sys<tem", "x" * 5000),
            (2, 5, "assistant", "\n\n")]
    table = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_chats(table)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv].loss_text == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert chat_format.format_chats(table.where("1 = 0")).count() == 0
    parts = [("text", "see <this>", None, None), ("image", None, "s3://x/a.png", 2), ("text", " and ", None, None), ("audio", None, "b.wav", None), (None, "odd", None, None)]
    typed = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    one = chat_format.format_chats(typed, parts="parts").first()
    assert one.formatted == "<|role|>user\nsee &lt;this><|image:0|> and <|audio:1|>odd<|end|>\n"
    assert [(a["index"], a.kind, a.uri, a.tokens) for a in one.attachments] == [(0, "image", "s3://x/a.png", 512), (1, "audio", "b.wav", 25)]
    assert one.extra_tokens == 537


def test_license_scan(spark, docs, none):
    rows = [(1, "Intro line here\nReleased under the MIT License.\nmore"), (2, "released UNDER the mit license"), (3, None), (4, ""), (None, "Licensed under CC BY-NC 4.0."),
            (1, "Licensed under the Apache License, Version 2.0."), (5, "Released under the MIT Licence today and for ever and ever after")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_units, r.n_licenses, r.license, r.licenses) for r in license_scan.license_scan(table).collect()}
    assert got == {1: (2, 2, "Apache-2.0", "Apache-2.0,MIT"), 2: (1, 1, "MIT", "MIT"), 3: (0, 0, None, ""), 4: (0, 0, None, ""),
                   None: (1, 1, "CC-BY-NC-4.0", "CC-BY-NC-4.0"), 5: (0, 0, None, "")}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    columns = "doc_id, n_units, n_licenses, license, dice, licenses"
    want = Counter(con.sql(f"SELECT {columns} FROM ({license_scan.oracle_sql()})").fetchall())
    assert Counter(tuple(r) for r in license_scan.license_scan(small(spark)).select(*columns.split(", ")).collect()) == want
    assert license_scan.license_scan(none).count() == 0 and license_scan.license_scan(docs).count() == docs.select("doc_id").distinct().count()


def test_license_scan_passages(spark):
    known = {}
    for name, text in license_scan.TEMPLATES + license_scan.PASSAGES:
        known.setdefault(name, []).append(text)
    clauses = known["BSD-3-Clause"][0].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ").replace(" 3. ", "\n\n3. ")
    two = clauses.partition("\n\n3. ")[0]
    rest = '\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.\n'
    words = " ".join(f"word{i} of the plain text" for i in range(120))
    texts = [("BSD-2-Clause", "Copyright (c) 2020, A\nAll rights reserved.\n\n" + two + rest), ("BSD-3-Clause", "Copyright (c) 2020, A\n\n" + clauses + rest),
             ("BSD-2-Clause", words + "\n" + two + "\n" + words), ("MIT", f"{words} Released under the MIT License. {words}"),
             ("MIT", f"{words} released under the mit license {words}"), (None, words)]
    texts += [(name, f"{words} {t} {words}") for name in ("AGPL-3.0", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0") for t in known[name]]
    more = [(100, None), (101, ""), (None, texts[3][1]), (100, texts[4][1])]
    table = spark.createDataFrame([*((i, t) for i, (_n, t) in enumerate(texts)), *more], "doc_id long, text string")
    columns = "doc_id, n_units, n_licenses, license, dice, licenses"
    rows = license_scan.license_scan(table).select(*columns.split(", ")).collect()
    got = {r.doc_id: (r.license, r.licenses) for r in rows}
    assert [got[i] for i in range(len(texts))] == [(n, n or "") for n, _t in texts]
    # the registered SQL answers alike
    con = duckdb.connect()
    con.register("documents", table.toArrow())
    assert Counter(tuple(r) for r in rows) == Counter(con.sql(f"SELECT {columns} FROM ({license_scan.oracle_sql()})").fetchall())
