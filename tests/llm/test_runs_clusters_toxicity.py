"""Periodic runs, centroid clusters and toxicity against brute force on whole small tables, and on edge rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from minelake.llm import centroid_clusters as cc
from minelake.llm import queries
from minelake.llm import toxicity as tox
from minelake.llm.common import mix64
from minelake.llm.periodic_runs import SquareCatcher, periodic_runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ periodic runs

def brute_runs(words, least=12):
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def hashed(words):
    return mix64(np.array(words, np.uint64) + np.uint64(99))


def listed(catcher):
    return list(zip(*(x.tolist() for x in catcher.runs()), strict=True))


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_catcher_online_and_whole(data):
    letters, n = data.draw(st.integers(1, 4)), data.draw(st.integers(1, 150))
    words = data.draw(st.lists(st.integers(0, letters - 1), min_size=n, max_size=n))
    if data.draw(st.booleans()):  # a planted period, up to half the rest
        a = data.draw(st.integers(0, n - 1))
        p = data.draw(st.integers(1, max(1, (n - a) // 2)))
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    want = brute_runs(words)
    whole = SquareCatcher()
    whole.append(hashed(words))
    assert listed(whole) == want
    online, at = SquareCatcher(), 0
    while at < n:
        step = data.draw(st.sampled_from([1, 1, 2, 13]))
        online.append(hashed(words[at:at + step]))
        at += step
    assert listed(online) == want


def test_runs_reported_as_words_come():
    words, catcher = [0, 1, 2] * 8 + [9] + list(range(10, 30)), SquareCatcher()
    for n, w in enumerate(words, 1):
        catcher.append(hashed([w]))
        assert listed(catcher) == brute_runs(words[:n])


def brute_op11(doc_id, text):
    words = WORDS.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_op11_against_brute_force(spark):
    got = queries.REGISTRY["op11_periodic_runs"][0](spark, SMALL)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if len(r.text or "") < 30_000]
    some = {i for i, _ in rows}
    got = Counter(tuple(r) for r in got.collect() if r.doc_id in some)
    want = Counter(brute_op11(i, t) for i, t in rows)
    assert got == want and sum(r[1] > 0 for r in want) > 10


def test_periodic_runs_edge_rows(spark, docs, none):
    texts = docs.select("doc_id", "text").collect()
    got = {(r.doc_id, r.n_words): r for r in periodic_runs(docs).collect()}
    assert len(periodic_runs(docs).collect()) == len(texts)
    for doc_id, text in texts:
        words = WORDS.findall(text or "")
        if len(words) < 1000:
            r = got[(doc_id, len(words))]
            runs = brute_runs(words)
            assert [(x.start, x.length, x.period) for x in r.runs] == runs
            gone = {i for s, m, q in runs for i in range(s + q, s + m)}
            assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
    long = got[(7, 60_000)]  # all words differ but in their remainder
    assert long.runs == [] and long.collapsed.count(" ") == 59_999
    assert periodic_runs(none).count() == 0


def test_long_periods_beside_short_documents(spark):
    period = [f"a{k}" for k in range(9000)]
    rows = [(1, " ".join(period * 2 + period[:500])), (2, "x " * 30), (3, " ".join(period)), (4, " ".join(period)), (5, " ".join(["u v w"] * 7))]
    got = {r.doc_id: [(x.start, x.length, x.period) for x in r.runs] for r in periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [(0, 18_500, 9000)], 2: [(0, 30, 1)], 3: [], 4: [], 5: [(0, 21, 3)]}


# ------------------------------------------------------------------ centroid clusters

def brute_lloyd(rows, k=16, rounds=3):
    """Python integers throughout."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))[:k]
    centroids = [list(v) for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for j, vs in groups.items():
            centroids[j] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    ends = [(i, *nearest(v)[::-1]) for i, v in kept]
    per = Counter()
    for _, j, d in ends:
        per[j] += d
    return Counter((i, j, d, per[j], sum(per.values()), sha(",".join(map(str, centroids[j])))) for i, j, d in ends)


def test_op12_against_brute_force(spark):
    got = queries.REGISTRY["op12_centroid_clusters"][0](spark, SMALL)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in got.collect()) == brute_lloyd(rows)


def test_clusters_of_edge_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=64).astype(np.float32).tolist(), 1) for k in range(40)]
    rows += [rows[5], rows[5], (None, rows[6][1], None), (5, rows[7][1], 2)]  # repeated rows, null and repeated ids
    rows += [(100, None, 1), (101, [], 1), (102, [0.5] * 63, 1), (103, [None] + [0.5] * 63, 1), (104, [float("nan")] * 64, 1),
             (105, [float("inf")] + [0.0] * 63, 1), (106, [3000.0] * 32 + [-3000.0] * 32, 1), (107, [1e30] * 64, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int").withColumn("distance", F.lit("x"))
    want = brute_lloyd([r[:2] for r in rows if r[0] != 107])
    for width in (16, 5, 64):  # any column blocks give the same clusters
        assert Counter(tuple(r) for r in cc.centroid_clusters(df.repartition(3), shard_columns=width).collect()) == want
    few = df.where("vec_id IN (1, 2, 3)")
    assert Counter(tuple(r) for r in cc.centroid_clusters(few).collect()) == brute_lloyd([r[:2] for r in rows if r[0] in (1, 2, 3)])
    assert cc.centroid_clusters(df.where("1 = 0")).collect() == []
    assert cc.centroid_clusters(df.where("vec_id = 104")).collect() == []


def test_partial_distances_are_exact():
    rng = np.random.default_rng(1)
    for top in (100, cc.LARGEST):
        x, c = rng.integers(-top, top, (50, 16)), rng.integers(-top, top, (4, 16))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(u, v, strict=True)) for v in c] for u in x]
        assert cc._squared(x.astype(np.int32), c).tolist() == want


# ------------------------------------------------------------------ toxicity

def dense(n, n_terms, vectors):
    m = np.zeros((n, n_terms))
    for k, (t, w) in enumerate(vectors):
        m[k, t] = w
    return m


def test_block_max_search_equals_brute_force():
    rng = np.random.default_rng(5)
    n_terms, vectors = 40, []
    for _ in range(700):
        t = np.sort(rng.choice(n_terms, rng.integers(1, 6), replace=False))
        w = rng.integers(1, 4, len(t)).astype(float)  # many ties
        vectors.append((t, w / np.sqrt((w * w).sum())))
    index = tox.Index(vectors, n_terms)
    all_ = dense(700, n_terms, vectors)
    for k in (1, 7, 1000):
        for e in range(0, 700, 5):
            sims = np.round(all_ @ all_[e], 9)
            order = [j for j in np.lexsort((np.arange(700), -sims)) if sims[j] > 0 and j != e][:k]
            near, got = index.nearest(*vectors[e], k, without=e)
            # sums of another order may round the ninth decimal the other way
            assert np.allclose(got, sims[order], atol=2e-9)
            assert set(near[got > got[-1] + 1e-8]) == set(np.array(order)[sims[order] > sims[order][-1] + 1e-8])
    index.visited = 0
    index.nearest(np.array([3]), np.array([1.0]), 1)
    assert index.visited < index.n_blocks  # the bound spares blocks


def auc(labels, scores):
    order = sorted(zip(scores, labels, strict=True))
    rank, s = 0, Counter()
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and order[j][0] == order[i][0]:
            j += 1
        s[1] += sum(y for _, y in order[i:j]) * (i + 1 + j) / 2
        i = j
    pos = sum(labels)
    return (s[1] - pos * (pos + 1) / 2) / (pos * (len(labels) - pos))


def test_op13_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.REGISTRY["op13_toxicity"][0](spark, sf).collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for i, r in got.items())
    truth = [(r.toxic, got[r.doc_id]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert auc([y for y, _ in truth], [r.score for _, r in truth]) > 0.75
    assert sum(y == r.predicted for y, r in truth) / len(truth) > 0.9
    # evidence names labelled examples, none of them held out
    shown = {int(x.split(":")[0]) for r in got.values() for x in r.evidence.split(",") if x}
    assert shown and not any(got[i].held_out for i in shown)


def test_scores_do_not_read_labels_or_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(80)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    text = F.when(F.col("doc_id") % 2 == 1, F.concat("text", F.lit(" horrid nasty"))).otherwise(F.col("text"))
    model = tox.fit(docs.withColumn("text", text), labels)
    assert len(model["words"]) >= 2
    new = spark.createDataFrame([(None, "so horrid"), (1, "so horrid"), (2, "some NASTY, horrid thing"), (3, None), (4, ""), (5, "fine")], "doc_id long, text string")
    rows = tox.toxicity(new.withColumn("score", F.lit("x")).withColumn("evidence", F.lit(1)), model).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[None] == by[1] and by[1][0] > 0.5 and by[2][0] > 0.5 and by[3] == by[4] == by[5] and by[3][0] < 0.5
    assert all(x.label == 1 for r in rows if r.doc_id == 2 for x in r.evidence)


def test_toxicity_edge_rows(spark, docs, none):
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (no_labels, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None), (8, 7), (1, 0), (2, 1)], "doc_id long, toxic int")):
        model = tox.fit(docs, labels)
        assert tox.toxicity(docs, model).count() == docs.count()
        assert all(0 <= r.score <= 1 for r in tox.toxicity(docs, model).collect())
    assert tox.fit(docs, no_labels)["rate"] == 0.5
    assert tox.toxicity(none, model).count() == 0 and tox.fit(none, no_labels)["rate"] == 0.5


def test_word_pairs():
    texts = pa.array(["A b, b!c É 9", None, "", "b"])
    rows = [(int(r), int(c)) for _, _, row, _, count in tox._pairs(texts) for r, c in zip(row, count, strict=True)]
    assert Counter(rows) == Counter([(0, 1), (0, 2), (0, 1), (0, 1), (0, 1), (3, 1)])
