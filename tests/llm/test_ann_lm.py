from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from geohealth.llm import ann, lm

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def nearest(ids, x, k=20):
    """query row -> its k best (score, id) pairs, by comparing all."""
    s = x @ x.T
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        rest = [(-(x[q] * x[j]).sum(), ids[j]) for j in range(len(ids)) if j != q]
        out[ids[q]] = sorted(rest)[:k]
    assert s.shape[0] == len(ids)
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 24)).astype("f4").astype("f8")
    x[300:500] = x[300] + rng.normal(scale=0.05, size=(200, 24)).astype("f4")
    x[500:560] = x[500]  # many copies of one vector
    ids = np.arange(700)
    df = spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, x)], "vec_id long, embedding array<float>, rank int")
    x = x.astype("f4").astype("f8")
    got = ann.search(df, lambda i: i % 20 == 0).toPandas()
    want = nearest(ids, x)
    assert got.groupby("query_id")["rank"].apply(list).map(lambda r: r == list(range(1, 21))).all()
    hits = 0
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        worst = want[q][-1]
        pairs = list(zip(-rows["score"], rows["vec_id"]))
        assert pairs == sorted(pairs)  # nearest first, ties to the smaller id
        assert np.allclose(rows["score"], [(x[q] * x[j]).sum() for j in rows["vec_id"]], rtol=0, atol=1e-12)
        hits += sum(s <= worst[0] + 1e-12 for s, _ in pairs)
    assert hits / (20 * len(want)) >= 0.9
    copies = got[got["query_id"] == 520].sort_values("rank")
    if len(copies):
        assert copies["vec_id"].tolist() == [i for i in range(500, 521) if i != 520]


def test_small_and_broken_tables(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0, 2.0, 3.0]), (7, [-1.0, 0.0])]
    got = ann.search(spark.createDataFrame(rows, schema), lambda i: i % 20 == 0).collect()
    assert len([r for r in got if r.query_id == 0]) == 3 and len([r for r in got if r.query_id == 20]) == 6  # two rows ask
    assert {r.vec_id for r in got} == {0, 7, 20}
    assert ann.search(spark.createDataFrame([], schema), lambda i: i % 20 == 0).count() == 0
    assert ann.search(spark.createDataFrame([(20, [1.0])], schema), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize("n", [25, 26, 100])
def test_clustered_tables_give_all_ranks(spark, n):
    """Few rows, in tight and far clusters: every query has its 20 (or all) candidates at the registered setting."""
    rng = np.random.default_rng(n)
    x = np.eye(8)[rng.integers(0, 8, n)] * 5 + rng.normal(scale=0.01, size=(n, 8))
    got = ann.search(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), lambda i: i % 20 == 0).toPandas()
    assert got.groupby("query_id")["rank"].apply(lambda r: sorted(r) == list(range(1, min(20, n - 1) + 1))).all() and set(got["query_id"]) == set(range(0, n, 20))
    want = nearest(np.arange(n), x)
    hits = sum(len({i for _, i in want[q]} & set(rows["vec_id"])) for q, rows in got.groupby("query_id"))
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_probe_follows_the_data():
    rng = np.random.default_rng(0)
    loose, tight = rng.normal(size=(2000, 32)), np.repeat(rng.normal(size=(40, 32)) * 9, 50, axis=0) + rng.normal(scale=0.1, size=(2000, 32))
    share = [ann.fitted_probe(x, ann.centroids(x, 40), 20, 0.97) for x in (loose, tight)]
    assert share[0] > 0.3 and share[1] < 0.2


def test_abandoning_keeps_what_is_near():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(400, 64)), rng.normal(size=(8, 64))
    x, q = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, q))
    rotation = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    tau = np.sort(q @ x.T, axis=1)[:, -10]
    lists = np.arange(400) % 2
    near = ann.scan_cell(x @ rotation, lists, q @ rotation, np.array([[True, True]] * 7 + [[True, False]]), tau, 16, 1.6)
    kept = np.isfinite(near)
    assert np.allclose(near[kept], (q @ x.T)[kept]) and not kept[7, 1::2].any()
    assert kept[:7][(q @ x.T)[:7] >= tau[:7, None]].mean() > 0.95 and kept.mean() < 0.75


def segmentations(model, text, at=0):
    """ln probability of every segmentation."""
    if at == len(text):
        yield 0.0
        return
    for j, p, _ in model.spell(text, at):
        for rest in segmentations(model, text, j):
            yield p + rest


@pytest.mark.parametrize("word", ["the", "thereof", "x", "ñandú", "漢字", "a" * 12])
def test_lattice_sums_all_segmentations(word):
    model = lm.lattice(lm.vocabulary(PIECES), {})
    want = math.log(sum(map(math.exp, segmentations(model, lm.MARK + word)))) + model.stop
    assert abs(model.forward(word) - want) < 1e-9
    counts = ({}, {})
    model.expect(word, 3, counts)
    assert abs(sum(counts[False].values()) - 3) < 1e-9 and counts[True][""] == 3.0


def test_long_words():
    """Block by block expected counts, and a forward recursion that keeps a few places only, give what the whole gives."""
    model = lm.lattice(lm.vocabulary(PIECES), {})
    word = "abc漢" * 3000
    alpha, text = [0.0] + [-math.inf] * (len(word) + 1), lm.MARK + word
    for i in range(len(text)):
        for j, p, _ in model.spell(text, i):
            alpha[j] = np.logaddexp(alpha[j], alpha[i] + p)
    assert abs(model.forward(word) - alpha[-1] - model.stop) < 1e-6 * abs(alpha[-1])
    counts = ({}, {})
    model.expect(word, 1, counts)
    pieces = sum(len(p) * n for c in counts for p, n in c.items() if not p.startswith("<0x"))
    bytes_ = sum(n for c in counts for p, n in c.items() if p.startswith("<0x"))
    assert abs(pieces + bytes_ / 3 - len(text)) < 1 + bytes_ * 2 / 3


def test_vocabulary_keeps_its_share():
    weights = lm.vocabulary(PIECES)
    counts = {(False, "▁the"): 1e9, (True, "ing"): 1e9}
    model = lm.lattice(weights, counts)
    plain = lm.lattice(weights, {})
    assert abs(math.exp(model.first["▁the"]) - 0.5 - 0.5 * math.exp(plain.first["▁the"])) < 1e-9
    assert all(v >= plain.first[p] + math.log(0.5) - 1e-9 for p, v in model.first.items())


def test_document_scores_equal_plain_sums(spark):
    """The whole operator on small texts: every segmentation of every word is enumerated, the model is fitted plainly."""
    texts = ["the cat", "a cat sat", "", "ñu the", None, "The  End", "zq"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string"), PIECES).collect()}
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w.decode() for t in train for w in lm.tokens(t))
    weights, plain = lm.vocabulary(PIECES), lm.lattice(lm.vocabulary(PIECES), {})

    def ways(model, text, at=0):
        if at == len(text):
            yield 0.0, []
            return
        for j, p, piece in model.spell(text, at):
            for rest, more in ways(model, text, j):
                yield p + rest, [(at > 0, piece) if piece else (True, text[at].encode())] + more

    expected = Counter()
    for w, c in counts.items():
        every = list(ways(plain, lm.MARK + w))
        total = sum(math.exp(p) for p, _ in every)
        for p, pieces in every:
            for later, piece in pieces:
                for one in [piece] if isinstance(piece, str) else [f"<0x{b:02X}>" for b in piece]:
                    expected[later, one] += c * math.exp(p) / total
        expected[True, ""] += c
    model = lm.lattice(weights, expected)
    n = sum(counts.values()) + len(train)
    end = (len(train) + 1) / (n + 2)
    for i, t in rows:
        want = math.log10(end)
        for w in lm.tokens(t):
            want += math.log10(sum(math.exp(p) for p, _ in ways(model, lm.MARK + w.decode()))) + model.stop / math.log(10) + math.log10(1 - end)
        assert abs(got[i].score - want) < 1e-6


def test_lattice_is_normalised():
    model = lm.lattice(lm.vocabulary(PIECES), {})
    assert abs(sum(map(math.exp, model.first.values())) - 1) < 1e-9
    assert abs(sum(map(math.exp, model.later.values())) + sum(map(math.exp, model.byte)) + math.exp(model.stop) - 1) < 1e-9


def check_base(got, rows):
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c = Counter(w for t in train for w in [*lm.tokens(t), None])
    n, v = sum(c.values()), len(c)
    want = sorted((-1 if i is None else i, len(lm.tokens(t)) + 1, sum(c[w] > 0 for w in [*lm.tokens(t), None]), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*lm.tokens(t), None]), 6)) for i, t in rows)
    mine = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert len(mine) == len(want)
    for a, b in zip(mine, want):
        assert a[:4] == b[:4] and abs(a[4] - b[4]) <= 1e-5 * max(1, abs(b[4]))


def test_scores_edges(edge, edge_rows, empty):
    got = lm.score(edge, PIECES).collect()
    check_base(got, [(r[0], r[1]) for r in edge_rows])
    assert all(r.score < 0 and math.isfinite(r.score) and r.mixed_score < 0 for r in got)
    assert lm.score(empty, PIECES).count() == 0


def test_scores_with_few_frequent_words(spark, monkeypatch):
    """With a higher bound most words go through the join."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    monkeypatch.setattr(lm, "HOT_SHARE", 1e-3)
    got = lm.score(docs, PIECES).collect()
    check_base(got, rows)
    held = [r for r in got if r.held_out]
    assert held and all(r.score < 0 for r in got)
    monkeypatch.setattr(lm, "HOT_SHARE", 2e-6)
    again = {r.doc_id: r for r in lm.score(docs, PIECES).collect()}
    assert all(abs(r.score - again[r.doc_id].score) < 1e-6 * abs(r.score) and abs(r.mixed_score - again[r.doc_id].mixed_score) < 1e-6 * abs(r.mixed_score) for r in got)
