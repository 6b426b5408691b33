"""Best-fit packing, whitening and collocations against plain versions."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from geohealth.llm import bestfit, collocation, whitening

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(lengths: list[int], capacity: int) -> list[int]:
    """What is left in each bin, putting one piece after the other."""
    left: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(capacity - n)
    return left


@pytest.mark.parametrize("seed", range(12))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.choice([1, 7, 16, 100, 1024]))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 600))).tolist() if seed % 2 else (rng.integers(1, min(6, capacity) + 1, 400)).tolist()
    plan = bestfit.best_fit_plan(Counter(lengths), capacity)
    bins: dict[int, list[tuple[int, int]]] = {}
    ranks = Counter()
    for length, first, count, each, start, filled in plan:
        assert first == ranks[length]
        ranks[length] += count
        for nth in range(count):
            bins.setdefault(start + nth // each, []).append((filled + nth % each * length, length))
    assert ranks == Counter(lengths) and set(bins) == set(range(len(bins)))
    for pieces in bins.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in bins.values()) == sorted(plain_best_fit(lengths, capacity))


def test_plan_does_not_grow_with_the_rows():
    few = {n: 1000 + n * 37 % 501 for n in range(1, 1025)}
    sizes = [len(bestfit.best_fit_plan({n: c * k for n, c in few.items()}, 1024)) for k in (1, 1_000_000)]
    assert max(sizes) < 20_000


def test_tree_finds_the_tightest():
    rng = np.random.default_rng(0)
    tree, held = bestfit.CapacityTree(50), Counter()
    for _ in range(300):
        r = int(rng.integers(0, 51))
        tree.add(r, 1)
        held[r] += 1
        if rng.random() < 0.6:
            gone = int(rng.choice([k for k, v in held.items() if v]))
            tree.add(gone, -held.pop(gone))
        for n in range(1, 51):
            assert tree.tightest(n) == min((k for k, v in held.items() if v and k >= n), default=None)


def check_packed(got, texts, capacity, end):
    t = Tokenizer.from_file(BPE)
    want = [[*t.encode(x or "", add_special_tokens=False).ids, end] for _, x in texts]
    assert Counter(np.frombuffer(b"".join(g.sort_values("piece")["ids"]), "<u4").tobytes() for _, g in got[got["doc_id"].notna()].drop_duplicates(["doc_id", "piece"]).groupby("doc_id")) == Counter(
        np.array(w, "<u4").tobytes() for w in {i: w for (i, _), w in zip(texts, want) if i is not None}.values())
    assert (got["ids_crc32"] == [zlib.crc32(x) for x in got["ids"]]).all() and (got["length"] * 4 == got["ids"].map(len)).all()
    lengths = []
    for w in want:
        lengths += [(len(w) - 1) % capacity + 1] + [capacity] * ((len(w) - 1) // capacity)
    assert Counter(got["length"]) == Counter(lengths)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["offset"].tolist() == np.concatenate([[0], g["length"].cumsum()[:-1]]).tolist() and g["length"].sum() <= capacity
    assert sorted(capacity - got.groupby("sequence_id")["length"].sum()) == sorted(plain_best_fit(lengths, capacity))


def test_packing_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(5)
    check_packed(bestfit.pack_best_fit(docs, BPE).toPandas(), [tuple(r) for r in docs.collect()], 1024, 2)


def test_packing_edges(spark, edge, empty):
    got = bestfit.pack_best_fit(edge, BPE, 64, 9).toPandas()
    check_packed(got, [(r.doc_id, r.text) for r in edge.collect()], 64, 9)
    assert (got.groupby("doc_id").apply(lambda g: (g.sort_values("piece")["start"] == np.concatenate([[0], g.sort_values("piece")["length"].cumsum()[:-1]])).all(), include_groups=False)[[4, 6]]).all()
    assert bestfit.pack_best_fit(empty, BPE).count() == 0
    with pytest.raises(ValueError):
        bestfit.pack_best_fit(edge, BPE, 0)


def plain_whitening(rows, most=16):
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in map(float, v)] for _, v in rows]
    fit = np.array(sorted({tuple(v) for v in x}), dtype=object)
    n, s = len(fit), fit.sum(axis=0)
    dev = [sum((n * a - b) ** 2 for a, b in zip(v, s)) for v in x]
    y = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(v, s)] for v in fit])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    k = min(most, int((e > 1e-10 * max(e[0], 1e-300)).sum()))
    own = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(v, s)] for v in x])
    return n, dev, own @ u[:, :k] / np.sqrt(e[:k]), e[:k] / np.trace(cov)


def check_whitened(got, rows, most=16):
    n, dev, w, share = plain_whitening(rows, most)
    assert len(got) == len(rows) * len(share) and set(got["n"]) <= {n}
    got = got.sort_values(["vec_id", "component"])
    ids = np.array([i for i, _ in rows])
    order = np.argsort(ids, kind="stable")
    assert got["deviation"].tolist() == [dev[k] for k in order for _ in share]
    table = got["whitened"].to_numpy().reshape(len(rows), len(share))
    for c in range(len(share)):
        sign = np.sign(table[:, c] @ w[order, c])
        assert np.allclose(table[:, c] * sign, w[order, c], rtol=0, atol=1e-7)
    assert np.allclose(got["explained"].to_numpy().reshape(len(rows), -1), share, rtol=1e-9) and got["identity_error"].max() < 1e-9 and got["identity_error"].nunique() == 1


def test_whitening_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").repartition(6)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    check_whitened(whitening.whiten(df).toPandas(), rows)


def test_whitening_of_correlated_vectors(spark):
    """Steep and clustered spectra, copies, and a direction without variance."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) * np.array([50, 20, 20, 20, 3, 3, 1, 1, 1, 0.5, 0.2, 0]) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    x[:, 5] = 2.0
    x[200:300] = x[200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    check_whitened(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 9).toPandas(), rows, 9)


def test_whitening_of_few_and_broken_vectors(spark):
    schema = "vec_id long, embedding array<double>, _v int, x int"
    bad = [(7, None, 0, 0), (8, [1.0, None], 0, 0), (9, [float("nan"), 1.0], 0, 0), (10, [float("inf"), 1.0], 0, 0), (11, [1.0, 2.0, 3.0], 0, 0), (12, [1e300, 1.0], 0, 0), (13, [], 0, 0)]
    good = [(1, [1.0, 0.0], 0, 0), (1, [1.0, 0.0], 0, 0), (2, [2.0, 0.0], 0, 0), (3, [4.0, 0.0], 0, 0)]
    got = whitening.whiten(spark.createDataFrame(good + bad, schema)).toPandas()
    assert got["component"].tolist() == [1] * 4 and set(got["vec_id"]) == {1, 2, 3}  # one direction only
    check_whitened(got, [(i, v) for i, v, _, _ in good])
    alike = spark.createDataFrame([(i, [1.0, 1.0], 0, 0) for i in range(5)], schema)
    assert whitening.whiten(alike).count() == 0 and whitening.whiten(spark.createDataFrame(bad[:3], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], schema)).columns == [c.split()[0] for c in whitening.OUT.split(", ")]
    huge = whitening.whiten(spark.createDataFrame([(1, [1e12], 0, 0), (2, [-1e12], 0, 0), (None, [0.0], 0, 0)], schema)).toPandas()
    assert huge["deviation"].isna().sum() == 2 and len(huge) == 3


@pytest.mark.parametrize("n", [1, 2, 9, 40])
def test_feast_against_eigh(n):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.normal(size=(n, n)))
    values = np.sort(np.where(rng.random(n) < 0.4, 5.0, rng.uniform(0.1, 10, n)))[::-1]
    a = q @ np.diag(values) @ q.T
    d, o = whitening.tridiagonal((a + a.T) / 2)
    assert whitening.inertia(d, o, np.array([0.05, 4.9, 5.1, 11])).tolist() == [int((values < s).sum()) for s in (0.05, 4.9, 5.1, 11)]
    assert np.allclose(whitening.spectrum(d, o), values, rtol=1e-9)
    parts = whitening.intervals((a + a.T) / 2, n)
    found = [whitening.feast((a + a.T) / 2, *p) for p in parts]
    assert sum(p[2] for p in parts) == n and np.allclose(np.concatenate([e for e, _ in found]), values, rtol=1e-12)
    u = np.hstack([u for _, u in found])
    assert np.allclose(u.T @ u, np.eye(n), atol=1e-9) and np.allclose(a @ u, u * np.concatenate([e for e, _ in found]), atol=1e-11)
    with pytest.raises(ArithmeticError):
        whitening.feast((a + a.T) / 2, parts[0][0], parts[0][1], parts[0][2] + 1)


def plain_collocations(rows, least=10, kept=2000):
    f: dict[str, Counter] = {}
    for lang, text in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(rb"[.,;:!?\n-\r]", (text or "").encode().lower()):
            w = re.findall(rb"[^ \t]+", piece)
            for k in (1, 2, 3):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in f.items():
        n, found = sum(v for p, v in own.items() if len(p) == 1), []
        for p, a in own.items():
            if len(p) < 2 or a < least or len(p) == 2 and any(len(q) == 3 and v >= least and 100 * v >= 50 * a and p in (q[:2], q[1:]) for q, v in own.items()):
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, b" ".join(p), own[p[:k]], own[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:kept], 1)]
    return sorted(out)


def test_collocations_of_small_texts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [("en", "New York City, new york! " + " ".join(rng.choice(["a", "b", "Ñ", "c d", "e"], 30))) for _ in range(60)]
    texts += [("fr", "r s t r s t r s t\tr. a ring: b a ring b"), ("fr", None), (None, "x y z " * 40), ("", "one two;  three  "), ("de", " \n ")] * 12
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "key long, text string, lang string").repartition(5)
    want = plain_collocations(texts)
    assert sorted(map(tuple, collocation.collocations(docs).collect())) == want and {r[0] for r in want} == {"en", "fr", "und", ""}
    # small tables of words and edges only change how often a task passes its graphs on
    for name, value in (("CHUNK", 7), ("MOST_WORDS", 3), ("MOST_EDGES", 5)):
        monkeypatch.setattr(collocation, name, value)
    assert sorted(map(tuple, collocation.collocations(docs).collect())) == want


def test_unary_paths(spark):
    """Chains, forks, rings, a loop, and a path over several stretches."""
    chain = [f"w{k} w{k + 1} w{k + 2}" for k in range(3000)]
    ring = ["a b c", "b c a", "c a b"]
    edges = [("x", p, 10 + i % 3) for i, p in enumerate(chain)] + [("x", p, 7) for p in ring] + [("x", "o o o", 5), ("x", "f g h", 4), ("x", "f g i", 4), ("y", "a b c", 3)]
    df = spark.createDataFrame(edges, "lang string, phrase string, f long")
    paths = collocation.unary_paths(df)
    assert sorted(map(tuple, collocation.edges_of(paths).collect())) == sorted(edges)
    rows = paths.collect()
    long = sorted((r for r in rows if r.path == chain[0]), key=lambda r: r.part)
    assert [len(r.weights) for r in long] == [1024, 1024, 952] and long[0].phrase.startswith("w0 w1 w2 w3 ")
    assert {r.phrase for r in rows if r.lang == "x" and r.path != chain[0]} == {"a b c a b", "o o o", "f g h", "f g i"}


def test_collocations_on_edges(spark, edge, empty):
    assert collocation.collocations(empty).count() == 0
    got = collocation.collocations(edge.drop("lang").withColumn("lang", F.lit(None).cast("string"))).collect()
    assert sorted(map(tuple, got)) == plain_collocations([(None, r.text) for r in edge.collect()])


def test_sql_of_collocations(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({collocation.SQL})").fetchall()
    assert sorted(want) == sorted(map(tuple, collocation.run(spark, SF).collect()))
