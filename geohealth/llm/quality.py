"""Quality: a linear-chain conditional random field over the lines of a document."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geohealth.llm.common import crc_bucket, labelled_sample, unused

#: At most so many labelled rows are learned from; features of a line; share of the marginals above which a document is good.
SAMPLE, FEATURES, THRESHOLD = 2000, 16, 0.7
_KINDS = ("upper", "lower", "digit", "mark", "beyond")
_CLASS = np.array([0 if 65 <= b <= 90 else 1 if 97 <= b <= 122 else 2 if 48 <= b <= 57 else 4 if b >= 128 else 5 if b <= 32 else 3 for b in range(256)], dtype=np.uint8)


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row of features for each line of each text, the first line of each text, and the lines' UTF-8 lengths."""
    data = np.frombuffer("".join((t or "").replace("\0", " ") + "\0" for t in texts).encode("utf-8", "replace"), dtype=np.uint8)
    final = data == 0  # ends of texts, as of lines
    stops = np.flatnonzero((data == 10) | final)
    begins = np.concatenate([[0], stops[:-1] + 1])
    length = stops - begins
    first = np.concatenate([[0], np.flatnonzero(final[stops])[:-1] + 1])
    doc = np.repeat(np.arange(len(texts)), np.diff(np.concatenate([first, [len(stops)]])))
    kind = _CLASS[data]
    count = {k: np.add.reduceat((kind == i).astype(np.int32), begins) for i, k in enumerate(_KINDS)}
    # words
    solid = kind != 5
    heads = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    tails = np.flatnonzero(solid & ~np.concatenate([solid[1:], [False]])) + 1
    line = np.searchsorted(stops, heads)
    size = tails - heads
    words = np.bincount(line, minlength=len(stops))
    out = np.zeros((len(stops), FEATURES), dtype="f4")
    per = np.maximum(words, 1)
    if len(heads):
        place = (np.arange(len(data)) - np.repeat(np.concatenate([[0], heads]), np.diff(np.concatenate([[0], heads, [len(data)]])))).astype(np.uint32)
        mixed = np.where(solid, (data.astype(np.uint32) + np.uint32(7)) * ((place + np.uint32(1)) * np.uint32(2246822519) ^ np.uint32(3266489917)), 0)
        code = np.add.reduceat(mixed.astype(np.uint64), heads) * np.uint64(11400714819323198485)
        of = lambda x: np.bincount(line, weights=x, minlength=len(stops))
        last, before = data[tails - 1], data[np.maximum(tails - 2, 0)]
        out[:, 8] = of((size > 2) & (last == before) & (kind[tails - 1] == 3)) / per
        again = np.concatenate([[False], (code[1:] == code[:-1]) & (line[1:] == line[:-1])])
        out[:, 9] = of(again) / per
        pair = _distinct(line, code)
        out[:, 10] = (words > 0) * (1 - np.bincount(pair, minlength=len(stops)) / per)
        out[:, 11] = of(size <= 3) / per
        out[:, 12] = of((size == 1) & (kind[heads] == 3)) / per
        whole = of((code >> np.uint64(20)).astype("f8") % 1e9)
        out[:, 2] = of(size) / per / 10
    else:
        whole = np.zeros(len(stops))
    letters = np.maximum(count["upper"] + count["lower"] + count["beyond"], 1)
    filled = np.maximum(length, 1)
    out[:, 0] = np.log1p(length) / 5
    out[:, 1] = np.log1p(words) / 4
    out[:, 3] = count["upper"] / letters
    out[:, 4] = count["digit"] / filled
    out[:, 5] = count["mark"] / filled
    out[:, 6] = count["beyond"] / filled
    out[:, 7] = (length > 0) & np.isin(data[np.maximum(stops - 1, 0)], np.frombuffer(b".!?:;", dtype=np.uint8))
    _, at, times = np.unique(np.stack([doc, whole, length], axis=1), axis=0, return_inverse=True, return_counts=True)
    out[:, 13] = np.log1p((times[at.reshape(-1)] - 1) * (length > 0))
    out[:, 14] = length == 0
    out[:, 15] = 1
    return out, first, length


def _distinct(line: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The line of every distinct (line, code)."""
    order = np.lexsort((code, line))
    l, c = line[order], code[order]
    return l[np.concatenate([[True], (l[1:] != l[:-1]) | (c[1:] != c[:-1])])]


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features with those of the lines before and after it in its text (zeros beyond)."""
    prev, after = np.zeros_like(x), np.zeros_like(x)
    prev[1:], after[:-1] = x[:-1], x[1:]
    prev[first] = 0
    after[np.concatenate([first[1:] - 1, [len(x) - 1]])] = 0
    return np.concatenate([x, prev, after], axis=1)


@dataclass
class Field:
    """Weights of the evidence for a good line, log potentials of (label, next label), and the calibration."""

    w: np.ndarray
    t: np.ndarray
    slope: float = 1.0
    offset: float = 0.0


def marginals(e: np.ndarray, first: np.ndarray, t: np.ndarray, pairs: bool = False):
    """P(good) of every line by forward-backward in log space; with pairs, also the expected counts of (label, next label).

    e: log odds of a line's evidence. Texts of about the same number of lines are worked on together.
    """
    ends = np.concatenate([first[1:], [len(e)]])
    n = ends - first
    good, expected = np.empty(len(e)), np.zeros((2, 2))
    order, at = np.argsort(n, kind="stable"), 0
    while at < len(order):
        upto = at + 1
        while upto < len(order) and (upto - at) * n[order[upto]] < 100_000 and n[order[upto]] <= 2 * n[order[at]] + 4:
            upto += 1
        docs = order[at:upto]
        at = upto
        steps = int(n[docs].max())
        place = first[docs][:, None] + np.minimum(np.arange(steps)[None], n[docs][:, None] - 1)
        live = np.arange(steps)[None] < n[docs][:, None]
        own = np.stack([np.zeros(place.shape), e[place]])  # (label, text, step)
        a = np.empty((2, len(docs), steps))
        a[:, :, 0] = own[:, :, 0]
        for k in range(1, steps):
            into = np.logaddexp(a[0, :, k - 1][None] + t[0][:, None], a[1, :, k - 1][None] + t[1][:, None])
            a[:, :, k] = np.where(live[:, k], into + own[:, :, k], a[:, :, k - 1])
        b = np.zeros_like(a)
        for k in range(steps - 2, -1, -1):
            ahead = own[:, :, k + 1] + b[:, :, k + 1]
            back = np.logaddexp(t[:, 0][:, None] + ahead[0][None], t[:, 1][:, None] + ahead[1][None])
            b[:, :, k] = np.where(live[:, k + 1], back, b[:, :, k + 1])
        z = np.logaddexp(a[0, :, -1], a[1, :, -1])[:, None]
        p = np.exp(a[1] + b[1] - z)
        good[place[live]] = p[live]
        if pairs and steps > 1:
            for i in (0, 1):
                for j in (0, 1):
                    both = a[i, :, :-1] + t[i, j] + own[j, :, 1:] + b[j, :, 1:] - z
                    expected[i, j] += np.exp(both[live[:, 1:]]).sum()
    return (good, expected) if pairs else good


def weighted(good: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A document's mean marginal, by the lines' lengths (empty lines have a little weight)."""
    w = length + 0.01
    return np.add.reduceat(good * w, first) / np.add.reduceat(w, first)


def _fit(x: np.ndarray, first: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int) -> Field:
    """Maximum likelihood of the lines' labels (Adam); weight is of a line, and of a text through its first line."""
    w, t = np.zeros(x.shape[1]), np.zeros((2, 2))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    inner = np.ones(len(x), dtype=bool)
    inner[first] = False
    nxt = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[nxt - 1], y[nxt]), 1.0)
    for step in range(1, rounds + 1):
        good, expected = marginals(x @ w, first, t, pairs=True)
        gw = -(x.T @ ((y - good) * weight)) / weight.sum() + 1e-4 * w
        gt = -(seen - expected) / max(1, len(nxt)) + 1e-3 * t
        for p, g, m, v in ((w, gw, state[0], state[1]), (t, gt, state[2], state[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(w, t)


def train(rows: list[tuple[str, int]]) -> Field:
    """Lines first take their document's label; then lines of bad documents that look good are labelled good, and the fit is repeated."""
    y_doc = np.array([y for _, y in rows], dtype=np.int64)
    if len(set(y_doc.tolist())) < 2:
        base = float(np.clip(y_doc.mean() if len(y_doc) else 0.5, 0.01, 0.99))
        return Field(np.zeros(3 * FEATURES), np.zeros((2, 2)), 0.0, float(np.log(base / (1 - base))))
    parts = [line_features([t for t, _ in rows[at : at + 500]]) for at in range(0, len(rows), 500)]
    shift = np.cumsum([0] + [len(p[0]) for p in parts[:-1]])
    first = np.concatenate([p[1] + s for p, s in zip(parts, shift)])
    length = np.concatenate([p[2] for p in parts])
    x = with_neighbours(np.concatenate([p[0] for p in parts]), first).astype("f8")
    n = np.diff(np.concatenate([first, [len(x)]]))
    doc = np.repeat(np.arange(len(rows)), n)
    y = y_doc[doc]
    share = np.bincount(y_doc, minlength=2) / len(y_doc)
    weight = (0.5 / share)[y_doc][doc] / n[doc] ** 0.5
    field = _fit(x, first, y, weight, 45)
    good = marginals(x @ field.w, first, field.t)
    y = np.where((y_doc[doc] == 0) & (good > 0.7), 1, y)
    lost = np.bincount(doc, weights=y, minlength=len(rows)) == n  # a bad document keeps its worst line
    for d in np.flatnonzero(lost & (y_doc == 0)):
        y[first[d] + int(good[first[d] : first[d] + n[d]].argmin())] = 0
    field = _fit(x, first, y, weight, 45)
    mean = weighted(marginals(x @ field.w, first, field.t), first, length)
    return calibrated(field, mean, y_doc)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def calibrated(field: Field, mean: np.ndarray, y: np.ndarray, rounds: int = 50) -> Field:
    """Logistic fit of the documents' labels to the log odds of their mean marginals."""
    a, c = np.stack([logit(mean), np.ones(len(mean))], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ c, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        c = c - np.clip(np.linalg.solve(h, a.T @ (p - y) + 1e-2 * (c - [1.0, 0.0])), -2, 2)
    return Field(field.w, field.t, float(c[0]), float(c[1]))


def score_texts(field: Field, texts: list[str | None]) -> np.ndarray:
    x, first, length = line_features(texts)
    mean = weighted(marginals(with_neighbours(x, first) @ field.w, first, field.t), first, length)
    return 1 / (1 + np.exp(-(field.slope * logit(mean) + field.offset)))


def blocks(texts: Iterable, chars: int = 1_000_000) -> Iterator[list]:
    """Consecutive texts of at most so many characters together, or one longer text."""
    block, size = [], 0
    for t in texts:
        if block and size + len(t or "") > chars:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t or "")
    if block:
        yield block


def _scored(rows: DataFrame, field: Field, columns: str) -> DataFrame:
    """rows (with a text column that is dropped) and their score."""
    shared = rows.sparkSession.sparkContext.broadcast(field)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [score_texts(shared.value, block) for block in blocks(t.as_py() for t in b.column("text"))]
            rest = [n for n in b.schema.names if n != "text"]
            yield pa.record_batch([*[b.column(n) for n in rest], pa.array(np.concatenate(found) if found else np.zeros(0))], names=[*rest, "score"])

    return rows.mapInArrow(work, f"{columns}, score double")


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, held_out: int = 2, sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted.

    At most `sample` labelled rows outside of the held-out ids (16 million characters) are learned from. Every line of a text is labelled by the
    field, with the features of its neighbours; the marginals are averaged by length and calibrated. Null and empty texts
    are one empty line. Null ids are scored like others; repeated rows come out repeatedly. Without labels of both kinds
    the score is the share of good rows. An empty table gives an empty result; other columns are ignored.
    """
    field = train(labelled_sample(docs, labels, "quality", modulus, held_out, sample))
    rows = docs.select(F.col("doc_id").cast("long"), "text", (crc_bucket(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    return _scored(rows, field, "doc_id long, held_out boolean").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (all columns) whose text scores THRESHOLD at least. The score is added where the text is read; nothing is joined.

    Null and empty texts are scored as one empty line, whatever their id; repeated rows stay or go together. Very long
    texts are scored whole. An empty table gives an empty one, and without labels of both kinds the share of good rows
    decides on all.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    field = train(labelled_sample(docs, labels, "quality", 4, 2, SAMPLE))
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kept = unused(docs, "_score")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [score_texts(shared.value, block) for block in blocks(t.as_py() for t in b.column("text"))]
            s = np.concatenate(found) if found else np.zeros(0)
            yield pa.record_batch([*b.columns, pa.array(s)], names=[*b.schema.names, kept]).filter(pa.array(s >= THRESHOLD))

    return docs.mapInArrow(work, StructType([*docs.schema.fields, StructField(kept, DoubleType())])).select(*docs.columns)


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
