"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geohealth.llm.common import crc_bucket, discard, labelled_rows, materialize

#: ASCII but digits and letters to spaces; bytes beyond ASCII belong to words.
APART = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Words of a window and the step to the next; at most so many labelled rows are learned from.
WINDOW, STEP, SAMPLE = 40, 20, 4000
#: Learned vectors: of hashed words and of hashed runs of CHARS characters, and the rate at which they learn.
CHARS, WORD_SLOTS, CHAR_SLOTS, WIDTH, RATE = 5, 1 << 16, 1 << 15, 8, 0.002
#: Character n-grams of the evidence, its slots; inputs of a word (two vectors and its evidence), states of a direction.
GRAMS, SLOTS, INPUTS, HIDDEN, FOLDS = (4, 6), 1 << 18, 2 * WIDTH + 1, 8, 4
#: Windows that the network learns from at a time.
BATCH = 256
#: Words that a task keeps the inputs of.
KEPT = 300_000


def hashed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slots of whole words, slots of the character n-grams that begin at each byte (a row for CHARS and for each of GRAMS; 0: none), starts, lengths."""
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    data = np.frombuffer(b"".join(b"^" + w + b"$" for w in words) + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
    end = np.repeat(starts + lengths, lengths)
    n, at, grams = len(end), np.arange(len(end)), []
    for order in (CHARS, *GRAMS):
        value = data[:n].copy()
        for k in range(1, order):
            value = value * np.uint32(257) + data[k : n + k]
        slot = ((value * np.uint32(2654435761)) >> np.uint32(14)).astype(np.int64)
        grams.append(np.where(at + order <= end, slot % (SLOTS - 1) + 1, 0))
    place = np.uint32(1) + (at - np.repeat(starts, lengths)).astype(np.uint32)
    mixed = (data[:n] + np.uint32(7)) * (place * np.uint32(2246822519) ^ np.uint32(3266489917))
    whole = np.add.reduceat(mixed.astype(np.uint64), starts) if len(words) else np.zeros(0, dtype=np.uint64)
    return (whole * np.uint64(11400714819323198485) >> np.uint64(46)).astype(np.int64) % SLOTS, np.array(grams), starts, lengths


def evidence(sets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """For each slot, how many standard errors the log odds of its documents being toxic are off the average."""
    count = np.zeros((2, SLOTS))
    for s, y in zip(sets, labels):
        count[y, s] += 1
    n = np.bincount(labels, minlength=2)
    odds = np.log((count[1] + 0.5) / (n[1] + 1)) - np.log((count[0] + 0.5) / (n[0] + 1))
    z = odds / np.sqrt(1 / (count[1] + 0.5) + 1 / (count[0] + 0.5))
    return np.where(count.sum(axis=0) > 1, z / 4, 0).clip(-1, 3).astype("f4")


@dataclass
class Vectors:
    """Learned vectors of hashed words and of hashed runs of characters."""

    words: np.ndarray
    chars: np.ndarray


def fresh_vectors(rng: np.random.Generator) -> Vectors:
    return Vectors(*[rng.normal(0, 0.1, (n, WIDTH)).astype("f4") for n in (WORD_SLOTS, CHAR_SLOTS)])


class Spelled:
    """Distinct words with their slots; a word's characters are the runs from its first byte on."""

    def __init__(self, words: list[bytes]) -> None:
        self.whole, grams, self.starts, self.lengths = hashed(words)
        self.runs, self.grams = grams[0] % CHAR_SLOTS, grams[1:]
        self.count = np.maximum(self.lengths - (CHARS - 1), 1)

    def evidence(self, by_word: np.ndarray, by_gram: np.ndarray) -> np.ndarray:
        """Sum of the evidence of each word and that of its strongest n-gram of each order."""
        tops = [np.maximum.reduceat(np.where(g > 0, by_gram[g], 0), self.starts) for g in self.grams]
        return (by_word[self.whole] + sum(tops)).astype("f4")

    def places(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of these words the slots of all their runs, and where each word's begin among them."""
        n = self.count[some]
        begins = np.cumsum(n) - n
        return self.runs[np.repeat(self.starts[some] - begins, n) + np.arange(n.sum())], begins

    def vectors(self, learned: Vectors, some: np.ndarray) -> np.ndarray:
        runs, begins = self.places(some)
        chars = np.add.reduceat(learned.chars[runs], begins, axis=0) / self.count[some][:, None]
        return np.concatenate([learned.words[self.whole[some] % WORD_SLOTS], chars], axis=1).astype("f4")


def inputs(words: list[bytes], model: "Model") -> np.ndarray:
    """A row for each word: its learned vector, the mean of those of its characters, and its evidence."""
    if not words:
        return np.zeros((0, INPUTS), dtype="f4")
    spelled = Spelled(words)
    return np.concatenate([spelled.vectors(model.vectors, np.arange(len(words))), spelled.evidence(model.by_word, model.by_gram)[:, None]], axis=1)


@dataclass
class Model:
    by_word: np.ndarray
    by_gram: np.ndarray
    vectors: Vectors
    net: dict[str, np.ndarray]
    slope: float
    offset: float


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def fresh(rng: np.random.Generator) -> dict[str, np.ndarray]:
    net = {}
    for d in "fb":
        net[f"W{d}"] = rng.normal(0, 0.5, (INPUTS, 3 * HIDDEN))
        net[f"U{d}"] = rng.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        net[f"c{d}"] = np.zeros(3 * HIDDEN)
    net["v"], net["w"], net["b"] = rng.normal(0, 0.3, 2 * HIDDEN), rng.normal(0, 0.5, 2 * HIDDEN), np.full(1, -1.0)
    return {k: a.astype("f4") for k, a in net.items()}


def run_gru(proj: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States over time of both directions. proj: inputs' part of the gates (time, direction, windows, 3 * HIDDEN), u: (direction,
    HIDDEN, 3 * HIDDEN), mask: (time, direction, windows, 1); the second direction's time runs from the end."""
    steps, _, n, _ = proj.shape
    h, out = np.zeros((2, n, HIDDEN), dtype=proj.dtype), np.empty((steps, 2, n, HIDDEN), dtype=proj.dtype)
    for t in range(steps):
        hu, p = h @ u, proj[t]
        gates = sigmoid(p[..., : 2 * HIDDEN] + hu[..., : 2 * HIDDEN])
        z, r, hn = gates[..., :HIDDEN], gates[..., HIDDEN:], hu[..., 2 * HIDDEN :]
        c = np.tanh(p[..., 2 * HIDDEN :] + r * hn)
        if keep is not None:
            keep.append((h, z, r, c, hn))
        h = h + (1 - z) * (c - h) * mask[t]
        out[t] = h
    return out


def both_ways(f: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Two arrays over time as directions of one; the second turned round."""
    return np.stack([f, b[::-1]], axis=1)


def forward(net: dict, proj: dict[str, np.ndarray], mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows: both directions, attention over time, and a linear layer."""
    out = run_gru(both_ways(proj["f"], proj["b"]), np.stack([net["Uf"], net["Ub"]]), both_ways(mask, mask), None if keep is None else keep.setdefault("steps", []))
    h = np.concatenate([out[:, 0], out[::-1, 1]], axis=2)
    a = np.where(mask[:, :, 0] > 0, h @ net["v"], np.float32(-1e9))
    a = np.exp(a - a.max(axis=0))
    a *= mask[:, :, 0]
    a /= np.maximum(a.sum(axis=0), np.float32(1e-9))
    pooled = np.einsum("tn,tnh->nh", a, h)
    if keep is not None:
        keep |= {"h": h, "a": a, "pooled": pooled}
    return pooled @ net["w"] + net["b"]


def gradients(net: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted log loss by the network's weights and, as "x", by its inputs: back-propagation through time."""
    keep: dict = {}
    logit = forward(net, {d: x @ net[f"W{d}"] + net[f"c{d}"] for d in "fb"}, mask, keep)
    dl = weight * (sigmoid(logit) - y)
    h, a, pooled = keep["h"], keep["a"], keep["pooled"]
    g = {"w": pooled.T @ dl, "b": dl.sum(keepdims=True)}
    dp = dl[:, None] * net["w"]
    da = np.einsum("tnh,nh->tn", h, dp)
    ds = a * (da - (a * da).sum(axis=0))
    g["v"] = np.einsum("tn,tnh->h", ds, h)
    dh_all = a[:, :, None] * dp[None] + ds[:, :, None] * net["v"]
    part, masks = both_ways(dh_all[:, :, :HIDDEN], dh_all[:, :, HIDDEN:]), both_ways(mask, mask)
    u = np.stack([net["Uf"], net["Ub"]])
    turned, dh = u.transpose(0, 2, 1), np.zeros(part.shape[1:], dtype=part.dtype)
    gates, du = np.empty((*part.shape[:3], 3 * HIDDEN), dtype=part.dtype), np.zeros_like(u)
    for t in range(len(part) - 1, -1, -1):
        h0, z, r, c, hn = keep["steps"][t]
        dh = dh + part[t]
        step = dh * masks[t]
        dc = step * (1 - z) * (1 - c * c)
        gates[t, ..., :HIDDEN], gates[t, ..., HIDDEN : 2 * HIDDEN], gates[t, ..., 2 * HIDDEN :] = -step * (c - h0) * z * (1 - z), dc * hn * r * (1 - r), dc
        back = np.concatenate([gates[t, ..., : 2 * HIDDEN], dc * r], axis=2)
        du += h0.transpose(0, 2, 1) @ back
        dh = dh - step * (1 - z) + back @ turned
    ways = {"f": gates[:, 0], "b": gates[::-1, 1]}
    for k, (d, own) in enumerate(ways.items()):
        g |= {f"W{d}": np.einsum("tni,tnj->ij", x, own, optimize=True), f"U{d}": du[k], f"c{d}": own.sum(axis=(0, 1))}
    g["x"] = sum(own @ net[f"W{d}"].T for d, own in ways.items())
    return g


def windows(n: int) -> list[int]:
    """Starts of the overlapping windows over n words; the last one reaches the end."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STEP), n - WINDOW]


def laid_out(ids: np.ndarray, starts: list[int]) -> np.ndarray:
    """Word numbers by window, -1 beyond the text."""
    padded = np.concatenate([ids, np.full(max(0, WINDOW - len(ids)), -1, dtype=np.int64)])
    return padded[np.array(starts)[:, None] + np.arange(WINDOW)[None]]


def tokens(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(APART).split()


def train(rows: list[tuple[str, int]], epochs: int = 6, seed: int = 3) -> Model:
    """The network and the vectors of words and characters learn from windows, most of them where the evidence is.

    While they learn, a row's evidence is that of the other folds, so that it is no surer of it than it can be of new rows;
    afterwards it is that of all rows. Half of the words lose their own vector in each step, so that characters and
    neighbours count. The network's weights are running means of the last steps.
    """
    rng = np.random.default_rng(seed)
    labels, number = np.array([y for _, y in rows], dtype=np.int64), Numbers()
    ids = [np.array(list(map(number.__getitem__, tokens(t))), dtype=np.int64) for t, _ in rows]
    fold = rng.permutation(len(rows)) % FOLDS
    words, learned_vectors = number.names, fresh_vectors(rng)
    if not words or len(set(labels.tolist())) < 2:
        flat = np.zeros(SLOTS, dtype="f4")
        base = float(np.clip(labels.mean() if len(labels) else 0.0, 0.01, 0.99))
        return Model(flat, flat, learned_vectors, fresh(rng), 0.0, float(np.log(base / (1 - base))))
    spelled = Spelled(words)
    of_word = np.repeat(np.arange(len(words)), spelled.lengths)
    order = np.concatenate([np.unique(np.stack([of_word, g]), axis=1) for g in spelled.grams], axis=1)
    order = order[:, order[1] > 0]
    order = order[:, np.argsort(order[0], kind="stable")]
    cut = np.searchsorted(order[0], np.arange(len(words) + 1))
    gram_set = lambda d: np.unique(np.concatenate([order[1][cut[w] : cut[w + 1]] for w in np.unique(d)] or [np.zeros(0, np.int64)])).astype(np.int32)
    seen = [np.unique(spelled.whole[d]).astype(np.int32) for d in ids], [gram_set(d) for d in ids]

    def learned(some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(evidence([s[i] for i in some], labels[some]) for s in seen)

    # the numbers of a fold's words follow those of the folds before it
    hint = np.concatenate([*[spelled.evidence(*learned(np.flatnonzero(fold != f))) for f in range(FOLDS)], np.zeros(1, dtype="f4")])
    laid_all = [laid_out(d + f * len(words), windows(len(d))) for d, f in zip(ids, fold)]
    laid_all = [np.where(w < 0, FOLDS * len(words), w) for w in laid_all]
    none = FOLDS * len(words)
    picks, ys = [], []
    for laid, label in zip(laid_all, labels):
        best = np.argsort(-hint[laid].max(axis=1), kind="stable")[: 1 if label else 2]
        take = set(best.tolist()) | (set() if label else {int(rng.integers(len(laid)))})
        picks += [laid[k] for k in take]
        ys += [label] * len(take)
        # pieces of the text around its strongest word, which stands anywhere in them
        for lo in rng.integers(0, WINDOW, 2):
            piece = laid[best[0]]
            at = int(hint[piece].argmax())
            first, upto = max(0, at - int(lo)), at + 1 + int(rng.integers(0, WINDOW))
            part = piece[first:upto]
            picks.append(np.concatenate([part, np.full(WINDOW - len(part), none, dtype=np.int64)]))
            ys.append(label)
    laid, y = np.array(picks), np.array(ys, dtype="f4")
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    net, step = fresh(rng), 0
    state = {k: [np.zeros_like(a), np.zeros_like(a)] for k, a in net.items()}
    sums = [np.full((n, 1), 1e-6, dtype="f4") for n in (WORD_SLOTS, CHAR_SLOTS)]
    for _ in range(epochs):
        deal = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            b = deal[at : at + BATCH]
            used, back = np.unique(laid[b].T, return_inverse=True)
            some = used[used < none] % len(words)
            x = np.zeros((len(used), INPUTS), dtype="f4")
            x[: len(some), : 2 * WIDTH] = spelled.vectors(learned_vectors, some) if len(some) else 0
            keep = rng.random(len(some)) > 0.5
            x[: len(some), :WIDTH] *= keep[:, None]
            x[: len(some), -1] = hint[used[: len(some)]]
            back = back.reshape(laid[b].T.shape)
            mask = (laid[b].T < none).astype("f4")[:, :, None]
            g = gradients(net, x[back], mask, y[b], (weight[b] / len(b)).astype("f4"))
            step += 1
            for k, (m, v) in state.items():
                m += 0.1 * (g[k] - m)
                v += 0.001 * (g[k] ** 2 - v)
                net[k] = (net[k] - 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype("f4")
            mean = {k: mean[k] + (a - mean[k]) * max(0.02, 1 / step) for k, a in net.items()} if step > 1 else dict(net)
            if len(some):
                dx = _added(back, g["x"], len(x))
                runs, _ = spelled.places(some)
                spread = np.repeat(dx[: len(some), WIDTH : 2 * WIDTH] / spelled.count[some][:, None], spelled.count[some], axis=0)
                _descend(learned_vectors.words, sums[0], spelled.whole[some] % WORD_SLOTS, dx[: len(some), :WIDTH] * keep[:, None])
                _descend(learned_vectors.chars, sums[1], runs, spread)
    net = {k: a.astype("f4") for k, a in mean.items()}
    del order, of_word, laid, picks
    vectors, top = spelled.vectors(learned_vectors, np.arange(len(words))), np.zeros(len(rows), dtype="f4")
    for f in range(FOLDS):  # one fold's words at a time
        some = np.flatnonzero(fold == f)
        if not len(some):
            continue
        x = np.concatenate([vectors, hint[f * len(words) : (f + 1) * len(words), None]], axis=1)
        proj = {d: np.concatenate([x @ net[f"W{d}"] + net[f"c{d}"], np.zeros((1, 3 * HIDDEN), dtype="f4")]) for d in "fb"}
        every = np.concatenate([laid_all[i] for i in some])
        logit = score_windows(net, proj, np.where(every == none, -1, every - f * len(words)))
        top[some] = np.maximum.reduceat(logit, np.cumsum([0, *[len(laid_all[i]) for i in some]])[:-1])
    return Model(*learned(np.arange(len(rows))), learned_vectors, net, *calibrate(top, labels))


def _added(at: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the values (their last axis kept) that go to the same row."""
    at, values = at.reshape(-1), values.reshape(-1, values.shape[-1])
    return np.stack([np.bincount(at, values[:, k], rows) for k in range(values.shape[1])], axis=1).astype("f4")


def _descend(table: np.ndarray, sums: np.ndarray, rows: np.ndarray, grad: np.ndarray, rate: float = RATE) -> None:
    """A step against the gradients of some rows of a table, by the size of all that each row has had so far."""
    used, back = np.unique(rows, return_inverse=True)
    g = _added(back, grad, len(used))
    sums[used] += (g * g).mean(axis=1, keepdims=True)
    table[used] -= rate * g / np.sqrt(sums[used]) + 1e-3 * table[used]


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic fit of the labels to the documents' highest logits."""
    a, c = np.stack([x, np.ones_like(x)], axis=1).astype("f8"), np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ c, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        c = c - np.clip(np.linalg.solve(h, a.T @ (p - y) + 1e-2 * (c - [1.0, 0.0])), -2, 2)
    return float(c[0]), float(c[1])


def score_windows(net: dict, proj: dict[str, np.ndarray], laid: np.ndarray) -> np.ndarray:
    """Logits of windows of word numbers; proj holds each word's part of the gates, the last row no word's."""
    out = []
    for at in range(0, len(laid), 1024):
        part = laid[at : at + 1024].T
        out.append(forward(net, {d: p[part] for d, p in proj.items()}, (part >= 0).astype("f4")[:, :, None]))
    return np.concatenate(out)


class Numbers(dict):
    """word -> its number, in the order of appearance."""

    def __init__(self) -> None:
        self.names: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.names)
        self.names.append(word)
        return n


class Scorer:
    """A task's model with the words it has met."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number, self.done = Numbers(), 0
        self.proj = {d: np.zeros((1, 3 * HIDDEN), dtype="f4") for d in "fb"}

    def _learn(self) -> None:
        names, net = self.number.names, self.model.net
        if len(names) >= len(self.proj["f"]):  # room for the words and a last row that stands for none
            self.proj = {d: np.concatenate([p[: self.done], np.zeros((len(names) * 3 // 2 + 1 - self.done, p.shape[1]), dtype="f4")]) for d, p in self.proj.items()}
        while self.done < len(names):
            x = inputs(names[self.done : self.done + 20_000], self.model)
            for d, p in self.proj.items():
                p[self.done : self.done + len(x)] = x @ net[f"W{d}"] + net[f"c{d}"]
            self.done += len(x)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """Scores: the calibrated highest logit of a text's windows."""
        if len(self.number) > KEPT:
            self._forget()
        number = self.number.__getitem__
        ids = [np.array(list(map(number, tokens(t))), dtype=np.int64) for t in texts]
        self._learn()
        starts = [windows(len(d)) for d in ids]
        laid = np.concatenate([laid_out(d, s) for d, s in zip(ids, starts)])
        logit = score_windows(self.model.net, self.proj, laid)
        top = np.maximum.reduceat(logit, np.concatenate([[0], np.cumsum([len(s) for s in starts])[:-1]]))
        return 1 / (1 + np.exp(-np.clip(self.model.slope * top.astype("f8") + self.model.offset, -50, 50)))


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


def trained(rows: DataFrame) -> Model:
    """train() over rows of text and label, in a task of an executor: only the model comes back. A lost executor costs a new start."""
    import pickle

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(t, y) for b in batches for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        yield pa.record_batch([pa.array([pickle.dumps(train(found))], pa.binary())], names=["model"])

    one = rows.coalesce(1)  # the sample's bound is that of this task
    got = one.mapInArrow(work, "model binary").first()
    return pickle.loads(got[0]) if got else train([])  # a table without rows may have no task


def score(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0, sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1), predicted.

    At most `sample` labelled rows outside of the held-out ids (16 million characters) are learned from; whole texts are scored, by the highest
    of all their overlapping windows, each of WINDOW words and half of them shared with the next. Null and empty texts are one empty window. Null ids are scored like others;
    repeated rows come out repeatedly. Without labels of both kinds the score is the share of toxic rows. An empty table
    gives an empty result; other columns are ignored.
    """
    rows = materialize(labelled_rows(docs, labels, "toxic", modulus, held_out, sample), "toxic-sample")
    shared = docs.sparkSession.sparkContext.broadcast(trained(rows))
    discard(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            found = [scorer(block) for block in blocks(t.as_py() for t in b.column("text"))]
            s = np.concatenate(found) if found else np.zeros(0)
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype("int32"))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", (crc_bucket(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int")


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
