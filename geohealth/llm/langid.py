"""Language identification by error-correcting output codes over character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.llm.common import crc_bucket

#: Hashed n-grams of 1 to 3 bytes, each order in a table of its own.
ORDERS, SLOTS = (1, 2, 3), 1 << 12
#: Rows that are learned from, and their characters together; of a longer text its middle, of so many characters, is learned from.
SAMPLE, SAMPLE_CHARS, LONGEST = 2000, 4_000_000, 20_000
#: Letters and, beyond ASCII, numerals such as a superscript, which has_letter() tells apart.
LIKELY = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return any(m[0].isalpha() for m in LIKELY.finditer(text or ""))


@dataclass
class Coded:
    """Languages, their codewords (rows of -1 and 1) and the bits' linear classifiers."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # (slots of all orders, bits)
    bias: np.ndarray
    scale: np.ndarray = field(default_factory=lambda: np.ones(1))


def codewords(classes: int, seed: int = 5) -> np.ndarray:
    """Exhaustive codes for up to 5 classes; beyond, of many random codes the one with the largest least distance."""
    if classes <= 5:
        n = max(1, 2 ** (classes - 1) - 1)
        bits = [[1] * n] + [[1 if (c >> (classes - 1 - k)) & 1 else -1 for c in range(n)] for k in range(1, classes)]
        return np.array(bits, dtype="f8") if classes > 1 else np.ones((1, 1))
    rng, width, best, far = np.random.default_rng(seed), int(np.ceil(10 * np.log2(classes))), None, -1.0
    for _ in range(300):
        code = rng.choice([-1.0, 1.0], size=(classes, width))
        code = code[:, np.abs(code.sum(axis=0)) < classes]  # a bit on which all agree says nothing
        apart = (code.shape[1] - code @ code.T) / 2 + 1e9 * np.eye(classes)
        if apart.min() > far:
            best, far = code, apart.min()
    return best


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all n-grams of the texts, the start of each text's run for reduceat, and how many each has.

    Two spaces begin a text and one ends it, so that none of its n-grams reaches a letter of the next.
    """
    data = np.frombuffer(b"  " + b"   ".join(texts) + b"   ", dtype=np.uint8)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts)) + 3
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
    data[(data < 97) & (data != 32)] = 32  # digits, punctuation, line ends
    return data, starts, lengths


def slots(data: np.ndarray, order: int) -> np.ndarray:
    """The slot of the n-gram that begins at each byte (the last bytes take the place of missing ones)."""
    value = data.copy()
    for k in range(1, order):
        value *= 257
        value[:-k] += data[k:]
    value *= np.uint32(2654435761)
    return (value >> np.uint32(20)) + np.uint32(ORDERS.index(order) * SLOTS)


def features(texts: list[bytes]) -> np.ndarray:
    """Relative frequencies of the slots, a row for each text; for the bounded training sample."""
    out = np.zeros((len(texts), len(ORDERS) * SLOTS), dtype="f4")
    for i, t in enumerate(texts):
        data, _, n = grams([t])
        for order in ORDERS:
            out[i] += np.bincount(slots(data[: n[0] + 1], order)[: n[0]], minlength=out.shape[1]) / n[0]
    return out


def fit(rows: list[tuple[str, str]], rounds: int = 40) -> Coded:
    """Logistic classifiers of the code's bits, by full-batch Adam over (text, language) rows."""
    languages = sorted({lang for _, lang in rows})
    code = codewords(max(1, len(languages)))
    width = len(ORDERS) * SLOTS
    if len(languages) < 2:
        return Coded(languages, code, np.zeros((width, code.shape[1]), dtype="f4"), np.zeros(code.shape[1]))
    x = features([t.encode() for t, _ in rows])
    scale = 1.0 / (np.sqrt(np.einsum("ij,ij->j", x, x) / len(x)) + 1e-3)
    x *= scale
    y = code[[languages.index(lang) for _, lang in rows]]
    w, b = np.zeros((width, y.shape[1]), dtype="f4"), np.zeros(y.shape[1], dtype="f4")
    state = [np.zeros_like(a) for a in (w, w, b, b)]
    balance = np.array([1.0 / sum(lang == l for _, l in rows) for _, lang in rows], dtype="f4")
    balance = (balance / balance.sum())[:, None]
    for step in range(1, rounds + 1):
        margin = np.clip(y * (x @ w + b), -30, 30)
        g = -balance * y / (1 + np.exp(margin))
        for a, grad, m, v in ((w, x.T @ g + 1e-5 * w, state[0], state[1]), (b, g.sum(axis=0), state[2], state[3])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            a -= 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Coded(languages, code, (w * scale[:, None]).astype("f4"), b)


def margins(model: Coded, texts: list[bytes]) -> np.ndarray:
    """The bits' margins, a row for each text, over all its n-grams."""
    data, starts, n = grams(texts)
    end = int(starts[-1] + n[-1])
    total = np.zeros((len(texts), model.weights.shape[1]))
    for order in ORDERS:
        at = slots(data, order)[:end]
        for bit in range(model.weights.shape[1]):
            total[:, bit] += np.add.reduceat(model.weights[:, bit][at], starts, dtype="f8")
    return total / n[:, None] + model.bias


def decode(model: Coded, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of the least summed logistic loss (of equal ones the first), its share against the other classes, and whether the second is near."""
    loss = np.logaddexp(0, -np.clip(model.code[None] * margin[:, None, :], -50, 50)).sum(axis=2)
    share = np.exp(loss.min(axis=1, keepdims=True) - loss)
    share /= share.sum(axis=1, keepdims=True)
    second = np.sort(share, axis=1)[:, -2] if loss.shape[1] > 1 else np.zeros(len(loss))
    return loss.argmin(axis=1), share.max(axis=1), second > 0.5 * share.max(axis=1)


def training_rows(docs: DataFrame, modulus: int, held_out: int, rows: int = SAMPLE, chars: int = SAMPLE_CHARS, longest: int = LONGEST) -> list[tuple[str, str]]:
    """About `rows` (text, lang) rows, as many of each language as it has, up to its equal part and 20 at least.

    Every language of the training rows is found, however rare and however long its texts: of a text over `longest`
    characters its middle stands for it. Within a language the order is that of a hash; rows are taken in turn as long as
    they have `chars` together, and each language's first row in any case.
    """
    picked = docs.where(F.col("lang").isNotNull() & (crc_bucket(F.col("doc_id"), modulus) != held_out) & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    counts = picked.groupBy("lang").agg(F.count(F.lit(1)).alias("_all"))
    languages = counts.count()
    each = max(20, -(-rows // max(1, languages)))
    turn = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("_at", 11), "doc_id", "_th")
    keys = picked.select("lang", "doc_id", F.xxhash64("text").alias("_th"))
    # of a large language only the lowest hashes, some four times as many as are taken, meet in its window
    low = F.shiftrightunsigned("_at", 11) / F.lit(float(2**53)) < F.lit(4.0 * each + 100) / F.col("_all")
    keys = keys.withColumn("_at", F.xxhash64("doc_id")).join(F.broadcast(counts), "lang").where(low).drop("_all")
    ids = keys.withColumn("_turn", F.row_number().over(turn)).where(F.col("_turn") <= each).select("doc_id", "lang", "_th", "_turn").distinct()
    found = picked.withColumn("_th", F.xxhash64("text")).join(F.broadcast(ids), ["doc_id", "lang", "_th"])  # `each` rows of a language
    part = F.when(F.length("text") > longest, F.substring("text", F.floor((F.length("text") - longest) / 2).cast("int") + 1, F.lit(longest))).otherwise(F.col("text"))
    got, out, size = found.select("doc_id", "lang", "_th", "_turn", part.alias("text")).dropDuplicates(["doc_id", "lang", "_th", "_turn"]).orderBy("_turn", "lang").select("text", "lang", "_turn").collect(), [], 0
    for text, lang, turn in got:
        if turn == 1 or size + len(text) <= chars:
            out.append((text, lang))
            size += len(text)
    return out


def identify(docs: DataFrame, modulus: int = 3, held_out: int = 1, sample: int = SAMPLE, chars: int = SAMPLE_CHARS, longest: int = LONGEST) -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, ambiguous.

    The classifiers are fitted on about `sample` rows with a language (of `chars` characters together, and of a text
    at most `longest` from its middle), equally of all languages, outside of the held-out ids; each predicts a bit of the languages' codewords
    from all n-grams of a text. The language whose codeword has the least summed loss is chosen, of equally near ones the
    first by name; score is its share against the others, and a text whose second language has over half of that is
    ambiguous. A letter is what Unicode calls one: superscripts, fractions and other numerals aren't. Null texts and texts without a letter, and all texts if nothing could
    be learned, get `und` with score 0. Null ids are predicted like others; repeated rows come out repeatedly. An empty
    table gives an empty result; other columns are ignored.
    """
    model = fit(training_rows(docs, modulus, held_out, sample, chars, longest))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            lang, score, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            some = [i for i, t in enumerate(texts) if known.languages and has_letter(t)]
            while some:  # a bounded number of characters at a time
                take, size = 0, 0
                while take < len(some) and (not take or size + len(texts[some[take]]) < 2_000_000):
                    size += len(texts[some[take]])
                    take += 1
                now, some = some[:take], some[take:]
                own, share, near = decode(known, margins(known, [texts[i].encode() for i in now]))
                for i, c, s, n in zip(now, own, share, near):
                    lang[i], score[i], unsure[i] = known.languages[c], s, n
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", (crc_bucket(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    return identify(table(spark, sf_dir, "documents"))
