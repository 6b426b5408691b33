"""Language-model scores: the likelihood of a text over all segmentations of its words into subword pieces."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geohealth.llm.common import crc_bucket, materialize

MARK = "▁"
#: Words of at least this share of all tokens are looked up in each task: at most 1 / HOT_SHARE of them can exist.
HOT_SHARE = 2e-6
#: Words that a task counts before it hands them on.
COUNTED = 400_000
#: Columns of a word's scores: whether training has it, and log10 of its probability by the base, the lattice and the mixture.
SCORES = ["known", "base", "own", "mixed"]
#: Share of the vocabulary's own scores in the weights of the pieces; the rest is that of the expected counts in the corpus.
OWN = 0.5
#: Characters of a word whose expected counts are taken together.
COUNTED_CHARS = 2000


class Lattice:
    """Log probabilities of pieces that begin a word, of those that go on with it, of its end and of single bytes."""

    def __init__(self, first: dict[str, float], later: dict[str, float], byte: list[float], stop: float) -> None:
        self.first, self.later, self.byte, self.stop = first, later, byte, stop
        self.first_tree, self.later_tree = _tree(first), _tree(later)
        self.longest = max(map(len, [*first, *later]))

    def spell(self, text: str, i: int, begins: bool = True) -> list[tuple[int, float, str]]:
        """(to, log probability, piece) of all arcs from place i of a word with its mark; piece is empty for a character as bytes."""
        inside = i > 0 or not begins
        tree, n, j, out = self.later_tree if inside else self.first_tree, len(text), i, []
        while tree and j < n:
            node = tree.get(text[j])
            if node is None:
                break
            j += 1
            p, piece, tree = node
            if piece:
                out.append((j, p, piece))
        if inside and not (out and out[0][0] == i + 1):
            out.append((i + 1, self.as_bytes(text[i]), ""))
        return out

    def as_bytes(self, character: str) -> float:
        return sum(self.byte[b] for b in character.encode("utf-8", "replace"))

    def forward(self, word: str) -> float:
        """ln of the sum over all segmentations of the word, its end included. Only the last few places are kept."""
        text = MARK + word
        n, ring = len(text), self.longest + 1
        exp, log1p, inf = math.exp, math.log1p, -math.inf
        alpha: list[float] = [inf] * ring
        alpha[0] = 0.0
        top, later = self.first_tree, self.later_tree
        for i in range(n):
            here, tree, j, single = alpha[i % ring], top, i, not i
            alpha[i % ring] = inf  # the place of i + ring
            while tree and j < n:
                node = tree.get(text[j])
                if node is None:
                    break
                j += 1
                p, piece, tree = node
                if piece:
                    single = single or j == i + 1
                    v, w = here + p, alpha[j % ring]
                    alpha[j % ring] = v if w == inf else w + log1p(exp(v - w)) if w > v else v + log1p(exp(w - v))
            if not single:
                v, j = here + self.as_bytes(text[i]), i + 1
                w = alpha[j % ring]
                alpha[j % ring] = v if w == inf else w + log1p(exp(v - w)) if w > v else v + log1p(exp(w - v))
            top = later
        return alpha[n % ring] + self.stop

    def expect(self, word: str, count: float, counts: tuple[dict[str, float], dict[str, float]]) -> None:
        """Add `count` times the expected counts of pieces that begin the word, and of those that go on with it.

        A word is worked on in blocks of COUNTED_CHARS, so that a very long one takes no more memory than others.
        """
        text = MARK + word
        for at in range(0, len(text), COUNTED_CHARS):
            self._expect(text[at : at + COUNTED_CHARS], not at, count, counts)
        counts[True][""] = counts[True].get("", 0.0) + count

    def _expect(self, text: str, begins: bool, count: float, counts: tuple[dict[str, float], dict[str, float]]) -> None:
        n = len(text)
        arcs = [self.spell(text, i, begins) for i in range(n)]
        alpha, beta = [-math.inf] * (n + 1), [-math.inf] * n + [0.0]
        alpha[0] = 0.0
        exp, log1p, inf = math.exp, math.log1p, -math.inf
        for i in range(n):
            here = alpha[i]
            for j, p, _ in arcs[i]:
                v, w = here + p, alpha[j]
                alpha[j] = v if w == inf else w + log1p(exp(v - w)) if w > v else v + log1p(exp(w - v))
        total = alpha[n]
        for i in range(n - 1, -1, -1):
            here, ahead, into = alpha[i] - total, inf, counts[bool(i) or not begins]
            for j, p, piece in arcs[i]:
                v = p + beta[j]
                ahead = v if ahead == inf else ahead + log1p(exp(v - ahead)) if ahead > v else v + log1p(exp(ahead - v))
                weight = exp(here + v) * count
                if piece:
                    into[piece] = into.get(piece, 0.0) + weight
                else:
                    for b in text[i].encode("utf-8", "replace"):
                        into[f"<0x{b:02X}>"] = into.get(f"<0x{b:02X}>", 0.0) + weight
            beta[i] = ahead


def _tree(pieces: dict[str, float]) -> dict:
    """character -> (log probability, piece, what can follow); the piece is empty where none ends."""
    nodes: dict = {}
    for piece, p in pieces.items():
        at = nodes
        for c in piece[:-1]:
            at = at.setdefault(c, [0.0, "", {}])[2]
        at.setdefault(piece[-1], [0.0, "", {}])[:2] = p, piece
    return nodes


def vocabulary(path: str) -> dict[tuple[bool, str], float]:
    """(goes on with a word, piece) -> weight, from the scores of a sentencepiece model.

    The scores of a unigram model are log probabilities. Those of a BPE model are ranks by the order of its merges, from
    0 down; pieces by falling frequency follow Zipf's law, so their weight is 1 / (1 + rank).
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    ranked = all(float(model.get_score(i)).is_integer() for i in kinds)
    out: dict[tuple[bool, str], float] = {(True, model.id_to_piece(i)): 1.0 / model.get_piece_size() for i in range(model.get_piece_size()) if model.is_byte(i)}
    for i in kinds:
        piece, score = model.id_to_piece(i), model.get_score(i)
        if MARK not in piece[1:]:
            out[piece[:1] != MARK, piece] = 1.0 / (1.0 + abs(score)) if ranked else math.exp(score)
    out.setdefault((False, MARK), 1.0)
    return out


def lattice(weights: dict[tuple[bool, str], float], counts: dict[tuple[bool, str], float], stop: float = 0.3, own: float = OWN) -> Lattice:
    """Normalised over what begins a word, and over what can follow in it (pieces, bytes and its end).

    The vocabulary's weights have the share `own`, however large the corpus is, and the expected counts the rest.
    """
    logs: dict[tuple[bool, str], float] = {}
    for later in (False, True):
        given = {k: w for k, w in weights.items() if k[0] == later}
        if later:
            given[True, ""] = stop / (1 - stop) * sum(given.values())
        seen = sum(n for k, n in counts.items() if k[0] == later)
        scale, share = (own if seen else 1.0) / sum(given.values()), (1 - own) / seen if seen else 0.0
        logs |= {k: math.log(w * scale + counts.get(k, 0.0) * share) for k, w in given.items()}
    byte = [logs.pop((True, f"<0x{b:02X}>")) for b in range(256)]
    end = logs.pop((True, ""))
    return Lattice({p: v for (later, p), v in logs.items() if not later}, {p: v for (later, p), v in logs.items() if later}, byte, end)


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words; of bytes, so A-Z and ASCII white space only."""
    return (text or "").encode().lower().split()


def count_words(docs: DataFrame, held: str) -> DataFrame:
    """word, c (its count outside of the rows where column `held` is true) and n (in all rows)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, out = {False: Counter(), True: Counter()}, lambda words, c, n: pa.record_batch([pa.array(words, pa.binary()).cast(pa.string()), pa.array(c, pa.int64()), pa.array(n, pa.int64())], names=["word", "c", "n"])
        for b in batches:
            for text, h in zip(b.column(0), b.column(1).to_pylist()):
                seen[h].update(tokens(text.as_py()))
                for k, some in seen.items():
                    if len(some) > COUNTED:
                        yield out(list(some), [0] * len(some) if k else list(some.values()), list(some.values()))
                        some.clear()
        for k, some in seen.items():
            for at in range(0, len(some), 50_000):
                words, counts = list(some)[at : at + 50_000], list(some.values())[at : at + 50_000]
                yield out(words, [0] * len(words) if k else counts, counts)

    parts = docs.select("text", held).mapInArrow(work, "word string, c long, n long")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def score(docs: DataFrame, vocabulary_path: str, modulus: int = 7, held_out: int = 2, rounds: int = 1) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, mixed_score.

    score is the marginal of the text in the lattice: for every word the sum over all its segmentations into pieces of an
    existing vocabulary, and for the text's end the share that ends have of the training tokens. The pieces' weights are
    the vocabulary's own scores and, as the other half, the expected counts of `rounds` rounds over all training words
    and their counts. Every text has a probability, and those of all texts sum to one.

    mixed_score also lets a word be drawn whole: with probability 1 - u by its count in the training rows and with u from
    the lattice, u being the share of words met once (Good and Turing).

    Counts cover all rows. Words are counted in each task before the shuffle. Frequent words (a share of HOT_SHARE, so a
    bounded number) are scored where the text is read; all others by a join on the word. Null text is empty text: its
    end alone is scored. Null ids count as the empty id; repeated rows count and come out repeatedly. A very long word is
    scored with the memory of a short one. An empty table gives an empty result; other columns are ignored.
    """
    import numpy as np

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text", (crc_bucket(F.col("doc_id"), modulus) == held_out).alias("held_out"))
    words = materialize(count_words(rows, "held_out"), "words")
    sums = words.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.sum("n")).first()
    ends = rows.where(~F.col("held_out")).count()
    total, distinct, once, every = (sums[0] or 0) + ends, sums[1] + (ends > 0), sums[2], sums[3] or 0
    unseen = (once + 1) / (total + 2)

    weights, counts = vocabulary(vocabulary_path), {}
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(lattice(weights, counts))

        def expected(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            got: tuple[dict[str, float], dict[str, float]] = ({}, {})
            for b in batches:
                for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    shared.value.expect(w, c, got)
            for later, some in enumerate(got):
                yield pa.record_batch([pa.array([bool(later)] * len(some), pa.bool_()), pa.array(list(some), pa.string()), pa.array(list(some.values()), pa.float64())], names=["later", "piece", "n"])

        spread = words.where("c > 0").select("word", "c").mapInArrow(expected, "later boolean, piece string, n double")
        counts = {(r[0], r[1]): r[2] for r in spread.groupBy("later", "piece").agg(F.sum("n")).collect()}  # pieces of the vocabulary
    shared = spark.sparkContext.broadcast(lattice(weights, counts))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            c = np.array(b.column("c"), dtype="f8")
            spelled = np.array([model.forward(w) for w in b.column("word").to_pylist()])
            mixed = np.logaddexp(np.log(unseen) + spelled, np.log((1 - unseen) * np.maximum(c, 1e-300) / (total + 1)))
            columns = [b.column("word"), b.column("n"), pa.array(c > 0), pa.array(np.log10((c + 1) / (total + distinct + 1))), pa.array((spelled + going) / math.log(10)), pa.array(mixed / math.log(10))]
            yield pa.record_batch(columns, names=["word", "n", *SCORES])

    ending = (ends + 1) / (total + 2)
    going = math.log1p(-ending)
    scored = materialize(words.mapInArrow(weigh, "word string, n long, known boolean, base double, own double, mixed double"), "scored")
    hot = scored.where(F.col("n") >= max(1.0, HOT_SHARE * every)).select("word", *SCORES).toPandas()  # at most 1 / HOT_SHARE rows
    table = spark.sparkContext.broadcast((pa.array(hot["word"], pa.string()).cast(pa.binary()), *[hot[c].to_numpy(dtype="f8") for c in SCORES]))
    end = math.log10((ends + 1) / (total + distinct + 1)), math.log10(ending), math.log10((1 - unseen) * (ends + 1) / (total + 1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, *values = table.value
        place = {w: i for i, w in enumerate(names.to_pylist())}
        known, *sums = (np.append(v, 0.0) for v in values)  # the last place: not there
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        for b in batches:
            out: list[tuple] = []
            rare: list[list[bytes]] = []
            times: list[list[int]] = []
            for text in b.column("text"):
                found = tokens(text.as_py())
                at = np.array([place.get(w, -1) for w in found], dtype="i8")
                other = Counter([found[i] for i in np.flatnonzero(at < 0)])
                out.append((len(found) + 1, int(known[at].sum()) + (ends > 0), *[v[at].sum() + e for v, e in zip(sums, end)]))
                rare.append(list(other))
                times.append(list(other.values()))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), *columns, pa.array(rare, pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array(times, pa.list_(pa.int32()))], names=["doc_id", "held_out", "n", "k", "b", "s", "m", "rare", "times"])

    part = rows.mapInArrow(read, "doc_id long, held_out boolean, n long, k long, b double, s double, m double, rare array<string>, times array<int>")
    part = materialize(part.withColumn("row", F.monotonically_increasing_id()), "parts")
    single = part.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("t"))
    sums = single.join(scored.select("word", *SCORES), "word").groupBy("row").agg(*[F.sum(F.col("t") * F.col(c).cast("double")).alias("r_" + c) for c in SCORES])
    whole = lambda c, r: F.col(c) + F.coalesce("r_" + r, F.lit(0.0))
    return part.drop("rare", "times").join(sums, "row", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), whole("k", "known").cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        whole("b", "base").alias("base_score"), whole("s", "own").alias("score"), whole("m", "mixed").alias("mixed_score"))


def run(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from geohealth.llm.common import table

    return score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
