"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are runs of two words, edges runs of three, each from its first two words to its last two. Only edges are counted,
with what stands at the ends of pieces; the counts of nodes and words are flows: what leaves a node, and what ends there.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.llm.common import discard, materialize

#: Bytes to what they count as: A-Z as a-z, the ends of pieces as a line end, a tab as a space.
_ENDS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes(10 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bits of a word's number in a task, as an edge is three of them in a long; edges that a task keeps before it passes them
#: on; words that are counted in one step.
WORD_BITS, MOST_EDGES, CHUNK = 21, 4_000_000, 200_000
#: Rows that a task hands on at a time, and documents that it gets at a time.
STEP, DOCUMENTS = 20_000, 500
#: Words of a task's table beyond which it passes its graphs on; a text in parts adds CHUNK + 2 to them at a time.
MOST_WORDS = (1 << WORD_BITS) - 3 * CHUNK
#: Parts of a language whose best phrases are found apart; edges in a row of a path at most.
PARTS, STRETCH = 32, 1024


class Graph:
    """The edges of one language in one task. An edge without a third word is a piece's end; without a second too, a piece of one word."""

    def __init__(self) -> None:
        self.waiting: list[np.ndarray] = []
        self.size = 0
        self.keys, self.counts = np.zeros(0, dtype="i8"), np.zeros(0, dtype="i4")

    def add(self, ids: np.ndarray) -> None:
        """ids: words by their numbers, pieces followed by 0. The last two are only what follows the others."""
        a, b, c = ids[:-2], ids[1:-1], ids[2:]
        at = a != 0
        a, b, c = a[at], b[at], c[at]
        self.waiting.append((a << 2 * WORD_BITS) | (b << WORD_BITS) | np.where(b != 0, c, 0))
        self.size += len(a)
        if self.size > 2 * CHUNK:
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        new = np.concatenate(self.waiting)
        self.waiting, self.size = [], 0
        new.sort()
        keys, counts = _runs(new, np.ones(len(new), dtype="i4"))
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        self.counts[at[known]] += counts[known]
        fresh = ~known
        self.keys, self.counts = np.insert(self.keys, at[fresh], keys[fresh]), np.insert(self.counts, at[fresh], counts[fresh])


def _runs(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def flows(keys: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number of words, keys and counts of edges, nodes and words, without the bits of what follows, in parts of STEP.

    A node has what leaves it and what ends there, and a word what its nodes have and what ends with it.
    """
    for order in (3, 2, 1):
        if order < 3:
            keys = keys >> WORD_BITS
            keys, counts = _runs(keys, counts)
        for at in range(0, len(keys), STEP):
            k, n = keys[at : at + STEP], counts[at : at + STEP]
            real = k & ((1 << WORD_BITS) - 1) != 0
            yield order, k[real], n[real]


def graph_rows(docs: DataFrame) -> DataFrame:
    """key (words, line end, language) and n: counts of edges, nodes and words of each task's graphs; without words, all of the language.

    Flows add up over graphs, so the sums of these rows are those of the whole graph.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graphs: dict[str, Graph] = defaultdict(Graph)
        number: dict[bytes, int] = defaultdict()
        number.default_factory = lambda: len(number) + 1
        ids: dict[str, list[int]] = defaultdict(list)

        def rows() -> Iterator[pa.RecordBatch]:
            for lang in list(ids):
                note(lang)
            words = pa.array(list(number), pa.binary()).cast(pa.string())
            for lang in list(graphs):
                graph = graphs.pop(lang)
                graph.settle()
                for order, k, counts in flows(graph.keys, graph.counts):
                    parts = [words.take(pa.array((k >> s * WORD_BITS & (1 << WORD_BITS) - 1) - 1)) for s in range(order - 1, -1, -1)]
                    phrase = pc.binary_join_element_wise(*parts, " ") if order > 1 else parts[0]
                    yield pa.record_batch([pc.binary_join_element_wise(phrase, lang, "\n"), pa.array(counts.astype("i8"))], names=["key", "n"])
                yield pa.record_batch([pa.array(["\n" + lang]), pa.array([int(graph.counts.sum(dtype="i8"))], pa.int64())], names=["key", "n"])
            graphs.clear()
            number.clear()

        def note(lang: str) -> None:
            if own := ids.pop(lang, None):
                graphs[lang].add(np.array([*own, 0, 0], dtype="i8"))

        get = number.__getitem__
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                for piece in (text.as_py() or "").encode().translate(FOLD).split(b"\n"):
                    words = piece.split(b" ") if b"  " not in piece else [w for w in piece.split(b" ") if w]
                    if words and not words[0]:
                        del words[0]
                    if words and not words[-1]:
                        del words[-1]
                    while len(words) > CHUNK + 1:  # a very long piece in parts, each with the two words that follow it
                        graphs[lang].add(np.fromiter(map(get, words[: CHUNK + 2]), dtype="i8"))
                        del words[:CHUNK]
                        if len(number) > MOST_WORDS:
                            yield from rows()
                    if words:
                        own = ids[lang]
                        own += map(get, words)
                        own.append(0)
                        if len(own) > CHUNK:
                            note(lang)
                            if len(number) > MOST_WORDS:
                                yield from rows()
                if len(number) > MOST_WORDS or sum(len(g.keys) for g in graphs.values()) > MOST_EDGES:
                    yield from rows()
        yield from rows()

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").mapInArrow(work, "key string, n long")


def frequent(docs: DataFrame, least: int) -> DataFrame:
    """lang, phrase, words (how many), f: phrases of 1 to 3 words that occur at least so often; without words (0) all of a language."""
    # a task's rows are sums already, so they are dealt out as they are and summed where they meet
    total = graph_rows(docs).repartition("key").groupBy("key").agg(F.sum("n").alias("f")).where((F.col("f") >= least) | F.startswith("key", F.lit("\n")))
    cut = F.instr("key", "\n")
    phrase = F.substring("key", F.lit(1), cut - 1)
    return total.select(F.substring("key", cut + 1, F.length("key")).alias("lang"), phrase.alias("phrase"), F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " "))).alias("words"), "f")


def _placed(edges: DataFrame) -> DataFrame:
    """edges (lang, phrase, f, before: the edge before it on its path) with path (its path's first edge) and place (steps from there).

    In each round an edge goes as far back again as it has come, until all have reached a first edge. Edges that never do
    lie on rings: when a round neither brings an edge home nor shows one a lesser edge, all know the least edge of
    their ring, which is then taken as its first.
    """
    far = F.col("before").isNotNull()
    state = materialize(edges.select("*", F.coalesce("before", "phrase").alias("path"), F.when(far, 1).otherwise(0).cast("long").alias("place"), (~far).alias("home"), F.col("phrase").alias("least"), F.lit(True).alias("news")), "paths")
    while state.where("news AND NOT home").limit(1).count():
        way = state.select("lang", F.col("phrase").alias("path"), F.col("path").alias("_path"), F.col("place").alias("_place"), F.col("home").alias("_home"), F.col("least").alias("_least"))
        step = state.where("NOT home").join(way, ["lang", "path"]).select(
            *edges.columns, F.col("_path").alias("path"), (F.col("place") + F.col("_place")).alias("place"), F.col("_home").alias("home"),
            F.least("least", "_least").alias("least"), (F.col("_home") | (F.col("_least") < F.col("least"))).alias("news"))
        # news of one edge is news for all: a ring's edges wait until no edge has any
        told = materialize(step, "paths")
        news = told.where("news").limit(1).count() > 0
        moved = materialize(state.where("home").unionByName(told.withColumn("news", F.lit(news))), "paths")
        discard(state, told)
        state = moved
    done = state.where("home").select(*edges.columns, "path", "place")
    rings = state.where("NOT home")
    if not rings.limit(1).count():
        return done
    opened = rings.select("lang", "phrase", "f", F.when(F.col("phrase") != F.col("least"), F.col("before")).alias("before"))
    return done.unionByName(_placed(opened))


def unary_paths(edges: DataFrame) -> DataFrame:
    """lang, path (first edge), part, phrase (its words in a row) and weights (of its edges): edges (lang, phrase, f) with unary paths compacted.

    Edges follow each other on a path where a single edge comes into a node and a single one leaves it. Rings are opened at
    their least edge. Paths are cut into stretches of STRETCH edges, so no row grows with the data. All edges come out
    with their weights: it is the same graph in fewer rows.
    """
    none = F.lit(None).cast("string")
    ends = edges.select("lang", F.substring_index("phrase", " ", 2).alias("node"), none.alias("into"), F.col("phrase").alias("out")).unionAll(
        edges.select("lang", F.substring_index("phrase", " ", -2).alias("node"), F.col("phrase").alias("into"), none.alias("out")))
    met = ends.groupBy("lang", "node").agg(F.count("into").alias("i"), F.count("out").alias("o"), F.max("into").alias("before"), F.max("out").alias("phrase"))
    link = met.where("i = 1 AND o = 1").select("lang", "phrase", "before")
    placed = _placed(edges.select("lang", "phrase", "f").join(link, ["lang", "phrase"], "left"))
    rows = placed.groupBy("lang", "path", F.floor(F.col("place") / STRETCH).cast("int").alias("part")).agg(F.array_sort(F.collect_list(F.struct("place", "phrase", "f"))).alias("e"))
    words = F.concat_ws(" ", F.get("e.phrase", F.lit(0)), F.transform(F.slice("e", 2, STRETCH), lambda x: F.substring_index(x["phrase"], " ", -1)))
    return rows.select("lang", "path", "part", words.alias("phrase"), F.col("e.f").alias("weights"))


def edges_of(paths: DataFrame) -> DataFrame:
    """lang, phrase, f of all edges of the paths."""
    at = paths.select("lang", F.split("phrase", " ").alias("w"), F.posexplode("weights").alias("k", "f"))
    return at.select("lang", F.array_join(F.slice("w", F.col("k") + 1, 3), " ").alias("phrase"), "f")


def collocations(docs: DataFrame, least: int = 10, kept: int = 2000, inside: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `kept` best phrases of two or three words.

    Texts are lower-cased (A-Z), cut into pieces at .,;:!? and line ends, and these into words at spaces and tabs. a is how
    often the phrase occurs within pieces (`least` times or more), l and r are the counts of its two parts at the cut of
    the lowest floor(1000000 a a / (l r)), of equal ones the first; n counts the language's words. A pair goes if a
    frequent phrase of three words holds it and has `inside` percent of its count or more. Ranks go by score, then count,
    then the phrase's bytes.

    Only edges are counted in the texts; tables of pairs and words are their flows. The frequent edges are compacted to
    unary paths, from which phrases of three words, and the nodes that lie on them, are read. Arithmetic is exact, in
    decimals, for counts up to 10^15. Null text is empty, null lang is `und`; repeated rows and null ids count like others.
    An empty table, or one without frequent phrases, gives no rows; other columns are ignored.
    """
    spark, setting = docs.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, DOCUMENTS)  # long texts: thousands at a time would take as much memory as a task's graph
    try:
        counts = materialize(frequent(docs, least), "counts")
    finally:
        spark.conf.set(setting, before)
    paths = materialize(unary_paths(counts.where("words = 3")), "unary")
    edges = edges_of(paths)
    node = lambda k: F.substring_index("phrase", " ", k)
    longer = edges.select("lang", F.explode(F.array(node(2), node(-2))).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
    pairs = counts.where("words = 2").select("lang", "phrase", F.col("f").alias("a")).join(longer, ["lang", "phrase"], "left")
    pairs = pairs.where(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * inside)).select("lang", "phrase", "a", F.array(F.struct(F.lit(1).alias("k"), node(1).alias("left"), node(-1).alias("right"))).alias("cuts"))
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), node(k).alias("left"), node(k - 3).alias("right")) for k in (1, 2)])
    found = pairs.unionByName(edges.select("lang", "phrase", F.col("f").alias("a"), cuts.alias("cuts"))).select("lang", "phrase", "a", F.explode("cuts").alias("cut")).select("lang", "phrase", "a", "cut.*")
    part = lambda name, f: counts.where("words > 0").select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    both = found.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    score = F.expr("(CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = best.select("lang", "phrase", "a", "m.l", "m.r", "m.score").withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    # a part's best first, so no language meets whole in one task
    few = scored.withColumn("_n", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_n") <= kept).drop("_n", "_part")
    top = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= kept)
    total = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    return top.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k)
), f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k AS words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
longer AS (SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE words = 3),
kept AS (SELECT * FROM c WHERE words = 3 OR NOT EXISTS (SELECT 1 FROM longer WHERE longer.lang = c.lang AND longer.phrase = c.phrase AND 100 * longer.a >= 50 * c.a)),
cut AS (SELECT lang, words, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, words)) AS k FROM kept)),
s AS (SELECT cut.lang, cut.phrase, a, cut.k, x.f AS l, y.f AS r, CAST((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x AND x.k = cut.k JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y AND y.k = cut.words - cut.k),
one AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT one.lang, row_number() OVER (PARTITION BY one.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM one JOIN total ON total.lang = one.lang
QUALIFY rank <= 2000
"""
