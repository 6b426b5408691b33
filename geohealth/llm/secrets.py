"""Secret scans with multipart credential linking: an interval join of identifiers, secrets and endpoints within scopes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geohealth.llm.common import let, unused

IDENTIFIER, SECRET, ENDPOINT = 1, 2, 4


@dataclass(frozen=True)
class Kind:
    """A pattern whose matches are kept if their group has `least` characters (and fewer than `below`)."""

    name: str
    pattern: str
    group: int
    least: int
    part: int
    below: int = 0


_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Strong kinds stand alone.
STRONG = [
    Kind("assign", _ASSIGN, 2, 12, SECRET),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 18, IDENTIFIER),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16, SECRET),
]
#: Weak kinds count only next to their complement. A key has a digit anywhere and any length from 32 on; names may have any prefix.
WEAK = [
    Kind("weak_assign", _ASSIGN, 2, 6, SECRET, 12),
    Kind("weak_access", r"AKIA[A-Z0-9]+", 0, 8, IDENTIFIER, 18),
    Kind("weak_key", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{32,}+={0,2}+(?![A-Za-z0-9+/=_-])", 0, 32, SECRET),
    Kind("login", r"""(?i:(?:user|user_?name|user[\x20_]?id|(?<![A-Za-z])uid|login|client_?id|account|account_?id|account_?name)["']?\x20{0,4}[:=]\x20{0,4}["']?)([A-Za-z0-9@_.+-]{3,64})""", 1, 3, IDENTIFIER),
    Kind("endpoint", r"(?i:\b(?:https?|ftp|ssh|jdbc:[a-z0-9]{2,16}|postgres|postgresql|mysql|mongodb|redis|amqp)://)[^\x00-\x20\"'<>]+", 0, 8, ENDPOINT),
    Kind("host", r"""(?i:(?:host|hostname|endpoint|server|region)["']?\x20{0,4}[:=]\x20{0,4}["']?)([A-Za-z0-9.:-]{4,128})""", 1, 4, ENDPOINT),
]
KINDS = [k.name for k in STRONG + WEAK]
SPAN = "struct<start:int,end:int,kind:int>"
#: Code points in a slice of a text that is redacted.
SLICE = 2048
#: Before and after all places.
LOW, HIGH = -(1 << 30), 1 << 30


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """values[i] joined with all before it. Each step doubles how far a value has seen, so n values take n * log(n) work."""
    def step(acc: Column, width: Column) -> Column:
        joined = F.transform(acc, lambda v, i: F.when(i < width, v).otherwise(join(F.get(acc, i - width), v)))
        return F.when(F.size(acc) <= width, acc).otherwise(joined)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(28)]), values, step)


def _none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def _matches(text: Column, kinds: list[Kind]) -> Column:
    """Spans of one pattern, which `kinds` share: leftmost, non-overlapping, in code points.

    split() gives what lies between the matches; the running sum of the lengths of both gives every match its place.
    """
    pattern = kinds[0].pattern
    rows = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length).alias("all"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(kinds[0].group)), F.length).alias("own"),
    )
    rows = F.filter(rows, lambda r: r["all"].isNotNull())
    which = lambda n: F.coalesce(*[F.when((n >= k.least) & ((n < k.below) if k.below else F.lit(True)), F.lit(KINDS.index(k.name))) for k in kinds])

    def placed(r: Column) -> Column:
        ends = running(F.transform(r, lambda x: x["gap"] + x["all"]), lambda a, b: a + b)
        spans = F.zip_with(r, ends, lambda x, end: F.struct((end - x["all"]).alias("start"), end.alias("end"), which(x["own"]).alias("kind")))
        return F.filter(spans, lambda s: s["kind"].isNotNull())

    return F.when(text.rlike(pattern), let(rows, placed)).otherwise(_none())


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(n) for n in KINDS])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(text: Column) -> Column:
    """Every strong and weak span of a text, weak ones unconfirmed, sorted by place."""
    patterns: dict[str, list[Kind]] = {}
    for k in STRONG + WEAK:
        patterns.setdefault(k.pattern, []).append(k)
    text = F.coalesce(text, F.lit(""))
    return F.array_sort(F.concat(*[_matches(text, ks) for ks in patterns.values()]))


def link(spans: Column, reach: int = 200) -> Column:
    """The weak spans of a sorted array of spans that are confirmed and that no strong span overlaps.

    A scope is the `reach` code points to either side of a candidate's start. An identifier needs a secret in its scope, a
    secret an identifier, an endpoint both. The interval join is a sweep over the sorted spans: running maxima and minima
    give every candidate the nearest identifier and secret on either side and the strong spans about it, so a text with m
    spans takes m * log(m) work, whatever they are near to, and nothing leaves its row.
    """
    parts = F.array(*[F.lit(k.part) for k in STRONG + WEAK])
    strong = lambda s: s["kind"] < len(STRONG)
    is_ = lambda s, part: F.get(parts, s["kind"]) == part
    here = lambda c, value, other: F.when(c, value).otherwise(F.lit(other))

    def swept(all_: Column) -> Column:
        before = F.transform(all_, lambda s: F.struct(here(is_(s, IDENTIFIER), s["start"], LOW).alias("i"), here(is_(s, SECRET), s["start"], LOW).alias("s"), here(strong(s), s["end"], LOW).alias("t")))
        after = F.transform(F.reverse(all_), lambda s: F.struct(here(is_(s, IDENTIFIER), s["start"], HIGH).alias("i"), here(is_(s, SECRET), s["start"], HIGH).alias("s"), here(strong(s), s["start"], HIGH).alias("t")))
        of = lambda f: lambda a, b: F.struct(*[f(a[n], b[n]).alias(n) for n in "ist"])
        seen = F.arrays_zip(all_.alias("x"), running(before, of(F.greatest)).alias("b"), F.reverse(running(after, of(F.least))).alias("a"))

        def good(r: Column) -> Column:
            x = r["x"]
            near = {p: (x["start"] - r["b"][p] <= reach) | (r["a"][p] - x["start"] <= reach) for p in "is"}
            whole = F.when(is_(x, IDENTIFIER), near["s"]).when(is_(x, SECRET), near["i"]).otherwise(near["i"] & near["s"])
            covered = (r["b"]["t"] > x["start"]) | (r["a"]["t"] < x["end"])
            return ~strong(x) & whole & ~covered

        return F.transform(F.filter(seen, good), lambda r: r["x"])

    weak = lambda all_: F.exists(all_, lambda s: ~strong(s))
    return let(spans, lambda all_: F.when(weak(all_), swept(all_)).otherwise(_none()))


def found(text: Column, reach: int = 200) -> Column:
    """strong and linked: the spans of a text that are secrets by themselves, and through their complement."""
    return let(scan(text), lambda s: F.struct(F.filter(s, lambda x: x["kind"] < len(STRONG)).alias("strong"), link(s, reach).alias("linked")))


def find_secrets(docs: DataFrame, reach: int = 200) -> DataFrame:
    """One row per row of docs: doc_id, strong and linked (arrays of start, end, kind number in KINDS).

    Null and empty texts have no spans. Spans of different kinds may overlap; a weak span that a strong one overlaps is
    not reported. Spans at the same place count once a kind. All work is done where the text is read, in time in
    proportion to its length (times the logarithm of its matches), so very long texts and texts full of matches are like
    others. Null doc_ids are scanned like others; repeated rows come out repeatedly. An empty table gives an empty result.
    Other columns are ignored.
    """
    return docs.select("doc_id", found(F.col("text"), reach).alias("_found")).select("doc_id", "_found.strong", "_found.linked")


def _between(slices: Column, start: Column, end: Column) -> Column:
    """Code points start to end of a text that is given in slices."""
    part = lambda n: F.substring(F.get(slices, n), F.greatest(start - n * SLICE, F.lit(0)) + 1, F.least(end - n * SLICE, F.lit(SLICE)) - F.greatest(start - n * SLICE, F.lit(0)))
    first, last = F.floor(start / SLICE).cast("int"), F.floor((end - 1) / SLICE).cast("int")
    return F.when(start >= end, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(first, last), part), ""))


def masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with each of the sorted spans replaced; overlapping ones together. Every slice of the text is cut by its own spans only."""
    def cleaned(s: Column, slices: Column) -> Column:
        upto = running(F.transform(s, lambda x: x["end"]), F.greatest)
        before = F.concat(F.array(F.lit(0)), upto)
        pieces = F.zip_with(s, F.slice(before, 1, F.size(s)), lambda x, b: F.when(x["start"] >= b, F.concat(_between(slices, b, x["start"]), F.lit(mark))).otherwise(F.lit("")))
        return F.concat(F.array_join(pieces, ""), _between(slices, F.element_at(upto, -1), F.length(text)))

    slices = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{SLICE}}}"), F.lit(0))
    return let(spans, lambda s: let(slices, lambda sl: cleaned(s, sl)))


def redact(docs: DataFrame, mark: str = "[SECRET]", reach: int = 200) -> DataFrame:
    """docs (all columns) with each span of a secret replaced in text; n_chars, where there is one, is counted anew.

    Overlapping spans are replaced together. Texts without spans, empty and null texts stay as they are, as do all other
    columns, null ids and repeated rows. Masking is done where the text is read: nothing is joined or shuffled. An empty
    table gives an empty one.
    """
    spans, new = unused(docs, "_spans"), unused(docs, "_new")
    every = let(found(F.col("text"), reach), lambda f: F.array_sort(F.concat(f["strong"], f["linked"])))
    out = docs.withColumn(spans, every)
    out = out.withColumn(new, F.when(F.size(spans) > 0, masked(F.col("text"), F.col(spans), mark)))
    changed = {"text": F.coalesce(F.col(new), F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col(new).isNotNull(), F.length(new).cast("long")).otherwise(F.col("n_chars"))
    return out.select(*[changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


def run(spark, sf_dir: str) -> DataFrame:
    from geohealth.llm.common import table

    out = find_secrets(table(spark, sf_dir, "documents"))
    count = [F.size(F.filter("strong", lambda s: s["kind"] == 0)).cast("long").alias("n_assign"),
             F.size(F.filter("strong", lambda s: s["kind"] == 1)).cast("long").alias("n_access"),
             F.size(F.filter("strong", lambda s: s["kind"] == 2)).cast("long").alias("n_hex")]
    return out.select("doc_id", *count, F.sha2(_shown(F.col("strong")), 256).alias("base_sha256"), _shown(F.concat("strong", "linked")).alias("spans"))
