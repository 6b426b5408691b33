"""Harmonic packing of token sequences, filled independently by every worker."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words in the newer half of a worker's table at most; that of words at the start of a line has a quarter of it.
CACHE = 200_000
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space, or of none, that go to the encoder on their own.
LONG = re.compile(f"[{_SPACE}]{{500,}}|[^{_SPACE}]{{500,}}")
_encoders: dict[str, Callable[[str], bytes]] = {}
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def encoder(path: str) -> Callable[[str], bytes]:
    """text -> its ids as little-endian unsigned 32-bit integers, as tokenizers gives them with add_special_tokens=False.

    In this byte-level BPE a single space or line end between two words begins a new piece, whatever stands before it.
    Where all white space of a text is of that kind, a separator and its word thus have ids of their own, which are looked
    up in two bounded tables (the older one is dropped when the newer one is full); other texts go whole to the encoder,
    but for very long runs, which tokenizers itself encodes.
    """
    import json
    from array import array

    import tiktoken
    from public_tokenizers import PATTERN
    from tokenizers import Tokenizer

    spec = json.load(open(path, encoding="utf-8"))
    byte_of = dict(zip(_byte_alphabet(), range(256)))
    added = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in added}
    plain = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert spec["pre_tokenizer"]["type"] == "ByteLevel"
    kept: list[Tokenizer] = []  # read when a text first needs it
    del spec

    def reference(part: str) -> bytes:
        if not kept:
            kept.append(Tokenizer.from_file(path))
        return array("I", kept[0].encode(part, add_special_tokens=False).ids).tobytes()

    def ids_of(part: str) -> bytes:
        if len(part) < 500 or not LONG.search(part):
            return array("I", plain.encode_ordinary(part)).tobytes()
        return b"".join(reference(p) if long else array("I", plain.encode_ordinary(p)).tobytes() for p, long in apart(part))

    class Words(dict):
        """word -> ids of the word after its separator."""

        def __init__(self, lead: str) -> None:
            self.lead, self.old = lead, {}

        def __missing__(self, word: str) -> bytes:
            ids = self.old.get(word) or ids_of(self.lead + word)
            if len(word) < 100:
                self[word] = ids
            return ids

        def trim(self, most: int) -> None:
            if len(self) > most:
                self.old = dict(self)
                self.clear()

    spaced, first = Words(" "), Words("\n")
    after_space, after_line = spaced.__getitem__, first.__getitem__

    def encode(text: str) -> bytes:
        if any(s in text for s in added):
            return reference(text)
        lines = [line.split(" ") for line in text.split("\n")]
        if any("" in words for words in lines) or len(text.split()) != sum(map(len, lines)):
            return ids_of(text)
        out: list[bytes] = []
        for i, words in enumerate(lines):
            out.append(after_line(words[0]) if i else ids_of(words[0]))
            out += map(after_space, words[1:])
        spaced.trim(CACHE)
        first.trim(CACHE // 4)
        return b"".join(out)

    return encode


def apart(text: str) -> Iterator[tuple[str, bool]]:
    """The text in parts that have ids of their own, and whether a part is a very long run.

    The last white space before a word belongs to the word or stands alone, so parts begin with it; after a word comes
    the end of a part.
    """
    at = 0
    for m in LONG.finditer(text):
        start, end = m.span()
        if m[0][0].isspace() and text[start] not in "\x1c\x1d\x1e\x1f":
            end -= end < len(text)
        else:
            start -= start > 0
        if at < start:
            yield text[at:start], False
        if start < end:
            yield text[start:end], True
        at = end
    if at < len(text):
        yield text[at:], False


def _byte_alphabet() -> list[str]:
    """The printable characters that stand for bytes 0-255 in a byte-level BPE: printable bytes for themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Bins:
    """The open bins of one worker. Class k has the documents of lengths in (capacity / (k + 1), capacity / k], k of which
    fill a bin; what is still free in it is cut off one further document, the filler, which goes on in the next bins.

    A piece is (doc_id, start, ids, doc_tokens). About 2 * sqrt(capacity) classes exist, each with fewer than k open pieces.
    """

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}
        self.filler: tuple | None = None
        self.waiting: list[tuple] = []  # pieces of the one full bin that has room, while there is no filler

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        """Pieces (with sequence and offset) of the bins that this document completes."""
        n = len(ids) // 4
        whole = n - n % self.capacity
        for start in range(0, whole, self.capacity):
            yield from self._close([(doc_id, start, ids[4 * start : 4 * (start + self.capacity)], n)])
        if whole == n:
            return
        piece, k = (doc_id, whole, ids[4 * whole :], n), self.capacity // (n - whole)
        if self.filler is None:
            self.filler = piece
            if self.waiting:
                yield from self._fill(self.waiting)
            return
        self.open.setdefault(k, []).append(piece)
        if len(self.open[k]) == k:
            yield from self._fill(self.open.pop(k))

    def _fill(self, pieces: list[tuple]) -> Iterator[tuple]:
        """Cut the bin's room off the filler; without one the bin waits for the next document."""
        room, self.waiting = self.capacity - sum(len(p[2]) for p in pieces) // 4, []
        if room and self.filler is not None:
            head, self.filler = _cut(self.filler, room)
            pieces = [*pieces, head]
            room -= len(head[2]) // 4
        if room:
            self.waiting = pieces
        else:
            yield from self._close(pieces)

    def rest(self) -> Iterator[tuple]:
        """What is still open, laid end to end: bins of full capacity, then of ever smaller powers of two. None needs padding."""
        left = [*self.waiting, *[p for k in sorted(self.open) for p in self.open[k]], *([self.filler] if self.filler else [])][::-1]
        total, self.open, self.waiting, self.filler = sum(len(p[2]) for p in left) // 4, {}, [], None
        while left:
            room = min(self.capacity, 1 << total.bit_length() - 1)
            total -= room
            taken = []
            while room:
                head, tail = _cut(left.pop(), room)
                taken.append(head)
                room -= len(head[2]) // 4
                if tail is not None:
                    left.append(tail)
            yield from self._close(taken)

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, n in pieces:
            yield doc_id, start, len(ids) // 4, ids, n, self.next_id, offset
            offset += len(ids) // 4
        self.next_id += 1


def _cut(piece: tuple, tokens: int) -> tuple[tuple, tuple | None]:
    """The piece's first tokens, and what is left of it."""
    doc_id, start, ids, n = piece
    if len(ids) <= 4 * tokens:
        return piece, None
    return (doc_id, start, ids[: 4 * tokens], n), (doc_id, start + tokens, ids[4 * tokens :], n)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    A document's ids end with end_id. Documents over the capacity give whole sequences; what is left, and every shorter
    document, falls into the class k of lengths in (capacity / (k + 1), capacity / k], whose bins take k each. The room
    that is left in such a bin is filled from one more document, which is cut for it, so sequences have no padding and
    about one document a sequence is cut. Every task fills bins of its own: nothing is shuffled, and no task needs more
    than its open bins in memory. The bins that are open at a task's end are laid end to end; the last of them have
    lengths of powers of two, which aren't padded. Null text is empty text (end_id alone). Null ids and repeated rows are
    packed like others; an empty table gives no pieces. Very long texts take memory in proportion to their own length.
    Documents of equal length are packed in the order in which they are read. Other columns are ignored. capacity must be
    a power of two.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encode = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, encoder(tokenizer))
        end = np.array([end_id], dtype="<u4").tobytes()
        bins = Bins(capacity, TaskContext.get().partitionId() << 36)

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*pieces), kinds)], names=names)

        ready: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):  # one text at a time
                ready += bins.add(doc_id, encode(text.as_py() or "") + end)
                if len(ready) >= 2_000:
                    yield rows(ready)
                    ready = []
        if ready := [*ready, *bins.rest()]:
            yield rows(ready)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, SCHEMA)


def run(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from geohealth.llm.common import table

    out = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
