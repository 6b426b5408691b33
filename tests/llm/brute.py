"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

WS = b" \t\n\r\x0b\x0c"

ASSIGN = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def base_digest(text: str | None) -> str:
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in base_spans(text)).encode()).hexdigest()


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def words_3(text: str | None) -> list[bytes]:
    tokens = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not tokens:
        return []
    return [b" ".join(tokens[i : i + 3]) for i in range(len(tokens) - 2)] if len(tokens) >= 3 else [b" ".join(tokens)]


def simhash(text: str | None) -> int:
    import xxhash

    hs = [xxhash.xxh64_intdigest(g, seed=42) for g in words_3(text)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def components(prints: list[tuple[int, int]], distance: int = 3) -> dict[int, int]:
    """doc_id -> smallest doc_id that links of fingerprints reach, by comparing all pairs."""
    parent = {i: i for i, _ in prints}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= distance:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in prints}


ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_words(text: str | None) -> list[str]:
    return ITEM_WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def overlap(text: str | None, items: list[tuple[int, str | None]], window: int = 10) -> tuple[int, int, list[str]]:
    """Words, words hit, and the ids of items hit."""
    w, hit, found = item_words(text), set(), set()
    for item, t in items:
        v = item_words(t)
        n = min(window, len(v))
        wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in wins:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def similar(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """doc_id -> smallest doc_id by all pairs: 3 bits of the fingerprints, or Jaccard similarity 0.8 of five-word shingles."""
    def grams(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    known = [(i, simhash(t), grams(t)) for i, t in rows]
    comp = {i: i for i, _ in rows}
    for n, (i, f, g) in enumerate(known):
        for j, e, h in known[:n]:
            if (f ^ e).bit_count() <= 3 or (g and h and 5 * len(g & h) >= 4 * len(g | h)):
                x, y = comp[i], comp[j]
                comp = {k: min(x, y) if c in (x, y) else c for k, c in comp.items()}
    return comp
