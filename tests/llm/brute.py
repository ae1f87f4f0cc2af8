"""Plain Python versions of the training-data operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import regex
import xxhash


def sha256(data: bytes | str) -> str:
    return hashlib.sha256(data.encode("utf-8") if isinstance(data, str) else data).hexdigest()


# op1

SECRET_KINDS = [
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def base_secrets(text: str | None) -> tuple[list[int], str]:
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(SECRET_KINDS) for m in p.finditer(text or "") if ok(m)]
    shown = ",".join(f"{SECRET_KINDS[k][0]}:{s}:{e}" for s, k, e in sorted(found))
    return [sum(f[1] == k for f in found) for k in range(3)], shown


# op2


PRIME, BASE = (1 << 31) - 1, 1_000_003


def word_hash(word: str) -> int:
    """Spark's xxhash64 of a string, as a residue."""
    h = xxhash.xxh64(word.encode("utf-8"), seed=42).intdigest()
    return (h - (1 << 64) if h >> 63 else h) % PRIME


def rolling(words: list[str], k: int) -> list[int]:
    """Hashes of all k-grams, each from the one before."""
    w = [word_hash(x) for x in words]
    h = 0
    for x in w[:k]:
        h = (h * BASE + x) % PRIME
    out = [h]
    for gone, come in zip(w, w[k:]):
        h = ((h - gone * pow(BASE, k - 1, PRIME)) * BASE + come) % PRIME
        out.append(h)
    return out


def winnow(text: str, k: int = 5, window: int = 8) -> list[tuple[int, int]]:
    """(hash, place) chosen in each window, the rightmost of the smallest."""
    words = [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", text.lower()) if w]
    if len(words) >= k:
        hashes = rolling(words, k)
    elif words:
        hashes = [word_hash(" ".join(words))]
    else:
        hashes = [word_hash(text)] if text else []
    out = []
    for i in range(max(1, len(hashes) - window + 1) if hashes else 0):
        part = range(i, min(i + window, len(hashes)))
        best = min(part, key=lambda j: (hashes[j], -j))
        if (hashes[best], best) not in out:
            out.append((hashes[best], best))
    return out


def edited(text: str, following: str) -> str:
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


# op5


def repeated_bytes(texts: list[bytes], length: int = 200) -> list[list[bool]]:
    seen: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for d, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]].append((d, i))
    out = [[False] * len(t) for t in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                out[d][i : i + length] = [True] * length
    return out


def removal(text: bytes, gone: list[bool]) -> tuple[int, int, int, str]:
    spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
    return len(text), sum(gone), spans, sha256(bytes(b for b, g in zip(text, gone) if not g))


# op6

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def license_words(text: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_licenses(text: str | None) -> tuple:
    w = license_words(text)
    places = [(i, label) for phrase, label in PHRASES.items() for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


# op7


def shingles(text: str | None, k: int = 5) -> list[tuple[str, ...]]:
    w = re.findall(r"\w+", (text or "").lower())
    return [tuple(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [tuple(w)] if w else []


def alike(a: str | None, b: str | None) -> bool:
    """Whether the longest common subsequence of their words has 0.8 of the longer text's."""
    x, y = (re.findall(r"\w+", (t or "").lower()) for t in (a, b))
    n = max(len(x), len(y))
    if not n or 5 * sum((Counter(x) & Counter(y)).values()) < 4 * n:
        return False
    before = [0] * (len(y) + 1)
    for w in x:
        row = [0]
        for j, v in enumerate(y):
            row.append(before[j] + 1 if w == v else max(before[j + 1], row[j]))
        before = row
    return 5 * before[-1] >= 4 * n


def near_links(texts: list[str | None]) -> list[tuple[int, int]]:
    """Pairs of different texts that are alike, and pairs of equal ones."""
    bags = [set(shingles(t)) for t in texts]
    return [(j, i) for i in range(len(texts)) for j in range(i) if (texts[i] or "") == (texts[j] or "") or bags[i] & bags[j] and alike(texts[i], texts[j])]


def near_classes(texts: list[str | None]) -> list[int]:
    """For each text the number of its component's first text."""
    root = list(range(len(texts)))
    for j, i in near_links(texts):
        a, b = sorted((root[i], root[j]))
        root = [a if x == b else x for x in root]
    return root


# op10


def quality(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, x in enumerate(zip(words, words[1:], words[2:])) if windows[x] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def crc32_ids(ids: list[int]) -> int:
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
