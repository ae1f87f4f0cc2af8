"""Language detection by agreement of two independent detectors, both trained on labelled text.

One compares ranks of frequent character trigrams, the other is a multinomial
naive Bayes over character n-grams. Their profiles have a fixed size per
language, so they travel with the functions. A text's language is what both
say; the rest is ``und``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.shared import small_batches

PROFILE = 400
FEATURES = 3000
#: Characters whose n-grams are taken at once, and counts that a task holds for a language.
CHARS, HELD = 1 << 18, 1 << 20
#: Codes of the first detector that others spell differently.
ALIASES = {"tl": "fil", "jw": "jv", "iw": "he", "no": "nb", "hr": "sh", "sr": "sh", "bs": "sh"}
#: What a detector can't take: controls, surrogates, noncharacters, fillers, angle brackets.
ILLEGAL = r"[\x00-\x08\x0B\x0E-\x1F\x7F-\x9F\x{FDD0}-\x{FDEF}\x{FFFE}\x{FFFF}\x{115F}\x{1160}\x{3164}\x{FFA0}<>]"
#: Pairs that are close enough to be taken for each other.
CLOSE = {frozenset(p) for p in (("nb", "no"), ("nb", "da"), ("nb", "nn"), ("id", "ms"), ("hr", "sr"), ("hr", "bs"), ("sr", "bs"), ("sh", "hr"), ("sh", "sr"), ("sh", "bs"), ("fil", "tl"), ("he", "iw"), ("zh", "zh-Hans"), ("pt", "pt-BR"), ("pt", "pt-PT"))}


def legal(text: Column) -> Column:
    return F.regexp_replace(text, ILLEGAL, "")


def tag_distance(a: str, b: str) -> int:
    """0 for the same language, under 10 for close ones, else 100."""
    if a == b:
        return 0
    if a.split("-")[0] == b.split("-")[0]:
        return 3
    return 4 if frozenset((a, b)) in CLOSE else 100


def _grams(text: str, n: int = 3) -> list[str]:
    t = " " + regex.sub(r"[^\p{L}\p{M}]+", " ", text.lower()).strip() + " "
    return [t[i : i + n] for i in range(len(t) - n + 1)]


@dataclass
class Models:
    ranks: dict[str, dict[str, int]] = field(default_factory=dict)
    logs: dict[str, dict[str, float]] = field(default_factory=dict)
    unseen: dict[str, float] = field(default_factory=dict)
    _made: dict = field(default_factory=dict, repr=False, compare=False)

    def by_rank(self, text: str) -> tuple[str, bool]:
        """(language, sure): the least sum of rank differences."""
        own = {g: r for r, (g, _) in enumerate(Counter(_grams(text)).most_common(PROFILE))}
        if not own or not self.ranks:
            return "und", False
        lang = min(self.ranks, key=lambda x: (sum(abs(self.ranks[x].get(g, PROFILE) - r) for g, r in own.items()), x))
        if lang == "sh" and "ا" in text:
            lang = "ar"
        sure = len(text.encode("utf-8", "replace")) >= 50 and not (lang == "sh" and regex.search(r"\p{Cyrillic}", text))
        return ALIASES.get(lang, lang), sure

    def by_bayes(self, text: str) -> tuple[str, float]:
        grams = [g for n in (2, 3) for g in _grams(text, n)]
        if not grams or not self.logs:
            return "und", 0.0
        scores = {x: sum(self.logs[x].get(g, self.unseen[x]) for g in grams) for x in self.logs}
        best = max(scores, key=lambda x: (scores[x], x))
        return best, 1 / sum(math.exp(max(-700.0, s - scores[best])) for s in scores.values())

    def checked(self, text: str) -> tuple[str, float]:
        a, _ = self.by_rank(text)
        b, sure = self.by_bayes(text)
        return (b, sure) if a != "und" and tag_distance(a, b) < 10 else ("und", 0.0)


    def detect_all(self, texts: list[str]) -> list[str]:
        """``checked`` for many texts at once, over flat arrays of their n-grams."""
        if not self.ranks:
            return ["und"] * len(texts)
        codes, doc = _codes([t.lower() for t in texts])
        size = len(texts)
        scores, own = {x: np.zeros(size) for x in self.logs}, None
        for n in (2, 3):
            keys, valid = _keys(codes, n)
            valid &= doc[: len(valid)] == doc[n - 1 :]
            of, grams = pd.factorize(keys[valid])
            both, found = pd.factorize(doc[: len(valid)][valid] * max(1, len(grams)) + of)  # texts in order, n-grams as they first appear
            count, at, gram = np.bincount(both, minlength=len(found)), found // max(1, len(grams)), found % max(1, len(grams))
            known, logs, ranks = self._tables(n)
            place = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            place = np.where(known[place] == grams, place, len(known)) if len(known) else np.zeros(len(grams), np.int64)
            for x in scores:
                scores[x] += np.bincount(at, count * logs[x][place][gram], size)
            if n == 3:
                order = np.lexsort((-count, at))
                at, gram = at[order], gram[order]
                rank = np.arange(len(at)) - np.searchsorted(at, np.arange(size))[at]
                top = rank < PROFILE
                at, gram, rank = at[top], gram[top], rank[top]
                own = np.bincount(at, minlength=size) > 0
                far = {x: np.bincount(at, np.abs(ranks[x][place][gram] - rank), size) for x in self.ranks}
        near, likely = sorted(self.ranks, key=lambda x: x or ""), sorted(self.logs, key=lambda x: x or "", reverse=True)
        by_rank = np.argmin([far[x] for x in near], axis=0)
        by_bayes = np.argmax([scores[x] for x in likely], axis=0)
        out = []
        for text, a, b, some in zip(texts, by_rank.tolist(), by_bayes.tolist(), own.tolist()):
            lang, other = near[a], likely[b]
            lang = "ar" if lang == "sh" and "ا" in text else ALIASES.get(lang, lang)
            out.append(other if some and lang != "und" and tag_distance(lang, other) < 10 else "und")
        return out

    def _tables(self, n: int) -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray]]:
        """Keys of the known n-grams in order; by language, their logarithms and ranks, with those of unknown ones at the end. Made once."""
        if n not in self._made:
            grams = {g for table in (*self.logs.values(), *self.ranks.values()) for g in table if len(g) == n}
            keys = {_key(g): g for g in grams}
            known = np.array(sorted(keys), np.int64)
            grams = [keys[k] for k in known.tolist()]
            logs = {x: np.array([*(self.logs[x].get(g, self.unseen[x]) for g in grams), self.unseen[x]]) for x in self.logs}
            ranks = {x: np.array([*(self.ranks[x].get(g, PROFILE) for g in grams), PROFILE]) for x in self.ranks}
            self._made[n] = known, logs, ranks
        return self._made[n]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Of each code point, whether it is a letter or a mark."""
    out = np.zeros(0x110000, bool)
    for m in regex.finditer(r"[\p{L}\p{M}]+", "".join(map(chr, range(0x110000)))):
        out[m.start() : m.end()] = True
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def _codes(lows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts as ``_grams`` has them, with the number of each one's text; a text without letters is a single space."""
    codes = _points("".join(f" {t} " for t in lows))
    doc = np.repeat(np.arange(len(lows)), [len(t) + 2 for t in lows])
    letter = _letters()[codes]
    first = np.r_[True, doc[1:] != doc[:-1]]
    keep = letter | first | np.r_[True, letter[:-1]]
    return np.where(letter, codes, 32)[keep], doc[keep]


def _keys(codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram at each place as a number (n up to 3), and a mask of all of them."""
    size = max(0, len(codes) - n + 1)
    keys = np.zeros(size, np.int64)
    for k in range(n):
        keys = keys << 21 | codes[k : k + size]
    return keys, np.ones(size, bool)


def _key(gram: str) -> int:
    return int(_keys(_points(gram), len(gram))[0][0])


def _gram(key: int) -> str:
    return "".join(chr(c) for c in (key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF) if c)


def _slices(sizes: Iterable[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of some CHARS characters, one text at least."""
    begin = end = total = 0
    for size in sizes:
        if total + size > CHARS and end > begin:
            yield begin, end
            begin, total = end, 0
        end, total = end + 1, total + size
    if end > begin:
        yield begin, end


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, t) to counts (lang, g, n) of the task's n-grams; what is held is bounded, so an n-gram may come again."""
    held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}

    def compact(lang: str | None) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in held[lang]]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in held[lang]]), len(keys)).astype(np.int64)

    def rows(lang: str | None, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(keys), 1 << 16):
            grams = [_gram(x) for x in keys[k : k + (1 << 16)].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(counts[k : k + (1 << 16)])], ["lang", "g", "n"])

    for batch in batches:
        of: dict[str | None, list[str]] = {}
        for lang, t in zip(batch.column("lang").to_pylist(), batch.column("t").to_pylist()):
            of.setdefault(lang, []).append(t)
        for lang, texts in of.items():
            for begin, end in _slices(map(len, texts)):
                part = texts[begin:end]
                codes, doc = _points("".join(part)), np.repeat(np.arange(len(part)), [len(t) for t in part])
                for n in (2, 3):
                    keys, valid = _keys(codes, n)
                    at, found = pd.factorize(keys[valid & (doc[: len(valid)] == doc[n - 1 :])])
                    held.setdefault(lang, []).append((found, np.bincount(at, minlength=len(found))))
            if lang in held and sum(len(k) for k, _ in held[lang]) > HELD:
                keys, counts = compact(lang)
                held[lang] = [(keys, counts)]
                if len(keys) > HELD // 2:
                    yield from rows(lang, keys, counts)
                    del held[lang]
    for lang in held:
        yield from rows(lang, *compact(lang))


def train(docs: DataFrame) -> Models:
    """Models from (lang, text): n-gram counts over all rows, then a fixed number of n-grams per language."""
    low = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower("text"), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))
    models = Models()
    small_batches(docs.sparkSession)
    texts = docs.select("lang", low.alias("t")).filter("t IS NOT NULL")
    counts = texts.mapInArrow(_count, "lang string, g string, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "g")
    top = counts.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= FEATURES)
    rows: dict[str, list[tuple[str, int]]] = {}
    for r in top.orderBy("lang", "r").collect():  # FEATURES rows per language
        rows.setdefault(r["lang"], []).append((r["g"], r["n"]))
    for lang, found in rows.items():
        total = sum(n for _, n in found) + FEATURES
        models.logs[lang] = {g: math.log((n + 1) / total) for g, n in found}
        models.unseen[lang] = math.log(1 / total)
        models.ranks[lang] = {g: i for i, g in enumerate([g for g, _ in found if len(g) == 3][:PROFILE])}
    return models


def detect(text: Column, models: Models) -> Column:
    """The language both detectors agree on, or ``und``. Declared non-deterministic, so that a filter on it doesn't find it a second time."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        texts = [t or "" for t in s]
        out = [x for begin, end in _slices(map(len, texts)) for x in models.detect_all(texts[begin:end])]
        return pd.Series(out, index=s.index, dtype="object")

    return run.asNondeterministic()(legal(text))
