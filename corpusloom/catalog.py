"""Which source has which languages, and what follows from it.

A catalogue is a plain mapping ``source -> languages``, read from configuration:
it decides how many lists a merge has, whether or not rows of a list are there.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Iterable, Mapping
from pathlib import Path

MIN_SOURCES, LARGE_SOURCES = 3, 5
#: Languages with few sources that get a large list all the same.
ALWAYS_LARGE = frozenset({"nl"})
#: Our code -> a provider's.
PROVIDER_CODES = {
    "wikipedia": {"zh-Hans": "zh", "zh-Hant": "zh", "nb": "no", "fil": "tl"},
    # fixed values: the providers' own codes
    "google": {"en": "eng", "zh-Hans": "chi_sim", "fr": "fre", "de": "ger", "he": "heb", "it": "ita", "ru": "rus", "es": "spa"},
    "fasttext": {"zh-Hans": "zh", "zh-Hant": "zh", "pt-BR": "pt", "pt-PT": "pt", "zh-x-oversimplified": "zh"},
}
#: (dataset, our code) -> OPUS's code; datasets that aren't listed are refused.
OPUS_CODES = {
    # fixed values: the datasets' own codes
    "Tatoeba": {"zh-Hans": "cmn", "fa": "pes", "fil": "tl", "sh": "sr"},
    "GlobalVoices": {"ja": "jp", "zh-Hant": "zht", "zh-Hans": "zhs", "sh": "sr"},
    "OpenSubtitles2018": {"pt-PT": "pt", "pt-BR": "pt_br", "zh-Hans": "zh_cn", "zh-Hant": "zh_tw", "nb": "no"},
    "Europarl": {"pt-PT": "pt"},
    "ParaCrawl": {}, "MultiUN": {}, "UNPC": {}, "EUBookshop": {}, "JW300": {}, "SETIMES": {}, "GNOME": {}, "KDE4": {},
}


def load(path: str | Path) -> dict[str, list[str]]:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def language_sources(catalogue: Mapping[str, Iterable[str]]) -> dict[str, list[str]]:
    """language -> its sources, both sorted."""
    found: dict[str, list[str]] = {}
    for source in sorted(catalogue):
        for lang in catalogue[source]:
            found.setdefault(lang, []).append(source)
    return dict(sorted(found.items()))


def supported(catalogue: Mapping[str, Iterable[str]], least: int = MIN_SOURCES) -> list[str]:
    return [lang for lang, s in language_sources(catalogue).items() if len(s) >= least]


def large(catalogue: Mapping[str, Iterable[str]], least: int = LARGE_SOURCES, always: Collection[str] = ALWAYS_LARGE) -> list[str]:
    return [lang for lang, s in language_sources(catalogue).items() if len(s) >= least or lang in always]


def expand(pattern: str, **values: Iterable[str]) -> list[str]:
    """All fillings of a path pattern, the last name varying fastest."""
    paths = [pattern]
    for name, options in values.items():
        options = list(options)
        paths = [p.replace("{" + name + "}", o) for p in paths for o in options]
    return paths


def provider_code(provider: str, lang: str) -> str:
    return PROVIDER_CODES.get(provider, {}).get(lang, lang)


def opus_code(dataset: str, lang: str) -> str:
    if dataset not in OPUS_CODES:
        raise ValueError(f"unknown OPUS dataset: {dataset}")
    return OPUS_CODES[dataset].get(lang, lang)


def opus_pair(dataset: str, a: str, b: str) -> tuple[str, bool]:
    """The pair's name in OPUS, which sorts by its own codes, and whether that swaps the sides."""
    x, y = opus_code(dataset, a), opus_code(dataset, b)
    return f"{min(x, y)}-{max(x, y)}", x > y


def paracrawl_source(lang: str) -> str:
    """The pair a ParaCrawl language is taken from; English comes with French."""
    return "en-fr" if lang == "en" else f"en-{lang}"


def reddit_file(month: str, folder: str = "") -> str:
    """Monthly dump by the compression of its time."""
    suffix = "bz2" if month <= "2017-11" else "xz" if month <= "2018-10" else "zst"
    return f"{folder}RC_{month}.{suffix}"


def count_file(source: str, lang: str, folder: str = "counts") -> str:
    return f"{folder}/{source}/{lang}.txt"
