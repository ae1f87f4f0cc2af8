"""Sinks. Text goes out by Spark's writers; the two binary formats are small and written on the driver."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..functions import text as X


def text(df: DataFrame, path: str, column: str = "text", compressed: bool = False) -> None:
    df.select(column).write.option("compression", "gzip" if compressed else "none").text(path)


def by_language(df: DataFrame, path: str, languages: list[str], column: str = "text") -> None:
    """A folder for each language; others are dropped."""
    df.filter(F.col("lang").isin(languages)).select("lang", column).write.partitionBy("lang").text(path)


def count_file(counts: DataFrame, total: DataFrame, path: str) -> None:
    """``__total__`` first, then rows by falling count, ties by ``first_seen`` where there is one, else by token."""
    tie = "first_seen" if "first_seen" in counts.columns else "token"
    head = total.select(F.lit(0).alias("k"), F.lit(None).cast("long").alias("count"), F.lit("").alias("t"), F.concat(F.lit("__total__\t"), F.col("total").cast("string")).alias("value"))
    rows = counts.select(F.lit(1).alias("k"), "count", F.col(tie).alias("t"), F.concat_ws("\t", "token", F.col("count").cast("string")).alias("value"))
    if tie == "first_seen":
        head = head.withColumn("t", F.lit(None).cast(counts.schema[tie].dataType))
    head.union(rows).orderBy("k", F.desc("count"), "t").select("value").coalesce(1).write.text(path)


def frequency_file(freqs: DataFrame, path: str) -> None:
    """Rows of 1e-9 and more, frequency and word both falling."""
    rows = freqs.filter("freq >= 1e-9").orderBy(F.desc("freq"), F.desc("word"))
    rows.select(F.concat_ws("\t", "word", X.format_5g(F.col("freq"))).alias("value")).coalesce(1).write.text(path)


def jieba(rows: DataFrame, path: str) -> None:
    rows.orderBy(F.desc("ppb"), F.desc("word")).select(F.concat_ws(" ", "word", F.col("ppb").cast("string")).alias("value")).coalesce(1).write.text(path)


def vocabulary(vocab: DataFrame, path: str) -> None:
    vocab.orderBy("idx").select(F.col("uri").alias("value")).coalesce(1).write.text(path)


def msgpack(value: Any) -> bytes:
    """Maps, lists, strings, byte strings, integers, floats, booleans and None."""
    if value is None:
        return b"\xc0"
    if isinstance(value, bool):
        return b"\xc3" if value else b"\xc2"
    if isinstance(value, int):
        for low, high, code, form in ((0, 127, None, "B"), (-32, -1, None, "b"), (0, 0xFF, 0xCC, "B"), (0, 0xFFFF, 0xCD, "H"), (0, 0xFFFFFFFF, 0xCE, "I"), (0, (1 << 64) - 1, 0xCF, "Q"), (-128, 127, 0xD0, "b"), (-(1 << 15), 0, 0xD1, "h"), (-(1 << 31), 0, 0xD2, "i"), (-(1 << 63), 0, 0xD3, "q")):
            if low <= value <= high:
                return (b"" if code is None else bytes([code])) + struct.pack(">" + form, value)
        raise OverflowError(value)
    if isinstance(value, float):
        return b"\xcb" + struct.pack(">d", value)
    if isinstance(value, str):
        raw = value.encode("utf-8")
        return _sized(len(raw), (0xA0, 32), ((0xD9, "B"), (0xDA, "H"), (0xDB, "I"))) + raw
    if isinstance(value, (bytes, bytearray)):
        return _sized(len(value), None, ((0xC4, "B"), (0xC5, "H"), (0xC6, "I"))) + bytes(value)
    if isinstance(value, dict):
        return _sized(len(value), (0x80, 16), ((0xDE, "H"), (0xDF, "I"))) + b"".join(msgpack(k) + msgpack(v) for k, v in value.items())
    return _sized(len(value), (0x90, 16), ((0xDC, "H"), (0xDD, "I"))) + b"".join(map(msgpack, value))


def _sized(n: int, fixed: tuple[int, int] | None, forms: Iterable[tuple[int, str]]) -> bytes:
    if fixed and n < fixed[1]:
        return bytes([fixed[0] | n])
    for code, form in forms:
        if n < 1 << 8 * struct.calcsize(form):
            return bytes([code]) + struct.pack(">" + form, n)
    raise OverflowError(n)


def cbpack(tiers: DataFrame, path: str) -> None:
    """Tiers of one language, (neg_cb, words), as gzipped msgpack; a frequency list is bounded by its cutoff."""
    found = {r["neg_cb"]: r["words"] for r in tiers.select("neg_cb", "words").toLocalIterator()}
    data = [{"format": "cB", "version": 1}, *(found.get(i, []) for i in range(max(found, default=-1) + 1))]
    with open(path, "wb") as f:
        f.write(gzip.compress(msgpack(data), mtime=0))


def coordinates(coords: DataFrame, path: str) -> None:
    """Little-endian pairs of 32-bit indices, ``n`` times each; streamed to the driver, a partition at a time."""
    with open(path, "wb") as f:
        for r in coords.toLocalIterator():
            f.write(struct.pack("<ii", r["idx1"], r["idx2"]) * (r["n"] if "n" in coords.columns else 1))


def id_stream(ids: DataFrame, path: str, column: str = "ids") -> None:
    """A msgpack array for each row."""
    with open(path, "wb") as f:
        for r in ids.toLocalIterator():
            f.write(msgpack(list(r[column])))
