"""Readers of corpora and third-party count lists; every one takes paths that Spark opens."""

from __future__ import annotations

import bz2
import io
import lzma
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import text as X

Paths = str | list[str]


def text_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """(text): UTF-8 lines, of .gz and .bz2 files too; malformed bytes are replaced."""
    return spark.read.text(paths).withColumnRenamed("value", "text")


def numbered_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """(file, line, text) with lines from 0 in each file; whole files, for inputs whose order is a key."""
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.regexp_replace("value", r"\n\z", "").alias("value"))
    return files.select("file", F.posexplode(F.split("value", "\n")).alias("line", "text"))


def strict_text_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Lines with malformed bytes dropped instead of replaced."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                yield pd.DataFrame({"text": bytes(content).decode("utf-8", "ignore").removesuffix("\n").split("\n")})

    return spark.read.format("binaryFile").load(paths).select("content").mapInPandas(run, "text string")


def _stream(name: str, data: bytes) -> io.BufferedIOBase:
    kind = name.rpartition(".")[2]
    if kind in ("zst", "zstd"):
        import zstandard

        return zstandard.ZstdDecompressor(max_window_size=1 << 31).stream_reader(io.BytesIO(data), read_across_frames=True)
    if kind == "xz":
        return lzma.open(io.BytesIO(data))
    if kind == "bz2":
        return bz2.open(io.BytesIO(data))
    raise ValueError(f"unknown compression: {name}")


def compressed_lines(spark: SparkSession, paths: Paths, rows: int = 10_000) -> DataFrame:
    """Lines of .bz2, .xz and .zst dumps, unpacked as streams; other extensions are refused. A task per file."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                lines: list[str] = []
                for line in io.TextIOWrapper(_stream(path, bytes(content)), encoding="utf-8", errors="replace", newline="\n"):
                    lines.append(line.rstrip("\n"))
                    if len(lines) >= rows:
                        yield pd.DataFrame({"text": lines})
                        lines = []
                yield pd.DataFrame({"text": lines}, dtype="object")

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "text string")


def reddit_comments(spark: SparkSession, paths: Paths) -> DataFrame:
    """A malformed line fails the read."""
    return spark.read.schema(schemas.REDDIT).option("mode", "FAILFAST").json(paths)


def parse_reddit(lines: DataFrame, column: str = "text") -> DataFrame:
    return lines.select(F.from_json(column, schemas.REDDIT, {"mode": "FAILFAST"}).alias("c")).select("c.*")


def tweets(spark: SparkSession, paths: Paths) -> DataFrame:
    """A row for each line of each tweet's text; no other field is read."""
    return spark.read.schema(schemas.TWEET).json(paths).select(F.explode(F.split("text", "\n")).alias("text"))


def reviews(spark: SparkSession, paths: Paths) -> DataFrame:
    """``label__{overall}``, summary and text, tab-separated; missing ones read ``null``."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    overall = F.regexp_replace(part("overall"), r"\.0$", "")
    return spark.read.schema(schemas.REVIEW).json(paths).select(F.concat(F.lit("label__"), overall, F.lit("\t"), part("summary"), F.lit("\t"), part("reviewText")).alias("text"))


def tmx(spark: SparkSession, paths: Paths) -> DataFrame:
    """(unit, lang, text) of translation units, but for those with a property of 0.0."""
    units = spark.read.format("xml").option("rowTag", "tu").schema(schemas.TMX).load(paths)
    bad = F.exists(F.coalesce("prop", F.array().cast("array<string>")), lambda p: p == "0.0")
    units = units.filter(~bad).withColumn("unit", F.monotonically_increasing_id())
    return units.select("unit", F.explode("tuv").alias("v")).select("unit", F.col("v.`_xml:lang`").alias("lang"), F.col("v.seg").alias("text"))


def wiki_pages(spark: SparkSession, paths: Paths) -> DataFrame:
    """Text of MediaWiki pages with the commonest markup taken off."""
    pages = spark.read.format("xml").option("rowTag", "page").schema("title string, revision struct<text: string>").load(paths)
    return pages.select("title", wiki_text(F.col("revision.text")).alias("text"))


def wiki_text(markup):
    out = F.regexp_replace(markup, r"(?s)<!--.*?-->|<ref[^>/]*>.*?</ref>|<[^>]+>", "")
    for _ in range(3):
        out = F.regexp_replace(out, r"(?s)\{\{[^{}]*\}\}|\{\|[^{}]*\|\}", "")
    out = F.regexp_replace(out, r"\[\[(?:File|Image|Category):[^\[\]]*\]\]", "")
    out = F.regexp_replace(out, r"\[\[(?:[^|\[\]]*\|)?([^|\[\]]*)\]\]", "$1")
    out = F.regexp_replace(out, r"\[https?://[^ \]]*\s?([^\]]*)\]", "$1")
    return F.regexp_replace(F.regexp_replace(out, r"'{2,}", ""), r"(?m)^[=*#:;]+\s*|\s*=+\s*$", "")


def sum_ngram_years(line) -> tuple:
    """(term, count) of ``term year,matches,books ...``: matches summed over the years."""
    parts = F.split(F.trim(line), r"\s+")
    years = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return X.strip_pos_tag(parts[0]), F.aggregate(years, F.lit(0).cast("long"), lambda a, y: a + F.coalesce(F.get(F.split(y, ","), F.lit(1)).cast("long"), F.lit(0).cast("long")))


def ngram_rows(spark: SparkSession, paths: Paths) -> DataFrame:
    term, count = sum_ngram_years(F.col("value"))
    return spark.read.text(paths).select(term.alias("term"), count.alias("count"))


def _columns(spark: SparkSession, paths: Paths, term: int, count: int, header: bool = False, encoding: str = "UTF-8", sep: str = "\t") -> DataFrame:
    """Two fields, counted from 1, of an unquoted list; rows whose count isn't a number go."""
    width = max(term, count)
    ddl = ", ".join(f"c{i} string" for i in range(1, width + 1))
    rows = spark.read.schema(ddl).option("sep", sep).option("header", header).option("enforceSchema", True).option("quote", "").option("encoding", encoding).option("mode", "PERMISSIVE").csv(paths)
    return rows.select(F.col(f"c{term}").alias("term"), F.expr(f"try_cast(c{count} AS BIGINT)").alias("count")).filter("count IS NOT NULL")


def ngram_counts(spark: SparkSession, paths: Paths) -> DataFrame:
    return _columns(spark, paths, 1, 3)


def leeds(spark: SparkSession, paths: Paths) -> DataFrame:
    line = F.col("value")
    return spark.read.text(paths).filter(X.is_leeds_row(line)).select(X.leeds_term(line).alias("term"), X.leeds_count(line).alias("count"))


def mokk(spark: SparkSession, paths: Paths) -> DataFrame:
    """Latin-2 list with the term in the first field and the count in the third.

    Spark reads Latin-1 but not Latin-2: both are one byte a character, so what
    was read as the one is translated to the other.
    """
    high = bytes(range(0xA0, 0x100))
    rows = _columns(spark, paths, 1, 3, encoding="ISO-8859-1")
    return rows.withColumn("term", F.translate("term", high.decode("iso-8859-1"), high.decode("iso-8859-2")))


SUBTLEX = {"de": (1, 3), "en": (1, 2), "nl": (1, 2), "pl": (1, 5), "zh": (1, 5)}


def subtlex(spark: SparkSession, paths: Paths, lang: str) -> DataFrame:
    return _columns(spark, paths, *SUBTLEX[lang], header=True)


def jieba_dictionary(spark: SparkSession, paths: Paths) -> DataFrame:
    parts = F.split("value", " ")
    return spark.read.text(paths).select(X.simplify_chinese(parts[0]).alias("term"), parts[1].cast("bigint").alias("count"))


def voa(spark: SparkSession, paths: Paths) -> DataFrame:
    return text_lines(spark, paths).select(X.headline(F.col("text")).alias("text"))


def tsv_pairs(spark: SparkSession, paths: Paths, first: int = 1, second: int = 2) -> DataFrame:
    """(text1, text2): two fields, counted from 1."""
    parts = F.split("value", "\t")
    return spark.read.text(paths).select(F.get(parts, F.lit(first - 1)).alias("text1"), F.get(parts, F.lit(second - 1)).alias("text2"))


def count_list(spark: SparkSession, paths: Paths) -> tuple[DataFrame, DataFrame]:
    """(term, count) rows and (total) of a count file; the total is never a row."""
    parts = F.split("value", "\t")
    rows = spark.read.text(paths).select(F.get(parts, F.lit(0)).alias("term"), F.expr("try_cast(get(split(value, '\t'), 1) AS BIGINT)").alias("count"))
    return rows.filter("term <> '__total__'"), rows.filter("term = '__total__'").select(F.col("count").alias("total"))
