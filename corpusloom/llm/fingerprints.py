"""Document fingerprints by winnowing, DataFrame operations only.

The k-grams are of five words. A gram's hash is the polynomial of a rolling
hash, w0 * B^4 + w1 * B^3 + ... + w4 modulo a prime, over hashes of its words;
each word is hashed once. Array functions keep no running state, so a gram is
evaluated from the five word hashes it has rather than from the gram before;
the value is that of the rolling update, which a test holds it against. The
least hash of every window of eight is chosen, the rightmost of equals, and
kept with its place: passages of k + w - 1 = 12 words that two texts share give
both a common fingerprint. A hash and its place are one positive 64-bit number
(31 bits of hash, then the place counted down from 2 ** 32), so one ``least``
picks the rightmost of the smallest and neighbouring windows with the same
choice are one number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize, table

K, WINDOW = 5, 8
PLACES = 32  # bits for the place: more than an array has
PRIME, BASE = (1 << 31) - 1, 1_000_003


def with_words(df: DataFrame, text: str, out: str) -> DataFrame:
    """Lower-cased runs of letters and digits."""
    return df.withColumn(out, F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != ""))


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the chosen numbers of a text, by rising place.

    A text of fewer than five words is one gram, a text without words is one
    gram of itself, the empty text has none. Each step is a column of its own,
    for an array that a later step looks into many times.
    """
    w, h, g = f"_{out}_w", f"_{out}_h", f"_{out}_g"
    df = with_words(df, text, w)
    small = lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME))  # noqa: E731  products of two stay within 64 bits
    df = df.withColumn(h, F.transform(w, small))
    mask = (1 << PLACES) - 1
    pick = lambda x, i: F.shiftleft(x, PLACES).bitwiseOR(F.lit(mask) - i.cast("long"))
    words, hashed = F.col(w), F.col(h)

    def gram(i: Column) -> Column:
        x = F.get(hashed, i)
        for k in range(1, K):
            x = (x * F.lit(BASE) + F.get(hashed, i + k)) % F.lit(PRIME)
        return x

    rolled = F.transform(F.sequence(F.lit(0), F.size(words) - K), lambda i: pick(gram(i), i))
    few = F.array(pick(small(F.concat_ws(" ", words)), F.lit(0)))
    bare = F.array(pick(small(F.col(text)), F.lit(0)))
    none = F.array().cast("array<bigint>")
    df = df.withColumn(g, F.when(F.size(words) >= K, rolled).when(F.size(words) > 0, few).when(F.col(text) != "", bare).otherwise(none))
    grams = F.col(g)
    windows = F.slice(grams, F.lit(1), F.greatest(F.lit(1), F.size(grams) - WINDOW + 1))
    least = F.transform(windows, lambda x, i: F.least(x, *[F.get(grams, i + k) for k in range(1, WINDOW)]))
    return df.withColumn(out, F.array_distinct(least)).drop(w, h, g)


def shown(numbers: Column) -> Column:
    """hash@place, comma-joined."""
    place = lambda x: F.lit((1 << PLACES) - 1).cast("long") - x.bitwiseAND(F.lit((1 << PLACES) - 1).cast("long"))
    return F.array_join(F.transform(numbers, lambda x: F.concat(F.lower(F.hex(F.shiftrightunsigned(x, PLACES))), F.lit("@"), place(x).cast("string"))), ",")


def hashes(numbers: Column) -> Column:
    return F.array_distinct(F.transform(numbers, lambda x: F.shiftrightunsigned(x, PLACES)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two hash sets; 1 for two empty ones."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(all_ == 0, 1.0).otherwise(both / (all_ - both))


def neighbours(ids: DataFrame) -> DataFrame:
    """(doc_id, before_id, before_n): the id before each id, the last one's for the first, and its greatest text length.

    Ids are dealt by ranges and looked at within them; a row for each range
    closes the gaps between ranges, so no task holds more than its range.
    """
    per = ids.groupBy("doc_id").agg(F.max("n").alias("n"))
    dealt = materialize(per.repartitionByRange("doc_id").select("doc_id", "n", F.spark_partition_id().alias("pid")), "ids")
    entry = F.struct("doc_id", "n")
    ends = dealt.groupBy("pid").agg(F.max(entry).alias("last"))  # a row for each range
    every = Window.orderBy("pid")
    total = ends.agg(F.max(F.struct("pid", "last")).alias("m")).select(F.col("m.last").alias("final"))
    ends = ends.select("pid", F.lag("last").over(every).alias("earlier")).crossJoin(F.broadcast(total)).select("pid", F.coalesce("earlier", "final").alias("earlier"))
    before = F.lag(entry).over(Window.partitionBy("pid").orderBy(F.col("doc_id").asc_nulls_first()))
    joined = dealt.withColumn("before", before).join(F.broadcast(ends), "pid")
    before = F.coalesce("before", "earlier")
    return joined.select("doc_id", before["doc_id"].alias("before_id"), before["n"].alias("before_n"))


def keyed(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """An id that may be null, as two columns for equi-joins."""
    return df.withColumn(f"{prefix}0", F.col(column).isNull()).withColumn(f"{prefix}1", F.coalesce(column, F.lit(0).cast("long"))).drop(column)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    A null text counts as empty. Rows with one doc_id follow the same next
    document; where several rows have the next id, the one with the least
    beginning stands for it. A null doc_id comes before all others. An empty
    table gives no rows; a single document is its own next.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length(text).cast("long").alias("n"))
    base = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")), "doc_id", "k")
    befores = keyed(neighbours(ids), "doc_id", "k")
    heads = keyed(base.join(befores, ["k0", "k1"]), "before_id", "k_")
    heads = with_fingerprint(heads, "text", "fp").select(F.col("k_0").alias("k0"), F.col("k_1").alias("k1"), F.struct(F.substr("text", F.lit(1), F.floor(F.col("before_n") / 4).cast("int")).alias("head"), F.col("fp")).alias("next"))
    heads = heads.groupBy("k0", "k1").agg(F.min("next").alias("next"))
    both = base.join(heads, ["k0", "k1"])
    both = both.withColumn("n_chars", F.length("text").cast("long")).withColumn("q", F.floor(F.col("n_chars") / 4).cast("int"))
    edited = F.concat(F.substr("text", F.lit(1), F.col("n_chars").cast("int") - F.col("q")), F.substr("next.head", F.lit(1), F.col("q")))
    both = both.withColumn("edited", edited)
    both = with_fingerprint(with_fingerprint(both, "text", "fp"), "edited", "efp")
    doc_id = F.when(~F.col("k0"), F.col("k1")).alias("doc_id")
    both = both.select(doc_id, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fp", "efp", hashes(F.col("fp")).alias("h"), hashes(F.col("efp")).alias("eh"), hashes(F.col("next.fp")).alias("nh"))
    return both.select("doc_id", "n_chars", "edited_sha256", shown(F.col("fp")).alias("fingerprint"), shown(F.col("efp")).alias("edited_fingerprint"), likeness(F.col("h"), F.col("eh")).alias("near_edited"), likeness(F.col("h"), F.col("nh")).alias("near_next"))


def op2_winnowing(spark, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents"))
