"""Schemas of the stages; every reader is given one, none is inferred."""

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "strings": T.ArrayType(T.StringType())}


def _schema(fields: str) -> T.StructType:
    """``name kind`` pairs; unlike DDL it needs no session."""
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in (f.split() for f in fields.split(", "))])


DOC = _schema("source string, lang string, pos long, text string")
TAGGED = _schema("lang string, text string")
COUNTS = _schema("source string, lang string, token string, count long")
TOTALS = _schema("source string, lang string, total long")
FREQS = _schema("lang string, word string, freq double")
TIERS = _schema("lang string, neg_cb int, words strings")
JIEBA = _schema("word string, ppb long")
REDDIT = _schema("score long, body string, subreddit string")
TWEET = _schema("text string")
REVIEW = _schema("overall double, summary string, reviewText string")
TMX = T.StructType([T.StructField("prop", T.ArrayType(T.StringType())), T.StructField("tuv", T.ArrayType(_schema("_xml:lang string, seg string")))])
PAIR = _schema("pos long, text1 string, text2 string")
VOCAB = _schema("idx int, uri string")
COORDS = _schema("idx1 int, idx2 int, n long")
