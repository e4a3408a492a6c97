"""Fixtures and plain-Python versions that the operators are compared with."""
import re

from pyspark.sql import types as T

#: Columns whose names the operators use inside, and extra ones.
CLASH = ["k1", "k2", "score", "fp", "n", "w", "term", "drop", "hits", "items", "h", "at", "cut", "start", "length", "hashes",
         "n_tokens", "predicted", "kept", "n_lines", "_k1", "value", "__k1", "__k2", "__drop", "__may", "__cuts", "_host", "_template", "sid", "root", "n_shingles"]


def edge_rows():
    """Null ids and texts, empty and blank texts, repeated rows, ties, one very long text."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    line = "the same line of words in every one of these documents"
    return [(None, "text without an id"), (1, None), (2, ""), (3, " \t\n "), (4, "a b c"), (4, "a b c"), (5, "A B C"), (5, "other"),
            (6, long), (7, long), (8, f"{line}\n{line} two\nown {line[:9]}"), (9, f"x\n{line}\n{line} two\n\nend"), (10, "\n\n"),
            (11, "é" * 700), (12, "é" * 700), (None, None)]


def docs_of(spark, rows, clash=True):
    extra = CLASH if clash else []
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *[T.StructField(c, T.StringType()) for c in extra]])
    return spark.createDataFrame([(i, t, *["z"] * len(extra)) for i, t in rows], schema)


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def words(text):
    """Words of the decontamination contract."""
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
