import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use for columns of their own.
        *(T.StructField(n, T.StringType()) for n in ("score", "th", "k", "n", "h", "a", "b", "d1", "spans", "start", "ids")),
    ]
)


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text[, lang]) as a documents table with extra columns of clashing names."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), *["x"] * 11) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture
def odd():
    """NULL and empty values, white space, a very long word and text, other scripts, ties."""
    same = "one and the same text of more than five words here"
    return [
        (1, None), (2, ""), (3, "   \n\t "), (4, "x" * 20_000), (5, "word " * 5_000), (6, "ß é 執 벨 😀 \x00 ▁ a▁b"),
        (7, same), (8, same), (8, same), (None, same), (None, None), (9, "a"), (10, "<|endoftext|> </s> <0x41>"),
        (11, "two  spaces   three \n and a line "),
    ]
