"""Hand-made documents with every odd case, for all operators."""

import random

from pyspark.sql import types as T

TEMPORARY = ("__id", "__key", "__removed", "__lines", "__f", "__kept", "__w", "__n_words", "__node", "__digest", "__found", "__h")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for their own columns elsewhere.
        T.StructField("id", T.StringType()),
        T.StructField("found", T.StringType()),
        T.StructField("score", T.DoubleType()),
        *(T.StructField(name, T.StringType()) for name in TEMPORARY),
    ]
)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}x" for _ in range(n))


def rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "other"
    texts = [
        (1, base),
        (2, base),
        (3, " ".join(near)),
        (3, " ".join(near)),
        (4, prose(2, 90)),
        (5, None),
        (6, ""),
        (7, "   \n\n "),
        (8, "###!!!"),
        (None, prose(3, 70)),
        (None, None),
        (9, "x" * 200_000),
        (10, "one two\n" * 3000),
        (11, "é ß 日本語 🙂 ▁ token: 'abcdef12' user@mail.example.org"),
        (12, "short"),
        (12, "another text of the same id"),
    ]
    return [(i, t, "en", "s", len(t or ""), "a", "b", 0.5, *TEMPORARY) for i, t in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
