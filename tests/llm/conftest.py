import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("salt", T.StringType()),
     T.StructField("sha", T.StringType()), T.StructField("cls", T.StringType())]
)


def odd_texts() -> list[str | None]:
    """Empty, null, very long, repeated and near-equal texts, and awkward white space."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["the", "ou", "re", "an", "É", "ß", "x1", "9"]) for _ in range(rng.randint(1, 3)))
    base = [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(25)]
    near = [b.replace("the", "The", 1) + rng.choice(["", ".", " end"]) for b in base]
    spaced = [b.replace(" ", "  ", 1) for b in base[:5]] + [b.replace(" ", "\n", 2) for b in base[5:9]]
    return [None, "", " ", "\n\t ", "a", "a b", "a b c", "A B C", *base, *base[:7], *near, *spaced, None, "", " ".join(base) * 40, "x" * 9000, "+1 (", "@", "0", "１ ２ ３"]


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with odd texts, extra columns with names that operators use inside, nulls in every column, repeated rows."""
    texts = odd_texts()
    rows = [(3 * k + 1, t, None if k % 7 == 0 else ["en", "fr"][k % 2], None, None, "s", None, "c") for k, t in enumerate(texts)]
    rows += [rows[9], (None, "a b", "en", "src", 3, "s", "h", "c")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
