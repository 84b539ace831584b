import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def prose():
    """prose(seed, words): text of invented words, in lines of a dozen words."""

    def write(seed, words):
        draw = random.Random(seed)
        made = ["".join(draw.choice("aeiou" if i % 2 else "bcdfglmnprst") for i in range(draw.randint(2, 8))) for _ in range(words)]
        made[::3] = [draw.choice(("the", "of", "and", "to", "in", "that")) for _ in made[::3]]
        return "\n".join(" ".join(made[i : i + 12]) for i in range(0, len(made), 12))

    return write


@pytest.fixture
def docs(spark):
    """docs(texts): a documents table with ids 0, 1, ..., or of (id, text) pairs."""

    def build(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs], DOCS)

    return build


@pytest.fixture
def odd(docs, prose):
    """Nulls, empty and blank texts, one long word, a very long text, repeated rows, a null id, clashing columns."""
    from pyspark.sql import functions as F

    long = prose(99, 40_000)
    rows = docs([
        (0, None), (1, ""), (2, " \t\n "), (3, "x" * 200_000), (4, long), (5, prose(5, 60)), (5, prose(5, 60)),
        (None, prose(6, 60)), (None, None), (7, prose(5, 60)), (8, "éÉ ß 漢字 🙂 ﬁ"), (9, "one two"),
    ])
    clash = ("n_words", "kept", "spans", "items", "key", "node", "label", "line", "shard", "slot", "ids", "score", "n_tokens", "class_id")
    return rows.withColumns({c: F.lit("mine") for c in clash})
