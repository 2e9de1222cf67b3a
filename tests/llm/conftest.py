import pytest

from feedpulse.llm.ship import ship

LONG = "word after word " * 5_000
CLASHING = (
    "fingerprint component_id score predicted ids token_starts n_tokens epoch block place bytes shard depth"
    " raw raw_text row node number redo n_entities label source Lang best_score decoded group"
).split()


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text[, source]) tuples."""

    def make(*rows):
        full = [(i, t, "en", rest[0] if rest else "s", len(t) if t else None) for i, t, *rest in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def messy(make_docs):
    """Nulls in every column, empty, blank and long texts, and repeated rows."""
    return make_docs(
        (1, "The same text of a few words"), (1, "The same text of a few words"), (2, None), (3, ""), (4, " \n\t "),
        (5, LONG), (None, "no id here"), (6, "short"), (7, "mail bob@site.example now", None), (None, None, None),
    )


@pytest.fixture(scope="session")
def clashing(messy):
    """The same with columns named like those that operators add or use inside."""
    from pyspark.sql import functions as F

    own = {c.lower() for c in messy.columns}
    return messy.select("*", *[F.lit("x").alias(c) for c in CLASHING if c.lower() not in own])
