import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"

PROSE = ("The quick brown fox jumps over the lazy dog while seven wizards quietly hum a tune about rivers, "
         "mountains and old clocks that nobody ever winds again. ") * 1
OTHER = ("Grüße aus Köln: während der Regen fällt, zählen müde Bäcker ihre Brötchen, und draußen läuft ein Hund "
         "über die nasse Straße zum Fluß hinunter, ohne sich umzusehen. ")


def long_text(n=30_000, seed=3):
    import random

    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß", k=rng.randint(2, 9))) for _ in range(n))


EDGES = [
    (1, PROSE + "One more sentence of its own for the first text."),
    (2, None),
    (3, ""),
    (None, PROSE + "A row without an id."),
    (4, PROSE),
    (5, PROSE),
    (5, PROSE),              # a repeated row
    (5, OTHER),              # the same id, another text
    (6, " \n\t \r\n"),
    (7, OTHER + PROSE + OTHER),
    (8, "é" * 70),
    (9, "ab" * 200),
    (10, "ab" * 200 + "c"),
    (11, long_text() + " " + PROSE),
    (12, "a<|endoftext|>b \x00 <|endof"),
    (13, "one two"),
    (None, None),
    (-5, OTHER),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id long, text string").repartition(3).cache()


#: Names that operators use for columns of their own.
CLASHES = ("quality", "facts", "repeats", "shard", "contamination", "text_key", "candidates", "words", "bitmap", "place", "copy",
           "token_ids", "decoded", "n_tokens", "Fingerprint", "a.b", "rows")


@pytest.fixture(scope="session")
def clashing(spark, edges):
    from pyspark.sql import functions as F

    return edges.select("doc_id", "text", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"),
                        F.length("text").cast("long").alias("n_chars"), *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
