"""Documents with every odd case, shared by the tests of all operators."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; an input may have them too.
CLASHES = ("id", "crc", "hash", "fp", "node", "component", "rank", "pos", "dropped", "text_hash", "h1", "salt", "kept", "n_words", "row", "answer", "spans", "_id", "score", "piece", "shard")


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    words = ["the", "of", "and", "to", "in"] + [f"w{i}x" for i in range(400)]
    return " ".join(rng.choice(words) + ("." if i % 11 == 10 else "") + ("\n" if i % 37 == 36 else "") for i in range(n)).replace("\n ", "\n")


def odd_rows() -> list[tuple]:
    base = prose(120, 1)
    shared = "this very common line stands in many documents"
    rows = [
        (0, base, "en", "a", 1),
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", None, 3),
        (4, base, "en", "b", 1),  # exact copy
        (5, base.replace("w1x", "w2x", 1), "en", "b", 1),  # near copy
        (6, prose(20_000, 2), "en", "a", 2),  # very long
        (7, "x" * 100_000, "en", "a", 3),  # one endless word
        (8, "héllo wörld ñandú " * 30, "es", "c", 4),
        (9, f"{shared}\n{prose(60, 3)}\n{shared}", "en", "c", 5),
        (10, f"  {shared.upper()}\n{prose(60, 4)}", "en", "c", 5),
        (11, f"{prose(60, 5)}\n{shared}", "en", "c", 5),
        (12, "\U0001f642 中文 \x1c tab\x0bfeed\x0c <|endoftext|>", None, "d", 6),
        (None, prose(80, 6), "en", "d", 7),
        (None, None, None, None, None),
        (13, prose(55, 7) + " " + base, "de", "d", 8),
    ]
    return rows + [rows[9], rows[9], rows[0]]  # repeated rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit(f"clash {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def plain(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
