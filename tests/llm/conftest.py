import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, node long, row long, digest string, size string, tokens string, slot string, _id string, _key string, n string"


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with columns whose names operators use themselves."""
    full = [(i, t, la, so, None if t is None else len(t), "k", 1, 2, "d", "s", "t", "sl", "i", "ke", "n") for i, t, la, so in rows]
    return spark.createDataFrame(full, SCHEMA)


def words(seed, n, vocabulary=2000):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def messy_rows():
    body = words(1, 60)
    near = [*body[:30], "changed", *body[31:]]
    long = " ".join(words(9, 30_000, 50_000))
    lines = "\n".join(["line one here", "line two here", "line three here", "line four here"])
    return [
        (1, " ".join(body), "en", "a"),
        (2, "  ".join(body) + "\n", "en", "a"),
        (3, " ".join(near), "en", "b"),
        (4, " ".join(body).upper(), "de", "b"),
        (5, None, "en", "a"),
        (6, "", None, "a"),
        (7, " \t\n ", "en", None),
        (8, long, "en", "c"),
        (9, "ab", "de", "c"),
        (9, "ab", "de", "c"),
        (10, "ab", None, "c"),
        (11, lines, "en", "a"),
        (12, "start\n" + lines + "\nend", "en", "b"),
        (12, "start\n" + lines + "\nend", "en", "b"),
        (None, "no id here at all", "en", "a"),
        (None, None, None, None),
        (13, "éàü ß ΣΑΣ İx 漢字 \U0001f600 it's", "fr", "a"),
        (14, "mail a.b@c-d.org from 10.0.0.1 and call +1 (741) 555-3069 pay 4111 1111 1111 1111.", "en", "b"),
        (15, "x" * 5000, "en", "b"),
        (16, "9" * 3000 + "@" * 50, "en", "b"),
    ]


@pytest.fixture(scope="session")
def messy(spark):
    return frame(spark, messy_rows()).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, []).cache()
