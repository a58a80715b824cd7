"""Small document tables with odd rows, and brute-force helpers."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return PLAIN.findall((text or "").translate(LOWER))


def prose(seed, words, stock=400, letters="abcdefghij"):
    draw = random.Random(seed)
    own = random.Random(f"stock-{letters}")
    known = ["".join(own.choices(letters, k=own.randint(2, 7))) for _ in range(stock)]
    return " ".join(draw.choice(known) for _ in range(words))


def odd_rows():
    """Null in every column, empty and wordless texts, repeats, a very long text."""
    return [
        (1, None, None, None, None),
        (2, "", "aa", "s", 0),
        (3, "!!! ... ???", "aa", None, 1),
        (None, "some words without an id here", "aa", "s", 2),
        (5, "Same text twice over, with words.", "aa", "s", 3),
        (5, "Same text twice over, with words.", "aa", "s", 3),
        (6, "one", None, "t", 4),
        (7, "é ü ñ " * 40 + "\n\t\r\x0b end", "bb", "t", 5),
        (8, prose("long", 60_000), "aa", "s", 6),
    ]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def clashing(df, *names):
    """The table with further columns of these names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(f"own {n}") for n in names})
