"""Small tables that hold every awkward row, and brute-force twins of the operators."""

import random
import re

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def prose(rng, n, size=400):
    return " ".join(f"{rng.choice('bdfglmnprst')}{rng.choice('aeiouäé')}{rng.randrange(size)}" for _ in range(n))


def awkward_docs(seed=1):
    """Nulls in each column, empty and long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    passage = prose(rng, 60)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "b", 1),
        (3, base + " extra", None, "a", None),
        (4, None, "en", "a", 0),
        (5, "", "en", None, 0),
        (6, " \t\n\x0b\x0c\r ", "en", "b", 7),
        (7, "x", "en", "", 1),
        (8, prose(rng, 40) + " " + passage + " " + prose(rng, 30), "de", "c", 9),
        (9, passage + "\n" + prose(rng, 5), "de", "c", 9),
        (9, passage + "\n" + prose(rng, 5), "de", "d", 9),
        (10, prose(rng, 20_000, 5000), "en", "a", 1),
        (11, "A" * 5000 + " " + "word " * 300, "en", "b", 1),
        (None, base, "en", "a", 1),
        (None, None, None, None, None),
        (12, "No-break space, \U0001f600 emoji and   line", "en", "e", 3),
        (7, "x", "en", "", 1),
        (-3, base, "en", "f", 1),
    ]
    return rows + [(100 + k, base.replace(base.split()[k], "changed", 1), "en", "abc"[k % 3], k) for k in range(20)]


def frame(spark, rows, schema=DOC_SCHEMA):
    return spark.createDataFrame(rows, schema)


def clashing(df, *names):
    """The table with extra columns named like the operator's own."""
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit("clash"))
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
