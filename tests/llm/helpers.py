import random

TABLES = ("documents", "pages", "benchmark", "labels")
ODD_ROWS = [(1, "the same text again and again", "x"), (1, "the same text again and again", "x"), (2, None, None), (3, "", "y"),
            (4, " \t\n ", "y"), (None, "no id at all here", None), (5, "word", "z"), (6, "ünï çødé ✓ 漢字 \U0001F600", "z")]


def docs_of(spark, rows):
    """doc_id, text and a column whose name the operators use inside."""
    return spark.createDataFrame(rows, "doc_id long, text string, shard string")


def long_text(seed, n=30_000):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(n))
