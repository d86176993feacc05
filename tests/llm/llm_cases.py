"""Rows that every operator has to cope with, and small helpers."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside, as columns of the input.
CLASHING = ["k", "digest", "kept", "signature", "component", "node", "spans", "prefix", "keep_id", "hot", "score", "_hot", "n", "_text", "dropped", "_spread"]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def clashing(frame_):
    from pyspark.sql import functions as F

    return frame_.withColumns({name: F.lit("x") for name in CLASHING})


def odd_rows(seed=0):
    """Nulls, empty and blank texts, a long text, ties, repeated rows and ids."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(50)]
    long = " ".join(pick.choice(words) for _ in range(8000))
    usual = " ".join(pick.choice(words) for _ in range(120))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, long), (5, usual), (6, usual.upper()), (7, usual + " one more"),
        (8, usual), (8, usual), (9, "short"), (9, "other words under the same id"), (None, usual), (None, None), (10, "Ä" * 30), (11, "x" * 5000),
    ]


def rows_of(frame_):
    return sorted((tuple(r) for r in frame_.collect()), key=repr)
