"""Small documents with the awkward cases, and plain versions of the operators."""

from __future__ import annotations

import random
import re

SPACE = r"[\x20\x09-\x0D]+"
#: Extra columns whose names operators use themselves.
CLASHING = ["id", "tie", "line", "sig", "print", "component", "n", "at", "kept", "tokens", "h", "words", "lines", "row"]


def words_of(text):
    return [w for w in re.split(SPACE, text or "") if w]


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def awkward_rows(seed=3):
    """(doc_id, text): nulls, empty and blank texts, repeated rows, copies, near copies, shared passages, one long text."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(30, 90)) for _ in range(12)]
    passage = sentence(rng, 40)
    rows = list(enumerate(base))
    rows += [(100 + k, base[0]) for k in range(4)]
    rows += [(200 + k, base[1].replace(base[1].split()[k + 5], "changed", 1)) for k in range(4)]
    rows += [(300 + k, f"{sentence(rng, 10)}\n{passage}\n{sentence(rng, 12)} password = hunter{k}22 ") for k in range(4)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "one two"), (405, None), (406, "é ü 日本語 🙂 x")]
    rows += [(500, "again " * 300), (501, "\n".join([base[2]] * 3))]
    rows += [(600, " ".join(base) + "\n" + sentence(rng, 4000))]
    return rows + [rows[0], rows[12], (400, None)]


def frame(spark, rows, clashing=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clashing:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit("x").alias(c) for c in CLASHING])
    return df
