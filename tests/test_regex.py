"""The linear-time e-mail-token pattern accepts exactly what the plain one does."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from flagstar.functions.rules import contains_email

PLAIN = r"[^@\s]+@[^@\s]+\.[^@\s]+"


def test_same_rows_match_on_random_texts(spark):
    rng = random.Random(7)
    alphabet = "ab@. \n\t"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24))) for _ in range(20_000)]
    texts += ["a@b.c", "x a@b.c y", "@a.b", "a@.b", "a@b.", "a@@b.c", "a@b@c.d", "a.b@c", ".@a.b", "a@b..c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    diff = df.filter(F.col("t").rlike(PLAIN) != contains_email("t"))
    assert diff.count() == 0


def test_long_tokens_stay_fast(spark):
    df = spark.createDataFrame([("x" * 60_000 + " a@b.c",)], "t string")
    start = time.perf_counter()
    assert df.select(contains_email("t")).first()[0] is True
    assert time.perf_counter() - start < 5
