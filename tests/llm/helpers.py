"""Small tables for the tests of this folder."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, ids string, key string"


def documents(spark, texts, ids=None):
    """A documents table with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", "s", len(t or ""), "mine", "x", "k") for i, t in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS)


def words(seed: int, n: int) -> list[str]:
    chance = random.Random(seed)
    return ["".join(chance.choice("abcdefghij") for _ in range(chance.randint(3, 8))) for _ in range(n)]


def saved(df, folder, name):
    df.coalesce(2).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
