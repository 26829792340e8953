import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import documents, words

from tidemark.llm import resampling


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, buckets):
    w = cut(text)
    grams = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    return [zlib.crc32(g.encode()) % buckets for g in grams]


def brute(docs, target, share=5, of=100, least=20, buckets=10_000):
    """Rows (doc, n_features, weight, score, rank or None), documents given as (id, text)."""
    found = [runs(t, buckets) for _, t in docs]
    own, wanted = Counter(b for f in found for b in f), Counter(b for t in target for b in runs(t, buckets))
    total, much = sum(own.values()), sum(wanted.values())
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (total + buckets) / ((own[b] + 1) * (much + buckets)))) for b in range(buckets)
    ]
    rows = []
    for (i, t), f in zip(docs, found):
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    drawn = sorted((r for r, (_, t) in zip(rows, docs) if len(cut(t)) >= least), key=lambda r: (-r[3], r[0] is not None, r[0]))
    for place, row in enumerate(drawn[: share * len(drawn) // of], 1):
        row[4] = place
    return sorted(map(tuple, rows), key=repr)


def texts(seed, n):
    chance = random.Random(seed)
    out = [(chance.choice([" ", ", ", "\n", "-_ "])).join(words(chance.random(), chance.randint(0, 60))) for _ in range(n)]
    return out + ["", None, "One two THREE", "é ß É", "x" * 5000, " ".join(["y" * 64, "z" * 65, "w" * 63] * 9), "a b " * 300]


COLUMNS = ("id", "n_features", "weight", "score", "rank")


def rows_of(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("piece, rows, share, buckets", [(1 << 20, 4096, 5, 10_000), (50, 7, 30, 97), (200, 20, 100, 10_000), (1 << 20, 3, 0, 50)])
def test_equals_brute_force(spark, scratch, monkeypatch, piece, rows, share, buckets):
    monkeypatch.setattr(resampling, "PIECE", piece)
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", rows)
    own, target = texts(3, 90), texts(4, 20)
    frame = documents(spark, own).repartition(5)
    found = resampling.resample(
        frame, spark.createDataFrame([(t,) for t in target], "text string"), scratch, share=share, buckets=buckets, columns=("text", "key")
    )
    assert rows_of(found) == brute(list(enumerate(own)), target, share, buckets=buckets)
    assert {r.row.text for r in found.collect()} == set(own)


def test_checksums_of_runs():
    chance = random.Random(5)
    some = [bytes(chance.choices(range(97, 123), k=chance.choice([1, 2, 7, 63, 64, 65, 200]))) for _ in range(400)]
    one = np.array([zlib.crc32(w) for w in some], np.uint32)
    size = np.array([len(w) for w in some])
    two = resampling._longer(one[:-1], some[1:], one[1:], size[1:])
    assert two.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(some, some[1:])]


def test_one_row_repeated_very_often(spark, scratch, monkeypatch):
    """Equal scores and ids are spread over segments, and every rank is given once."""
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", 10)
    text = " ".join(words(1, 30))
    own = [(None, text)] * 300 + [(7, text)] * 100 + [(i, " ".join(words(i, 25))) for i in range(200)]
    frame = documents(spark, [t for _, t in own], [i for i, _ in own]).repartition(6)
    target = spark.createDataFrame([(text,)], "text string")
    found = resampling.resample(frame, target, scratch, share=50)
    ranks = sorted(r.rank for r in found.collect() if r.rank is not None)
    assert ranks == list(range(1, 301))
    by_rank = sorted((r.rank, -r.score, r.id is not None, r.id) for r in found.collect() if r.rank is not None)
    assert [x[1:3] for x in by_rank] == sorted(x[1:3] for x in by_rank)
    segments = spark.read.parquet(f"{scratch}/segments").groupBy("segment").count().collect()
    assert len(segments) > 30 and max(r["count"] for r in segments) < 60


def test_empty_tables(spark, scratch):
    none = spark.createDataFrame([], "text string")
    assert resampling.resample(documents(spark, []), none, f"{scratch}/a").count() == 0
    own = texts(6, 30)
    found = resampling.resample(documents(spark, own), none, f"{scratch}/b")
    assert rows_of(found) == brute(list(enumerate(own)), [])
