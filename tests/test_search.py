import math
import random

import pytest

from tidemark.operators import search


def brute(points, queries, k, metric, skip):
    def distance(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        if metric == "Dot":
            return -dot
        if metric == "Euclid":
            return math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b)))
        size = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return 1 - (dot / size if size else 0)

    out = []
    for q, a in queries:
        near = sorted((round(distance(a, b), 9), p) for p, b in points if b is not None and len(b) == 3 and not (skip and p == q))[:k]
        out += [(q, p, d, r) for r, (d, p) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("metric, k, skip, cells", [("Cosine", 3, False, 1 << 20), ("Dot", 7, True, 8), ("euclid", 400, False, 1 << 20), ("Euclid", 2, True, 30)])
def test_equals_brute_force(spark, monkeypatch, metric, k, skip, cells):
    monkeypatch.setattr(search, "SLICE_CELLS", cells)
    monkeypatch.setattr(search, "BLOCK_CELLS", cells)
    chance = random.Random(k)
    points = [(i, [float(chance.randint(-3, 3)) for _ in range(3)]) for i in range(150)]  # many ties
    points += [(200, None), (201, [1.0]), (202, [0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(points, "id long, vector array<double>").repartition(5)
    found = search.nearest(frame, frame.where("id % 20 = 0"), k, metric, skip_same=skip)
    queries = [p for p in points if p[0] % 20 == 0 and p[1] and len(p[1]) == 3]
    rows = sorted((r.query, r.id, round(r.distance, 9), r.rank) for r in found.collect())
    wanted = brute(points, queries, k, metric.capitalize(), skip)
    if metric == "Cosine":  # equal cosines may differ in the last bit
        rows, wanted = ([(r[0], r[3], abs(r[2])) for r in sorted(x, key=lambda r: (r[0], r[3]))] for x in (rows, wanted))
        assert rows == wanted
    else:
        assert rows == wanted


def test_no_queries_and_unknown_metric(spark):
    frame = spark.createDataFrame([(1, [1.0])], "id long, vector array<double>")
    assert search.nearest(frame, frame.limit(0), 3).count() == 0
    with pytest.raises(ValueError, match="unknown metric"):
        search.nearest(frame, frame, 3, "Manhattan")
