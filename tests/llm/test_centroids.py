import hashlib
import math
import random

import pytest

from tidemark.llm import centroids

SCHEMA = "id long, embedding array<double>, cluster string, v int, distance int"


def table(spark, rows, schema=SCHEMA):
    """Vectors with extra columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], "mine", 1, 2) for i, v in rows], schema)


def brute(rows, k, rounds, dims, scale=256):
    most = centroids.limit_of(dims)
    kept = [
        (i, tuple(int(max(-most, min(most, math.floor(scale * x)))) for x in v)) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    means = [v for _, v in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(means)) for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for j in range(len(means)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == j]
            if own:
                means[j] = tuple(sum(x) // len(own) for x in zip(*own))
    found = assign()
    inertia = {j: sum(d for d, c in found if c == j) for j in range(len(means))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in means]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, found)), key=repr), means


def rows(seed, n, dims=3):
    chance = random.Random(seed)
    out = [(i, [chance.choice([-1, 0, 1]) + chance.gauss(0, 0.2) for _ in range(dims)]) for i in range(n)]
    out += [(1000 + i, out[0][1]) for i in range(n)]  # as many copies as other vectors
    out += [(5, [9.0, 9, 9]), (5, [9.0, 9, 9]), (None, [1.0, 1, 1]), (2000, None), (2001, []), (2002, [1.0, 2]), (2003, [1.0, 2, 3, 4]),
            (2004, [1.0, None, 2]), (2005, [1.0, math.nan, 2]), (2006, [math.inf, 0, 0]), (2007, [1e300, -1e300, 0.0])]
    return out


@pytest.mark.parametrize("k, rounds, cells", [(7, 4, 1 << 18), (1, 2, 16), (40, 3, 9), (500, 2, 64)])
def test_equals_brute_force(spark, scratch, monkeypatch, k, rounds, cells):
    monkeypatch.setattr(centroids, "SLICE_CELLS", cells)
    data = rows(k, 60)
    found, means = centroids.cluster(table(spark, data).repartition(5), scratch, k, rounds, 3)
    wanted, last = brute(data, k, rounds, 3)
    wanted = [(*w[:3], min(w[3], centroids._LONGEST), min(w[4], centroids._LONGEST), w[5]) for w in wanted]
    assert sorted(map(tuple, found.collect()), key=repr) == wanted
    assert list(map(tuple, means.tolist())) == last


def test_ties_go_to_the_smaller_number(spark, scratch):
    data = [(i, [float(x), 0, 0]) for i, x in enumerate([-1, 1, 0, 0, 0])]
    found, _ = centroids.cluster(table(spark, data), scratch, 5, 0, 3, scale=1)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(data, 5, 0, 3, 1)[0]


def test_no_centroids_and_empty_table(spark, scratch):
    found, means = centroids.cluster(table(spark, [(None, [1.0, 1, 1])] * 2), f"{scratch}/a", 3, 2, 3)
    assert [tuple(r) for r in found.collect()] == [(None,) * 6] * 2 and not len(means)
    found, _ = centroids.cluster(table(spark, []), f"{scratch}/b", 3, 2, 3)
    assert found.count() == 0 and found.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_largest_distance_fits():
    for dims in (1, 2, 3, 64, 65, 4096):
        assert dims * (2 * centroids.limit_of(dims)) ** 2 < 1 << 63
