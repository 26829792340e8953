"""The layout of a collection: buckets, lookups, two writers, vacuum."""

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark import ensure_collection, open_collection
from tidemark.sources import store


def rows(spark, ids, value=0.5):
    payload = F.struct(
        F.col("id").alias("question"), F.array("id").alias("answer"), F.lit("p").alias("product"),
        F.array().cast("array<string>").alias("keywords"), F.lit("s").alias("source"),
    )
    frame = spark.createDataFrame([(f"id{i:05d}",) for i in ids], "id string")
    return frame.select("id", F.array(F.lit(value).cast("float")).alias("vector"), payload.alias("payload"), F.lit(str(value)).alias("question_hash"))


def commit(spark, collection, upserts, deletes=(), points=0, **options):
    data = store.new_data_path(collection.path, collection.name)
    buckets = store.delta_buckets(collection, len(upserts) + len(deletes))
    gone = spark.createDataFrame([(f"id{i:05d}",) for i in deletes], "id string")
    store.write_rows(store.as_rows(rows(spark, upserts, options.pop("value", 0.5)), gone), data, buckets)
    return store.commit_changes(spark, collection, data, len(upserts), len(deletes), points, buckets=buckets, **options)


@pytest.fixture
def filled(spark, tmp_path):
    """A base of 400 points and three deltas, the last one too small for buckets."""
    keep = dict(compact_fraction=10.0)
    collection = ensure_collection(spark, str(tmp_path), "c", 1)
    collection = commit(spark, collection, range(400), points=400, **keep)
    collection = commit(spark, collection, range(50), range(50, 100), 350, value=1.5, **keep)
    collection = commit(spark, collection, range(40, 60), range(20), 340, value=2.5, **keep)
    return commit(spark, collection, [0, 40], [399], 340, value=3.5, **keep)


def expected():
    found = {i: 0.5 for i in range(400)} | {i: 1.5 for i in range(50)}
    found = {i: v for i, v in found.items() if not 50 <= i < 100} | {i: 2.5 for i in range(40, 60)}
    found = {i: v for i, v in found.items() if i >= 20} | {0: 3.5, 40: 3.5}
    del found[399]
    return {f"id{i:05d}": v for i, v in found.items()}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def above(plan, place):
    """Operators between the root and the node on the line that holds ``place``, the nearest first."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if place in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            found.append(line.strip(" :+-"))
            depth = own
    return found


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_newest_rows(spark, filled, limit):
    assert [s[3] for s in filled.segments] == [8, 8, 8, 0]
    found = {r.id: r.vector[0] for r in store.read_rows(spark, filled, limit).collect()}
    assert found == expected()
    again = open_collection(spark, filled.path, "c")
    assert again == filled


def test_base_and_large_deltas_are_not_exchanged(spark, filled):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(store.read_rows(spark, filled, broadcast_rows=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [line for line in plan.splitlines() if "FileScan" in line and "vector" in line]
    assert len(wide) == 4
    for line in wide[:3]:
        assert "Bucketed: true" in line
        nodes = above(plan, line.strip(" :+-"))
        assert any(n.startswith("SortMergeJoin") for n in nodes) and not any("Exchange" in n for n in nodes)


def test_another_session_finds_the_buckets(spark, filled):
    for _, _, data, _ in filled.segments[:3]:
        spark.sql(f"DROP TABLE {store._table(data)}")
    assert {r.id: r.vector[0] for r in store.read_rows(spark, open_collection(spark, filled.path, "c"), 0).collect()} == expected()


def test_compaction_exchanges_no_row(spark, filled, monkeypatch):
    plans = []
    write = store.write_rows

    def watched(frame, data, buckets):
        plans.append((plan_of(frame), buckets))
        return write(frame, data, buckets)

    monkeypatch.setattr(store, "write_rows", watched)
    merged = commit(spark, filled, range(500, 520), points=360, compact_fraction=0.0)
    plan, buckets = plans[-1]
    assert buckets == merged.buckets == 8 and merged.deltas == 0
    wide = [line for line in plan.splitlines() if "FileScan" in line and "vector" in line]
    assert len(wide) == 5 and not any(n.startswith("Exchange") for line in wide for n in above(plan, line.strip(" :+-")))
    found = {r.id: r.vector[0] for r in store.read_rows(spark, merged).collect()}
    assert found == expected() | {f"id{i:05d}": 0.5 for i in range(500, 520)}


def test_outgrown_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "BUCKET_POINTS", 10)
    collection = commit(spark, ensure_collection(spark, str(tmp_path), "c", 1), range(40), points=40)
    assert collection.buckets == 8
    collection = commit(spark, collection, range(1000), points=1000)
    assert (collection.buckets, collection.deltas) == (128, 0)
    assert store.count_points(spark, collection) == 1000


def test_lookup_reads_few_buckets(spark, filled):
    ids = ["id00000", "id00055", "id00399", "id09999"]
    found = store.read_rows(spark, filled, ids=ids)
    assert {r.id: r.vector[0] for r in found.collect()} == {"id00000": 3.5, "id00055": 2.5}
    chosen = [int(n) for n in re.findall(r"SelectedBucketsCount: (\d+) out of 8", plan_of(found))]
    assert chosen and max(chosen) <= 4
    with pytest.raises(ValueError, match="looked up"):
        store.read_rows(spark, filled, ids=["x"] * 1001)


def test_the_first_of_two_writers_has_the_version(spark, tmp_path):
    created = ensure_collection(spark, str(tmp_path), "c", 1)
    first = commit(spark, created, range(10), points=10)
    with pytest.raises(RuntimeError, match="another writer"):
        commit(spark, created, range(20, 25), points=5)
    # A writer that died before it withdrew its record.
    folder = tmp_path / "c" / "commits"
    record = next(p for p in folder.glob("v=00000002*/part-*.json"))
    late = folder / "v=00000002-zzz" / "part-0.json"
    late.parent.mkdir()
    late.write_text(record.read_text().replace('"points":10', '"points":99'))
    os.utime(late, (time.time() + 60,) * 2)
    found = open_collection(spark, str(tmp_path), "c")
    assert found == first and found.points == 10
    assert commit(spark, found, [77], points=11).version == 3


def test_vacuum(spark, filled):
    path = filled.path
    assert store.vacuum(spark, path, "c") == [] and store.vacuum(spark, path, "nothing") == []
    kept = store.vacuum(spark, path, "c", grace_hours=0)
    assert len(kept) == 1  # the empty base of the beginning
    reader = store.read_rows(spark, filled)
    merged = commit(spark, filled, [600], points=341, compact_fraction=0.0)
    # Two versions are kept: the reader of the one before still finds its rows.
    assert len(store.vacuum(spark, path, "c", keep_versions=2, grace_hours=0)) == 1  # the delta folded into the new base
    assert {r.id: r.vector[0] for r in reader.collect()} == expected()
    gone = store.vacuum(spark, path, "c", grace_hours=0)
    assert len(gone) == 4
    now = open_collection(spark, path, "c")
    assert now == merged and {r.id for r in store.read_rows(spark, now).collect()} == {*expected(), "id00600"}
    left = {d for d in os.listdir(f"{path}/c/data")}
    assert left == {merged.segments[0][2].rsplit("/", 1)[-1]}
    assert len(os.listdir(f"{path}/c/commits")) == 1
