import json

import pytest
from pyspark.sql import functions as F

from tidemark import apply_changes, dedup_last, diff, load_state, next_state, op_counts, save_state, with_identity
from tidemark.operators.diff import current_points, deletions, inserts, keep_sources, unchanged, updates
from tidemark.sources.state import parse_state, state_documents, state_points

ITEM = "source string, pos bigint, q string, a string, product string, keywords array<string>"


def items(spark, rows, change_key="question"):
    full = [(s, p, q, a, "x", ["k"]) for s, p, q, a in rows]
    return with_identity(spark.createDataFrame(full, ITEM), change_key=change_key)


def state_of(identified):
    return next_state(diff(identified, identified.sparkSession.createDataFrame(
        [], "point_id string, source_file string, question_hash string")))


def ops(compared):
    return {(r.source_file or r.previous_source, r.op): r.n for r in compared.groupBy(
        "source_file", "previous_source", "op").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_scenario(spark):
    previous = state_of(items(spark, [("docs/faq.json", 0, "q1", "a"), ("docs/manual.json", 0, "q1", "a")]))
    now = items(spark, [("docs/faq.json", 0, "q1", "a"), ("docs/faq.json", 1, "q3", "a"), ("docs/nuevo.json", 0, "q4", "a")])
    compared = diff(now, previous)
    assert ops(compared) == {("docs/faq.json", "unchanged"): 1, ("docs/faq.json", "insert"): 1,
                             ("docs/nuevo.json", "insert"): 1, ("docs/manual.json", "delete"): 1}
    assert next_state(compared).count() == 3
    current = current_points(now)
    assert inserts(current, previous).count() == 2
    assert [r.source_file for r in deletions(current, previous).collect()] == ["docs/manual.json"]
    assert unchanged(current, previous).count() == 1 and updates(current, previous).count() == 0


def test_rerun_empty_and_first(spark):
    now = items(spark, [("f", i, f"q{i}", "a") for i in range(5)])
    state = state_of(now)
    counts = lambda compared: {r.op: (r.ids, r["items"]) for r in op_counts(compared).collect()}
    assert counts(diff(now, state)) == {"unchanged": (5, 5)}
    assert counts(diff(now.limit(0), state)) == {"delete": (5, 0)}
    assert counts(diff(now, state.limit(0))) == {"insert": (5, 5)}


def test_answer_changes_show_only_with_the_content_key(spark):
    for key, expected in (("question", "unchanged"), ("content", "update")):
        before, after = items(spark, [("f", 0, "q", "old")], key), items(spark, [("f", 0, "q", "new")], key)
        assert [r.op for r in diff(after, state_of(before)).collect()] == [expected]


def test_odd_previous_entries(spark):
    now = items(spark, [("f", i, f"q{i}", "a") for i in range(4)])
    ids = {r.q: r.point_id for r in now.collect()}
    hashes = {r.q: r.question_hash for r in now.collect()}
    previous = spark.createDataFrame(
        [(ids["q0"], None, None), (ids["q1"], "f", None), (ids["q2"], None, hashes["q2"]), (ids["q3"], "f", "0")],
        "point_id string, source_file string, question_hash string")
    found = {r.point_id: r.op for r in diff(now, previous).collect()}
    assert [found[ids[f"q{i}"]] for i in range(4)] == ["insert", "update", "unchanged", "update"]
    current = current_points(now)
    assert {r.point_id for r in inserts(current, previous).collect()} == {ids["q0"]}
    assert {r.point_id for r in updates(current, previous).collect()} == {ids["q1"], ids["q3"]}
    assert {r.point_id for r in unchanged(current, previous).collect()} == {ids["q2"]}


def test_duplicates_last_position_wins(spark):
    now = items(spark, [("f", 0, "q", "first"), ("f", 2, "q", "last"), ("f", 1, "q", "middle"), ("b\\c", 9, "z", "raw"), ("b/c", 0, "z", "slash")])
    last = {r.q: (r.pos, r.a) for r in dedup_last(now).collect()}
    assert last == {"q": (2, "last"), "z": (9, "raw")}
    current = {r.source_file: (r.pos, r.copies) for r in current_points(now).collect()}
    assert current == {"f": (2, 3), "b\\c": (9, 2)}


def test_hot_id_is_reduced_before_the_shuffle(spark):
    """A third of the rows share one id; each map task sends one row of it."""
    rows = spark.range(0, 30_000, numPartitions=4).select(
        F.lit("f").alias("source"), F.col("id").alias("pos"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("q"))
    current = current_points(with_identity(rows))
    hot = current.where("copies > 1").collect()
    assert [(r.copies, r.pos) for r in hot] == [(10_000, 29_997)] and current.count() == 20_001
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "partial_count" in plan
    plan = dedup_last(with_identity(rows))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert dedup_last(with_identity(rows)).count() == 20_001


def test_both_sides_are_shuffled_once(spark):
    now = items(spark, [("f", i, f"q{i}", "a") for i in range(5)])
    plan = diff(now, state_of(now))._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("small", [True, False])
def test_unread_files_keep_their_points(spark, small):
    previous = state_of(items(spark, [("bad.json", 0, "q1", "a"), ("gone.json", 0, "q2", "a"), ("ok.json", 0, "q3", "a")]))
    now = items(spark, [("ok.json", 0, "q3", "a")])
    unread = spark.createDataFrame([("bad.json",), ("bad.json",), ("other.json",)], "source string")
    kept = keep_sources(diff(now, previous), unread, small)
    assert ops(kept) == {("bad.json", "unchanged"): 1, ("gone.json", "delete"): 1, ("ok.json", "unchanged"): 1}
    assert {r.source_file for r in next_state(kept).collect()} == {"bad.json", "ok.json"}


def test_apply_changes(spark):
    frame = lambda pairs: spark.createDataFrame(pairs, "id string, v int")
    points = frame([("a", 1), ("b", 2), ("c", 3)])
    after = apply_changes(points, frame([("b", 20), ("d", 4), ("e", 5)]), frame([("c", 0), ("e", 0), ("zz", 0)]))
    assert {(r.id, r.v) for r in after.collect()} == {("a", 1), ("b", 20), ("d", 4)}


def test_state_file_repair(spark):
    entry = '{"i1":{"source_file":"f","question_hash":"h"},"i2":{},"i3":{"source_file":"g"}}'
    texts = {
        "good": '{"version":"1.0","last_run_utc":"t","indexed_points":%s}' % entry,
        "foreign": '{"version":"2.0","indexed_points":%s,"more":1}' % entry,
        "no version": '{"indexed_points":%s}' % entry,
        "points list": '{"version":"1.0","indexed_points":[1]}', "no points": '{"version":"1.0"}',
        "list": "[]", "broken": '{"version":', "trailing": '{"version":"2.0"} x', "quotes": "{'version':'2.0'}",
    }
    frame = spark.createDataFrame(list(texts.items()), "name string, value string")
    found = {}
    for name in texts:
        parsed = parse_state(frame.where(F.col("name") == name))
        row = parsed.first()
        points = {r.point_id: (r.source_file, r.question_hash) for r in state_points(parsed).collect()}
        found[name] = (row.version, row.last_run_utc, row.version_mismatch, points)
    full = {"i1": ("f", "h"), "i2": (None, None), "i3": ("g", None)}
    empty = ("1.0", None, False, {})
    assert found == {
        "good": ("1.0", "t", False, full), "foreign": ("2.0", None, True, full), "no version": ("1.0", None, False, full),
        "points list": empty, "no points": empty, "list": empty, "broken": empty, "trailing": empty, "quotes": empty}


def test_state_round_trip(spark, tmp_path):
    state = state_of(items(spark, [("ñ.json", i, f"q{i}", "a") for i in range(50)]))
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    assert save_state(state, one) == 50
    assert save_state(state, many, rows_per_file=10) == 50
    wanted = {tuple(r) for r in state.collect()}
    for path in (one, many):
        loaded = load_state(spark, path)
        assert {tuple(r) for r in loaded.points.collect()} == wanted
        assert all(r.version == "1.0" and not r.version_mismatch for r in loaded.runs.collect())
    files = list((tmp_path / "one").glob("part-*"))
    texts = [f.read_text("utf-8") for f in files if f.stat().st_size]
    assert len(texts) == 1
    document = json.loads(texts[0])
    assert sorted(document) == ["indexed_points", "last_run_utc", "version"]
    assert document["last_run_utc"].endswith("+00:00")
    assert {(k, v["source_file"], v["question_hash"]) for k, v in document["indexed_points"].items()} == wanted
    assert 2 <= state_documents(state, files=5).count() <= 5
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        save_state(state, one)


def test_missing_state_is_empty(spark, tmp_path):
    loaded = load_state(spark, str(tmp_path / "none.json"))
    assert loaded.points.count() == 0 and loaded.points.columns == ["point_id", "source_file", "question_hash"]
