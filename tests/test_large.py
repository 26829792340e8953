"""Hidden, empty and very large files."""

import json
import os
import random

import numpy as np
import pytest

from tidemark import SyncOptions, read_qas, sync
from tidemark.sources import corpus as source
from tidemark.sources import files, pieces

GOOD = {"q": "Wo?", "a": "Hier", "product": "lamp", "keywords": ["k1"]}


def write(root, name, text):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def status(corpus):
    return {r.source: (r.status, r.valid_items, r.invalid_items) for r in corpus.files.collect()}


def test_hidden_and_empty_files(spark, tmp_path):
    one = json.dumps([GOOD])
    for name in ("_under.json", ".dot.json", ".git/deep/x.json", "_tmp/y.json", "plain.json"):
        write(tmp_path, name, one)
    write(tmp_path, "nothing.json", b"")
    write(tmp_path, "a/_nothing.json", b"")
    found = read_qas(spark, str(tmp_path))
    good = {n: ("ok", 1, 0) for n in ("_under.json", ".dot.json", ".git/deep/x.json", "_tmp/y.json", "plain.json")}
    assert status(found) == good | {"nothing.json": ("malformed", 0, 0), "a/_nothing.json": ("malformed", 0, 0)}
    assert {r.source for r in found.errors.collect()} == {"nothing.json", "a/_nothing.json"}
    assert {r.source for r in found.valid.collect()} == set(good)


def test_a_truncated_file_keeps_its_points(spark, tmp_path):
    root, path = tmp_path / "corpus", str(tmp_path / "store")
    write(root, "a.json", json.dumps([GOOD]))
    write(root, "_b.json", json.dumps([GOOD]))
    options = SyncOptions(dim=8, on_bad_file="keep")
    assert sync(spark, str(root), path, options).report.first().points == 2
    write(root, "a.json", b"")
    kept = sync(spark, str(root), path, options).report.first()
    assert (kept.files_found, kept.files_failed, kept.to_delete, kept.points) == (2, 1, 0, 2)
    os.remove(root / "a.json")
    assert sync(spark, str(root), path, options).report.first().points == 1


def test_folders_beyond_what_the_driver_lists(spark, tmp_path, monkeypatch):
    names = {f"d{i}/e{j}/f{k}.json" for i in range(4) for j in range(3) for k in range(2)}
    for name in names:
        write(tmp_path, name, "[]")
    whole = files.TreeReader({"path": str(tmp_path)}).partitions()
    assert len(whole) == 1 and len(whole[0].files) == 24
    monkeypatch.setattr(files, "LISTED", 5)
    monkeypatch.setattr(files, "TASK_FILES", 3)
    reader = files.TreeReader({"path": str(tmp_path)})
    shares = reader.partitions()
    assert any(s.folders for s in shares)
    found = [name for s in shares for batch in reader.read(s) for name in batch.column("source").to_pylist()]
    assert sorted(found) == sorted(names)
    only = files.tree(spark, str(tmp_path), only=["d0/e0/f0.json", "gone.json"]).collect()
    assert [(r.source, r.size, bytes(r.content)) for r in only] == [("d0/e0/f0.json", 2, b"[]")]


def cut_up(text, size, depth):
    """Frame and elements of a text that is read in pieces."""
    state, elements, frame = pieces.State(), {}, b""
    for i in range(0, max(1, len(text)), size):
        data = np.frombuffer(text[i : i + size], np.uint8)
        for container, element, a, b, _ in pieces.cut(data, state, depth):
            if container < 0:
                frame += data[a:b].tobytes()
            else:
                elements[container, element] = elements.get((container, element), b"") + data[a:b].tobytes()
        state = pieces.after(state, pieces.effect(data), depth)
    return frame, [elements[k] for k in sorted(elements)]


def some_value(chance, depth):
    kind = chance.random()
    if depth and kind < 0.3:
        return {chance.choice(["a", 'b"', "c\\"]): some_value(chance, depth - 1) for _ in range(chance.randint(0, 3))}
    if depth and kind < 0.5:
        return [some_value(chance, depth - 1) for _ in range(chance.randint(0, 3))]
    return chance.choice(['x,[{"\\', "\\\\", '"', '\\"', 1, None, True, "é,]", "", ",", "}"])


def test_pieces_of_any_size_give_the_same_elements():
    chance = random.Random(1)
    for _ in range(150):
        value = [some_value(chance, 3) for _ in range(chance.randint(0, 6))]
        text = json.dumps(value, ensure_ascii=chance.random() < 0.5, indent=chance.choice([None, 1])).encode()
        state = {"version": "1", "points": {f"k{i}": some_value(chance, 1) for i in range(4)}, "z": [1, 2]}
        for size in (1, 2, 3, 7, 1000):
            frame, found = cut_up(text, size, 1)
            assert frame.strip() == b"[]" and [json.loads(x) for x in found if x.strip()] == value
            frame, found = cut_up(json.dumps(state).encode(), size, 2)
            assert json.loads(frame) == {"version": "1", "points": {}, "z": []}
            assert [json.loads(b"{" + x + b"}") for x in found[:4]] == [{k: v} for k, v in state["points"].items()]
            assert [json.loads(x) for x in found[4:]] == [1, 2]


LONG = [
    json.dumps([GOOD, {**GOOD, "q": 5}, {"q": "x"}, 7, {**GOOD, "q": " \n"}, {**GOOD, "a": "lang " * 30, "keywords": [1, "ä", None]}], indent=1),
    json.dumps([{**GOOD, "q": f'q{i} "\\ [,]'} for i in range(40)]),
    json.dumps([GOOD] * 4)[:-1], json.dumps([GOOD] * 4) + "]", "[" + json.dumps(GOOD) + ",," + json.dumps(GOOD) + "]",
    json.dumps([GOOD] * 4) + "[]", json.dumps({"a": [GOOD] * 4}), "[" + " " * 200 + "]", "[" + json.dumps(GOOD) * 2 + "]",
    json.dumps([GOOD] * 4).replace("}, {", "}, ]{", 1), json.dumps([GOOD] * 3) + "x", "[" + "'" * 120 + "]",
    json.dumps([GOOD, {**GOOD, "q": "é" * 90}], ensure_ascii=False).encode("latin-1"), json.dumps([["]" * 50, '"' * 50]] * 2),
]


@pytest.mark.parametrize("piece, item", [(64, 1 << 20), (7, 1 << 20), (64, 1)])
def test_large_files_are_read_like_small_ones(spark, tmp_path, monkeypatch, piece, item):
    """The same rows whether files are parsed whole or cut, by variants or one huge item at a time."""
    for i, text in enumerate(LONG):
        write(tmp_path, f"{i:02d}.json", text)
    write(tmp_path, "small.json", json.dumps([GOOD]))
    whole = read_qas(spark, str(tmp_path))
    wanted = [sorted(map(tuple, f.collect()), key=repr) for f in (whole.valid, whole.rejects, whole.files)]
    errors = {r.source: r.status for r in whole.errors.collect()}
    monkeypatch.setattr(source, "LARGE", 100)
    monkeypatch.setattr(pieces, "PIECE", piece)
    monkeypatch.setattr(source, "ITEM_BYTES", item)
    cut = read_qas(spark, str(tmp_path))
    found = [sorted(map(tuple, f.collect()), key=repr) for f in (cut.valid, cut.rejects, cut.files)]
    if item == 1:
        # What is shown of a huge item is spelled differently where numbers or white space are concerned.
        found[1], wanted[1] = ([r[:3] for r in rows[1]] for rows in (found, wanted))
    assert found == wanted
    assert {r.source: r.status for r in cut.errors.collect()} == errors


def test_an_item_too_large_for_a_variant(spark, tmp_path):
    """200 MB of one answer, in a file of 300 MB and more with other items."""
    answer, root = "word " * 40_000_000, tmp_path / "corpus"
    root.mkdir()
    with open(root / "big.json", "w") as out:
        out.write("[")
        for i in range(60):
            out.write(json.dumps({**GOOD, "q": f"before {i}", "a": "x" * 2_000_000}) + ",")
        out.write(json.dumps({**GOOD, "q": "huge", "a": answer}) + "," + json.dumps({**GOOD, "q": "after"}) + "]")
    assert os.path.getsize(root / "big.json") > 300_000_000
    found = read_qas(spark, str(root))
    rows = {r.q: (r.pos, r.n) for r in found.valid.selectExpr("q", "pos", "length(a) AS n").collect()}
    assert len(rows) == 62 and rows["huge"] == (60, len(answer)) and rows["before 3"] == (3, 2_000_000) and rows["after"] == (61, 4)
    assert status(found) == {"big.json": ("ok", 62, 0)}


def test_huge_items_given_by_content(spark, tmp_path, monkeypatch):
    """A run over a table of files, one of them with an item that no variant holds."""
    rows = [("a.json", json.dumps([GOOD]).encode()), ("b.json", json.dumps([{**GOOD, "q": "b1"}, {**GOOD, "q": "b2", "a": "y" * 500}]).encode())]
    frame = spark.createDataFrame(rows, "source string, content binary")
    parse = source.parse_files

    def limited(files):
        from pyspark.sql import functions as F

        rows = parse(files)
        large = F.col("source") == "b.json"
        return rows.select("source", F.when(large, "too_large").otherwise(F.col("status")).alias("status"), "head", F.when(~large, F.col("items")).alias("items"))

    monkeypatch.setattr(source, "parse_files", limited)
    monkeypatch.setattr(pieces, "PIECE", 64)
    result = sync(spark, frame, str(tmp_path), SyncOptions(dim=8))
    assert {r.payload.question for r in result.points.collect()} == {"Wo?", "b1", "b2"}
    assert sync(spark, frame, str(tmp_path), SyncOptions(dim=8)).report.first().unchanged == 3


def entries(n):
    return {f"id{i:06d}": {"source_file": f'dir/"{i % 7}".json', "question_hash": f"{i:064x}"} for i in range(n)}


@pytest.mark.parametrize("piece", [50, 1 << 20])
def test_large_states_are_read_like_small_ones(spark, tmp_path, monkeypatch, piece):
    from tidemark import load_state

    good = {"version": "0.9", "last_run_utc": "then", "extra": [1, [2]], "indexed_points": entries(40) | {"bare": {}, "null": None}, "more": {"a": {}}}
    texts = {
        "good": json.dumps(good, indent=2), "compact": json.dumps(good, separators=(",", ":")), "cut": json.dumps(good)[:-1],
        "twice": json.dumps(good) + "{}", "list": json.dumps([good]), "none": json.dumps({"version": "1.0", "x": "y" * 300}),
        "empty": json.dumps({"indexed_points": {}, "x": "y" * 300}), "broken": json.dumps(good).replace('"bare"', "bare"),
        "kind": json.dumps({"indexed_points": [1, 2], "x": "y" * 300}), "bytes": json.dumps(good | {"x": "é"}, ensure_ascii=False).encode("latin-1"),
    }
    for name, text in texts.items():
        write(tmp_path, name, text)

    def read():
        states = {name: load_state(spark, str(tmp_path / name)) for name in texts}
        return {n: (sorted(map(tuple, s.points.collect()), key=repr), [tuple(r) for r in s.runs.collect()]) for n, s in states.items()}

    whole = read()
    assert len(whole["good"][0]) == 42 and whole["cut"][0] == whole["list"][0] == []
    monkeypatch.setattr(source, "LARGE", 100)
    monkeypatch.setattr(pieces, "PIECE", piece)
    assert read() == whole


def test_a_state_of_300_mb(spark, tmp_path):
    from tidemark import load_state
    from tidemark.sources.state import replace_state

    rows = spark.range(2_200_000).selectExpr(
        "uuid(7) AS point_id", "concat('folder/', id % 1000, '/file.json') AS source_file", "sha2(cast(id AS string), 256) AS question_hash")
    rows = rows.selectExpr("sha2(question_hash, 256) AS point_id", "source_file", "question_hash")
    path = str(tmp_path / "state.json")
    assert replace_state(rows, path) == 2_200_000 and os.path.getsize(path) > 300_000_000
    found = load_state(spark, path)
    assert found.points.exceptAll(rows).count() == 0 and found.points.count() == 2_200_000
    assert found.runs.first().version == "1.0"


def test_a_state_file_is_replaced_in_place(spark, tmp_path):
    from tidemark import load_state
    from tidemark.sources.state import replace_state

    path, schema = tmp_path / "state.json", "point_id string, source_file string, question_hash string"
    for rows in ([("b", 'x"\\ü', "1"), ("a", None, None), ("c", "z", "3")], [("q", "s", "h")], []):
        frame = spark.createDataFrame(rows, schema)
        assert replace_state(frame, str(path)) == len(rows)
        document = json.loads(path.read_text("utf-8"))
        assert document["version"] == "1.0" and document["last_run_utc"].endswith("+00:00")
        assert {(k, v.get("source_file"), v.get("question_hash")) for k, v in document["indexed_points"].items()} == set(rows)
        assert sorted(map(tuple, load_state(spark, str(path)).points.collect())) == sorted(rows)
    assert [p for p in os.listdir(tmp_path) if not p.startswith(".")] == ["state.json"]
