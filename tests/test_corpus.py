import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank, strip
from tidemark.plans.report import corpus_counts
from tidemark.sources.corpus import explode_items, file_stats, parse_files, read_qas

GOOD = '{"q":"Wo?","a":"Hier","product":"lamp","keywords":["k1"]}'


def write(root, name, text):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def parsed(spark, texts):
    rows = [(str(i), bytearray(t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass"))) for i, t in enumerate(texts)]
    return parse_files(spark.createDataFrame(rows, "source string, content binary"))


def statuses(spark, texts):
    found = {r.source: r.status for r in parsed(spark, texts).select("source", "status").collect()}
    return [found[str(i)] for i in range(len(texts))]


def test_folder_cases(spark, tmp_path):
    """One file of each kind; what is wrong with it decides its status and what is left of it."""
    half = json.dumps([
        {"q": "Wer?", "a": "Ich", "product": "lamp", "keywords": ["x"]}, {"q": "Was?", "a": "Das", "product": "lamp"},
        {"q": " \t", "a": "leer", "product": "lamp", "keywords": []}, 7,
    ])
    kinds = {
        "one.json": (f"[{GOOD}]", "ok", 1, 0), "none.json": ("[ ]", "empty", 0, 0), "deep/er/half.json": (half, "ok", 1, 3),
        "object.json": ('{"items": 3}', "not_array", 0, 0), "cut.json": (half[:-9], "malformed", 0, 0),
        "bytes.json": ('[{"q":"ü"}]'.encode("cp1252"), "not_utf8", 0, 0),
    }
    for name, (content, *_) in kinds.items():
        write(tmp_path, name, content)
    for name in ("notes.md", "UPPER.JSON"):
        write(tmp_path, name, f"[{GOOD}]")
    corpus = read_qas(spark, str(tmp_path))
    assert {(r.source, r.pos) for r in corpus.valid.collect()} == {("one.json", 0), ("deep/er/half.json", 0)}
    assert {(r.pos, r.reason) for r in corpus.rejects.collect()} == {(1, "missing_key"), (2, "blank"), (3, "not_object")}
    found = {r.source: (r.status, r.valid_items, r.invalid_items) for r in corpus.files.collect()}
    assert found == {name: tuple(rest) for name, (_, *rest) in kinds.items()}
    assert {r.source for r in corpus.errors.collect()} == {"object.json", "cut.json", "bytes.json"}
    assert corpus_counts(corpus.files).first().asDict() == {
        "files_found": 6, "files_parsed": 3, "files_failed": 3, "files_too_large": 0, "files_with_items": 2,
        "items_valid": 2, "items_invalid": 3}


def test_missing_root(spark, tmp_path):
    missing = str(tmp_path / "nowhere")
    with pytest.raises(FileNotFoundError):
        read_qas(spark, missing).valid.count()
    write(tmp_path, "file.json", "[]")
    with pytest.raises(FileNotFoundError):
        read_qas(spark, str(tmp_path / "file.json"))
    corpus = read_qas(spark, missing, strict=False)
    assert corpus.valid.count() == 0 and corpus.files.count() == 0
    assert corpus.valid.columns == ["source", "pos", "q", "a", "product", "keywords"]


def test_odd_paths_come_back_unchanged(spark, tmp_path):
    root = tmp_path / "r +%41 ñ"
    names = ["a+b c/ñ%41/x+_(1).json", "Descargar+D/A-20_(51).json", "plain.json"]
    for name in names:
        write(root, name, f"[{GOOD}]")
    for given in (str(root), str(root) + "/", f"file:{root}"):
        assert {r.source for r in read_qas(spark, given).valid.collect()} == set(names)


ACCEPTED = ["[]", " [] ", "\n[\t]\r\n", '[{"q":"a","q":"b"}]', '["\\ud800"]', "[NaN]", "[-Infinity, Infinity]", "[1e400]"]
REFUSED = ["[]]", "[]}", "[]\nxx", "[],[1]", '[],"d":[1]', "1],[2", '1,"e":2', '1},{"a":2', "﻿[]", "[1,]",
           "   ", "[1]//c", "[01]", "['a']", '["a\tb"]', "[{'bad': 'json'}", "[NaN]]", "[NaN]}", "[NaN],[1]", "[nan]"]


def test_strict_json_agrees_with_python(spark):
    assert [s in ("ok", "empty") for s in statuses(spark, ACCEPTED)] == [True] * len(ACCEPTED)
    assert statuses(spark, REFUSED) == ["malformed"] * len(REFUSED)
    for text in ACCEPTED:
        json.loads(text)
    for text in REFUSED:
        with pytest.raises(ValueError):
            json.loads(text)


def test_top_level_must_be_an_array(spark):
    assert statuses(spark, ['{"a":1}', '"[1]"', "5", "null", "{} x"]) == ["not_array"] * 4 + ["malformed"]


def test_last_of_equal_keys_wins(spark):
    item = explode_items(parsed(spark, ['[{"q":"a","q":"b","a":"x","product":"","keywords":[]}]'])).first()
    assert (item.q, item.reason) == ("b", None)


ITEMS = [
    ('{"q":5,"a":"x","product":"p","keywords":[]}', "wrong_type"),
    ('{"q":"   \\n","a":"x","product":"p","keywords":[]}', "blank"),
    ('{"q":"x","a":"\\u00a0","product":"p","keywords":[]}', "blank"),
    ('{"q":"x","a":"y"}', "missing_key"),
    ("7", "not_object"), ("null", "not_object"), ("[1]", "not_object"),
    ('{"q":"x","a":"y","product":"p","keywords":"k"}', "wrong_type"),
    ('{"q":"x","a":"y","product":null,"keywords":[]}', "wrong_type"),
    ('{"q":"x","a":"y","product":"p","keywords":null}', "wrong_type"),
    ('{"q":"x","a":"y","product":"p","keywords":[],"extra":{"z":1}}', None),
    ('{"q":"2024-01-01","a":"y","product":"","keywords":[]}', None),
    ('{"q":"x","a":"y","product":"p","keywords":[1,"a",null]}', None),
]


def test_item_rules(spark):
    rows = explode_items(parsed(spark, ["[" + ",".join(t for t, _ in ITEMS) + "]"])).orderBy("pos").collect()
    assert [r.reason for r in rows] == [reason for _, reason in ITEMS]
    assert rows[-1].keywords == ["1", "a", None]
    assert rows[-2].q == "2024-01-01"


def test_large_file_keeps_all_items(spark):
    item = json.dumps({"q": "q", "a": "y" * 1000, "product": "p", "keywords": ["a"] * 20})
    count = 140 * 1024 * 1024 // len(item)
    stats = file_stats(explode_items(parsed(spark, ["[" + ",".join([item] * count) + "]"]))).first()
    assert (stats.status, stats.valid_items) == ("ok", count)


def test_blank_and_strip_match_python(spark):
    texts = ["a", "​", "　x", "﻿", "᠎", "", " ", "\n\t", " ", " ", "\x1c", "\x85",
             " a b ", "\x1f\n x  ", "x\n", "\n\nx y\n\n", "　", "a\x1c"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", is_blank(F.col("t")).alias("blank"), strip(F.col("t")).alias("stripped")).collect()
    for row in rows:
        assert row.blank == (not row.t.strip()), repr(row.t)
        assert row.stripped == row.t.strip(), repr(row.t)


@pytest.mark.skipif("QA_CORPUS_DIR" not in os.environ, reason="QA_CORPUS_DIR names a folder of Q&A files")
def test_given_corpus_matches_python(spark):
    from pathlib import Path

    root = Path(os.environ["QA_CORPUS_DIR"])
    expected = set()
    for path in root.rglob("*.json"):
        for pos, item in enumerate(json.loads(path.read_text("utf-8"))):
            expected.add((str(path.relative_to(root)), pos, item["q"], item["a"], tuple(item["keywords"])))
    corpus = read_qas(spark, str(root))
    assert {(r.source, r.pos, r.q, r.a, tuple(r.keywords)) for r in corpus.valid.collect()} == expected
    assert corpus.rejects.count() == 0
