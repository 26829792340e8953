import hashlib
import random
import uuid

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import SyncOptions, encode, hashing_encoder, normalise_metric, vector_faults, with_identity
from tidemark.functions.chunking import chunk, explode_chunks, fixed_windows, split_text
from tidemark.functions.identity import content_hash, uuid5
from tidemark.options import POINT_NAMESPACE, encoder_batch


def test_identity_matches_uuid_and_hashlib(spark):
    rows = [("Wo liegt der Schlüssel?", "haus/tür.json"), ("Wo liegt der Schlüssel?", "haus/hof.json"),
            ("Wo liegt der Schlüssel nun?", "haus/tür.json"), ("a", "b\\c.json"), ("a", "b/c.json"),
            ("", ""), ("😀 |source:", "x|y+z %41.json"), ("\x00\n", "ñ.json")]
    found = with_identity(spark.createDataFrame(rows, "q string, source string")).collect()
    for row in found:
        name = f"question:{row.q}|source:" + row.source.replace("\\", "/")
        assert row.point_id == str(uuid.uuid5(uuid.UUID(POINT_NAMESPACE), name))
        assert row.question_hash == hashlib.sha256(row.q.encode()).hexdigest()
    ids = {(r.q, r.source): r.point_id for r in found}
    assert ids[rows[0]] == str(uuid.uuid5(uuid.UUID(POINT_NAMESPACE), "question:Wo liegt der Schlüssel?|source:haus/tür.json"))
    assert ids[rows[3]] == ids[rows[4]] == "5505485a-8686-5c45-8ada-54c088a86ccf"
    assert len({r.point_id for r in found}) == len(rows) - 1


def test_every_variant_nibble(spark):
    names = [str(i) for i in range(200)]
    other = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", uuid5(F.col("n"), other).alias("u"))
    assert all(r.u == str(uuid.uuid5(uuid.UUID(other), r.n)) for r in rows.collect())


def test_content_hash_sees_every_field_and_border(spark):
    rows = [("q", "a", "p", ["k"]), ("qa", "", "p", ["k"]), ("q", "a", "pk", []), ("q", "a", "p", ["k", ""]),
            ("q", "a", "p", []), ("q", "b", "p", ["k"]), ("q", "a", "p", ["k", "l"]), ("q", "a", "p", ["kl"])]
    frame = spark.createDataFrame(rows, "q string, a string, p string, k array<string>")
    hashes = {r.h for r in frame.select(content_hash(*[F.col(c) for c in "qapk"]).alias("h")).collect()}
    assert len(hashes) == len(rows)


def prose(seed, sentences):
    """Seeded random words in sentences, some of them on new lines."""
    chance = random.Random(seed)
    words = ["".join(chance.choice("abdeilmnorstuäß") for _ in range(chance.randint(2, 9))) for _ in range(40)]
    parts = [" ".join(chance.choices(words, k=chance.randint(3, 12))).capitalize() + "." for _ in range(sentences)]
    return "".join(p + chance.choice([" ", " ", "\n", "\n\n"]) for p in parts)


LONG = prose(11, 12)


def test_chunk_cases(spark):
    short = "Kurz genug für ein Stück."
    rows = [(0, LONG), (1, short), (2, ""), (3, None), (4, "  \n "), (5, f"\n {short} \n")]
    found = {r.i: r.chunks for r in chunk(spark.createDataFrame(rows, "i int, t string"), "t", 100, 20).collect()}
    assert len(found[0]) > 1 and all(len(c) <= 100 for c in found[0])
    assert [found[i] for i in range(1, 6)] == [[short], [], [], [], [short]]


def test_chunk_examples(spark):
    assert split_text("abcdefghijk", 5, 2) == ["abcde", "defgh", "ghijk"]
    assert split_text("aa bb cc dd", 5, 2) == ["aa bb", "cc", "dd"]
    assert split_text("aa bb cc dd", 6, 3) == ["aa bb", "bb cc", "cc dd"]
    assert split_text("one two\n\nthree four\n\nfive", 11, 0) == ["one two", "three four", "five"]
    assert split_text("x" * 12 + " yy zz", 5, 0) == ["xxxxx", "xxxxx", "xx", "yy", "zz"]
    assert split_text("😀" * 7, 3, 1) == ["😀😀😀"] * 3
    for size, overlap in ((50, 60), (50, 50), (0, 0), (10, -1), (True, 0)):
        with pytest.raises(ValueError):
            chunk(spark.createDataFrame([], "t string"), "t", size, overlap)


def level_by_level(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    """The contract spelled out with strings: split, recurse, pack, strip."""
    level = next(i for i, s in enumerate(separators) if s == "" or s in text)
    sep, finer = separators[level], separators[level + 1:]
    parts = list(text) if sep == "" else text.split(sep)
    pieces = [p if i == 0 or sep == "" else sep + p for i, p in enumerate(parts)]
    chunks, run = [], []

    def flush():
        window, total = [], 0
        for piece in run:
            if total + len(piece) > size:
                chunks.append("".join(window))
                while window and (total > overlap or total + len(piece) > size):
                    total -= len(window.pop(0))
            window.append(piece)
            total += len(piece)
        if window:
            chunks.append("".join(window))
        run.clear()

    for piece in filter(None, pieces):
        if len(piece) >= size and finer:
            flush()
            chunks.extend(level_by_level(piece, size, overlap, finer))
        else:
            run.append(piece)
    flush()
    return [c.strip() for c in chunks if c.strip()]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab\n  \n.é😀", max_size=200), st.integers(1, 30), st.integers(0, 29))
def test_chunk_invariants(text, size, overlap):
    overlap = min(overlap, size - 1)
    chunks = split_text(text, size, overlap)
    assert chunks == (level_by_level(text, size, overlap) if text else [])
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    if text.strip() and len(text) <= size:
        assert chunks == [text.strip()]
    if overlap == 0:
        assert "".join("".join(chunks).split()) == "".join(text.split())


def test_native_and_python_chunks_meet(spark):
    generator = random.Random(7)
    texts = ["".join(generator.choice("ab \n") for _ in range(generator.randint(0, 90))) for _ in range(300)]
    frame = chunk(spark.createDataFrame([(t,) for t in texts], "t string"), "t", 40, 10)
    assert all(r.chunks == split_text(r.t, 40, 10) for r in frame.collect())


def test_fixed_windows(spark):
    texts = ["abcdefghijk", "abcde", "a", "abcdef\nghi😀jklm", "x" * 1000]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for size, overlap in ((5, 2), (5, 4), (3, 0), (7, 5), (1, 0)):
        rows = frame.select("t", fixed_windows(F.col("t"), size, overlap).alias("w")).collect()
        for row in rows:
            step = size - overlap
            count = max(1, -(-(len(row.t) - overlap) // step))
            assert row.w == [row.t[i * step: i * step + size] for i in range(count)]


def test_splitter_runs_once_per_row(spark):
    """An inner explode would add a second copy of the splitter below it."""
    frame = spark.createDataFrame([("a b " * 50,)], "t string")
    plan = explode_chunks(chunk(frame, "t", 40, 10))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_short_text_stays_in_the_jvm(spark):
    frame = chunk(spark.createDataFrame([("short",), ("x" * 50,)], "t string"), "t", 10, 0)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN (length(t" in plan.split("ArrowEvalPython")[1]


def test_encoder(spark):
    texts = ["uno dos tres", "dos  uno\ntres", "", "   ", "otra cosa", "é 😀"] * 20
    frame = encode(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t", dim=32, batch_size=7)
    rows = {r.i: r.vector for r in frame.collect()}
    assert all(len(v) == 32 for v in rows.values())
    for i, text in enumerate(texts):
        sums = [0] * 32
        for token in text.split():
            digest = hashlib.md5(token.encode()).hexdigest()
            sums[int(digest[:8], 16) % 32] += 1 if int(digest[8], 16) % 2 == 0 else -1
        norm = sum(s * s for s in sums) ** 0.5
        assert rows[i] == pytest.approx([s / norm if norm else 0 for s in sums], abs=1e-6)
    assert rows[0] == rows[1] and rows[0] != rows[4]
    assert vector_faults(frame, "vector", 32).count() == 0
    assert vector_faults(frame, "vector", 31).count() == len(texts)


def test_empty_input_gives_typed_frame(spark):
    frame = encode(spark.createDataFrame([], "t string"), "t", dim=8)
    assert frame.schema["vector"].dataType.simpleString() == "array<float>" and frame.count() == 0


def test_caller_supplied_encoder_is_loaded_once_per_task_and_batched(spark):
    def factory():
        loads.append(1)
        return lambda part: np.full((len(part), 2), [len(part), len(loads)], dtype=np.float64)

    loads = []
    frame = spark.range(100).coalesce(1).select(F.col("id").cast("string").alias("t"))
    rows = encode(frame, "t", factory, 2, 32).collect()
    assert [r.vector[0] for r in rows] == [32.0] * 96 + [4.0] * 4
    assert {r.vector[1] for r in rows} == {1.0}


@pytest.mark.parametrize("shape", [(1, 8), (3, 7)])
def test_wrong_encoder_output_fails_the_job(spark, shape):
    frame = spark.createDataFrame([("a",), ("b",), ("c",)], "t string").coalesce(1)
    with pytest.raises(Exception, match="encoder returned shape"):
        encode(frame, "t", lambda: (lambda part: np.zeros(shape)), 8).collect()


def test_options():
    names = ["Cosine", "cosine", "DOT", "dot", "Euclid", "euclid", "Euclidean", "dotproduct"]
    assert [normalise_metric(n) for n in names] == ["Cosine"] * 2 + ["Dot"] * 2 + ["Euclid"] * 3 + ["Dot"]
    for bad in ("Manhattan", "", None):
        with pytest.raises(ValueError):
            normalise_metric(bad)
    assert SyncOptions(chunk_size=1000, chunk_overlap=200, metric="euclidean").metric == "Euclid"
    for bad in ({"chunk_overlap": 1000}, {"chunk_overlap": 1200}, {"chunk_overlap": -50}, {"chunk_size": 0},
                {"dim": 0}, {"batch_size": 0}, {"change_key": "x"}, {"on_bad_file": "x"},
                {"max_delete_fraction": 1.5}, {"on_mismatch": "x"}):
        with pytest.raises(ValueError):
            SyncOptions(**bad)
    assert [encoder_batch(n) for n in (128, 2, 1)] == [64, 1, 16]
    assert hashing_encoder(4)()(["a"]).dtype == np.float32


def test_texts_reach_python_functions_in_bounded_slices(spark, monkeypatch):
    """Whatever a batch of rows holds, no more than a slice of it is made into Python strings at once."""
    from tidemark.functions import text

    sizes = [5, 5, 30, 0, 9, 2, 10, 1]
    texts = pa.array([None if n == 0 else "é" * (n // 2) + "x" * (n % 2) for n in sizes])
    slices = [s.to_pylist() for s in text.text_slices(texts, 10)]
    assert [t for s in slices for t in s] == texts.to_pylist() and [len(s) for s in slices] == [2, 1, 2, 1, 1, 1]
    assert [len(s) for s in text.text_slices(pa.array([], pa.string()))] == [0]

    monkeypatch.setattr(text, "SLICE_BYTES", 2_000)
    rows = [(i, None if i % 7 == 3 else f"{i} " + "word " * (i * 37 % 900)) for i in range(120)]
    frame = spark.createDataFrame(rows, "i int, t string").coalesce(1)
    # The size of the encoder's calls tells what was there to choose from.
    sized = encode(frame, "t", lambda: (lambda part: np.full((len(part), 1), sum(map(len, part)))), 1, batch_size=1000).collect()
    assert all(r.vector is None if r.t is None else r.vector[0] <= max(2_000, len(r.t)) for r in sized)
    found = chunk(encode(frame, "t", dim=8), "t", 100, 20).collect()
    encoder = hashing_encoder(8)()
    for r in found:
        assert r.chunks == split_text(r.t, 100, 20)
        assert r.vector == (None if r.t is None else encoder([r.t])[0].tolist())
