import random

import corpus_pipeline
import pytest
import xxhash
from helpers import DOCS, saved, words
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tidemark.llm import decontam


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean, copied, near-copied, junk, contaminated and shared-passage documents, with odd rows."""
    path, chance = str(tmp_path_factory.mktemp("tables")), random.Random(9)
    clean = [" ".join(words(i, 120)) for i in range(600)]
    items = [" ".join(words(5000 + i, 14)) for i in range(5)]
    passage = " ".join(words(7000, 90))
    rows = [("clean", t) for t in clean]
    rows += [("copy", clean[i]) for i in range(5)]
    for i in range(5, 10):
        w = clean[i].split()
        w[chance.randrange(len(w))] = "changed"
        rows.append(("near", " ".join(w)))
    rows += [("junk", "### " + " ### ".join(words(8000 + i, 80))) for i in range(20)]
    rows += [("leak", " ".join(words(9000 + i, 60)) + " " + items[i] + " " + " ".join(words(9500 + i, 60))) for i in range(5)]
    rows += [("shared", " ".join(words(9900 + i, 70)) + " " + passage + " " + " ".join(words(9950 + i, 70))) for i in range(4)]
    rows += [("short", "few words"), ("none", None), ("empty", "")]
    table = [(i, t, "en", k, len(t or ""), "mine", "x", "k") for i, (k, t) in enumerate(rows)]
    table += [(None, clean[20], None, "nulls", None, None, None, None), (None, " ".join(words(9999, 90)), None, "nulls", None, None, None, None)]
    saved(spark.createDataFrame(table, DOCS), path, "documents")
    saved(spark.createDataFrame([(i, 1, 0) for i in range(600)] + [(i, 0, 0) for i, (k, _) in enumerate(rows) if k == "junk"],
                                "doc_id long, quality int, toxic int"), path, "labels")
    saved(spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), path, "benchmark")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The tables that the stages leave, in order."""
    path, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{folder}/documents.parquet")
    out = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        stage(spark, docs, folder).write.parquet(f"{path}/{i}")
        docs = spark.read.parquet(f"{path}/{i}")
        assert i == 4 or docs.columns == before
        out.append(docs)
    return out


def test_stages(spark, folder, stages):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    kinds = {r.doc_id: r.source for r in docs if r.doc_id is not None}
    kept = stages[3].collect()
    found = [kinds[r.doc_id] for r in kept if r.doc_id is not None]
    assert found.count("clean") == 600 and "copy" not in found  # each copy's original has the smaller id
    assert found.count("shared") == 4
    assert set(found) - {"near"} == {"clean", "shared"}  # a changed word may move more than two bits
    assert sum(r.source == "nulls" for r in kept) == 1  # the other repeats a clean document
    passage = " ".join(words(7000, 90))
    for row in kept:
        assert row.n_chars == len(row.text)
        if row.source == "shared":
            assert passage[20:-20] not in row.text and len(row.text) > 300
    texts = {r.doc_id: r.text for r in docs}
    paired = set(range(5, 10)) if "near" in found else set()  # what is left of near copies loses its long repeats
    assert all(r.text == texts[r.doc_id] for r in kept if kinds.get(r.doc_id) == "clean" and r.doc_id not in paired)


def simhash(text):
    """The fingerprint by its definition."""
    part = (text or "").encode().lower().split()
    grams = [b" ".join(part[i : i + 3]) for i in range(max(1, len(part) - 2))] if part else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_brute_force(stages):
    rows = [(r.doc_id is None, r.doc_id or 0, r.text, simhash(r.text)) for r in stages[0].collect()]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][3] ^ rows[j][3]).bit_count() <= 2 and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    want = {}
    for g, row in zip(group, rows):
        want[g] = min(want.get(g, row), row)
    kept = [(r.doc_id, r.text) for r in stages[1].collect()]
    assert sorted(kept, key=str) == sorted(((None if r[0] else r[1], r[2]) for r in want.values()), key=str)
    assert len(kept) < len(rows)


def test_no_window_is_left(spark, folder, stages):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    index = decontam.WindowIndex(items, 10)
    assert not any(index.scan(r.text)[1] for r in stages[3].collect())


def test_empty_table(spark, folder, tmp_path):
    for name in ("labels", "benchmark"):
        saved(spark.read.parquet(f"{folder}/{name}.parquet"), tmp_path, name)
    saved(spark.read.parquet(f"{folder}/documents.parquet").limit(0), tmp_path, "documents")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_equals_its_stages(spark, folder, stages):
    one = corpus_pipeline.run(spark, folder)
    assert one.columns == stages[4].columns
    assert one.exceptAll(stages[4]).count() == stages[4].exceptAll(one).count() == 0


@pytest.mark.parametrize("name", [n for n in entry_module.queries() if n.startswith("op") and n not in entry_module.oracle_sql()])
def test_queries_cover_their_tables(spark, name):
    table = "conversations" if name.startswith("op4_") else "documents"
    rows = entry_module.queries()[name](spark, SMALL).select("*", F.lit(1)).collect()
    if name != "op7_length_histogram":
        assert len(rows) == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    else:
        assert sum(r.docs for r in rows) == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
