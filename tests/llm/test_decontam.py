import random
import re

import pytest
from helpers import documents, words

from tidemark.llm import decontam


def cut(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items, n=10):
    doc, hit, found = cut(text), set(), set()
    for item, body in items:
        w = cut(body)
        size = min(n, len(w))
        for i in range(len(w) - size + 1) if size else ():
            for j in range(len(doc) - size + 1):
                if doc[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add("null" if item is None else str(item))
    return len(doc), len(hit), sorted(found)


def corpus():
    chance = random.Random(8)
    items = [(i, " ".join(words(i, n)).capitalize() + ".") for i, n in enumerate([12, 25, 10, 9, 3, 1, 40])]
    items += [(7, ""), (8, None), (None, " ".join(words(77, 11))), (3, items[3][1]), (11, "Éa-b, ÉC")]
    docs = ["", None, "nothing of it", items[5][1].lower() * 3, "xx éa B Éc yy éa b éc"]
    for _ in range(60):
        parts = []
        for _ in range(chance.randint(1, 5)):
            w = cut(chance.choice(items)[1])
            k = chance.randint(0, len(w))
            parts += [*words(chance.random(), chance.randint(0, 20)), *w[k // 2 :][: chance.randint(0, 40)]]
        docs.append((chance.choice([" ", ", ", "\n"])).join(parts))
    return docs, items


@pytest.mark.parametrize("segment, block", [(1 << 20, 500_000), (40, 500_000), (1 << 20, 60)])
def test_equals_brute_force(spark, scratch, monkeypatch, segment, block):
    monkeypatch.setattr(decontam, "SEGMENT", segment)
    docs, items = corpus()
    table = spark.createDataFrame([(*x, "s") for x in items], "item_id long, text string, row string")
    found = decontam.contamination(documents(spark, docs), table, scratch, block_words=block).orderBy("row.doc_id").collect()
    for text, row in zip(docs, found, strict=True):
        assert (row.n_words, row.n_hit, list(row["items"])) == brute(text, items), text


def test_removals(spark, scratch):
    docs, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    frame = documents(spark, docs)
    clean = decontam.drop_contaminated(frame, table, scratch)
    assert clean.columns == frame.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, t in enumerate(docs) if not brute(t, items)[1]}
    spans = decontam.remove_spans(frame, table, scratch).orderBy("doc_id").collect()
    for text, row in zip(docs, spans, strict=True):
        total, hit, _ = brute(text, items)
        assert len(cut(row.text)) == total - hit and (hit or row.text == text)


def test_empty_tables(spark, scratch):
    docs, items = corpus()
    table = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contamination(documents(spark, []), table, f"{scratch}/a").count() == 0
    found = decontam.contamination(documents(spark, docs), table.limit(0), f"{scratch}/b").collect()
    assert all(r.n_hit == 0 and not r["items"] for r in found)


def test_spans_are_cut_in_blocks_of_items(spark, scratch):
    items = [(f"i{i}", " ".join(words(300 + i, 12))) for i in range(40)]
    # Items that overlap in a text: the second starts with the end of the first.
    items += [("long", items[0][1] + " " + items[1][1]), ("late", " ".join(items[2][1].split()[2:] + words(999, 8)))]
    texts = [f"{' '.join(words(i, 9))}, {items[i % 42][1]}; {items[(i + 1) % 42][1]} {' '.join(words(50 + i, 9))}" for i in range(45)]
    texts += [items[2][1] + " " + " ".join(words(999, 8)) + " end", "", None, "clean text"]
    frame, table = documents(spark, texts), spark.createDataFrame(items, "item_id string, text string")
    whole, blocks = (
        {r.doc_id: r.text for r in decontam.remove_spans(frame, table, f"{scratch}/{n}", block_words=n).collect()} for n in (500_000, 300)
    )
    assert whole == blocks and whole[45] == " end" and (whole[46], whole[47], whole[48]) == ("", None, "clean text")
    index = decontam.WindowIndex(items, 10)
    assert not any(len(index.scan(t)[1]) for t in whole.values())
    assert list(decontam.remove_spans(frame, table, f"{scratch}/c").columns) == frame.columns
