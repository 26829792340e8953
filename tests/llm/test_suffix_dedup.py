import hashlib
import random
from collections import Counter

import pytest
from helpers import documents, words
from pyspark.sql import functions as F

from tidemark.llm import suffix_dedup as s


def brute(texts, size=400):
    counts = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if counts[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), gone.count(1), len([p for p in gone.split(b"\0") if p]), hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    chance = random.Random(5)

    def text(n, letters="abcdefgh "):
        return "".join(chance.choice(letters) for _ in range(n))

    passages = [text(n) for n in (390, 399, 400, 401, 450, 700, 1500)]
    texts = ["", None, "a" * 399, "a" * 400, "a" * 1000, "ab" * 600, passages[5], passages[5], text(3000), "é" * 300]
    for _ in range(40):
        a, b = chance.choice(passages), chance.choice(passages)
        k = chance.randint(0, len(a))
        texts.append(text(chance.randint(0, 300)) + a[:k] + chance.choice(["", "x"]) + a[k:] + text(30) + b[chance.randint(0, 50):])
    big = text(9000)
    return [*texts, big, big[:4000] + "Q" + big[4500:], passages[6] * 3]


@pytest.mark.parametrize("hot, piece", [(s.HOT, s.PIECE), (3, s.PIECE), (s.HOT, 700)])
def test_equals_brute_force(spark, scratch, monkeypatch, hot, piece):
    monkeypatch.setattr(s, "PIECE", piece)
    monkeypatch.setattr(s.repeated_spans, "__defaults__", (hot,))
    texts = corpus()
    rows, gone = s.removals(documents(spark, texts).repartition(3), scratch)
    whole, n = F.coalesce("whole", F.lit(False)), F.octet_length("data").cast("long")
    found = rows.join(gone, "key", "left").select(
        F.col("row.doc_id").alias("i"), n, F.when(whole, n).otherwise(F.coalesce("n_removed", F.lit(0))),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))),
        F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce(F.sha2("kept", 256), F.sha2("data", 256))),
    )
    assert [tuple(r)[1:] for r in found.orderBy("i").collect()] == brute([(t or "").encode() for t in texts])


@pytest.mark.parametrize("length, hot", [(250, s.HOT), (60, s.HOT), (60, 3)])
def test_other_lengths(spark, scratch, monkeypatch, length, hot):
    monkeypatch.setattr(s.repeated_spans, "__defaults__", (hot,))
    texts = corpus()
    rows, gone = s.removals(documents(spark, texts).repartition(3), scratch, length=length)
    kept = F.when(F.coalesce("whole", F.lit(False)), F.lit(b"")).otherwise(F.coalesce("kept", "data"))
    found = rows.join(gone, "key", "left").select(F.col("row.doc_id").alias("i"), F.sha2(kept, 256)).orderBy("i").collect()
    assert [r[1] for r in found] == [x[3] for x in brute([(t or "").encode() for t in texts], length)]


def test_empty_table(spark, scratch):
    rows, gone = s.removals(documents(spark, []), scratch)
    assert rows.count() == 0 and gone.count() == 0


def test_merge_of_front_coded_runs():
    chance = random.Random(1)
    strings = [bytes(chance.choice(b"ab") for _ in range(chance.randint(0, 12))) for _ in range(300)]
    for k in (1, 2, 3, 7):
        runs = [s.front_decode(s.front_code(sorted((x, i) for x in set(strings[i::k])))) for i in range(k)]
        out, before = [], b""
        for n, string, _ in s.merge(runs):
            assert n == s.common(before, string)
            out.append(string)
            before = string
        assert out == sorted(x for i in range(k) for x in set(strings[i::k]))


def test_common_prefix():
    chance = random.Random(2)
    for _ in range(500):
        a = bytes(chance.choice(b"ab") for _ in range(chance.randint(0, 200)))
        n = chance.randint(0, len(a))
        b = a[:n] + b"c" * chance.randint(0, 3)
        assert s.common(a, b) == s.common(a, b, n // 2) == (n if b != a[:n] or True else len(a))


def test_anchors_serve_each_window_once():
    chance = random.Random(3)
    data = bytes(chance.choice(b"abc") for _ in range(5000))
    at, lo, hi, _ = s.sample_text(data)
    windows = sorted(w for a, x, y in zip(at.tolist(), lo.tolist(), hi.tolist()) for w in range(a - y, a - x + 1))
    assert windows == list(range(len(data) - s.LENGTH + 1))


def test_core_repeated_within_few_texts_is_hot(spark, scratch, monkeypatch):
    line = " ".join(words(41, 90))[:450]
    texts = [" ".join(words(50 + i, 100)) + line * 20 + " ".join(words(60 + i, 100)) for i in range(2)]
    taken, hot_ranges = [], s.hot_ranges
    monkeypatch.setattr(s, "hot_ranges", lambda *a: taken.append(1) or hot_ranges(*a))
    monkeypatch.setattr(s.repeated_spans, "__defaults__", (10,))
    rows, gone = s.removals(documents(spark, texts), scratch)
    kept = {bytes(r.data).decode(): bytes(r.kept).decode() for r in rows.join(gone, "key").select("data", "kept").collect()}
    assert taken and [kept[t] for t in texts] == [b.decode() for b in want_kept(texts)]


def want_kept(texts):
    """By all windows of 400 bytes."""
    places = {}
    for i, t in enumerate(x.encode() for x in texts):
        for at in range(len(t) - 399):
            places.setdefault(t[at : at + 400], []).append((i, at))
    gone = {(i, at + k) for found in places.values() if len(found) > 1 for i, at in found for k in range(400)}
    return [bytes(c for k, c in enumerate(t.encode()) if (i, k) not in gone) for i, t in enumerate(texts)]
