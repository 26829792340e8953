import random
import re

import xxhash
from helpers import documents, words
from pyspark.sql import functions as F

from tidemark.llm import simhash as s


def plain(text, n=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(found[i : i + n]) for i in range(len(found) - n + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    """Smallest id reachable of each id."""
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprint(monkeypatch):
    for segment in (1 << 20, 7):
        monkeypatch.setattr(s, "SEGMENT", segment)
        for text in ["", None, "One", "One TWO", "a b c", "É é x\ty\nz", " ".join(words(1, 700)), "same " * 300, " \n"]:
            assert s.fingerprint(text) == plain(text), text


def test_components_equal_brute_force(spark, scratch):
    chance = random.Random(2)
    values = [chance.getrandbits(64) for _ in range(60)]
    for v in values[:40]:  # near ones, chains and a crowd that shares blocks
        values.append(v ^ 1 << chance.randrange(64))
        values.append(values[-1] ^ 1 << chance.randrange(64) ^ 1 << chance.randrange(64))
    crowd = chance.getrandbits(64)
    values += [crowd ^ (chance.getrandbits(12) << 3) for _ in range(200)] + [0, 0, 3, crowd]
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(values)]
    prints = spark.createDataFrame(rows, "doc_id long, fp long")
    want = groups(range(len(values)), [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2])
    for bucket in (s.BUCKET, 2):
        found = s.near_duplicates(prints, f"{scratch}/{bucket}", bucket=bucket)
        assert {r.doc_id: r.component_id for r in prints.join(found, "fp").collect()} == want


def test_null_ids_and_empty_table(spark, scratch):
    prints = spark.createDataFrame([(None, 5), (None, 4), (7, 15 << 40), (None, 15 << 40)], "doc_id long, fp long")
    found = {r.fp: r.component_id for r in s.near_duplicates(prints, f"{scratch}/a").collect()}
    assert found == {5: None, 4: None, 15 << 40: 7}
    assert s.near_duplicates(prints.limit(0), f"{scratch}/b").count() == 0


def test_similar_groups(spark, scratch):
    chance, texts = random.Random(3), []
    for i in range(25):
        base = words(i, chance.randint(60, 400))
        texts.append(" ".join(base))
        for _ in range(chance.randint(0, 3)):
            copy = list(base)
            for _ in range(chance.randint(0, max(1, len(base) // 60))):
                copy[chance.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    texts += ["", None, "", "two words", "Two  words", "other words", texts[0], texts[0]]
    rows = documents(spark, texts).select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), F.col("doc_id").alias("id"), "text")
    sets = [s.shingles(t) for t in texts]

    def alike(a, b):
        return len(a & b) >= 0.8 * len(a | b)

    want = groups(range(len(texts)), [(i, j) for i in range(len(texts)) for j in range(i) if alike(sets[i], sets[j])])
    found = [r.id for r in s.similar_groups(rows, f"{scratch}/a").collect()]
    assert sorted(found) == sorted(set(want.values()))
    assert s.similar_groups(rows.limit(0), f"{scratch}/b").count() == 0


def kept_and_wanted(spark, texts, scratch, **options):
    """Ids that stay, and the smallest ids of the groups by all pairs."""
    rows = documents(spark, texts).select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"), F.col("doc_id").alias("id"), "text")
    sets = [s.shingles(t) for t in texts]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    found = [r.id for r in s.similar_groups(rows, scratch, **options).collect()]
    return sorted(found), sorted(set(groups(range(len(texts)), linked).values())), len(linked)


def test_families_with_one_word_set(spark, scratch):
    chance, vocabulary, texts = random.Random(4), words(77, 200), []
    for _ in range(30):
        base = chance.sample(vocabulary, len(vocabulary))
        for _ in range(3):
            copy = list(base)
            i = chance.randrange(len(copy) - 1)
            copy[i], copy[i + 1] = copy[i + 1], copy[i]
            texts.append(" ".join(copy))
    chance.shuffle(texts)
    found, want, linked = kept_and_wanted(spark, texts, scratch)
    assert linked >= 60 and found == want


def test_crowded_keys(spark, scratch, monkeypatch):
    monkeypatch.setattr(s, "FREQUENT", 1)
    chance, texts, common = random.Random(6), [], words(88, 150)
    for i in range(90):  # around the threshold to each other: hubs take some, others must be paired up
        own = words(1000 + i // 3, chance.randint(8, 26)) if i % 2 else words(2000 + i, chance.randint(8, 26))
        texts.append(" ".join(common + own))
    for bucket in (s.BUCKET, 2):
        found, want, linked = kept_and_wanted(spark, texts, f"{scratch}/{bucket}", bucket=bucket)
        assert linked and found == want
    monkeypatch.setattr(s, "ROUNDS", 0)
    found, want, _ = kept_and_wanted(spark, texts, f"{scratch}/none", bucket=2)
    assert found == want


def edited(base, kind, share, chance):
    """``base`` with one edit after which about ``share`` of all distinct shingles are in both."""
    n = len(base)
    if kind == "append":
        return base + words(chance.random(), round(n / share) - n)
    if kind == "truncate":
        return base[: round(n * share)]
    if kind == "replace":
        m = round(n * (1 - share) / (1 + share)) - 4
        at = chance.randrange(n - m)
        return base[:at] + words(chance.random(), m) + base[at + m :]
    copy, step = list(base), round(5 * (1 + share) / (1 - share))
    for at in range(step // 2, n, step):
        copy[at] = words(chance.random(), 1)[0]
    return copy


def test_every_kind_of_edit_is_found(spark, scratch):
    chance, texts, kinds = random.Random(5), [], []
    for i in range(80):
        kind, base = ("append", "truncate", "replace", "scatter")[i % 4], words(3000 + i, chance.randint(150, 400))
        texts += [" ".join(base), " ".join(edited(base, kind, chance.uniform(0.81, 0.9), chance))]
        a, b = map(s.shingles, texts[-2:])
        kinds += [kind] * (0.8 <= len(a & b) / len(a | b) <= 0.92)
    assert all(kinds.count(k) >= 15 for k in set(kinds)) and len(set(kinds)) == 4
    found, want, linked = kept_and_wanted(spark, texts, scratch)
    lost = [("append", "truncate", "replace", "scatter")[i // 2 % 4] for i in set(found) - set(want)]
    assert linked >= 60 and found == want, {k: f"{lost.count(k)} of {kinds.count(k)} lost" for k in set(kinds)}
