import math
import re
from collections import Counter

import numpy as np
import pytest
from helpers import documents, words
from pyspark.sql import functions as F

from tidemark.llm import pu_quality, risk_rules


def plain(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(found, found[1:], found[2:]))
    often, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_measures(spark):
    texts = ["", None, " \n\t", "a", "a b", "a b c", "a a a a a", "x y z x y z", "#a *b\n#a *b\n\n \nq<>", "é b c\x1cd 😀 e",
             "\x0bw\x0cv\r\n" * 3, " ".join(words(1, 3000)), " ".join(words(2, 40) * 50), "A!B !!"]
    found = risk_rules.measured(documents(spark, texts)).orderBy("row.doc_id").collect()
    for text, row in zip(texts, found, strict=True):
        m = row.m
        got = (m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words)
        assert got == plain(text), text
        assert row.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0])
        assert row.row.fingerprint == "mine"


def tail(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(k, n) for n in (1, 5, 50, 300, 1000) for k in (0, 1, 2, 5, 18, 19) if k <= n]
    rows = spark.createDataFrame(cases, "k long, n long").select(
        "k", "n", *[risk_rules.binomial_tail(F.col("k"), F.col("n"), p).alias(f"p{i}") for i, p in enumerate((0.02, 0.3))]
    ).collect()
    for row in rows:
        for i, p in enumerate((0.02, 0.3)):
            if row.k < row.n * p:
                assert row[f"p{i}"] == pytest.approx(tail(row.k, row.n, p), rel=1e-9)
            else:
                assert row[f"p{i}"] == 1.0
    big = spark.range(1).select(risk_rules.binomial_tail(F.lit(19_500), F.lit(1_000_000), 0.02).alias("p")).first().p
    assert 0 < big < 0.001


def holdout(spark, n, bad_share):
    rows = [("en", {"symbol_share": 0.2 if i < n * bad_share else 0.0, "loud_share": 0.0, "line_share": 0.0, "window_share": 0.0}) for i in range(n)]
    rows += [("few", {"symbol_share": 0.0, "loud_share": 0.0, "line_share": 0.0, "window_share": 0.0})] * 20
    return spark.createDataFrame(rows, "stratum string, shares struct<symbol_share:double,loud_share:double,line_share:double,window_share:double>")


def test_cutoffs_respect_the_bound(spark):
    chosen = {r.stratum: r.cutoffs for r in risk_rules.select_cutoffs(holdout(spark, 2000, 0.05)).collect()}
    assert chosen["en"].symbol_share == 0.2  # 5 % of good texts lie above the next rung, 0.15
    assert chosen["en"].loud_share == risk_rules.LADDERS["loud_share"][-1]
    assert chosen["few"] == (None, None, None, None)
    strict = {r.stratum: r.cutoffs for r in risk_rules.select_cutoffs(holdout(spark, 2000, 0.001)).collect()}
    assert strict["en"].symbol_share == risk_rules.LADDERS["symbol_share"][-1]


def test_verdicts(spark, scratch):
    good = [" ".join(words(i, 60)) for i in range(700)]
    junk = ["### " + " ### ".join(words(1000 + i, 60)) for i in range(30)]
    texts = [*good, *junk, "", None]
    docs = documents(spark, texts)
    labels = [(i, 1, 0) for i in range(700)] + [(700 + i, 0, 0) for i in range(10)] + [(3, None, 0), (None, 1, 0), (99_999, 1, 0), (5, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    cutoffs = risk_rules.calibrate(docs, labels)
    rows = risk_rules.verdicts(risk_rules.measured(docs), F.col("row.lang"), cutoffs)
    kept = {r.i: r.kept for r in rows.select(F.col("row.doc_id").alias("i"), "kept").collect()}
    assert all(kept[i] for i in range(700)) and not any(kept[i] for i in range(700, 732))
    none = risk_rules.calibrate(docs, labels.limit(0))
    rows = risk_rules.verdicts(risk_rules.measured(docs), F.col("row.lang"), none)
    assert rows.where("kept = base_failed").count() == 0
    assert risk_rules.verdicts(risk_rules.measured(docs.limit(0)), F.col("row.lang"), none).count() == 0


def test_positive_unlabelled(spark):
    good = [" ".join(words(i, 80)) for i in range(300)]
    bad = [" | ".join(words(500 + i, 60)) for i in range(60)] + ["!! ".join(words(900 + i, 60)).upper() for i in range(60)]
    texts = [*good, *bad, "", None]
    docs = documents(spark, texts)
    labels = [(i, 1, 0) for i in range(0, 300, 2)] + [(300 + i, 0, 0) for i in range(0, 120, 2)] + [(None, 1, 0), (1, None, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    p, u = pu_quality.learning_rows(docs, labels)
    prior = pu_quality.class_prior(p, u)
    assert 0.55 < prior < 0.85 and len(p) and len(u)
    model = pu_quality.fit(p, u, prior)
    found = pu_quality.scored(docs.select("doc_id", "text", pu_quality.held_out(F.col("doc_id")).alias("held_out")), model)
    rows = found.collect()
    right = [(r.score >= 0.7) == (r.doc_id < 300) for r in rows if r.held_out and r.doc_id < 420]
    assert sum(right) >= 0.95 * len(right) and all(0 <= r.score <= 1 for r in rows) and len(rows) == len(texts)
    p, u = pu_quality.learning_rows(docs, labels.limit(0))
    assert len(p) == 0 and len(u) and pu_quality.class_prior(p, u) == 0.5
    none = pu_quality.learn(docs, labels.limit(0))
    assert {r.score for r in pu_quality.scored(docs, none).collect()} == {0.5}
    assert pu_quality.scored(docs.limit(0), pu_quality.learn(docs.limit(0), labels)).count() == 0
    bounded = pu_quality.learning_rows(docs, labels, positives=20, unlabelled=10)
    assert len(bounded[0]) <= 20 and len(bounded[1]) <= 10
    odd = docs.where("doc_id < 3").withColumn("score", F.lit("theirs")).withColumn("x", F.lit(1))
    twice = pu_quality.scored(odd.unionByName(odd), model)
    assert twice.columns.count("score") == 1 and "x" in twice.columns
    assert twice.groupBy("doc_id").agg(F.count_distinct("score").alias("n"), F.count("*").alias("m")).where("n = 1 AND m = 2").count() == 3


def test_risk_and_gradient_equal_their_definition():
    chance = np.random.default_rng(3)
    for prior in (0.3, 0.9):
        p, u, w = chance.normal(size=(7, 4)), chance.normal(size=(9, 4)), chance.normal(size=4)

        def terms(w):
            loss = lambda z, y: float(np.mean([np.log(1 + np.exp(-y * float(x @ w))) for x in z]))
            return np.array([prior * loss(p, 1), loss(u, -1) - prior * loss(p, -1)])

        part, bracket, of_part, of_bracket = pu_quality.risk(w, p, u, prior)
        assert np.allclose([part, bracket], terms(w))
        for i in range(4):
            step = np.eye(4)[i] * 1e-6
            assert np.allclose((terms(w + step) - terms(w - step)) / 2e-6, [of_part[i], of_bracket[i]], atol=1e-6)


def test_prior_from_scores():
    chance = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.85):
        p, u = chance.normal(2, 1, 4000), np.where(chance.random(6000) < share, chance.normal(2, 1, 6000), chance.normal(-2, 1, 6000))
        assert abs(pu_quality.prior_from(p, u) - share) < 0.05
        assert abs(pu_quality.prior_from(np.ones(50), np.ones(50)) - 1) < 1e-9  # ties


def test_features_by_definition(monkeypatch):
    text = "Some words!\nSome words!\n| x 12 é " * 40
    whole, names = pu_quality.features(text, pu_quality.Hasher()), pu_quality.NAMES
    monkeypatch.setattr(pu_quality, "SEGMENT", 64)
    assert np.array_equal(pu_quality.features(text, pu_quality.Hasher()), whole) and len(whole) == len(names)
    at, parts, lines = dict(zip(names, whole)), text.split(), [x for x in text.split("\n") if x]
    assert np.isclose(at["line_repeats"], 1 - len(set(lines)) / len(lines)) and np.isclose(at["new_words"], len(set(parts)) / len(parts))
    assert np.isclose(at["word_repeats"], 1 - len(set(zip(parts, parts[1:]))) / (len(parts) - 1))
    for kind in ("word", "pair", "bytes"):
        assert np.isclose(sum(v * v for n, v in at.items() if n.startswith(f"{kind}_") and n[len(kind) + 1 :].isdigit()), 1)
    mixed = pu_quality.features(" ".join(sorted(parts)), pu_quality.Hasher())
    assert any(a != b for n, a, b in zip(names, whole, mixed) if n.startswith("pair_"))  # order counts


def test_tokens_and_very_long_texts(monkeypatch):
    hasher = pu_quality.Hasher()
    for n in (1, 2, 500):
        found = hasher.tokens(b" ".join(w.encode() for w in words(5, n)) + b" \n", b" \n")
        assert len(found) == n and len(set(found.tolist())) == len(set(words(5, n)))
    assert len(hasher.tokens(b"", b" ")) == len(hasher.tokens(b"   ", b" ")) == 0
    assert len(set(hasher.tokens(b"x y x  x", b" ").tolist())) == 2
    giant = "long text " * 600_000 + "x" * 3_000_000
    assert np.isfinite(pu_quality.features(giant, hasher)).all()
    assert not pu_quality.features(None, hasher).any() and not pu_quality.features("", hasher).any()
