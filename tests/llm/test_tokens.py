import random
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from helpers import documents, words
from tokenizers import Tokenizer

from tidemark.llm import bpe, lengths, simple8b
from tidemark.llm.common import materialise
from tidemark.llm.pretokens import UnitEncoder

RANKS, PATTERN, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("byte_bpe_50k.json")
ODD = "ab  \n\n\t'sllvet.,!?12é漢字　\xa0\x85\x1c​😀Á"


def strings():
    chance = random.Random(1)
    some = ["".join(chance.choice(ODD) for _ in range(chance.randint(0, 40))) for _ in range(3000)]
    return [*some, "", None, "a" * 20_000, "ab" * 5000, " " * 3000, "<|endoftext|> x", " ".join(words(3, 400)), "abc\n" * 500]


def reference():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_tiktoken_and_decodes():
    own, theirs = bpe.BytePairEncoder(bpe.read_ranks(RANKS), PATTERN), reference()
    for text, ids in zip(strings(), own.encode_many(strings())):
        assert bpe.ids_array(ids).tolist() == theirs.encode_ordinary(text or "")
        assert own.decode(ids) == (text or "").encode()


def test_segments_and_generations(monkeypatch):
    from tidemark.llm import pretokens

    monkeypatch.setattr(pretokens, "SEGMENT", 50)
    monkeypatch.setattr(pretokens, "REMEMBERED", 20)
    own, theirs = bpe.BytePairEncoder(bpe.read_ranks(RANKS), PATTERN), reference()
    chance = random.Random(4)
    text = " ".join(chance.choice(words(5, 60)) + chance.choice(["", ",", "\n", "  "]) for _ in range(800))
    for _ in range(2):
        assert bpe.ids_array(own.encode(text)).tolist() == theirs.encode_ordinary(text)


def test_merge_that_brings_up_a_lower_rank():
    tokens = [bytes([b]) for b in range(256)] + [b"aba", b"ab"]  # "aba" ranks below the "ab" it is made of
    ranks = {t: i for i, t in enumerate(tokens)}
    theirs = tiktoken.Encoding("low", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = bpe.BytePairEncoder(tokens, PATTERN)
    for text in ("abab", "ababab", "aabab", "abaabab", "babab" * 3):
        assert bpe.ids_array(own.encode(text)).tolist() == theirs.encode_ordinary(text)


def test_rank_queue():
    queue, chance = bpe.RankQueue(50_000), random.Random(6)
    ranks = chance.sample(range(50_000), 500)
    for r in ranks:
        queue.open(r).append(r)
    for r in sorted(ranks):
        assert queue.first() == r
        queue.clear(r)
    assert queue.first() == -1


def test_library_units_equal_whole_texts():
    tokenizer = Tokenizer.from_file(JSON)
    texts = [t or "" for t in strings() if "<|endoftext|>" not in (t or "")]
    whole = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    own = UnitEncoder(simple8b.library_encoder(JSON)).encode_many(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in own] == whole


def test_library_ids_with_special_strings():
    tokenizer, chance, special = Tokenizer.from_file(JSON), random.Random(12), "<|endoftext|>"
    texts = [special, special * 3, f"a {special} b", f"{special}a", f"don{special}'t", f" {special} ", f"x{special[:-1]}y{special[1:]}", None, "", "plain"]
    bits = [special, special, "<|", "endoftext", "|>", " ", "  ", "\n", "'s", "word", "é", "12", ",", "<|endoftext|", "\u3000"]
    texts += ["".join(chance.choices(bits, k=chance.randint(1, 12))) for _ in range(3000)]
    whole = [e.ids for e in tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    own = simple8b.LibraryEncoder(JSON)
    for size in (1, 7, 3010):
        found = [x for i in range(0, len(texts), size) for x in own.encode_many(texts[i : i + size])]
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == whole


def test_words_of_64_bits():
    chance = random.Random(7)
    cases = [[], [0] * 1000, [1, 2**63, 5] * 50, list(range(3000)), [2**64 - 1] * 70, [2**60 - 1, 2**60, 0]]
    cases += [[chance.getrandbits(chance.randint(0, 64)) for _ in range(chance.randint(1, 400))] for _ in range(60)]
    for case in cases:
        ids = np.array(case, np.uint64)
        packed = simple8b.pack(ids)
        assert np.array_equal(simple8b.unpack(*packed), ids)
    assert len(simple8b.pack(np.zeros(6000, np.uint64))[0]) == 100


def test_files(spark, scratch):
    texts = ["hello world", None, "", "same <|endoftext|>", "same <|endoftext|>", "x " * 500, "last"]
    docs = documents(spark, texts, [5, 3, None, 9, 9, 1, 2])
    index = simple8b.write_ids(docs, scratch, JSON, block_ids=100)
    found = simple8b.read_ids(index, scratch).orderBy("start").collect()
    tokenizer, start = Tokenizer.from_file(JSON), 0
    order = sorted(zip([5, 3, None, 9, 9, 1, 2], texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    for row, (key, text) in zip(found, order, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        raw = np.array(ids, "<u4").tobytes()
        assert tuple(row) == (key, start, len(ids), zlib.crc32(raw), raw)
        start += len(ids)


def test_rows_of_one_key_are_spread(spark, scratch):
    """Null ids with one text and with many: several files, and starts without gaps."""
    texts = ["the same text"] * 400 + [f"text {i}" for i in range(400)]
    # Small partitions would be put together here.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = simple8b.write_ids(documents(spark, texts, [None] * 800).repartition(4), scratch, JSON)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.select("part").distinct().count() >= 3 and max(r.docs for r in index.collect()) < 500
    found = simple8b.read_ids(index, scratch).orderBy("start").collect()
    assert len(found) == 800 and all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))


def test_files_of_an_empty_table(spark, scratch):
    assert simple8b.read_ids(simple8b.write_ids(documents(spark, []), scratch, JSON), scratch).count() == 0


def test_frame_keeps_clashing_columns(spark):
    docs = documents(spark, ["one two", None, ""]).select("doc_id", "text", "key", "fingerprint")
    rows = bpe.with_ids(docs, bpe.vocabulary(spark, RANKS, PATTERN), decode=True).orderBy("doc_id").collect()
    assert [r.decoded.decode() for r in rows] == ["one two", "", ""] and {r.key for r in rows} == {"k"}


def test_histogram(spark, scratch, monkeypatch):
    monkeypatch.setattr(lengths, "BLOCK", 4)
    texts = ["a", "a", "", None, *[" ".join(words(i, i)) for i in range(1, 12)]]
    sizes = [len(reference().encode_ordinary(t or "")) for t in texts]
    counts = materialise(lengths.histogram(documents(spark, texts), RANKS, PATTERN), scratch)
    sums = lengths.suffix_sums(counts)
    want = [
        (n, sizes.count(n), sum(x <= n for x in sizes), sum(x > n for x in sizes), sum(x for x in sizes if x > n), sum(min(x, n) for x in sizes))
        for n in sorted(set(sizes))
    ]
    assert sorted(map(tuple, sums.collect())) == want
    limits = lengths.at_limits(sums, [0, 3, 10, 1000]).orderBy("limit").collect()
    assert [r.tokens_truncated for r in limits] == [sum(min(x, n) for x in sizes) for n in (0, 3, 10, 1000)]
    middle = lengths.quantiles(sums, [0.5, 1.0]).orderBy("share").collect()
    assert [r.n_tokens for r in middle] == [sorted(sizes)[-(-len(sizes) // 2) - 1], max(sizes)]
    assert lengths.suffix_sums(counts.limit(0)).count() == 0


def test_a_word_met_before_costs_no_python_string(monkeypatch):
    """Units are coded in bulk: what is looked up is each distinct unit of a segment once, and marks do not make new ones."""
    asked, looked_up, ids_of = [], [], UnitEncoder._ids
    monkeypatch.setattr(UnitEncoder, "_ids", lambda self, units: looked_up.append(list(units)) or ids_of(self, units))
    own = UnitEncoder(lambda units: asked.extend(units) or [u.encode("utf-32-le") for u in units])
    texts = ["red blue, red### blue red, " * 300, None, "red　blue's  red(blue)"]
    assert [x.decode("utf-32-le") for x in own.encode_many(texts)] == [t or "" for t in texts]
    assert len(looked_up) == 1 and len(looked_up[0]) == len(set(looked_up[0])) == len(asked) == 10
    assert " blue" in asked and " blue," not in asked
