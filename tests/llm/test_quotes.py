import random
import re

import pytest
from helpers import words
from pyspark.sql import functions as F

from tidemark.llm import quotes

SCHEMA = "conv long, turn long, role string, text string"

MESSAGES = [
    (1, 0, "user", "Hello there\nsecond line\n\nA paragraph"), (1, 1, "a", "> Hello   there\n> second line\nYes"),
    (1, 2, "user", "> > Hello there\n> Yes\nok"), (1, 3, "a", "fine"), (1, 4, "b", ">yes\nbranch"), (1, 5, "b", "more"),
    (1, 6, "c", "> branch\n> nothing like this\nz"), (1, 7, "q", ">branch\nw"), (2, 0, "x", None), (None, None, "x", "> a"),
    (None, 3, "x", "b"), (3, 5, "u", "same"), (3, 5, "u", "same"), (3, 6, "u", "> same"), (3, 9, "u", ">\n> \nblank"),
]
# conv, turn: position, reply_to, root, depth, passages, linked
WANT = {
    (1, 0): (0, None, 0, 0, 0, 0), (1, 1): (1, 0, 0, 1, 1, 1), (1, 2): (2, 1, 0, 2, 2, 2), (1, 3): (3, 2, 0, 3, 0, 0),
    (1, 4): (4, 1, 0, 2, 1, 1), (1, 5): (5, 4, 0, 3, 0, 0), (1, 6): (6, 4, 0, 3, 1, 1), (1, 7): (7, 4, 0, 3, 1, 1),
    (2, 0): (0, None, 0, 0, 0, 0), (None, None): (0, None, 0, 0, 1, 0), (None, 3): (1, 0, 0, 1, 0, 0),
    (3, 6): (2, 1, 0, 2, 1, 1), (3, 9): (3, 2, 0, 3, 0, 0),
}


@pytest.mark.parametrize("block", [2, 1024])
def test_reply_order(spark, scratch, monkeypatch, block):
    monkeypatch.setattr(quotes, "BLOCK", block)
    rows = [(*m, "extra") for m in MESSAGES]
    found = quotes.reply_order(spark.createDataFrame(rows, "conv long, turn long, role string, text string, pos string"), scratch).collect()
    assert len(found) == len(MESSAGES)
    got = {(r.conv, r.turn): (r.pos, r.reply_to, r.root, r.depth, r.n_passages, r.n_linked) for r in found if (r.conv, r.turn) != (3, 5)}
    assert got == WANT
    assert sorted(r.pos for r in found if (r.conv, r.turn) == (3, 5)) == [0, 1]
    assert next(r.text for r in found if (r.conv, r.turn) == (1, 2)) == "ok"


def test_long_chain_of_jumps(spark, scratch):
    # Message 2k quotes message 2k - 2, past one that quotes nothing: a chain of branches.
    rows = [(7, i, "u", f"> unique words {i - 2}\nunique words {i}" if i % 2 == 0 and i else f"unique words {i}") for i in range(41)]
    found = quotes.reply_order(spark.createDataFrame(rows, "conv long, turn long, role string, text string"), scratch).collect()
    depth = {r.pos: r.depth for r in found}
    assert all(depth[i] == (i // 2 if i % 2 == 0 else i // 2 + 1) for i in range(41))
    assert {r.root for r in found} == {0}


def test_levels(spark):
    lines = ["a", "> a", ">> a", " > > > a", "x > a", ">"]
    found = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, x string").select("i", quotes.level("x").alias("n")).orderBy("i")
    assert [r.n for r in found.collect()] == [0, 1, 2, 3, 0, 1]


def test_empty_table(spark, scratch):
    none = spark.createDataFrame([], "conv long, turn long, role string, text string")
    assert quotes.reply_order(none, scratch).count() == 0


def marks(line):
    found = re.match(r"(?:[ \t]*>)+", line)
    return found.group().count(">") if found else 0


def normal(text):
    return re.sub(r"\s+", " ", text).strip(" ").lower()


def brute_force(rows):
    """What ``reply_order`` gives, by conversation and position, one message after the other."""
    out, conversations = {}, {}
    for row in rows:
        conversations.setdefault(row[0], []).append(row)
    for conv, messages in conversations.items():
        messages.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] or ""))
        said, replies = [], []
        for pos, (_, turn, role, text) in enumerate(messages):
            lines = (text or "").split("\n")
            own, quoted = "\n".join(x for x in lines if not marks(x)), []
            for i, line in enumerate(lines):
                if marks(line):
                    if not (i and marks(lines[i - 1]) == marks(line)):
                        quoted.append((marks(line), i, []))
                    quoted[-1][2].append(re.sub(r"^(?:[ \t]*>)+[ \t]?", "", line))
            quoted = [q for q in quoted if normal("\n".join(q[2]))]
            sources = []
            for depth, i, part in quoted:
                scores = {}
                for unit in [normal("\n".join(part)), *[u for u in map(normal, part) if u]]:
                    source = max((p for p in range(pos) if unit in said[p]), default=None)
                    scores[source] = scores.get(source, 0) + len(unit)
                scores.pop(None, None)
                if scores:
                    sources.append((depth, i, max((n, p) for p, n in scores.items())[1]))
            said.append({normal(u) for u in [own, *re.split(r"\n\s*\n", own), *own.split("\n")]} - {""})
            to = min(sources)[2] if sources else pos - 1 if pos else None
            replies.append(to)
            steps, at = 0, pos
            while replies[at] is not None:
                steps, at = steps + 1, replies[at]
            out[conv, pos] = (turn, role, own, to, at, steps, len(quoted), len(sources))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_generated_conversations_equal_brute_force(spark, scratch, monkeypatch, seed):
    monkeypatch.setattr(quotes, "BLOCK", 4)
    chance, rows = random.Random(seed), []
    vocabulary = words(seed, 12)
    for conv in [None, *range(12)]:
        texts = []
        for i in range(chance.randint(1, 25)):
            lines = []
            for _ in range(chance.randint(0, 2)):  # quotes of earlier messages, quotes within them, changed in case and blanks
                if texts:
                    source = chance.choice(texts).split("\n")
                    a = chance.randrange(len(source))
                    for line in source[a : a + chance.randint(1, 3)]:
                        lines.append(chance.choice([">", "> ", ">> ", " > > "]) + chance.choice([line, line.upper(), line.replace(" ", "  ")]))
                lines += [""] * chance.randint(0, 1)
            lines += [" ".join(chance.choices(vocabulary, k=chance.randint(0, 3))) for _ in range(chance.randint(0, 3))]
            texts.append("\n".join(lines))
            turn = chance.choice([None, i, i, i, 1000 * i, 5])
            rows += [(conv, turn, chance.choice("ab"), texts[-1] or None)] * chance.choice([1, 1, 1, 2])
    chance.shuffle(rows)
    want = brute_force(rows)
    found = quotes.reply_order(spark.createDataFrame(rows, SCHEMA).repartition(5), scratch).collect()
    got = {(r.conv, r.pos): (r.turn, r.role, r.text, r.reply_to, r.root, r.depth, r.n_passages, r.n_linked) for r in found}
    assert len(found) == len(rows) and got == want
    assert sum(w[7] for w in want.values()) > 50 and any(w[3] is not None and w[3] < p - 1 for (_, p), w in want.items())


@pytest.mark.parametrize("turn", [None, 7])
def test_no_task_orders_a_conversation_without_turns(spark, scratch, turn):
    rows = spark.range(4000).select(F.lit(1).cast("long").alias("conv"), F.lit(turn).cast("long").alias("turn"), F.lit("u").alias("role"), F.lit("same").alias("text"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = quotes.positions(rows, scratch)
        assert sorted(r.pos for r in found.select("pos").collect()) == list(range(4000))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    blocks = [r["count"] for r in spark.read.parquet(f"{scratch}/blocked").groupBy("_block").count().collect()]
    assert len(blocks) >= 3 and max(blocks) < 2500
