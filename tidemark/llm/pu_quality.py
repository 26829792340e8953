"""Quality scores by positive-unlabelled learning.

Trusted positives are texts labelled good; the rest of the evidence is unlabelled web text, of which a
share ``prior`` is good too. A logistic model minimises the non-negative unbiased risk

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with R_p and R_u the mean logistic loss over positives and unlabelled texts. While the bracket is
negative, which only over-fitting can bring about, the step goes against its gradient instead.

The prior comes from the same two kinds of rows: a model tells half of the positives from half of the unlabelled,
and with the other halves, over all cutoffs, the share of unlabelled texts above it is divided by that of
positives. Above the cutoff with the least upper bound hardly any bad text is left, so the quotient there is the
share of good ones. Texts labelled bad are never learned from.

Features of a whole text are shares of kinds of bytes, repetition and size, and, hashed to BUCKETS each, the shares of
its words, pairs of neighbouring words and runs of three bytes (letters A-Z in lower case), so that what is said and in
which order counts. The model is fitted on at most POSITIVES and UNLABELLED rows (the documented bound), chosen by a
hash of the id; a row of features has 1.7 kB, so what reaches the driver stays at 100 MB at any size. Features are
computed for these rows and, with the score, in one pass over all texts; they are never written.

Defined cases: null and empty texts have all features zero and get a score as any other; very long texts are read in
pieces of SEGMENT bytes, and a word or line beyond that counts as several; a null id counts as not held out and has
no label; labels with null quality are ignored, contradictory ones count as bad; repeated rows are scored alike, and
an id is learned from once, by its smallest text; other columns are kept by ``scored``, which replaces one named like its result; an empty
table gives an empty result; without positives or unlabelled texts every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import add_columns, map_rows

#: Largest numbers of rows that the model is fitted on.
POSITIVES, UNLABELLED = 20_000, 40_000
STEPS, RATE, PENALTY, CLIP = 600, 0.05, 1e-4, 8.0
#: Buckets for each kind of hashed features, and their weight beside the others.
BUCKETS, HASHED_SCALE = 128, 0.1

#: Kinds of bytes: each is a share of all bytes of the text.
KINDS = (
    ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("line", b"\n"), ("space", b" \t\r\x0b\x0c"),
    ("stop", b".,;:?"), ("loud", b"!"), ("bar", b"|"), ("mark", b"#*$%&"), ("angle", b"<>{}[]()\\/=+~^_@"), ("quote", b"\"'`-"),
)
_TABLE = np.full(256, len(KINDS), np.int64)
for _i, (_, _kind) in enumerate(KINDS):
    _TABLE[list(_kind)] = _i
_TABLE[128:] = len(KINDS) + 1
SHARES = (*(k for k, _ in KINDS), "other", "wide", "line_repeats", "word_repeats", "same_word", "new_words")
HASHED = tuple(f"{kind}_{i}" for kind in ("word", "pair", "bytes") for i in range(BUCKETS))
NAMES = (*SHARES, *(f"root_{s}" for s in SHARES), "size", "words", "word_size", *HASHED)
DENSE = len(NAMES) - len(HASHED)
SEGMENT = 1 << 20

_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, n: int) -> np.ndarray:
    values = np.full(n, base, np.uint64)
    values[0] = 1
    return np.multiply.accumulate(values)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class Hasher:
    """64-bit hashes of the tokens of a text between bytes that separate; equal tokens have equal hashes anywhere."""

    def __init__(self) -> None:
        self.up, self.down = _powers(_BASE, SEGMENT), _powers(pow(_BASE, -1, 1 << 64), SEGMENT)

    def tokens(self, data: bytes, separators: bytes) -> np.ndarray:
        apart = np.zeros(256, bool)
        apart[list(separators)] = True
        out, at = [], 0
        while at < len(data):
            part = np.frombuffer(data, np.uint8, min(SEGMENT, len(data) - at), at)
            gaps = apart[part]
            if at + len(part) < len(data) and gaps.any():  # up to the last separator
                part = part[: len(part) - int(gaps[::-1].argmax())]
                gaps = gaps[: len(part)]
            at += len(part)
            edges = np.flatnonzero(np.diff(np.concatenate(([True], gaps, [True])).view(np.int8)))
            starts, ends = edges[::2], edges[1::2]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((_LOWER[part].astype(np.uint64) + np.uint64(1)) * self.up[: len(part)], out=sums[1:])
            out.append(_mixed((sums[ends] - sums[starts]) * self.down[np.minimum(starts, SEGMENT - 1)]))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _runs(data: bytes) -> np.ndarray:
    """How often a run of three bytes falls into each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data) - 2, SEGMENT):
        part = _LOWER[np.frombuffer(data, np.uint8, min(SEGMENT + 2, len(data) - at), at)].astype(np.uint64)
        h = _mixed(((part[:-2] << np.uint64(16)) | (part[1:-1] << np.uint64(8)) | part[2:]) * np.uint64(_BASE))
        counts += np.bincount((h % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return counts


def features(text: str | None, hasher: Hasher) -> np.ndarray:
    """The features of a whole text, in the order of NAMES."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return np.zeros(len(NAMES), np.float32)
    counts = np.zeros(256, np.int64)
    for at in range(0, len(data), SEGMENT):
        counts += np.bincount(np.frombuffer(data, np.uint8, min(SEGMENT, len(data) - at), at), minlength=256)
    kinds = np.bincount(_TABLE, weights=counts, minlength=len(KINDS) + 2) / len(data)
    lines, words = hasher.tokens(data, b"\n"), hasher.tokens(data, b" \t\n\r\x0b\x0c")
    pairs = _mixed(words[:-1] * np.uint64(3) + words[1:])
    n, distinct = max(1, len(words)), len(np.unique(words))
    shares = np.array([
        *kinds, 1 - len(np.unique(lines)) / max(1, len(lines)), 1 - len(np.unique(pairs)) / max(1, n - 1) if n > 1 else 0.0,
        np.count_nonzero(words[1:] == words[:-1]) / n, distinct / n,
    ])
    hashed = [np.bincount((h % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS) for h in (words, pairs)]
    hashed = [np.sqrt(h / max(1, h.sum())) for h in (*hashed, _runs(data))]
    size = [np.log1p(len(data)), np.log1p(len(words)), len(data) / n / 10]
    return np.concatenate([shares, np.sqrt(shares), size, *hashed]).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED):
    """Features of positives and of unlabelled rows; ``docs``: ``doc_id, text``. Only the chosen rows' texts are exchanged."""
    votes = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    n, good = rows.select("doc_id").join(votes, "doc_id", "left").agg(
        F.expr("count_if(quality IS NULL)"), F.expr("count_if(quality = 1)")
    ).first()

    def vectors(part: pa.RecordBatch) -> list[tuple]:
        hasher = Hasher()
        ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
        return [(i, features(t, hasher).tobytes()) for i, t in zip(ids, texts)]

    def some(which: str, most: int, there: int) -> np.ndarray:
        # A hash below a bound keeps somewhat fewer than ``most`` ids whatever the order; the slice makes it certain.
        bound = int((1 << 30) * (1.0 if there <= most else 0.95 * most / there))
        chosen = F.pmod(F.xxhash64("doc_id", F.lit("pu")), F.lit(1 << 30)) < bound
        part = rows.where(chosen).join(votes.where(chosen), "doc_id", "left").where(which).groupBy("doc_id").agg(F.min("text").alias("text"))
        kind = dict(docs.dtypes)["doc_id"]
        found = map_rows(part, vectors, f"doc_id {kind}, x binary", "text").toArrow().sort_by("doc_id").slice(0, most)
        return np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(-1, len(NAMES))

    return some("quality = 1", positives, good), some("quality IS NULL", unlabelled, n)


def prior_from(p: np.ndarray, u: np.ndarray, doubt: float = 0.1) -> float:
    """Share of good ones among the unlabelled, from scores of held-back ``p`` and ``u`` (higher: likelier positive)."""
    cutoffs = np.unique(p)
    above_p = 1 - np.searchsorted(np.sort(p), cutoffs) / len(p)
    above_u = 1 - np.searchsorted(np.sort(u), cutoffs) / len(u)
    slack = sum(np.sqrt(np.log(4 / doubt) / (2 * len(z))) for z in (p, u))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(above_u[best] / above_p[best])


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Mean of two estimates, each with one half of the rows held back; kept away from 0 and 1."""
    if min(len(p), len(u)) < 4:
        return 0.5
    p, u = p[:, :DENSE], u[:, :DENSE]
    found = []
    for i in range(2):
        model = fit(p[i::2], u[i::2], None)
        found.append(prior_from(model.score(p[1 - i :: 2]), model.score(u[1 - i :: 2])))
    return min(0.98, max(0.02, sum(found) / 2))


@dataclass
class Model:
    """Weights over standardised features, which are clipped to CLIP deviations."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP) * weight_of(x.shape[1])

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.standard(x).astype(np.float64) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def weight_of(n: int) -> np.ndarray:
    return np.where(np.arange(n) < DENSE, 1.0, HASHED_SCALE).astype(np.float32)


def risk(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> tuple[float, float, np.ndarray, np.ndarray]:
    """The risk's part of positives and its bracket, and their gradients, with logistic loss."""
    at_p, at_u = p @ w, u @ w
    sig_p, sig_u = 1 / (1 + np.exp(-at_p)), 1 / (1 + np.exp(-at_u))
    part = prior * np.logaddexp(0, -at_p).mean()
    bracket = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
    of_part = prior * ((sig_p - 1) @ p) / len(p)
    of_bracket = sig_u @ u / len(u) - prior * (sig_p @ p) / len(p)
    return float(part), float(bracket), of_part, of_bracket


def fit(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int = STEPS) -> Model:
    """The logistic model with least non-negative risk, by Adam on all rows; without ``prior``, one that tells p from u."""
    width = len(NAMES) if not len(p) else p.shape[1]
    if not len(p) or not len(u):
        zeros = np.zeros(width)
        return Model(zeros, zeros + 1, zeros, 0.0)
    total = len(p) + len(u)
    mean = (p.sum(axis=0, dtype=np.float64) + u.sum(axis=0, dtype=np.float64)) / total
    middle = mean.astype(np.float32)
    scale = np.sqrt(sum(((z - middle) ** 2).sum(axis=0, dtype=np.float64) for z in (p, u)) / total)
    scale[scale < 1e-6] = 1.0
    model = Model(middle, scale.astype(np.float32), np.zeros(width), 0.0)
    p, u = (np.column_stack([model.standard(z), np.ones(len(z), np.float32)]) for z in (p, u))
    w = np.zeros(width + 1)
    if prior is not None:
        w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        narrow = w.astype(np.float32)
        if prior is None:
            sig_p, sig_u = (1 / (1 + np.exp(-(z @ narrow))) for z in (p, u))
            gradient = 0.5 * ((sig_p - 1) @ p / len(p) + sig_u @ u / len(u))
        else:
            _, bracket, of_part, of_bracket = risk(narrow, p, u, prior)
            gradient = of_part + of_bracket if bracket >= 0 else -of_bracket
        gradient = gradient + PENALTY * np.append(w[:-1], 0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w = w - RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    return Model(model.mean, model.scale, w[:-1], float(w[-1]))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    p, u = learning_rows(docs, labels)
    return fit(p, u, class_prior(p, u))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, from 0 to 1, of the whole ``text``."""

    def score(part: pa.RecordBatch) -> list[pa.Array]:
        hasher = Hasher()
        x = np.stack([features(t, hasher) for t in part.column("text").to_pylist()])
        return [pa.array(model.score(x), pa.float64())]

    return add_columns(docs.drop("score"), score, "score double", "text")
