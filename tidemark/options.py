"""Job options and their checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

# The id namespace, the state format version, and the metric
# names a collection may be declared with. Ids and state files only match
# earlier runs while these stay as they are.
POINT_NAMESPACE = "f8a7c9a1-e45f-4e6d-8f3c-1b7a2b9e8d0f"
STATE_VERSION = "1.0"
METRICS = ("Cosine", "Dot", "Euclid")
METRIC_ALIASES = {"Euclidean": "Euclid", "Dotproduct": "Dot"}

CHANGE_KEYS = ("question", "content")


def normalise_metric(name: str) -> str:
    """Canonical metric name, ignoring case; ``ValueError`` for anything unknown."""
    if not isinstance(name, str):
        raise ValueError(f"metric must be a string, got {type(name).__name__}")
    title = name.capitalize()
    metric = METRIC_ALIASES.get(title, title)
    if metric not in METRICS:
        raise ValueError(f"unknown metric {name!r}; use one of {', '.join(METRICS)}")
    return metric


def check_positive(name: str, value: int) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")
    return value


def check_chunking(size: int, overlap: int) -> None:
    check_positive("chunk_size", size)
    if isinstance(overlap, bool) or not isinstance(overlap, int) or overlap < 0:
        raise ValueError(f"chunk_overlap must be a non-negative integer, got {overlap!r}")
    if overlap >= size:
        raise ValueError(f"chunk_overlap ({overlap}) must be smaller than chunk_size ({size})")


def encoder_batch(batch_size: int) -> int:
    """Questions per encoder call when points travel in batches of ``batch_size``."""
    return check_positive("batch_size", batch_size) // 2 or 16


def check_choice(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {', '.join(allowed)}, got {value!r}")


@dataclass(frozen=True)
class SyncOptions:
    """Everything that changes what a sync run does.

    ``encoder`` is a factory called once per task that returns
    ``list[str] -> array(n, dim)``; ``None`` uses the hashing encoder.
    ``broadcast_rows`` bounds how many narrow keys may be broadcast; beyond it
    the same join runs shuffled. ``on_row_error="skip"`` leaves out the items the encoder
    fails on: they are listed, keep what was indexed before, and are tried again by the next run; more than
    ``max_failed_fraction`` of them stop the run. ``batch_chars`` bounds the characters of an encoder's batch.
    """

    collection: str = "qa-points-v1"
    dim: int = 384
    metric: str = "Cosine"
    encoder: Callable[[], Callable[[list[str]], Any]] | None = field(default=None, compare=False)
    chunk_size: int = 1000
    chunk_overlap: int = 150
    batch_size: int = 128
    namespace: str = POINT_NAMESPACE
    change_key: str = "question"
    force: bool = False
    dry_run: bool = False
    apply_deletes: bool = True
    on_bad_file: str = "drop"
    max_delete_fraction: float | None = None
    on_mismatch: str = "warn"
    on_row_error: str = "fail"
    max_failed_fraction: float | None = None
    batch_chars: int | None = None
    broadcast_rows: int = 1_000_000
    rows_per_task: int = 20_000
    compact_fraction: float = 0.25
    max_deltas: int = 16

    def __post_init__(self) -> None:
        object.__setattr__(self, "metric", normalise_metric(self.metric))
        check_positive("dim", self.dim)
        check_positive("batch_size", self.batch_size)
        check_positive("rows_per_task", self.rows_per_task)
        check_positive("max_deltas", self.max_deltas)
        check_chunking(self.chunk_size, self.chunk_overlap)
        check_choice("change_key", self.change_key, CHANGE_KEYS)
        check_choice("on_bad_file", self.on_bad_file, ("drop", "keep"))
        check_choice("on_mismatch", self.on_mismatch, ("warn", "error"))
        check_choice("on_row_error", self.on_row_error, ("fail", "skip"))
        for name in ("max_delete_fraction", "max_failed_fraction"):
            if getattr(self, name) is not None and not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie between 0 and 1")
        if self.batch_chars is not None:
            check_positive("batch_chars", self.batch_chars)
        if self.broadcast_rows < 0:
            raise ValueError("broadcast_rows must not be negative")
