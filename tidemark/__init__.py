"""Keep a keyed vector collection in step with a corpus of question/answer files."""

import sys

from pyspark import cloudpickle

from tidemark.functions.chunking import chunk, explode_chunks, fixed_windows
from tidemark.functions.encoding import encode, encode_apart, hashing_encoder, vector_faults
from tidemark.functions.identity import content_hash, point_id, text_hash, uuid5, with_identity
from tidemark.operators.diff import dedup_last, diff, next_state, op_counts
from tidemark.operators.export import export_batches, export_changes, export_counts, export_once
from tidemark.operators.points import apply_changes, build_points
from tidemark.operators.search import nearest
from tidemark.options import SyncOptions, normalise_metric
from tidemark.plans.sync import SyncResult, sync
from tidemark.sources.corpus import read_qas
from tidemark.sources.state import load_state, replace_state, save_state
from tidemark.sources.store import (
    count_points, ensure_collection, open_collection, read_points, read_state, vacuum,
)
from tidemark.streaming.ingest import start_ingest

__all__ = [
    "SyncOptions", "SyncResult", "apply_changes", "build_points", "chunk", "content_hash", "count_points",
    "dedup_last", "diff", "encode", "encode_apart", "ensure_collection", "explode_chunks", "export_batches",
    "export_changes", "export_counts", "export_once",
    "fixed_windows", "hashing_encoder", "load_state", "nearest", "next_state", "normalise_metric", "op_counts",
    "open_collection", "point_id", "read_points", "read_qas", "read_state", "replace_state", "save_state", "start_ingest",
    "sync", "text_hash", "uuid5", "vacuum", "vector_faults", "with_identity",
]

# The functions that run in Python workers travel with the job, so executors need no
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
