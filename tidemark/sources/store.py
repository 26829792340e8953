"""A keyed collection of points as parquet commits in one folder.

A commit is a folder of rows plus one line in ``commits/``, written last, so
points and state become visible together or not at all. ``base`` commits hold
every point, ``delta`` commits only what changed (with a ``deleted`` mark), so a
run writes as much as changed and not the whole collection. Readers take the
newest row per id. Once the deltas have grown past a share of the base, the next
commit writes a new base. One job writes to a collection at a time; readers may
run alongside, as the folders of earlier commits stay in place until
:func:`vacuum` removes those that no kept version needs.

A base is bucketed and sorted by id, and so is every delta with rows for most buckets, in as
many buckets as its base. They meet bucket by bucket: reading, comparing and compacting
exchange no row of a base, and of the deltas at most the ids. Few ids are looked up in their
buckets alone.
"""

from __future__ import annotations

import logging
import time
import uuid
from dataclasses import dataclass, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.points import POINT_SCHEMA
from tidemark.options import check_choice, check_positive, normalise_metric
from tidemark.sources.scratch import children, discard, qualified

log = logging.getLogger(__name__)

ROW_SCHEMA = f"{POINT_SCHEMA}, question_hash string, deleted boolean"
COMMIT_SCHEMA = (
    "version bigint, kind string, data string, dim int, metric string, "
    "upserted bigint, deleted bigint, points bigint, committed_at string, buckets int"
)

# Most ids (of 36 bytes) that may be broadcast: about 100 MB.
BROADCAST_IDS = 1_000_000

# Points that a bucket is meant to hold, and bounds of the number of buckets.
BUCKET_POINTS, LEAST_BUCKETS, MOST_BUCKETS = 20_000, 8, 1 << 16

# Most ids that are looked up one by one.
LOOKED_UP = 1_000


@dataclass(frozen=True)
class Collection:
    """Where a collection lives, and what its commits say about it."""

    path: str
    name: str
    dim: int
    metric: str
    version: int
    points: int
    segments: tuple[tuple[int, str, str, int], ...]
    base_rows: int
    delta_rows: int

    @property
    def deltas(self) -> int:
        return sum(1 for s in self.segments if s[1] == "delta")

    @property
    def buckets(self) -> int:
        """Buckets of the base; 0 when it has none."""
        return self.segments[0][3]


def _folder(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    """Commit records below ``folder``, one per version.

    Of two writers that made one version, the one whose record was there first has it; the other withdraws its own.
    """
    found = spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", True).json(folder).select(
        "*", F.col("_metadata.file_modification_time").alias("written"), F.col("_metadata.file_path").alias("record")
    ).where("version IS NOT NULL")
    first = Window.partitionBy("version").orderBy("written", "record")
    return found.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place", "written")


def open_collection(spark: SparkSession, path: str, name: str) -> Collection | None:
    """The latest committed version, or None when the collection does not exist."""
    try:
        commits = _records(spark, f"{_folder(path, name)}/commits")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None
    base = commits.where("kind = 'base'").agg(F.max("version")).first()[0]
    # Commits since the last base: at most one base and ``max_deltas`` short rows.
    rows = commits.where(F.col("version") >= (base or 0)).orderBy("version").collect()
    if not rows:
        return None
    return _collection(path, name, rows)


def _collection(path: str, name: str, rows: list) -> Collection:
    """The collection as of the last of its records, which begin with a base."""
    last = rows[-1]
    return Collection(
        path=path, name=name, dim=last.dim, metric=last.metric, version=last.version, points=last.points,
        segments=tuple((r.version, r.kind, r.data, r.buckets or 0) for r in rows),
        base_rows=rows[0].points,
        delta_rows=sum(r.upserted + r.deleted for r in rows[1:]),
    )


def _commit(
    spark: SparkSession, path: str, name: str, version: int, kind: str, data: str, dim: int, metric: str,
    upserted: int, deleted: int, points: int, below: Collection | None = None, buckets: int = 0,
) -> Collection:
    """Make a written folder visible. A version that exists already is an error."""
    record = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"), F.lit(kind).alias("kind"), F.lit(data).alias("data"),
        F.lit(dim).alias("dim"), F.lit(metric).alias("metric"),
        F.lit(upserted).cast("bigint").alias("upserted"), F.lit(deleted).cast("bigint").alias("deleted"),
        F.lit(points).cast("bigint").alias("points"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("committed_at"),
        F.lit(buckets).alias("buckets"),
    )
    # A name of its own, so that what an interrupted commit has left stands in nobody's way.
    token = f"v={version:08d}-{uuid.uuid4().hex}"
    commits = f"{_folder(path, name)}/commits"
    record.coalesce(1).write.mode("errorifexists").json(f"{commits}/{token}")
    winner = _records(spark, commits).where(F.col("version") == version).first()
    if winner is None:
        raise RuntimeError(f"commit {version} of collection {name!r} is not there after writing it")
    if token not in unquote(winner.record):
        discard(spark, f"{commits}/{token}")
        raise RuntimeError(f"version {version} of collection {name!r} is there already: another writer made it")
    segment = (version, kind, data, buckets)
    if kind == "base" or below is None:
        return Collection(path, name, dim, metric, version, points, (segment,), points, 0)
    return replace(
        below, version=version, points=points, segments=below.segments + (segment,),
        delta_rows=below.delta_rows + upserted + deleted,
    )


def new_data_path(path: str, name: str) -> str:
    """A folder no commit refers to yet."""
    return f"{_folder(path, name)}/data/{uuid.uuid4().hex}"


def bucket_count(points: int) -> int:
    """Buckets for so many points: a power of two."""
    wanted = max(1, -(-points // BUCKET_POINTS))
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << (wanted - 1).bit_length()))


def delta_buckets(collection: Collection, rows: int) -> int:
    """Buckets to write a commit of ``rows`` rows with; 0 where most buckets would stay empty.

    The first rows of a collection become its base, so they are always bucketed.
    """
    if collection.base_rows == 0 and collection.deltas == 0:
        return bucket_count(rows)
    return collection.buckets if rows >= collection.buckets else 0


def _table(data: str) -> str:
    """Name in the session's catalog of the bucketed rows at ``data``."""
    return f"tidemark_{data.rstrip('/').rsplit('/', 1)[-1]}"


def write_rows(rows: DataFrame, data: str, buckets: int) -> None:
    """Write the rows of a commit to the new folder ``data``.

    The Bloom filters of the ids let a lookup skip what it does not need.
    """
    writer = rows.write.option("parquet.bloom.filter.enabled#id", "true").mode("errorifexists")
    if buckets:
        # Spark knows bucketing for tables only; the table is external and just names the folder.
        writer.format("parquet").bucketBy(buckets, "id").sortBy("id").option("path", data).saveAsTable(_table(data))
    else:
        writer.parquet(data)


def read_data(spark: SparkSession, data: str, buckets: int) -> DataFrame:
    """The rows of one commit."""
    if not buckets:
        return spark.read.schema(ROW_SCHEMA).parquet(data)
    name = _table(data)
    if not spark.catalog.tableExists(name):
        place = qualified(spark, data).replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({ROW_SCHEMA}) USING parquet "
            f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)


def ensure_collection(
    spark: SparkSession, path: str, name: str, dim: int, metric: str = "Cosine",
    recreate: bool = False, on_mismatch: str = "warn",
) -> Collection:
    """Open the collection, creating it when absent.

    ``recreate`` drops all points. An existing collection of another dimension or
    metric is only warned about unless ``on_mismatch="error"``; it keeps its own.
    """
    check_positive("dim", dim)
    check_choice("on_mismatch", on_mismatch, ("warn", "error"))
    metric = normalise_metric(metric)
    found = open_collection(spark, path, name)
    if found is None or recreate:
        data = new_data_path(path, name)
        spark.createDataFrame([], ROW_SCHEMA).write.parquet(data)
        version = 1 if found is None else found.version + 1
        return _commit(spark, path, name, version, "base", data, dim, metric, 0, 0, 0)
    if (found.dim, found.metric) != (dim, metric):
        message = (
            f"collection {name!r} has dim={found.dim}, metric={found.metric}; "
            f"expected dim={dim}, metric={metric}"
        )
        if on_mismatch == "error":
            raise ValueError(message)
        log.warning(message)
    return found


def read_rows(
    spark: SparkSession, collection: Collection, broadcast_rows: int = BROADCAST_IDS, ids: list[str] | None = None,
) -> DataFrame:
    """Live rows ``(id, vector, payload, question_hash)`` of the collection's version.

    With ``ids``, at most ``LOOKED_UP`` of them, only their rows; other buckets are not read.
    """
    live = ["id", "vector", "payload", "question_hash"]
    parts = [(version, read_data(spark, data, buckets)) for version, _, data, buckets in collection.segments]
    if ids is not None:
        if len(ids) > LOOKED_UP:
            raise ValueError(f"at most {LOOKED_UP} ids can be looked up, got {len(ids)}")
        parts = [(version, rows.where(F.col("id").isin(ids))) for version, rows in parts]
    base = parts[0][1]
    if len(parts) == 1:
        return base.select(*live)
    named = [rows.select("id", F.lit(version).alias("version")) for version, rows in parts[1:]]
    newest = reduce(DataFrame.unionByName, named).groupBy("id").agg(F.max("version").alias("version"))
    # The commits say how many ids the deltas hold; only while that is few they are broadcast.
    share = F.broadcast if collection.delta_rows <= broadcast_rows else lambda few: few
    found = base.join(share(newest.select("id")), "id", "left_anti").select(*live)
    for version, rows in parts[1:]:
        own = rows.where("NOT deleted").select(*live)
        if len(parts) > 2:
            own = own.join(share(newest.where(F.col("version") == version).select("id")), "id", "left_semi")
        found = found.unionByName(own)
    return found


def read_points(spark: SparkSession, collection: Collection, broadcast_rows: int = BROADCAST_IDS) -> DataFrame:
    """Live points ``(id, vector, payload)``."""
    return read_rows(spark, collection, broadcast_rows).drop("question_hash")


def read_state(
    spark: SparkSession, collection: Collection, broadcast_rows: int = BROADCAST_IDS, ids: list[str] | None = None,
) -> DataFrame:
    """State table of the collection, or of ``ids`` alone; reads only ids, sources and hashes from the files."""
    return read_rows(spark, collection, broadcast_rows, ids).select(
        F.col("id").alias("point_id"), F.col("payload.source").alias("source_file"), "question_hash"
    )


def as_rows(upserts: DataFrame | None, delete_ids: DataFrame | None) -> DataFrame:
    """Upserts ``(id, vector, payload, question_hash)`` and deleted ids as rows of a delta."""
    parts = []
    if upserts is not None:
        parts.append(upserts.select("id", "vector", "payload", "question_hash", F.lit(False).alias("deleted")))
    if delete_ids is not None:
        parts.append(
            delete_ids.select(
                "id", F.lit(None).cast("array<float>").alias("vector"),
                F.lit(None).cast(_payload_type()).alias("payload"),
                F.lit(None).cast("string").alias("question_hash"), F.lit(True).alias("deleted"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _payload_type() -> str:
    return POINT_SCHEMA[POINT_SCHEMA.index("struct<"):]


def commit_changes(
    spark: SparkSession, collection: Collection, data: str, upserted: int, deleted: int, points: int,
    compact_fraction: float = 0.25, max_deltas: int = 16, buckets: int = 0, broadcast_rows: int = BROADCAST_IDS,
) -> Collection:
    """Publish the delta written at ``data``, folding it into a new base when it is time.

    Counts come from the caller, who has read them from the written rows, and so does the number of buckets.
    """
    if upserted == 0 and deleted == 0:
        return collection
    version = collection.version + 1
    grown = collection.delta_rows + upserted + deleted > compact_fraction * collection.base_rows
    dim, metric = collection.dim, collection.metric
    if collection.base_rows == 0 and collection.deltas == 0 and deleted == 0:
        # Nothing below the delta: it already is a base.
        return _commit(spark, collection.path, collection.name, version, "base", data, dim, metric,
                       upserted, 0, points, buckets=buckets)
    if not grown and collection.deltas < max_deltas:
        return _commit(spark, collection.path, collection.name, version, "delta", data, dim, metric,
                       upserted, deleted, points, collection, buckets)
    merged = replace(
        collection, segments=collection.segments + ((version, "delta", data, buckets),),
        delta_rows=collection.delta_rows + upserted + deleted,
    )
    base, wanted = new_data_path(collection.path, collection.name), bucket_count(points)
    rows = read_rows(spark, merged, broadcast_rows).withColumn("deleted", F.lit(False))
    if not collection.buckets or not collection.buckets // 4 <= wanted <= 4 * collection.buckets:
        # The only time that a base is exchanged: it has outgrown its buckets.
        rows = rows.repartition(wanted, "id")
    else:
        wanted = collection.buckets
    write_rows(rows, base, wanted)
    return _commit(spark, collection.path, collection.name, version, "base", base, dim, metric,
                   upserted, deleted, points, buckets=wanted)


def count_points(spark: SparkSession, collection: Collection) -> int:
    """Exact number of live points, counted from the files."""
    return read_rows(spark, collection).count()


def vacuum(spark: SparkSession, path: str, name: str, keep_versions: int = 1, grace_hours: float = 24.0) -> list[str]:
    """Delete data that none of the newest ``keep_versions`` versions needs; returns the names of the folders.

    What a version needs follows from the commit records: its rows down to the base below it. Folders
    younger than ``grace_hours`` stay, as a running job may be about to commit them, and so do all records
    of kept versions; records below the oldest needed base go. A reader of a kept version is not disturbed.
    """
    check_positive("keep_versions", keep_versions)
    folder = _folder(path, name)
    newest = open_collection(spark, path, name)
    if newest is None:
        return []
    records = _records(spark, f"{folder}/commits")
    oldest = newest.version - keep_versions + 1
    floor = records.where((F.col("kind") == "base") & (F.col("version") <= oldest)).agg(F.max("version")).first()[0] or 0
    # One short row per commit.
    needed = {r.data.rstrip("/").rsplit("/", 1)[-1] for r in records.where(F.col("version") >= floor).select("data").collect()}
    gone = []
    for child, modified in children(spark, f"{folder}/data"):
        if child not in needed and time.time() - modified > 3600 * grace_hours:
            spark.sql(f"DROP TABLE IF EXISTS {_table(child)}")
            discard(spark, f"{folder}/data/{child}")
            gone.append(child)
    for child, modified in children(spark, f"{folder}/commits"):
        # Names begin with the version.
        if int(child[2:10]) < floor and time.time() - modified > 3600 * grace_hours:
            discard(spark, f"{folder}/commits/{child}")
    return sorted(gone)
