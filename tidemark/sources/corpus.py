"""Reading a tree of question/answer JSON files.

Each file holds one JSON array of ``{q, a, product, keywords}``. A file that is
not strict JSON, or whose top level is not an array, is dropped as a whole; an
item that breaks a rule is dropped alone. Both stay visible in the results.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json import STRICT_OPTIONS, is_single_value, strict_value
from tidemark.functions.text import is_blank
from tidemark.sources import files as tree_files
from tidemark.sources import pieces as cutting
from tidemark.sources.pieces import elements_of, frames_of, parts_of
from tidemark.sources.scratch import materialise, shared_folder

# The keys every item must have.
ITEM_KEYS = ("q", "a", "product", "keywords")

FILE_SCHEMA = "source string, content binary"
ITEM_SCHEMA = "source string, pos bigint, q string, a string, product string, keywords array<string>"

# Fixed value: characters of a dropped item or file that are shown.
PREVIEW = 150

# Size of one item beyond which Spark cannot hold it as a variant, and of a file beyond which it is cut into pieces.
ITEM_BYTES, LARGE = 128 * 1024 * 1024, 64 * 1024 * 1024

# Bytes of a file from which its preview is taken.
HEAD_BYTES = 4 * PREVIEW


# Files without items that are broadcast, to be left out.
FEW_FILES = 100_000

# File statuses that drop the file.
FILE_ERRORS = ("not_array", "malformed", "not_utf8", "too_large")


class Corpus(NamedTuple):
    """``valid`` items, ``rejects`` with a reason, one row per file in ``files``, and the
    dropped files in ``errors``."""

    valid: DataFrame
    rejects: DataFrame
    files: DataFrame
    errors: DataFrame


def read_files(spark: SparkSession, root: str, strict: bool = True, only: list[str] | None = None) -> DataFrame:
    """``(source, content)`` of every ``*.json`` below ``root``; ``source`` is relative to it.

    Hidden and empty files are files like any other. Those beyond ``LARGE`` bytes are left to :func:`large_items`.
    A root that is no folder raises with ``strict`` and gives no rows otherwise. ``only`` names the files to
    read. Where just Spark can open the store, its own reader is used, which sees neither hidden nor empty files.
    """
    try:
        prefix = folder_prefix(spark, root)
    except FileNotFoundError:
        if strict:
            raise
        return spark.createDataFrame([], FILE_SCHEMA)
    if tree_files.readable(prefix):
        return tree_files.tree(spark, prefix, only=only, large=LARGE).select("source", "content")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .load(root)
    )
    return files.select(relative_path(F.col("path"), prefix).alias("source"), "content")


def read_exploded(spark: SparkSession, root: str, strict: bool = True, only: list[str] | None = None) -> DataFrame:
    """Item rows (of :func:`explode_items`) of all files below ``root``, whatever their size."""
    rows = explode_items(parse_files(read_files(spark, root, strict, only)))
    try:
        prefix = folder_prefix(spark, root)
    except FileNotFoundError:
        return rows
    if not tree_files.readable(prefix):
        return rows
    large = tree_files.tree(spark, prefix, "large", only=only, large=LARGE)
    if large.isEmpty():
        return rows
    return rows.unionByName(large_items(spark, lambda states: file_pieces(large, prefix, states)))


def folder_prefix(spark: SparkSession, root: str) -> str:
    """``root`` as Spark spells it in the paths of the files below, with a slash at the end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    filesystem = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not (filesystem.exists(path) and filesystem.getFileStatus(path).isDirectory()):
        raise FileNotFoundError(f"{root} is not a folder")
    return filesystem.makeQualified(path).toString().rstrip("/") + "/"


def relative_path(path: Column, base: str) -> Column:
    """``path`` below ``base``, or just the file name when it lies elsewhere."""
    return F.when(F.startswith(path, F.lit(base)), F.substr(path, F.lit(len(base) + 1))).otherwise(
        F.substring_index(path, "/", -1)
    )


def parse_files(files: DataFrame) -> DataFrame:
    """Parse ``(source, content)`` to ``(source, status, head, items array<variant>)``.

    ``status`` is ``ok``, ``empty``, ``not_array``, ``malformed``, ``not_utf8``
    or ``too_large``; ``head`` shows the start of a file without items. Items
    are separate variants, so the size limit of a variant applies to an item and
    not to the file.
    """
    # The reader lets the last of two equal keys win only under this setting.
    files.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = F.col("content").cast("string")
    body = F.col("text")
    found = F.col("found")
    opens_array = body.rlike(r"\A[ \t\r\n]*\[")
    return (
        files.select(
            "source", F.when(F.is_valid_utf8(text), text).alias("text"),
            F.left(F.make_valid_utf8(text), F.lit(PREVIEW)).alias("head"),
        )
        .withColumn(
            "found",
            F.when(
                opens_array & is_single_value(body),
                F.from_json(body, "array<variant>", STRICT_OPTIONS),
            ),
        )
        .select(
            "source",
            F.when(body.isNull(), "not_utf8")
            .when(F.size(found) > 0, "ok")
            .when(F.size(found) == 0, "empty")
            .when(opens_array & (F.octet_length(body) >= ITEM_BYTES) & is_single_value(body), "too_large")
            .when(opens_array, "malformed")
            .when(is_single_value(body) & F.try_parse_json(body).isNotNull(), "not_array")
            .otherwise("malformed")
            .alias("status"),
            F.when(found.isNull(), F.col("head")).alias("head"),
            found.alias("items"),
        )
    )


def explode_items(parsed: DataFrame) -> DataFrame:
    """One row per item, and one with null ``pos`` per file without any.

    Columns: ``source, status, pos, reason, q, a, product, keywords, raw``.
    ``reason`` is null for a valid item; ``raw`` starts like the item, or like the file
    where there is none.
    """
    # An outer explode: the inner one would make Spark infer a filter that parses every file again.
    return _checked(parsed.select("source", "status", "head", F.posexplode_outer("items").alias("pos", "item")))


def _checked(rows: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The item rules on rows ``source, status, head, pos, item`` (a variant); the columns ``also`` travel along."""
    part = {key: F.variant_get("item", f"$.{key}", "variant") for key in ITEM_KEYS}
    kind = {key: F.schema_of_variant(part[key]) for key in ITEM_KEYS}
    text = {key: F.try_variant_get("item", f"$.{key}", "string") for key in ITEM_KEYS[:3]}
    is_object = F.startswith(F.schema_of_variant("item"), F.lit("OBJECT"))
    absent = part["q"].isNull() | part["a"].isNull() | part["product"].isNull() | part["keywords"].isNull()
    mistyped = (
        (kind["q"] != "STRING") | (kind["a"] != "STRING") | (kind["product"] != "STRING")
        | ~F.startswith(kind["keywords"], F.lit("ARRAY"))
    )
    reason = (
        F.when(F.col("pos").isNull(), F.lit(None))
        .when(absent, F.when(is_object, "missing_key").otherwise("not_object"))
        .when(mistyped, "wrong_type")
        .when(is_blank(text["q"]) | is_blank(text["a"]), "blank")
    )
    return rows.select(
        "source", "status", F.col("pos").cast("bigint").alias("pos"), reason.alias("reason"),
        text["q"].alias("q"), text["a"].alias("a"), text["product"].alias("product"),
        F.try_variant_get("item", "$.keywords", "array<string>").alias("keywords"),
        F.when(F.col("pos").isNull(), F.col("head"))
        .otherwise(F.left(F.to_json("item"), F.lit(PREVIEW))).alias("raw"), *also,
    )


def file_pieces(files: DataFrame, prefix: str, states: DataFrame | None) -> DataFrame:
    """Pieces of the files ``source, size`` below ``prefix``, of ``states`` when given; read by the tasks that need them."""
    length = cutting.PIECE
    if states is None:
        states = files.select(
            "source", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(length).cast("bigint"))).alias("offset"),
            "size",
        )
    # Rows without bytes, dealt out one by one.
    tasks = 4 * states.sparkSession.sparkContext.defaultParallelism
    states = states.repartition(tasks, "source", "offset")
    names = [f"{f.name} {f.dataType.simpleString()}" for f in states.schema]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = tree_files.open_root(prefix)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                name, offset = row.column("source")[0].as_py(), row.column("offset")[0].as_py()
                with fs.open_input_file(f"{base.rstrip('/')}/{name}") as file:
                    data = file.read_at(length, offset)
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([data], pa.binary())], names=[*row.schema.names, "data"])

    return states.mapInArrow(read, ", ".join([*names, "data binary"]))


def content_pieces(files: DataFrame, states: DataFrame | None) -> DataFrame:
    """Pieces of files given with their ``content``."""
    size = F.octet_length("content").cast("bigint")
    offsets = F.sequence(F.lit(0).cast("bigint"), F.greatest(size - 1, F.lit(0)), F.lit(cutting.PIECE).cast("bigint"))
    rows = files.select("source", "content", size.alias("size"), F.explode(offsets).alias("offset")).select(
        "source", "offset", "size", F.substring("content", F.col("offset").cast("int") + 1, F.lit(cutting.PIECE)).alias("data")
    )
    return rows if states is None else states.join(rows.drop("size"), ["source", "offset"])


def large_items(spark: SparkSession, pieces: Callable[[DataFrame | None], DataFrame]) -> DataFrame:
    """Item rows, like those of :func:`explode_items`, of files of any size given in pieces.

    The items of one file are found and checked by many tasks; the file counts only if all of it is strict JSON.
    """
    scratch = shared_folder(spark)
    parts = parts_of(pieces, scratch, 1)
    text, data = F.col("text"), F.col("data")
    elements = elements_of(parts).select("source", "element", "data")
    blank = data.cast("string").rlike(r"\A[ \t\r\n]*\z")
    small = elements.where(F.octet_length("data") < ITEM_BYTES).select(
        "source", "element", F.is_valid_utf8(data.cast("string")).alias("utf8"), blank.alias("blank"),
        F.when(F.is_valid_utf8(data.cast("string")), data.cast("string")).alias("text"),
    )
    value = F.when(is_single_value(text), F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<variant>", STRICT_OPTIONS))
    small = small.withColumn("value", value).select(
        "source", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("head"), F.col("element").alias("pos"), "utf8", "blank",
        (F.size("value") == 1).alias("valid"), F.get("value", F.lit(0)).alias("item"),
    )
    flags = ["utf8", "blank", "valid"]
    rows = _checked(small, flags).unionByName(_huge_items(elements.where(F.octet_length("data") >= ITEM_BYTES)))
    rows = materialise(rows, f"{scratch}/rows")

    # A row per file.
    seen = rows.groupBy("source").agg(
        F.min("utf8").alias("utf8"), F.min(F.coalesce("valid", F.lit(False))).alias("valid"), F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank")
    )
    frame = F.make_valid_utf8(F.col("data").cast("string"))
    status = (
        F.when(~F.is_valid_utf8(F.col("data").cast("string")), "not_utf8").when(~frame.rlike(r"\A[ \t\r\n]*\["), "not_array").when(~frame.rlike(r"\A[ \t\r\n]*\[0\][ \t\r\n]*\z"), "malformed")
        .when(~F.col("utf8"), "not_utf8").when((F.col("n") == 1) & F.col("blank"), "empty").when(~F.col("valid"), "malformed")
        .otherwise("ok")
    )
    judged = materialise(
        frames_of(parts).join(seen, "source", "left")
        .select("source", F.coalesce(status, F.lit("malformed")).alias("status")), f"{scratch}/judged"
    )
    without = judged.where("status <> 'ok'")
    few = without.count() <= FEW_FILES
    kept = rows.drop(*flags).join(F.broadcast(without.select("source")) if few else without.select("source"), "source", "left_anti")
    heads = pieces(without.select("source", F.lit(0).cast("bigint").alias("offset"), F.lit(0).cast("bigint").alias("size")))
    heads = heads.join(F.broadcast(without) if few else without, "source").select(
        "source", "status", F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("string").alias("reason"),
        *[F.lit(None).cast("string").alias(c) for c in ITEM_KEYS[:3]], F.lit(None).cast("array<string>").alias("keywords"),
        F.when(F.col("status") != "empty", F.left(F.make_valid_utf8(F.substring("data", 1, HEAD_BYTES).cast("string")), F.lit(PREVIEW))).alias("raw"),
    )
    return kept.unionByName(heads)


def _huge_items(elements: DataFrame) -> DataFrame:
    """The item rules on items that no variant can hold; one item at a time."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield pa.RecordBatch.from_pylist(
                    [{"source": row["source"], "status": "ok", "pos": row["element"], **huge_item(row["data"])}], schema=schema
                )

    ddl = "source string, status string, pos bigint, reason string, q string, a string, product string, keywords array<string>, raw string, utf8 boolean, blank boolean, valid boolean"
    text = pa.string()
    schema = pa.schema([
        ("source", text), ("status", text), ("pos", pa.int64()), ("reason", text), ("q", text), ("a", text), ("product", text),
        ("keywords", pa.list_(text)), ("raw", text), ("utf8", pa.bool_()), ("blank", pa.bool_()), ("valid", pa.bool_()),
    ])
    return elements.mapInArrow(check, ddl)


def huge_item(data: bytes) -> dict:
    """Fields, reason and flags of one item, as the rules in :func:`explode_items` have them."""
    out = dict.fromkeys(("reason", "q", "a", "product", "keywords", "raw"))
    try:
        text = data.decode("utf-8")
        item = strict_value(text)
    except ValueError as error:
        return {**out, "utf8": not isinstance(error, UnicodeDecodeError), "blank": not data.strip(b" \t\r\n"), "valid": False}

    def clean(value: str) -> str:
        return value.encode("utf-8", "replace").decode()

    fields = item if isinstance(item, dict) else {}
    for key in ITEM_KEYS[:3]:
        value = fields.get(key)
        out[key] = clean(value) if isinstance(value, str) else None
    words = fields.get("keywords")
    if isinstance(words, list):
        out["keywords"] = [w if w is None else clean(w if isinstance(w, str) else json.dumps(w, ensure_ascii=False, separators=(",", ":"))) for w in words]
    if any(fields.get(key) is None and key not in fields for key in ITEM_KEYS):
        out["reason"] = "missing_key" if isinstance(item, dict) else "not_object"
    elif any(not isinstance(fields[key], str) for key in ITEM_KEYS[:3]) or not isinstance(words, list):
        out["reason"] = "wrong_type"
    elif not out["q"].strip() or not out["a"].strip():
        out["reason"] = "blank"
    out["raw"] = clean(json.dumps(item, ensure_ascii=False, separators=(",", ":"), sort_keys=True)[:PREVIEW])
    return {**out, "utf8": True, "blank": False, "valid": True}


def check_items(items: DataFrame) -> DataFrame:
    """Items ``(source, pos, q, a, product, keywords)`` in the form of :func:`explode_items`.

    They come typed, so only missing and blank values can be wrong with them.
    """
    absent = (
        F.col("q").isNull() | F.col("a").isNull() | F.col("product").isNull() | F.col("keywords").isNull()
        | F.col("source").isNull() | F.col("pos").isNull()
    )
    reason = F.when(absent, "missing_key").when(is_blank(F.col("q")) | is_blank(F.col("a")), "blank")
    return items.select(
        "source", F.lit("ok").alias("status"), F.col("pos").cast("bigint").alias("pos"), reason.alias("reason"),
        "q", "a", "product", "keywords",
        F.left(F.to_json(F.struct(*ITEM_KEYS)), F.lit(PREVIEW)).alias("raw"),
    )


def valid_items(exploded: DataFrame) -> DataFrame:
    return exploded.where("pos IS NOT NULL AND reason IS NULL").select(
        "source", "pos", "q", "a", "product", "keywords"
    )


def rejected_items(exploded: DataFrame) -> DataFrame:
    return exploded.where("reason IS NOT NULL").select("source", "pos", "reason", "raw")


def file_errors(exploded: DataFrame) -> DataFrame:
    """Files that were dropped as a whole, with how they start."""
    return exploded.where(F.col("status").isin(*FILE_ERRORS)).select("source", "status", "raw")


def file_stats(exploded: DataFrame) -> DataFrame:
    """Per file: its status and how many items were valid and rejected."""
    # A file has one status; as a second key it keeps the aggregation hashed.
    return exploded.groupBy("source", "status").agg(
        F.count_if(F.col("pos").isNotNull() & F.col("reason").isNull()).alias("valid_items"),
        F.count_if(F.col("reason").isNotNull()).alias("invalid_items"),
    )


def read_qas(spark: SparkSession, root: str, strict: bool = True) -> Corpus:
    """Read and check the corpus below ``root``."""
    exploded = read_exploded(spark, root, strict)
    return Corpus(
        valid_items(exploded), rejected_items(exploded), file_stats(exploded), file_errors(exploded)
    )
