"""Deterministic ids and change hashes as native expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.options import CHANGE_KEYS, POINT_NAMESPACE, check_choice


def uuid5(name: Column, namespace: str = POINT_NAMESPACE) -> Column:
    """RFC 4122 version 5 UUID text of ``name`` inside ``namespace``."""
    prefix = F.lit(bytearray(uuid.UUID(namespace).bytes))
    digest = F.sha1(F.concat(prefix, name.cast("binary")))
    # The variant nibble keeps its two low bits and gets the high bits 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def point_id(question: Column, source: Column, namespace: str = POINT_NAMESPACE) -> Column:
    """Id of a question in a source; back slashes in the source count as slashes."""
    path = F.translate(source, "\\", "/")
    return uuid5(F.concat(F.lit("question:"), question, F.lit("|source:"), path), namespace)


def text_hash(text: Column) -> Column:
    """SHA-256 hex digest of the UTF-8 bytes."""
    return F.sha2(text, 256)


def content_hash(question: Column, answer: Column, product: Column, keywords: Column) -> Column:
    """SHA-256 over the hashes of all four fields, so no separator can be forged."""
    words = F.array_join(F.transform(keywords, lambda k: F.sha2(F.coalesce(k, F.lit("")), 256)), "")
    return F.sha2(
        F.concat(text_hash(question), text_hash(answer), text_hash(product), F.sha2(words, 256)), 256
    )


def with_identity(
    items: DataFrame, namespace: str = POINT_NAMESPACE, change_key: str = "question"
) -> DataFrame:
    """Add ``point_id`` and ``question_hash`` to items ``(source, q, ...)``.

    ``change_key="question"`` hashes the question alone, so a changed answer goes
    unnoticed; ``"content"`` covers question, answer, product and keywords.
    """
    check_choice("change_key", change_key, CHANGE_KEYS)
    if change_key == "content":
        digest = content_hash(F.col("q"), F.col("a"), F.col("product"), F.col("keywords"))
    else:
        digest = text_hash(F.col("q"))
    return items.withColumns(
        {"point_id": point_id(F.col("q"), F.col("source"), namespace), "question_hash": digest}
    )
