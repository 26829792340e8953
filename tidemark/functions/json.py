"""Strictness that Spark's JSON readers leave out."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT_OPTIONS = {"allowSingleQuotes": "false", "maxStringLen": "2147483647"}


def is_single_value(text: Column) -> Column:
    """True when ``text`` is one JSON value with nothing behind it.

    Spark's JSON readers stop after the first value. Wrapped in an array, text
    behind the value can only go unnoticed if it starts with a closing bracket;
    wrapped in an object, only if it starts with a closing brace. The cheap token
    counters come first; the fallback serves files with NaN or Infinity, which
    the counters refuse.
    """
    in_array = F.concat(F.lit("["), text, F.lit("]"))
    in_object = F.concat(F.lit('{"d":'), text, F.lit("}"))
    items = F.coalesce(
        F.json_array_length(in_array), F.size(F.from_json(in_array, "array<string>", STRICT_OPTIONS))
    )
    keys = F.coalesce(
        F.size(F.json_object_keys(in_object)),
        F.size(F.map_keys(F.from_json(in_object, "map<string,string>", STRICT_OPTIONS))),
    )
    return F.coalesce((items == 1) & (keys == 1), F.lit(False))


def strict_value(text: str):
    """The value of one JSON text by the same rules, for text that no Spark value can hold parsed; else ``ValueError``."""
    return json.loads(text.strip(" \t\r\n"))
