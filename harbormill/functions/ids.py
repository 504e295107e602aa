"""Deterministic identifiers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid5(name: Column, namespace: uuid.UUID) -> Column:
    """Name-based UUID, version 5, equal to ``uuid.uuid5`` but computed in the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    # the variant nibble keeps its two low bits and gets the high bits 10
    nibble = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex((nibble % 4 + 8).cast("bigint")))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
