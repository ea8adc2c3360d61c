"""Identifiers that follow from content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the URL namespace of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The version 5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1), F.lit(1))
    return F.concat(F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12))


def point_id(subject: Column, level: Column, text: Column) -> Column:
    """The identity of a chunk: the same subject, level and text always give the same point."""
    return uuid5(F.sha2(F.concat(subject, F.lit(":"), level, F.lit(":"), text), 256))


def short_digest(url: Column) -> Column:
    return F.substring(F.sha2(url, 256), 1, 16)
