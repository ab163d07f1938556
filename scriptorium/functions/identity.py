"""Content-derived identifiers (FN-01, FN-02, FN-04) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name spaces of the version-5 identifiers.
AUTHOR = "f8e4a56a-5f5f-4c4e-8f2e-6d91ce1fb33e"
WORK = "09f2c7d1-4a2a-4f48-b0fd-7d3719f93a0c"
EDITION = "1a7c3a40-6b3b-4bdb-a0b2-c2a15c66411a"


def strip(text: Column) -> Column:
    """Surrounding Unicode white space removed."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version 5 of a stripped name: SHA-1 with version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(strip(name), "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def author_id(name: Column) -> Column:
    return uuid5(AUTHOR, name)


def work_id(author: Column, title: Column) -> Column:
    return uuid5(WORK, F.concat(author, F.lit(":"), strip(title)))


def edition_id(work: Column, language: Column, url: Column) -> Column:
    return uuid5(EDITION, F.concat(work, F.lit(":"), strip(language), F.lit(":"), strip(url)))


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def group_hash(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, "|"), 256)


def uuid5_sql(namespace: str, expression: str) -> str:
    """DuckDB text of uuid5."""
    h = f"sha1(unhex('{namespace.replace('-', '')}') || encode({expression}))"
    return f"concat({h}[1:8], '-', {h}[9:12], '-5', {h}[14:16], '-', translate({h}[17], '0123456789abcdef', '89ab89ab89ab89ab'), {h}[18:20], '-', {h}[21:32])"
