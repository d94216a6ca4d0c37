"""Column expressions. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F

from keelson.spec import HASH_SEPARATOR, CodeMap


def code_label(mapping: CodeMap) -> Column:
    """Label of the group a code belongs to. The groups are a small fixed table, so they are
    an expression rather than a join."""
    code = F.col(mapping.source)
    branches = reduce(
        lambda chain, group: chain.when(code.isin(*group[1]), F.lit(group[0])),
        mapping.groups.items(),
        F,
    )
    return branches.otherwise(F.lit(mapping.default))


def record_hash(columns, null_safe: bool = False, separator: str = HASH_SEPARATOR) -> Column:
    """Change signature over the tracked columns.

    The plain form skips NULL, so a value that moves to the neighbouring column past a NULL,
    or that contains the separator, hashes alike. ``null_safe`` hashes the JSON array of the
    values instead, where both cases differ. Changing the form makes every stored row look
    changed, so choose once per table.
    """
    if null_safe:
        return F.md5(F.to_json(F.array(*columns)))
    return F.md5(F.concat_ws(separator, *columns))


def surrogate_key(business_key: str) -> Column:
    return F.sha2(F.col(business_key), 256)


def file_path(encoded: Column) -> Column:
    """Plain text of a file path as Spark reports it. Paths come percent-encoded; ``url_decode``
    would also turn a plus sign into a space, so plus signs are encoded first. A scheme without
    a host is written with one slash in file metadata and with three in file listings."""
    plain = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([a-zA-Z0-9+.-]+):///", "$1:/")


def plain_path(encoded: str) -> str:
    """``file_path`` for a path held by the driver."""
    return re.sub("^([a-zA-Z0-9+.-]+):///", r"\1:/", unquote(encoded))


def bucket_of(key: str | Column, buckets: int) -> Column:
    """Bucket by the hash Spark shuffles on, so rows shuffled by key are already grouped by
    bucket when the number of shuffle partitions is a multiple of ``buckets``."""
    return F.pmod(F.hash(key), F.lit(buckets))


class _SetDigest:
    """Digest of a set with repeats that can be summed in parts: the sums of both halves of
    each value's MD5. Equal for equal rows in any order; NULL counts as a value of its own."""

    NAMES = ("_digest_high", "_digest_low")

    def sums(self, value: Column) -> dict[str, Column]:
        hashed = F.md5(F.coalesce(F.concat(F.lit("v"), value), F.lit("")))
        halves = (F.substring(hashed, 1, 16), F.substring(hashed, 17, 16))
        number = "decimal(20,0)"
        return {n: F.sum(F.conv(half, 16, 10).cast(number)) for n, half in zip(self.NAMES, halves)}

    def text(self, sums: dict[str, Column]) -> Column:
        return F.concat_ws("-", *(s.cast("string") for s in sums.values()))

    def __call__(self, value: Column) -> Column:
        return self.text(self.sums(value))


set_digest = _SetDigest()
