"""String helpers with the split and hash rules the jobs rely on."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extensions that mark a request as a static resource.
STATIC_EXTENSIONS = ("css", "js", "png", "ico")


def split_parts(col: Column, sep: str) -> Column:
    """Split on a literal separator, keeping inner empty parts and dropping trailing ones.

    An empty input is one empty part; an input of separators only has no parts.
    """
    quoted = "(?:" + re.escape(sep) + ")"
    trimmed = F.rtrim(col) if sep == " " else F.regexp_replace(col, quoted + "+$", "")
    return (
        F.when(col == "", F.array(F.lit("")))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, quoted))
    )


def string_hash(col: Column) -> Column:
    """31-based 32-bit wrapping hash of a string's UTF-16 units, as a signed bigint."""
    units = F.regexp_extract_all(F.hex(F.encode(col, "UTF-16BE")), F.lit("(....)"), 1)
    wrapped = F.aggregate(
        units,
        F.lit(0).cast("bigint"),
        lambda acc, unit: (acc * 31 + F.conv(unit, 16, 10).cast("bigint")).bitwiseAND(F.lit(0xFFFFFFFF)),
    )
    return F.when(wrapped >= F.lit(1 << 31), wrapped - F.lit(1 << 32)).otherwise(wrapped)


def hash_code(col: Column, factor: int = 23) -> Column:
    return string_hash(col) * F.lit(factor).cast("bigint")


def bitmap_slot(col: Column, bits: int = 29, seed: int = 61) -> Column:
    """Slot of an id in a bitmap of 2**bits cells. Masking at each step equals masking once at the end."""
    mask = F.lit((1 << bits) - 1)
    codes = F.filter(F.split(col.cast("string"), ""), lambda ch: ch != "")
    return F.aggregate(
        codes, F.lit(0).cast("bigint"), lambda acc, ch: (acc * seed + F.ascii(ch)).bitwiseAND(mask)
    )


def is_page_request(method: Column, url: Column) -> Column:
    return (method == "GET") & ~url.rlike(r"\.(" + "|".join(STATIC_EXTENSIONS) + r")$")
