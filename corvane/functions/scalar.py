"""Scalar expressions. All are built-in columns, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp01(x: Column) -> Column:
    """x within [0, 1]; NaN gives 1, null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def normalise(x: Column, size: Column) -> Column:
    return F.when(size <= 0, F.lit(0.0)).otherwise(clamp01(x / size))


def round_half_even(x: Column) -> Column:
    return F.rint(x.cast("double")).cast("long")


def numbers(tokens: Column) -> Column:
    """Tokens as doubles, null where one is not a number."""
    return F.transform(tokens, lambda t: t.try_cast("double"))


def tokens(line: Column) -> Column:
    trimmed = F.trim(F.regexp_replace(line, r"\s+", " "))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)).cast("int")


def hex_to_long(h: Column) -> Column:
    """Up to 16 hexadecimal digits as a 64-bit integer in two's complement."""
    return F.conv(h, 16, -10).cast("long")


def long_to_hex(x: Column, digits: int = 16) -> Column:
    return F.lower(F.lpad(F.hex(x), digits, "0"))


def difference_hash(values: Column, bits: int = 64, width: int = 8) -> Column:
    """Bits of rows of `width`: left value greater than its right neighbour; rows have width + 1 values; first bit highest."""

    def bit(acc: Column, i: Column) -> Column:
        at = F.floor(i / width).cast("int") * (width + 1) + i % width
        return F.shiftleft(acc, 1).bitwiseOR(F.when(F.get(values, at) > F.get(values, at + 1), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("long"), bit)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, r"^(.*)/[^/]*$", 1)).otherwise(F.lit(""))


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(basename(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    name = basename(path)
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)).otherwise(name)


def clean_path(path: Column) -> Column:
    return F.ltrim(F.replace(path, F.lit("\\"), F.lit("/")), F.lit("/"))


def split_from_path(path: Column) -> Column:
    """The last part of a path that names a split."""
    return F.get(F.filter(F.reverse(F.split(F.lower(path), "/")), lambda p: p.isin("train", "valid", "test")), F.lit(0))


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def group_from_name(name: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^g(\d{2})", 1), F.lit("")), F.lit("unknown"))


def has_group_prefix(name: Column, grp: Column) -> Column:
    return F.startswith(name, F.concat(F.lit("g"), grp, F.lit("_")))


def source_stem(name: Column) -> Column:
    return F.nullif(F.regexp_extract(name, r"^(g\d{2}_\d{6})", 1), F.lit(""))


def source_key(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


def stable_stem(grp: Column, index: Column) -> Column:
    return F.format_string("g%s_%06d", grp, index)


def strip_bom(text: Column) -> Column:
    return F.regexp_replace(text, "^﻿", "")


def fixed(x: Column, digits: int = 6) -> Column:
    """x (0 or more, below 2 ** 26) as text with so many digits after the point (6 at most), rounded half to even on the exact binary value.

    The value is cut into three whole numbers of 26 and 27 bits, all exact, and put together as one decimal in units of 2 ** -80.
    """
    if not 0 < digits <= 6:
        raise ValueError("1 to 6 digits")
    whole = lambda v: F.floor(v).cast("decimal(38,0)")
    one = F.floor(x).cast("double")
    two = (x - one) * float(1 << 27)
    three = (two - F.floor(two).cast("double")) * float(1 << 27)
    four = (three - F.floor(three).cast("double")) * float(1 << 26)
    power = lambda n: F.lit(1 << n).cast("decimal(38,0)")
    scale, unit = F.lit(10**digits).cast("decimal(10,0)"), F.lit(str(1 << 80)).cast("decimal(25,0)")
    below = (whole(two).cast("decimal(10,0)") * power(53).cast("decimal(16,0)") + whole(three).cast("decimal(10,0)") * power(26).cast("decimal(8,0)")).cast("decimal(27,0)") + whole(four).cast("decimal(9,0)")
    part = (below.cast("decimal(25,0)") * scale).cast("decimal(33,0)")
    rest = part % unit
    kept = ((part - rest) / unit).cast("decimal(10,0)")
    twice = rest * F.lit(2).cast("decimal(1,0)")
    up = (twice > unit) | ((twice == unit) & (kept % 2 == 1))
    all_ = (one.cast("decimal(10,0)") * scale + kept + F.when(up, 1).otherwise(0)).cast("bigint")
    return F.concat(F.floor(all_ / 10**digits).cast("string"), F.lit("."), F.lpad((all_ % 10**digits).cast("string"), digits, "0"))


def percent(x: Column, digits: int = 2) -> Column:
    """A share as text in per cent."""
    return F.concat(fixed(x * 100, digits), F.lit("%"))
