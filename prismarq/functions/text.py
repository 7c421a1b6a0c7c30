"""Scalar functions on names, labels, captions and versions, as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File name suffixes of images, compared in lower case.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tiff", ".tif")
#: White space of Python's ``str.isspace``; Java's Unicode class lacks 0x1c to 0x1f.
WHITE = r"(?U)[\s\x{1c}-\x{1f}]+"

# What messages of passing network errors contain, in lower case.
PASSING = ("connection reset", "connection abort", "broken pipe", "timed out", "timeout", "errno 104", "errno 110", "errno 32")


def suffix(path: Column) -> Column:
    """Last suffix of a path in lower case, with its dot; empty if none."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)$", 1))


def is_image(path: Column) -> Column:
    return suffix(path).isin(*IMAGE_SUFFIXES)


def image_id(relative: Column) -> Column:
    """Relative path without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(relative, r"(?<=[^/])\.[^./]+$", "")


def output_dir(base: Column, image: Column) -> Column:
    return F.concat_ws("/", base, image)


def parent_dir(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def components(path: Column) -> Column:
    """Path components; ordering by them puts ``a/b`` before ``a-b/c``."""
    return F.split(path, "/")


def single_paragraph(text: Column) -> Column:
    """White space runs as one space, trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "))


def strip(text: Column) -> Column:
    """Text without white space at both ends."""
    return F.regexp_replace(text, rf"^{WHITE}|(?U)[\s\x{{1c}}-\x{{1f}}]+\z", "")


def range_label(start: Column, end: Column) -> Column:
    """``00000-00999``; longer numbers are not cut."""
    return F.format_string("%05d-%05d", start, end)


def parse_range_label(name: Column) -> Column:
    """Struct (start, end) of a file name ``<digits>-<digits>.<anything>``, else null."""
    part = lambda i: F.regexp_extract(name, r"^(\d+)-(\d+)\.", i).try_cast("bigint")
    return F.when(part(1).isNotNull() & part(2).isNotNull(), F.struct(part(1).alias("start"), part(2).alias("end")))


def bump_version(version: Column) -> Column:
    """Patch number one higher; padded with zeros to three parts, further parts dropped."""
    parts = F.slice(F.concat(F.transform(F.split(version, r"\."), lambda p: p.cast("bigint")), F.lit([0, 0, 0]).cast("array<bigint>")), 1, 3)
    return F.concat_ws(".", F.get(parts, F.lit(0)).cast("string"), F.get(parts, F.lit(1)).cast("string"), (F.get(parts, F.lit(2)) + 1).cast("string"))


def human_size(n: Column) -> Column:
    """Bytes in units of 1024: whole bytes, else one decimal, up to TB."""
    out = F.format_string("%.1f TB", n / F.lit(1024.0**4))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB")):
        out = F.when(n < 1024 ** (power + 1), F.format_string(f"%.1f {unit}", n / F.lit(1024.0**power))).otherwise(out)
    return F.when(n < 1024, F.format_string("%d B", n)).otherwise(out)


def human_bytes(n: int) -> str:
    """``human_size`` of a plain number."""
    if n < 1024:
        return f"{n} B"
    power = next((p for p in (1, 2, 3) if n < 1024 ** (p + 1)), 4)
    return f"{n / 1024.0**power:.1f} {('KB', 'MB', 'GB', 'TB')[power - 1]}"


def megabytes(mb: Column) -> Column:
    """Bytes of decimal megabytes."""
    return (mb * 1_000_000).cast("bigint")


def preview(text: Column, n: int = 120) -> Column:
    """First ``n`` characters, with dots if there are more."""
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def percent(part: Column, total: Column) -> Column:
    """Share in percent to one decimal; 0 of nothing."""
    return F.when(total > 0, F.round(100.0 * part / total, 1)).otherwise(F.lit(0.0))


def issue_name(issue: Column) -> Column:
    return F.trim(F.split_part(issue, F.lit(":"), F.lit(1)))


def slug(name: Column) -> Column:
    """Lower-case name before the first bracket, with spaces and hyphens as underscores."""
    return F.regexp_replace(F.lower(F.trim(F.split_part(name, F.lit("("), F.lit(1)))), "[ -]", "_")


def safe_repo(repo: Column) -> Column:
    return F.replace(repo, F.lit("/"), F.lit("--"))


def error_class(message: Column) -> Column:
    """rate_limited, transient or fatal, by the message of an error."""
    low = F.lower(F.coalesce(message, F.lit("")))
    passing = F.lit(False)
    for needle in PASSING:
        passing = passing | F.contains(low, F.lit(needle))
    return F.when(F.contains(low, F.lit("429")), "rate_limited").when(passing, "transient").otherwise("fatal")
