"""Scalar functions on times, cue texts and paths (whole expressions; nothing here runs Python on rows)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters that Unicode counts as white space; Java's plain \s stops at ASCII.
UNICODE_SPACE = r"(?U)[\s\x1c-\x1f]+"
SPACE_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
#: Fixed value: what stands for a line end while a text is translated.
LINE_MARK = " __COPILOT_LINEBREAK__ "


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is computed once although use names it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def milliseconds(seconds: Column) -> Column:
    """Seconds as whole milliseconds, halves to even, never below 0; NaN raises."""
    return F.greatest(F.lit(0).cast("bigint"), F.rint(seconds * 1000).cast("bigint"))


def srt_time(seconds: Column) -> Column:
    """HH:MM:SS,mmm with as many digits for hours as needed."""
    ms = milliseconds(seconds)
    div = lambda a, b: F.floor(a / b)  # noqa: E731  exact below 2**53 ms
    return F.format_string("%02d:%02d:%02d,%03d", div(ms, 3_600_000), div(ms, 60_000) % 60, div(ms, 1000) % 60, ms % 1000)


def srt_milliseconds(time: Column) -> Column:
    """The milliseconds that a rendered time stands for; null if it is not one."""

    def read(parts: Column) -> Column:
        part = lambda k, digits: F.when(F.length(F.get(parts, F.lit(k))) == digits, F.get(parts, F.lit(k))).try_cast("bigint")
        hours = F.get(parts, F.lit(0)).try_cast("bigint")
        return F.when(F.size(parts) == 4, hours * 3_600_000 + part(1, 2) * 60_000 + part(2, 2) * 1000 + part(3, 3))

    return let(F.split(F.trim(time), "[:,.]"), read)


def collapsed(text: Column) -> Column:
    """Runs of Unicode white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, UNICODE_SPACE, " "))


def stripped(text: Column) -> Column:
    """Without Unicode white space at the ends."""
    return F.btrim(text, F.lit(SPACE_CHARACTERS))


def blank(text: Column) -> Column:
    return stripped(text) == ""


def marked(text: Column) -> Column:
    """Line ends as LINE_MARK, stripped; a blank text as it was."""
    flat = stripped(F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\n"), F.lit(LINE_MARK)))
    return let(flat, lambda x: F.when(x == "", text).otherwise(x))


def unmarked(text: Column) -> Column:
    """LINE_MARK as line ends again, stripped."""
    return stripped(F.replace(text, F.lit(LINE_MARK), F.lit("\n")))


def setting(value: Column, default) -> Column:
    """An environment setting: unset and empty mean the default."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def flag(value: Column) -> Column:
    """A switch is on only at "1"."""
    return F.coalesce(value == "1", F.lit(False))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/?#]*)/?(?:[?#].*)?$", 1)


def stem(path: Column) -> Column:
    """The file name without its last extension."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def padded(index: Column, prefix: str, suffix: str) -> Column:
    """A chunk's file name: four digits at least, never fewer than the index has."""
    return F.format_string(prefix + "%04d" + suffix, index)


def container_path(path: Column, root: str) -> Column:
    """A host path as seen in the container: the root itself, what lies below it, or the path unchanged below the mount."""
    return F.when(path == root, F.lit("/workspace")).otherwise(F.concat(F.lit("/workspace/"), F.when(F.startswith(path, F.lit(root + "/")), F.substring(path, F.lit(len(root) + 2), F.length(path))).otherwise(path)))


def one_decimal(x: Column) -> Column:
    """A number of at least 0 with one decimal, halves to even."""
    tenths = F.rint(x * 10).cast("bigint")
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"))


def minutes_text(seconds: Column) -> Column:
    return F.concat(one_decimal(seconds / 60), F.lit(" min"))


def gigabytes_text(size: Column) -> Column:
    return F.concat(one_decimal(size / F.lit(float(1 << 30))), F.lit(" GB"))


def ratio(text: Column) -> Column:
    """The quotient that a text such as 30000/1001 stands for; null if it is none or its divisor is 0."""
    part = lambda k: F.split_part(text, F.lit("/"), F.lit(k)).try_cast("double")
    return F.when(F.contains(text, F.lit("/")), part(1) / F.nullif(part(2), F.lit(0.0))).otherwise(text.try_cast("double"))
