"""Column functions over slash-separated paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def parent(path: Column | str) -> Column:
    """Everything before the last slash; empty without one."""
    return F.regexp_replace(col(path), r"/?[^/]*\z", "")


def stem(path: Column | str) -> Column:
    """The name without its last extension; a leading dot starts no extension."""
    return F.regexp_replace(name(path), r"(?<=.)\.[^.]*\z", "")


def species(path: Column | str) -> Column:
    """The name of the folder a file lies in."""
    return name(parent(path))


def numeric_suffix(path: Column | str) -> Column:
    """The number behind the last underscore of the stem, or null; a year counts."""
    digits = F.regexp_extract(stem(path), r"_(\p{Nd}+)\z", 1)
    return F.nullif(digits, F.lit("")).cast("decimal(38,0)")


def windows(path: Column | str) -> Column:
    return F.translate(col(path), "/", "\\")


def reroot(path: Column | str, root: str, out: str) -> Column:
    """The same path below another root; null outside of `root`."""
    r, o = (x.rstrip("/") + "/" if x else "" for x in (root, out))
    return F.when(F.startswith(col(path), F.lit(r)), F.concat(F.lit(o), F.substring(col(path), F.lit(len(r) + 1), F.length(col(path)))))


def relative(target: Column | str, start: Column | str) -> Column:
    """`target` as seen from the folder `start`; `.` for the folder itself."""
    split = lambda c: F.filter(F.split(col(c), "/"), lambda x: x != "")
    t, s = split(target), split(start)
    least = F.least(F.size(t), F.size(s))
    same = F.transform(F.sequence(F.lit(0), least), lambda i: F.when(F.slice(t, F.lit(1), i) == F.slice(s, F.lit(1), i), i).otherwise(0))
    common = F.array_max(same)
    parts = F.concat(F.array_repeat(F.lit(".."), F.size(s) - common), F.slice(t, common + 1, F.size(t)))
    return F.coalesce(F.nullif(F.array_join(parts, "/"), F.lit("")), F.lit("."))


def order(path: Column | str) -> Column:
    """Sorts paths part by part: `a/x` stands before `a-b/x`."""
    return F.split(col(path), "/")
