"""Exact duplicates of files and the layout that keeps one copy of each.

An inventory has (hash, path, ord): ord is the order of the rows; a null hash is a file that couldn't be read. Empty
inventories give empty results and summaries of zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import paths

# The script that makes hard links on Windows.
LINK_COMMAND = 'Push-Location "%s"; New-Item -ItemType HardLink -Path "%s" -Target "%s" -Force; Pop-Location'


def digest(content: Column | str) -> Column:
    return F.md5(content)


def readable(inventory: DataFrame) -> DataFrame:
    return inventory.filter(F.col("hash").isNotNull()).select("hash", "path", "ord")


def sizes(inventory: DataFrame) -> DataFrame:
    """(hash, n, first_ord, keeper): the keeper is the first path without a number at its end, else the one with the least.

    Only partial aggregates are shuffled, so one hash may hold any share of the rows.
    """
    number = paths.numeric_suffix("path")
    rank = F.struct(number.isNotNull().alias("numbered"), F.coalesce(number, F.lit(0)).alias("number"), "ord", "path")
    return readable(inventory).groupBy("hash").agg(F.count("*").alias("n"), F.min("ord").alias("first_ord"), F.min(rank).alias("best")).select("hash", "n", "first_ord", F.col("best.path").alias("keeper"))


def report(inventory: DataFrame) -> DataFrame:
    """(hash, n, first_ord, path, ord) of hashes with more than one path, one row per path: a hash may have any number of them."""
    return readable(inventory).join(sizes(inventory).filter("n > 1").select("hash", "n", "first_ord"), "hash")


def export_order(inventory: DataFrame) -> DataFrame:
    """(hash, path, row_no): rows grouped by hash in the order hashes are first seen, as a hash table is written."""
    first = sizes(inventory).select("hash", "first_ord")
    return readable(inventory).join(first, "hash")


def summary(inventory: DataFrame) -> DataFrame:
    """(total, distinct_hashes, no_duplicate, has_duplicate); unreadable files count as having one, as the total holds them."""
    per = readable(inventory).groupBy("hash").agg(F.count("*").alias("n")).agg(F.count("*").alias("distinct_hashes"), F.count_if(F.col("n") == 1).alias("no_duplicate"))
    total = inventory.agg(F.count("*").alias("total"))
    return total.crossJoin(per).select("total", "distinct_hashes", "no_duplicate", (F.col("total") - F.col("no_duplicate")).alias("has_duplicate"))  # one row each


def absent(files: DataFrame, inventory: DataFrame) -> DataFrame:
    """Files (path) that the inventory doesn't list with a hash; multiplicity is kept."""
    return files.select("path").join(readable(inventory).select("path").distinct(), "path", "left_anti")


def plan(inventory: DataFrame, files: DataFrame, root: str, out: str) -> DataFrame:
    """(action, src, dest, target, command, first_ord, ord): copies of unique, unlisted and kept files, links for the rest.

    A path outside of `root` has a null dest; its row stays, so it can be counted as an error. A keeper listed twice is not linked to itself.
    """
    rows = readable(inventory).join(sizes(inventory), "hash")
    to = lambda c: paths.reroot(c, root, out)
    none = F.lit(None).cast("string")
    unique = rows.filter("n = 1").select(F.lit("copy").alias("action"), F.col("path").alias("src"))
    kept = sizes(inventory).filter("n > 1").select(F.lit("copy_keeper").alias("action"), F.col("keeper").alias("src"))
    loose = absent(files, inventory).select(F.lit("copy_unlisted").alias("action"), F.col("path").alias("src"))
    copies = unique.unionByName(kept).unionByName(loose).select("action", "src", to("src").alias("dest"), none.alias("target"), none.alias("command"))
    links = rows.filter("n > 1 AND path <> keeper").select("first_ord", "ord", F.lit("link").alias("action"), F.col("path").alias("src"), to("path").alias("dest"), to("keeper").alias("kept"))
    links = links.withColumn("target", paths.relative("kept", paths.parent("dest")))
    inner = paths.reroot("dest", out, "")
    command = F.format_string(LINK_COMMAND, paths.windows(paths.parent(inner)), paths.name("dest"), paths.windows("target"))
    return copies.unionByName(links.select("action", "src", "dest", "target", F.when(F.col("dest").isNotNull(), command).alias("command"), "first_ord", "ord"), allowMissingColumns=True)


def plan_summary(planned: DataFrame) -> DataFrame:
    """(unique_files, groups, files_in_groups, links, errors)."""
    n = lambda *a: F.count_if(F.col("action").isin(*a))
    return planned.agg(n("copy", "copy_unlisted").alias("unique_files"), n("copy_keeper").alias("groups"), n("copy_keeper", "link").alias("files_in_groups"), n("link").alias("links"), F.count_if(F.col("dest").isNull()).alias("errors"))
