"""From pairs of classes back to pairs of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.sources.staging import stage

#: Classes of more exact copies than this are given by membership: every copy is paired with the class's first record,
#: which stands for them in pairs with other classes. No link between different texts is lost; `membership` has the classes, None lists all pairs.
MOST_COPIES = 1000


def membership(members: DataFrame) -> DataFrame:
    """(field, cls, representative, n, id): every record of every class with the class's first record and its number of records.

    With the pairs of representatives (`representatives`) it says the same as all pairs of records, in a row a record.
    """
    members = members.select("field", "cls", "id").distinct()
    sizes = members.groupBy("cls").agg(F.min("id").alias("representative"), F.count("*").alias("n"))
    return members.join(sizes, "cls").select("field", "cls", "representative", "n", "id")


def representatives(members: DataFrame, alike: DataFrame) -> DataFrame:
    """(field, doc_a, doc_b, n_a, n_b): pairs of different classes by their first records, with the numbers of their records."""
    sizes = stage(members.groupBy("field", "cls").agg(F.min("id").alias("doc"), F.countDistinct("id").alias("n")), "copies-sizes")
    one = lambda x: sizes.select(F.col("cls").alias(f"cls_{x}"), F.col("doc").alias(f"doc_{x}"), F.col("n").alias(f"n_{x}"))
    return alike.select("field", "cls_a", "cls_b").distinct().join(one("a"), "cls_a").join(one("b"), "cls_b").select("field", "doc_a", "doc_b", "n_a", "n_b")


def expand(members: DataFrame, alike: DataFrame, most: int | None = MOST_COPIES) -> DataFrame:
    """(field, doc_a, doc_b), doc_a < doc_b, from members (field, id, cls) and pairs of classes (cls_a, cls_b).

    A record in several classes is never paired with itself; each pair comes once. most: classes of more records are given
    by membership; None lists all pairs of any class.
    """
    members = members.select("field", "id", "cls").distinct()
    sizes = members.groupBy("cls").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    known = members.join(sizes, "cls")
    all_ = F.lit(True) if most is None else F.col("n") <= most
    active = known.filter(all_ | (F.col("id") == F.col("first"))).select("field", "cls", "id")
    across = alike.select("cls_a", "cls_b").join(active.toDF("field", "cls_a", "a"), "cls_a").join(active.select(F.col("cls").alias("cls_b"), F.col("id").alias("b")), "cls_b").select("field", "a", "b")
    few = known.filter((F.col("n") > 1) & all_).select("field", "cls", "id")
    pairs = across.unionByName(few.withColumnRenamed("id", "a").join(few.select("cls", F.col("id").alias("b")), "cls").filter("a < b").select("field", "a", "b"))
    if most is not None:
        pairs = pairs.unionByName(known.filter((F.col("n") > most) & (F.col("id") != F.col("first"))).select("field", F.col("first").alias("a"), F.col("id").alias("b")))
    return pairs.filter("a <> b").select("field", F.least("a", "b").alias("doc_a"), F.greatest("a", "b").alias("doc_b")).distinct()


def _field(members: DataFrame, alike: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records with the set of their classes, sets that are alike, records alike to those of a set, themselves among them)."""
    sets = members.filter("id IS NOT NULL").groupBy("id").agg(F.array_sort(F.collect_set("cls")).alias(f"s{k}"))
    sizes = sets.groupBy(f"s{k}").agg(F.count("*").alias("n"))
    of = sizes.select(F.col(f"s{k}").alias("s"), F.explode(f"s{k}").alias("c"))
    pairs = alike.select(F.col("cls_a").alias("c"), F.col("cls_b").alias("d"))
    pairs = pairs.unionByName(pairs.select(F.col("d").alias("c"), F.col("c").alias("d"))).unionByName(of.select("c", F.col("c").alias("d")))
    near = stage(of.join(pairs.distinct(), "c").join(of.toDF("t", "d"), "d").select(F.col("s").alias(f"s{k}"), F.col("t").alias(f"t{k}")).distinct(), "copies-near")
    return sets, near, near.join(sizes.withColumnRenamed(f"s{k}", f"t{k}"), f"t{k}").groupBy(f"s{k}").agg(F.sum("n").alias(f"n{k}"))


def links(first: tuple[DataFrame, DataFrame], second: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(id, n_links): how many other records a record is alike to in either of two fields, each given as for expand().

    Counted over sets of classes; copies aren't paired, so any number of them counts in full. Those alike in both fields count once.
    """
    sets0, near0, count0 = _field(*first, 0)
    sets1, near1, count1 = _field(*second, 1)
    records = stage(sets0.join(sets1, "id", "full"), "copies-sets")
    both = records.filter("s0 IS NOT NULL AND s1 IS NOT NULL").groupBy("s0", "s1").agg(F.count("*").alias("n"))
    twice = both.select("s0", "s1").join(near0, "s0").join(near1, "s1").join(both.toDF("t0", "t1", "n"), ["t0", "t1"]).groupBy("s0", "s1").agg(F.sum("n").alias("n2"))
    counted = records.join(count0, "s0", "left").join(count1, "s1", "left").join(twice, ["s0", "s1"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return counted.select("id", (zero("n0") + zero("n1") - zero("n2") - 1).alias("n_links"))
