"""Tables and pictures of structured documents, and the chunks built from their items.

Items: (doc_id, item_ord, item_type, self_ref, label, text, caption, page_nos array<int>).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import text

FIGURES = "array<struct<caption:string,picture_ref:string,image_file:string>>"
TABLES = "array<struct<caption:string,csv_file:string>>"


def of_type(items: DataFrame, kind: str) -> DataFrame:
    """Items of one type with ordinal, counted from 1 over all of that type in a document."""
    return items.filter(F.col("item_type") == kind).withColumn("ordinal", F.row_number().over(W.partitionBy("doc_id").orderBy("item_ord")))


def table_files(items: DataFrame, folder: str = "tables") -> DataFrame:
    """(doc_id, self_ref, ordinal, caption, page_number, slug, csv_file) of every table, whether or not its export succeeds."""
    slug = text.slug_or("caption", "table", "ordinal")
    return of_type(items, "TableItem").select(
        "doc_id", "self_ref", "ordinal", F.coalesce("caption", F.lit("")).alias("caption"), F.get(text.sorted_pages("page_nos"), F.lit(0)).alias("page_number"),
        slug.alias("slug"), F.concat(F.lit(folder + "/"), slug, F.lit(".csv")).alias("csv_file"))


def written(files: DataFrame) -> DataFrame:
    """What stands in each file in the end: of those with one name the last."""
    return files.groupBy("doc_id", "slug").agg(F.max_by(F.struct("ordinal", "self_ref", "caption", "page_number"), "ordinal").alias("x"), F.count("*").alias("writers")).select("doc_id", "slug", "writers", "x.*")


def picture_files(items: DataFrame, folder: str = "images") -> DataFrame:
    """(doc_id, picture_ref, ordinal, caption, page_number, slug, image_file, meta_path) of every picture."""
    slug = text.slug_or("caption", "figure", "ordinal")
    return of_type(items, "PictureItem").select(
        "doc_id", F.col("self_ref").alias("picture_ref"), "ordinal", F.coalesce("caption", F.lit("")).alias("caption"), F.get(text.sorted_pages("page_nos"), F.lit(0)).alias("page_number"),
        slug.alias("slug"), F.concat(F.lit(folder + "/"), slug, F.lit(".png")).alias("image_file"), F.concat(F.lit(folder + "/"), slug, F.lit("_meta.json")).alias("meta_path"))


def captions(items: DataFrame) -> DataFrame:
    """(doc_id, caption, picture_ref, pos): of pictures with one caption the last is meant, in the place of the first."""
    rows = items.filter(F.col("item_type") == "PictureItem").filter(F.coalesce("caption", F.lit("")) != "")
    return rows.groupBy("doc_id", "caption").agg(F.max_by("self_ref", "item_ord").alias("picture_ref"), F.min("item_ord").alias("pos"))


def build_chunks(placed: DataFrame, items: DataFrame, folder: str = "tables") -> DataFrame:
    """Chunks with pages, figures and tables from (doc_id, chunk_idx, chunk_text, headings, item_ord): which items a chunker put where.

    Pictures and caption texts that name one share the figures; a reference counts once a chunk, the first time.
    """
    own = placed.select("doc_id", "chunk_idx", "item_ord").join(items, ["doc_id", "item_ord"])
    pictures = own.filter("item_type = 'PictureItem'").select("doc_id", "chunk_idx", "item_ord", F.coalesce("caption", F.lit("")).alias("caption"), F.col("self_ref").alias("picture_ref"))
    named = own.filter(F.contains(F.lower("label"), F.lit("caption"))).select("doc_id", "chunk_idx", "item_ord", F.col("text").alias("caption")).join(captions(items).drop("pos"), ["doc_id", "caption"]).select("doc_id", "chunk_idx", "item_ord", "caption", "picture_ref")
    once = W.partitionBy("doc_id", "chunk_idx", "picture_ref").orderBy("item_ord")
    figures = pictures.unionByName(named).withColumn("n", F.row_number().over(once)).filter("n = 1").groupBy("doc_id", "chunk_idx").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("item_ord", "caption", "picture_ref"))), lambda x: F.struct(x["caption"].alias("caption"), x["picture_ref"].alias("picture_ref"), F.lit(None).cast("string").alias("image_file"))).alias("figures"))
    files = table_files(items, folder).select("doc_id", "self_ref", "csv_file")
    once = W.partitionBy("doc_id", "chunk_idx", "self_ref").orderBy("item_ord")
    tables = own.filter("item_type = 'TableItem'").select("doc_id", "chunk_idx", "item_ord", "self_ref", F.coalesce("caption", F.lit("")).alias("caption")).join(files, ["doc_id", "self_ref"], "left").withColumn("n", F.row_number().over(once)).filter("n = 1").groupBy("doc_id", "chunk_idx").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("item_ord", "caption", F.coalesce("csv_file", F.lit("")).alias("csv_file")))), lambda x: F.struct(x["caption"].alias("caption"), x["csv_file"].alias("csv_file"))).alias("tables"))
    types = F.transform(F.array_sort(F.collect_list(F.struct("item_ord", "item_type"))), lambda x: x["item_type"])
    base = own.groupBy("doc_id", "chunk_idx").agg(types.alias("item_types"), text.sorted_pages(F.flatten(F.collect_list(F.coalesce("page_nos", F.array().cast("array<int>"))))).alias("page_numbers"))
    words = placed.groupBy("doc_id", "chunk_idx").agg(F.first("chunk_text", True).alias("text"), F.first("headings", True).alias("headings"))
    empty = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return words.join(base, ["doc_id", "chunk_idx"], "left").join(figures, ["doc_id", "chunk_idx"], "left").join(tables, ["doc_id", "chunk_idx"], "left").select(
        "doc_id", "chunk_idx", "text", empty("headings", "array<string>"), empty("item_types", "array<string>"), empty("page_numbers", "array<int>"), empty("figures", FIGURES), empty("tables", TABLES))
