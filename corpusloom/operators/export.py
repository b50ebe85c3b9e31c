"""Tables and pictures of structured documents as files with sidecars, and the whole run over a converted document.

Items as in `operators.items`. Table data: (doc_id, self_ref, header array<string>, cells array<array<string>>, error); picture data:
(doc_id, self_ref, content binary, error). A table without data, or with an error, fails; its CSV name stays in use. A picture
without content is a success without an image, since its sidecar is written. Of several with one name the last successful one is on disk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import paths
from corpusloom.operators import chunks as chunk_ops
from corpusloom.operators import items as item_ops
from corpusloom.sources.staging import stage


def csv_text(header: Column | str, cells: Column | str) -> Column:
    """A table as CSV: a line each, ended by a line feed; fields with a comma, quote or line break are quoted, nulls are empty."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    field = lambda x: F.when(F.rlike(x, F.lit('[",\n\r]')), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.coalesce(x, F.lit("")))
    line = lambda row: F.concat(F.array_join(F.transform(row, field), ","), F.lit("\n"))
    return F.concat(line(col(header)), F.array_join(F.transform(col(cells), line), ""))


def _sidecar(**fields) -> Column:
    return F.to_json(F.struct(*(c.alias(k) for k, c in fields.items())), {"ignoreNullFields": "false"})


def tables(items: DataFrame, data: DataFrame, sources: DataFrame, folder: str = "tables") -> DataFrame:
    """(doc_id, self_ref, ordinal, csv_file, ok, csv, meta_path, meta): every table with its file and sidecar; sources: (doc_id, source_file, species)."""
    made = item_ops.table_files(items, folder).join(data.select("doc_id", "self_ref", "header", "cells", "error"), ["doc_id", "self_ref"], "left").join(sources, "doc_id", "left")
    ok = F.col("header").isNotNull() & F.col("cells").isNotNull() & F.col("error").isNull()
    meta = _sidecar(caption=F.col("caption"), page_number=F.col("page_number"), rows=F.size("cells"), cols=F.size("header"), source_file=F.col("source_file"), species=F.col("species"))
    return made.select(
        "doc_id", "self_ref", "ordinal", "csv_file", ok.alias("ok"), F.when(ok, csv_text("header", "cells")).alias("csv"),
        F.concat(F.lit(folder + "/"), "slug", F.lit("_meta.json")).alias("meta_path"), F.when(ok, meta).alias("meta"))


def pictures(items: DataFrame, data: DataFrame, sources: DataFrame, folder: str = "images") -> DataFrame:
    """(doc_id, picture_ref, ordinal, caption, page_number, image_file, ok, content, meta_path, meta): every picture with its file and sidecar."""
    made = item_ops.picture_files(items, folder).join(data.select("doc_id", F.col("self_ref").alias("picture_ref"), "content", "error"), ["doc_id", "picture_ref"], "left").join(sources, "doc_id", "left")
    ok = F.col("error").isNull()
    meta = _sidecar(caption=F.col("caption"), page_number=F.col("page_number"), picture_ref=F.col("picture_ref"), source_file=F.col("source_file"), species=F.col("species"))
    return made.select("doc_id", "picture_ref", "ordinal", "caption", "page_number", "image_file", ok.alias("ok"), F.when(ok, F.col("content")).alias("content"), "meta_path", F.when(ok, meta).alias("meta"))


def on_disk(exported: DataFrame, name: str) -> DataFrame:
    """Of successful exports with one file name in a document the last: an aggregate, so a name may be used any number of times."""
    rest = [c for c in exported.columns if c not in ("doc_id", name)]
    return exported.filter("ok").groupBy("doc_id", name).agg(F.max_by(F.struct(*rest), "ordinal").alias("x")).select("doc_id", name, "x.*")


def export_stats(exported: DataFrame) -> DataFrame:
    """(doc_id, total, ok, fail)."""
    return exported.groupBy("doc_id").agg(F.count("*").alias("total"), F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("fail"))


def summary(page_counts: DataFrame, table_stats: DataFrame, picture_stats: DataFrame, chunk_stats: DataFrame, post_stats: DataFrame) -> DataFrame:
    """One row per document (doc_id, page_count) with all counts of its run; what a document has none of is 0."""
    name = lambda df, k: df.select("doc_id", *(F.col(c).alias(f"{k}_{c}") for c in ("total", "ok", "fail")))
    out = page_counts.select("doc_id", "page_count")
    for part in (name(table_stats, "tables"), name(picture_stats, "pictures"), chunk_stats.withColumnsRenamed({"total": "chunks"}), post_stats):
        out = out.join(part, "doc_id", "left")
    return out.select("doc_id", "page_count", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in out.columns if c not in ("doc_id", "page_count")))


def process(items: DataFrame, placed: DataFrame, table_data: DataFrame, picture_data: DataFrame, page_counts: DataFrame, paths_of: DataFrame, threshold: float = chunk_ops.FUZZY) -> dict[str, DataFrame]:
    """A run over converted documents: tables, pictures, raw chunks, final chunks and the summary of each document.

    placed: which items a chunker put where, as for items.build_chunks; page_counts: (doc_id, page_count); paths_of: (doc_id, path).
    """
    sources = paths_of.select("doc_id", paths.name("path").alias("source_file"), paths.species("path").alias("species"))
    exported_tables = stage(tables(items, table_data, sources), "export-tables")
    exported_pictures = stage(pictures(items, picture_data, sources), "export-pictures")
    raw = item_ops.build_chunks(placed, items).join(sources, "doc_id", "left")
    raw = stage(raw, "export-chunks")
    sidecars = on_disk(exported_pictures, "meta_path").select("doc_id", "meta_path", "caption", "page_number", "picture_ref")
    done = chunk_ops.postprocess(raw, item_ops.captions(items), sidecars, threshold)
    run = summary(page_counts, export_stats(exported_tables), export_stats(exported_pictures), chunk_ops.chunk_stats(raw), done["stats"])
    return {"tables": exported_tables, "pictures": exported_pictures, "raw_chunks": raw, "chunks": done["chunks"], "summary": run}
