"""Sinks. Each writes a folder by task commit; a single file is made only where the format is one."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import paths
from corpusloom.operators import chunks as chunk_ops
from corpusloom.operators import duplicates


def write_inventory(inventory: DataFrame, path: str) -> None:
    """hash, path with a header, grouped by hash in the order hashes are first seen."""
    duplicates.export_order(inventory).orderBy("first_ord", "ord").select("hash", "path").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_log(log: DataFrame, path: str) -> None:
    """Failed documents have empty fields."""
    log.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").option("escape", '"').csv(path)


def write_texts(docs: DataFrame, path: str) -> None:
    """A text file per document, in the folder of its species and name; a document without text has none."""
    rows = docs.filter("full_text IS NOT NULL").select("species", paths.stem("doc_path").alias("document"), "full_text")
    rows.repartition("species", "document").sortWithinPartitions("species", "document").write.mode("overwrite").partitionBy("species", "document").text(path)


def write_metadata(metadata: DataFrame, path: str) -> None:
    """One JSON object a line; nulls are kept."""
    metadata.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """One line per document: its chunks as a JSON array, without fields that have no value."""
    chunk_ops.to_json(chunks).select("json").write.mode("overwrite").text(path)


def write_link_script(planned: DataFrame, path: str, header: str = "# Makes hard links for duplicate files; run in the root of the output folder.") -> None:
    """One file, since the format is one: a header and a command per link, group by group in the order of the inventory."""
    lines = planned.filter("command IS NOT NULL").select(F.lit(1).alias("k"), "first_ord", "ord", "command")
    top = planned.sparkSession.range(1).select(F.lit(0).alias("k"), F.lit(header).alias("command"))
    top.unionByName(lines, allowMissingColumns=True).repartitionByRange(1, "k").sortWithinPartitions("k", "first_ord", "ord").select("command").write.mode("overwrite").text(path)


def write_files(files: DataFrame, root: str, path: str = "path", content: str = "content") -> DataFrame:
    """(path, bytes) of the files written: each row's content (binary, or text as UTF-8) under root/path, whole or not at all; rows without content give none.

    Written by the tasks to any file system that is known by URI, under a name of the attempt's own that is then moved, so a task that
    runs again does no harm. Lazy: the files are written when the result is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs

        fs, base = pyarrow.fs.FileSystem.from_uri(root)
        for batch in batches:
            names, sizes = [], []
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = f"{base}/{name}"
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                own = f"{at}.{uuid.uuid4().hex}.part"
                with fs.open_output_stream(own, compression=None) as out:
                    out.write(body)
                fs.move(own, at)
                names.append(name)
                sizes.append(len(body))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["path", "bytes"])

    rows = files.select(F.col(path).alias("path"), F.col(content).cast("binary").alias("content")).filter("path IS NOT NULL AND content IS NOT NULL")
    return rows.mapInArrow(run, "path string, bytes bigint")


def write_images(images: DataFrame, root: str) -> DataFrame:
    """The kept images of documents as root/species/stem/images/page<n>_img<m>.png; lazy, as write_files."""
    at = F.concat_ws("/", paths.species("doc_path"), paths.stem("doc_path"), F.lit("images"), "image_file")
    return write_files(images.select(at.alias("path"), "content"), root)


def write_documents(items: DataFrame, path: str) -> None:
    """One JSON object a document: all its items in order, under the document's id."""
    rest = [c for c in items.columns if c not in ("doc_id", "error")]
    body = F.sort_array(F.collect_list(F.struct("item_ord", *(c for c in rest if c != "item_ord"))))
    items.groupBy("doc_id").agg(body.alias("items")).write.mode("overwrite").json(path)


def write_run(run: dict[str, DataFrame], root: str) -> None:
    """What export.process gives: table and picture files with sidecars, chunks before and after post-processing, summaries."""
    from corpusloom.operators import export

    write_chunks(run["raw_chunks"], f"{root}/raw_chunks")
    write_chunks(run["chunks"], f"{root}/chunks")
    run["summary"].write.mode("overwrite").json(f"{root}/summary")
    for kind, name, content in (("tables", "csv_file", "csv"), ("tables", "meta_path", "meta"), ("pictures", "image_file", "content"), ("pictures", "meta_path", "meta")):
        kept = export.on_disk(run[kind], name).select(F.concat_ws("/", "doc_id", name).alias("path"), F.col(content).alias("content"))
        write_files(kept, root if "://" in root else f"file://{root}").count()
