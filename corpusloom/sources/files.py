"""Sources with explicit schemas: files, hash tables, JSON sidecars, HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import paths

INVENTORY = "hash STRING, path STRING"
LOG = "file_path STRING, species STRING, page_count INT, text_length INT, image_count INT, ocr_used BOOLEAN, error STRING"
PICTURE_META = "caption STRING, page_number INT, picture_ref STRING, source_file STRING, species STRING"
TABLE_META = "caption STRING, page_number INT, rows INT, cols INT, source_file STRING, species STRING"


def exists(spark: SparkSession, root: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def decoded(path: Column | str) -> Column:
    """A path as it is named: file metadata has it percent-encoded, in which a plus stands for itself."""
    return F.url_decode(F.replace(F.col(path) if isinstance(path, str) else path, F.lit("+"), F.lit("%2B")))


def scan_files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, length, modificationTime, content, species, stem). `content` is read only where it is selected.

    A missing root is an error (FileNotFoundError); a root without such files gives no rows.
    """
    if not exists(spark, root):
        raise FileNotFoundError(f"no folder {root}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return files.withColumns({"species": paths.species("path"), "stem": paths.stem("path")})


def in_order(files: DataFrame, path: str = "path") -> DataFrame:
    """Files sorted part by part of their paths, for a listing; the engine itself needs no order."""
    return files.orderBy(paths.order(path))


def hash_files(files: DataFrame) -> DataFrame:
    """(path, hash); hashing comes before any shuffle, so contents never move."""
    return files.select("path", F.md5("content").alias("hash"))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(hash, path, ord): a CSV with a header, or a folder of them.

    ord sorts the rows by file name, place of the split in the file and row in the split, so it is the order of the rows whatever tasks read them.
    """
    rows = spark.read.schema(INVENTORY).option("header", True).option("escape", '"').csv(path)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return rows.select("hash", "path", at.alias("ord"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG).option("header", True).option("escape", '"').csv(path)


def read_sidecars(spark: SparkSession, root: str, schema: str = PICTURE_META, pattern: str = "*_meta.json") -> DataFrame:
    """(meta_path, bad, fields of the schema): one row per file; a file that isn't a JSON object has bad = true and nulls. A missing root has none: nothing was exported."""
    if not exists(spark, root):
        return spark.createDataFrame([], f"meta_path STRING, bad BOOLEAN, {schema}")
    text = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(root).select(decoded("_metadata.file_path").alias("meta_path"), "value")
    parsed = text.withColumn("x", F.from_json("value", f"{schema}, _bad STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("x").isNull() | F.col("x._bad").isNotNull()
    names = [part.split()[0] for part in schema.split(",")]
    return parsed.select("meta_path", bad.alias("bad"), *(F.col(f"x.{n}").alias(n) for n in names))


def read_html(spark: SparkSession, root: str, pattern: str = "*.html") -> DataFrame:
    """(url, html), one row per file."""
    return spark.read.option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(root).select(decoded("_metadata.file_path").alias("url"), F.col("value").alias("html"))
