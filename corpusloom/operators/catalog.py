"""Catalog pages: fields and links from HTML, file names, what is still to be fetched. Fetching itself is left to others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import text


def folder(name):
    """A species' folder: blanks as underscores."""
    return F.translate(text.col(name), " ", "_")


def fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds author, year and title from labelled cells, and hrefs."""
    return pages.withColumns({"author": text.labelled_cell(html, "Author"), "year": text.labelled_cell(html, "Year"), "title": text.labelled_cell(html, "Title"), "hrefs": text.hrefs(html)})


def links(pages: DataFrame, html: str = "html", label: str = "PDF") -> DataFrame:
    """One row per link of the cell labelled PDF, as it stands: columns but html, pdf_ord, pdf_url."""
    keep = [c for c in pages.columns if c != html]
    return pages.select(*keep, F.posexplode(text.labelled_links(html, label)).alias("n", "pdf_url")).select(*keep, (F.col("n") + 1).alias("pdf_ord"), "pdf_url")


def references(genus: DataFrame, base: str, html: str = "html", shift: int = 9) -> DataFrame:
    """(species, pos, ref_ord, ref_url): every species title of a catalog page with the links of the block `shift` places further; one without links has nulls.

    A page is one row, so nothing is sorted over all of them; columns beside html are kept.
    """
    keep = [c for c in genus.columns if c != html]
    rows = genus.select(*keep, text.reference_blocks(html).alias("__b"), F.posexplode(text.species_titles(html)).alias("pos", "species"))
    rows = rows.withColumn("__r", F.get("__b", F.col("pos") + shift))
    return rows.select(*keep, "species", "pos", F.posexplode_outer("__r").alias("ref_ord", "href")).select(*keep, "species", "pos", "ref_ord", text.url_join(F.lit(base), "href").alias("ref_url"))


def crawl(genus: DataFrame, pages: DataFrame, present: DataFrame, base: str, root: str, names: DataFrame | None = None, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """What a crawl of saved pages fetches.

    genus: catalog pages (html); pages: (url, html) of references; present: (path) of files that are there; names: species
    (folder names) to take, all for none. Returns files (species, pos, ref_url, pdf_ord, pdf_url, author, year, title, base, copy_no, path, there) and
    summary (species_processed, species_total, files, folders with errors in the order of the species). A reference whose page isn't
    there, or has no author, year or title, is an error of its folder and gives no file. Files that are there count as well.
    Names are numbered over all species, in the order of species, reference and link.
    """
    wanted = references(genus.select(html), base, html).withColumn("species", folder("species"))
    total = wanted.select("species", "pos").distinct()
    if names is not None:
        wanted = allowed(wanted, names)
    read = wanted.join(fields(pages.select(F.col("url").alias("ref_url"), html), html), "ref_url", "left")
    good = F.col("author").isNotNull() & F.col("year").isNotNull() & F.col("title").isNotNull()
    found = links(read.filter(good).drop("hrefs"), html).withColumn("base", text.base_name("author", "year", "title"))
    numbered = number_names(found, ["pos", "ref_ord", "pdf_ord", "ref_url"]).withColumn("path", F.concat_ws("/", F.lit(root.rstrip("/")), "species", text.file_name("base", "copy_no")))
    there = present.select("path").distinct().withColumn("there", F.lit(True))
    files = numbered.join(there, "path", "left").select("species", "pos", "ref_ord", "ref_url", "pdf_ord", "pdf_url", "author", "year", "title", "base", "copy_no", "path", F.coalesce("there", F.lit(False)).alias("there"))
    errors = failed_folders(read.filter(F.col("ref_url").isNotNull() & ~F.coalesce(good, F.lit(False))).select("species", F.col("pos").alias("ord")))
    # One row each.
    done = wanted.agg(F.countDistinct("species", "pos").alias("species_processed")).crossJoin(total.agg(F.count("*").alias("species_total")))
    return files, done.crossJoin(files.agg(F.count("*").alias("files"), F.count_if("there").alias("already_there"))).crossJoin(errors)


def allowed(species: DataFrame, names: DataFrame) -> DataFrame:
    """Rows of species that the list (species) names."""
    return species.join(names.select("species").distinct(), "species", "left_semi")


def number_names(refs: DataFrame, order: list[str], name: str = "base") -> DataFrame:
    """Adds copy_no and unique_base: the first of a name stays, the n-th gets `_{n-1}`; counted over all species."""
    n = F.row_number().over(W.partitionBy(name).orderBy(*order)) - 1
    return refs.withColumn("copy_no", n).withColumn("unique_base", F.when(F.col("copy_no") == 0, F.col(name)).otherwise(F.concat(name, F.lit("_"), F.col("copy_no").cast("string"))))


def to_fetch(wanted: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    """What isn't there yet."""
    return wanted.join(present.select(key).distinct(), key, "left_anti")


def failed_folders(errors: DataFrame) -> DataFrame:
    """(folders): species with an error, each once, in the order they first failed; one row, empty for none."""
    first = errors.groupBy("species").agg(F.min("ord").alias("ord"))
    return first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "species"))), lambda x: x["species"]), ", ").alias("folders"))
