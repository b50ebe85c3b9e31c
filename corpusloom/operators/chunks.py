"""Figures and tables of text chunks: linking by caption, image files, duplicates, figures placed by page.

Chunks: (doc_id, chunk_idx, text, page_numbers, figures, tables, ...), one row per (doc_id, chunk_idx); null arrays
count as empty. Captions: (doc_id, caption, picture_ref, pos). Sidecars: (doc_id, meta_path, caption,
page_number, picture_ref). Work is keyed by document and chunk; texts go through no shuffle but the fuzzy one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import text
from corpusloom.functions.fuzzy import partial_ratios_udf
from corpusloom.operators.items import FIGURES, TABLES
from corpusloom.sources.staging import stage

FUZZY = 85
KEY = ["doc_id", "chunk_idx"]


def latest(chunks: DataFrame, keys: list[str] = KEY, at: str = "loaded_at") -> DataFrame:
    """One row per key: of a key written again the last run's, then the greatest text; repeated rows fall together."""
    rest = [c for c in chunks.columns if c not in keys]
    by = F.struct(F.col(at).isNotNull(), F.col(at), F.col("text").isNotNull(), F.col("text"))
    return chunks.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("__x")).select(*keys, "__x.*").select(chunks.columns)


def _array(c: str, kind: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast(kind))


def figures(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk_idx, pos, caption, picture_ref, image_file), one row per figure entry; a missing reference is empty."""
    return chunks.select(*KEY, F.posexplode("figures").alias("pos", "f")).select(*KEY, "pos", F.col("f.caption").alias("caption"), F.coalesce("f.picture_ref", F.lit("")).alias("picture_ref"), F.col("f.image_file").alias("image_file"))


def tables(chunks: DataFrame) -> DataFrame:
    """(doc_id, chunk_idx, pos, caption, csv_file); a missing file is empty."""
    return chunks.select(*KEY, F.posexplode("tables").alias("pos", "t")).select(*KEY, "pos", F.col("t.caption").alias("caption"), F.coalesce("t.csv_file", F.lit("")).alias("csv_file"))


def with_figures(chunks: DataFrame, figs: DataFrame) -> DataFrame:
    """`chunks` with their figures put together anew from rows in the order of pos."""
    packed = figs.groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "caption", "picture_ref", "image_file"))), lambda x: F.struct(x["caption"].alias("caption"), x["picture_ref"].alias("picture_ref"), x["image_file"].alias("image_file"))).alias("__f"))
    return chunks.join(packed, KEY, "left").withColumn("figures", F.coalesce("__f", F.array().cast(FIGURES))).select(chunks.columns)


def _first_by(c: Column, key) -> Column:
    """Of an array's entries with one key the first."""
    return F.aggregate(c, F.slice(c, 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: key(y) == key(x)), acc).otherwise(F.concat(acc, F.array(x))))


def dedup_in_chunk(chunks: DataFrame) -> DataFrame:
    """Within a chunk the first figure of a reference and the first table of a file; missing ones count as empty. No shuffle."""
    return chunks.withColumn("figures", _first_by(_array("figures", FIGURES), lambda x: F.coalesce(x["picture_ref"], F.lit("")))).withColumn(
        "tables", _first_by(_array("tables", TABLES), lambda x: F.coalesce(x["csv_file"], F.lit(""))))


def first_across(figs: DataFrame) -> DataFrame:
    """Of figure rows with one reference in a document those of the first place; empty references all stay."""
    # An aggregate, not a window: a reference may be repeated any number of times.
    first = figs.filter("picture_ref <> ''").groupBy("doc_id", "picture_ref").agg(F.min(F.struct("chunk_idx", "pos")).alias("first"))
    return figs.join(first, ["doc_id", "picture_ref"], "left").filter((F.col("picture_ref") == "") | ((F.col("chunk_idx") == F.col("first.chunk_idx")) & (F.col("pos") == F.col("first.pos")))).drop("first")


def dedup_across(chunks: DataFrame) -> DataFrame:
    return with_figures(chunks, first_across(figures(chunks)))


def fuzzy_links(chunks: DataFrame, captions: DataFrame, threshold: float = FUZZY) -> DataFrame:
    """(doc_id, chunk_idx, pos, caption, picture_ref, score): captions found in a chunk's text that it doesn't refer to yet.

    A chunk meets its document's captions as one array, so its text is shuffled and read once. A caption that stands in the text word
    for word scores 100 in the JVM; only the others go to Python, and none where the threshold leaves nothing else.
    """
    caps = captions.filter(F.coalesce("caption", F.lit("")) != "").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("pos", "caption", "picture_ref"))).alias("__c"))
    near = chunks.filter(F.coalesce("text", F.lit("")) != "").select(*KEY, "text", F.transform(_array("figures", FIGURES), lambda x: F.coalesce(x["picture_ref"], F.lit(""))).alias("refs")).join(caps, "doc_id")
    near = near.withColumn("__c", F.filter("__c", lambda c: ~F.array_contains("refs", c["picture_ref"]))).filter(F.size("__c") > 0)
    inside = lambda c: F.contains(F.col("text"), c["caption"])
    if threshold >= 100:
        # What is the whole of a shorter text scores 100 as well.
        scores = F.transform("__c", lambda c: F.when(inside(c) | F.contains(c["caption"], F.col("text")), 100.0))
    else:
        # Scoring costs far more than the shuffle, which deals a document's chunks out: small tables aren't left to one task, nor large documents.
        near = near.repartition(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), *KEY)
        near = near.withColumn("__p", partial_ratios_udf(threshold)("text", F.transform("__c", lambda c: F.when(~inside(c), c["caption"]))))
        scores = F.transform("__c", lambda c, i: F.when(inside(c), 100.0).otherwise(F.get("__p", i)))
    scored = near.select(*KEY, F.explode(F.arrays_zip("__c", scores.alias("score"))).alias("x"))
    return scored.filter(F.col("x.score") >= threshold).select(*KEY, "x.__c.pos", "x.__c.caption", "x.__c.picture_ref", "x.score")


def inject(chunks: DataFrame, links: DataFrame) -> DataFrame:
    """`chunks` with linked figures behind their own, in the captions' order; a reference once a chunk."""
    own = links.groupBy(*KEY, "picture_ref").agg(F.min(F.struct("pos", "caption")).alias("x")).groupBy(*KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("x.pos", "x.caption", "picture_ref"))), lambda x: F.struct(x["caption"].alias("caption"), x["picture_ref"].alias("picture_ref"), F.lit(None).cast("string").alias("image_file"))).alias("__new"))
    return chunks.join(own, KEY, "left").withColumn("figures", F.concat(_array("figures", FIGURES), _array("__new", FIGURES))).select(chunks.columns)


def image_files(sidecars: DataFrame) -> DataFrame:
    """(doc_id, picture_ref, found): the image beside a reference's sidecar; of several the last by path."""
    image = F.concat(F.lit("images/"), F.regexp_replace(F.substring_index("meta_path", "/", -1), r"_meta\.json\z", ".png"))
    return sidecars.filter(F.coalesce("picture_ref", F.lit("")) != "").groupBy("doc_id", "picture_ref").agg(F.max_by(image, "meta_path").alias("found"))


def resolve_images(chunks: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Figures without an image file get that of their sidecar, if there is one."""
    known = image_files(sidecars).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("picture_ref", "found"))).alias("__m"))
    done = lambda x: F.coalesce(F.nullif(x["image_file"], F.lit("")), F.try_element_at(F.col("__m"), F.coalesce(x["picture_ref"], F.lit(""))))
    return chunks.join(known, "doc_id", "left").withColumn("figures", F.transform(_array("figures", FIGURES), lambda x: F.struct(x["caption"].alias("caption"), x["picture_ref"].alias("picture_ref"), done(x).alias("image_file")))).select(chunks.columns)


def fallback_links(chunks: DataFrame, sidecars: DataFrame) -> DataFrame:
    """(doc_id, chunk_idx, meta_path, caption, picture_ref, image_file): uncaptioned figures no chunk has, put into the first chunk of their page; their caption is empty.

    Sidecars without such a chunk are passed over; of a reference's others the first by path counts.
    """
    ref = F.coalesce("picture_ref", F.lit(""))
    held = figures(chunks).select("doc_id", "picture_ref").distinct()
    loose = sidecars.filter((text.strip(F.coalesce("caption", F.lit(""))) == "") & (ref != "")).join(held, ["doc_id", "picture_ref"], "left_anti")
    first = chunks.select(*KEY, F.explode("page_numbers").alias("page_number")).groupBy("doc_id", "page_number").agg(F.min("chunk_idx").alias("chunk_idx"))
    image = F.concat(F.lit("images/"), F.regexp_replace(F.substring_index("meta_path", "/", -1), r"_meta\.json\z", ".png"))
    placed = loose.join(first, ["doc_id", "page_number"]).groupBy("doc_id", "picture_ref").agg(F.min(F.struct("meta_path", "chunk_idx")).alias("x"))
    return placed.select("doc_id", "x.chunk_idx", "x.meta_path", F.lit("").alias("caption"), "picture_ref").withColumn("image_file", image)


def inject_fallback(chunks: DataFrame, links: DataFrame) -> DataFrame:
    own = links.groupBy(*KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("meta_path", "caption", "picture_ref", "image_file"))), lambda x: F.struct(x["caption"].alias("caption"), x["picture_ref"].alias("picture_ref"), x["image_file"].alias("image_file"))).alias("__new"))
    return chunks.join(own, KEY, "left").withColumn("figures", F.concat(_array("figures", FIGURES), _array("__new", FIGURES))).select(chunks.columns)


def postprocess(chunks: DataFrame, captions: DataFrame, sidecars: DataFrame, threshold: float = FUZZY) -> dict[str, DataFrame]:
    """chunks in their final state, and stats: (doc_id, fuzzy_injected, image_files_resolved, cross_chunk_removed, fallback_injected).

    The order is fixed: fuzzy links, image files, duplicates in a chunk, duplicates across chunks (the first chunk wins, so a link may
    take a figure from a later chunk), figures by page. A second pass across chunks would change nothing.
    """
    own = F.size(_array("figures", FIGURES))
    files = F.size(F.filter(_array("figures", FIGURES), lambda x: F.coalesce(x["image_file"], F.lit("")) != ""))
    # The counts travel with the chunks, and the state before anything crosses chunks is a table: nothing is computed twice.
    linked = inject(chunks, fuzzy_links(chunks, captions, threshold).withColumnRenamed("score", "__s")).select(*KEY, own.alias("__linked"), files.alias("__files"), *[c for c in chunks.columns if c not in KEY])
    before = chunks.select(*KEY, own.alias("__own"))
    inner = dedup_in_chunk(resolve_images(linked, sidecars).withColumn("__files", files - F.col("__files")))
    inner = stage(inner.withColumn("__inner", F.size("figures")), "chunks-inner")
    across = dedup_across(inner.select(chunks.columns))
    placed = stage(fallback_links(across, sidecars), "chunks-placed")
    across = stage(across, "chunks-across")
    first = inner.join(before, KEY).groupBy("doc_id").agg(F.sum(F.col("__linked") - F.col("__own")).alias("fuzzy_injected"), F.sum("__files").alias("image_files_resolved"), F.sum("__inner").alias("__inner"))
    after = across.groupBy("doc_id").agg(F.sum(F.size("figures")).alias("__across"))
    last = placed.groupBy("doc_id").agg(F.count("*").alias("fallback_injected"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    stats = first.join(after, "doc_id").join(last, "doc_id", "left").select(
        "doc_id", zero("fuzzy_injected").alias("fuzzy_injected"), zero("image_files_resolved").alias("image_files_resolved"), (zero("__inner") - zero("__across")).alias("cross_chunk_removed"), zero("fallback_injected").alias("fallback_injected"))
    return {"chunks": inject_fallback(across, placed), "stats": stats}


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """(doc_id, total, with_figures, with_tables)."""
    return chunks.groupBy("doc_id").agg(F.count("*").alias("total"), F.count_if(F.size(_array("figures", FIGURES)) > 0).alias("with_figures"), F.count_if(F.size(_array("tables", TABLES)) > 0).alias("with_tables"))


def to_json(chunks: DataFrame) -> DataFrame:
    """(doc_id, json): a document's chunks as one array in their order; fields without a value are left out."""
    body = F.struct("text", "headings", "item_types", "source_file", "species", "page_numbers", "figures", "tables")
    return chunks.groupBy("doc_id").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("chunk_idx", body.alias("x")))), lambda y: y["x"])).alias("json"))
