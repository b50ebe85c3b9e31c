"""The registered queries of the core over the driver's tables, and equivalent SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions import paths, text
from corpusloom.operators import catalog, chunks, duplicates, export, items, pages
from corpusloom.sources import files, sinks, staging

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Character classes of the SQL engine's regular expressions, equal to those of functions.chars.
_WS = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
_DIGIT = r"\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_WS}+', ''), '{_WS}+$', '')"


def _n(x: str, what: str) -> str:
    return f"CAST(length(regexp_replace({x}, '{what}', '', 'g')) AS INTEGER)"


def _slug(x: str) -> str:
    core = f"regexp_replace({_strip(f'''regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\t-\\r\\x1c-\\x1f\\x{{85}}\\p{{Z}}\\-]', '', 'g')''')}, '{_WS}+', '_', 'g')"
    return f"coalesce(nullif(regexp_replace(left({core}, 50), '[_\\-]+$', ''), ''), left({x}, 50))"


_STEM = r"regexp_replace(regexp_extract({}, '[^/]*$'), '\.[^.]*$', '')"

# -- duplicates ---------------------------------------------------------------------------------------------------------


@query("SELECT md5(text) AS hash, count(*) AS n, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def dup_groups(spark, d):
    rows = t(spark, d, "documents").filter("text IS NOT NULL").select("doc_id", duplicates.digest("text").alias("hash"))
    return rows.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("n > 1")


def _inventory(spark, d):
    return t(spark, d, "hash_csv").select("hash", "path", "ord")


@query("""
WITH g AS (SELECT hash, count(*) AS n FROM hash_csv WHERE hash IS NOT NULL GROUP BY hash),
x AS (SELECT (SELECT count(*) FROM hash_csv) AS total, count(*) AS distinct_hashes, CAST(count(*) FILTER (n = 1) AS BIGINT) AS no_duplicate FROM g)
SELECT total, distinct_hashes, no_duplicate, total - no_duplicate AS has_duplicate FROM x""")
def dup_summary(spark, d):
    return duplicates.summary(_inventory(spark, d))


@query("SELECT hash, n, first_ord, path, ord FROM (SELECT *, count(*) OVER (PARTITION BY hash) AS n, min(ord) OVER (PARTITION BY hash) AS first_ord FROM hash_csv WHERE hash IS NOT NULL) WHERE n > 1")
def dup_report(spark, d):
    return duplicates.report(_inventory(spark, d))


def _folder(spark, what):
    """A new folder beside the staged tables."""
    return f"{staging.shared_folder(spark)}/corpusloom/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


@query("SELECT hash, path FROM hash_csv WHERE hash IS NOT NULL")
def inventory_round_trip(spark, d):
    """The hash table written as CSV and read again."""
    at = _folder(spark, "inventory")
    sinks.write_inventory(_inventory(spark, d), at)
    return files.read_inventory(spark, at).select("hash", "path")


_KEEPERS = rf"""
r AS (SELECT hash, path, ord, TRY_CAST(nullif(regexp_extract({_STEM.format("path")}, '_(\p{{Nd}}+)$', 1), '') AS HUGEINT) AS num FROM hash_csv WHERE hash IS NOT NULL),
k AS (SELECT hash, count(*) OVER (PARTITION BY hash) AS n, min(ord) OVER (PARTITION BY hash) AS first_ord, path AS keeper,
             row_number() OVER (PARTITION BY hash ORDER BY num IS NOT NULL, num, ord) AS rn FROM r)"""


@query(f"WITH {_KEEPERS} SELECT hash, n, first_ord, keeper FROM k WHERE rn = 1")
def dup_keeper(spark, d):
    return duplicates.sizes(_inventory(spark, d))


@query("SELECT hash, path, ord, min(ord) OVER (PARTITION BY hash) AS first_ord FROM hash_csv WHERE hash IS NOT NULL")
def hash_export(spark, d):
    return duplicates.export_order(_inventory(spark, d))


def _files(spark, d):
    return t(spark, d, "metadata").select(F.col("original_pdf_path").alias("path"))


@query("SELECT original_pdf_path AS path FROM metadata WHERE original_pdf_path NOT IN (SELECT path FROM hash_csv WHERE hash IS NOT NULL)")
def files_not_in_inventory(spark, d):
    return duplicates.absent(_files(spark, d), _inventory(spark, d))


_PLAN = f"""
WITH {_KEEPERS},
keep AS (SELECT hash, n, keeper FROM k WHERE rn = 1),
links AS (SELECT r.path, keep.keeper, string_split(r.path, '/') AS p, string_split(keep.keeper, '/') AS q FROM r JOIN keep USING (hash) WHERE n > 1 AND path <> keeper),
targets AS (SELECT *, CASE WHEN p[1] = q[1] AND p[2] = q[2] THEN q[3] WHEN p[1] = q[1] THEN '../' || q[2] || '/' || q[3] ELSE '../../' || keeper END AS target FROM links),
plan AS (
  SELECT 'copy' AS action, r.path AS src, 'clean/' || r.path AS dest, NULL AS target, NULL AS command FROM r JOIN keep USING (hash) WHERE n = 1
  UNION ALL SELECT 'copy_keeper', keeper, 'clean/' || keeper, NULL, NULL FROM keep WHERE n > 1
  UNION ALL SELECT 'copy_unlisted', original_pdf_path, 'clean/' || original_pdf_path, NULL, NULL FROM metadata WHERE original_pdf_path NOT IN (SELECT path FROM hash_csv WHERE hash IS NOT NULL)
  UNION ALL SELECT 'link', path, 'clean/' || path, target,
    'Push-Location "' || p[1] || chr(92) || p[2] || '"; New-Item -ItemType HardLink -Path "' || p[3] || '" -Target "' || replace(target, '/', chr(92)) || '" -Force; Pop-Location' FROM targets)"""


def _planned(spark, d):
    return duplicates.plan(_inventory(spark, d), _files(spark, d), "", "clean")


@query(_PLAN + "SELECT action, src, dest, target FROM plan")
def dup_actions(spark, d):
    return _planned(spark, d).select("action", "src", "dest", "target")


@query(_PLAN + "SELECT src, command FROM plan WHERE command IS NOT NULL")
def link_script(spark, d):
    return _planned(spark, d).filter("command IS NOT NULL").select("src", "command")


@query(_PLAN + "SELECT src FROM plan WHERE action IN ('copy', 'copy_unlisted')")
def copy_list(spark, d):
    return _planned(spark, d).filter("action IN ('copy', 'copy_unlisted')").select("src")


@query(_PLAN + """SELECT count(*) FILTER (action IN ('copy', 'copy_unlisted')) AS unique_files, count(*) FILTER (action = 'copy_keeper') AS groups,
 count(*) FILTER (action IN ('copy_keeper', 'link')) AS files_in_groups, count(*) FILTER (action = 'link') AS links, count(*) FILTER (dest IS NULL) AS errors FROM plan""")
def dup_plan_summary(spark, d):
    return duplicates.plan_summary(_planned(spark, d))


@query("SELECT string_split(path, '/')[2] AS species, count(*) AS n, count(DISTINCT path) AS n_paths FROM hash_csv GROUP BY 1")
def species_files(spark, d):
    return _inventory(spark, d).groupBy(paths.species("path").alias("species")).agg(F.count("*").alias("n"), F.countDistinct("path").alias("n_paths"))


@query("SELECT DISTINCT species, replace(species, ' ', '_') AS folder FROM metadata")
def species_folders(spark, d):
    return t(spark, d, "metadata").select("species", catalog.folder("species").alias("folder")).distinct()


# -- text functions -----------------------------------------------------------------------------------------------------

_INNER = f"regexp_replace(regexp_replace(regexp_replace({{x}}, '[^\\p{{{{L}}}}{_DIGIT.replace('{', '{{').replace('}', '}}')}]', '.', 'g'), '[{_DIGIT.replace('{', '{{').replace('}', '}}')}]', '0', 'g'), '\\p{{{{L}}}}', 'aa', 'g')".replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{").replace("}}", "}")


def _inner(x: str) -> str:
    y = _INNER.replace("{x}", x)
    return f"CAST((length({y}) - length(replace({y}, 'a0a', ''))) // 3 AS INTEGER)"


_PROFILE = f"{_n('{x}', _WS)} AS nws, {_n('{x}', '[^L]')} AS letters, {_n('{x}', '[^L]|[\\x00-\\x7f]')} AS foreign_letters".replace("[^L]", r"[^\p{L}]")


def _profile(x: str) -> str:
    return _PROFILE.replace("{x}", x) + f", {_inner(x)} AS inner_digits"


@query(f"SELECT doc_id, {_profile('text')} FROM documents")
def char_profile(spark, d):
    return t(spark, d, "documents").select("doc_id", text.nonws_len("text").alias("nws"), text.letter_count("text").alias("letters"), text.foreign_letter_count("text").alias("foreign_letters"), text.inner_digit_count("text").alias("inner_digits"))


_GATE = """CASE WHEN coalesce(nws, 0) = 0 THEN FALSE WHEN foreign_letters / nws >= 0.15 THEN FALSE WHEN letters / nws < 0.4 THEN TRUE ELSE inner_digits / nws > 0.005 END"""


@query(f"WITH p AS (SELECT doc_id, {_profile('text')} FROM documents) SELECT doc_id, {_GATE} AS garbled, coalesce(nws, 0) < 50 OR {_GATE} AS ocr FROM p")
def ocr_gate(spark, d):
    return pages.gate(t(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", "garbled", "ocr")


_YEAR = r"(?s)^(.*?)(?:^|_)(\p{Nd}{4}[a-z]?)((?:_.*)?)$"


def _parsed(src: str) -> str:
    title = _strip("replace(regexp_replace(regexp_extract(s, '" + _YEAR + "', 3), '^_+', ''), '_', ' ')")
    return f"""SELECT s AS stem,
 CASE WHEN y THEN regexp_extract(s, '{_YEAR}', 1) ELSE p[1] END AS author,
 CASE WHEN y THEN regexp_extract(s, '{_YEAR}', 2) ELSE coalesce(p[2], '') END AS year,
 CASE WHEN y THEN {title} ELSE replace(array_to_string(p[3:], '_'), '_', ' ') END AS title
FROM (SELECT s, regexp_matches(s, '{_YEAR}') AS y, string_split(s, '_') AS p FROM ({src}))"""


@query(_parsed(f"SELECT DISTINCT {_STEM.format('original_pdf_path')} AS s FROM metadata WHERE original_pdf_path IS NOT NULL"))
def parse_filename(spark, d):
    stems = t(spark, d, "metadata").filter("original_pdf_path IS NOT NULL").select(paths.stem("original_pdf_path").alias("stem")).distinct()
    return stems.select("stem", text.parse_filename("stem").alias("x")).select("stem", "x.author", "x.year", "x.title")


@query(_parsed("SELECT DISTINCT species || '_' || coalesce(replace(title, ' ', '_'), '') AS s FROM metadata WHERE species IS NOT NULL"))
def parse_filename_fallback(spark, d):
    s = F.concat("species", F.lit("_"), F.coalesce(F.translate("title", " ", "_"), F.lit("")))
    stems = t(spark, d, "metadata").filter("species IS NOT NULL").select(s.alias("stem")).distinct()
    return stems.select("stem", text.parse_filename("stem").alias("x")).select("stem", "x.author", "x.year", "x.title")


@query(f"SELECT DISTINCT title, {_slug('title')} AS slug FROM metadata")
def make_slug(spark, d):
    return t(spark, d, "metadata").select("title", text.make_slug("title").alias("slug")).distinct()


_LATEST_META = "SELECT * FROM metadata QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY extraction_datetime DESC NULLS LAST, title DESC NULLS LAST) = 1"
_BASE = r"regexp_replace(replace(coalesce(author, '') || '_' || coalesce(year, '') || '_' || coalesce(title, ''), ' ', '_'), '[^\p{L}\p{N}_\-]', '', 'g')"


def _latest_metadata(spark, d):
    m = t(spark, d, "metadata")
    by = F.struct(F.col("extraction_datetime").isNotNull(), "extraction_datetime", F.col("title").isNotNull(), "title")
    rest = [c for c in m.columns if c != "doc_id"]
    return m.groupBy("doc_id").agg(F.max_by(F.struct(*rest), by).alias("x")).select("doc_id", "x.*")


@query(f"SELECT doc_id, title, extraction_datetime FROM ({_LATEST_META})")
def latest_metadata(spark, d):
    return _latest_metadata(spark, d).select("doc_id", "title", "extraction_datetime")


@query(f"""WITH b AS (SELECT doc_id, {_BASE} AS base FROM ({_LATEST_META})), n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY doc_id) - 1 AS k FROM b)
SELECT doc_id, base, CAST(k AS INTEGER) AS copy_no, CASE WHEN k = 0 THEN base ELSE base || '_' || k END AS unique_base FROM n""")
def name_counter(spark, d):
    named = _latest_metadata(spark, d).select("doc_id", text.base_name("author", "year", "title").alias("base"))
    return catalog.number_names(named, ["doc_id"])


@query("""WITH x AS (SELECT DISTINCT title FROM metadata WHERE title IS NOT NULL)
SELECT title, CASE WHEN strlen(title) <= 60 THEN title ELSE left(title, list_max(list_filter(range(0, 61), lambda i: strlen(left(title, i)) <= 60))) END AS short FROM x""")
def byte_truncate(spark, d):
    return t(spark, d, "metadata").filter("title IS NOT NULL").select("title", text.truncate_utf8("title", 60).alias("short")).distinct()


@query("""SELECT doc_id, to_json({'original_pdf_path': original_pdf_path, 'species': species, 'author': author, 'year': year, 'title': title, 'page_count': page_count,
 'text_length_chars': text_length_chars, 'image_count': image_count, 'ocr_used': ocr_used}) :: VARCHAR AS json FROM (""" + _LATEST_META + ")")
def metadata_json(spark, d):
    body = F.struct("original_pdf_path", "species", "author", "year", "title", "page_count", "text_length_chars", "image_count", "ocr_used")
    return _latest_metadata(spark, d).select("doc_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))


# -- pages and documents ------------------------------------------------------------------------------------------------

_MARK = r"(?m)^\[Page (\p{Nd}+)( — OCR(?: failed: [^\]\n]*)?)?\]$"
_PAGES = f"""
docs AS (SELECT DISTINCT doc_path, chr(10) || chr(10) || full_text AS x FROM full_texts WHERE full_text IS NOT NULL),
cut AS (SELECT doc_path, regexp_extract_all(x, '{_MARK}') AS m, regexp_split_to_array(x, '{_MARK}') AS b FROM docs),
pages AS (SELECT doc_path, CAST(regexp_extract(m[i], '{_MARK}', 1) AS INTEGER) AS page_no,
  regexp_replace(regexp_replace(regexp_extract(m[i], '{_MARK}', 2), '^ — ', ''), ': .*', '') AS label,
  regexp_replace(regexp_replace(b[i + 1], '^\\n', ''), '\\n+$', '') AS raw_text FROM cut, unnest(range(1, len(m) + 1)) AS u(i))"""


def _pages(spark, d):
    return pages.split_marked(t(spark, d, "full_texts").select("doc_path", "full_text").distinct(), "doc_path", "full_text")


@query(f"WITH {_PAGES} SELECT doc_path, page_no, label, md5(raw_text) AS hash, CAST(length(raw_text) AS INTEGER) AS size FROM pages")
def page_split(spark, d):
    return _pages(spark, d).select("doc_path", "page_no", "label", F.md5("raw_text").alias("hash"), F.length("raw_text").alias("size"))


@query(f"WITH {_PAGES}, p AS (SELECT doc_path, page_no, {_profile('raw_text')} FROM pages) SELECT doc_path, page_no, nws, {_GATE} AS garbled, nws < 50 OR {_GATE} AS ocr FROM p")
def page_gate(spark, d):
    return pages.gate(_pages(spark, d)).select("doc_path", "page_no", "nws", "garbled", "ocr")


@query(f"""WITH {_PAGES}, p AS (SELECT doc_path, {_profile('raw_text')} FROM pages), g AS (SELECT doc_path, nws >= 50 AS bears, {_GATE} AS garbled FROM p),
a AS (SELECT doc_path, count(*) AS page_count, count(*) FILTER (bears) AS text_pages, count(*) FILTER (bears AND garbled) AS garbled_pages FROM g GROUP BY doc_path)
SELECT *, coalesce(garbled_pages / nullif(text_pages, 0), 0.0) AS ratio, coalesce(garbled_pages / nullif(text_pages, 0), 0.0) > 0.3 AS force_ocr FROM a""")
def garbled_ratio(spark, d):
    return pages.garbled_share(_pages(spark, d), "doc_path")


_PARTS = f"""{_PAGES},
p AS (SELECT doc_path, page_no, label, raw_text, {_profile('raw_text')} FROM pages),
g AS (SELECT *, nws < 50 OR {_GATE} AS ocr FROM p),
parts AS (SELECT doc_path, page_no, ocr AND label <> 'OCR failed' AS ocr_done, CASE WHEN NOT ocr THEN '[Page ' || page_no || ']' || chr(10) || raw_text
  WHEN label = 'OCR failed' THEN '[Page ' || page_no || ' — OCR failed: no text]' ELSE '[Page ' || page_no || ' — OCR]' || chr(10) || raw_text END AS part FROM g)"""


def _parts(spark, d):
    read = _pages(spark, d).withColumn("ocr_text", F.col("raw_text")).withColumn("ocr_error", F.when(F.col("label") == "OCR failed", "no text"))
    return pages.with_parts(read)


@query(f"WITH {_PARTS} SELECT doc_path, page_no, ocr_done, {_n('part', _WS)} AS part_nws, md5(part) AS hash FROM parts")
def page_labels(spark, d):
    return _parts(spark, d).select("doc_path", "page_no", "ocr_done", "part_nws", F.md5("part").alias("hash"))


@query(f"""WITH {_PARTS}, r AS (SELECT doc_path, count(*) AS page_count, string_agg(part, chr(10) || chr(10) ORDER BY page_no, part) AS x, bool_or(ocr_done) AS ocr_used FROM parts GROUP BY doc_path)
SELECT doc_path, page_count, ocr_used, CAST(length(x) AS INTEGER) AS text_length, md5(x) AS hash FROM r""")
def document_text(spark, d):
    return pages.roll_up(_parts(spark, d), "doc_path").select("doc_path", "page_count", "ocr_used", "text_length", F.md5("full_text").alias("hash"))


@query("""SELECT species, count(*) AS n, count(*) FILTER (error = '') AS ok, count(*) FILTER (error <> '') AS failed, CAST(coalesce(sum(page_count), 0) AS BIGINT) AS pages,
 count(*) FILTER (ocr_used) AS with_ocr FROM (SELECT DISTINCT * FROM extraction_log) GROUP BY species""")
def log_summary(spark, d):
    log = t(spark, d, "extraction_log").distinct()
    return log.groupBy("species").agg(
        F.count("*").alias("n"), F.count_if(F.col("error") == "").alias("ok"), F.count_if(F.col("error") != "").alias("failed"), F.coalesce(F.sum("page_count"), F.lit(0)).cast("bigint").alias("pages"), F.count_if("ocr_used").alias("with_ocr"))


_IMAGES = """
img AS (SELECT CAST(l_suppkey AS VARCHAR) AS doc_path, CAST(l_linenumber AS INTEGER) AS page_no, CAST(l_orderkey AS BIGINT) * 1000000 + l_partkey AS seq, CAST(l_partkey % 10 AS INTEGER) AS xref,
 CAST(l_quantity AS INTEGER) * 4 AS width, CAST(l_partkey % 100 AS INTEGER) * 3 AS height, CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_quantity AS INTEGER) * 12.0e0 END AS rect_w,
 700.0e0 AS rect_h, 600.0e0 AS page_w, 800.0e0 AS page_h, CAST(l_orderkey % 600 AS INTEGER) AS page_nws FROM lineitem)"""


def _images(spark, d):
    c, i = F.col, "int"
    return t(spark, d, "lineitem").select(
        c("l_suppkey").cast("string").alias("doc_path"), c("l_linenumber").cast(i).alias("page_no"), (c("l_orderkey").cast("bigint") * 1000000 + c("l_partkey")).alias("seq"), (c("l_partkey") % 10).cast(i).alias("xref"),
        (c("l_quantity").cast(i) * 4).alias("width"), ((c("l_partkey") % 100).cast(i) * 3).alias("height"), F.when(c("l_partkey") % 7 != 0, c("l_quantity").cast(i) * F.lit(12.0)).alias("rect_w"),
        F.lit(700.0).alias("rect_h"), F.lit(600.0).alias("page_w"), F.lit(800.0).alias("page_h"), (c("l_orderkey") % 600).cast(i).alias("page_nws"))


@query(f"WITH {_IMAGES} SELECT count(*) FILTER (width >= 50 AND height >= 50) AS large, count(*) FILTER (width < 50 OR height < 50) AS small FROM img")
def image_size_filter(spark, d):
    return _images(spark, d).agg(F.count_if(pages.large_enough()).alias("large"), F.count_if(~pages.large_enough()).alias("small"))


@query(f"WITH {_IMAGES} SELECT doc_path, page_no, seq, xref FROM img WHERE rect_w >= 0.85e0 * page_w AND rect_h >= 0.85e0 * page_h AND page_nws > 300")
def scan_filter(spark, d):
    return _images(spark, d).filter(pages.page_scan()).select("doc_path", "page_no", "seq", "xref")


@query(f"WITH {_IMAGES} SELECT doc_path, page_no, xref, min(seq) AS seq FROM img GROUP BY doc_path, page_no, xref")
def xref_dedup(spark, d):
    return pages.first_on_page(_images(spark, d)).select("doc_path", "page_no", "xref", "seq")


@query(f"""WITH {_IMAGES}, one AS (SELECT * FROM img QUALIFY row_number() OVER (PARTITION BY doc_path, page_no, xref ORDER BY seq) = 1),
kept AS (SELECT *, row_number() OVER (PARTITION BY doc_path, page_no ORDER BY seq) AS n FROM one WHERE width >= 50 AND height >= 50 AND NOT coalesce(rect_w >= 0.85e0 * page_w AND rect_h >= 0.85e0 * page_h AND page_nws > 300, FALSE))
SELECT doc_path, page_no, seq, CAST(n AS INTEGER) AS image_idx, 'page' || page_no || '_img' || n || '.png' AS image_file FROM kept""")
def images_kept(spark, d):
    return pages.kept_images(_images(spark, d)).select("doc_path", "page_no", "seq", "image_idx", "image_file")


@query(f"""WITH {_PARTS}, {_IMAGES}, r AS (SELECT doc_path, count(*) AS page_count, string_agg(part, chr(10) || chr(10) ORDER BY page_no, part) AS x, bool_or(ocr_done) AS ocr_used FROM parts GROUP BY doc_path),
one AS (SELECT * FROM img QUALIFY row_number() OVER (PARTITION BY doc_path, page_no, xref ORDER BY seq) = 1),
kept AS (SELECT doc_path AS source, count(*) AS n FROM one WHERE width >= 50 AND height >= 50 AND NOT coalesce(rect_w >= 0.85e0 * page_w AND rect_h >= 0.85e0 * page_h AND page_nws > 300, FALSE) GROUP BY doc_path)
SELECT doc_path AS file_path, string_split(doc_path, '/')[2] AS species, CAST(page_count AS INTEGER) AS page_count, CAST(length(x) AS INTEGER) AS text_length, CAST(coalesce(n, 0) AS INTEGER) AS image_count, ocr_used, '' AS error
 FROM r LEFT JOIN kept ON source = CAST(length(doc_path) % 50 + 1 AS VARCHAR)
UNION ALL SELECT DISTINCT file_path, string_split(file_path, '/')[2], CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS BOOLEAN), error FROM extraction_log WHERE error <> ''""")
def extraction_log(spark, d):
    """Every document has the images of one source, chosen by the length of its path."""
    failed = t(spark, d, "extraction_log").filter("error <> ''").select(F.col("file_path").alias("doc_path"), "error").distinct()
    docs = pages.roll_up(_parts(spark, d), "doc_path")
    source = docs.select("doc_path", (F.length("doc_path") % 50 + 1).cast("string").alias("source"))
    images = pages.kept_images(_images(spark, d)).select(F.col("doc_path").alias("source"), "image_file").join(source, "source")
    return pages.extraction_log(docs, images, failed)


# -- chunks -------------------------------------------------------------------------------------------------------------

_LATEST = "latest AS (SELECT * FROM chunks QUALIFY row_number() OVER (PARTITION BY doc_id, chunk_idx ORDER BY loaded_at DESC NULLS LAST, text DESC NULLS LAST) = 1)"
_FIGS = f"""{_LATEST},
figs AS (SELECT doc_id, chunk_idx, CAST(i - 1 AS INTEGER) AS pos, figures[i].caption AS caption, coalesce(figures[i].picture_ref, '') AS picture_ref, figures[i].image_file AS image_file FROM latest, unnest(range(1, len(figures) + 1)) AS u(i))"""
_TABS = f"""{_LATEST},
tabs AS (SELECT doc_id, chunk_idx, CAST(i - 1 AS INTEGER) AS pos, tables[i].caption AS caption, coalesce(tables[i].csv_file, '') AS csv_file FROM latest, unnest(range(1, len(tables) + 1)) AS u(i))"""


def _chunks(spark, d):
    return chunks.latest(t(spark, d, "chunks"))


@query(f"WITH {_LATEST} SELECT doc_id, chunk_idx, md5(text) AS hash FROM latest")
def latest_chunks(spark, d):
    return _chunks(spark, d).select("doc_id", "chunk_idx", F.md5("text").alias("hash"))


@query(f"WITH {_LATEST} SELECT doc_id, count(*) AS total, count(*) FILTER (len(figures) > 0) AS with_figures, count(*) FILTER (len(tables) > 0) AS with_tables FROM latest GROUP BY doc_id")
def chunk_stats(spark, d):
    return chunks.chunk_stats(_chunks(spark, d))


@query(f"WITH {_LATEST}, p AS (SELECT DISTINCT doc_id, unnest(page_numbers) AS p FROM latest) SELECT doc_id, string_agg(CAST(p AS VARCHAR), ',' ORDER BY p) AS pages FROM p WHERE p IS NOT NULL GROUP BY doc_id")
def chunk_pages(spark, d):
    union = F.flatten(F.collect_list(F.coalesce("page_numbers", F.array().cast("array<int>"))))
    return _chunks(spark, d).groupBy("doc_id").agg(F.array_join(text.sorted_pages(union).cast("array<string>"), ",").alias("pages")).filter("pages <> ''")


def _items(spark, d):
    """Pictures and tables of the chunks as items of their documents."""
    latest = _chunks(spark, d)
    order = W.partitionBy("doc_id").orderBy("chunk_idx", "item_type", "pos")
    figs = chunks.figures(latest).select("doc_id", "chunk_idx", F.lit("PictureItem").alias("item_type"), "pos", "caption", F.col("picture_ref").alias("self_ref"))
    tabs = chunks.tables(latest).select("doc_id", "chunk_idx", F.lit("TableItem").alias("item_type"), "pos", "caption", F.concat_ws("/", F.lit("#/tables"), "chunk_idx", "pos").alias("self_ref"))
    rows = figs.unionByName(tabs).join(latest.select("doc_id", "chunk_idx", F.col("page_numbers").alias("page_nos")), ["doc_id", "chunk_idx"])
    return rows.withColumn("item_ord", F.row_number().over(order)).withColumn("label", F.lit("")).withColumn("text", F.lit(None).cast("string"))


_ITEMS = f"""{_FIGS}, {_TABS[len(_LATEST) + 1:]},
mixed AS (SELECT doc_id, chunk_idx, 'PictureItem' AS item_type, pos, caption, picture_ref AS self_ref FROM figs UNION ALL SELECT doc_id, chunk_idx, 'TableItem', pos, caption, '#/tables/' || chunk_idx || '/' || pos FROM tabs),
items AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_idx, item_type, pos) AS item_ord FROM mixed),
ordinals AS (SELECT items.*, row_number() OVER (PARTITION BY doc_id, item_type ORDER BY item_ord) AS ordinal FROM items)"""


@query(f"""WITH {_ITEMS}, s AS (SELECT *, CASE WHEN coalesce(caption, '') = '' THEN 'table_' || ordinal ELSE {_slug('caption')} END AS slug FROM ordinals WHERE item_type = 'TableItem')
SELECT doc_id, self_ref, CAST(ordinal AS INTEGER) AS ordinal, slug, 'tables/' || slug || '.csv' AS csv_file FROM s""")
def table_slugs(spark, d):
    return items.table_files(_items(spark, d)).select("doc_id", "self_ref", "ordinal", "slug", "csv_file")


_TABLE_FILES = f"""{_ITEMS}, tf AS (SELECT o.*, CASE WHEN coalesce(o.caption, '') = '' THEN 'table_' || ordinal ELSE {_slug('o.caption')} END AS slug, list_min(list_filter(l.page_numbers, lambda x: x IS NOT NULL)) AS page_number, l.headings, l.page_numbers
 FROM ordinals o JOIN latest l USING (doc_id, chunk_idx) WHERE item_type = 'TableItem')"""


@query(f"WITH {_TABLE_FILES} SELECT doc_id, self_ref, page_number, coalesce(nullif(left(caption, 80), ''), '(no caption)') AS shown FROM tf")
def table_listing(spark, d):
    return items.table_files(_items(spark, d)).select("doc_id", "self_ref", "page_number", text.display("caption", 80).alias("shown"))


def _sources(spark, d):
    return _latest_metadata(spark, d).select("doc_id", paths.name("original_pdf_path").alias("source_file"), paths.species("original_pdf_path").alias("species"))


def _table_data(spark, d):
    """A row of caption, chunk and headings for every table; none where the chunk has no pages."""
    tabs = chunks.tables(_chunks(spark, d)).join(_chunks(spark, d).select("doc_id", "chunk_idx", "headings", "page_numbers"), ["doc_id", "chunk_idx"])
    has = F.col("page_numbers").isNotNull()
    row = F.array("caption", F.col("chunk_idx").cast("string"), F.array_join(F.coalesce("headings", F.array().cast("array<string>")), ", "))
    return tabs.select("doc_id", F.concat_ws("/", F.lit("#/tables"), "chunk_idx", "pos").alias("self_ref"), F.when(has, F.array(F.lit("caption"), F.lit("chunk"), F.lit("all, headings"))).alias("header"), F.when(has, F.array(row)).alias("cells"), F.when(~has, "no pages").alias("error"))


_CSV = """CASE WHEN regexp_matches({x}, '[",\n\r]') THEN '"' || replace({x}, '"', '""') || '"' ELSE coalesce({x}, '') END"""
_SOURCES = f"src AS (SELECT doc_id, regexp_extract(original_pdf_path, '[^/]*$') AS source_file, string_split(original_pdf_path, '/')[-2] AS species FROM ({_LATEST_META}))"


@query(f"""WITH {_TABLE_FILES}, {_SOURCES} SELECT doc_id, self_ref, 'tables/' || slug || '.csv' AS csv_file, page_numbers IS NOT NULL AS ok,
 CASE WHEN page_numbers IS NOT NULL THEN 'caption,chunk,"all, headings"' || chr(10) || {_CSV.format(x='caption')} || ',' || chunk_idx || ',' || {_CSV.format(x="array_to_string(headings, ', ')")} || chr(10) END AS csv,
 CASE WHEN page_numbers IS NOT NULL THEN to_json({{'caption': coalesce(caption, ''), 'page_number': page_number, 'rows': 1, 'cols': 3, 'source_file': source_file, 'species': src.species}}) :: VARCHAR END AS meta FROM tf LEFT JOIN src USING (doc_id)""")
def table_export(spark, d):
    return export.tables(_items(spark, d), _table_data(spark, d), _sources(spark, d)).select("doc_id", "self_ref", "csv_file", "ok", "csv", "meta")


@query(f"WITH {_TABLE_FILES} SELECT doc_id, count(*) AS total, count(*) FILTER (page_numbers IS NOT NULL) AS ok, count(*) FILTER (page_numbers IS NULL) AS fail FROM tf GROUP BY doc_id")
def table_export_stats(spark, d):
    return export.export_stats(export.tables(_items(spark, d), _table_data(spark, d), _sources(spark, d)))


def _picture_data(spark, d):
    """The reference as content for every picture with an image file; an error for references that end in 7."""
    figs = chunks.figures(_chunks(spark, d)).groupBy("doc_id", F.col("picture_ref").alias("self_ref")).agg(F.max("image_file").alias("f"))
    return figs.select("doc_id", "self_ref", F.when(F.col("f") != "", F.col("self_ref").cast("binary")).alias("content"), F.when(F.endswith("self_ref", F.lit("7")), "unreadable").alias("error"))


_PICTURE_FILES = f"""{_ITEMS}, pf AS (SELECT o.*, CASE WHEN coalesce(o.caption, '') = '' THEN 'figure_' || ordinal ELSE {_slug('o.caption')} END AS slug, list_min(list_filter(l.page_numbers, lambda x: x IS NOT NULL)) AS page_number
 FROM ordinals o JOIN latest l USING (doc_id, chunk_idx) WHERE item_type = 'PictureItem')"""


@query(f"WITH {_PICTURE_FILES} SELECT doc_id, count(*) AS total, count(*) FILTER (NOT self_ref LIKE '%7') AS ok, count(*) FILTER (self_ref LIKE '%7') AS fail FROM pf GROUP BY doc_id")
def picture_export_stats(spark, d):
    return export.export_stats(export.pictures(_items(spark, d), _picture_data(spark, d), _sources(spark, d)))


@query(f"""WITH {_PICTURE_FILES}, {_SOURCES}, w AS (SELECT doc_id, slug, arg_max(struct_pack(caption := coalesce(caption, ''), page_number := page_number, picture_ref := self_ref), ordinal) AS x FROM pf WHERE NOT self_ref LIKE '%7' GROUP BY doc_id, slug)
SELECT doc_id, slug || '_meta.json' AS name, x.caption AS caption, x.page_number AS page_number, x.picture_ref AS picture_ref, source_file, src.species AS species, 'images/' || replace(max(slug || '_meta.json') OVER (PARTITION BY doc_id, x.picture_ref), '_meta.json', '.png') AS image_file FROM w LEFT JOIN src USING (doc_id)""")
def sidecar_files(spark, d):
    """The pictures' sidecars written as files, under names of any script, and read again."""
    at = _folder(spark, "sidecars")
    made = export.on_disk(export.pictures(_items(spark, d), _picture_data(spark, d), _sources(spark, d)), "meta_path")
    sinks.write_files(made.select(F.concat_ws("/", "doc_id", "meta_path").alias("path"), F.col("meta").alias("content")), at).count()
    read = files.read_sidecars(spark, at).filter("NOT bad").withColumn("doc_id", F.element_at(F.split("meta_path", "/"), -3))
    found = chunks.image_files(read)
    return read.join(found, ["doc_id", "picture_ref"]).select("doc_id", F.element_at(F.split("meta_path", "/"), -1).alias("name"), "caption", "page_number", "picture_ref", "source_file", "species", F.col("found").alias("image_file"))


@query(f"""WITH {_ITEMS}, s AS (SELECT *, CASE WHEN coalesce(caption, '') = '' THEN 'table_' || ordinal ELSE {_slug('caption')} END AS slug FROM ordinals WHERE item_type = 'TableItem')
SELECT doc_id, slug, count(*) AS writers, arg_max(self_ref, ordinal) AS self_ref FROM s GROUP BY doc_id, slug""")
def slug_collisions(spark, d):
    return items.written(items.table_files(_items(spark, d))).select("doc_id", "slug", "writers", "self_ref")


@query(f"""WITH {_ITEMS}, s AS (SELECT *, CASE WHEN coalesce(caption, '') = '' THEN 'figure_' || ordinal ELSE {_slug('caption')} END AS slug FROM ordinals WHERE item_type = 'PictureItem')
SELECT doc_id, self_ref AS picture_ref, CAST(ordinal AS INTEGER) AS ordinal, 'images/' || slug || '.png' AS image_file, 'images/' || slug || '_meta.json' AS meta_path FROM s""")
def picture_sidecars(spark, d):
    return items.picture_files(_items(spark, d)).select("doc_id", "picture_ref", "ordinal", "image_file", "meta_path")


@query(f"WITH {_ITEMS} SELECT doc_id, caption, arg_max(self_ref, item_ord) AS picture_ref, CAST(min(item_ord) AS INTEGER) AS pos FROM items WHERE item_type = 'PictureItem' AND caption <> '' GROUP BY doc_id, caption")
def caption_lookup(spark, d):
    return items.captions(_items(spark, d))


@query(f"""WITH {_ITEMS}, caps AS (SELECT doc_id, caption, arg_max(self_ref, item_ord) AS picture_ref FROM items WHERE item_type = 'PictureItem' AND caption <> '' GROUP BY doc_id, caption)
SELECT f.doc_id, f.chunk_idx, f.pos, f.caption, c.picture_ref FROM figs f JOIN caps c ON c.doc_id = f.doc_id AND c.caption = f.caption""")
def caption_exact_link(spark, d):
    made = items.captions(_items(spark, d)).drop("pos")
    return chunks.figures(_chunks(spark, d)).drop("picture_ref").join(made, ["doc_id", "caption"]).select("doc_id", "chunk_idx", "pos", "caption", "picture_ref")


_CAPS = "caps AS (SELECT doc_id, caption, arg_max(self_ref, item_ord) AS picture_ref, min(item_ord) AS pos FROM items WHERE item_type = 'PictureItem' AND caption <> '' GROUP BY doc_id, caption)"
_LINKS = f"""{_ITEMS}, {_CAPS},
links AS (SELECT l.doc_id, l.chunk_idx, c.pos, c.caption, c.picture_ref FROM latest l JOIN caps c ON c.doc_id = l.doc_id WHERE l.text <> '' AND (contains(l.text, c.caption) OR contains(c.caption, l.text))
  AND NOT EXISTS (SELECT 1 FROM figs f WHERE f.doc_id = l.doc_id AND f.chunk_idx = l.chunk_idx AND f.picture_ref = c.picture_ref))"""


def _phrases(spark, d):
    """The captions of all pictures, and every heading of every chunk, whole."""
    rows = _chunks(spark, d).select("doc_id", F.explode("headings").alias("caption"), F.col("chunk_idx").alias("pos")).filter("caption <> ''")
    made = rows.groupBy("doc_id", "caption").agg(F.concat(F.lit("#/pictures/"), F.max("pos").cast("string")).alias("picture_ref"), F.min("pos").alias("pos"))
    return made.unionByName(items.captions(_items(spark, d)))


def _spoilt(spark, d):
    """The captions of all pictures, and every heading of every chunk, whole, with one character read wrongly."""
    rows = _chunks(spark, d).select("doc_id", F.explode("headings").alias("h"), F.col("chunk_idx").alias("pos"), F.concat(F.lit("#/pictures/"), F.col("chunk_idx").cast("string")).alias("ref"))
    rows = rows.filter("h <> ''").withColumn("caption", F.overlay("h", F.lit("#"), F.ceil(F.length("h") / 2).cast("int"), F.lit(1)))
    made = rows.groupBy("doc_id", "caption").agg(F.max_by("ref", "pos").alias("picture_ref"), F.min("pos").alias("pos"))
    return made.unionByName(items.captions(_items(spark, d)))


@query(f"""WITH {_ITEMS}, {_CAPS},
heads AS (SELECT doc_id, h AS caption, '#/pictures/' || max(chunk_idx) AS picture_ref, min(chunk_idx) AS pos FROM (SELECT doc_id, chunk_idx, unnest(headings) AS h FROM latest) WHERE h <> '' GROUP BY doc_id, h),
both_ AS (SELECT doc_id, caption, picture_ref, pos FROM heads UNION ALL SELECT doc_id, caption, picture_ref, pos FROM caps)
SELECT l.doc_id, l.chunk_idx, CAST(c.pos AS INTEGER) AS pos, c.caption, c.picture_ref FROM latest l JOIN both_ c ON c.doc_id = l.doc_id WHERE l.text <> '' AND (contains(l.text, c.caption) OR contains(c.caption, l.text))
 AND NOT EXISTS (SELECT 1 FROM figs f WHERE f.doc_id = l.doc_id AND f.chunk_idx = l.chunk_idx AND f.picture_ref = c.picture_ref)""")
def caption_contains_link(spark, d):
    return chunks.fuzzy_links(_chunks(spark, d), _phrases(spark, d), 100).drop("score")


@query()
def caption_fuzzy_link(spark, d):
    """Best alignment of 85 and more with captions and spoilt headings; SQL has no such score."""
    return chunks.fuzzy_links(_chunks(spark, d), _spoilt(spark, d))


@query(f"WITH {_FIGS} SELECT doc_id, chunk_idx, picture_ref, min(pos) AS pos FROM figs GROUP BY doc_id, chunk_idx, picture_ref")
def dedup_in_chunk(spark, d):
    """The figures that stay, with their places before the others went."""
    before = chunks.figures(_chunks(spark, d)).groupBy("doc_id", "chunk_idx", "picture_ref").agg(F.min("pos").alias("pos"))
    after = chunks.figures(chunks.dedup_in_chunk(_chunks(spark, d))).drop("pos", "caption", "image_file")
    return after.join(before, ["doc_id", "chunk_idx", "picture_ref"]).select("doc_id", "chunk_idx", "picture_ref", "pos")


@query(f"WITH {_TABS} SELECT doc_id, chunk_idx, csv_file, count(*) FILTER (pos = p) AS kept FROM (SELECT *, min(pos) OVER (PARTITION BY doc_id, chunk_idx, csv_file) AS p FROM tabs) GROUP BY doc_id, chunk_idx, csv_file")
def dedup_tables_in_chunk(spark, d):
    return chunks.tables(chunks.dedup_in_chunk(_chunks(spark, d))).groupBy("doc_id", "chunk_idx", "csv_file").agg(F.count("*").alias("kept"))


@query(f"""WITH {_FIGS} SELECT doc_id, chunk_idx, picture_ref, caption, image_file FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, picture_ref ORDER BY chunk_idx, pos) AS n FROM figs) WHERE n = 1 OR picture_ref = ''""")
def dedup_cross_chunk(spark, d):
    return chunks.figures(chunks.dedup_across(_chunks(spark, d))).select("doc_id", "chunk_idx", "picture_ref", "caption", "image_file")


def _sidecars(spark, d):
    """A sidecar for each picture of the chunks, and for every even page one of a picture that no chunk holds."""
    latest = _chunks(spark, d)
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1)
    own = chunks.figures(latest).filter("picture_ref <> ''").groupBy("doc_id", "picture_ref").agg(F.max(F.coalesce("caption", F.lit(""))).alias("caption"))
    own = own.select("doc_id", F.concat(F.lit("images/figure_"), number("picture_ref"), F.lit("_meta.json")).alias("meta_path"), "caption", F.lit(None).cast("int").alias("page_number"), "picture_ref")
    page = latest.select("doc_id", F.explode("page_numbers").alias("page_number")).filter("page_number % 2 = 0").distinct()
    no = (F.col("page_number") + 900).cast("string")
    loose = page.select("doc_id", F.concat(F.lit("images/figure_"), no, F.lit("_meta.json")).alias("meta_path"), F.lit(" ").alias("caption"), "page_number", F.concat(F.lit("#/pictures/"), no).alias("picture_ref"))
    return own.unionByName(loose)


_SIDE = """
side AS (SELECT doc_id, 'images/figure_' || regexp_extract(picture_ref, '(\\d+)$', 1) || '_meta.json' AS meta_path, max(coalesce(caption, '')) AS caption, CAST(NULL AS INTEGER) AS page_number, picture_ref FROM figs WHERE picture_ref <> '' GROUP BY doc_id, picture_ref
 UNION ALL SELECT DISTINCT doc_id, 'images/figure_' || (p + 900) || '_meta.json', ' ', p, '#/pictures/' || (p + 900) FROM (SELECT doc_id, unnest(page_numbers) AS p FROM latest) WHERE p % 2 = 0),
found AS (SELECT doc_id, picture_ref, replace(arg_max(meta_path, meta_path), '_meta.json', '.png') AS found FROM side GROUP BY doc_id, picture_ref)"""


@query(f"WITH {_FIGS}, {_SIDE} SELECT f.doc_id, chunk_idx, pos, f.picture_ref, coalesce(nullif(image_file, ''), found) AS image_file FROM figs f LEFT JOIN found USING (doc_id, picture_ref)")
def resolve_images(spark, d):
    return chunks.figures(chunks.resolve_images(_chunks(spark, d), _sidecars(spark, d))).select("doc_id", "chunk_idx", "pos", "picture_ref", "image_file")


_FALL = """
loose AS (SELECT * FROM side WHERE trim(caption) = '' AND picture_ref <> '' AND NOT EXISTS (SELECT 1 FROM figs f WHERE f.doc_id = side.doc_id AND f.picture_ref = side.picture_ref)),
firsts AS (SELECT doc_id, p AS page_number, min(chunk_idx) AS chunk_idx FROM (SELECT doc_id, chunk_idx, unnest(page_numbers) AS p FROM latest) GROUP BY doc_id, p),
fall AS (SELECT doc_id, picture_ref, arg_min(chunk_idx, meta_path) AS chunk_idx, min(meta_path) AS meta_path FROM loose JOIN firsts USING (doc_id, page_number) GROUP BY doc_id, picture_ref)"""


@query(f"WITH {_FIGS}, {_SIDE}, {_FALL} SELECT doc_id, chunk_idx, meta_path, '' AS caption, picture_ref, replace(meta_path, '_meta.json', '.png') AS image_file FROM fall")
def fallback_inject(spark, d):
    return chunks.fallback_links(_chunks(spark, d), _sidecars(spark, d))


_POST = f"""{_LINKS}, {_SIDE}, {_FALL},
united AS (SELECT doc_id, chunk_idx, 0 AS src, pos, caption, picture_ref, image_file FROM figs UNION ALL SELECT doc_id, chunk_idx, 1, min(pos), arg_min(caption, struct_pack(p := pos, c := caption)), picture_ref, NULL FROM links GROUP BY doc_id, chunk_idx, picture_ref),
res AS (SELECT u.*, coalesce(nullif(image_file, ''), found) AS img FROM united u LEFT JOIN found USING (doc_id, picture_ref)),
inchunk AS (SELECT * FROM res QUALIFY row_number() OVER (PARTITION BY doc_id, chunk_idx, picture_ref ORDER BY src, pos) = 1),
across_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, picture_ref ORDER BY chunk_idx, src, pos) AS n FROM inchunk) WHERE n = 1 OR picture_ref = '')"""


def _post(spark, d):
    """With the default threshold. SQL finds captions that stand in the text word for word; no caption of these tables scores between the threshold and that."""
    return chunks.postprocess(_chunks(spark, d), items.captions(_items(spark, d)), _sidecars(spark, d))


@query(f"""WITH {_POST}, every_ AS (SELECT doc_id, chunk_idx, src, pos, '' AS meta_path, caption, picture_ref, img AS image_file FROM across_ UNION ALL SELECT doc_id, chunk_idx, 2, 0, meta_path, '', picture_ref, replace(meta_path, '_meta.json', '.png') FROM fall)
SELECT doc_id, chunk_idx, CAST(row_number() OVER (PARTITION BY doc_id, chunk_idx ORDER BY src, pos, meta_path, caption) - 1 AS INTEGER) AS pos, caption, picture_ref, image_file FROM every_""")
def postprocess(spark, d):
    return chunks.figures(_post(spark, d)["chunks"]).select("doc_id", "chunk_idx", "pos", "caption", "picture_ref", "image_file")


@query(f"""WITH {_POST}, z AS (SELECT doc_id, sum(CAST(coalesce(img, '') <> '' AS INT)) - sum(CAST(coalesce(image_file, '') <> '' AS INT)) AS r FROM res GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(a.n, 0) AS BIGINT) AS fuzzy_injected, CAST(coalesce(z.r, 0) AS BIGINT) AS image_files_resolved, CAST(coalesce(b.n, 0) - coalesce(c.n, 0) AS BIGINT) AS cross_chunk_removed, CAST(coalesce(e.n, 0) AS BIGINT) AS fallback_injected
FROM (SELECT DISTINCT doc_id FROM latest) d LEFT JOIN (SELECT doc_id, count(*) AS n FROM united WHERE src = 1 GROUP BY doc_id) a USING (doc_id) LEFT JOIN z USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM inchunk GROUP BY doc_id) b USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM across_ GROUP BY doc_id) c USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM fall GROUP BY doc_id) e USING (doc_id)""")
def postprocess_stats(spark, d):
    return _post(spark, d)["stats"]


@query(f"""WITH {_ITEMS} SELECT l.doc_id, l.total, l.with_figures, l.with_tables, count(*) FILTER (item_type = 'PictureItem') AS pictures, count(*) FILTER (item_type = 'TableItem') AS tables
FROM (SELECT doc_id, count(*) AS total, count(*) FILTER (len(figures) > 0) AS with_figures, count(*) FILTER (len(tables) > 0) AS with_tables FROM latest GROUP BY doc_id) l LEFT JOIN items USING (doc_id) GROUP BY ALL""")
def run_summary(spark, d):
    counted = _items(spark, d).groupBy("doc_id").agg(F.count_if(F.col("item_type") == "PictureItem").alias("pictures"), F.count_if(F.col("item_type") == "TableItem").alias("tables"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return chunks.chunk_stats(_chunks(spark, d)).join(counted, "doc_id", "left").select("doc_id", "total", "with_figures", "with_tables", zero("pictures"), zero("tables"))


@query()
def chunks_json(spark, d):
    """Fields without a value are left out, which the SQL engine's JSON doesn't do."""
    return chunks.to_json(_chunks(spark, d))


def _documents(spark, d):
    """Items with the pictures' captions as texts of their own, one chunk further, where there is one."""
    made = _items(spark, d)
    texts = chunks.figures(_chunks(spark, d)).filter("caption <> ''").select("doc_id", (F.col("chunk_idx") + 1).alias("chunk_idx"), F.lit("TextItem").alias("item_type"), "pos", F.lit(None).cast("string").alias("caption"), F.concat_ws("/", F.lit("#/texts"), "chunk_idx", "pos").alias("self_ref"), F.lit("Caption").alias("label"), F.col("caption").alias("text"))
    texts = texts.join(_chunks(spark, d).select("doc_id", "chunk_idx", F.col("page_numbers").alias("page_nos")), ["doc_id", "chunk_idx"])
    order = W.partitionBy("doc_id").orderBy("chunk_idx", "item_type", "pos")
    return made.drop("item_ord").unionByName(texts).withColumn("item_ord", F.row_number().over(order))


def _built(spark, d):
    made = _documents(spark, d)
    words = _chunks(spark, d).select("doc_id", "chunk_idx", F.col("text").alias("chunk_text"), "headings")
    return items.build_chunks(made.select("doc_id", "chunk_idx", "item_ord").join(words, ["doc_id", "chunk_idx"]), made.drop("chunk_idx", "pos"))


@query(f"""WITH {_ITEMS},
more AS (SELECT doc_id, chunk_idx, item_type, pos, caption, self_ref, '' AS label, NULL AS text FROM mixed UNION ALL SELECT f.doc_id, f.chunk_idx + 1, 'TextItem', f.pos, NULL, '#/texts/' || f.chunk_idx || '/' || f.pos, 'Caption', f.caption FROM figs f JOIN latest l ON l.doc_id = f.doc_id AND l.chunk_idx = f.chunk_idx + 1 WHERE f.caption <> ''),
docs AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_idx, item_type, pos) AS item_no, row_number() OVER (PARTITION BY doc_id, item_type ORDER BY chunk_idx, item_type, pos) AS ordinal FROM more),
caps AS (SELECT doc_id, caption, arg_max(self_ref, item_no) AS ref FROM docs WHERE item_type = 'PictureItem' AND caption <> '' GROUP BY doc_id, caption),
refs AS (SELECT doc_id, chunk_idx, item_no, coalesce(caption, '') AS caption, self_ref AS ref FROM docs WHERE item_type = 'PictureItem' UNION ALL SELECT d.doc_id, chunk_idx, item_no, d.text, ref FROM docs d JOIN caps c ON c.doc_id = d.doc_id AND c.caption = d.text WHERE label = 'Caption'),
fig AS (SELECT doc_id, chunk_idx, string_agg(caption || '>' || ref, '|' ORDER BY item_no) AS figures FROM (SELECT * FROM refs QUALIFY row_number() OVER (PARTITION BY doc_id, chunk_idx, ref ORDER BY item_no) = 1) GROUP BY doc_id, chunk_idx),
tab AS (SELECT doc_id, chunk_idx, string_agg(coalesce(caption, '') || '>tables/' || CASE WHEN coalesce(caption, '') = '' THEN 'table_' || ordinal ELSE {_slug('caption')} END || '.csv', '|' ORDER BY item_no) AS tables FROM docs WHERE item_type = 'TableItem' GROUP BY doc_id, chunk_idx),
base AS (SELECT doc_id, chunk_idx, string_agg(item_type, '|' ORDER BY item_no) AS item_types FROM docs GROUP BY doc_id, chunk_idx)
SELECT doc_id, chunk_idx, md5(text) AS hash, array_to_string(headings, '|') AS headings, base.item_types, coalesce(array_to_string(list_sort(list_distinct(list_filter(page_numbers, lambda x: x IS NOT NULL))), '|'), '') AS pages, coalesce(fig.figures, '') AS figures, coalesce(tab.tables, '') AS tables
FROM base JOIN latest USING (doc_id, chunk_idx) LEFT JOIN fig USING (doc_id, chunk_idx) LEFT JOIN tab USING (doc_id, chunk_idx)""")
def build_chunks(spark, d):
    """Chunks built again from the items, caption texts among them, and where they stood."""
    join = lambda c, f: F.array_join(F.transform(c, f), "|").alias(c)
    pages_ = F.array_join(F.col("page_numbers").cast("array<string>"), "|").alias("pages")
    return _built(spark, d).select(
        "doc_id", "chunk_idx", F.md5("text").alias("hash"), F.array_join("headings", "|").alias("headings"), F.array_join("item_types", "|").alias("item_types"), pages_,
        join("figures", lambda x: F.concat_ws(">", x["caption"], x["picture_ref"])), join("tables", lambda x: F.concat_ws(">", x["caption"], x["csv_file"])))


@query()
def process_summary(spark, d):
    """A whole run over every document: exports, chunks, post-processing and the counts of each."""
    made = _documents(spark, d)
    words = _chunks(spark, d).select("doc_id", "chunk_idx", F.col("text").alias("chunk_text"), "headings")
    placed = made.select("doc_id", "chunk_idx", "item_ord").join(words, ["doc_id", "chunk_idx"])
    meta = _latest_metadata(spark, d)
    return export.process(made.drop("chunk_idx", "pos"), placed, _table_data(spark, d), _picture_data(spark, d), meta.select("doc_id", "page_count"), meta.select("doc_id", F.col("original_pdf_path").alias("path")))["summary"]


# -- catalog ------------------------------------------------------------------------------------------------------------


def _catalog(spark, d):
    """A page of HTML for every record."""
    v = lambda c: F.coalesce(c, F.lit(""))
    row = lambda name, c: F.concat(F.lit(f"<tr><td class='k'>{name}:</td>\n<td> "), v(c), F.lit(" </td></tr>\n"))
    link = F.concat(F.lit("<tr><td>PDF</td><td>\n<a href=\"https://files.example.org/"), "original_pdf_path", F.lit('">1</a> <a class="x" href="/'), "doc_id", F.lit('?a=1">2</a></td></tr><tr><td>More</td><td><a href="about.html">?</a></td></tr>'))
    html = F.concat(F.lit("<html><table>"), row("Author", "author"), row("Year", "year"), row("Title", "title"), link, F.lit("</table></html>"))
    return _latest_metadata(spark, d).select("doc_id", "species", html.alias("html"))


@query(f"SELECT doc_id, nullif({_strip('author')}, '') AS author, nullif({_strip('year')}, '') AS year, nullif({_strip('title')}, '') AS title, 'https://files.example.org/' || original_pdf_path || '|/' || doc_id || '?a=1|about.html' AS hrefs FROM ({_LATEST_META})")
def catalog_fields(spark, d):
    return catalog.fields(_catalog(spark, d)).select("doc_id", "author", "year", "title", F.array_join("hrefs", "|").alias("hrefs"))


@query(f"SELECT doc_id, 1 AS pdf_ord, 'https://files.example.org/' || original_pdf_path AS pdf_url FROM ({_LATEST_META}) UNION ALL SELECT doc_id, 2, '/' || doc_id || '?a=1' FROM ({_LATEST_META})")
def catalog_links(spark, d):
    return catalog.links(_catalog(spark, d).drop("species")).select("doc_id", "pdf_ord", "pdf_url")


def _genus(spark, d):
    """A catalog page for every species and first digit of a digest, its references in the tenth block."""
    link = F.concat(F.lit('<strong><a class="r" href="/ref/'), "doc_id", F.lit('">x</a></strong>'))
    rows = _latest_metadata(spark, d).filter("species IS NOT NULL").groupBy("species", F.substring(F.md5("doc_id"), 1, 1).alias("k")).agg(F.array_join(F.array_sort(F.collect_list(link)), " ").alias("links"))
    return rows.select(F.concat(F.lit('<div class="a species-title">\n<em>'), F.col("species"), F.lit("</em></div>"), F.lit('<div class="tax-ref"></div>' * 9 + '<div class="tax-ref">'), "links", F.lit("</div>")).alias("html"))


def _crawled(spark, d):
    pages_ = _catalog(spark, d).select(F.concat(F.lit("https://example.org/ref/"), "doc_id").alias("url"), "html")
    m = _latest_metadata(spark, d).filter("ocr_used")
    there = m.select(F.concat_ws("/", F.lit("pdfs"), catalog.folder("species"), F.concat(text.base_name("author", "year", "title"), F.lit(".pdf"))).alias("path"))
    return catalog.crawl(_genus(spark, d), pages_, there, "https://example.org/", "pdfs")


_CRAWL = rf"""
m AS (SELECT *, nullif({_strip('author')}, '') AS a, nullif({_strip('year')}, '') AS y, nullif({_strip('title')}, '') AS t FROM ({_LATEST_META})),
o AS (SELECT *, row_number() OVER (PARTITION BY species, left(md5(doc_id), 1) ORDER BY doc_id) - 1 AS ref_ord FROM m WHERE species IS NOT NULL),
b AS (SELECT *, regexp_replace(replace(a || '_' || y || '_' || t, ' ', '_'), '[^\p{{L}}\p{{N}}_\-]', '', 'g') AS base FROM o WHERE a IS NOT NULL AND y IS NOT NULL AND t IS NOT NULL),
l AS (SELECT *, unnest([1, 2]) AS pdf_ord FROM b),
n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY ref_ord, pdf_ord, doc_id) - 1 AS copy_no FROM l),
f AS (SELECT *, CASE WHEN copy_no > 0 THEN '_' || copy_no ELSE '' END || '.pdf' AS ending FROM n),
g AS (SELECT *, 'pdfs/' || replace(species, ' ', '_') || '/' || CASE WHEN strlen(base || ending) > 255 THEN left(base, list_max(list_filter(range(0, 246), lambda i: strlen(left(base, i)) <= 245))) ELSE base END || ending AS path FROM f),
p AS (SELECT DISTINCT 'pdfs/' || replace(species, ' ', '_') || '/' || {_BASE} || '.pdf' AS path FROM ({_LATEST_META}) WHERE ocr_used)"""


@query(f"""WITH {_CRAWL} SELECT replace(species, ' ', '_') AS species, 'https://example.org/ref/' || doc_id AS ref_url, pdf_ord, base, CAST(copy_no AS INTEGER) AS copy_no, path, path IN (SELECT path FROM p WHERE path IS NOT NULL) AS there FROM g""")
def crawl_files(spark, d):
    return _crawled(spark, d)[0].select("species", "ref_url", "pdf_ord", "base", "copy_no", "path", "there")


@query(f"""WITH {_CRAWL}, e AS (SELECT DISTINCT replace(species, ' ', '_') AS s FROM o WHERE a IS NULL OR y IS NULL OR t IS NULL)
SELECT (SELECT count(DISTINCT species) FROM o) AS species_processed, (SELECT count(DISTINCT species) FROM o) AS species_total, (SELECT count(*) FROM g) AS files, (SELECT count(*) FROM g WHERE path IN (SELECT path FROM p WHERE path IS NOT NULL)) AS already_there,
 (SELECT coalesce(string_agg(s, ', ' ORDER BY s), '') FROM e) AS folders""")
def crawl_summary(spark, d):
    return _crawled(spark, d)[1]


@query("SELECT doc_id, species FROM metadata WHERE species IN (SELECT species FROM documents GROUP BY species HAVING count(*) >= 10)")
def species_filter(spark, d):
    names = t(spark, d, "documents").groupBy("species").count().filter("count >= 10").select("species")
    return catalog.allowed(t(spark, d, "metadata").select("doc_id", "species"), names).select("doc_id", "species")


@query("SELECT DISTINCT original_pdf_path AS path FROM metadata WHERE original_pdf_path NOT IN (SELECT file_path FROM extraction_log WHERE error = '' AND file_path IS NOT NULL)")
def skip_existing(spark, d):
    done = t(spark, d, "extraction_log").filter("error = ''").select(F.col("file_path").alias("path"))
    return catalog.to_fetch(_files(spark, d).distinct(), done)


@query(f"""WITH x AS (SELECT species, doc_id, row_number() OVER (PARTITION BY species, left(md5(doc_id), 1) ORDER BY doc_id) - 1 AS ref_ord FROM ({_LATEST_META}) WHERE species IS NOT NULL)
SELECT species, CAST(ref_ord AS INTEGER) AS ref_ord, 'https://example.org/ref/' || doc_id AS ref_url FROM x""")
def reference_blocks(spark, d):
    """References of every species title, from the block nine places further on its page."""
    return catalog.references(_genus(spark, d), "https://example.org").select("species", "ref_ord", "ref_url")


@query("""WITH e AS (SELECT DISTINCT species, file_path FROM extraction_log WHERE error <> ''), f AS (SELECT species, min(file_path) AS p FROM e GROUP BY species)
SELECT coalesce(string_agg(species, ', ' ORDER BY p), '') AS folders FROM f""")
def failed_folders(spark, d):
    return catalog.failed_folders(t(spark, d, "extraction_log").filter("error <> ''").select("species", F.col("file_path").alias("ord")))
