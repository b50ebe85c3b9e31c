"""The queries of this package over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.staging import stage

from . import bpe, copies, language, mojibake, neardup, packing, scan, spans, split


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """A table that comes as one split (a small file of one row group) is dealt out, so that Python work isn't done by one task; any other stays as it lies."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if df.rdd.getNumPartitions() == 1 else df


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _spread(_t(spark, sf_dir, "chunks").select("doc_id", "chunk_idx", "text"))
    return split.split_oversized(chunks).filter("n_pieces > 1").select("doc_id", "chunk_idx").distinct()


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every chunk text; a key written again with another text keeps each version, under the digest of the text."""
    chunks = _spread(_t(spark, sf_dir, "chunks").select("doc_id", "chunk_idx", "text")).withColumn("version", F.md5("text"))
    pieces = split.split_oversized(chunks).select("doc_id", "chunk_idx", "version", "piece_idx", "start", "end", "piece", "n_pieces")
    return pieces.dropDuplicates(["doc_id", "chunk_idx", "version", "piece_idx"])


def _samples(spark: SparkSession, sf_dir: str) -> list[str]:
    return [text for _, text in mojibake.bounded_samples(_t(spark, sf_dir, "lang_refs"), None, "sample")]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = _spread(_t(spark, sf_dir, "full_texts").select("doc_id", "full_text"))
    return scan.clean(full, samples=_samples(spark, sf_dir), with_text=False).filter("noisy").select("doc_id").distinct()


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The noisy records as continuous paragraphs."""
    full = _spread(_t(spark, sf_dir, "full_texts").select("doc_id", "full_text"))
    return scan.clean(full, samples=_samples(spark, sf_dir), only_noisy=True).filter("noisy").select("doc_id", "evidence", "paragraphs").distinct()


def _language_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    full, refs = _t(spark, sf_dir, "full_texts"), _t(spark, sf_dir, "lang_refs")
    texts = _spread(full.select("doc_id", F.lit(-1).alias("chunk_idx"), F.col("full_text").alias("text")).unionByName(_t(spark, sf_dir, "chunks").select("doc_id", "chunk_idx", "text")))
    samples = _samples(spark, sf_dir)
    repair = mojibake.Shared(spark, mojibake.train(_spread(full.select("full_text")), samples, "full_text"))
    return language.segments(texts, refs, "text", repair=repair, alphabet=mojibake.clean_alphabet(samples))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    full, refs = _t(spark, sf_dir, "full_texts"), _t(spark, sf_dir, "lang_refs")
    runs = _language_segments(spark, sf_dir).filter((F.col("end") - F.col("start") >= language.LEAST_RUN) & (F.col("confidence") >= language.LEAST_CONFIDENCE))
    labels = full.select("doc_id", language.named(F.col("lang"), refs).alias("named")).distinct()
    return runs.select("doc_id", "chunk_idx", F.col("language").alias("lang")).distinct().join(labels, "doc_id").filter(~F.col("lang").eqNullSafe(F.col("named"))).select("doc_id", "chunk_idx", "lang").distinct()


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stretch of every text with its language and confidence."""
    return _language_segments(spark, sf_dir).distinct()


def _works(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, str, str, neardup.Field]]:
    """Texts (field 0) and titles (field 1) with what makes them alike."""
    return [
        (_spread(_t(spark, sf_dir, "full_texts").select("doc_id", "full_text")), "doc_id", "full_text", neardup.Field(5, 0.5, 100)),
        (_t(spark, sf_dir, "metadata").select("doc_id", "title"), "doc_id", "title", neardup.Field(1, 0.6)),
    ]


def _field_name() -> Column:
    return F.element_at(F.array(F.lit("full_text"), F.lit("title")), F.col("field") + 1)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.expand(*neardup.similar_members(_works(spark, sf_dir))).select(_field_name().alias("field"), "doc_a", "doc_b")


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classes of exact copies of texts and of titles: every record with its class, the class's first record and size."""
    members, _ = neardup.class_members(_works(spark, sf_dir))
    return copies.membership(members).select(_field_name().alias("field"), F.lower(F.hex(F.substring("cls", 2, 16))).alias("cls"), "representative", "n", F.col("id").alias("doc_id"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record that is like another in text or title: its group and how many records it is like, copies counted in full."""
    members, alike = (stage(x, f"dup-{k}") for k, x in enumerate(neardup.similar_members(_works(spark, sf_dir))))
    edges = copies.expand(members, alike, most=1).select("doc_a", "doc_b").distinct()  # stars: all a group needs
    groups = neardup.components(edges).select("id", "group_id")
    fields = [(members.filter(F.col("field") == k), alike.filter(F.col("field") == k)) for k in range(2)]
    return groups.join(copies.links(*fields), "id").select(F.col("id").alias("doc_id"), "group_id", "n_links")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = _spread(_t(spark, sf_dir, "full_texts").select("doc_id", "full_text"))
    return mojibake.restore(full, _t(spark, sf_dir, "lang_refs"), keep_text=False).filter("garbled").select("doc_id").distinct()


def p5_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The garbled records with their text restored as far as it can be."""
    full = _spread(_t(spark, sf_dir, "full_texts").select("doc_id", "full_text"))
    found = mojibake.restore(full, _t(spark, sf_dir, "lang_refs")).filter("garbled")
    return found.select("doc_id", "chains", "words_changed", "restored").distinct()


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_spread(_t(spark, sf_dir, "documents").select("doc_id", "text"))).select("doc_id", "ids")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text")
    sized = bpe.count_tokens(_spread(docs)).select("doc_id", "n_tokens")
    return packing.pack(sized, n_items=docs.count())


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_pairs(_spread(_t(spark, sf_dir, "documents").select("doc_id", "text")))


def p8_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.shared_share(_spread(_t(spark, sf_dir, "documents").select("doc_id", "text"))).withColumn("spans", F.array_join(F.transform("spans", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), " "))


def p8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.repeated_lines(_t(spark, sf_dir, "documents").select("doc_id", "text"))


def p8_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document what is left without lines that stand earlier, each piece with its offset in the text as stored."""
    left = spans.left_over(_t(spark, sf_dir, "documents").select("doc_id", "text"))
    pieces = F.transform("pieces", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"), F.md5(x["piece"])))
    return left.select("doc_id", "n_removed", "removed_chars", F.array_join(pieces, " ").alias("pieces"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (p1_found, p1_pieces, p2_found, p2_paragraphs, p3_found, p3_segments, p4_found, p4_classes, p4_groups, p5_found, p5_restored, p6_ids, p7_containers, p8_found, p8_share, p8_lines, p8_left)
}

_ALIKE = r"""w AS (SELECT DISTINCT doc_id, list_transform(regexp_extract_all(full_text, '\p{L}{3,}'), lambda x: lower(x)) AS ws FROM full_texts WHERE full_text IS NOT NULL),
big AS (SELECT row_number() OVER () AS r, doc_id, ws FROM w WHERE len(ws) >= 100),
sh AS (SELECT DISTINCT r, doc_id, hash(ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS s FROM big, unnest(range(1, len(ws) - 3)) AS u(i)),
n AS (SELECT r, doc_id, count(*) AS n FROM sh GROUP BY r, doc_id),
c AS (SELECT a.r AS ra, b.r AS rb, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
texts AS (SELECT 'full_text' AS field, least(x.doc_id, y.doc_id) AS doc_a, greatest(x.doc_id, y.doc_id) AS doc_b
          FROM c JOIN n x ON x.r = ra JOIN n y ON y.r = rb WHERE x.doc_id <> y.doc_id AND 2 * c >= x.n + y.n - c),
tw AS (SELECT row_number() OVER () AS r, doc_id, ws FROM (SELECT DISTINCT doc_id, list_distinct(list_transform(regexp_extract_all(title, '\p{L}{3,}'), lambda x: lower(x))) AS ws FROM metadata WHERE title IS NOT NULL)),
ts AS (SELECT r, doc_id, len(ws) AS n, unnest(ws) AS s FROM tw),
tc AS (SELECT a.doc_id AS da, b.doc_id AS db, a.n AS na, b.n AS nb, count(*) AS c FROM ts a JOIN ts b ON a.s = b.s AND a.r < b.r AND a.doc_id <> b.doc_id GROUP BY a.r, b.r, a.doc_id, b.doc_id, a.n, b.n),
titles AS (SELECT 'title' AS field, least(da, db) AS doc_a, greatest(da, db) AS doc_b FROM tc WHERE 5 * c >= 3 * (na + nb - c)),
found AS (SELECT DISTINCT * FROM (SELECT * FROM texts UNION ALL SELECT * FROM titles))"""

ORACLE: dict[str, str] = {
    "p1_found": "SELECT DISTINCT doc_id, chunk_idx FROM chunks WHERE length(text) > 1200",
    "p4_found": f"WITH {_ALIKE} SELECT * FROM found",
    "p4_groups": f"""
WITH RECURSIVE {_ALIKE},
e AS (SELECT doc_a AS a, doc_b AS b FROM found UNION SELECT doc_b, doc_a FROM found),
reach AS (SELECT a AS id, a AS x FROM e UNION SELECT r.id, e.b FROM reach r JOIN e ON r.x = e.a),
g AS (SELECT id, min(x) AS group_id FROM reach GROUP BY id)
SELECT id AS doc_id, group_id, count(DISTINCT b) AS n_links FROM g JOIN e ON e.a = id GROUP BY id, group_id
""",
    "p4_classes": r"""
WITH x AS (SELECT DISTINCT 'full_text' AS field, full_text AS t, doc_id FROM full_texts WHERE len(regexp_extract_all(full_text, '\p{L}{3,}')) >= 100
 UNION ALL SELECT DISTINCT 'title', title, doc_id FROM metadata WHERE regexp_matches(title, '\p{L}{3,}'))
SELECT field, md5(t) AS cls, min(doc_id) OVER (PARTITION BY field, t) AS representative, count(*) OVER (PARTITION BY field, t) AS n, doc_id FROM x
""",
    "p8_found": r"""
WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 240),
w AS (SELECT doc_id, hash(substr(text, i, 240)) AS h FROM d, unnest(range(1, n - 238)) AS u(i)),
s AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT DISTINCT doc_id, h FROM w SEMI JOIN s USING (h))
SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM m a JOIN m b ON a.h = b.h AND a.doc_id < b.doc_id
""",
    "p8_share": r"""
WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents WHERE length(text) >= 240),
w AS (SELECT doc_id, i, hash(substr(text, i, 240)) AS h FROM d, unnest(range(1, n - 238)) AS u(i)),
s AS (SELECT h FROM w GROUP BY h HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT DISTINCT doc_id, i FROM w SEMI JOIN s USING (h)),
g AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 240 THEN 0 ELSE 1 END AS new FROM m)),
c AS (SELECT doc_id, run, min(i) - 1 AS s, max(i) + 239 AS e FROM g GROUP BY doc_id, run),
a AS (SELECT doc_id, string_agg(s || '-' || e, ' ' ORDER BY s) AS spans, CAST(sum(e - s) AS BIGINT) AS shared_chars FROM c GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(length(text), 0) AS INTEGER) AS n_chars, coalesce(spans, '') AS spans, coalesce(shared_chars, 0) AS shared_chars,
 CASE WHEN length(text) > 0 THEN coalesce(shared_chars, 0) / length(text) ELSE 0.0 END AS share FROM documents LEFT JOIN a USING (doc_id)
""",
    "p8_lines": r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
arr AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM d),
lines AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, a[i] AS line,
                 CAST(coalesce(sum(length(a[i]) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start
          FROM arr, unnest(range(1, len(a) + 1)) AS u(i)),
units AS (SELECT doc_id, line_no, start, CAST(length(line) AS INTEGER) AS size,
                 md5(lower(regexp_replace(trim(line, ' '), '[ \t]+', ' ', 'g'))) AS digest FROM lines WHERE length(line) >= 40)
SELECT doc_id, line_no, start, size, digest, row_number() OVER (PARTITION BY digest ORDER BY doc_id, line_no) = 1 AS keep FROM units
""",
    "p8_left": r"""
WITH arr AS (SELECT doc_id, text, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, i, a[i] AS line, coalesce(sum(length(a[i]) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM arr, unnest(range(1, len(a) + 1)) AS u(i)),
k AS (SELECT *, length(line) < 40 OR row_number() OVER (PARTITION BY length(line) >= 40, md5(lower(regexp_replace(trim(line, ' '), '[ \t]+', ' ', 'g'))) ORDER BY doc_id, i) = 1 AS keep FROM lines),
r AS (SELECT *, sum(CASE WHEN keep THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run, max(i) OVER (PARTITION BY doc_id) AS last FROM k),
p AS (SELECT doc_id, min(start) AS s, max(start + length(line) + CASE WHEN i < last THEN 1 ELSE 0 END) AS e FROM r WHERE keep GROUP BY doc_id, run),
j AS (SELECT doc_id, string_agg(CAST(s AS VARCHAR) || ':' || CAST(e AS VARCHAR) || ':' || md5(substr(text, CAST(s AS BIGINT) + 1, CAST(e - s AS BIGINT))), ' ' ORDER BY s) AS pieces FROM p JOIN documents USING (doc_id) WHERE e > s GROUP BY doc_id),
c AS (SELECT doc_id, CAST(count(*) AS INTEGER) AS n_removed, CAST(sum(length(line)) AS INTEGER) AS removed_chars FROM k WHERE NOT keep GROUP BY doc_id)
SELECT doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0) AS removed_chars, coalesce(pieces, '') AS pieces FROM documents LEFT JOIN j USING (doc_id) LEFT JOIN c USING (doc_id)
""",
}
