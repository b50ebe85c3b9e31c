"""Column functions over text: measures of quality, file names, slugs. All stay in the JVM; null in gives null out unless said."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chars import DIGIT, LETTER, SPACE, WORD

# Thresholds of the text quality gate.
OCR_LEAST_CHARS = 50
FOREIGN_SHARE, LETTER_SHARE, DIGIT_SHARE = 0.15, 0.4, 0.005
FORCE_OCR_SHARE = 0.3
SLUG_CHARS, NAME_BYTES, NAME_LIMIT = 50, 245, 255


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(col(c), rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def nonws_len(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), rf"[{SPACE}]", ""))


def letter_count(c: Column | str) -> Column:
    return F.length(F.regexp_replace(col(c), rf"[^{LETTER}]", ""))


def foreign_letter_count(c: Column | str) -> Column:
    """Letters beyond ASCII."""
    return F.length(F.regexp_replace(col(c), rf"[^{LETTER}]|[\x00-\x7f]", ""))


def inner_digit_count(c: Column | str) -> Column:
    """Digits with a letter on either side; `a1b2c` has two."""
    return F.regexp_count(col(c), F.lit(rf"(?<=[{LETTER}])[{DIGIT}](?=[{LETTER}])"))


def looks_garbled(c: Column | str) -> Column:
    """Whether a page's native text is unusable. Blank and null texts are not; text with many letters beyond ASCII is real
    text of another script; few letters, or digits inside words more often than DIGIT_SHARE, are signs of a broken font."""
    n = nonws_len(c)
    return (
        F.when(F.coalesce(n, F.lit(0)) == 0, False)
        .when(foreign_letter_count(c) / n >= FOREIGN_SHARE, False)
        .when(letter_count(c) / n < LETTER_SHARE, True)
        .otherwise(inner_digit_count(c) / n > DIGIT_SHARE)
    )


def needs_ocr(c: Column | str) -> Column:
    return (F.coalesce(nonws_len(c), F.lit(0)) < OCR_LEAST_CHARS) | looks_garbled(c)


def page_part(page_no: Column | str, raw: Column | str, ocr: Column, ocr_text: Column | str, ocr_error: Column | str) -> Column:
    """A page as it enters the document's text, under its marker; after a failed OCR the native text is dropped."""
    no = col(page_no).cast("string")
    return (
        F.when(~ocr, F.concat(F.lit("[Page "), no, F.lit("]\n"), F.coalesce(col(raw), F.lit(""))))
        .when(col(ocr_error).isNotNull(), F.concat(F.lit("[Page "), no, F.lit(" — OCR failed: "), col(ocr_error), F.lit("]")))
        .otherwise(F.concat(F.lit("[Page "), no, F.lit(" — OCR]\n"), F.coalesce(col(ocr_text), F.lit(""))))
    )


def parse_filename(stem: Column | str) -> Column:
    """struct<author, year, title> of `Author_Year_Title`. The year is the first part of four digits and perhaps a letter; without
    one the first three parts are taken as they come."""
    s = col(stem)
    year = r"(?s)\A(.*?)(?:\A|_)(\p{Nd}{4}[a-z]?)(?=_|\z)(.*)\z"
    has = s.rlike(year)
    parts = F.split(s, "_", 3)
    part = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
    title = strip(F.translate(F.regexp_replace(F.regexp_extract(s, year, 3), r"\A_+", ""), "_", " "))
    return F.when(s.isNotNull(), F.struct(
        F.when(has, F.regexp_extract(s, year, 1)).otherwise(part(0)).alias("author"),
        F.when(has, F.regexp_extract(s, year, 2)).otherwise(part(1)).alias("year"),
        F.when(has, title).otherwise(F.translate(part(2), "_", " ")).alias("title")))


def make_slug(c: Column | str, size: int = SLUG_CHARS) -> Column:
    """A file name part: word characters, blanks as one underscore, `size` characters; what has none of them stays as it is."""
    s = F.regexp_replace(strip(F.regexp_replace(col(c), rf"[^{WORD}{SPACE}\-]", "")), rf"[{SPACE}]+", "_")
    return F.coalesce(F.nullif(F.regexp_replace(F.substring(s, 1, size), r"[_\-]+\z", ""), F.lit("")), F.substring(col(c), 1, size))


def slug_or(c: Column | str, prefix: str, ordinal: Column | str) -> Column:
    """The slug of a caption, or `prefix_ordinal` for none."""
    return F.when(F.coalesce(col(c), F.lit("")) == "", F.concat(F.lit(prefix + "_"), col(ordinal).cast("string"))).otherwise(make_slug(c))


def base_name(author: Column | str, year: Column | str, title: Column | str) -> Column:
    whole = F.concat_ws("_", *(F.coalesce(col(c), F.lit("")) for c in (author, year, title)))
    return F.regexp_replace(F.translate(whole, " ", "_"), rf"[^{WORD}\-]", "")


def truncate_utf8(c: Column | str, size: int = NAME_BYTES) -> Column:
    """The longest beginning of at most `size` bytes of UTF-8 that cuts no character."""
    s = col(c)
    heads = F.transform(F.sequence(F.lit(0), F.least(F.length(s), F.lit(size))), lambda i: F.substring(s, F.lit(1), i))
    return F.when(F.octet_length(s) <= size, s).otherwise(F.element_at(F.filter(heads, lambda x: F.octet_length(x) <= size), -1))


def file_name(base: Column | str, copy_no: Column | str | int = 0, suffix: str = ".pdf", limit: int = NAME_LIMIT, size: int = NAME_BYTES) -> Column:
    """`base_n.pdf` for the n-th copy, `base.pdf` for the first. Of a name over the limit the base is cut, so copies stay apart."""
    n = F.lit(copy_no) if isinstance(copy_no, int) else col(copy_no)
    end = F.concat(F.when(n > 0, F.concat(F.lit("_"), n.cast("string"))).otherwise(F.lit("")), F.lit(suffix))
    whole = F.concat(col(base), end)
    return F.when(F.octet_length(whole) > limit, F.concat(truncate_utf8(base, size), end)).otherwise(whole)


def url_join(base: Column | str, href: Column | str) -> Column:
    return F.concat(F.regexp_replace(col(base), r"/+\z", ""), F.lit("/"), F.regexp_replace(col(href), r"\A/+", ""))


def hrefs(html: Column | str) -> Column:
    """Distinct link targets in the order they stand."""
    return F.array_distinct(F.regexp_extract_all(col(html), F.lit('href="([^"]*)"'), F.lit(1)))


def _cell(html: Column | str, label: str) -> Column:
    return F.regexp_extract(col(html), rf"(?s)<td[^>]*>[^<]*\Q{label}\E[^<]*</td>\s*<td[^>]*>(.*?)</td>", 1)


def labelled_cell(html: Column | str, label: str) -> Column:
    """Text of the table cell right of the one that holds `label`, without tags and outer blanks; null if there is none."""
    return F.nullif(strip(F.regexp_replace(_cell(html, label), "<[^>]*>", "")), F.lit(""))


def labelled_links(html: Column | str, label: str) -> Column:
    """Link targets in the table cell right of the one that holds `label`, as they stand."""
    return F.regexp_extract_all(_cell(html, label), F.lit('<a\\s[^>]*href="([^"]*)"'), F.lit(1))


def species_titles(html: Column | str) -> Column:
    """The emphasised names of a catalog page's species titles, in order."""
    return F.regexp_extract_all(col(html), F.lit(r'(?s)<div[^>]*class="[^"]*species-title[^"]*"[^>]*>(?:(?!</div>).)*?<em[^>]*>(.*?)</em>'), F.lit(1))


def reference_blocks(html: Column | str) -> Column:
    """array<array<string>>: the link targets of each reference block of a catalog page, distinct, in the order they stand."""
    blocks = F.slice(F.split(col(html), r'<div[^>]*class="[^"]*tax-ref[^"]*"[^>]*>'), 2, 1_000_000_000)
    return F.transform(blocks, lambda x: F.array_distinct(F.regexp_extract_all(x, F.lit('<strong[^>]*>\\s*<a\\s[^>]*href="([^"]*)"'), F.lit(1))))


def display(c: Column | str, size: int, none: str = "(no caption)") -> Column:
    return F.coalesce(F.nullif(F.substring(col(c), 1, size), F.lit("")), F.lit(none))


def sorted_pages(pages: Column | str) -> Column:
    """Distinct page numbers in order, without nulls; an empty array for null."""
    return F.coalesce(F.array_sort(F.array_distinct(F.filter(col(pages), lambda x: x.isNotNull()))), F.array().cast("array<int>"))
