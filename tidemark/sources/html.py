"""Meeting days out of landed HTML pages, with regular expressions over whole pages."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
EXCLUDED = r"(?iU)unscheduled|conference\s+call|notation\s+vote|cancell?ed"
HEADING = r"(?iU)^([a-z]+(?:/[a-z]+)?)\s+(\d{1,2})(?:-(\d{1,2}))?\s+(.+?)\s*-\s*(\d{4})\s*$"
REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, html): landed page files as text; bad bytes become replacement characters."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", page_text(F.col("content")).alias("html"))


def page_text(content: Column) -> Column:
    """UTF-8 text of page bytes with malformed input replaced (a binary cast keeps bytes, so re-encode)."""
    return F.make_valid_utf8(content.cast("string"))


def strip_tags(fragment: Column) -> Column:
    """Tags removed, whitespace collapsed, then character references decoded, ends trimmed."""
    text = unescaped(F.regexp_replace(F.regexp_replace(fragment, r"<[^>]+>", ""), r"\s+", " "))
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def unescaped(text: Column) -> Column:
    """Character references decoded in one pass: all names of the HTML5 table, decimal and hexadecimal numbers.

    The text is cut at its references; what one decodes to is not read again. Unknown names stay as they are.
    """
    # one literal: a map built of thousands takes seconds to plan
    names = F.from_json(F.lit(json.dumps({"&" + name: char for name, char in sorted(html5.items()) if name.endswith(";")})), "map<string,string>")
    found = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    between = F.split(text, REFERENCE, -1)
    decoded = F.transform(found, lambda e: F.coalesce(F.when(e.startswith("&#"), _character(e)).otherwise(F.try_element_at(names, e)), e))
    pairs = F.zip_with(decoded, F.slice(between, 2, F.size(found)), lambda d, t: F.concat(d, t))
    return F.when(text.contains("&"), F.concat(between[0], F.array_join(pairs, ""))).otherwise(text)


def _character(reference: Column) -> Column:
    """The character of a numeric reference; a number that is no character gives the replacement character."""
    body = F.lower(F.substring(reference, 3, 16))
    digits = F.regexp_replace(body, "[x;]", "")
    code = F.coalesce(F.when(body.startswith("x"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint"), F.lit(0))
    none = (code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    return F.decode(F.unhex(F.lpad(F.hex(F.when(none, 0xFFFD).otherwise(code)), 8, "0")), "UTF-32")


def heading_fragments(html: Column, levels: tuple[int, ...] = (4, 5)) -> Column:
    """Array of heading bodies at the given levels, in page order."""
    h = "".join(str(n) for n in levels)
    return F.regexp_extract_all(html, F.lit(rf"(?is)<h[{h}][^>]*>(.*?)</h[{h}]>"), F.lit(1))


def headings(pages: DataFrame, key: str, levels: tuple[int, ...] = (4, 5)) -> DataFrame:
    """(key, position, title): one row per heading."""
    # cleaned inside the generator, so later filters test a plain column instead of repeating the cleaning
    titles = F.transform(heading_fragments(F.col("html"), levels), strip_tags)
    return pages.select(key, F.posexplode(titles).alias("position", "title"))


def month_number(name: Column) -> Column:
    """1-12: the first month whose name starts with the text's first three letters; else NULL."""
    key = F.substring(F.lower(F.trim(name)), 1, 3)
    return F.coalesce(*[F.when(F.lit(m).startswith(key), i) for i, m in enumerate(MONTHS, 1)])


def with_final_day(df: DataFrame, parts: str, out: str) -> DataFrame:
    """Rows whose ``parts`` = [months, d1, d2, year] text name a possible day, with that day added.

    Months are 'Month' or 'Month/Month'; a second month earlier in the year than
    the first is in the next year.  The day is made inside a generator, which
    drops the missing ones: a filter would repeat the whole expression.
    """
    p = F.col(parts)
    months = F.split(p[0], "/")
    x = df.withColumns({"_m1": month_number(months[0]), "_m2": month_number(F.element_at(months, -1))})
    d1, d2, year = (F.nullif(p[i], F.lit("")).try_cast("int") for i in (1, 2, 3))
    crosses = d2.isNotNull() & (F.col("_m1") != F.col("_m2"))
    text = F.format_string(
        "%04d-%02d-%02d",
        F.when(crosses & (F.col("_m2") < F.col("_m1")), year + 1).otherwise(year),
        F.when(crosses, F.col("_m2")).otherwise(F.col("_m1")),
        F.coalesce(d2, d1),
    )
    known = F.col("_m1").isNotNull() & F.col("_m2").isNotNull() & d1.isNotNull()
    day = F.when(known, F.try_to_date(text, "yyyy-MM-dd"))
    return x.select(*df.columns, F.explode(F.array_compact(F.array(day))).alias(out))


def scheduled_heading(title: Column) -> Column:
    """Condition: a meeting heading of no excluded kind."""
    return ~title.rlike(EXCLUDED) & title.rlike(r"(?iU)\bmeeting\b") & title.rlike(HEADING)


def heading_days(titles: DataFrame, title: str = "title") -> DataFrame:
    """Scheduled meeting headings with their final day; excluded kinds and non-meetings drop out."""
    t = F.regexp_replace(title, r"(?U)^\s+|\s+$", "")
    parts = F.split(F.regexp_replace(t, HEADING, "$1|$2|$3|$5"), r"\|")
    return with_final_day(titles.where(scheduled_heading(t)).withColumn("_p", parts), "_p", "event_date").drop("_p")


def meeting_days(pages: DataFrame, key: str, levels: tuple[int, ...] = (4, 5)) -> DataFrame:
    """(key, event_date): scheduled meeting days on year pages made of headings."""
    return heading_days(headings(pages, key, levels)).select(key, "event_date")


# ------------------------------------------------------------ panel pages
# Marks of the page format.
YEAR_MARK = r"(?i)20\d{2}\s+FOMC\s+Meetings"
ROW_MARK = r'(?i)<div class="[^"]*\bfomc-meeting\b'
PANEL_MONTH = r"(?i)fomc-meeting__month[^>]*>\s*<strong>\s*([a-z/]+)\s*</strong>"
PANEL_DATES = r"(?i)fomc-meeting__date[^>]*>\s*([\d\s\-]+\*?)"


def panel_meeting_days(pages: DataFrame, key: str, years: Column | None = None) -> DataFrame:
    """(key, year, event_date) from panel pages: year marks cut blocks, row marks cut rows.

    ``years``: optional condition on the ``year`` column; other panels are skipped.
    """
    block = F.split(F.col("html"), f"(?={YEAR_MARK})")
    # text before the first mark has no leading mark and drops out here
    blocks = pages.select(key, F.explode(block).alias("block")).where(F.col("block").rlike("^" + YEAR_MARK))
    blocks = blocks.withColumn("year", F.substring("block", 1, 4).cast("int"))
    if years is not None:
        blocks = blocks.where(years)
    rows = blocks.select(key, "year", F.explode(F.split("block", f"(?={ROW_MARK})")).alias("row"))
    rows = rows.where(F.col("row").rlike("^" + ROW_MARK))
    found = rows.select(
        key, "year", F.regexp_extract("row", PANEL_MONTH, 1).alias("months"),
        F.regexp_replace(F.regexp_extract("row", PANEL_DATES, 1), r"[^\d\-]", "").alias("dates"),
    ).where(F.col("months") != "")
    day = r"^(\d+)(?:-(\d+))?$"
    parts = F.array("months", F.regexp_extract("dates", day, 1), F.regexp_extract("dates", day, 2), F.col("year").cast("string"))
    return with_final_day(found.withColumn("_p", parts), "_p", "event_date").select(key, "year", "event_date")
