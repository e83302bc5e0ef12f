"""Sinks: documents by meeting, roll-ups, pages written only where they changed, caches, sitemaps."""

from __future__ import annotations

import re
import zipfile
from io import BytesIO
from xml.sax.saxutils import escape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorumlake.io import bounded_rows
from quorumlake.operators import relations as R


def by_meeting(motions: DataFrame, path: str) -> None:
    """One JSON document a meeting, in folders by body; a meeting's motions are its own few."""
    docs = motions.groupBy("body", "meeting_id").agg(F.sort_array(F.collect_list(F.struct("id", "page", "item_title", "motion", "outcome", "votes"))).alias("motions"))
    docs.write.mode("overwrite").partitionBy("body").json(path)


def roll_up(df: DataFrame, path: str) -> None:
    """Each row as one line of JSON, nulls left out."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_changed(new: DataFrame, old: DataFrame, key: str, content: str, path: str) -> DataFrame:
    """Writes the rows that are new or changed against ``old`` and returns (key, state) of all, orphans among them."""
    from quorumlake.io import cut

    states = cut(R.changes(old, new, key, content))
    new.join(states.where("state IN ('new', 'changed')").select(key), key, "left_semi").write.mode("overwrite").parquet(path)
    return states


def upsert(cache: DataFrame, fresh: DataFrame, key: list[str], path: str) -> None:
    """The cache with fresh rows in place of those of their keys, written to a folder of its own."""
    R.override(cache, fresh, key).write.mode("overwrite").parquet(path)


def append_lines(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def index_by_body(df: DataFrame, body: str, date: str, fields: list[str]) -> DataFrame:
    """(body, entries): the documents of each body, the newest first."""
    return df.groupBy(body).agg(F.sort_array(F.collect_list(F.struct(date, *[f for f in fields if f != date])), asc=False).alias("entries"))


def sitemap(pages: DataFrame) -> DataFrame:
    """(value): a line of XML for each page (url, changed, priority)."""
    priority = F.format_string("%.1f", F.greatest(F.lit(0.1), F.col("priority").cast("double")))
    return pages.select(F.format_string("<url><loc>%s</loc><lastmod>%s</lastmod><priority>%s</priority></url>", "url", "changed", priority).alias("value"))


def node(kind: str, **fields: Column) -> Column:
    """A JSON-LD node; null fields are left out."""
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit(kind).alias("@type"), *(c.alias(n) for n, c in fields.items())))


def spliced(source: Column, block: Column, begin: str, end: str) -> Column:
    """The source with what stands between two markers replaced, all else kept; unchanged without the markers."""
    at, after = F.instr(source, begin), F.locate(end, source)
    size = F.length(source)
    return F.when((at > 0) & (after > at), F.concat(F.left(source, at + len(begin) - 1), block, F.substring(source, after, size))).otherwise(source)


def server_event(event: Column, data: Column) -> Column:
    """One event of a text/event-stream: its name, and a line for each line of data."""
    lines = F.array_join(F.transform(F.split(data, "\n"), lambda x: F.concat(F.lit("data: "), x)), "\n")
    return F.concat(F.lit("event: "), event, F.lit("\n"), lines, F.lit("\n\n"))


def pages_with_records(pages: DataFrame, records: DataFrame, body: str = "body") -> DataFrame:
    """Pages scoped to a body that has records; pages of no body (null) stay."""
    held = records.select(body).distinct()
    return pages.where(F.col(body).isNull()).unionByName(pages.join(held, body, "left_semi").select(*pages.columns))


def loaded(own: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """Rows of each key from ``own``, those of keys that it lacks from ``fallback``."""
    return R.override(fallback.select(*own.columns), own, [key])


_TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def workbook(sheets: dict[str, DataFrame], most_rows: int = 100_000) -> bytes:
    """An .xlsx file with one sheet a table, the columns' names in its first row.

    A workbook is made on one machine, so a table of more than ``most_rows`` rows is an error; write such as Parquet.
    Numbers stay numbers, nulls are empty cells, all else is text.
    """

    def cell(value) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return f"<c><v>{value}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(re.sub("[\x00-\x08\x0b\x0c\x0e-\x1f]", "", str(value)))}</t></is></c>'

    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        parts = [(n, name[:31], df) for n, (name, df) in enumerate(sheets.items(), 1)]
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for n, _, _ in parts)
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{kinds}</Types>')
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{"".join(f"""<sheet name="{escape(name)}" sheetId="{n}" r:id="rId{n}"/>""" for n, name, _ in parts)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}">{"".join(f"""<Relationship Id="rId{n}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{n}.xml"/>""" for n, _, _ in parts)}</Relationships>')
        for n, name, df in parts:
            rows = [df.columns, *(tuple(r) for r in bounded_rows(df, most_rows, f"the sheet {name}"))]
            body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in rows)
            z.writestr(f"xl/worksheets/sheet{n}.xml", f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()
