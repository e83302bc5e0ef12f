"""Text, subtitle, table and web formats as DataFrames; parsing stays in the JVM wherever it is a matter of patterns."""

from __future__ import annotations

import re
import subprocess
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quorumlake.functions import text as T


def whole_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(source_file, value): whole text files; their names sorted give the order of the input."""
    read = spark.read.option("recursiveFileLookup", True)
    if pattern:
        read = read.option("pathGlobFilter", pattern)
    return read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("source_file"), "value")


def minutes_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, page, line_no, line): pages divided by form feeds, lines trimmed, blank ones left out.

    Files other than .txt are refused, as their text must be taken out first.
    """
    files = whole_files(spark, path, "*.{txt,pdf}")
    checked = files.where(F.when(F.lower("source_file").endswith(".txt"), True).otherwise(F.raise_error(F.concat(F.lit("no text reader for "), F.col("source_file")))))
    pages = checked.select("source_file", F.posexplode(F.split("value", "\f")).alias("p", "page_text"))
    lines = pages.select("source_file", (F.col("p") + 1).alias("page"), F.posexplode(F.split("page_text", "\r\n|\n|\r")).alias("line_no", "line"))
    return lines.select("source_file", "page", "line_no", F.trim("line").alias("line")).where("line <> ''")


def stem_parts(name: Column) -> tuple[Column, Column]:
    """(date, id) of a file name <date>__<id>."""
    return F.nullif(F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2})__", 1), F.lit("")), F.regexp_extract(name, r"__(\d+)", 1).try_cast("bigint")


_MARK = r"(\d{1,2}):(\d{2}):(\d{2})[.,](\d{3})"


def cues(files: DataFrame) -> DataFrame:
    """(source_file, cue_no, start_s, end_s, text) of subtitle files (source_file, value)."""
    blocks = files.select("source_file", F.explode(F.split(F.regexp_replace("value", "\r\n?", "\n"), r"\n\s*\n")).alias("b"))
    at = lambda k: (F.regexp_extract("b", f"{_MARK}\\s*-->\\s*{_MARK}", k)).try_cast("double")
    start, end = at(1) * 3600 + at(2) * 60 + at(3) + at(4) / 1000, at(5) * 3600 + at(6) * 60 + at(7) + at(8) / 1000
    text = T.clean(F.regexp_replace("b", r"(?s)^.*?-->[^\n]*\n?", ""))
    rows = blocks.where(F.col("b").rlike(f"{_MARK}\\s*-->\\s*{_MARK}"))
    return rows.select("source_file", F.regexp_extract("b", r"^\s*(\d+)\s*\n", 1).try_cast("int").alias("cue_no"), start.alias("start_s"), end.alias("end_s"), text.alias("text"))


def speaker_lines(files: DataFrame) -> DataFrame:
    """(source_file, line_no, speaker, said): labelled lines give the letter, others null."""
    lines = files.select("source_file", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("line_no", "line"))
    pattern = r"^Speaker ([A-Z]):\s*(.*)$"
    letter = F.nullif(F.regexp_extract("line", pattern, 1), F.lit(""))
    return lines.select("source_file", "line_no", letter.alias("speaker"), F.when(letter.isNotNull(), F.regexp_extract("line", pattern, 2)).otherwise(F.col("line")).alias("said"))


def table_marks(files: DataFrame, section: str = "meeting map", column: str = "elapsed") -> DataFrame:
    """(source_file, line_no, label, mark): cells of the named column in the pipe table of a Markdown section.

    The section of a line is the last heading before it, the columns are those of the first row of the table.
    """
    lines = files.select("source_file", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("line_no", "line"))
    w = Window.partitionBy("source_file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.withColumn("section", F.last(F.when(F.col("line").startswith("## "), F.lower(F.trim(F.substring("line", 4, 10_000)))), ignorenulls=True).over(w))
    rows = placed.where(F.col("section").startswith(section) & F.col("line").contains("|"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    rows = rows.select("source_file", "line_no", cells.alias("cells"))
    hit = F.filter(F.transform("cells", lambda c, i: F.when(F.lower(c).contains(column), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("__c", F.first(F.get(hit, F.lit(0)), ignorenulls=True).over(w)).withColumn("__head", F.get(hit, F.lit(0)).isNotNull())
    mark = F.get(F.col("cells"), F.col("__c"))
    kept = rows.where(~F.col("__head") & F.col("__c").isNotNull() & ~F.array_join("cells", "").rlike("^[-: ]*$") & mark.rlike(r"^\d{1,2}(:\d{2}){1,2}$"))
    return kept.select("source_file", "line_no", F.coalesce(F.nullif(F.get("cells", F.lit(0)), F.lit("")), F.lit("(row)")).alias("label"), mark.alias("mark"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines with ``line_no`` and, for lines that do not parse, ``bad``; blank lines and # comments are left out."""
    files = whole_files(spark, path)
    lines = files.select("source_file", F.posexplode(F.split("value", "\r\n|\n|\r")).alias("n", "line")).where("trim(line) <> '' AND NOT startswith(trim(line), '#')")
    parsed = lines.select("source_file", (F.col("n") + 1).alias("line_no"), "line", F.from_json("line", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.select("source_file", "line_no", "r.*").withColumnRenamed("_bad", "bad")


def wide_years(spark: SparkSession, path: str, keep: str, prefix: str, key: list[str]) -> DataFrame:
    """(key, year, value) of a Latin-1 table with one column a year; ``keep`` is a filter on its rows."""
    wide = spark.read.csv(path, header=True, encoding="ISO-8859-1").where(keep)
    years = [c for c in wide.columns if re.fullmatch(prefix + r"\d{4}", c)]
    return wide.unpivot(key, years, "year", "value").select(*key, F.right("year", F.lit(4)).cast("int").alias("year"), F.col("value").try_cast("bigint").alias("value"))


def glossary(files: DataFrame) -> DataFrame:
    """(source_file, pos, slug, term) of the definitions of an HTML page."""
    blocks = F.regexp_extract_all("value", F.lit(r'(?s)<div class="def" id="[^"]+">.*?</div>'), F.lit(0))
    rows = files.select("source_file", F.posexplode(blocks).alias("pos", "b"))
    name = T.strip_tags(F.regexp_replace(F.regexp_extract("b", r"(?s)<dt>(.*?)</dt>", 1), r"(?s)<a\b.*?</a>", ""))
    return rows.select("source_file", "pos", F.regexp_extract("b", 'id="([^"]+)"', 1).alias("slug"), name.alias("term")).where("term <> ''")


def font_faces(files: DataFrame, subsets: list[str]) -> DataFrame:
    """(family, style, weight, subset, remote, file): faces of style sheets, each once, faces of one address sharing a file."""
    blocks = F.regexp_extract_all("value", F.lit(r"(?s)/\*\s*[\w-]+\s*\*/\s*@font-face\s*\{.*?\}"), F.lit(0))
    rows = files.select("source_file", F.posexplode(blocks).alias("pos", "b"))
    get = lambda p: F.trim(F.regexp_extract("b", p, 1))
    faces = rows.select(
        "source_file", "pos", F.translate(get(r"font-family:\s*([^;]+);"), "'\"", "").alias("family"), get(r"font-style:\s*([^;]+);").alias("style"), get(r"font-weight:\s*([^;]+);").alias("weight"),
        get(r"/\*\s*([\w-]+)\s*\*/").alias("subset"), get(r"url\(([^)]+\.woff2)\)").alias("remote"),
    ).where(F.col("subset").isin(subsets) & (F.col("remote") != ""))
    once = Window.partitionBy("family", "style", "weight", "subset").orderBy("source_file", "pos")
    faces = faces.withColumn("__r", F.row_number().over(once)).where("__r = 1")
    shared = Window.partitionBy("remote").orderBy("source_file", "pos")
    name = F.concat_ws("-", T.slug(F.col("family")), "style", T.slug(F.col("weight")), "subset")
    return faces.withColumn("file", F.concat(F.first(name).over(shared), F.lit(".woff2"))).drop("__r", "source_file", "pos")


def settings(text: str, overrides: dict[str, str] | None = None) -> dict[str, str]:
    """key=value lines; "export", quotes, blank lines and comments are borne.  Overrides, such as the environment, hold for keys
    of the text where they are not empty."""
    out = {}
    for line in text.splitlines():
        m = re.match(r"^\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*$", line)
        if m and not line.lstrip().startswith("#"):
            out[m[1]] = re.sub(r"""^(['"])(.*)\1$""", r"\2", m[2])
    return out | {k: v for k, v in (overrides or {}).items() if k in out and v}


def committed_at(path: str) -> datetime | None:
    """When a file was last committed, by the git repository it lies in; None without one or without a commit."""
    where = Path(path)
    try:
        told = subprocess.run(["git", "-C", str(where.parent), "log", "-1", "--format=%cI", "--", where.name], capture_output=True, text=True, check=True, timeout=60).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return None
    return datetime.fromisoformat(told) if told else None


def landed(spark: SparkSession, path: str, schema: str, key: str, order: str) -> DataFrame:
    """Replies of a service that were landed as JSON files, each key in its newest form; so nothing is asked for twice."""
    rows = spark.read.schema(schema).json(path)
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(key, "__r.*")


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of one JSON file each, by a declared schema; a file that is none gives a row of nulls with ``bad``."""
    return spark.read.schema(f"{schema}, bad string").option("columnNameOfCorruptRecord", "bad").json(path, multiLine=True)


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(source_file, length, content) of files of any kind."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return read.load(path).select(F.col("_metadata.file_name").alias("source_file"), "length", "content")


def pdf_lines(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, page, line_no, line) of PDF files, if a PDF library is installed on the executors."""
    import pandas as pd

    def pages(batches):
        try:
            import io

            import pdfplumber
        except ImportError as missing:
            raise RuntimeError("reading PDF files needs the library pdfplumber") from missing
        for batch in batches:
            for name, content in zip(batch["source_file"], batch["content"]):
                with pdfplumber.open(io.BytesIO(content)) as pdf:
                    rows = [(name, p, n, s.strip()) for p, page in enumerate(pdf.pages, 1) for n, s in enumerate((page.extract_text() or "").split("\n")) if s.strip()]
                yield pd.DataFrame(rows, columns=["source_file", "page", "line_no", "line"])

    return binary_files(spark, path, "*.pdf").select("source_file", "content").mapInPandas(pages, "source_file string, page int, line_no int, line string")
