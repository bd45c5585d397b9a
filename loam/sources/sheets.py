"""SC-05 to SC-07, SC-13, SK-10: sheets as frames, on any of Hadoop's stores.

A sheet is a small table that people edit: a header with stray blanks and a byte-order mark,
rows of any width, blank rows, bytes that aren't UTF-8. ``sheet`` gives its cells as text
under the tidy header. Files are listed and read by Spark (``binaryFile``), so a path may be a
folder or pattern and lie where only Spark can read.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tidy_sheet(rows: list[list[str | None]]) -> tuple[list[str], list[list[str]]]:
    """SC-06: header without byte-order mark and blanks at its end, blank rows dropped, rows cut or padded to its width."""
    if not rows:
        return [], []
    header = [(h or "").lstrip("\ufeff").strip() for h in rows[0]]
    while header and not header[-1]:
        header.pop()
    body = [[(v or "") for v in r] for r in rows[1:]] if header else []
    return header, [(r + [""] * len(header))[: len(header)] for r in body if any(v.strip() for v in r)]


def cells(content: bytes) -> list[list[str]]:
    """Rows of a CSV file's bytes; what isn't UTF-8 becomes the replacement character (SC-13)."""
    return list(csv.reader(io.StringIO(content.decode("utf-8", "replace"), newline="")))


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    """The files of a path (path, content), or None if there are none."""
    try:
        files = spark.read.format("binaryFile").load(path).select("path", "content")
        return None if files.isEmpty() else files
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def sheet(spark: SparkSession, path: str, fallback: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """SC-06, SC-07: the rows of the sheets at ``path``, all cells text; ``fallback`` if nothing is there.

    Columns are those of the first file's header by name, or ``columns``; a header cell that
    is blank or repeated is named by its place (``_2``). Cells a file lacks are empty text. A file
    without a byte counts as missing. Each file is read by one task, as sheets are small; files
    are read in parallel.
    """
    files = _files(spark, path)
    if files is None and fallback is not None:
        files = _files(spark, fallback)
    if files is None:
        raise FileNotFoundError(path)

    def named(header: list[str]) -> list[str]:
        seen, out = set(), []
        for k, name in enumerate(header, 1):
            out.append(f"_{k}" if not name or name.lower() in seen else name)
            seen.add(out[-1].lower())
        return out

    def headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                yield pa.RecordBatch.from_arrays([pa.array([named(tidy_sheet(cells(content.as_py()))[0])], pa.list_(pa.string()))], ["names"])

    if columns is None:
        first = files.orderBy("path").limit(1)
        columns = [c for r in first.select("content").mapInArrow(headers, "names array<string>").collect() for c in r["names"]]
    if not columns:
        return spark.createDataFrame([], T.StructType([]))
    wanted = list(columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                header, body = tidy_sheet(cells(content.as_py()))
                at = {name: k for k, name in enumerate(named(header))}
                yield pa.RecordBatch.from_arrays([pa.array([r[at[c]] if c in at else "" for r in body], pa.string()) for c in wanted], wanted)

    return files.mapInArrow(rows, ", ".join(f"`{c}` string" for c in wanted))


def write_sheet(df: DataFrame, path: str) -> None:
    """SK-10, SK-13: replace a sheet: one CSV with header, null as empty text, quoted so that it reads back as it is."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]
    # One file, as readers of a sheet expect; a sheet is small, and ``orderBy`` of the caller is kept.
    df.select(*text).coalesce(1).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
