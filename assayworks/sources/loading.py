"""Reading inputs: tables by path or frame, and documents as text."""

from __future__ import annotations

import io
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.operators.contract import ContractError
from assayworks.sources import positions
from assayworks.sources.documents import only_file, xlsx_rows

SUFFIXES = (".parquet", ".csv", ".xlsx")


def table_path(value: str | os.PathLike) -> str:
    """The path of a table; of a local folder that holds exactly one, this one's."""
    path = os.fspath(value)
    return path if path.rstrip("/").endswith(".parquet") else only_file(path, SUFFIXES)


def load_table(spark: SparkSession, value: DataFrame | bytes | str | os.PathLike | None) -> DataFrame | None:
    """A frame as it is, a Parquet file's bytes, or a Parquet, CSV or XLSX file; a local folder must hold exactly one of these."""
    if value is None or isinstance(value, DataFrame):
        return value
    if isinstance(value, (bytes, bytearray, memoryview)):
        return _of_bytes(spark, bytes(value))
    path = table_path(value)
    kind = os.path.splitext(path.rstrip("/"))[1].lower()
    if kind == ".parquet":
        return spark.read.parquet(path)
    if kind == ".csv":
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if kind == ".xlsx":
        with open(path, "rb") as f:
            return _sheet(spark, path, f.read())
    raise ContractError(f"{path}: not a table")


def _of_bytes(spark: SparkSession, data: bytes) -> DataFrame:
    """What came as bytes is on the driver already, and bounded by that."""
    try:
        table = pq.read_table(io.BytesIO(data))
    except (pa.ArrowInvalid, OSError) as e:
        raise ContractError(f"bytes that are no Parquet file: {e}") from e
    return spark.createDataFrame(table)


def _sheet(spark: SparkSession, path: str, data: bytes) -> DataFrame:
    """The first sheet, its first row as names; cells as text."""
    rows = xlsx_rows(data)
    if not rows or None in rows[0]:
        raise ContractError(f"{path}: the first row must name each column")
    return spark.createDataFrame([tuple(r) for r in rows[1:]], ", ".join(f"`{c}` string" for c in rows[0]))


def load_in_order(spark: SparkSession, value: DataFrame | bytes | str | os.PathLike | None) -> DataFrame | None:
    """:func:`load_table` with ``_pos``, the place of each row in its files (or frame), where the table has none."""
    if value is None:
        return None
    if isinstance(value, (DataFrame, bytes, bytearray, memoryview)):
        return positions.of_frame(load_table(spark, value))
    path = table_path(value)
    if path.rstrip("/").lower().endswith(".parquet"):
        return positions.of_parquet(spark, path)
    found = load_table(spark, path)
    return positions.of_text(found) if path.lower().endswith(".csv") else positions.of_frame(found)


def load_monitoring(spark: SparkSession, value: DataFrame | bytes | str | os.PathLike) -> DataFrame:
    """A monitoring table in order: a frame, or Parquet by path or as bytes; all else is refused by name."""
    if isinstance(value, (str, os.PathLike)):
        if not table_path(value).rstrip("/").lower().endswith(".parquet"):
            raise ContractError(f"{value}: a monitoring table is a Parquet file")
    elif not isinstance(value, (DataFrame, bytes, bytearray, memoryview)):
        raise ContractError(f"a monitoring table can't be a {type(value).__name__}")
    return load_in_order(spark, value)


def text_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``source, content`` of the plain-text documents (txt, md, csv) in a folder, read as UTF-8."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,md,csv,TXT,MD,CSV}").load(folder)
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    return files.select(name.alias("source"), F.decode("content", "UTF-8").alias("content"))


def recursive_chunks(text: str, size: int = 1000, overlap: int = 200, separators: tuple[str, ...] = ("\n\n", "\n", " ", "")) -> list[str]:
    """Pieces of at most ``size`` characters, cut at the coarsest separator that will do, neighbours sharing up to ``overlap``."""
    sep = next((s for s in separators if s in text), "")
    finer = separators[separators.index(sep) + 1 :]
    parts = list(text) if sep == "" else text.split(sep)
    out: list[str] = []
    held: list[str] = []
    width = 0

    def flush() -> None:
        nonlocal width
        if held and (piece := sep.join(held).strip()):
            out.append(piece)
        while held and width > overlap:
            width -= len(held.pop(0)) + len(sep)

    for part in (p for p in parts if p or sep):
        if len(part) > size and finer:
            flush()
            held.clear()
            width = 0
            out.extend(recursive_chunks(part, size, overlap, finer))
            continue
        if held and width + len(part) > size:
            flush()
            while held and width + len(part) > size:
                width -= len(held.pop(0)) + len(sep)
        held.append(part)
        width += len(part) + len(sep)
    if held and (piece := sep.join(held).strip()):
        out.append(piece)
    return out


def chunk_function(size: int = 1000, overlap: int = 200):
    """A table function of a text: its recursive chunks as rows, for ``lateralJoin`` and, registered, for ``LATERAL`` in SQL."""

    @F.udtf(returnType="chunk_id int, total_chunks int, content string")
    class Chunks:
        def eval(self, text: str):
            pieces = recursive_chunks(text or "", size, overlap)
            for i, piece in enumerate(pieces):
                yield i, len(pieces), piece

    return Chunks


def chunked(documents: DataFrame, size: int = 1000, overlap: int = 200) -> DataFrame:
    """``source, chunk_id, total_chunks, content`` of ``documents(source, content)``; other columns are carried along."""
    chunks = chunk_function(size, overlap)
    texts = documents.withColumnRenamed("content", "_text")
    cut = texts.lateralJoin(chunks(F.col("_text").outer()))
    carried = [c for c in documents.columns if c not in ("source", "content", "chunk_id", "total_chunks")]
    return cut.select("source", "chunk_id", "total_chunks", "content", *carried)
