"""File sources: CSV tables with the dataframe-library null tokens, text
files as documents, CSV rows as documents, binary files (images)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import CSV_NULL_TOKENS, base64_plain
from . import packed


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str, *, multiline: bool, null_tokens=CSV_NULL_TOKENS,
                   keep_empty: bool = False, bad_cells: str | None = None) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass).  Columns
    are taken by name, in any order and beside any others; a name that the
    header lacks is an error.  ``bad_cells`` names an array column that lists,
    per row, the columns whose text could not be read as their type.

    ``escape='"'`` reads doubled quotes inside quoted cells; every string
    cell equal to one of ``null_tokens`` becomes null, as the dataframe
    reader does (Spark alone only nulls empty cells).  ``multiline`` has
    no default: True reads cells that hold newlines but stops files being
    split, False splits files and must not meet such cells.
    ``keep_empty=True`` reads a quoted "" as '' (only an empty field is
    null), the way ``write_csv`` writes them; by default both are null, as
    in the dataframe library."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    r = (spark.read.option("header", True).option("quote", '"').option("escape", '"')
         .option("multiLine", multiline).option("mode", "PERMISSIVE"))
    if keep_empty:
        r = r.option("nullValue", "\u0000")
    header = r.csv(path).columns  # reads the first line only
    missing = [f.name for f in wanted if f.name not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header}")
    df = r.schema(StructType([StructField(c, StringType()) for c in header])).csv(path)
    toks = [t for t in null_tokens if t != ""]
    cols, bad = [], []
    for f in wanted:
        c = F.col(f"`{f.name}`")
        c = F.when(c.isin(*toks), F.lit(None)).otherwise(c)
        value = c if isinstance(f.dataType, StringType) else F.expr(f"try_cast(trim(`{f.name}`) AS {f.dataType.simpleString()})")
        cols.append(value.alias(f.name))
        bad.append(F.when(c.isNotNull() & value.isNull(), F.lit(f.name)))
    if bad_cells:
        cols.append(F.filter(F.array(*bad), lambda x: x.isNotNull()).alias(bad_cells))
    return df.select(*cols)


def read_text_documents(spark: SparkSession, folder: str, glob: str = "*.md", part_bytes: int | None = None, recursive: bool = False) -> DataFrame:
    """One document per file of the top folder (``recursive``: and of those
    below it): ``source`` (file path) and ``text``; ``doc_id`` is a stable hash
    of the path.

    With ``part_bytes`` a document is one row per so many bytes of its file,
    with ``part``: no row holds a file, so files may be of any size.  The parts
    of a file follow each other in one task (``packed.read_text_parts``)."""
    if part_bytes:
        parts = packed.read_text_parts(spark, folder, glob, row_bytes=part_bytes, task_bytes=part_bytes, recursive=recursive, together=True)
        return parts.select(F.xxhash64("source").alias("doc_id"), "source", "part", "text")
    df = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).text(folder, wholetext=True)
    return df.select(F.xxhash64(F.col("_metadata.file_path")).alias("doc_id"),
                     F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))


def csv_rows_as_documents(df: DataFrame, source: str, id_col: str, labelled: bool = False) -> DataFrame:
    """One document per CSV row: cell values on lines (or ``col: value``
    lines with ``labelled=True``).  Per-row documents keep rows whole when
    they are chunked."""
    cols = [c for c in df.columns]
    cells = [(F.concat(F.lit(c + ": "), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) if labelled
              else F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in cols]
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.lit(source).alias("source"),
                     F.concat_ws("\n", *cells).alias("text"))


def read_binary_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Binary files with their content and its base64 text (no line breaks)."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return df.select("path", "length", "content", base64_plain(F.col("content")).alias("b64"))
