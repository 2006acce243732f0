"""Table functions for SQL: the recursive splitter as a Python UDTF.

    register(spark)
    SELECT d.doc_id, c.* FROM documents d, LATERAL split_text(d.text, 300, 100) c

``analyze`` checks the constants before the query runs and tells which columns
come out, so a wrong size is an error of the query, not of a task.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..operators.chunking import chunk_with_offsets, token_length

LENGTHS = {"characters": len, "tokens": token_length}


class SplitText:
    """split_text(text, size, overlap [, unit]): chunk_no, start_index, chunk.
    ``unit`` measures the size in 'characters' (default) or 'tokens'; a null or
    empty text gives no rows."""

    @staticmethod
    def analyze(text: AnalyzeArgument, size: AnalyzeArgument, overlap: AnalyzeArgument, unit: AnalyzeArgument | None = None) -> AnalyzeResult:
        for name, arg in (("size", size), ("overlap", overlap)):
            if not arg.isConstantExpression or not isinstance(arg.value, int):
                raise ValueError(f"split_text: {name} must be a whole constant")
        if not 0 <= overlap.value < size.value:
            raise ValueError(f"split_text: overlap {overlap.value} is not below size {size.value}")
        if unit is not None and unit.value not in LENGTHS:
            raise ValueError(f"split_text: unit must be one of {sorted(LENGTHS)}")
        if not isinstance(text.dataType, (T.StringType, T.NullType)):
            raise ValueError("split_text: text must be a string")
        return AnalyzeResult(T.StructType().add("chunk_no", T.IntegerType()).add("start_index", T.IntegerType()).add("chunk", T.StringType()))

    def eval(self, text: str, size: int, overlap: int, unit: str = "characters"):
        for no, (start, chunk) in enumerate(chunk_with_offsets(text or "", size, overlap, LENGTHS[unit])):
            yield no, start, chunk


def register(spark: SparkSession) -> None:
    """Make ``split_text`` callable from SQL in this session."""
    spark.udtf.register("split_text", udtf(SplitText))
