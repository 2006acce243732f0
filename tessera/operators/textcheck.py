"""Whole-text checks: character census (code point counts) and XML
well-formedness with the parser's message."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def char_census(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Count of every character (by code point) over all texts.

    ``explode`` feeds a partial hash aggregate in the same codegen stage, so
    only (code point, partial count) pairs are shuffled - bounded by the
    alphabet, not by the text volume."""
    chars = df.select(F.explode(F.split(F.col(text_col), "")).alias("ch")).filter(F.col("ch") != "")
    return (chars.groupBy("ch").agg(F.count(F.lit(1)).alias("n"))
            .select(F.ascii("ch").cast("bigint").alias("code_point"), "ch", "n"))


# The messages of the check.
WELL_FORMED, NOT_WELL_FORMED = "The XML is well-formed.", "XML is not well-formed: "


class _Discard:
    """A parser target that keeps nothing: no tree is built."""

    def close(self) -> None:
        return None


def parser_fault(text: str | None) -> str | None:
    """What the parser finds wrong with a text, None when it is well-formed."""
    if text is None:
        return "no text"
    parser = ET.XMLParser(target=_Discard())
    try:
        parser.feed(text)
        parser.close()
    except ET.ParseError as e:
        return str(e)


def surely_well_formed(xml) -> Column:
    """True where the JVM alone can tell that a text is well-formed: its
    reader finds no fault, and what that reader lets pass is ruled out by the
    text's form - content after the root element (the root's name opens and
    closes once and its end tag, or its own slash, ends the text), prefixed names (their
    namespace may be missing), declarations and other prolog.  All other texts
    are left to the parser, which names their fault."""
    x = F.col(xml) if isinstance(xml, str) else xml
    root = F.regexp_extract(x, r"^\s*<([A-Za-z_][A-Za-z0-9_.-]*)(?=[\s/>])", 1)
    starts = F.regexp_like(x, F.lit(r"""^\s*<[^\s<>/"']+(?:\s(?:[^<>"']|"[^"<]*"|'[^'<]*')*)?(?<!/)>"""))
    opened = starts & (F.size(F.split(x, F.concat(F.lit(r"<\Q"), root, F.lit(r"\E(?![A-Za-z0-9_.:-])")))) == 2)
    once = F.size(F.split(x, F.concat(F.lit(r"</\Q"), root, F.lit(r"\E(?![A-Za-z0-9_.:-])")))) == 2
    closed = once & F.rtrim(x, F.lit(" \t\r\n")).endswith(F.concat(F.lit("</"), root, F.lit(">")))
    alone = F.regexp_like(x, F.lit(r"^\s*<[^<>]*/>\s*$"))
    plain = ~F.regexp_like(x, F.lit(r"</?[^\s<>/]*:|<[^<>]*\s[^\s<>=]*:[^\s<>=]*\s*=|[^\x09\x0a\x0d\x20-\x{d7ff}\x{e000}-\x{fffd}\x{10000}-\x{10ffff}]|<!(?!--)|<\?"))
    fault = F.from_xml(x, "_corrupt_record string", {"mode": "PERMISSIVE"})["_corrupt_record"]
    return F.coalesce((root != "") & ((opened & closed) | alone) & plain & fault.isNull(), F.lit(False))


def faults():
    """Arrow-batched function: the fault of each text, null where it has none."""
    return F.pandas_udf(lambda s: s.map(parser_fault, na_action=None).astype(object), "string")


def xml_quality(df: DataFrame, id_col: str, xml_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: well-formed flag and message, with the ``carry`` columns.
    The JVM settles the well-formed texts; Python reads only the others, for
    the message."""
    sure = df.select(id_col, *carry, F.col(xml_col).alias("_x"), surely_well_formed(xml_col).alias("_sure"))
    asked = sure.withColumn("_fault", F.when(~F.col("_sure"), faults()(F.when(F.col("_sure"), F.lit("<a/>")).otherwise(F.col("_x")))))
    valid = F.col("_fault").isNull()
    return asked.select(id_col, *carry, valid.alias("valid"), F.when(valid, F.lit(WELL_FORMED)).otherwise(F.concat(F.lit(NOT_WELL_FORMED), "_fault")).alias("message"))


def quarantined(df: DataFrame, checked: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows, quarantined rows with the parser's message) of
    ``df``.  ``checked`` is best a written table: both halves read it."""
    good = checked.filter("valid").select(id_col)
    return df.join(good, id_col, "left_semi"), df.join(checked.filter("NOT valid").select(id_col, "message"), id_col)


def quality_by_source(checked: DataFrame, source_col: str) -> DataFrame:
    """Documents, well-formed ones and the kinds of fault (message without its
    position) per source; map-side counts, so a source with most documents is
    no hot task."""
    fault = F.when(~F.col("valid"), F.regexp_replace("message", r": line \d+, column \d+$", ""))
    return checked.groupBy(source_col, fault.alias("fault")).agg(F.count("*").alias("n_docs"))
