"""Replies with keys that nobody listed: the keys beyond a known list as a
map, or one typed column for every key that occurs.

The columns of the dynamic table are found by one distributed pass: every
reply is a VARIANT, each of its keys gives (key, where it was first seen, its
value's type), and an aggregate per key merges the types and keeps the first
sight, as an assembled list of dictionaries would order its columns.  Whole
numbers stay whole, other numbers become doubles, true and false booleans, one
text type holds strings, mixed types and nested values (as JSON text).  The
driver sees one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import replies as R

MAX_KEYS = 1_000  # columns of a dynamic table; keys beyond stay in ``extra``
TYPES = {"BIGINT": "bigint", "BOOLEAN": "boolean", "DOUBLE": "double", "FLOAT": "double"}


def reply_map(cleaned) -> Column:
    """Top-level keys and values of a JSON object as text (nested values as
    JSON); of a repeated key the last value.  Null unless it is valid JSON."""
    c = F.col(cleaned) if isinstance(cleaned, str) else cleaned
    return F.when(R.is_json(c), F.from_json(c, "map<string,string>", {"allowSingleQuotes": "false"}))


def extra_fields(cleaned, known, fill: str = "none") -> Column:
    """The keys of a reply that ``known`` does not list; a null value becomes
    ``fill``, as in ``reply_fields``."""
    known = F.array(*[F.lit(k) for k in known]).cast("array<string>")
    kept = F.map_filter(reply_map(cleaned), lambda k, v: ~F.array_contains(known, k))
    return F.transform_values(kept, lambda k, v: F.coalesce(v, F.lit(fill)))


def with_extra(df: DataFrame, keys, id_col: str = "reply_id", reply_col: str = "reply") -> DataFrame:
    """One row per reply: id, status, the listed fields and ``extra``, a map
    of all others (OK rows)."""
    c = df.select(id_col, R.clean_reply(F.col(reply_col)).alias("cleaned"))
    c = c.withColumn("error", R.reply_status("cleaned"))
    ok, fields = F.col("error") == R.STATUS_OK, R.reply_fields("cleaned", keys)
    return c.select(id_col, "error", *[F.when(ok, fields[k]).alias(k) for k in keys], F.when(ok, extra_fields("cleaned", keys)).alias("extra"))


def key_table(replies: DataFrame, order_col: str) -> DataFrame:
    """(key, first, place, type) of every key of ``cleaned`` replies: the first
    reply in ``order_col`` order that holds it, its place there, and the merged
    type of its values."""
    spark = replies.sparkSession
    sight = (replies.select(order_col, F.posexplode(F.json_object_keys("cleaned")).alias("place", "key"))
             .groupBy("key").agg(F.min(F.struct(F.col(order_col).alias("first"), "place")).alias("s")))
    parsed = replies.select(F.expr("try_parse_json(cleaned)").alias("v"))
    kinds = (parsed.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("key", "value")
             .groupBy("key").agg(F.expr("schema_of_variant_agg(value)").alias("type")))
    return sight.join(kinds, "key", "left").select("key", "s.first", "s.place", "type")


def dynamic_rows(df: DataFrame, id_col: str = "reply_id", reply_col: str = "reply", max_keys: int = MAX_KEYS) -> DataFrame:
    """One row per reply: id, a typed column per key in the order of first
    sight (by ``id_col``), ``extra`` (keys without a column: beyond
    ``max_keys``, equal to a carried column, or differing from an earlier key
    by case only), ``error`` and ``error_output``."""
    c = df.select(id_col, R.clean_reply(F.col(reply_col)).alias("cleaned"))
    c = c.withColumn("error", R.reply_status("cleaned"))
    ok = F.col("error") == R.STATUS_OK
    found = key_table(c.filter(ok), id_col).orderBy(F.asc_nulls_last("first"), "place").limit(max_keys).collect()  # one row a column
    taken, columns = {id_col.lower(), "extra", "error", "error_output"}, []
    for r in found:
        if r.key.lower() not in taken:
            taken.add(r.key.lower())
            columns.append((r.key, "double" if (r.type or "").startswith("DECIMAL") else TYPES.get(r.type, "string")))
    c = c.withColumn("_map", F.when(ok, reply_map("cleaned")))
    return c.select(id_col, *[F.col("_map")[F.lit(k)].try_cast(t).alias(k) for k, t in columns],
                    F.when(ok, F.map_filter("_map", lambda k, v: ~F.array_contains(F.array(*[F.lit(k) for k, _ in columns]).cast("array<string>"), k))).alias("extra"),
                    "error", F.when(ok, F.lit("NA")).otherwise(F.col("cleaned")).alias("error_output"))
