"""Cleaning model replies: cut to the outer braces, optional null patch,
strict JSON test, key-list test, status, field extraction, and the nested
chat-completion / request documents.

All built-in expressions; no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The status texts.
STATUS_OK, STATUS_NO_ANSWER, STATUS_INVALID = "OK", "NO_ANSWER", "INVALID_JSON"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def brace_trim(s) -> Column:
    """Everything from the first '{' to the last '}' ('' when there is no
    such span).  Text without any '{' keeps only a final '}' (what cutting
    at "not found" positions gives), which is never valid JSON either."""
    s = _c(s)
    no_open = F.instr(s, "{") == 0
    return (F.when(no_open, F.when(F.endswith(s, F.lit("}")), F.lit("}")).otherwise(F.lit("")))
            .otherwise(F.regexp_extract(s, r"(?s)\{.*\}", 0)))


def null_patch(s) -> Column:
    """Parity mode: every 'null' becomes "'none'" (which breaks the JSON)."""
    return F.replace(_c(s), F.lit("null"), F.lit("'none'"))


NON_FINITE = r"(?<![^\s:\[,])(?:NaN|-?Infinity)(?![^\s,\]}])"


def is_json(s, allow_nan: bool = False) -> Column:
    """Single JSON value; repeated keys are allowed.

    Two array probes parse the text: ``[s]`` must hold exactly one element and
    ``[s,0]`` exactly two (a stray ']' closes the probe array early and breaks
    the second count).  That parser also takes single-quoted strings and raw
    control characters, so without escapes and clean double-quoted strings no
    quote may be left.  ``allow_nan`` also accepts NaN and the infinities (a
    string that holds such a word stays a string).  Null -> false."""
    s = _c(s)
    if allow_nan:
        s = F.regexp_replace(s, NON_FINITE, "0")
    one = F.json_array_length(F.concat(F.lit("["), s, F.lit("]")))
    two = F.json_array_length(F.concat(F.lit("["), s, F.lit(",0]")))
    bare = F.regexp_replace(F.regexp_replace(s, r"(?s)\\.", ""), r'"[^"\x00-\x1f]*"', "")
    return F.coalesce((one == 1) & (two == 2) & ~bare.rlike("[\"']"), F.lit(False))


def clean_reply(reply, strict_parity: bool = False) -> Column:
    r = _c(reply)
    return brace_trim(null_patch(r) if strict_parity else r)


def reply_status(cleaned, allow_nan: bool = False) -> Column:
    c = _c(cleaned)
    return (F.when(is_json(c, allow_nan) & (c != "{}"), F.lit(STATUS_OK))
            .when(c == "{}", F.lit(STATUS_NO_ANSWER))
            .otherwise(F.lit(STATUS_INVALID)))


def keys_in_order(cleaned, keys) -> Column:
    """True when the JSON object's keys are exactly ``keys`` in that order (a
    repeated key counts where it comes first)."""
    c = _c(cleaned)
    want = F.array(*[F.lit(k) for k in keys])
    return F.coalesce(is_json(c) & (F.array_distinct(F.json_object_keys(c)) == want), F.lit(False))


def reply_fields(cleaned, keys, fill: str = "none") -> Column:
    """Struct of the named string fields; missing or null values -> ``fill``.
    Strict parser options: no single quotes, no comments."""
    schema = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    parsed = F.from_json(_c(cleaned), schema, {"allowSingleQuotes": "false", "mode": "PERMISSIVE"})
    return F.struct(*[F.coalesce(parsed[k], F.lit(fill)).alias(k) for k in keys])


# Chat completion reply document (nested), as returned by a chat API.
CHAT_REPLY_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("choices", T.ArrayType(T.StructType([
        T.StructField("finish_reason", T.StringType()),
        T.StructField("index", T.IntegerType()),
        T.StructField("logprobs", T.StringType()),
        T.StructField("message", T.StructType([
            T.StructField("content", T.StringType()),
            T.StructField("role", T.StringType()),
            T.StructField("function_call", T.StringType()),
            T.StructField("tool_calls", T.StringType()),
        ])),
    ]))),
    T.StructField("created", T.LongType()),
    T.StructField("model", T.StringType()),
    T.StructField("object", T.StringType()),
    T.StructField("system_fingerprint", T.StringType()),
    T.StructField("usage", T.StructType([
        T.StructField("completion_tokens", T.IntegerType()),
        T.StructField("prompt_tokens", T.IntegerType()),
        T.StructField("total_tokens", T.IntegerType()),
    ])),
])


def parse_chat_reply(doc) -> Column:
    return F.from_json(_c(doc), CHAT_REPLY_SCHEMA)


def chat_fields(parsed) -> list[Column]:
    """The flat fields of a parsed chat reply (first choice)."""
    p = _c(parsed)
    ch = p["choices"][0]
    return [
        p["id"].alias("id"), ch["finish_reason"].alias("finish_reason"), ch["index"].alias("choice_index"),
        ch["logprobs"].alias("logprobs"), ch["message"]["content"].alias("content"),
        ch["message"]["role"].alias("role"), ch["message"]["function_call"].alias("function_call"),
        ch["message"]["tool_calls"].alias("tool_calls"), p["created"].alias("created"),
        p["model"].alias("model"), p["object"].alias("object"),
        p["system_fingerprint"].alias("system_fingerprint"),
        p["usage"]["completion_tokens"].alias("completion_tokens"),
        p["usage"]["prompt_tokens"].alias("prompt_tokens"),
        p["usage"]["total_tokens"].alias("total_tokens"),
    ]


def request_payload(model, prompt, image_ref, max_tokens) -> Column:
    """Nested chat request: one user message with a text part and an image
    part.  ``to_json`` leaves out null fields, so one part struct type
    serves both parts (the text part has no image_url, the image part no
    text/temperature)."""
    part = lambda typ, temp, text, url: F.struct(
        F.lit(typ).alias("type"), temp.alias("temperature"), text.alias("text"),
        F.when(url.isNotNull(), F.struct(url.alias("url"))).alias("image_url"))
    null_s = F.lit(None).cast("string")
    parts = F.array(part("text", F.lit("0.0"), _c(prompt), null_s),
                    part("image_url", null_s, null_s, _c(image_ref)))
    return F.to_json(F.struct(
        _c(model).alias("model"), F.lit(False).alias("logprobs"),
        F.array(F.struct(F.lit("user").alias("role"), parts.alias("content"))).alias("messages"),
        _c(max_tokens).alias("max_tokens")))
