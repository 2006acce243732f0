"""Chat documents: reply documents as a chat API returns them (built from
conversation turns, for parsing and usage totals) and request payloads
with a text part and an image part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.replies import parse_chat_reply, chat_fields, request_payload
from ..functions.text import image_reference, token_count

CREATED_BASE = 1_700_000_000


def chat_reply_docs(conversations: DataFrame, model_col=None) -> DataFrame:
    """One reply document per assistant turn.  Usage: completion tokens of
    the reply, prompt tokens of the turn before it (an equi-join on
    (conv_id, turn - 1), not a window, so a long conversation is no hot
    group)."""
    c = conversations.select("conv_id", "turn", "role", "text")
    prev = c.select("conv_id", (F.col("turn") + 1).alias("turn"), token_count("text").alias("prompt_tokens"))
    a = c.filter(F.col("role") == "assistant").join(prev, ["conv_id", "turn"], "left")
    model = model_col if model_col is not None else F.lit("chat-model")
    comp = token_count("text")
    pt = F.coalesce("prompt_tokens", F.lit(0))
    null_s = F.lit(None).cast("string")
    doc = F.to_json(F.struct(
        F.concat(F.lit("reply-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.array(F.struct(F.lit("stop").alias("finish_reason"), F.lit(0).alias("index"), null_s.alias("logprobs"),
                         F.struct(F.col("text").alias("content"), F.col("role").alias("role"),
                                  null_s.alias("function_call"), null_s.alias("tool_calls")).alias("message"))).alias("choices"),
        (F.lit(CREATED_BASE) + F.col("conv_id") * 10 + F.col("turn")).alias("created"),
        model.alias("model"), F.lit("chat.completion").alias("object"), null_s.alias("system_fingerprint"),
        F.struct(comp.alias("completion_tokens"), pt.cast("int").alias("prompt_tokens"),
                 (comp + pt).cast("int").alias("total_tokens")).alias("usage")))
    return a.select("conv_id", "turn", doc.alias("reply"))


def reply_table(docs: DataFrame) -> DataFrame:
    """The flat fields of every reply document."""
    p = docs.select("conv_id", "turn", parse_chat_reply(F.col("reply")).alias("p"))
    return p.select("conv_id", "turn", *chat_fields(F.col("p")))


def usage_totals(replies: DataFrame) -> DataFrame:
    return replies.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_replies"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("total_tokens").alias("total_tokens"))


def page_requests(pages: DataFrame, model: str, prompt: str, max_tokens: int = 4096) -> DataFrame:
    """A request per page: https URLs are sent as URLs, anything else as a
    jpeg data URL of the page bytes."""
    src = F.when(F.col("url").startswith("https://"), F.lit("url")).otherwise(F.lit("file"))
    ref = image_reference(src, F.col("url"), F.col("html").cast("binary"))
    return pages.select("page_id", ref.alias("image_ref"),
                        request_payload(F.lit(model), F.lit(prompt), ref, F.lit(max_tokens)).alias("request"))
