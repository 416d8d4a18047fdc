"""Requests to and responses from a language model, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from vellumflow.functions.text import trim_space
from vellumflow.schema import LLM_RESPONSE

# The model's parameters, the texts between prompt and page, the prompt where none is set.
TEMPERATURE, TOP_K, TOP_P, MAX_TOKENS = 0.1, 40, 0.95, 8192
MARKER = "\n\nOCR TEXT FOLLOWS:\n\n"
NO_TEXT = "[This page contains little or no OCR text. Describe relevant content from the image in clear narration.]"
DEFAULT_PROMPT = "You are a PhD-level technical narrator. Integrate commentary derived from the page image into the OCR text, producing a coherent narration for text-to-speech. Maintain technical accuracy, describe figures/code/tables as natural prose inserted near the relevant context, avoid markdown, and output continuous paragraphs."

#: What a reply without any answer is reported as.
NO_CANDIDATES = "reply holds no candidate"


def encode_payload(content: Column) -> Column:
    """Base64 in one line; needs unbroken_base64()."""
    return F.base64(content)


def unbroken_base64(spark: SparkSession) -> None:
    """Spark breaks base64 into lines unless told otherwise."""
    spark.conf.set("spark.sql.chunkBase64String.enabled", "false")


def build_prompt(text: Column, prompt: str = "") -> Column:
    page = trim_space(F.coalesce(text, F.lit("")))
    return F.concat(F.lit((prompt or DEFAULT_PROMPT) + MARKER), F.when(page == "", F.lit(NO_TEXT)).otherwise(page))


def build_request(prompt: Column, mime: Column, data: Column) -> Column:
    """The request's JSON: a user turn of a text and an image."""
    parts = F.array(
        F.struct(prompt.alias("text"), F.lit(None).cast("struct<mimeType:string,data:string>").alias("inlineData")),
        F.struct(F.lit(None).cast("string").alias("text"), F.struct(mime.alias("mimeType"), data.alias("data")).alias("inlineData")),
    )
    settings = F.struct(F.lit(TEMPERATURE).alias("temperature"), F.lit(TOP_K).alias("topK"), F.lit(TOP_P).alias("topP"), F.lit(MAX_TOKENS).alias("maxOutputTokens"))
    return F.to_json(F.struct(F.array(F.struct(F.lit("user").alias("role"), parts.alias("parts"))).alias("contents"), settings.alias("generationConfig")))


def parse_response(status: Column, body: Column) -> Column:
    """(text, error) of a reply: parts of the first candidate that are not blank, a line each. Errors
    are replies out of the 200s, told ones, undecodable ones and those without candidates."""
    reply = F.from_json(body, LLM_RESPONSE)
    ok = (status >= 200) & (status < 300)
    told = reply["error"]["message"]
    told = F.when(F.coalesce(told, F.lit("")) != "", told)
    broken = reply.isNull() | (reply["candidates"].isNull() & reply["error"].isNull() & ~F.coalesce(body.rlike("^[\\t\\n\\r ]*\\{"), F.lit(False)))
    error = (
        F.when(~ok, F.concat(F.lit("HTTP "), status.cast("string"), F.lit(": "), F.coalesce(told, trim_space(F.coalesce(body, F.lit(""))))))
        .when(broken, F.lit("undecodable response"))
        .when(told.isNotNull(), told)
        .when(F.coalesce(F.size(reply["candidates"]), F.lit(0)) <= 0, F.lit(NO_CANDIDATES))
    )
    parts = F.transform(F.coalesce(F.get(reply["candidates"], F.lit(0))["content"]["parts"], F.array().cast("array<struct<text:string>>")), lambda p: F.coalesce(p["text"], F.lit("")))
    text = F.array_join(F.filter(parts, lambda p: trim_space(p) != ""), "\n")
    return F.struct(F.when(error.isNull(), text).alias("text"), error.alias("error"))
