import json

from pyspark.sql import functions as F

from vellumflow.functions import messages


def parsed(spark, status, body):
    row = spark.createDataFrame([(status, body)], "s int, b string").select(messages.parse_response(F.col("s"), F.col("b")).alias("r")).first()["r"]
    return row["text"], row["error"]


def test_parse_response(spark):
    reply = lambda *parts: json.dumps({"candidates": [{"content": {"parts": [{"text": p} for p in parts]}}]})
    assert parsed(spark, 200, reply("one", "two")) == ("one\ntwo", None)
    assert parsed(spark, 200, reply("a", " \n", "b")) == ("a\nb", None)
    assert parsed(spark, 200, '{"candidates": []}') == (None, messages.NO_CANDIDATES)
    assert parsed(spark, 200, "{}") == (None, messages.NO_CANDIDATES)
    assert parsed(spark, 200, '{"error": {"message": "quota"}}') == (None, "quota")
    assert parsed(spark, 429, '{"error": {"message": "quota"}}') == (None, "HTTP 429: quota")
    assert parsed(spark, 500, " oops ") == (None, "HTTP 500: oops")
    assert parsed(spark, 200, "oops") == (None, "undecodable response")


def test_request_and_payload(spark):
    messages.unbroken_base64(spark)
    row = spark.createDataFrame([(bytes(range(10)), " page ")], "c binary, t string")
    assert row.select(messages.encode_payload(F.col("c"))).first()[0] == "AAECAwQFBgcICQ=="
    made = json.loads(row.select(messages.build_request(messages.build_prompt(F.col("t"), "Do."), F.lit("image/png"), messages.encode_payload(F.col("c")))).first()[0])
    assert made["contents"][0]["parts"] == [{"text": "Do." + messages.MARKER + "page"}, {"inlineData": {"mimeType": "image/png", "data": "AAECAwQFBgcICQ=="}}]
    assert made["generationConfig"] == {"temperature": 0.1, "topK": 40, "topP": 0.95, "maxOutputTokens": 8192}
    assert len(spark.createDataFrame([(b"x" * 500,)], "c binary").select(messages.encode_payload(F.col("c"))).first()[0].split()) == 1
