import pytest
from pyspark.sql import functions as F

from vellumflow.functions import text


def one(spark, change, value):
    return spark.createDataFrame([(value,)], "t string").select(change(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("change", "value", "expected"),
    [
        (text.normalize_chars, "ﬁ ﬂ ﬀ ﬃ ﬄ", "fi fl ff ffi ffl"),
        (text.normalize_chars, "a—b–c…\r\n", "a--b--c...\n"),
        (text.strip_artifacts, "a Preprints’ b", "a  b"),
        (text.strip_artifacts, "épreprint", "é"),
        (text.strip_artifacts, "preprintſ", "ſ"),
        (text.strip_artifacts, "a ſpreprint", "a ſ"),
        (text.strip_artifacts, "preprinted", "preprinted"),
        (text.strip_artifacts, "Detected 12\n diacritics.", "."),
        (text.strip_artifacts, "DETECTED 5 DIACRITICſ", "DETECTED 5 DIACRITICſ"),
        (text.strip_artifacts, "xno best wordſ!!y", "xy"),
        (text.strip_artifacts, "no\vbest words!", "no\vbest words!"),
        (text.join_hyphens, "infor-\n mation", "information"),
        (text.join_hyphens, "a-\nb-\nc", "ab-\nc"),
        (text.join_hyphens, "A-\nB", "A-\nB"),
        (text.normalize_lines, " a  b\t\tc \n---\n« »\n$+=\n|\n\n\xa0d\xa0", "a b c\n$+=\n|\nd"),
        (text.clean_text, "", ""),
        (text.clean_text, None, None),
        (text.clean_or_raw, "...\n--", "...\n--"),
        (text.clean_or_raw, " x ", "x"),
    ],
)
def test_cleaning(spark, change, value, expected):
    assert one(spark, change, value) == expected
