import pytest
from pyspark.sql import functions as F

#: Names that the operators use inside; a table may have them as its own columns.
CLASHING = ["part", "bucket", "label", "node", "fp", "h", "length", "group", "start", "v", "salt",
            "ord", "shard", "score", "lang_pred", "__key", "component_id", "copies"]

LONG = "the quick brown fox " * 3000 + "x" * 5000
ODD = [
    (5, "Call +1 (234) 555-6789 or a.b@example.org now, please.", "en"),
    (5, "Call +1 (234) 555-6789 or a.b@example.org now, please.", "en"),
    (1, None, "en"),
    (2, "", None),
    (3, " \n\t ", "de"),
    (4, "12 34 ### 999.1.2.3", "fr"),
    (7, "the quick brown fox jumps over the lazy dog", "en"),
    (8, "the quick brown fox jumps over the lazy dog", "en"),
    (9, LONG, "en"),
    (10, "été \U0001f600 naïve   two  blanks\n\nand lines <|endoftext|> 's", "fr"),
    (None, "der schnelle braune Fuchs", "de"),
    (None, None, None),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in ODD], "doc_id long, text string, lang string, n_chars long")
    for c in CLASHING:
        df = df.withColumn(c, F.lit("x"))
    return df.repartition(3).checkpoint()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")
