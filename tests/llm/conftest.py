import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Columns whose names clash with results or helpers of the operators.
CLASHING = ("shard", "slot", "size", "h", "doc", "tag", "_id", "_rank", "_row", "kept", "score", "copies", "root", "tokens", "level")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        """Documents from (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """Nulls, empty and wordless texts, a very long text, repeated rows and extra columns."""
    words = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two three, four five six.\nSeven eight."), (4, "One two three, four five six.\nSeven eight."),
            (None, "No id but a text of some words\nand a second line"), (5, words), (6, words), (7, "é" * 3), (8, "x\x00y \x85 z")]
    df = docs_of(rows).withColumn("source", F.when(F.col("doc_id") > 5, F.col("source")))
    for name in CLASHING:
        df = df.withColumn(name, F.lit("extra"))
    return df
