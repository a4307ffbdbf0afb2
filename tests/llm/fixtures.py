"""Small frames with the awkward rows every operator has to take."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG_WORDS = " ".join(f"w{i % 977} the of" for i in range(20_000))

# doc_id, text, lang, source, n_chars, and columns named like the operators' own
SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()), StructField("n_tokens", LongType()),
    StructField("component_id", StringType()), StructField("block", LongType()), StructField("p", StringType()),
    StructField("host", StringType()), StructField("tokens", LongType()), StructField("feature", StringType()),
])
PROSE = "the quick brown fox jumps over the lazy dog while many other animals look on from the far side of a river"


def row(doc_id, text, lang="en", source="src1"):
    return (doc_id, text, lang, source, len(text or ""), 7, "x", 1, "p", "h", 3, "f")


def awkward_rows():
    return [
        row(1, PROSE), row(2, PROSE), row(2, PROSE),  # a copy, and a repeated row
        row(3, PROSE + " again"), row(4, None), row(5, ""), row(6, "   \n\t "), row(7, "one two"), row(8, "One  TWO"),
        row(9, LONG_WORDS), row(10, LONG_WORDS + " end"), row(11, "Ünïcode É ñ 文字 \x00 token = \"" + "0a1b2c3d4e" * 4 + "\" bye"),
        row(None, PROSE), row(12, PROSE, None, None), row(13, "x " * 400, "de", "src2"),
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fixture_dir(spark, tmp_path, docs=None, **tables):
    """A folder of tables as the queries read them."""
    frames = {"documents": awkward(spark) if docs is None else docs, **tables}
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
