"""Awkward tables that every operator must take."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        T.StructField("_row", T.StringType()),
        T.StructField("_key1", T.StringType()),
        T.StructField("_quality", T.StringType()),
        T.StructField("label.x", T.StringType()),
    ]
)
LONG = "anfang " + " ".join(f"wort{i % 977} und{i % 31}" for i in range(60_000)) + "\nEnde."
TEXTS = [
    None,
    "",
    "   \n\t \n",
    "x",
    "Der Hund läuft\x0bschnell. Released UNDER the MIT License.",
    "Der Hund läuft\x0bschnell. Released UNDER the MIT License.",
    "퟿\U0001f600 emoji 𝒳 und Zeichen",
    LONG,
    "word " * 400,
    "\n".join(["same line here", "another line", "same line here", "", "", "  "]),
]


def awkward(spark):
    rows = [
        (i, t, "de" if i % 2 else None, f"src{i % 3}" if i % 4 else None, len(t or ""), "a", "b", None, "c")
        for i, t in enumerate(TEXTS)
    ]
    rows.append(rows[4])  # a row twice
    rows.append((None, "without an id", None, None, None, None, None, None, None))
    rows.append((None, None, None, None, None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id LONG, quality INT, toxic INT, _row STRING")


def benchmark(spark, rows=()):
    return spark.createDataFrame(list(rows), "item_id LONG, text STRING, _matches STRING")
