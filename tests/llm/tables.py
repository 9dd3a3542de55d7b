"""Small tables with every awkward case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog near the river bank while the old miller counts his coins"
LONG = " ".join(f"w{k * 7919 % 100003}" for k in range(30_000))

ROWS = [
    (1, PROSE, "en", "a", len(PROSE)),
    (2, PROSE, "en", "a", len(PROSE)),                      # an exact copy
    (3, PROSE.replace("old", "very old"), None, "a", None),   # a near copy
    (4, "", "en", None, 0),
    (5, None, None, None, None),
    (None, "a text without an id, of a few words", "en", "b", 36),
    (6, LONG, "en", "b", len(LONG)),
    (7, "ünïcödé ẞtraße 中文 \U0001f600 <|endoftext|> x", "de", "c", 40),
    (8, "mail bob@example.com or call +1 (212) 555-0100, host 10.0.0.1, card 4111 1111 1111 1111", "en", "c", 90),
    (8, "mail bob@example.com or call +1 (212) 555-0100, host 10.0.0.1, card 4111 1111 1111 1111", "en", "c", 90),
    (9, " \t\n ", "fr", "c", 4),
    (-3, "solo", "fr", "d", 4),
]


def awkward(spark):
    """The rows above with further columns whose names operators use inside."""
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("shard", "slot", "node", "size", "fp", "score", "kept", "key", "ids", "variant", "target", "h"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def nothing(spark):
    return awkward(spark).where("false")
