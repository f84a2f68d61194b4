"""Small tables with everything awkward in them."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASHING = (
    "doc", "doc_key", "host", "key", "text_hash", "fp", "component", "component_id", "size", "row", "found", "kept", "removed",
    "line", "words", "ids", "part", "start", "score", "segments", "template", "cut", "whole", "target", "documents", "level",
    "repetitions", "lost", "first", "rest", "word", "n", "bit", "members", "taken", "extra", "range",
)

SENTENCE = "The quick brown fox jumps over the lazy dog near the old river bank today. "


def docs(spark, *rows):
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(*r, *([None] * (4 - len(r)))) for r in rows]
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in full], SCHEMA)


def awkward(spark):
    same = "\n".join(SENTENCE * 2 + str(i) for i in range(8))
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \t\n\v\f\r ", None, None),
        (4, same, "en", "a"),
        (5, same, "en", "b"),
        (5, same, "en", "b"),
        (None, same, "en", None),
        (None, None, None, None),
        (6, "word " * 60_000, "en", "a"),
        (7, "x" * 20_000, "xx", "a"),
        (8, "日本語 テスト 🙂 é̃ \x00 ▁ " * 30, "ja", "c"),
        (8, "another text with the same id", "en", "c"),
        (9, "1234 5678 !!! ###", "en", "d"),
        (10, "a b", "en", "d"),
        (-11, "a b c <|endoftext|> don't", None, "d"),
    ]
    return docs(spark, *rows)


def clashing(df):
    return df.withColumns({name: F.lit("clash") for name in CLASHING})


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
