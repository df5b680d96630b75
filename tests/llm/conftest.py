import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with extra columns whose names clash."""

    def make(*rows, extra=True):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(full, COLUMNS).repartition(2)
        if extra:
            for name in ("row", "score", "class", "component", "word", "line", "key", "position", "count"):
                frame = frame.selectExpr("*", f"'x' AS `{name}`")
        return frame

    return make


@pytest.fixture
def labelled(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return make


ODD = [
    (None, "a text without an id, but long enough to be one"),
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "word"),
    (5, "same words here\nsame words here\n" * 40),
    (5, "same words here\nsame words here\n" * 40),
    (6, "x" * 30_000),
    (7, "a b c " * 20_000),
    (8, "Émile ñandú 漢字 🙂 <|endoftext|> \x01 \x1c end."),
    (9, "@" * 500 + "+" * 500 + "1" * 5_000 + "." * 500),
]
