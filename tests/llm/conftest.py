import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside; extra columns may be called the same.
CLASHES = ("id", "row", "digest", "size", "copies", "nth", "node", "keep_id", "group_size", "component", "shard", "ids2")


@pytest.fixture
def documents(spark):
    """``documents((doc_id, text), ...)`` or ``(doc_id, text, source[, lang])``, with extra columns of clashing names."""

    def make(*rows, clashes=True):
        full = []
        for row in rows:
            doc_id, text, source, lang = (*row, *("s", "en")[len(row) - 2 :]) if len(row) < 4 else row
            full.append((doc_id, text, lang, source, len(text or "")) + ((7,) * len(CLASHES) if clashes else ()))
        extra = "".join(f", {name} int" for name in CLASHES) if clashes else ""
        return spark.createDataFrame(full, SCHEMA + extra)

    return make


@pytest.fixture
def labels(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return make
