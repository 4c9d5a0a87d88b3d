"""Documents that every operator has to take: missing, empty, long, equal and odd ones."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, node long, key long, "
    "score double, kept boolean, label int, features array<float>, row long, n long, candidates string"
)


def texts():
    prose = "the quick brown fox jumps over a lazy dog and runs home again before night falls on hills"
    long_text = " ".join(f"{prose} {i}" for i in range(400))
    return [
        (1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "one"), (5, "one"), (6, "a b"), (7, prose), (8, prose),
        (9, prose + " today"), (10, long_text), (11, long_text), (11, long_text), (12, "ÀÉ ß 日本語  x 😀😀"),
        (None, prose), (None, None), (13, "x" * 100_000), (14, "word " * 3000), (15, "a\x00b �"),
        (16, "line one\nline one\nline two\n\n\nline one"),
    ]


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en", "s", len(t or ""), 1, 2, 0.5, True, 1, [0.0], 3, 4, "c") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def ids_of(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda x: (x is not None, x))


ALL_IDS = sorted((i for i, _ in texts()), key=lambda x: (x is not None, x))
