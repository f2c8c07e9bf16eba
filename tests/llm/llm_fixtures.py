"""Small inputs that the tests of all operators share."""

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
#: Extra columns whose names the operators use themselves.
CLASH = "sid long, label string, n long, t string, row string, h string, hit string, th int, gram long, start long, c long, key string, sha string, prefix string, one string, epoch int, budget long"


def documents():
    """(doc_id, text, lang, source) of the smallest table."""
    t = pq.read_table(f"{SMALL}/documents.parquet").to_pydict()
    return list(zip(t["doc_id"], t["text"], t["lang"], t["source"]))


def edge_rows():
    """Nulls in every column, empty and blank texts, repeated rows, ties, one very long text."""
    base = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu. " * 4
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [
        (10_001, None, None, None),
        (None, "A text without an id, long enough to have several words in it. One more sentence here.", "en", "src1"),
        (10_002, "", "en", "src1"),
        (10_003, " \t\n\r ", "en", None),
        (10_004, "word", None, "odd"),
        (10_005, "12345 67890 !!", "de", "src2"),
        (10_006, base, "en", "src1"),
        (10_006, base, "en", "src1"),
        (10_007, base.replace(" ", "\n"), "en", "src3"),
        (10_008, base + "Tail.", None, "src3"),
        (10_009, long, "en", "src0"),
        (10_010, long + " end", "en", "src0"),
        (10_011, "é" * 150 + "ü" * 150, "fr", "src0"),
        (10_012, "中文 文字 " * 3, "zh", "src9"),
    ]


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    if clash:
        for c in CLASH.split(", "):
            name, kind = c.split()
            df = df.selectExpr("*", f"cast(1 as {kind}) as {name}")
    return df.repartition(3)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def rows_of(df, *keys):
    """Rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in df.select(*(keys or df.columns)).collect()), key=lambda r: [(x is not None, str(type(x)), x) for x in r])
