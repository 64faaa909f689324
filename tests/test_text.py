from pyspark.sql import functions as F

from pairforge.functions.text import clean_text, drop_missing, na_to_null, strip_text, words

CLEANUP = [
    ("Hello, World!", "hello world "),
    ("C'est l'été… 3.14%", "c'est l'été 3 14 "),
    ("...", " "),
    ("a\tb", "a\tb"),
    ("snake_case", "snake_case"),
    ("  x  ", "x"),
    ("½ litre", "½ litre"),
    ("éa", "e a"),
    (" NBSP x", "nbsp x"),
]


def test_clean_text_literals(spark):
    df = spark.createDataFrame([(a,) for a, _ in CLEANUP], "t string")
    got = [r[0] for r in df.select(clean_text("t")).collect()]
    assert got == [b for _, b in CLEANUP]


def test_clean_matches_python(spark, sf):
    import re
    punct = re.compile(r"[^\w\s\d']")
    runs = re.compile(r"[\.\s]{2,}")

    def py(t):
        t = t.lower().strip()
        return runs.sub(" ", punct.sub(" ", t))
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select("text", clean_text("text").alias("c")).collect()
    assert rows and all(py(r.text) == r.c for r in rows)


def test_strip_and_words(spark):
    df = spark.createDataFrame([("  a  b　",)], "t string")
    r = df.select(strip_text("t").alias("s"), words("t").alias("w")).first()
    assert r.s == "a  b" and r.w == ["a", "b"]


def test_missing_values(spark):
    rows = [("a", "b"), ("", "c"), ('say "hi", ok', ""), ("NA", "d"), ("nan", "e"), ("x,y", "f"),
            ('back\\slash "q\\"', "g"), ("None", "h"), ("null", "i"), (" pad ", "j"), ("n/a", "k")]
    df = spark.createDataFrame(rows, "en string, fr string")
    d = df.select(na_to_null("en").alias("en"), na_to_null("fr").alias("fr"))
    kept = sorted(tuple(r) for r in drop_missing(d, ["en", "fr"]).collect())
    assert kept == sorted([("a", "b"), ("x,y", "f"), ('back\\slash "q\\"', "g"), (" pad ", "j")])


def test_drop_missing_na_flag(spark):
    df = spark.createDataFrame([("NA", "x"), ("ok", None), ("ok", "fine")], "a string, b string")
    assert drop_missing(df, ["a", "b"], na_values=True).count() == 1
    assert drop_missing(df, ["a", "b"]).count() == 2
    assert df.select(F.lit(1)).count() == 3
