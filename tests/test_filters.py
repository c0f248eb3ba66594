from siltstone.operators.filters import accepted, quality_filter

GOOD = "def total_{0}(items, scale):\n    result = 0\n    count = 1\n    for item in items:\n        value = item * scale\n        if value > count:\n            result += value\n        count += 1\n    average = result / count\n    print(average, count, scale)\n    return result\n"


def documents(spark, rows):
    return spark.createDataFrame(rows, "document_id string, content string, language string, file_path string, is_vendor boolean")


def reasons(df):
    return {r["document_id"]: r["rejection_reason"] for r in df.collect()}


def test_each_screen(spark):
    good = GOOD.format("a")
    rows = [
        ("good", good, "Python", "src/a.py", None),
        ("null", None, "Python", "a.py", False),
        ("blank", "  \n", "Python", "a.py", False),
        ("nul", good + "\x00", "Python", "a.py", False),
        ("vendor", "// generated by x\n" + good, "Python", "src\\Vendor\\a.py", False),
        ("flag", good, "Python", None, True),
        ("generated", "# Do Not Edit\n" + good, "Python", "a.py", False),
        ("secret", "API_KEY = 'abcdefgh'\n" + good, "Python", "a.py", False),
        ("akia", "# akia" + "a1" * 8 + "\n" + good, "Python", "a.py", False),
        ("short", "x", "Python", "a.py", False),
        ("copies", "same line of text here\n" * 12, "Python", "a.py", False),
    ]
    got = reasons(quality_filter(documents(spark, rows)))
    assert got == {"good": None, "null": "malformed", "blank": "malformed", "nul": "malformed", "vendor": "vendor", "flag": "vendor", "generated": "generated", "secret": "secret", "akia": "secret", "short": "too_few_characters", "copies": "too_many_duplicate_lines"}


def test_parse_error_and_struct(spark):
    df = documents(spark, [("a", GOOD.format("a"), "Python", "a.py", False), ("b", GOOD.format("b") + "def bad(:", "Python", "b.py", False)])
    out = quality_filter(df, parser=lambda _, texts: ["(:" in t for t in texts])
    assert reasons(out) == {"a": None, "b": "parse_error"}
    row = out.where("document_id = 'b'").first()
    assert (row["rejection_signal"], row["rejection_value"], row["rejection_threshold"]) == ("parse_error", 1.0, 0.0)
    assert accepted(out).columns == [*df.columns, "quality_signals"]


def test_signals_are_null_for_text_rejections(spark):
    row = quality_filter(documents(spark, [("v", GOOD.format("v"), "Python", "vendor/x.py", False)])).first()
    assert row["quality_signals"] is None and row["rejection_reason"] == "vendor"


def test_empty_table_extra_and_clashing_columns(spark):
    df = spark.createDataFrame([("a", GOOD.format("x"), "Python", "old", 7)], "document_id string, content string, language string, rejection_reason string, extra int")
    out = quality_filter(df)
    assert out.first()["extra"] == 7 and out.first()["rejection_reason"] is None
    assert quality_filter(df.limit(0)).count() == 0
