import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.functions import text as T

TEXTS = [None, "", " ", "a", "ab cd", "é² x_1", "a\r\nb\rc\n", "\n", "x\x1cy\x85z w", "a b　c", "  lead and trail \t", "(a+b)*c", "日本 語", "one\n\n\nfour", "😀b"]


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def values(spark, texts, column):
    return [r[0] for r in rows(spark, texts).orderBy("i").select(column).collect()]


def py_tokens(t):
    return re.findall(r"\w+|[^\w\s]", t or "")


def py_shingles(tokens):
    if not tokens:
        return {""}
    return {" ".join(tokens[i : i + 5]) for i in range(max(1, len(tokens) - 4))}


def test_text_functions_agree_with_python(spark):
    t = F.col("t")
    assert values(spark, TEXTS, T.normalize(t)) == [None if x is None else re.sub(r"\s+", " ", x).strip() for x in TEXTS]
    assert values(spark, TEXTS, T.strip(t)) == [None if x is None else x.strip() for x in TEXTS]
    assert values(spark, TEXTS, T.rstrip(t)) == [None if x is None else x.rstrip() for x in TEXTS]
    assert values(spark, TEXTS, T.token_count(t)) == [len((x or "").split()) for x in TEXTS]
    assert values(spark, TEXTS, T.tokens(t)) == [py_tokens(x) for x in TEXTS]
    assert values(spark, TEXTS, T.lines(t)) == [None if x is None else x.splitlines() for x in TEXTS]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab_1 .\n\t\r\x0b\x1c\x85 é", max_size=40), min_size=1, max_size=40))
def test_random_texts(spark, texts):
    t = F.col("t")
    assert values(spark, texts, T.lines(t)) == [x.splitlines() for x in texts]
    assert [set(x) for x in values(spark, texts, T.shingles(T.tokens(t)))] == [py_shingles(py_tokens(x)) for x in texts]
    assert values(spark, texts, T.normalize(t)) == [re.sub(r"\s+", " ", x).strip() for x in texts]


def test_fences(spark):
    texts = ["no fence ", "x ```bash\nrun me\n``` y", "```\nplain\n```", "```Python\ncode\n```"]
    assert values(spark, texts, T.fenced_block(F.col("t"), "bash")) == ["no fence", "run me", "plain", "Python\ncode"]
    assert values(spark, ["```py\na\nb\n```\n", "a ```x``` b"], T.unwrap_fence(F.col("t"))) == ["a\nb", "a ```x``` b"]


def test_windows_of_short_lists(spark):
    assert values(spark, ["", "a", "a b", "a b c"], T.windows(T.tokens(F.col("t")), 2)) == [[], [], ["a b"], ["a b", "b c"]]
