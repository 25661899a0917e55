from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from corpusengine.functions import text as T


def values(spark, column, **cells):
    frame = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{name} string" for name in cells))
    return frame.select(column.alias("x")).first().x


def test_split_java(spark):
    cases = {"a b  c ": ["a", "b", "", "c"], "   ": [], "": [""], "a \n": ["a", "\n"], None: None}
    for given, expected in cases.items():
        assert values(spark, T.split_java("t"), t=given) == expected


def test_tokenizers(spark):
    assert values(spark, T.tokenize_space("t"), t="A b  C ") == ["a", "b", "c"]
    assert values(spark, T.tokenize_sep("t", "[|]"), t="A|b||") == ["a", "b"]
    assert values(spark, T.tokenize_white("t"), t="A b  C ") == ["a", "b", "", "c"]
    assert values(spark, T.tokens("t", "word"), t="Ab, c-d 42") == ["Ab", "c", "d", "42"]
    assert values(spark, T.tokens("t", "cjk_bigram"), t="新华网 a网b") == ["新华", "华网", "a", "网", "b"]


def test_parse_tagged(spark):
    rows = values(spark, T.parse_tagged("t"), t="cat/n the run/v x/y/z w/")
    assert [(r.word, r.tag) for r in rows] == [("cat", "n"), ("run", "v"), ("x", "y")]


def test_keyword_token(spark):
    cases = [("cat", "n", True), ("cat", "d", False), ("c", "n", False), ("c\n", "n", False), ("cat", "wx", False)]
    for word, tag, expected in cases:
        assert values(spark, T.is_keyword_token(F.col("w"), F.col("t")), w=word, t=tag) is expected


def test_combine(spark):
    cases = [("a", "b", "a b"), (None, "b", "b"), ("a", None, "a"), (None, None, None)]
    for a, b, expected in cases:
        assert values(spark, T.combine("a", "b"), a=a, b=b) == expected


def test_origin_flag(spark):
    named = "来源：新华网-人民网"
    cases = [("新华网", named, "1"), ("新浪", named, "0"), (None, named, "0"), ("a", None, "0"), ("b", " a－b ", "1")]
    for site, source, expected in cases:
        assert values(spark, T.origin_flag("a", "b"), a=site, b=source) == expected


def test_clean_and_split(spark):
    assert values(spark, T.clean_text("t"), t=" 　a  b&nbsp;&nbspc\n\nd ") == "a b\nc\nd"
    parts = values(spark, T.split_sentences("t"), t="一二三四五六。短句！ abc  def g\tx\r\n;hello　world")
    assert parts == ["一二三四五六", "abc def g", "hello world"]
    assert values(spark, T.split_clauses("a", "b"), a=None, b="x，y\nz") == ["", "x", "y", "z"]
    assert values(spark, T.contains_cjk("t"), t="a龥") and not values(spark, T.contains_cjk("t"), t="abc")


def test_round_half_up_is_exact(spark):
    shares = sorted({a / b for b in (7, 40, 200, 1000, 4096) for a in range(b + 1)} | {0.075, 0.175, 0.425, 0.475, 0.0049999, 0.005})
    rows = spark.createDataFrame([(x,) for x in shares], "x double").select("x", T.round_half_up_2(F.col("x")).alias("y")).collect()
    exact = {x: float(Decimal(x).quantize(Decimal("0.01"), ROUND_HALF_UP)) for x in shares}
    assert {r.x: r.y for r in rows} == exact


def test_round_half_up(spark):
    for given, expected in [("0.285", 0.28), ("0.125", 0.13), ("0.6666", 0.67)]:
        assert values(spark, T.round_half_up_2(F.col("t").cast("double")), t=given) == expected
