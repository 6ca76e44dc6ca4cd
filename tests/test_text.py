from pyspark.sql import functions as F

from tickerlens.functions import text as T
from tickerlens.operators.usjob import extract_ticker


def one(spark, values, fn, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col(df.columns[0]))).collect()]


def test_clean_text_removes_fixed_set_and_keeps_others(spark):
    assert one(spark, ["A&B (주), up"], T.headline_key) == ["AB 주"]
    assert one(spark, ["Acme", " Acme, x", "a\\b;{c}_d"], T.headline_key) == ["Acme", " Acme", "a\\b;{c}_d"]
    assert one(spark, ["-=+,#/?:^$.@*\"※~&%ㆍ!』‘|()[]<>`'…》x"], T.clean_text) == ["x"]


def test_extract_ticker_cases(spark):
    src = ["Acme (ACME) up", "Acme (ABCDE)", "Acme", "(2023) x", "() x", "x (AB", "a (B) (C)"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(src)], "i int, headline string")
    got = {r.i: r.ticker for r in extract_ticker(df).collect()}
    assert got == {0: "ACME", 3: "2023", 4: "", 5: "AB", 6: "B"}


def test_truncate_words(spark):
    assert one(spark, ["a  b", "a b c", "a  b c d"], lambda c: T.truncate_words(c, 3)) == [
        "a  b", "a b c", "a b c..."]
    assert one(spark, ["x y　z w"], lambda c: T.truncate_words(c, 2)) == ["x y..."]


def test_normalise_section_and_paragraph(spark):
    assert one(spark, [" a\n\tb  c "], T.normalise_ws) == [" a b c "]
    assert one(spark, ["x FORM 10-K body FORM 10-K tail", "none"],
               lambda c: T.section_after(c, "FORM 10-K")) == [" body ", None]
    assert one(spark, ["first\n\n  last block \n"], T.last_paragraph) == ["last block"]
    assert one(spark, ["Ab가 é!ㄱ"], T.keep_alnum_hangul) == ["Ab가 ㄱ"]


def test_sentences(spark):
    txt = "오늘은 비가 옵니다. 우산을 챙기는 편이 좋습니다. 저녁에는 갤 것입니다."
    assert one(spark, ["  " + txt], T.first_sentence) == ["오늘은 비가 옵니다."]
    assert one(spark, ["ab. c\nd! e"], lambda c: F.size(T.sentences(c))) == [2]
    assert one(spark, ["Mr. Smith went. Then? Yes e.g. this."], T.sentence_split) == [
        ["Mr. Smith went.", "Then?", "Yes e.g. this."]]


def test_number_formats(spark):
    assert one(spark, [1234567.9, -1234.5], T.fmt_int, "d double") == ["1,234,567", "-1,234"]
    assert one(spark, [150000000000.0, 0.30000000000000004, 1234.5], T.fmt_float, "d double") == [
        "150,000,000,000.0", "0.30000000000000004", "1,234.5"]
    assert one(spark, ["1,234,567/ 89", "-", None], T.parse_shares) == [1234567, None, None]


def test_zero_pad(spark):
    from tickerlens.operators.linking import stock_master
    df = spark.createDataFrame([("a", 5930), ("b", 1234567)], "n string, c long")
    assert [r.code for r in stock_master(df, "n", "c").collect()] == ["005930", "1234567"]


def test_anchor_attrs_first_anchor_rule(spark):
    from tickerlens.sources.html import anchor_attrs
    html = ("<dl><dd><a title='T1' href='x'>a</a></dd><dd><a href='y'>no title</a><a title='T2'>b</a></dd>"
            "<dd>no anchor</dd><dt><a title=\"D&amp;1\">c</a></dt></dl>")
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.slot, r.pos, r.value) for r in anchor_attrs(df, "title").orderBy("slot", "pos").collect()]
    assert got == [("dd", 0, "T1"), ("dt", 0, "D&1")]


def test_class_text_matches_class_token(spark):
    from tickerlens.sources.html import class_text
    html = '<a class="x jupiter">A &amp; B</a><a class="jupiter-2">no</a><a class="jupiter">C<b>D</b></a>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.text for r in class_text(df, "a", "jupiter").orderBy("pos").collect()] == ["A & B", "CD"]
