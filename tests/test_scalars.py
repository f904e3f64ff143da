from pyspark.sql import functions as F

from skein.functions import scalars as S


def _one(spark, col, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(col).collect()]


def test_pretty_duration(spark):
    secs = [(5.0,), (65.5,), (3600.0,), (694861.25,), (0.0,)]
    got = _one(spark, S.pretty_duration("s"), secs, "s double")
    assert got == ["5.00s", "1m, 5.50s", "1h, 0m, 0.00s", "1w, 1d, 1h, 1m, 1.25s", "0.00s"]


def test_canonical_symbol(spark):
    got = _one(spark, S.canonical_symbol("s"), [("CURRENCY:BTCUSD",), ("TLV:137",), ("TLV:999",), ("AAPL",)],
               "s string")
    assert got == ["BTC-USD", "^TA125.TA", "999.TA", "AAPL"]


def test_script_tests(spark):
    data = [("שלום world",), ("سلام",), ("",), (None,)]
    he = _one(spark, S.has_script("t", "hebrew"), data, "t string")
    assert he == [True, False, False, None]
    pct = _one(spark, S.script_pct("t", "english"), data, "t string")
    assert [round(x, 4) for x in pct] == [0.5, 0.0, 0.0, 0.0]


def test_search_params(spark):
    df = spark.createDataFrame([("textlike abc def;;; ;;;limit 5;;;chat_id",)], "p string")
    m = df.select(S.search_params("p").alias("m")).first().m
    assert m == {"textlike": "abc def", "limit": "5", "chat_id": None}


def test_message_template(spark):
    df = spark.createDataFrame([(3, "A B", None, None, "")], "i long, s string, rs string, ri long, t string")
    line = df.select(S.message_template("i", "s", "rs", "ri", "t")).first()[0]
    assert line == ('<message id="3" sender="A B" responds_to_sender="None" responds_to_message_id="None">'
                    'Message has no content (possibly media?)</msg>')


def test_tagged_and_json_responses(spark):
    df = spark.createDataFrame([("  <SUMMARY>s</SUMMARY><MSG ID='12'>hi</MSG>",), ("plain",)], "r string")
    rows = df.select(S.tagged_summary("r"), S.tagged_message("r"), S.tagged_reply_to("r")).collect()
    assert tuple(rows[0]) == ("s", "hi", 12) and tuple(rows[1]) == (None, None, None)
    js = spark.createDataFrame([('{"should_participate": true, "response_text": "x", "reply_to_message_id": 4}',),
                                ("garbage",), ('{"should_participate": false, "response_text": "y"}',)], "r string")
    out = [tuple(r[0]) for r in js.select(S.json_response("r")).collect()]
    assert out == [("x", 4), (None, None), (None, None)]


def test_search_params_repeated_key_keeps_the_last(spark):
    df = spark.createDataFrame([("a 1;;;b 2;;;a 3;;; ;;;c",), ("",), (None,)], "s string")
    got = [r.m for r in df.select(S.search_params("s").alias("m")).collect()]
    assert got == [{"a": "3", "b": "2", "c": None}, {}, None]
