"""Hand-traced splitter cases (exact bytes)."""

import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import messages, records
from queuelake.functions import xml as xx
from queuelake.operators.splitters import split_json, split_lines, split_records, split_xml

N = "\n"


def run_xml(spark, payload, **kw):
    return [(p, v, e) for _, p, v, e in records(split_xml(messages(spark, [payload]), **kw))]


@pytest.mark.parametrize(
    "payload,expected",
    [
        ("<r><i><a>1</a></i><i><a>2</a></i></r>", [(0, "<i>\n<a>1</a>\n</i>\n"), (1, "<i>\n<a>2</a>\n</i>\n")]),
        ("<r>\n  <i>\n    <a>1</a>\n  </i>\n</r>", [(0, "  <i>\n    <a>1</a>\n  </i>\n")]),
        ("<r>\r\n  <i>\r\n    <a>1</a>\r\n  </i>\r\n</r>", [(0, "  <i>\n    <a>1</a>\n  </i>\n")]),
        ("<r>\n<i><a>1</a></i>\n<i><a>2</a></i>\n</r>", [(0, "<i><a>1</a></i>\n"), (1, "<i><a>2</a></i>\n")]),
        ("<r><i>1</i><i>2</i></r>", [(0, "<i>1</i>\n"), (1, "<i>2</i>\n")]),
        ("<r><i/><ix>z</ix></r>", []),
        ('<r><i k="1"/><i>q</i></r>', [(0, "<i>q</i>\n")]),
        ("<r><i >q</i></r>", [(0, "<i >q</i>\n")]),
        ('<r><i\n k="2">q</i></r>', [(0, '<i\n k="2">q</i>\n')]),
        ("<r><a.b>1</a.b></r>", []),
        ("<r></r>", []),
        ("", []),
    ],
)
def test_xml_split_lines_layout(spark, payload, expected):
    got = run_xml(spark, payload, split="i")
    assert [(p, v) for p, v, e in got] == expected
    assert all(e is None for _, _, e in got)


def test_xml_headers(spark):
    got = run_xml(spark, "<r><h><k>7</k></h><i><a>1</a></i></r>", split="i", headers=["h"])
    assert got == [(0, "<root><h>\n<k>7</k>\n</h>\n\n<i>\n<a>1</a>\n</i>\n</root>", None)]
    leaf = run_xml(spark, "<r><h>7</h><i>1</i><i>2</i></r>", split="i", headers="h")
    assert [v for _, v, _ in leaf] == ["<root><h>7</h>\n\n<i>1</i>\n</root>", "<root><h>7</h>\n\n<i>2</i>\n</root>"]
    raw = run_xml(spark, "<r><h>7</h><i>1</i></r>", split="i", headers="h", layout="raw")
    assert raw == [(0, "<root><h>7</h><i>1</i></root>", None)]


def test_xml_errors(spark):
    assert run_xml(spark, "<r><i><a>", split="i") == [(-1, "<r><i><a>", "UNCLOSED_SPLIT")]
    nested = "<r><i><i><a>1</a></i></i></r>"
    assert run_xml(spark, nested, split="i") == [(-1, nested, "NESTED_SPLIT")]
    assert run_xml(spark, "<r><i>1</i></r>", split="i", headers=["h"]) == [(-1, "<r><i>1</i></r>", "HEADER_MISSING")]
    with pytest.raises(ValueError):
        split_xml(messages(spark, ["x"]), split="i", headers=["h", "h"])
    with pytest.raises(ValueError):
        split_xml(messages(spark, ["x"]), split="bad tag")


def test_xml_whole(spark):
    got = run_xml(spark, "a\r\nb\rc")
    assert got == [(0, "a\nb\nc\n", None)]
    assert run_xml(spark, "x\n") == [(0, "x\n", None)]
    assert run_xml(spark, "") == []
    assert run_xml(spark, "a\r\n", layout="raw") == [(0, "a\r\n", None)]


@pytest.mark.parametrize(
    "payload,expected",
    [
        ("", []),
        ("\n", [""]),
        ("a\n\n", ["a", ""]),
        ("a", ["a"]),
        ("a\r\nb\rc\u2028d\u2029e\u0085f\n", ["a", "b", "c", "d", "e", "f"]),
        ("a\r\n", ["a"]),
        ("\n\nx", ["", "", "x"]),
    ],
)
def test_lines(spark, payload, expected):
    got = records(split_lines(messages(spark, [payload])))
    assert [v for _, _, v, _ in got] == expected
    assert [p for _, p, _, _ in got] == list(range(len(expected)))


def test_lines_invalid_utf8_and_latin1(spark):
    got = records(split_lines(messages(spark, [b"a\xffb\nc"])))
    assert [v for _, _, v, _ in got] == ["a�b", "c"]
    from pyspark.sql import functions as F

    df = messages(spark, ["é\nü".encode("latin-1")])
    out = split_lines(df, encoding="ISO-8859-1").select(F.col("value")).collect()
    assert [bytes(r.value) for r in out] == ["é".encode("latin-1"), "ü".encode("latin-1")]


def test_json_split_and_scalars(spark):
    doc = '{"items":["1",1,null,{"b":2,"a":"x"},[1, 2],true],"z":1}'
    got = records(split_json(messages(spark, [doc]), split="items"))
    assert [v for _, _, v, _ in got] == ['"1"', "1", "null", '{"b":2,"a":"x"}', "[1,2]", "true"]
    objs = records(split_json(messages(spark, ['{"items":[{"a":null},{"b":[1]}]}']), split="items"))
    assert [v for _, _, v, _ in objs] == ['{"a":null}', '{"b":[1]}']


@pytest.mark.parametrize(
    "doc,err",
    [
        ('{"z":1,"items":[1]}', "SPLIT_KEY_NOT_FIRST"),
        ("bad", "BAD_JSON"),
        ("[1]", "NOT_OBJECT"),
        ('{"items":3}', "NOT_ARRAY"),
        ("{}", "SPLIT_KEY_NOT_FIRST"),
        ('{"items":[1]} garbage', "TRAILING_DATA"),
        ('{"items":[1]}\n{"items":[2]}', "TRAILING_DATA"),
        ('{"items":[1]}, {"b":2}', "TRAILING_DATA"),
        ('{"items":[1]}] x [', "TRAILING_DATA"),
        ('{"items":[1]}], {"b":2}', "TRAILING_DATA"),
        ('{"items":[1],"items":[2,3]}', "DUPLICATE_KEY"),
        ("{'items':[1]}", "BAD_JSON"),
        ('{"items":[\'a\']}', "BAD_JSON"),
        ('{"items":[1,]}', "BAD_JSON"),
        ('{"items":[1}', "BAD_JSON"),
        ('{"items":[1}]', "BAD_JSON"),
        ('{"items":[NaN]}', "BAD_JSON"),
        ('{"items":["a\nb"]}', "BAD_JSON"),
        ('{"items":' + "[" * 2000 + "]" * 2000 + "}", "BAD_JSON"),
        ('{"items":{"a":[1]}}', "NOT_ARRAY"),
        ('"items"', "NOT_OBJECT"),
    ],
)
def test_json_split_errors(spark, doc, err):
    assert records(split_json(messages(spark, [doc]), split="items")) == [("0", -1, doc, err)]


def test_json_whole(spark):
    got = records(split_json(messages(spark, ['{"k": 69, "n": null}', ' "x" ', "[1, 2]", "", '{"a":1} {"b":2}'])))
    assert [(m, v) for m, _, v, _ in got[:3]] == [("0", '{"k":69,"n":null}'), ("1", '"x"'), ("2", "[1,2]")]
    assert got[3:] == [("4", -1, '{"a":1} {"b":2}', "TRAILING_DATA")]
    assert records(split_json(messages(spark, ["nope"]))) == [("0", -1, "nope", "BAD_JSON")]


def test_dispatch_case_insensitive_and_unknown(spark):
    df = messages(spark, ["<r><i>1</i></r>"])
    assert len(records(split_records(df, "xml", split="i"))) == 1
    assert len(records(split_records(df))) == 1  # default XML, whole message
    with pytest.raises(ValueError):
        split_records(df, "CSV")


def test_output_keeps_columns_and_contract(spark):
    df = messages(spark, ["<r><i>1</i></r>"])
    out = split_xml(df.withColumn("extra", df.msg_id), split="i")
    assert out.columns == ["msg_id", "extra", "pos", "value", "error"]
    assert dict(out.dtypes)["pos"] == "int" and dict(out.dtypes)["value"] == "binary"


def test_python_splitter_contract(spark):
    from queuelake.operators.splitters import python_splitter, register_splitter

    def csv_fields(b: bytes):
        if not b:
            raise ValueError("empty message")
        return b.split(b",")

    register_splitter("CSVFIELDS", python_splitter(csv_fields))
    df = messages(spark, ["a,b", "", "c"]).withColumn("extra", F.lit(1))
    out = split_records(df, "csvfields")
    assert out.columns == ["msg_id", "extra", "pos", "value", "error"]
    got = records(out)
    assert got[:2] == [("0", 0, "a", None), ("0", 1, "b", None)]
    assert got[2][0] == "1" and got[2][1] == -1 and got[2][3].startswith("ValueError")
    assert got[3] == ("2", 0, "c", None)


def test_udtf_splitter(spark):
    from pyspark.sql.functions import udtf

    from queuelake.operators.splitters import register_splitter, udtf_splitter

    @udtf(returnType="pos int, value binary, error string")
    class Pipes:
        def eval(self, payload: bytes):
            data = bytes(payload)
            if not data:
                yield None, data, "EMPTY"
                return
            for i, part in enumerate(data.split(b"|")):
                yield i, part, None

    register_splitter("PIPES", udtf_splitter(Pipes))
    out = split_records(messages(spark, ["a|b", ""]).withColumn("extra", F.lit(2)), "pipes")
    assert out.columns == ["msg_id", "extra", "pos", "value", "error"]
    assert records(out) == [("0", 0, "a", None), ("0", 1, "b", None), ("1", -1, "", "EMPTY")]


def test_json_elements_are_as_written(spark):
    items = [
        "12345678901234567890.12345", "1.50", "1e400", "-0", "1E-7", "9" * 60, '"{a}"', '"[1"', '"{\\"a\\":1}"', '{"a":1}', '"a , b"', '"]"', '"\\\\"', '"\\u00e9<>&"',
        "[]", "{}", "null", "true", '[[1,[2]],{"x":"}"}]', '{"n":0.10,"m":{"k":[1.0]}}', '""', '"' + "1" * 60 + '\\" 1e999"', '"  two  spaces  "', '"é日🙂"',
    ]
    for doc in ('{"items":[' + ",".join(items) + '],"z":{"items":[7]}}', ' {\n "items" :\t[ ' + " ,\r\n ".join(items) + ' ] , "z": 1 } \n'):
        assert records(split_json(messages(spark, [doc]), split="items")) == [("0", k, v, None) for k, v in enumerate(items)]
    spaced = '{ "a" : [ 1.50 , "x  y\\" z" ] }'
    assert [r[2:] for r in records(split_json(messages(spark, [spaced, "1.50", ' "a b" ', " 1 2", "01", "'x'", "[1] [2]"])))] == [
        ('{"a":[1.50,"x  y\\" z"]}', None), ("1.50", None), ('"a b"', None), (" 1 2", "TRAILING_DATA"), ("01", "BAD_JSON"), ("'x'", "BAD_JSON"), ("[1] [2]", "TRAILING_DATA"),
    ]
    assert records(split_json(messages(spark, ['{"it\\u0065ms":[1]}', '{"items":[]}', '{"items":[ ]}']), split="items")) == [("0", 0, "1", None)]


def test_json_is_cut_alike_by_a_parser(spark):
    import json
    import random

    rng = random.Random(8)

    def value(depth):
        kind = rng.randrange(8 if depth else 5)
        if kind < 5:
            return rng.choice([rng.randint(-9, 10**20), rng.random(), None, True, "".join(rng.choices('a"\\{}[],:é \n/', k=rng.randint(0, 6)))])
        return [value(depth - 1) for _ in range(rng.randint(0, 4))] if kind < 7 else {f"k{i}": value(depth - 1) for i in range(rng.randint(0, 3))}

    docs = [[value(4) for _ in range(rng.randint(0, 5))] for _ in range(200)]
    text = [json.dumps({"v": d, "w": value(2)}, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) for d in docs]
    rows = split_json(messages(spark, text), split="v").selectExpr("int(msg_id) as m", "pos", "string(value) as value", "error").collect()
    got = {(r.m, r.pos): r.value for r in rows}
    assert not any(r.error for r in rows)
    assert {k: json.loads(v) for k, v in got.items()} == {(m, i): x for m, d in enumerate(docs) for i, x in enumerate(d)}


def test_json_is_linear(spark):
    import time

    many = '{"v":[' + ",".join('{"a":"x","b":[1,2]}' for _ in range(200_000)) + "]}"
    begin = time.time()
    assert split_json(messages(spark, [many]), split="v").count() == 200_000
    for bad in ('{"v":[' * 500_000, '{"v":[' + '"' * 2_000_001, '{"v":[' + "1," * 1_000_000):
        assert records(split_json(messages(spark, [bad]), split="v")) == [("0", -1, bad, "BAD_JSON")]
    assert time.time() - begin < 60


def test_custom_splitters_lose_no_message(spark):
    from queuelake.operators.splitters import expression_splitter, python_splitter, udtf_splitter

    payloads = [b"a b", b"", b"nothing", b"null inside", b"raises", None]

    def cut(payload):
        if payload == b"raises":
            raise ValueError("no")
        return None if payload == b"nothing" else [b"x", None] if payload == b"null inside" else payload.split()

    @F.udtf(returnType="pos int, value binary")
    class Cut:
        def eval(self, payload: bytes):
            rows = cut(payload)
            return None if rows is None else list(enumerate(rows))

    words = lambda p: F.when(p.cast("string") == "", F.array().cast("array<string>")).when(p.cast("string") == "null inside", F.array(F.lit("x"), F.lit(None))).when(
        ~p.cast("string").isin("nothing", "raises"), F.split(p.cast("string"), " ")
    )
    df = spark.createDataFrame(list(enumerate(payloads)), "msg_id int, payload binary")
    for splitter, raised in ((expression_splitter(words), "BAD_RECORDS"), (python_splitter(cut), "ValueError: no"), (udtf_splitter(Cut), "ValueError: no")):
        got = sorted((r.msg_id, -1 if r.pos is None else r.pos, r.value and bytes(r.value), r.error) for r in splitter(df).collect())
        assert got == [
            (0, 0, b"a", None), (0, 1, b"b", None), (2, -1, b"nothing", "BAD_RECORDS"), (3, -1, b"null inside", "NULL_RECORD"),
            (4, -1, b"raises", raised), (5, -1, None, "NULL_PAYLOAD"),
        ]
        named = df.withColumnRenamed("payload", "value")
        assert splitter(named, payload="value").columns == ["msg_id", "pos", "value", "error"]
        for name in ("pos", "value", "error"):
            with pytest.raises(ValueError, match="rename"):
                splitter(df.withColumn(name, F.lit(1)))


def test_xml_is_linear_and_quotes_are_read(spark):
    assert run_xml(spark, '<r><i a="x/>y"><b>1</b></i></r>', split="i", layout="raw") == [(0, '<i a="x/>y"><b>1</b></i>', None)]
    assert run_xml(spark, "<r></i><i>1</i></r>", split="i")[0][2] == "UNMATCHED_END"
    assert run_xml(spark, '<r><i a="x><b>1</b></i></r>', split="i")[0][2] == "UNMATCHED_END"
    begin = time.time()
    for bad in ("<i>" * 3_300_000, '<i a="' * 1_500_000 + "</i>", "<i" * 3_000_000 + "</i>"):
        assert run_xml(spark, bad, split="i")[0][1:] in [(bad, "UNCLOSED_SPLIT"), (bad, "UNMATCHED_END")]
    assert time.time() - begin < 60


@pytest.mark.parametrize(
    "payload,expected",
    [
        ("<r><!-- <i>x</i> --></r>", []),
        ("<r><!-- <i>x</i> --><i>1</i></r>", [(0, "<i>1</i>", None)]),
        ("<r><!-- <i> --><i>1</i><?p </i>?></r>", [(0, "<i>1</i>", None)]),
        ("<r><i>a<!-- <i>x</i> -->b</i></r>", [(0, "<i>a<!-- <i>x</i> -->b</i>", None)]),
        ("<r><i><![CDATA[</i><i><<]]></i><i><![CDATA[]]></i></r>", [(0, "<i><![CDATA[</i><i><<]]></i>", None), (1, "<i><![CDATA[]]></i>", None)]),
        ("<r><i><![CDATA[<!-- ]]>1</i><!-- <![CDATA[ --><i>2</i></r>", [(0, "<i><![CDATA[<!-- ]]>1</i>", None), (1, "<i>2</i>", None)]),
        ('<?xml version="1.0"?><r><?i <i>?><i>1</i></r>', [(0, "<i>1</i>", None)]),
        ("<?i <i>?><i>1</i>", [(0, "<i>1</i>", None)]),
        ("<r><i>&lt;!-- 5 ]]&gt; --&gt;</i></r>", [(0, "<i>&lt;!-- 5 ]]&gt; --&gt;</i>", None)]),
        ("<r><!--\u00e9\U0001F600<i>--><i>\U0001F600<!--<--></i></r>", [(0, "<i>\U0001F600<!--<--></i>", None)]),
        ("<r><i>1</i><!-- <i>2</i></r>", "UNCLOSED_SPAN"),
        ("<r><i>1</i><!--> <i>2</i></r>", "UNCLOSED_SPAN"),
        ("<r><i><![CDATA[x]></i></r>", "UNCLOSED_SPAN"),
        ("<r><i>\x01<!-- x --></i></r>", "ILLEGAL_CHARACTER"),
        ("<r><i>\x01</i></r>", [(0, "<i>\x01</i>", None)]),
        ("<r><i>1<!-- </i> --></r>", "UNCLOSED_SPLIT"),
    ],
)
def test_xml_spans_hold_no_tags(spark, payload, expected):
    got = run_xml(spark, payload, split="i", layout="raw")
    assert got == ([(-1, payload, expected)] if isinstance(expected, str) else expected)


def test_xml_spans_in_lines_and_headers(spark):
    got = run_xml(spark, "<r><!--<h>0</h>--><h>7<!--<i>--></h><i><a>1</a><![CDATA[<a><b>]]></i></r>", split="i", headers="h")
    assert got == [(0, "<root><h>7<!--<i>-->\n</h>\n\n<i>\n<a>1</a>\n<![CDATA[<a><b>]]>\n</i>\n</root>", None)]
    begin = time.time()
    for bad in ("<!--" * 2_000_000, "<![CDATA[<i>" * 800_000, "<r>" + "<!-- <i> -->" * 800_000 + "<i>1</i></r>"):
        out = run_xml(spark, bad, split="i", layout="raw")
        assert out == [(0, "<i>1</i>", None)] if bad.endswith("r>") else out[0][2] == "UNCLOSED_SPAN"
    assert time.time() - begin < 60


def test_null_payload_is_one_error_row(spark):
    from queuelake.operators.splitters import python_splitter

    df = spark.createDataFrame([("0", None)], "msg_id string, payload binary")
    plain = python_splitter(lambda b: [b])
    for out in (split_lines(df), split_json(df), split_json(df, split="a"), split_xml(df), split_xml(df, split="a", headers="h"), plain(df)):
        assert [(r.pos, r.value, r.error) for r in out.collect()] == [(None, None, "NULL_PAYLOAD")]


def test_encoding_of_xml_and_json(spark):
    df = messages(spark, ["<r><i>é</i></r>".encode("latin-1")])
    assert [v for _, _, v, _ in records(split_records(df, "XML", split="i", layout="raw", encoding="ISO-8859-1"))] == ["<i>é</i>"]
    df = messages(spark, ['{"a":["é"]}'.encode("utf-16-be")])
    assert [v for _, _, v, _ in records(split_records(df, "JSON", split="a", encoding="UTF-16BE"))] == ['"é"']


def test_python_batches_and_whole_error_text(spark):
    from queuelake.operators.splitters import _python_records, python_splitter

    def fail(b):
        raise ValueError("x" * 2000)

    assert len(_python_records(fail, b"q")[0][2]) > 2000
    out = python_splitter(lambda b: [b] * 2001, out_rows=100)(messages(spark, ["a", "b"]))
    assert out.count() == 4002


def test_an_element_is_found_from_tag_to_tag(spark):
    rng = random.Random(7)
    bits = ["<i>", "</i>", "<i a='>'>", "<ix>", "</ix>", "<i/>", "</i >", "é\U0001f600", "\n  ", "<", ">", "x"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(30))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for indent in (False, True):
        regex = xx.element_regex("i", keep_indent=indent)
        assert ".*?" not in regex  # it would try the end tag at every character
        plain = "(?sm)" + ("(?:^[ \\t]*)?" if indent else "") + xx.open_tag_regex("i") + ".*?</i>"
        found, want = (F.regexp_extract_all("t", F.lit(r), F.lit(0)) for r in (regex, plain))
        assert df.where(~found.eqNullSafe(want)).count() == 0
    body = xx.up_to_last_end(F.col("t"), xx.after_last_end(F.col("t"), "i"))
    got = [(r.t, r.b) for r in df.select("t", body.alias("b")).collect()]
    assert all(b == "".join(t.rpartition("</i>")[:2]) for t, b in got)
