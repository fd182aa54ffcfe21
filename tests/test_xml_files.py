"""XML files read in pieces give the records of the files as messages."""

import os

import pytest
from conftest import messages, records

from queuelake.operators.splitters import split_xml
from queuelake.sources.xml_files import LENGTH_MISMATCH, read_xml_files

BODY = "".join(f'  <i n="{k}">\n    <a>é{k}</a>\n  </i>\n' for k in range(50))
DOCS = {
    "pretty": f"<r>\n<h>\n  <k>7</k>\n</h>\n{BODY}</r>\n",
    "one_line": "<r><h>7</h>" + "".join(f"<i><a>{k}</a></i>" for k in range(50)) + "</r>",
    "crlf": "<r>\r\n<h>1</h>\r\n  <i>\r\n <a>2</a></i>  <i>3</i>\r\n</r>",
    "other_tags": "<r><h>1</h><ix>0</ix><i/><i k='/>'>1</i><!-- <i> --><i><![CDATA[<i>]]></i><i >2</i><i/></r>",
    "late_header": "<r><i>1</i><i>2</i><h>3</h><i>4</i></r>",
    "no_records": "<r><h>1</h></r>",
    "ends_at_the_tag": "<h>1</h><i>1</i>",
    "no_header": "<r><i>1</i></r>",
    "unclosed": "<r><h>1</h><i>1</i><i>2</r>",
    "unclosed_twice": "<r><h>1</h><i>1</i><i><i>2</r>",
    "nested": "<r><h>1</h><i><i>1</i></i></r>",
    "unmatched": "<r><h>1</h></i><i>1</i></r>",
    "open_comment": "<r><h>1</h><i>1</i><!-- </r>",
    "no_xml_character": "<r><h>\x01</h><i>\x01</i></r>",
}


@pytest.mark.parametrize("headers", [None, "h"])
@pytest.mark.parametrize("layout", ["lines", "raw"])
def test_pieces_give_the_records_of_the_whole(spark, tmp, headers, layout):
    for name, text in DOCS.items():
        with open(os.path.join(tmp, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    whole = records(split_xml(messages(spark, list(DOCS.values())), split="i", headers=headers, layout=layout))
    want = {name: [(v if e is None else None, e) for i, _, v, e in whole if int(i) == n] for n, name in enumerate(DOCS)}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("512", "37", old):  # blocks that cut records and tags anywhere
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            out = read_xml_files(spark, tmp, "i", headers=headers, layout=layout)
            got = {name: [] for name in DOCS}
            for r in sorted(out.collect(), key=lambda r: (r.block or 0, r.seq or 0)):
                got[os.path.basename(r.file)].append((r.value and bytes(r.value).decode(), r.error))
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_what_is_no_plain_text_file(spark, tmp):
    import gzip

    with gzip.open(os.path.join(tmp, "a.gz"), "wt") as f:
        f.write("<r><i>1</i></r>")
    assert [(r.value, r.error) for r in read_xml_files(spark, tmp, "i").collect()] == [(None, LENGTH_MISMATCH)]
    open(os.path.join(tmp, "empty.xml"), "w").close()
    with open(os.path.join(tmp, "cut.xml"), "w") as f:
        f.write("<r><i>1<!-- </i> --></i></r>")
    assert [r.error for r in read_xml_files(spark, tmp, "i", glob="*.xml").collect()] == ["UNCLOSED_SPAN"]
    for bad in ({"layout": "x"}, {"headers": "h,h"}):
        with pytest.raises(ValueError):
            read_xml_files(spark, tmp, "i", **bad)
