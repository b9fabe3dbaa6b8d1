"""File layouts: what is written, what is refused and what is read."""

import pyarrow as pa
import pytest

from coterie.functions.text import content_words, strip_markup, ENGLISH_STOP_WORDS
from coterie.sources import lines, xml
from pyspark.sql import functions as F

DUMP = """<?xml version="1.0"?>
<dblp>
<article key="j/1"><author>A. M&uuml;ller</author><author>B &amp; C</author>
<title>On <i>x</i> and y.</title><year>1999</year><url>db/journals/vldb/1</url></article>
<article key="j/2"><author>D</author><title>No year</title><url>db/conf/icde/2</url></article>
<book key="b/1"><author>E</author><title>Other venue</title><year>2001</year></book>
<www key="w/1"><title>Home</title></www>
<!-- a type that no list names -->
<dataset mdate="2020-01-01"
 key="x/1"><author>F &unknown; &LT;</author><title>Cited</title>
<year>2002</year><cite>conf/vldb/x</cite></dataset>
<book key="b/2"><author>G</author><title>Bad year</title><year>99999999999</year>
<note>/vldb</note></book><www key="w/2"/>
</dblp>
"""


def test_bibliography_dump(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "dump.xml").write_text(DUMP)
    records = xml.read_records(spark, str(tmp_path / "in"))
    baskets = sorted(tuple(r) for r in xml.record_baskets(records).collect())
    assert baskets == [
        ("b/1", "E"), ("b/2", "G"), ("j/1", "A. Müller"), ("j/1", "B & C"), ("j/2", "D"),
        ("x/1", "F &unknown; &LT;"),
    ]
    assert sorted(tuple(r) for r in xml.record_titles(records).collect()) == [
        ("Cited", 2002), ("On x and y.", 1999),
    ]
    only = xml.read_records(spark, str(tmp_path / "in"), ["dataset"])
    assert [r["_key"] for r in only.collect()] == ["x/1"]


def test_records_cross_file_splits(spark, tmp_path):
    (tmp_path / "in").mkdir()
    records = [f'<article key="k/{i}"><author>n{i}</author></article>' for i in range(2000)]
    text = "<dblp>\n" + "\n".join(records) + "\n</dblp>\n"
    (tmp_path / "in" / "dump.xml").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        read = xml.record_baskets(xml.read_records(spark, str(tmp_path / "in"))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, read)) == sorted((f"k/{i}", f"n{i}") for i in range(2000))


ODD_RECORDS = """<?xml version="1.0"?>
<!DOCTYPE dblp [ <!ENTITY x "y"> ]>
<!-- a comment with <article key="no/1"> and </dblp> -->
<dblp>
<article key="j/1"><author>A</author><title>Where key="x" is text</title></article>
<article key="p/1"><author>B</author><part key="c/1"><author>inner</author></part></article>
<article><author>C</author><title>no key</title></article>
<article key='s/1' note="a > b"><author>D</author></article><?pi <article> ?>
<article key="e/1"/><article
  key="n/1"
><author>E</author><!-- <author>F</author> --><title><![CDATA[<b> & "c"]]></title></article>
<article key="m/1"><article key="m/2"><author>G</author></article><author>H</author></article>
<article key="bad/1"><author>I</wrong></article>
</dblp>
"""


@pytest.mark.parametrize("block", [None, 20, 64, 300])
def test_records_are_the_children_of_the_root(spark, tmp_path, block):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.xml").write_text(ODD_RECORDS)
    (tmp_path / "in" / "b.xml").write_text("<dblp><www key='w/1'><author>J</author></www></dblp>")
    if block:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = xml.read_records(spark, str(tmp_path / "in")).collect()
        records = xml.read_records(spark, str(tmp_path / "in"))
        baskets = {(r.basket_id, r["item"]) for r in xml.record_baskets(records).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 9
    by_key = {r["_key"]: r for r in rows if r["_key"]}
    assert set(by_key) == {"j/1", "p/1", "s/1", "e/1", "n/1", "m/1", "w/1"}
    assert by_key["j/1"].title == 'Where key="x" is text'
    assert by_key["n/1"].title == '<b> & "c"' and by_key["n/1"].author == ["E"]
    assert by_key["e/1"].author is None and by_key["w/1"].record_type == "www"
    [nameless] = [r for r in rows if r.title == "no key"]
    [corrupt] = [r for r in rows if r.corrupt]
    assert corrupt.corrupt == '<article key="bad/1"><author>I</wrong></article>'
    assert corrupt.author is None and all(r.corrupt is None for r in rows if r is not corrupt)
    assert baskets == {
        ("j/1", "A"), ("p/1", "B"), (nameless.position, "C"), ("s/1", "D"), ("n/1", "E"),
        ("m/1", "H"), ("w/1", "J"),
    }


def test_line_formats_refuse_their_delimiter(spark, tmp_path):
    baskets = spark.createDataFrame([(1, "a#b")], "basket_id bigint, item string")
    with pytest.raises(Exception, match="contains a delimiter"):
        lines.write_baskets(baskets, str(tmp_path / "baskets"))


def test_basket_lines_keep_their_items_together(spark, tmp_path):
    path = tmp_path / "baskets"
    path.mkdir()
    (path / "part.txt").write_text("a#b#a\n\nc\n")
    rows = lines.read_baskets(spark, str(path)).collect()
    groups = {}
    for row in rows:
        groups.setdefault(row["basket_id"], []).append(row["item"])
    assert sorted(groups.values()) == [["a", "b", "a"], ["c"]]


def test_titles_split_at_the_last_mark(spark, tmp_path):
    path = tmp_path / "titles"
    path.mkdir()
    (path / "part.txt").write_text("C# in depth#2008\nno year#\n")
    assert [tuple(r) for r in lines.read_titles(spark, str(path)).collect()] == [
        ("C# in depth", 2008)
    ]


def test_reports_split_long_clusters_over_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "TITLES_PER_LINE", 3)
    rows = [(1990, 2000, 0, "t0", f"t{i}", 2) for i in range(10)]
    schema = "period_start int, period_end int, cluster int, clustroid string, title string, weight bigint"
    path = str(tmp_path / "reports")
    lines.write_cluster_reports(spark.createDataFrame(rows, schema), path)
    text = spark.read.text(path).where("NOT startswith(value, '#')")
    assert text.count() > 1
    read = lines.read_cluster_reports(spark, path)
    assert sorted(r["title"] for r in read.collect()) == sorted([f"t{i}" for i in range(10)] * 2)


def test_reports_split_a_frequent_title(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lines, "TITLES_PER_LINE", 3)
    schema = "period_start int, period_end int, cluster int, clustroid string, title string, weight bigint"
    path = str(tmp_path / "reports")
    lines.write_cluster_reports(
        spark.createDataFrame([(1990, 2000, 0, "t", "t", 50)], schema), path, steps=4
    )
    text = [r["value"] for r in spark.read.text(path).collect()]
    assert "# steps: 4" in text
    assert len(text) > 6
    assert lines.read_cluster_reports(spark, path).count() == 50


def test_group_contents(spark, tmp_path):
    rows = [(0, 7, i, f"text {i}") for i in range(3)] + [(3, 1 << 50, 0, ""), (3, 1 << 50, 1, " Group 1/2, Body 3: ")]
    path = str(tmp_path / "groups")
    lines.write_group_contents(
        spark.createDataFrame(rows, "band int, bucket bigint, body_no bigint, body string"), path
    )
    text = [r["value"] for r in spark.read.text(path).select("value").collect()]
    assert {"Group 0/7, Body 0:", "text 0", "Group 0/7, Body 2:", "text 2"} <= set(text)
    assert sorted(tuple(r) for r in lines.read_group_contents(spark, path).collect()) == rows


def test_cleaning(spark):
    frame = spark.createDataFrame(
        [("<p>The <b>Quick</b> fox&#39;s r&amp;d <!-- no --> été x1y</p>",)], "h string"
    )
    words = content_words(strip_markup(F.col("h")), ENGLISH_STOP_WORDS)
    assert frame.select(words).first()[0] == ["quick", "fox", "été"]


def test_records_of_a_block_leave_in_bounded_batches(monkeypatch):
    """A block of many records, one of them left open, comes out in parts of a few records."""
    monkeypatch.setattr(xml, "BATCH_CHARACTERS", 100, raising=False)
    values = ["", "dblp>"]
    for n in range(200):
        values += [f"article key='{n}'>", f"author>A{n}", "/author>", "/article>"]
    values += ["article key='open'>"]
    names = ["path", "start", "inside", "depth", "owner", "value"]
    rows = [dict(zip(names, ("f", 0, "markup", 0, 0, value))) for value in values]
    batches = list(xml._record_parts([pa.RecordBatch.from_pylist(rows)]))
    assert max(batch.num_rows for batch in batches) <= 3
    parts = [row for batch in batches for row in batch.to_pylist()]
    assert [row["number"] for row in parts] == [*range(1, 201), 0]
    assert parts[7]["part"] == "<article key='7'><author>A7</author></article>"
