import json

import pytest
from pyspark.sql import functions as F

from lexloom.sources import readers as R
from lexloom.sources import writers as W


def test_csv_with_mark_quotes_and_required(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('id,word\n1,"x\ny, ""z"""\nbad,q\n2,w\n2,v\n', encoding="utf-8-sig")
    df = R.read_csv(spark, str(p), "id", "word")
    assert df.columns == ["id", "word"]
    good = R.tolerant(df.withColumn("o", F.col("word")), "id", "o")
    assert sorted((r.id, r.word) for r in good.collect()) == [(1, 'x\ny, "z"'), (2, "w")]
    with pytest.raises(ValueError, match="missing columns: root"):
        R.read_csv(spark, str(p), "root")


def test_numbered_preamble_lines_and_xml(spark, tmp_path):
    for i in (1, 3):
        (tmp_path / f"out_{i}.jsonl").write_text(f'{{"i": {i}}}\n')
    got = R.read_numbered(spark, f"{tmp_path}/out_{{}}.jsonl", 3, skip_missing=True)
    assert sorted((r.file_no, r.line) for r in got.collect()) == [(1, '{"i": 1}'), (3, '{"i": 3}')]
    with pytest.raises(FileNotFoundError):
        R.read_numbered(spark, f"{tmp_path}/out_{{}}.jsonl", 3)
    (tmp_path / "m.tsv").write_text("# a\n# b\nLOC\tFORM\n(1:1:1:1)\tx\n(1:1:1:2)\ty\n")
    tsv = R.read_preamble_tsv(spark, str(tmp_path / "m.tsv"), 2, "LOC string, FORM string")
    assert [tuple(r) for r in tsv.collect()] == [(1, "(1:1:1:1)", "x"), (2, "(1:1:1:2)", "y")]
    (tmp_path / "q.xml").write_text('<quran><sura index="1" name="n"><aya index="1" text="a b"/><aya index="2" text="c"/></sura></quran>')
    assert sorted(tuple(r) for r in R.read_verses(spark, str(tmp_path / "q.xml")).collect()) == [(1, "n", 1, "a b"), (1, "n", 2, "c")]
    (tmp_path / "p.txt").write_text(" a \n\n b\n")
    assert sorted(tuple(r) for r in R.read_lines(spark, str(tmp_path / "p.txt")).collect()) == [("p.txt", 1, "a"), ("p.txt", 3, "b")]


def test_conversations_and_feed(spark, tmp_path):
    c = tmp_path / "c"
    c.mkdir()
    (c / "1.json").write_text(json.dumps({"participants": [{"name": "x"}], "messages": [{"sender_name": "x", "timestamp_ms": 5, "content": "hi"}]}))
    (c / "2.json").write_text(json.dumps({"messages": []}))
    assert R.read_conversations(spark, str(c)).count() == 1
    (tmp_path / "f.xml").write_text("<rss xmlns:content='u'><item><title>t</title><content:encoded>b</content:encoded></item></rss>")
    assert [tuple(r) for r in R.read_feed(spark, str(tmp_path / "f.xml")).collect()] == [("t", "b")]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    W.single(df, str(tmp_path / "s.csv"), bom=True)
    assert (tmp_path / "s.csv").read_bytes() == b"\xef\xbb\xbfid,t\r\n1,a\r\n2,\r\n"
    lines = [r.line for r in W.bulk_lines(df, "ix", F.col("id")).collect()]
    assert lines[0] == '{"index":{"_index":"ix","_id":1}}\n{"id":1,"t":"a"}'
    ok, bad = W.split_rejects(df, F.when(F.col("t").isNull(), "no text"))
    assert ok.count() == 1 and bad.first().reject_reason == "no text"
    W.write_csv(df, str(tmp_path / "d"))
    W.write_csv(df, str(tmp_path / "d"), append=True)
    assert R.read_csv(spark, str(tmp_path / "d"), "id").count() == 4
    W.write_chunks(df.withColumn("chunk", F.col("id")), str(tmp_path / "k"), "chunk")
    assert sorted(p.name for p in (tmp_path / "k").glob("chunk=*")) == ["chunk=1", "chunk=2"]
    W.write_files(df.fillna("").withColumn("f", F.concat("t", F.lit("x.md"))), "f", "t", str(tmp_path / "md"))
    assert sorted(p.name for p in (tmp_path / "md").iterdir()) == ["ax.md", "x.md"]
