import json
import os

import pytest
from pyspark.sql import functions as F

from rescuelens import session
from rescuelens.plans import filtering, training
from rescuelens.sources import columns, layout, readers, writers


@pytest.fixture
def folder(tmp_path):
    def write(name, text, encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
        return str(tmp_path)
    return write


HEAD = "tweet_id\ttweet_text \tclass_label\n"


def test_tsv_rows_and_order(spark, folder):
    root = folder("a/b/x.tsv", "﻿" + HEAD + '1\thello "x\tl\n2\tshort\n\n3\ta\tb\ttoo long\n'
                  '\tblank id\tc\n4\tNA\tz\n"q"\t"w"\t\n')
    folder("a-b/x.tsv", HEAD + "5\tfive\tl\n")
    folder("b c/x.tsv", HEAD + "6\tsix\tl\n")
    folder("b c/notes.txt", "ignored")
    df = readers.read_event_posts(spark, root, order=True)
    rows = [tuple(r)[:3] for r in df.orderBy(*readers.SCAN_ORDER).collect()]
    assert rows == [("1", 'hello "x', "l"), ("2", "short", None), ("3", "a", "b"), (None, "blank id", "c"),
                    ("4", None, "z"), ('"q"', '"w"', None), ("5", "five", "l"), ("6", "six", "l")]
    # the long line is cut to the header, whatever columns are asked for
    assert df.count() == 8
    assert df.filter("tweet_id = '3'").count() == 1


def test_long_ids_keep_their_digits(spark, folder):
    root = folder("x.tsv", HEAD + "01234567890123456789012\tt\tl\n")
    assert readers.read_event_posts(spark, root).first().tweet_id == "01234567890123456789012"


def test_flat_folder_and_optional_columns(spark, folder):
    root = folder("x.tsv", "id\ttext\tlang_conf\tother\n1\tt\t0.5\tz\n2\tt\tbad\tz\n")
    folder("deep/y.tsv", "id\ttext\n9\tt\n")
    rows = readers.read_crisis_posts(spark, root).orderBy("id").collect()
    assert [r.asDict() for r in rows] == [{"id": "1", "text": "t", "lang_conf": 0.5},
                                          {"id": "2", "text": "t", "lang_conf": None}]


def test_missing_input_and_columns(spark, folder, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_event_posts(spark, str(tmp_path / "none"))
    root = folder("readme.txt", "no posts")
    with pytest.raises(FileNotFoundError):
        readers.read_event_posts(spark, root)
    folder("x.tsv", "tweet_id\n1\n")
    with pytest.raises(ValueError, match=r"Missing columns: \['class_label', 'tweet_text'\]"):
        readers.read_event_posts(spark, root)


def test_every_file_by_its_own_header(spark, folder):
    root = folder("a.tsv", HEAD + "1\tt\tl\n")
    folder("b.tsv", "more\ttweet_id\tclass_label\ttweet_text \nx\t2\tk\tu\n")
    rows = readers.read_event_posts(spark, root).orderBy("tweet_id").collect()
    assert [tuple(r) for r in rows] == [("1", "t", "l"), ("2", "u", "k")]


def test_csv_headers_and_long_rows(spark, folder):
    root = folder("a.csv", 'content,language\n"hello, ""x""\nmore",en\nlong,tr,extra\nshort\n')
    folder("b.csv", "language,date,content\nen,2023-02-06 01:17:34,world\n")
    rows = readers.read_tagged_posts(spark, root).collect()
    assert sorted((r.content, r.language, r.date is None) for r in rows if r.language) == [
        ('hello, "x"\nmore', "en", True), ("long", "tr", True), ("world", "en", False)]
    assert {r.content for r in readers.read_csv(spark, root, skip_long=True).collect()} == {
        'hello, "x"\nmore', "short", "world"}
    with pytest.raises(ValueError, match="date"):
        readers.read_csv(spark, root, required=["date"])


def test_date_forms(spark):
    forms = {"Mon Feb 06 01:17:34 +0000 2023": "2023-02-06 01:17:34", "02/06/2023 01:17": "2023-02-06 01:17:00",
             "20230206": "2023-02-06 00:00:00", "Feb 6, 2023": "2023-02-06 00:00:00",
             "2023-02-06 01:17:34+03:00": "2023-02-05 22:17:34",
             "Mon, 06 Feb 2023 01:17:34 GMT": "2023-02-06 01:17:34", "6 February 2023": "2023-02-06 00:00:00",
             "nonsense": None, None: None}
    df = spark.createDataFrame([(k,) for k in forms], "d string")
    got = df.select("d", F.date_format(readers.parse_date(F.col("d")), "yyyy-MM-dd HH:mm:ss").alias("t"))
    assert {r.d: r.t for r in got.collect()} == forms


CSV = ('date,content,hashtags,language,place\n'
       '2023-02-06 01:00:00+00:00,"Şırnak ""yardım""\nçöğ, x",NaN,tr,p{}\n'
       'bad,hello,,en,\nshort,one\na,b,"c,d",d,e,f\n2023-02-06T03:00:00+02:00,z,"",EN,q\n')


def test_csv(spark, folder):
    root = folder("p.csv", CSV.format(""))
    rows = [tuple(r) for r in readers.read_tagged_posts(spark, root).select(
        F.date_format("date", "yyyy-MM-dd HH:mm"), "content", "hashtags", "language", "place").collect()]
    assert sorted(rows, key=str) == sorted([
        ("2023-02-06 01:00", 'Şırnak "yardım"\nçöğ, x', None, "tr", "p"),
        (None, "hello", None, "en", None), (None, "one", None, None, None), (None, "b", "c,d", "d", "e"),
        ("2023-02-06 01:00", "z", None, "EN", "q")], key=str)
    assert readers.read_tagged_posts(spark, root).columns == [
        "date", "content", "hashtags", "language", "place"]


def test_encodings(spark, folder, tmp_path):
    folder("u.csv", CSV.format(""))
    folder("b.csv", CSV.format(""), "utf-8-sig")
    folder("t.csv", CSV.format(""), "cp1254")
    folder("i.csv", CSV.format("\x90"), "iso-8859-9")
    found = {os.path.basename(r.file): r.encoding
             for r in readers.file_encodings(spark, str(tmp_path)).collect()}
    assert found == {"u.csv": "UTF-8", "b.csv": "UTF-8", "t.csv": "windows-1254",
                     "i.csv": "ISO-8859-9"}
    df = readers.read_csv_any_encoding(spark, str(tmp_path), required=["content"])
    first = df.filter("language = 'tr'").select("content", "place").collect()
    assert {r.content for r in first} == {'Şırnak "yardım"\nçöğ, x'}
    assert sorted(r.place for r in first) == ["p", "p", "p", "p\x90"]


def test_json_files(spark, folder):
    pair = {"user": "u", "assistant": {"needs": ["su"], "location": {"province": "Van"}}}
    root = folder("a.json", json.dumps([pair, pair], indent=2))
    rows = readers.read_json_array(spark, root).collect()
    assert len(rows) == 2 and rows[0].assistant.location.province == "Van"
    lines = folder("l/a.jsonl", '{"messages":[{"role":"user","content":"x"}]}\n') + "/l"
    assert readers.read_jsonl(spark, lines).first().messages[0].content == "x"


def test_column_helpers(spark):
    assert columns.clean_names(["﻿a ", " b"]) == ["a", "b"]
    assert columns.present(["b", "a", "z"], ["a", "b", "c"]) == ["a", "b"]
    df = spark.createDataFrame([(1, "x", "y", "z")], "n int, other string, Text string, mesaj string")
    assert columns.text_column(df) == "Text"
    assert columns.text_column(df, "mesaj") == "mesaj"
    assert columns.text_column(df.drop("Text", "mesaj"), "nope") == "other"
    with pytest.raises(ValueError):
        columns.text_column(df.select("n"))


def test_append_all_pads(spark):
    a, b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "b int")
    assert [tuple(r) for r in readers.append_all(a, b).collect()] == [(1, None), (None, 2)]


def test_spread_only_when_splits_are_few(spark):
    assert layout.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 9)
    assert layout.spread(many) is many


def test_filter_run(spark, folder, tmp_path):
    root = folder("in/a b/x.tsv", HEAD + "1\twe are trapped, fire\tl\n1\twe are trapped, flood\tl\n"
                  "2\tnothing\tl\n")
    folder("in/c/x.tsv", HEAD + "2\twe are trapped, \"flood\"\tl\n1\ttrapped, fire here now\tl\n")
    folder("in/d/x.tsv", HEAD + "7\tnothing\tl\n")
    out = str(tmp_path / "out")
    totals = filtering.run_filter(spark, filtering.EVENT, root + "/in", out).first()
    assert tuple(totals) == (3, 2, 2)
    rows = spark.read.option("header", True).option("escape", '"').csv(out).orderBy("tweet_id").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "we are trapped, fire", "l", "true", "false", "false", "true"),
        ("2", 'we are trapped, "flood"', "l", "true", "false", "false", "true")]


def test_pairs_sink(spark, tmp_path):
    df = spark.createDataFrame([(f"çadır lazım {i % 30 * 'x'}",) for i in range(90)], "message string")
    pairs = training.training_pairs(df)
    out = str(tmp_path / "all")
    assert [tuple(r) for r in training.write_training_pairs(pairs, out).collect()] == [("train", 90)]
    line = json.loads(spark.read.text(out).first()[0])
    assert list(line) == ["user", "assistant"] and line["assistant"]["location"]["province"] is None
    out = str(tmp_path / "parts")
    sizes = {r.split: r.n for r in training.write_training_pairs(pairs, out, .5, .3, .2).collect()}
    assert sizes == {"train": 45, "val": 27, "test": 18}
    back = spark.read.schema(readers.PAIR_DDL + ", split string").json(out)
    per_cluster = back.groupBy("assistant.dedup_cluster_id").agg(F.count_distinct("split").alias("n"))
    assert {r.n for r in per_cluster.collect()} == {1}
    assert training.training_pairs(df, max_rows=7, order=("message",)).count() == 7


def test_csv_sink_keeps_values(spark, tmp_path):
    rows = [(1, ' a,"b"\n c '), (2, None)]
    writers.write_csv(spark.createDataFrame(rows, "n int, t string"), str(tmp_path / "c"))
    back = readers.read_csv(spark, str(tmp_path / "c")).orderBy("n")
    assert [tuple(r) for r in back.collect()] == [("1", ' a,"b"\n c '), ("2", None)]


class _Session:
    """Stands in for a session with other settings."""

    def __init__(self, folder, master):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})


def test_shared_folder_comes_from_the_session(spark):
    cluster = _Session("hdfs://x/shared/", "yarn")
    assert session.fresh_path(cluster, "kept").startswith("hdfs://x/shared/kept-")
    assert session.fresh_path(cluster, "kept") != session.fresh_path(cluster, "kept")
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session(None, "yarn"))
    local = _Session(None, "local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
