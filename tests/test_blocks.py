"""CSV and JSON files cut anywhere, against Spark's own readers."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest

from rescuelens.sources import blocks, readers, writers
from tests.conftest import plan_of


@pytest.fixture(params=[150, 900])
def small(spark, request):
    """A session whose splits hold so many bytes."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    return session


def csv_bytes(rows, end="\r\n", quoting=csv.QUOTE_MINIMAL, header=("a", "b", "c")):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=end, quoting=quoting).writerows([header, *rows])
    return out.getvalue().encode()


def random_rows(seed, n, letters='ab,"\n Şé\\'):
    rng = random.Random(seed)
    return [[f"{k}", *("".join(rng.choice(letters) for _ in range(rng.randrange(30))) + "z" for _ in range(2))]
            for k in range(n)]


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_records_cut_anywhere(small, tmp_path):
    rows = random_rows(1, 60)
    for name, end, quoting in (("u.csv", "\n", csv.QUOTE_MINIMAL), ("w.csv", "\r\n", csv.QUOTE_ALL)):
        (tmp_path / name).write_bytes(csv_bytes(rows, end, quoting))
    df = readers.read_csv(small, str(tmp_path))
    # a line of the only column of Windows files keeps its line ends, which these texts don't have
    assert values(df) == sorted([tuple(r) for r in rows] * 2)
    spark_own = small.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path))
    assert values(df) == values(spark_own)


def test_a_file_is_many_tasks(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(csv_bytes(random_rows(2, 150)))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    df = readers.read_csv(session, str(tmp_path), order=True)
    assert df.rdd.getNumPartitions() > 5
    ordered = [r.a for r in df.orderBy(*readers.SCAN_ORDER).collect()]
    assert ordered == [str(k) for k in range(150)]
    plan = plan_of(readers.read_csv(session, str(tmp_path)))
    assert "Scan multiline" not in plan and "SortMergeJoin" not in plan


def test_two_headers_and_a_header_of_two_lines(small, tmp_path):
    rows = random_rows(3, 20)
    (tmp_path / "a.csv").write_bytes(csv_bytes(rows))
    (tmp_path / "b.csv").write_bytes(csv_bytes([r[::-1] for r in rows], header=("c", "b", "a")))
    (tmp_path / "d.csv").write_bytes(csv_bytes(rows, header=("a", "two\nlines", "c")))
    df = readers.read_csv(small, str(tmp_path))
    assert df.columns == ["a", "b", "c", "two\nlines"]
    want = [(a, b, c, None) for a, b, c in rows] * 2 + [(a, None, c, b) for a, b, c in rows]
    assert sorted(map(repr, df.collect())) and values(df.fillna("")) == sorted(
        tuple(x or "" for x in r) for r in want)


def test_records_longer_than_an_edge(small, tmp_path, monkeypatch):
    """They are read whole, by one task per file; the others are not."""
    monkeypatch.setattr(blocks, "EDGE", 64)
    rows = random_rows(4, 15)
    rows[8][1] = "line\n" * 200 + "z"
    (tmp_path / "long.csv").write_bytes(csv_bytes(rows))
    (tmp_path / "short.csv").write_bytes(csv_bytes(rows[:5]))
    (tmp_path / "open.csv").write_bytes(b'a,b,c\n1,2,"never closed\nz')
    found = blocks.survey(small, str(tmp_path), blocks.CsvLines)
    assert len(found.files) == 3
    df = readers.read_csv(small, str(tmp_path))
    assert values(df) == sorted([tuple(r) for r in rows + rows[:5]] + [("1", "2", "never closed\nz")])


def test_csv_edge_cases(small, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "blank.csv").write_bytes(b"\n\r\n\n")
    (tmp_path / "head.csv").write_bytes(b"\xef\xbb\xbfa,b,c")
    (tmp_path / "x.csv").write_bytes(b'\n\na,b,c\n\n1,"x""\n\n""y",\r\n5" pipe,6" pipe,"z"\n,,\nq\n7,"",8,9\n')
    rows = [tuple(r) for r in readers.read_csv(small, str(tmp_path)).collect()]
    assert sorted(rows, key=str) == sorted([("1", 'x"\n\n"y', None), ('5" pipe', '6" pipe', "z"), (None, None, None),
                                            ("q", None, None), ("7", None, "8")], key=str)


def test_splits_that_moved_are_noticed(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(csv_bytes(random_rows(5, 100)))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    df = readers.read_csv(session, str(tmp_path))
    session.conf.set("spark.sql.files.maxPartitionBytes", "900")
    with pytest.raises(Exception, match="split elsewhere than in the first pass"):
        df.collect()


@pytest.fixture
def few_per_split(spark):
    """A session whose splits depend on what a scan has in all."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.openCostInBytes", "100")
    session.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    return session


def test_splits_that_grew_are_noticed(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes(csv_bytes(random_rows(5, 100)))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    df = readers.read_csv(session, str(tmp_path))
    session.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    with pytest.raises(Exception, match="split elsewhere than in the first pass"):
        df.collect()


@pytest.mark.parametrize("encoded", [False, True])
def test_files_of_two_headers_are_one_scan(few_per_split, tmp_path, monkeypatch, encoded):
    """Cut as in the first pass, also where the size of splits is not ours to set."""
    rows = random_rows(8, 150)
    turkish = [[c.replace("é", "ç") for c in r] for r in rows] if encoded else rows
    for k in range(3):
        (tmp_path / f"a{k}.csv").write_bytes(csv_bytes(rows))
        (tmp_path / f"b{k}.csv").write_bytes(csv_bytes(turkish, header=("c", "b", "")).decode().encode(
            "windows-1254" if encoded else "utf-8"))
    (tmp_path / "d.csv").write_bytes(b"b,c\nx,y,too long\nx\nx,y\n")
    few_per_split.conf.set("spark.sql.files.minPartitionNum", "12")
    held = type(few_per_split.conf)
    monkeypatch.setattr(held, "set", lambda self, key, value, put=held.set:
                        None if key.startswith("spark.sql.files.") else put(self, key, value))
    if encoded:
        df = readers.read_csv_any_encoding(few_per_split, str(tmp_path))
    else:
        df = readers.read_csv(few_per_split, str(tmp_path), skip_long=True)
    want = [tuple(r) for r in rows] * 3 + [("", r[1], r[0]) for r in turkish] * 3
    want += [("", "x", ""), ("", "x", "y"), *([("", "x", "y")] if encoded else [])]
    assert df.columns == ["a", "b", "c"] and values(df.fillna("")) == sorted(want)
    assert plan_of(df).count("Scan text") == 1


def test_files_of_one_encoding_are_cut_as_all_were(few_per_split, tmp_path):
    rows = random_rows(8, 150)
    turkish = [[c.replace("é", "ç") for c in r] for r in rows]
    for k in range(3):
        (tmp_path / f"a{k}.csv").write_bytes(csv_bytes(rows))
        (tmp_path / f"b{k}.csv").write_bytes(csv_bytes(turkish).decode().encode("windows-1254"))
    df = readers.read_csv_any_encoding(few_per_split, str(tmp_path))
    assert values(df) == sorted([tuple(r) for r in rows + turkish] * 3)


def test_files_of_one_header_are_cut_as_all_were(few_per_split, tmp_path):
    rows = random_rows(8, 150)
    for k in range(3):
        (tmp_path / f"a{k}.csv").write_bytes(csv_bytes(rows))
        (tmp_path / f"b{k}.csv").write_bytes(csv_bytes(rows, header=("c", "b", "a")))
    df = readers.read_csv(few_per_split, str(tmp_path))
    assert values(df) == sorted([tuple(r) for r in rows] * 3 + [tuple(r[::-1]) for r in rows] * 3)
    # of the session it was asked of
    assert df._jdf.sparkSession().conf().get("spark.sql.session.timeZone") == "Asia/Tokyo"


def test_arrays_beside_one_that_is_read_whole(few_per_split, tmp_path):
    rows = [{"n": n, "text": f"t{n}"} for n in range(200)]
    for k in range(3):
        (tmp_path / f"{k}.json").write_text(json.dumps(rows))
    (tmp_path / "long.json").write_text(json.dumps([{"n": -1, "text": "} {" * 500_000}]))
    df = readers.read_json_array(few_per_split, str(tmp_path), "n long, text string")
    assert values(df) == sorted([(r["n"], r["text"]) for r in rows] * 3 + [(-1, "} {" * 500_000)])


def random_value(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind == 4:
        return {rng.choice(['k"', "k}", "{", "é"]): random_value(rng, depth + 1) for _ in range(rng.randrange(3))}
    if kind == 5:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(3))]
    return (None, 7, "", "".join(rng.choice('a"\\{}[],:\né ') for _ in range(rng.randrange(12))))[kind]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_cut_anywhere(small, tmp_path, indent):
    rng = random.Random(6)
    rows = [{"n": n, "text": "".join(rng.choice('a"\\{}[],é\n') for _ in range(20)), "more": random_value(rng)}
            for n in range(30)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text(json.dumps({"n": 1000, "text": "alone", "more": {"x": {"y": 1}}}, indent=indent))
    df = readers.read_json_array(small, str(tmp_path), "n long, text string")
    assert values(df) == sorted([(r["n"], r["text"]) for r in rows] + [(1000, "alone")])
    own = small.read.schema("n long, text string").option("multiLine", True).json(
        [str(tmp_path / n) for n in ("a.json", "c.json")])
    assert values(df) == values(own)


def test_json_objects_longer_than_an_edge(small, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "EDGE", 64)
    rows = [{"n": 1, "text": "x"}, {"n": 2, "text": "} {" * 500}, {"n": 3, "text": "y"}]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    (tmp_path / "b.json").write_text(json.dumps(rows[:1]))
    df = readers.read_json_array(small, str(tmp_path), "n long, text string")
    assert values(df) == sorted([(r["n"], r["text"]) for r in rows] + [(1, "x")])


def plain_open(line, inside):
    """One character after the other."""
    state, k = "quoted" if inside else "start", 0
    while k < len(line):
        c = line[k:k + 1]
        if state == "start":
            state = "quoted" if c == b'"' else "start" if c == b"," else "plain"
        elif state == "quoted" and c == b'"':
            state, k = ("quoted", k + 1) if line[k + 1:k + 2] == b'"' else ("plain", k)
        elif state == "plain" and c == b",":
            state = "start"
        k += 1
    return state == "quoted"


def test_effect_of_a_line():
    rng = random.Random(7)
    for _ in range(20_000):
        line = bytes(rng.choice(b'",ab') for _ in range(rng.randrange(14)))
        for inside in (False, True):
            assert blocks.CsvLines.fold(line, inside) == (plain_open(line, inside), 0), line


@pytest.mark.parametrize("large", [1, 64 << 20])
def test_first_lines(spark, tmp_path, monkeypatch, large):
    """Of large files little is read: the task ends with the line."""
    monkeypatch.setattr(readers, "LARGE_FILE", large)
    for k in range(3):
        (tmp_path / f"{k}.tsv").write_text("\n \n" + f"head{k}\tx\n" + "row\ty\n" * 5000)
    found = {r.file[-5:]: r.line for r in readers.first_lines(spark, str(tmp_path)).collect()}
    assert found == {f"{k}.tsv": f"head{k}\tx" for k in range(3)}


def test_tsv_headers_without_a_join(spark, tmp_path):
    for name, head, row in (("a", "tweet_id\ttweet_text\tclass_label\n", "1\tt\tl\n"),
                            ("b [x]", "x\tclass_label\ttweet_text\ttweet_id\n", "0\tk\tu\t2\n"),
                            ("c", "\n\ntweet_id\ttweet_text\tclass_label\n", "3\tv\tm\n")):
        (tmp_path / f"{name}.tsv").write_text(head + row * 3)
    (tmp_path / "none.tsv").write_text("")
    df = readers.read_event_posts(spark, str(tmp_path))
    assert values(df) == [("1", "t", "l")] * 3 + [("2", "u", "k")] * 3 + [("3", "v", "m")] * 3
    plan = plan_of(df)
    assert "Join" not in plan and plan.count("FileScan csv") == 2
    narrow = plan_of(df.select("tweet_id"))
    assert "ReadSchema: struct<c0:string>" in narrow and "ReadSchema: struct<c3:string>" in narrow


def test_edges_end_with_a_record(spark, tmp_path):
    """What the first pass keeps of a split is not half the split."""
    rows = [[f"{k}", 'x "y"\n' * 5, "z"] for k in range(40)]
    (tmp_path / "x.csv").write_bytes(b"\n\r\n" + csv_bytes(rows, end="\n"))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    session.conf.set("spark.sql.files.minPartitionNum", "1")
    kept = blocks._evidence(session, str(tmp_path), blocks.CsvLines).collect()
    assert len(kept) == 2 and all(len(r.prefix) < 150 and len(r.suffix) < 150 for r in kept), kept
    assert values(readers.read_csv(session, str(tmp_path))) == sorted(tuple(r) for r in rows)


def test_many_small_splits_are_few_tasks(spark, tmp_path):
    rows = random_rows(9, 600)
    (tmp_path / "x.csv").write_bytes(csv_bytes(rows))
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "200")
    assert blocks._units(session, str(tmp_path), blocks.CsvLines).rdd.getNumPartitions() == 8 * 4
    df = readers.read_csv(session, str(tmp_path), order=True)
    assert values(df.drop(*readers.SCAN_ORDER)) == sorted(tuple(r) for r in rows)
    assert [r.a for r in df.orderBy(*readers.SCAN_ORDER).collect()] == [str(k) for k in range(600)]


def test_arrays_are_written_a_few_records_at_a_time():
    """A task holds a piece of a batch as new values, not the batch."""
    records = [json.dumps({"n": n, "text": 'é"\n' * 10}) for n in range(3000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(records[a:b])], ["value"]) for a, b in ((0, 1), (1, 1), (1, 3000))]
    out = list(writers._framed(iter(batches)))
    assert max(b.num_rows for b in out) <= writers.PIECE < 3000
    assert json.loads("\n".join(v for b in out for v in b.column("value").to_pylist())) == [json.loads(r) for r in records]
    assert [b.column("value").to_pylist() for b in writers._framed(iter(batches[1:2]))] == [["[]"]]


def test_batches_are_taken_in_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(range(10))], ["n"])
    pieces = list(blocks._pieces(iter([batch, batch]), 4))
    assert [p.num_rows for p in pieces] == [4, 4, 2] * 2
    assert sum((p.column("n").to_pylist() for p in pieces), []) == [*range(10)] * 2
