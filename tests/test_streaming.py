import pytest
from pyspark.sql import functions as F

from rescuelens.catalog import stream_queries
from rescuelens.catalog.relations import posts
from rescuelens.functions import signals as sg
from rescuelens.operators import dedup, masks
from rescuelens.plans import filtering
from rescuelens.streaming import posts as streaming
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def source(spark, sf_dir, tmp_path_factory):
    """The posts as several files, read as a batch and as a stream of one file at a time."""
    path = str(tmp_path_factory.mktemp("stream") / "posts")
    posts(spark, sf_dir).repartitionByRange(4, "seq").write.parquet(path)
    batch = spark.read.parquet(path)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return batch, stream


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_filter_stream_equals_batch(spark, source, tmp_path):
    batch, stream = source
    query = run(streaming.help_stream(stream, "post_text").writeStream.format("parquet")
                .option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
    kept = masks.audit_flags(masks.keep_help_posts(batch, "post_text", sg.EVENT_RULES),
                             sg.EVENT_RULES).select("seq", "_sos", "_flood", "_need", "_haz")
    got = spark.read.parquet(str(tmp_path / "o")).select(kept.columns)
    assert got.count() and sorted(map(tuple, got.collect())) == sorted(map(tuple, kept.collect()))
    counters = [p["observedMetrics"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(c["read"]["rows"] for c in counters) == batch.count()
    assert sum(c["kept"]["rows"] for c in counters) == got.count()


def test_state_store_keeps_one_post_per_key(spark, source, tmp_path):
    batch, stream = source
    key = dedup.id_or_text_key("post_id", "post_text")
    run(streaming.distinct_posts(stream, key).writeStream.format("parquet")
        .option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
    got = spark.read.parquet(str(tmp_path / "o")).select(key.alias("k"))
    assert got.count() == got.distinct().count() == batch.select(key).distinct().count()


def test_watermarked_keys(spark, source, tmp_path):
    batch, stream = source
    key = dedup.id_or_text_key("post_id", "post_text")
    dated = stream.filter("posted_at IS NOT NULL")
    run(streaming.distinct_posts(dated, key, "posted_at", "3650 days").writeStream
        .format("parquet").option("path", str(tmp_path / "o"))
        .option("checkpointLocation", str(tmp_path / "c")))
    want = batch.filter("posted_at IS NOT NULL").select(key).distinct().count()
    assert spark.read.parquet(str(tmp_path / "o")).count() == want


def test_append_batches_equal_one_batch(spark, source, tmp_path):
    batch, stream = source
    key = dedup.id_or_text_key("post_id", "post_text")
    out = str(tmp_path / "o")
    streaming.start_append(streaming.help_stream(stream, "post_text"), out, str(tmp_path / "c"),
                           key, ["seq"]).start().awaitTermination()
    got = spark.read.parquet(out).select("seq", "_key")
    assert got.select("_key").distinct().count() == got.count()
    want = filtering.help_posts(batch, "post_id", "post_text", ["seq"])
    assert got.count() == want.count()


def test_append_batch_can_run_again(spark, tmp_path):
    out, key = str(tmp_path / "o"), F.col("k")
    handle = streaming.append_batch(out, key, ["n"])
    first = spark.createDataFrame([("a", 2), ("a", 1)], "k string, n int")
    second = spark.createDataFrame([("a", 0), ("b", 3)], "k string, n int")
    for batch_id, df in ((0, first), (1, second), (1, second)):
        handle(df, batch_id)
    assert sorted((r.k, r.n) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 3)]


def test_counters_outlive_the_progress(spark, source, monkeypatch):
    """More batches than the stream's progress remembers."""
    batch, stream = source
    monkeypatch.setattr(stream_queries, "_streamed", lambda spark, sf_dir: stream)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        got = stream_queries.stream_counters(spark, None).collect()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    kept = masks.keep_help_posts(batch, "post_text", sg.EVENT_RULES).count()
    assert [tuple(r) for r in got] == [(batch.count(), kept)]


def test_a_hot_key_reaches_the_state_once_per_task(spark, tmp_path):
    """A third of the posts have one key; all but one of them per task stop ahead of the state."""
    rows = [(k, "same" if k % 3 == 0 else f"k{k}") for k in range(3000)]
    path = str(tmp_path / "in")
    spark.createDataFrame(rows, "n long, k string").repartition(2).write.parquet(path)
    stream = spark.readStream.schema("n long, k string").option("maxFilesPerTrigger", 1).parquet(path)
    query = run(streaming.distinct_posts(stream, F.col("k")).writeStream.format("parquet")
                .option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2001
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    # one file is one task here: the second brings the key once more
    assert sum(s["customMetrics"]["numDroppedDuplicateRows"] for s in states) == 1


def test_keys_are_forgotten(spark, tmp_path):
    """State does not grow without bound: a key goes ``keep`` after it came."""
    schema = "k string, n int"
    for n in range(3):
        spark.createDataFrame([(f"k{n}", n), ("again", n)], schema).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = run(streaming.distinct_posts(stream, F.col("k"), keep="0 seconds").writeStream.format("parquet")
                .option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
    left = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert left[-1] < 4 and spark.read.parquet(str(tmp_path / "o")).filter("k <> 'again'").count() == 3
    for keep in ("30 days", None):
        out = str(tmp_path / f"o{keep}")
        run(streaming.distinct_posts(stream, F.col("k"), keep=keep).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", str(tmp_path / f"c{keep}")))
        assert spark.read.parquet(out).count() == 4


def test_counts_of_many_batches_from_the_stream_itself(spark, sf_dir, tmp_path):
    path = str(tmp_path / "posts")
    source = posts(spark, sf_dir).limit(200).repartition(30)
    source.write.parquet(path)
    batch = spark.read.parquet(path)
    listener = streaming.FunnelCounts(spark, str(tmp_path / "counts"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path)
        run(streaming.help_stream(stream, "post_text").writeStream.format("parquet")
            .option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    kept = spark.read.parquet(str(tmp_path / "o")).count()
    assert [tuple(r) for r in streaming.counted(spark, str(tmp_path / "counts")).collect()] == [(200, kept)]
    assert kept == masks.keep_help_posts(batch, "post_text", sg.EVENT_RULES).count()


def test_counters_scan_a_batch_once(spark, source):
    batch, _ = source
    counts = streaming.read_and_kept(batch, "post_text")
    assert plan_of(counts).count("FileScan") == 1
    kept = masks.keep_help_posts(batch, "post_text", sg.EVENT_RULES).count()
    assert tuple(counts.first()) == (batch.count(), kept)
