import pytest
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.functions import signals as sg
from rescuelens.operators import dedup, masks
from rescuelens.plans import filtering
from rescuelens.sources import readers, writers
from tests import brute
from tests.conftest import plan_of
from tests.samples import ALL

RULES = {"event": sg.EVENT_RULES, "crisis": sg.CRISIS_RULES, "tagged": sg.TAGGED_RULES}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(ALL)), "id int, t string").cache()


@pytest.mark.parametrize("corpus", RULES)
def test_signals_match_brute_force(rows, corpus):
    rules = RULES[corpus]
    df = sg.with_signals(rows, "t", rules).select(
        "id", *[sg.signal(rules, n).alias(n) for n in rules.lists],
        sg.phone().alias("phone"), sg.coordinates().alias("coord"), sg.retweet().alias("rt"),
        sg.url_count().alias("urls"), F.length(sg.FOLDED).alias("chars"))
    for r in df.collect():
        got = r.asDict()
        i = got.pop("id")
        assert got == brute.signals(ALL[i], rules.lists), ALL[i]


@pytest.mark.parametrize("mode", masks.MODES)
def test_masks_match_brute_force(rows, mode):
    for rules in RULES.values():
        got = {r.id for r in masks.keep_help_posts(rows, "t", rules, mode).collect()}
        assert got == {i for i, t in enumerate(ALL) if brute.keeps(t, rules, mode)}


def test_strict_is_part_of_balanced(rows):
    kept = {m: {r.id for r in masks.keep_help_posts(rows, "t", sg.EVENT_RULES, m).collect()}
            for m in masks.MODES}
    assert kept["strict"] < kept["balanced"]
    with pytest.raises(ValueError):
        masks.base_rule(sg.EVENT_RULES, "loose")


def test_retweets_can_be_dropped(spark):
    posts = spark.createDataFrame([("rt @a we are trapped, flood",), ("we are trapped, flood",)],
                                  "t string")
    assert masks.keep_help_posts(posts, "t", sg.EVENT_RULES).count() == 2
    assert masks.keep_help_posts(posts, "t", sg.EVENT_RULES, allow_retweets=False).count() == 1


def test_offer_list_keeps_its_bracketed_entry(spark):
    posts = spark.createDataFrame([("we are trapped, flood, drop-off here",)], "t string")
    assert masks.keep_help_posts(posts, "t", sg.EVENT_RULES).count() == 1
    assert masks.keep_help_posts(posts, "t", sg.with_dash_offers(sg.EVENT_RULES)).count() == 0


def test_tagged_mask(spark):
    rows = [("acil, somewhere far away from here", "#konum", None, True),
            ("acil, somewhere far away from here", None, None, False),
            ("acil, somewhere far away from here", None, "1", True),
            ("rt @x acil, somewhere far away", "#konum", None, False),
            (None, "#imdat #konum", None, False),            # too short
            ("imdat https://a.bc/d adres", None, None, False)]  # URL guard
    df = spark.createDataFrame(rows, "content string, hashtags string, coordinates string, want boolean")
    df = sg.with_signals(df.withColumn("_t", masks.combined_text()), "_t", sg.TAGGED_RULES)
    assert all(r.got == r.want for r in df.select(
        "want", masks.tagged_help_mask().alias("got")).collect())


def test_window_and_language(spark):
    df = spark.createDataFrame([("2023-02-06 00:00:00", "TR"), ("2023-02-08 00:00:00", "de"),
                                (None, "en")], "d string, l string")
    df = df.withColumn("d", F.col("d").cast("timestamp"))
    ends = ("2023-02-06 00:00:00", "2023-02-06 00:00:00")
    assert [r[0] for r in df.select(masks.in_window("d", *ends)).collect()] == [True, False, False]
    assert [r[0] for r in df.select(masks.in_window("d")).collect()] == [True] * 3
    assert [r[0] for r in df.select(masks.in_window(None, *ends)).collect()] == [True] * 3
    assert [r[0] for r in df.select(masks.in_languages("l")).collect()] == [True, False, True]


def test_first_wins(spark):
    rows = [(0, " 1 ", "a"), (1, "1", "b"), (2, "", "Hello  World"), (3, None, " hello world "),
            (4, " ", None), (5, None, ""), (6, "hello world", "x")]
    df = spark.createDataFrame(rows, "n int, id string, t string")
    kept = dedup.first_per_key(df, dedup.id_or_text_key("id", "t"), ["n"])
    # ids and texts share one key space, so row 6 is taken for a repeat of row 2
    assert sorted(r.n for r in kept.collect()) == [0, 2, 4]


def test_filter_comes_before_dedup(spark):
    rows = [(0, "1", "nothing to see"), (1, "1", "we are trapped in the fire"),
            (2, "1", "we are trapped in the flood")]
    df = spark.createDataFrame(rows, "n int, id string, t string")
    kept = filtering.help_posts(df, "id", "t", ["n"]).collect()
    assert [(r.n, r._sos, r._flood, r._need, r._haz) for r in kept] == [(1, True, False, False, True)]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(0, 90000, 1, 8).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    first = dedup.first_per_key(df, F.col("k"), ["n"])
    plan = plan_of(first)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert first.count() == 60001
    assert first.filter("k = 'hot'").first().n == 0


def test_drop_known(spark):
    new = spark.createDataFrame([("a",), ("b",)], "k string")
    known = spark.createDataFrame([("b",), ("b",)], "k string")
    assert [r.k for r in dedup.drop_known(new, known, "k").collect()] == ["a"]


def test_text_is_searched_once(spark, sf_dir):
    from rescuelens.catalog.relations import posts
    plan = plan_of(masks.keep_help_posts(posts(spark, sf_dir), "post_text", sg.EVENT_RULES)
                   .select("seq"))
    assert plan.count("regexp_extract_all(concat( , _folded") == 1  # the phrases
    assert plan.count("regexp_extract_all(_folded") == 1  # the URL count
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_word_lists_are_whole():
    sizes = {k: len(v) for k, v in sg.EVENT_RULES.lists.items()}
    assert sizes == {"sos": 25, "flood": 22, "need": 45, "hazard": 42, "first_person": 19,
                     "offer": 16, "location_word": 9, "address": 12}
    assert len(sg.CRISIS_RULES.lists["first_person"]) == 18
    assert {k: len(v) for k, v in sg.TAGGED_RULES.lists.items() if k in (
        "sos", "first_person", "offer", "location_word")} == {
            "sos": 26, "first_person": 17, "offer": 15, "location_word": 7}
    assert len(lx.PROVINCES) == 81


def test_tagged_run_reads_its_posts_once(spark, tmp_path, monkeypatch):
    rows = [(f"2023-02-0{k % 9 + 1}", f"ENKAZ altındayım, adres Van mah. {k % 40}", "tr" if k % 4 else "xx")
            for k in range(400)]
    writers.write_csv(spark.createDataFrame(rows, "date string, content string, language string"), str(tmp_path / "in"))
    passed = spark.sparkContext.accumulator(0)
    read = readers.read_tagged_posts

    def counting(*args, **more):
        df = read(*args, **more)

        def run(batches):
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch
        return df.mapInArrow(run, df.schema)

    monkeypatch.setattr(readers, "read_tagged_posts", counting)
    counts = filtering.run_tagged_filter(spark, str(tmp_path / "in"), str(tmp_path / "out"), "2023-02-03", None)
    assert passed.value == 400
    monkeypatch.undo()
    df = read(spark, str(tmp_path / "in"))
    assert counts.first() == filtering.tagged_funnel(df, "2023-02-03", None).first()
    assert plan_of(filtering.tagged_funnel(spark.read.parquet(_as_parquet(df, tmp_path)))).count("FileScan") == 1
    assert readers.read_csv(spark, str(tmp_path / "out")).count() == counts.first().kept > 1


def _as_parquet(df, tmp_path):
    df.write.parquet(str(tmp_path / "table"))
    return str(tmp_path / "table")
