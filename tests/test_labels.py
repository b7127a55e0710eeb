import pytest
from pyspark.sql import functions as F

from rescuelens import lexicons as lx
from rescuelens.operators import answers, labels, splits
from tests import brute
from tests.conftest import plan_of
from tests.records import RECORDS
from tests.samples import ALL


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(ALL)), "id int, t string").cache()


@pytest.fixture(scope="module")
def picked(spark):
    return spark.createDataFrame([(k, r[0]) for k, r in enumerate(RECORDS)], "id int, t string").cache()


def test_records(picked):
    for r in labels.label_posts(picked, "t", ["id"]).collect():
        post, *want = RECORDS[r.id]
        a, place = r.assistant, r.assistant.location
        assert [a.needs, a.urgency, a.life_threatening,
                (place.province, place.district, place.neighborhood, place.address_note, place.geo_confidence),
                a.people_count, a.vulnerable_groups, a.post_type, a.confidence] == want[:8], post
        assert place.country == ("Turkey" if place.province else None)
        assert r.user == brute.clean(post)
        assert r._cluster[:12] == a.dedup_cluster_id == brute.cluster(brute.clean(post))


def test_evidence(picked):
    for r in labels.with_cues(picked, "t").select(
            "id", labels.need_evidence().alias("n"), labels.vulnerable_evidence().alias("v"),
            labels.urgency_evidence().alias("u")).collect():
        assert [r.n, r.v, r.u] == list(RECORDS[r.id][9:]), RECORDS[r.id][0]


def test_mixtures_keep_the_rules(rows):
    """What must hold for any text, over many mixtures of posts."""
    for r in labels.label_posts(rows, "t", ["id"]).collect():
        a, place = r.assistant, r.assistant.location
        assert set(a.needs) <= set(lx.NEED_LABELS.values()) and len(set(a.needs)) == len(a.needs)
        assert a.urgency in ("critical", "high", "normal")
        assert a.life_threatening or a.urgency != "critical"
        assert (place.province is None) == (place.country is None)
        assert place.district is None or place.province is not None
        assert not a.needs or a.post_type in (lx.POST_REQUEST, lx.POST_OFFER)


def test_confidence_lies_on_a_grid(rows):
    got = {r[0] for r in labels.with_cues(rows, "t").select(labels.confidence()).collect()}
    assert got <= {0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8}


def test_complaint_about_missing_help_is_a_request(spark):
    df = spark.createDataFrame([("yardım gelmedi",)], "t string")
    assert labels.with_cues(df, "t").select(labels.post_type()).first()[0] == lx.POST_REQUEST


def test_map_records_runs_a_callers_labeller(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "n int")
    out = labels.map_records(df, lambda f: f.assign(twice=f.n * 2), "n int, twice int")
    assert sorted(r.twice for r in out.collect()) == list(range(0, 20, 2))


def test_translation(spark):
    df = spark.createDataFrame([("enkaz altında, çadır lazım, bilgi, bebek",)], "t string")
    row = labels.label_posts(df, "t").select(answers.translate_label(F.col("assistant"))).first()[0]
    assert row.needs == ["search_and_rescue", "shelter"]
    assert row.vulnerable_groups == ["infant"] and row.post_type == "help_request"


# --- splits ------------------------------------------------------------------------


def brute_split(clusters, train, val, seed):
    import hashlib
    ordered = sorted(clusters, key=lambda c: hashlib.sha1(f"{seed}|{c}".encode()).hexdigest())
    a, b = round(train * len(ordered)), round(val * len(ordered))
    return {c: "train" if i < a else "val" if i < a + b else "test"
            for i, c in enumerate(ordered)}


@pytest.mark.parametrize("n, train, val, test", [
    (927, .8, .1, .1), (5, .5, .5, .0), (7, .5, .25, .25), (10, 1.0, .0, .0), (10, .0, .0, 1.0),
    (1, .8, .1, .1), (3, .0, 1.0, .0), (0, .8, .1, .1)])
def test_split_matches_brute_force(spark, n, train, val, test):
    # a third of all rows belongs to one cluster
    df = spark.range(3 * n).select(F.when(F.col("id") % 3 == 0, "c0").otherwise(
        F.concat(F.lit("c"), (F.col("id") % max(n, 1)).cast("string"))).alias("c"))
    got = {(r.c, r.split) for r in splits.cluster_split(df, "c", train, val, test, 7)
           .distinct().collect()}
    assert got == set(brute_split({c for c, _ in got}, train, val, 7).items())


def test_split_moves_no_rows(spark):
    df = spark.range(1000).select((F.col("id") % 77).cast("string").alias("c"), "id")
    out = splits.cluster_split(df, "c", .8, .1, .1)
    plan = plan_of(out)
    # lines of the subquery hang off a colon
    outer = "".join(x for x in plan.splitlines() if not x.lstrip().startswith(":"))
    assert "Range" in outer and "Exchange" not in outer and "Join" not in outer
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    out.collect()
    assert "ReusedExchange" in plan_of(out)


def test_split_ratios_must_add_up(spark):
    with pytest.raises(ValueError):
        splits.cluster_split(spark.range(1), "id", .5, .1, .1)
