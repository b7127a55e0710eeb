"""Whole runs: sets of arrays, corrections, generated examples."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from rescuelens.plans import correction, generation, training
from rescuelens.sources import readers, writers
from tests.conftest import plan_of

SETS = ("train", "val", "test")


def parts(path):
    return [open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*"))]


@pytest.mark.parametrize("indent", [False, True])
def test_every_part_is_an_array(spark, tmp_path, indent):
    rows = [(k, "ş" if k % 2 else None, "train" if k % 5 else "val") for k in range(60)]
    df = spark.createDataFrame(rows, "n long, t string, of string").repartition(3)
    writers.write_json_sets(df, str(tmp_path), "of", SETS, indent)
    for name in SETS:
        arrays = [json.loads(p) for p in parts(tmp_path / f"of={name}")]
        want = [{"n": n, "t": t} for n, t, of in rows if of == name]
        assert sorted((r for a in arrays for r in a), key=lambda r: r["n"]) == want
        assert len(arrays) == (1 if name == "test" else 3)
    back = readers.read_json_sets(spark, str(tmp_path), "of", SETS, "n long, t string")
    assert sorted(map(str, map(tuple, back.collect()))) == sorted(map(str, rows))


def test_sets_of_an_empty_table(spark, tmp_path):
    writers.write_json_sets(spark.createDataFrame([], "n long, of string"), str(tmp_path), "of", SETS)
    assert [parts(tmp_path / f"of={name}") for name in SETS] == [["[]\n"]] * 3
    assert readers.read_json_sets(spark, str(tmp_path), "of", SETS, "n long").collect() == []


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    df = spark.range(40).repartition(4).select(
        "id", F.lit("train").alias("of"), F.raise_error(F.lit("lost")).cast("string").alias("x"))
    with pytest.raises(Exception, match="lost"):
        writers.write_json_sets(df, str(tmp_path / "o"), "of", SETS)
    assert not glob.glob(str(tmp_path / "o/of=*/part-*"))


def test_training_pairs_as_arrays(spark, tmp_path):
    df = spark.createDataFrame([(f"çadır lazım {'abcdefghijklmnopqrstuvwxyz'[k % 26]}",) for k in range(90)], "text string")
    pairs = training.training_pairs(df)
    sizes = training.write_training_pairs(pairs, str(tmp_path / "s"), .8, .1, .1, arrays=True)
    counts = {r.split: r.n for r in sizes.collect()}
    back = readers.read_json_sets(spark, str(tmp_path / "s"), "split", SETS)
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == counts
    assert sum(counts.values()) == 90 and len(counts) == 3 and '"_cluster"' not in "".join(parts(tmp_path / "s/split=train"))
    one = training.write_training_pairs(pairs, str(tmp_path / "all"), arrays=True, indent=True)
    assert [tuple(r) for r in one.collect()] == [("train", 90)]
    assert readers.read_json_array(spark, str(tmp_path / "all")).count() == 90


def records(tmp_path, rows):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in/a.json").write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    return str(tmp_path / "in")


def test_correction_run(spark, tmp_path):
    """Equal records are asked about once; failures are kept and leave the others alone."""
    rows = [{"user": "same", "assistant": {"needs": ["su"]}}] * 20 + [{"user": f"u{k}"} for k in range(5)]
    asked = []

    def model(requests):
        out = []
        for r in requests.collect():
            system, user = r.messages
            assert (system.role, system.content, user.role) == ("system", "Correct.", "user")
            record = json.loads(user.content)
            asked.append(record["user"])
            text = {"u0": "no", "u1": '{"a":}', "u2": None}.get(record["user"], "So: " + json.dumps({"was": record["user"]}))
            if record["user"] != "u3":
                out.append((r.record_key, text))
        out.append((out[0][0], "a second answer, without an object"))
        return spark.createDataFrame(out, "record_key string, raw_text string")

    counts = correction.run_correction(spark, records(tmp_path, rows), model, "Correct.", str(tmp_path / "out"))
    assert sorted(asked) == ["same", "u0", "u1", "u2", "u3", "u4"]
    assert tuple(counts.first()) == (25, 4)
    done = [r for p in parts(tmp_path / "out/corrected") for r in json.loads(p)]
    assert sorted(r["was"] for r in done) == ["same"] * 20 + ["u4"]
    failed = spark.read.json(str(tmp_path / "out/failed")).collect()
    assert {json.loads(r.record)["user"]: r.error for r in failed} == {
        "u0": "no_object", "u1": "bad_json", "u2": "no_object", "u3": "no_answer"}


def test_correction_plan_asks_after_a_partial_aggregation(spark):
    df = spark.createDataFrame([("{}",)] * 3, "record string")
    assert correction.requests(df, "x").count() == 1
    assert "partial_" in plan_of(correction.requests(df, "x"))


def example(text, extra=""):
    turns = [{"role": r, "content": c} for r, c in (("system", "s"), ("user", text), ("assistant", "a"))]
    return json.dumps({"messages": turns}, indent=1, ensure_ascii=False) + extra


@pytest.mark.parametrize("target, per_sample, accepted, calls", [(3, 3, 3, 5), (4, 2, 4, 7), (50, 2, 5, 9), (3, 1, 2, 3)])
def test_generation_stops(spark, tmp_path, target, per_sample, accepted, calls):
    raws = [example("a\nb"), "broken", example("ş"), example("a\nb"), example("c"), None, example("d"), "", example("e")]
    df = spark.createDataFrame([(k + 1, r) for k, r in enumerate(raws)], "attempt long, raw string").repartition(3)
    totals = generation.run_generation(df, str(tmp_path), target=target, per_sample=per_sample)
    assert tuple(totals.first()) == (accepted, calls)
    lines = "".join(parts(tmp_path)).splitlines()
    got = [json.loads(line)["messages"][1]["content"] for line in lines]
    assert got == ["a\nb", "ş", "c", "d", "e"][:accepted]


def test_instructions(spark):
    row = spark.range(1).select(generation.instructions("Use {{SYSTEM_PROMPT}}.", "P").alias("t")).first()
    assert row.t == "Use P."
