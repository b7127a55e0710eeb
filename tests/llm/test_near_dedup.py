import random
from itertools import combinations

from pyspark.sql import functions as F

from rescuelens.llm import near_dedup, staging
from rescuelens.llm.components import components


def shingles(text, size):
    w = (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split()
    return {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def smallest_reachable(ids, links):
    best = {k: k for k in ids}
    while True:
        before = dict(best)
        for a, b in links:
            best[a] = best[b] = min(best[a], best[b])
        if before == best:
            return best


def brute(rows, size):
    sets = {k: shingles(t, size) for k, t in rows}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return {k: (len(sets[k]), c) for k, c in smallest_reachable(sets, links).items()}


def near_copies(seed, families, members, words, edits):
    rng = random.Random(seed)
    rows, k = [], 0
    for _ in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(words)]
        for _ in range(members):
            own = list(base)
            for _ in range(rng.randrange(edits)):
                own[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
            rows.append((k, " ".join(own)))
            k += 1
    rng.shuffle(rows)
    return rows


def run(docs, rows, size):
    out = near_dedup.linked(docs(rows), shingle_words=size).collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out}


def test_families_around_the_threshold(docs):
    rows = near_copies(1, 6, 30, 120, 16)
    assert run(docs, rows, 2) == brute(rows, 2)


def test_families_of_several_blocks(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    rows = near_copies(2, 2, 40, 90, 12)
    assert run(docs, rows, 2) == brute(rows, 2)


def test_edge_rows(docs):
    rows = [(9, None), (8, ""), (7, " \n\t "), (6, "One"), (5, "one"), (4, "one two"), (3, "ONE two"),
            (2, "a\x0bb c d e f"), (1, "a b c d e f"), (0, "long " * 30_000), (10, "lõng lõng lõng")]
    for size in (2, 5):
        assert run(docs, rows, size) == brute(rows, size)


def test_rows_without_an_id(docs):
    rows = [(None, "a text of its own"), (None, "the same text again"), (5, "the same text again"),
            (7, "the same text again")]
    out = near_dedup.linked(docs(rows), shingle_words=2).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in out) == [
        ("5", "5", True), ("7", "5", False), ("None", "None", True), ("None", "None", True)]


def test_empty_table(docs):
    assert near_dedup.linked(docs([])).collect() == []
    assert near_dedup.linked(docs([(1, None), (2, "")])).count() == 2


def test_first_of_each_keeps_columns(docs):
    rows = [(3, "the same text in five words"), (1, "the same text in five words"), (2, "another"), (4, None)]
    frame = docs(rows)
    out = near_dedup.first_of_each(frame)
    assert out.columns == frame.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2, 4]


def test_first_of_each_with_columns_of_any_name(spark):
    frame = spark.createDataFrame([(3, "the same text in five words", 0, "r"), (1, "the same text in five words", 1, "s")],
                                  "doc_id long, text string, gone_id int, row string")
    assert [tuple(r) for r in near_dedup.first_of_each(frame).collect()] == [(1, "the same text in five words", 1, "s")]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)]
    links += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    rng.shuffle(links)
    links = [(a, b) if rng.random() < .5 else (b, a) for a, b in links if a != b]
    ids = {x for link in links for x in link}
    out = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == smallest_reachable(ids, links)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_pair_at_the_threshold_shares_a_key():
    import numpy as np
    rng = np.random.default_rng(0)
    missed = 0
    for _ in range(300):
        both, a, b = (rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (160, 20, 20))
        pair = np.array([near_dedup.signature(np.concatenate([both, x])) for x in (a, b)])
        keys = near_dedup.keys_of(pair)
        missed += not (keys[0] == keys[1]).any()
        assert (pair[0] != pair[1]).sum() <= near_dedup.MOST_DIFFERENT
    assert missed == 0


def shared_passages(seed, passages, older):
    """Per passage older documents that hold it beside words of their own, then two near
    copies of the passage alone."""
    rng = random.Random(seed)
    rows = []
    for p in range(passages):
        passage = [f"p{p}w{k}" for k in range(60)]
        for k in range(older):
            own = [f"o{rng.randrange(10 ** 9)}" for _ in range(rng.randrange(17, 26))]
            rows.append((1000 * p + k, " ".join(passage + own)))
        for k in (older, older + 1):
            rows.append((1000 * p + k, " ".join(passage + [f"e{k}"])))
    return rows


def test_members_of_a_key_unlike_its_smallest(docs):
    rows = shared_passages(5, 2, 200)
    assert run(docs, rows, 2) == brute(rows, 2)


def test_heads_and_links_come_from_one_scan(spark):
    classes = spark.createDataFrame([], "id long, n long, signature binary")
    plan = near_dedup.candidate_links(classes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_many_rows_in_small_files_are_not_sent(spark, docs, monkeypatch):
    """Links, ids and units of a few bytes a row are far below Spark's limit for a broadcast."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    monkeypatch.setattr(near_dedup, "SENT_IDS", 0)
    monkeypatch.setattr(staging, "SENT_ROWS", 0, raising=False)
    rows = near_copies(2, 2, 40, 90, 12)
    plans, write = [], staging.stage

    def stage(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, name)

    monkeypatch.setattr(staging, "stage", stage)
    out = near_dedup.linked(docs(rows), shingle_words=2)
    stage(out, "linked")
    stage(near_dedup.first_of_each(docs(rows), shingle_words=2), "first")
    assert [name for name, plan in plans if "BroadcastHashJoin" in plan] == []
    assert sum("SortMergeJoin" in plan for _, plan in plans) > 6
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out.collect()} == brute(rows, 2)


def test_blocks_of_sizes_too_far_apart_are_no_unit(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 5)
    sizes = {k: round(10 * 1.02 ** k) for k in range(300)}
    families = spark.createDataFrame([(k, 0) for k in sizes], "id long, component long")
    classes = spark.createDataFrame(list(sizes.items()), "id long, n long")
    units = near_dedup.family_units(families, classes, 300, 80).groupBy("low", "high").agg(
        F.collect_list(F.struct("id", "own")).alias("of")).collect()
    met = [(min(x.id, y.id), max(x.id, y.id)) for u in units for x, y in combinations(u.of, 2)
           if x.own != y.own or u.low == u.high]
    assert len(met) == len(set(met))
    assert set(met) >= {(x, y) for x, y in combinations(sizes, 2) if 100 * sizes[x] >= 80 * sizes[y]}
    assert sum(len(u.of) for u in units) < 300 * 20
    assert all(sum(x.own == b for x in u.of) <= 20 for u in units for b in (u.low, u.high))


def test_families_of_several_bands(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 7)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(400)]
    rows = [(k, " ".join(base[:rng.randrange(20, 400)])) for k in range(90)]
    assert run(docs, rows, 2) == brute(rows, 2)
