"""How the main plans behave on enlarged posts, with and without one hot key.

Usage: python scale.py [copies ...]   (default 1 4 16)

Posts are repeated with new ids. In the hot variant a third of all posts has the same id,
and a third of all posts the same text. Prints one JSON line per run, and first the
speed of plain Python regular expressions on one core for a sample of the posts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from rescuelens.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")


def enlarged(spark, copies: int, hot: bool):
    from rescuelens.catalog.relations import posts
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    df = posts(spark, SF_DIR).select("*", copy).withColumns({
        "seq": F.col("seq") * copies + F.col("copy"),
        "post_id": F.when(F.col("post_id") != "", F.concat_ws("-", "post_id", "copy")
                          ).otherwise("")})
    if hot:
        df = df.withColumns({
            "post_id": F.when(F.col("seq") % 3 == 0, "hot").otherwise(F.col("post_id")),
            "post_text": F.when(F.col("seq") % 3 == 1, "we are trapped, flood everywhere, konum"
                                ).otherwise(F.col("post_text"))})
    return df


def plans():
    from rescuelens.operators import labels, splits
    from rescuelens.plans import filtering
    return {
        "filter": lambda df: filtering.help_posts(df, "post_id", "post_text", ["seq"]),
        "label": lambda df: labels.label_posts(df, "post_text", ["seq"]),
        "split": lambda df: splits.cluster_split(df, "post_text", .8, .1, .1).select("seq", "split"),
    }


def plain_python(spark) -> None:
    """Cost of searching the word lists with one compiled alternation per list."""
    import re

    from rescuelens.functions import signals
    sample = [r.post_text or "" for r in enlarged(spark, 1, False).limit(1000).collect()]
    size = sum(len(t.encode()) for t in sample) / 1e6
    patterns = [re.compile(r"(?i)(?<!\w)(?:" + "|".join(
        re.escape(p) for p in sorted(phrases, key=len, reverse=True)) + r")(?!\w)")
        for phrases in signals.EVENT_RULES.lists.values()]
    start = time.perf_counter()
    for t in sample:
        folded = t.casefold()
        for p in patterns:
            p.search(folded)
    spent = time.perf_counter() - start
    print(json.dumps({"plain_python": "word lists of the filter",
                      "mb_per_sec_and_core": round(size / spent, 3)}), flush=True)


def main() -> None:
    spark = build_session("local[8]", "scale", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "32"})
    spark.sparkContext.setLogLevel("ERROR")
    plain_python(spark)
    for copies in [int(a) for a in sys.argv[1:]] or [1, 4, 16]:
        for hot in (False, True):
            df = enlarged(spark, copies, hot)
            size = df.agg(F.sum(F.octet_length("post_text"))).first()[0] / 1e6
            for name, plan in plans().items():
                start = time.perf_counter()
                plan(df).write.format("noop").mode("overwrite").save()
                spent = time.perf_counter() - start
                print(json.dumps({"plan": name, "copies": copies, "hot": hot, "mb": round(size),
                                  "seconds": round(spent, 2), "mb_per_sec": round(size / spent, 1)}),
                      flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
