import hashlib
import random
import re
import zlib
from itertools import product

from rescuelens.llm import conversation_repair as cr
from rescuelens.llm import queries

SOUND = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
SCHEMA = "conv_id long, turn long, role string, text string, copies string, digest int, place string"


def faults(rows):
    """(initial, cut off, must go) of rows in order, and how many have which fault."""
    seen, out, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        solid = text.strip(BLANK)
        fault = ("blank" if not solid else "duplicate" if (role, text) in seen
                 else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        out.append((role[:1], fault == "truncated", fault in ("blank", "duplicate")))
    counts["illegal"] = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return out, counts


def all_ways(rows):
    """Every choice of edits with up to two inserts at each place."""
    gaps = ["", "u", "a", "ua", "au", "uu", "aa"]
    best = None
    for inserts in product(gaps, repeat=len(rows) + 1):
        for edits in product("KuaD", repeat=len(rows)):
            cost, audit, roles = 3 * sum(map(len, inserts)), "I" * len(inserts[0]), inserts[0]
            for (initial, cut_off, must_go), edit, gap in zip(rows, edits, inserts[1:]):
                if edit == "D":
                    cost, audit = cost + 4, audit + "D"
                elif must_go or edit == "K" and initial not in ("s", "u", "a"):
                    break
                else:
                    cost += 3 * cut_off + (0 if edit == "K" else 3)
                    audit += "K" if edit == "K" else "R"
                    roles += initial if edit == "K" else edit
                audit, roles = audit + "I" * len(gap), roles + gap
            else:
                if SOUND.match(roles) and (best is None or (cost, audit) < best):
                    best = cost, audit
    return best


def plain(rows):
    """Least (cost, audit) by the last role, nothing left out."""
    def inserted(best):
        todo = list(best)
        while todo:
            last = todo.pop()
            for symbol in "ua":
                if symbol in NEXT[last]:
                    way = best[last][0] + 3, best[last][1] + "I"
                    if symbol not in best or way < best[symbol]:
                        best[symbol] = way
                        todo.append(symbol)
        return best

    best = inserted({"": (0, "")})
    for initial, cut_off, must_go in rows:
        after = {}
        for last, (cost, audit) in best.items():
            ways = [(last, cost + 4, audit + "D")]
            if not must_go:
                ways += [(x, cost + 3 * cut_off, audit + "K") for x in NEXT[last] if x == initial]
                ways += [(x, cost + 3 * cut_off + 3, audit + "R") for x in NEXT[last] if x in "ua"]
            for x, *way in ways:
                after[x] = min(after.get(x, tuple(way)), tuple(way))
        best = inserted(after)
    return min(best[x] for x in ("", "a") if x in best)


def parsed(rows):
    repair = cr.Repair(0)
    for initial, cut_off, must_go in rows:
        repair._edit(initial if initial in ("s", "u", "a") else "", cut_off, must_go)
    return repair.result()[-2:]


def random_rows(rng, n):
    kinds = rng.choice(["sua", "ua", "uuua", "sx", "uaa", "us"])
    return [(rng.choice(kinds), rng.random() < .2, rng.random() < .2) for _ in range(n)]


def test_all_short_conversations():
    for n in (0, 1, 2):
        for rows in product(product("sua?", (False, True), (False, True)), repeat=n):
            assert parsed(rows) == plain(rows) == all_ways(rows), rows
    rng = random.Random(4)
    for _ in range(6):
        rows = random_rows(rng, 3)
        assert parsed(rows) == plain(rows) == all_ways(rows), rows


def test_long_conversations(monkeypatch):
    rng = random.Random(5)
    for _ in range(1500):
        rows = random_rows(rng, rng.randrange(40))
        assert parsed(rows) == plain(rows), rows
    monkeypatch.setattr(cr, "WRITTEN", 3)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(40))
        assert parsed(rows) == plain(rows), rows


def test_a_very_long_conversation_takes_few_steps():
    rows = random_rows(random.Random(1), 50) * 2000
    cost, audit = parsed(rows)
    assert len(audit.replace("I", "")) == 100_000
    assert cr.step.cache_info().currsize < 5000


def test_equal_tops_are_one():
    top = cr.BOTTOM
    for symbol in "ua":
        top = cr.shifted(top, symbol)
    assert cr.shifted(cr.shifted(cr.shifted(cr.BOTTOM, "s"), "u"), "a") == top
    assert cr.shifted(cr.BOTTOM, "a") is None and cr.shifted(top, "s") is None


# --- whole conversations -------------------------------------------------------------------


def brute(rows, damage):
    """Everything the query returns, from (conv_id, turn, role, text) rows."""
    conversations = {}
    for conv_id, turn, role, text in rows:
        own = conversations.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        if damage:
            name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            own += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        else:
            own.append((turn, role, text))
    out = {}
    for conv_id, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest()))
        marks, counts = faults([r[1:] for r in own])
        turns = [r[0] for r in own if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = plain(marks)
        lines, at, roles = [], iter(own), ""
        for edit in audit:
            _, role, text = ("", "", "") if edit == "I" else next(at)
            if edit == "D":
                continue
            if edit != "K":
                role = "assistant" if roles[-1:] == "u" else "user"
            roles += role[0]
            lines.append(f"{role}:{text}")
        assert SOUND.match(roles)
        out[conv_id] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost,
                        audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    want = brute(rows, True)
    out = queries.op13_conversation_repair(spark, sf_dir).collect()
    assert {r.conv_id: tuple(r)[1:] for r in out} == want and len(out) == len(want)
    assert len({v[6] for v in want.values()}) > 5


def mixed_rows(seed, conversations):
    rng = random.Random(seed)
    texts = ["A.", "B!", "cut", "", " \t", None, "what? ", "a\x0b\n", "Ö.", "long " * 9000 + "."]
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "User"]
    return [(rng.choice([k, k, None]), rng.choice([None, *range(-2, 9)]), rng.choice(roles), rng.choice(texts))
            for k in range(conversations) for _ in range(rng.randrange(1, 9))]


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def test_mixed_rows(spark, tmp_path):
    """Nulls, ties, repeated rows, unknown roles, rows without an id, extra columns."""
    rows = mixed_rows(7, 60) + [(5, 1, "user", "Same.")] * 7
    path = str(tmp_path)
    frame_of(spark, rows).write.parquet(f"{path}/conversations.parquet")
    out = queries.op13_conversation_repair(spark, path).collect()
    assert {r.conv_id: tuple(r)[1:] for r in out} == brute(rows, True) and None in {r.conv_id for r in out}


def test_without_damage(spark):
    rows = mixed_rows(8, 40)
    repair = cr.repaired(frame_of(spark, rows))
    want = brute(rows, False)
    assert {r.conv_id: tuple(r)[1:] for r in repair.audits.collect()} == {k: v[:7] for k, v in want.items()}
    texts = {}
    for r in repair.turns.collect():
        texts.setdefault(r.conv_id, []).append((r.place, r.role, r.text))
    for k, v in want.items():
        lines = "\n".join(f"{role}:{text}" for _, role, text in sorted(texts.get(k, [])))
        assert hashlib.sha256(lines.encode()).hexdigest() == v[7]


def test_everything_dropped(spark, tmp_path):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    frame_of(spark, [(dropped, 0, "user", "Hi.")]).write.parquet(f"{tmp_path}/conversations.parquet")
    row, = queries.op13_conversation_repair(spark, str(tmp_path)).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_empty_table(spark, tmp_path):
    frame_of(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_conversation_repair(spark, str(tmp_path)).collect() == []
