import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rescuelens.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = ["it's 'tis DON'T we'll", "", "   ", "a<|endoftext|>b <|ENDOFTEXT|>", "ΑΣ σίγμας Σ", "İstanbul é Å x",
       "12 345,6.7 ab12cd !!..'s", "tab\x1cx\x85y z", "日本語 テスト ½ ²", "naïve—dash “quote”…", " x ",
       "ǅ ß SS", "...,,", "각 ᄀ가", "é café", "x" * 5000, "\x00a\x01b", "a b‍c"]


def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(reference, text):
    return np.asarray(reference.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_ids_equal_the_tokenizers(spark, sf_dir):
    reference, fast = tokenizer(), packing.text_ids(PATH)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    texts = [r.text for r in rows] + ODD
    want = [ids_of(reference, t) for t in texts]
    assert fast.of_texts([t.encode() for t in texts]) == want
    assert [fast.of_texts([t.encode()])[0] for t in texts[-60:]] == want[-60:]


def check_places(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:k]) for k in range(len(parts))]
        assert sum(p[1] for p in parts) <= capacity
    return len(by_sequence)


def test_query_against_the_tokenizer(spark, sf_dir):
    reference = tokenizer()
    rows = queries.op1_packing(spark, sf_dir).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {}
    for doc_id, text in texts.items():
        ids = ids_of(reference, text or "") + b"\0\0\0\0"
        for k, at in enumerate(range(0, len(ids), 4 * 2048)):
            part = ids[at:at + 4 * 2048]
            want[doc_id, k] = (at // 4, len(part) // 4, zlib.crc32(part))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    sequences = check_places(rows, 2048)
    total = sum(r.length for r in rows)
    assert sequences <= -(-total // 2048) * 1.005 + 1


def test_edge_rows_and_long_texts(docs):
    frame = docs([(1, None), (2, ""), (3, "word " * 9000), (4, "a b"), (4, "a b"), (5, "\n \t"), (None, "c")])
    result = packing.packed(frame, PATH, capacity=100, group_rows=40)
    rows = packing.sequences(result).collect()
    check_places(rows, 100)
    lengths = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
    assert lengths == {1: 1, 2: 1, 3: 9001, 4: 6, 5: 1, None: 2}


def test_empty_table(docs):
    assert packing.sequences(packing.packed(docs([]), PATH)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_each_choice_makes_the_sum_of_squares_smallest(seed):
    rng = np.random.default_rng(seed)
    bins, capacity = packing.OpenSequences(30), 30
    levels = {}
    for length in rng.integers(1, 31, 200).tolist():
        def cost(gaps):
            counts = np.bincount([g for g in gaps if 0 < g < capacity], minlength=capacity + 1)
            return int((counts.astype(int) ** 2).sum())
        before = list(levels.values())
        choices = [cost([*before, capacity - length])]
        for k, gap in enumerate(before):
            if gap >= length:
                choices.append(cost([*before[:k], gap - length, *before[k + 1:]]))
        sequence, offset = bins.place(length)
        assert offset == capacity - levels.get(sequence, capacity)
        levels[sequence] = levels.get(sequence, capacity) - length
        assert levels[sequence] >= 0
        assert cost(levels.values()) == min(choices)


@pytest.mark.parametrize("lengths", [[], [5], [2048, 2048], [1024] * 7, [1] * 5000, [2047, 1, 2047, 1]])
def test_places_of_special_lengths(lengths):
    lengths = np.array(lengths, np.int64)
    sequences, offsets = packing.place_lengths(lengths)
    filled = {}
    for s, o, n in sorted(zip(sequences.tolist(), offsets.tolist(), lengths.tolist())):
        assert o == filled.get(s, 0)
        filled[s] = o + n
    assert len(filled) == -(-sum(lengths.tolist()) // 2048) and max(filled.values(), default=0) <= 2048


def test_tokenised_once(docs):
    frame = docs([(k, f"text {k}") for k in range(20)])
    result = packing.packed(frame, PATH)
    assert "MapInArrow" not in result.pieces._jdf.queryExecution().executedPlan().toString()
    assert result.pieces.filter(F.col("length") > 2048).count() == 0


def plain_dissolve(lengths, sequences, capacity):
    """Each sequence tried on a copy of the gaps."""
    filled = np.bincount(sequences, lengths).astype(np.int64)
    members = {}
    for k, s in enumerate(sequences.tolist()):
        if filled[s] < capacity:
            members.setdefault(s, []).append(k)
    gaps = {s: capacity - int(filled[s]) for s in members}
    for sequence in sorted(members, key=lambda s: (filled[s], s)):
        rest = {s: g for s, g in gaps.items() if s != sequence and g}
        moves = []
        for k in sorted(members[sequence], key=lambda k: -lengths[k]):
            able = sorted((g, s) for s, g in rest.items() if g >= lengths[k])
            if not able:
                break
            moves.append((k, able[0][1]))
            rest[able[0][1]] -= int(lengths[k])
        else:
            for k, other in moves:
                sequences[k] = other
                members[other].append(k)
            members[sequence], gaps = [], rest


@pytest.mark.parametrize("seed", range(6))
def test_emptying_sequences_against_a_plain_search(seed):
    rng = np.random.default_rng(seed)
    for most in (30, 60, 100):
        lengths = rng.integers(1, most + 1, 120)
        sequences, room = np.zeros(120, np.int64), []
        for k, n in enumerate(lengths.tolist()):
            able = [s for s, r in enumerate(room) if r >= n]
            s = int(rng.choice(able)) if able and rng.random() < .7 else len(room)
            room += [100] if s == len(room) else []
            room[s] -= n
            sequences[k] = s
        want = sequences.copy()
        plain_dissolve(lengths, want, 100)
        packing.dissolve(lengths, sequences, 100)
        assert (sequences == want).all()


def test_emptying_until_no_gap_is_left():
    sequences = np.array([0, 1])
    packing.dissolve(np.array([50, 50]), sequences, 100)
    assert sequences.tolist() == [1, 1]


def test_many_long_pieces_take_seconds():
    import time
    rng = np.random.default_rng(1)
    began = time.perf_counter()
    sequences, _ = packing.place_lengths(rng.integers(1030, 2001, 50_000))
    assert time.perf_counter() - began < 15 and len(set(sequences.tolist())) == 50_000
