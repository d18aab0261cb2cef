import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm.packing import best_fit_plan, pack

P = pytest.importorskip("public_tokenizers")


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1, max_size=12))
def test_plan_fills_slots_without_overlap(histogram):
    plan = best_fit_plan(histogram, 64)
    used = {}
    ranks = {length: 0 for length in histogram}
    for length, lo, hi, sequence, offset, per in plan:
        assert lo == ranks[length]
        ranks[length] = hi
        for r in range(lo, hi):
            used.setdefault(sequence + (r - lo) // per, []).append((offset + (r - lo) % per * length, length))
    assert ranks == histogram
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 64
    # best fit decreasing never takes more than 11/9 of the best, plus one
    assert len(used) <= -(-sum(k * v for k, v in histogram.items()) // 64) * 11 / 9 + 1 or max(histogram) > 21


ROWS = [(1, "hello world"), (2, None), (3, ""), (4, "a b c " * 3000), (None, "null id"), (6, "twice"), (6, "twice"),
        (7, "<|endoftext|>"), (8, "日本語 😀\n\n\t x"), (9, "z" * 20_000), (10, " " * 5000), (11, "x" * 7 + "²")]


def test_matches_tokenizer(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    df = spark.createDataFrame([(d, t, 0) for d, t in ROWS], "doc_id long, text string, piece int")
    got = pack(df.repartition(3), P.path("byte_bpe_50k.json")).collect()
    want = []
    for d, t in ROWS:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    slots = {}
    for r in got:
        slots.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in slots.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(slots) == -(-sum(w[3] for w in want) // 2048) or len(slots) <= len(want)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pack(df, P.path("byte_bpe_50k.json")).count() == 0
