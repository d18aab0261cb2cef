import base64

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm import bpe

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def both():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bpe.codec(PATH, P.PATTERN), other


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=200), st.text(alphabet="ab aé'stre\n\t 1²_, ", max_size=200)))
def test_same_ids_as_the_library(both, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = both[0].encode(text)
    assert ids == both[1].encode_ordinary(text)
    assert both[0].decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 30_000, "ab" * 9_000, "qwertyuiop" * 2_000, " " * 9_000, "好" * 4_000, ""])
def test_long_pre_tokens(both, text):
    assert both[0].encode(text) == both[1].encode_ordinary(text)


def test_queue_is_empty_after_each_piece(both):
    both[0].encode("some words and unfathomable concatenationsofletters")
    assert not any(both[0].queue.low)


def test_splitter_agrees_on_every_latin_character():
    slow, fast = regex.compile(P.PATTERN).findall, bpe.splitter(P.PATTERN)
    for c in map(chr, range(0x2500)):
        for text in (c, "a" + c + "b", " " + c, "1" + c + " ", "_" + c, c + "\n" + c):
            assert slow(text) == fast(text)


def test_table(spark, both):
    rows = [(1, "plain words"), (2, None), (3, ""), (None, "x"), (1, "plain words"), (5, "é" * 5000)]
    df = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, ids int")
    got = bpe.round_trip_digests(df, PATH, P.PATTERN).collect()
    assert len(got) == len(rows)
    encoded = bpe.encode(df, PATH, P.PATTERN)
    back = {(r["id"], bytes(r["bytes"])) for r in bpe.decode(encoded, PATH, P.PATTERN).collect()}
    assert back == {(d, (t or "").encode()) for d, t in rows}
    assert bpe.round_trip_digests(df.limit(0), PATH, P.PATTERN).count() == 0
