"""Byte-level BPE against an independent library, and back."""

import base64
from array import array
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from heatgrid.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBPE(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other(own):
    return tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def ids(own, text):
    return np.frombuffer(own.encode([text])[0], np.int32).tolist()


@pytest.mark.parametrize("seed", range(30))
def test_ids_and_round_trip(own, other, seed):
    rng = random.Random(seed)
    alphabet = ["the", "ing", "é", "ß", "\n", "  ", " ", "'s", "'re", "12", "²", "漢字", "🙂", " ", "\x85", "aaaa", "Tion", ",", "!!", "ñ", "́"]
    text = "".join(rng.choice(alphabet[: rng.randint(3, 21)]) for _ in range(400))
    assert ids(own, text) == other.encode_ordinary(text)
    assert own.decode(ids(own, text)).decode() == text


@pytest.mark.parametrize("text", ["", "a", "ab" * 30_000, "the" * 20_000, "x" * 50_000, " " * 30_000, "é" * 20_000])
def test_very_long_pre_tokens(own, text):
    """Round trip, and no pair of neighbours left that could merge."""
    found = ids(own, text)
    assert own.decode(found).decode() == text
    pairs = zip(found, found[1:])
    if " " not in text:
        assert not any(own.tokens[a] + own.tokens[b] in own.ranks for a, b in pairs)


def test_the_queue_gives_the_lowest_rank():
    rng = random.Random(1)
    queue, open_ = bpe.RankQueue(3000), set()
    for _ in range(3000):
        rank = rng.randrange(3000)
        if rank in open_:
            queue.close(rank)
            open_.remove(rank)
        else:
            queue.open(rank, [1, 2])
            open_.add(rank)
        assert queue.lowest() == min(open_, default=-1)


def test_many_texts_together_are_as_each_alone(own, other):
    """Long and short pre-tokens side by side, met before or not."""
    rng = random.Random(7)
    texts = ["".join(rng.choice("abehinrst é1,") for _ in range(rng.choice([0, 3, 40, 600]))) for _ in range(300)]
    for some in (texts[:200], texts[100:], texts):
        found = own.encode(some)
        assert [array("i", x).tolist() for x in found] == [other.encode_ordinary(text) for text in some]


def test_a_lower_rank_comes_first(tmp_path):
    """A merge makes a pair that ranks before what waits to its right."""
    tokens = [bytes([i]) for i in range(256)]
    ranks = {token: 300 + i for i, token in enumerate(tokens)} | {b"ab": 20, b"aba": 10, b"cab": 5}
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))
    own = bpe.ByteBPE(str(path), r".+")
    theirs = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abab", "ababab", "cabab", "abcab", "aabcabab", "cabcab", "abacab"):
        assert array("i", own.encode([text])[0]).tolist() == theirs.encode_ordinary(text)


def test_both_ways_to_split_agree():
    pattern = regex.compile(public_tokenizers.PATTERN)
    split = bpe.splitter(public_tokenizers.PATTERN)
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(chr(rng.randrange(256)) for _ in range(50))
        assert split(text) == pattern.findall(text)


def test_odd_rows_and_none(odd, odd_rows, empty, other):
    found = bpe.round_trip_digests(odd, PATH, public_tokenizers.PATTERN).collect()
    expected = []
    for doc_id, text, _ in odd_rows:
        codes = other.encode_ordinary(text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, codes)).encode(), (text or "").encode())]
        expected.append((doc_id, len(codes), *sha))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert bpe.round_trip_digests(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_null_ids(spark):
    df = spark.createDataFrame([(1, [100, None, 200]), (2, None), (3, [])], "doc_id long, ids array<int>")
    rows = bpe.decode_documents(df, PATH, public_tokenizers.PATTERN).orderBy("doc_id").collect()
    tokens = bpe.loaded(PATH, public_tokenizers.PATTERN).tokens
    assert [bytes(r.decoded) for r in rows] == [tokens[100] + tokens[200], b"", b""]


def test_a_round_trip_takes_one_python_worker_per_task(odd):
    """Two in one task would both hold ranks and pre-tokens."""
    plan = bpe.round_trip_digests(odd, PATH, public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    apart = bpe.decode_documents(bpe.encode_documents(odd, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    whole = bpe.round_trip(odd, PATH, public_tokenizers.PATTERN)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, apart.collect()))


def test_long_pre_tokens_are_not_kept(own, other):
    text = "a" * 500 + " and " + "xyz" * 200
    assert ids(own, text) == other.encode_ordinary(text)
    assert max(map(len, own.known)) <= bpe.CACHED_LENGTH
