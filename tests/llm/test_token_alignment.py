"""Aligned tokens against the other library's tokenizer, set intersection and plain counting."""

import hashlib
import random
from collections import Counter
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from heatgrid.llm import token_alignment, tokenizer_files
from heatgrid.llm.queries import load_aligner, op13_token_alignment
from tests.llm.conftest import LONG, prose


@lru_cache
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@lru_cache
def byte_of_char():
    """The printable characters that stand for bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    for b in range(256):
        shown.setdefault(b, chr(256 + len(shown) - len(plain)))
    return {c: b for b, c in shown.items()}


def plain_groups(text):
    """[(a ids, b ids), ...] of one text, [] if it has none."""
    if not text:
        return []
    a, b = libraries()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(byte_of_char()[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    raw = (" " + text).encode()
    if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
        return []
    ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
        groups.append((ids_a[i:p], ids_b[j:q]))
        i, j = p, q
    return groups


def plain_rows(rows):
    groups = [plain_groups(text) for _, text in rows]
    links = [Counter((x, y) for g, h in found for x in g for y in h) for found in groups]
    counts = Counter(pair for some in links for pair in some)
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for (doc_id, _), found, some in zip(rows, groups, links):
        written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in found)
        out.append(
            (
                doc_id,
                sum(len(g) for g, _ in found),
                sum(len(h) for _, h in found),
                len(found),
                some.total(),
                sum(n for pair, n in some.items() if counts[pair] == best[pair[0]]),
                sum(n * counts[pair] for pair, n in some.items()),
                hashlib.sha256(written.encode()).hexdigest() if found else "",
            )
        )
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def rows_of(docs):
    found = token_alignment.scored(token_alignment.align(docs, load_aligner, digest=True))
    return sorted((tuple(row[c] for c in COLUMNS) for row in found.collect()), key=str)


def strange(rng):
    some = ["the ", "naïve ", "日本語", "🙂🙃", "  ", "\n\n", "\t", "<|endoftext|>", "<unk>", "</s>", "<0x41>", "▁", "don't", "=====" * 9,
            "12345", "ﬁ", "é", " ", "\x00", "𝔘", "a" * 30, "    x", "\r\n", "😀" * 12, "ا لعربية", "\u00a0", " \u00a0 ", "▁ ", "\u3000 x", "\x1c "]
    return "".join(rng.choice(some) for _ in range(rng.randint(1, 60)))


def test_equals_a_plain_version(spark):
    rng = random.Random(11)
    rows = [(i, strange(rng)) for i in range(400)] + [(1000 + i, prose(i, 200)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(docs) == plain_rows(rows)


def test_pairs_seldom_met_give_the_same(spark, monkeypatch):
    rows = [(i, prose(i % 7, 60)) for i in range(40)] + [(99, "one word only zyx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = rows_of(docs)
    monkeypatch.setattr(token_alignment, "OFTEN", 20)
    assert rows_of(docs) == whole == plain_rows(rows)


def test_odd_rows(odd, odd_rows):
    assert rows_of(odd) == plain_rows([(i, t) for i, t, _ in odd_rows])


def test_no_rows(empty):
    assert rows_of(empty) == []


def test_ids_of_ranks_are_those_of_the_vocabulary(spark):
    own = tokenizer_files.byte_level(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(2)
    texts = [strange(rng) for _ in range(2000)] + [LONG]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x3000, 0x9FFF)])) for _ in range(40)) for _ in range(2000)]
    for text in texts:
        assert own.encode(" " + text) == libraries()[0].encode(" " + text, add_special_tokens=False).ids


def own_side(sizes):
    ends = np.cumsum(sizes)
    return token_alignment.Side(np.arange(len(sizes)), ends, np.array([0, len(sizes)]))


@pytest.mark.parametrize("seed", range(40))
def test_cuts_are_the_shared_ends(seed):
    rng = random.Random(seed)
    total = rng.choice([1, 7, 100, 3000])

    def sizes():
        left, out = total, []
        while left:
            out.append(min(left, rng.randint(1, rng.choice([1, 3, 60]))))
            left -= out[-1]
        return out

    a, b = own_side(sizes()), own_side(sizes())
    cuts_a, cuts_b = token_alignment.shared_cuts(a, b)
    shared = sorted({0} | (set(a.ends.tolist()) & set(b.ends.tolist())))
    assert [0, *a.ends.tolist()][:1] + [int(a.ends[c - 1]) for c in cuts_a[1:]] == shared
    assert [int(b.ends[c - 1]) for c in cuts_b[1:]] == shared[1:]


def test_a_group_without_cuts_counts_its_links():
    """Threes against sevens share every 21st byte; ends moved by one share none."""
    a, b = own_side([3] * 700), own_side([1] + [3] * 699 + [2])
    cuts_a, cuts_b = token_alignment.shared_cuts(a, b)
    assert cuts_a.tolist() == [0, 700] and cuts_b.tolist() == [0, 701]
    text, ids_a, ids_b, n = token_alignment.links(a, b, cuts_a, cuts_b)
    assert len(ids_a) == n.sum() == 700 * 701


def test_registered_query_has_the_columns_asked_for(spark):
    found = op13_token_alignment(spark, "/root/testdata/sf0.001")
    assert found.columns[:8] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
