"""Alignment of the tokens of two tokenizers by divide and conquer at shared cuts.

Both tokenizers cut the bytes of a text. A stretch of bytes is divided at an end that tokens of both
share: the middle of the stretch is bisected into the ends of one side, and from there on candidates are
tried outwards, each by bisecting it into the ends of the other side. Both halves are divided in turn. A
stretch without a shared end inside is a leaf and becomes a group; one with a single token on either
side is a leaf from the start. The stretches of a batch of texts are divided together, level by level.

Every token of one side is linked with every token of the other in the same group. The links are counted
per document and pair of ids, so a large group costs its distinct ids, not its links. In how many
documents a pair is linked is a grouped count over all documents. Pairs met in more than one in
``OFTEN`` of all rows of the count can be at most ``OFTEN`` many; only these are broadcast, all others
are joined by a shuffle, in which no key is frequent.

Defined cases: a NULL or empty text has no tokens, groups or links; nor does a text whose bytes the
tokens of a side do not give back (a text that its tokenizer normalises). Repeated rows are separate
documents. Other columns are neither read nor returned. Texts are taken whole.
"""

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.shared import stored, text_or_empty

OFTEN = 200_000
TEXT_BYTES = 1_000_000  # texts are aligned together up to this size
MANY = 4_096  # links of a group from which its ids are counted first

CACHED_WORDS = 150_000  # per Python worker, and as many older ones
CACHED_LENGTH = 48
CLOSE = re.compile(r"[\s▁] ")
BETWEEN = re.compile(r"(?<=[^\s▁])(?= +[^ ])")

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "pairs array<struct<a:int,b:int,n:long>>"
)


@dataclass(frozen=True)
class Tokenizer:
    """Ids of a text, and the bytes of every id by position.

    The text begins with the space before it. No token may go on over a space that follows a visible
    character, so that a text can be encoded word by word.
    """

    encode: Callable[[str], list[int]]
    tokens: Sequence[bytes]


class Words:
    """Ids of the words met lately on both sides, as 32-bit numbers.

    New words are encoded together, as one text, and their ids parted where the words end.
    """

    def __init__(self, sides: tuple[Tokenizer, Tokenizer], lengths: tuple[np.ndarray, np.ndarray]):
        self.sides = sides
        self.lengths = lengths
        self.known: tuple[dict[str, bytes], ...] = ({}, {})
        self.older: tuple[dict[str, bytes], ...] = ({}, {})
        self.changed: set[str] = set()  # words that their tokens do not give back

    def learn(self, words: set[str]) -> None:
        """Take up the words; before that, forget those not met since the last time, if they are many."""
        if len(self.known[0]) > CACHED_WORDS:
            self.older, self.known = self.known, ({}, {})
            self.changed &= set(self.older[0])
        new = words.difference(self.known[0])
        for known, older in zip(self.known, self.older):
            known.update((word, older[word]) for word in new & older.keys())
        alone = [word for word in new.difference(self.older[0]) if len(word) > CACHED_LENGTH or CLOSE.fullmatch(word[-1] + " ")]
        joint = list(new.difference(self.older[0], alone))
        raws = [word.encode() for word in joint]
        ends = np.cumsum([len(raw) for raw in raws])
        parts = []
        for side, lengths in zip(self.sides, self.lengths):
            ids = side.encode("".join(joint)) if joint else []
            if b"".join(map(side.tokens.__getitem__, ids)) != b"".join(raws):
                alone += joint
                joint = []
                break
            ids = np.array(ids, np.int32)
            stops = np.searchsorted(np.cumsum(lengths[ids]), ends, "right") * 4
            flat = ids.tobytes()
            parts.append([flat[i:j] for i, j in zip([0, *stops.tolist()], stops.tolist())])
        for known, some in zip(self.known, parts):
            known.update(zip(joint, some))
        for word in alone:
            for side, known in zip(self.sides, self.known):
                ids = side.encode(word)
                known[word] = array("i", ids).tobytes()
                if b"".join([side.tokens[i] for i in ids]) != word.encode():
                    self.changed.add(word)

    def ids(self, words: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for known in self.known]


def words_of(text: str) -> list[str]:
    """The text cut before the spaces between words. White space and the mark that stands for a space in
    pieces stay with the space they precede, spaces at the end with the last word."""
    if CLOSE.search(text) or text.endswith(" "):
        return BETWEEN.split(text)
    return [" " + word for word in text[1:].split(" ")]


@dataclass(frozen=True)
class Side:
    """The tokens of some texts, one text behind the other: ids, ends in bytes, and the first token of each text."""

    ids: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray


def near_middle(
    ends: np.ndarray, others: np.ndarray, low: np.ndarray, high: np.ndarray, middle: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch a shared end near its middle, as positions in ``ends`` and ``others``, or -1.

    Candidates are ends[low:high]. They are tried outwards from the middle in blocks of growing width.
    """
    found, found_other = np.full(len(low), -1), np.full(len(low), -1)
    centre = np.clip(np.searchsorted(ends, middle), low, high - 1)
    open_ = np.arange(len(low))
    near, width = 0, 1
    while len(open_):
        steps = np.arange(near, near + width)
        steps = np.concatenate((steps, -1 - steps))
        # Nearest first, so that the first hit of a row is the one to take.
        steps = steps[np.argsort(np.abs(steps + 0.25), kind="stable")]
        tried = centre[open_, None] + steps
        inside = (tried >= low[open_, None]) & (tried < high[open_, None])
        tried = np.where(inside, tried, 0)
        values = ends[tried]
        place = np.minimum(np.searchsorted(others, values), len(others) - 1)
        hit = inside & (others[place] == values)
        any_hit = hit.any(axis=1)
        first = hit.argmax(axis=1)
        rows = np.arange(len(open_))
        found[open_[any_hit]] = tried[rows, first][any_hit]
        found_other[open_[any_hit]] = place[rows, first][any_hit]
        near, width = near + width, width * 2
        left = ~any_hit & ((centre[open_] + near < high[open_]) | (centre[open_] - 1 - near >= low[open_]))
        open_ = open_[left]
    return found, found_other


def shared_cuts(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """First tokens of all groups on both sides, in order, with the number of tokens at the end. No text is empty."""
    low_a, high_a = a.firsts[:-1], a.firsts[1:]
    low_b, high_b = b.firsts[:-1], b.firsts[1:]
    begin = np.where(low_a > 0, a.ends[np.maximum(low_a - 1, 0)], 0)
    cuts_a, cuts_b = [a.firsts], [b.firsts]
    while True:
        divisible = (high_a - low_a > 1) & (high_b - low_b > 1)
        low_a, high_a, low_b, high_b = low_a[divisible], high_a[divisible], low_b[divisible], high_b[divisible]
        begin = begin[divisible]
        if not len(low_a):
            break
        middle = (begin + a.ends[high_a - 1]) // 2
        # The last end of a stretch is shared anyway and divides nothing.
        at_a, at_b = near_middle(a.ends, b.ends, low_a, high_a - 1, middle)
        cut = at_a >= 0
        low_a, high_a, low_b, high_b, begin = low_a[cut], high_a[cut], low_b[cut], high_b[cut], begin[cut]
        at_a, at_b = at_a[cut] + 1, at_b[cut] + 1
        cuts_a.append(at_a)
        cuts_b.append(at_b)
        begin = np.column_stack((begin, a.ends[at_a - 1])).ravel()
        low_a, high_a = np.column_stack((low_a, at_a)).ravel(), np.column_stack((at_a, high_a)).ravel()
        low_b, high_b = np.column_stack((low_b, at_b)).ravel(), np.column_stack((at_b, high_b)).ravel()
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def side_of(ids: list[np.ndarray], lengths: np.ndarray) -> Side:
    all_ids = np.concatenate(ids).astype(np.int64)
    return Side(all_ids, np.cumsum(lengths[all_ids]), np.cumsum([0, *map(len, ids)]))


def links(a: Side, b: Side, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, a id, b id, number of links) with every pair of a text once."""
    texts = np.searchsorted(a.firsts, cuts_a[:-1], "right") - 1
    size_a, size_b = np.diff(cuts_a), np.diff(cuts_b)
    many = size_a * size_b > MANY
    group = np.flatnonzero(~many)
    times = (size_a * size_b)[group]
    each = np.repeat(group, times)
    within = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
    found_text = [texts[each]]
    found_a = [a.ids[cuts_a[each] + within // size_b[each]]]
    found_b = [b.ids[cuts_b[each] + within % size_b[each]]]
    found_n = [np.ones(len(each), np.int64)]
    for g in np.flatnonzero(many):
        ids_a, n_a = np.unique(a.ids[cuts_a[g] : cuts_a[g + 1]], return_counts=True)
        ids_b, n_b = np.unique(b.ids[cuts_b[g] : cuts_b[g + 1]], return_counts=True)
        found_a.append(np.repeat(ids_a, len(ids_b)))
        found_b.append(np.tile(ids_b, len(ids_a)))
        found_n.append(np.outer(n_a, n_b).ravel())
        found_text.append(np.full(len(found_a[-1]), texts[g]))
    text, ids_a, ids_b, n = map(np.concatenate, (found_text, found_a, found_b, found_n))
    order = np.argsort((text << 42) | (ids_a << 21) | ids_b, kind="stable")
    text, ids_a, ids_b, n = text[order], ids_a[order], ids_b[order], n[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (ids_a[1:] != ids_a[:-1]) | (ids_b[1:] != ids_b[:-1])
    starts = np.flatnonzero(new)
    return text[starts], ids_a[starts], ids_b[starts], np.add.reduceat(n, starts) if len(starts) else n


class Aligner:
    """Two tokenizers, with tables by id."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a, self.b = a, b
        self.lengths = tuple(np.array([len(token) for token in t.tokens], np.int64) for t in (a, b))
        self.words = Words((a, b), self.lengths)
        # Ids as written in a group, with what parts a token from the next: in its side, and at its end.
        self.written = [
            [f"{i}{mark}".encode() for mark in marks for i in range(len(t.tokens))]
            for t, marks in ((a, ",|"), (b, ",;"))
        ]
        self.all_written = self.written[0] + self.written[1]

    def tokens(self, texts: list[str]) -> list[list[np.ndarray] | None]:
        """Ids on both sides, None without text or if a side does not give back the bytes of space and text."""
        words = [words_of(" " + text) if text else [] for text in texts]
        self.words.learn({word for some in words for word in some})
        out: list[list[np.ndarray] | None] = []
        for text, some in zip(texts, words):
            ids = self.words.ids(some) if some else None
            if ids and self.words.changed and not self.words.changed.isdisjoint(some):
                raw = (" " + text).encode()
                if any(b"".join([side.tokens[i] for i in each.tolist()]) != raw for each, side in zip(ids, self.words.sides)):
                    ids = None
            out.append(ids)
        return out

    def aligned(self, texts: list[str]) -> list[dict]:
        rows = [dict(n_a=0, n_b=0, n_groups=0, n_links=0, groups=None, pairs=[]) for _ in texts]
        known = [(i, found) for i, found in enumerate(self.tokens(texts)) if found]
        if not known:
            return rows
        a = side_of([found[0] for _, found in known], self.lengths[0])
        b = side_of([found[1] for _, found in known], self.lengths[1])
        cuts_a, cuts_b = shared_cuts(a, b)
        sizes = np.diff(cuts_a) * np.diff(cuts_b)
        # A token is written after all tokens of earlier groups, those of a before those of b.
        order = np.empty(len(a.ids) + len(b.ids), np.int64)
        places_a = np.arange(len(a.ids)) + np.repeat(cuts_b[:-1], np.diff(cuts_a))
        places_b = np.arange(len(b.ids)) + np.repeat(cuts_a[1:], np.diff(cuts_b))
        last_a, last_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
        last_a[cuts_a[1:] - 1] = last_b[cuts_b[1:] - 1] = 1
        order[places_a] = a.ids + last_a * len(self.a.tokens)
        order[places_b] = b.ids + last_b * len(self.b.tokens) + len(self.written[0])
        order = order.tolist()
        text, ids_a, ids_b, n = links(a, b, cuts_a, cuts_b)
        starts = np.searchsorted(text, np.arange(len(known) + 1))
        group_of = np.searchsorted(cuts_a, a.firsts)
        for k, (i, _) in enumerate(known):
            written = order[a.firsts[k] + b.firsts[k] : a.firsts[k + 1] + b.firsts[k + 1]]
            first, stop = int(group_of[k]), int(group_of[k + 1])
            some = slice(starts[k], starts[k + 1])
            rows[i] = dict(
                n_a=int(a.firsts[k + 1] - a.firsts[k]),
                n_b=int(b.firsts[k + 1] - b.firsts[k]),
                n_groups=stop - first,
                n_links=int(sizes[first:stop].sum()),
                groups=b"".join(map(self.all_written.__getitem__, written))[:-1],
                pairs=(ids_a[some], ids_b[some], n[some]),
            )
        return rows


def record_batch(ids: pa.Array, rows: list[dict], groups: list[str | None]) -> pa.RecordBatch:
    pairs = [row["pairs"] or (np.empty(0, np.int64),) * 3 for row in rows]
    columns = [np.concatenate([some[c] for some in pairs]) for c in range(3)]
    kinds = (pa.int32(), pa.int32(), pa.int64())
    flat = pa.StructArray.from_arrays(
        [pa.array(column.astype(kind.to_pandas_dtype())) for column, kind in zip(columns, kinds)], ["a", "b", "n"]
    )
    ends = np.cumsum([0, *(len(some[0]) for some in pairs)]).astype(np.int32)
    numbers = [pa.array([row[name] for row in rows], pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs"]
    arrays = [ids, *numbers, pa.array(groups, pa.string()), pa.ListArray.from_arrays(pa.array(ends), flat)]
    return pa.RecordBatch.from_arrays(arrays, names)


def align(docs: DataFrame, load: Callable[[], Aligner], digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs) of every row.

    ``load`` is called on the executors, and keeps what it loads. ``groups`` is ``a1,a2|b1;a3|b2,b3`` with
    the ids of the tokens in order, '' without tokens; with ``digest`` it is the SHA-256 of that in
    lowercase hex, or ''. ``pairs`` holds each pair of linked ids once, with its number of links.
    """

    def one_batch(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        rows = load().aligned(texts)
        written = [row["groups"] or b"" for row in rows]
        groups = [hashlib.sha256(g).hexdigest() if digest and g else g.decode() for g in written]
        return record_batch(ids, rows, groups)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, texts, size = 0, [], 0
            for row in range(batch.num_rows):
                texts.append(batch.column(1)[row].as_py())
                size += len(texts[-1])
                if size >= TEXT_BYTES or row + 1 == batch.num_rows:
                    yield one_batch(batch.column(0).slice(first, len(texts)), texts)
                    first, texts, size = row + 1, [], 0

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(aligned, ALIGNED)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, documents, best): in how many documents a pair is linked, and whether no pair of its a id is in more."""
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("documents"))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy(F.col("a").alias("most_a")).agg(F.max("documents").alias("most"))
    found = counts.join(most, F.col("a") == F.col("most_a"))
    return stored(found.select("a", "b", "documents", (F.col("documents") == F.col("most")).alias("best")), "pair-table")


def scored(aligned: DataFrame) -> DataFrame:
    """``aligned`` without its pairs, with n_best and count_sum over the links of each row."""
    table = stored(aligned.withColumn("row_id", F.monotonically_increasing_id()), "aligned")
    pairs = table.select("row_id", F.inline("pairs"))
    counts = pair_counts(pairs)
    total = counts.agg(F.coalesce(F.sum("documents"), F.lit(0)).alias("total")).first().total
    often = F.col("documents") * OFTEN > total
    counts = counts.withColumnsRenamed({"a": "pair_a", "b": "pair_b"})
    same = (F.col("a") == F.col("pair_a")) & (F.col("b") == F.col("pair_b"))

    def sums(found: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("best"), F.col("n")).otherwise(0))
        return found.groupBy("row_id").agg(best.alias("n_best"), F.sum(F.col("n") * F.col("documents")).alias("count_sum"))

    # At most OFTEN pairs are in more than total / OFTEN rows.
    frequent = F.broadcast(counts.where(often))
    seldom = pairs.join(frequent, same, "left_anti").join(counts.where(~often), same)
    both = sums(pairs.join(frequent, same)).unionByName(sums(seldom))
    per_row = both.groupBy("row_id").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return table.drop("pairs").join(per_row, "row_id", "left").drop("row_id").na.fill(0, ["n_best", "count_sum"])
