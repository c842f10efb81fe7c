"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of words whose smallest period q fits into it four times or more (and which is six
words or longer), as far as it goes in both directions. Periods below ``FIRST_SCALE`` are met by
comparing the words with themselves q further on; that also finds the highly periodic regions of the
larger scales. At each scale t = 8, 16, 32, ... a position is selected if the hash of the t words that
start there is the least among those of the next t positions, or if that of the last of these is.
Windows of t words with a period of t/4 or less do not take part: they lie in runs known already, and
they alone would make the selection dense. What is selected depends on the next 2t words only, so in a
run with a period from t to 2t - 1 some position among the first t is selected, and again one period
later, with the same 2t words. Positions next to each other among those with equal words thus propose
a period; a proposal is followed word by word in both directions, so hashes never decide.

A scale costs a few passes over the texts of at least 4t words, and selects some 2/t of their words.

Defined cases: a NULL text counts as empty and has no words and no runs; repeated rows give repeated
rows; NULL ids stay NULL; other columns of the table are neither read nor returned. Texts are taken whole
and a text of any length is one row of work. A run is lost by chance only, if two different contexts of
one text share a 64-bit hash.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPEATS = 4
SHORTEST = 6
FIRST_SCALE = 8
WORDS = 200_000  # texts are worked on together up to this many words

RUNS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
WORD = r"[^\x20\x09-\x0D]+"


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def doubled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of windows of twice ``size`` words from those of ``size`` words."""
    return mixed(hashes[:-size] * np.uint64(0x9E3779B97F4A7C15) + hashes[size:])


def least_of_next(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each value and the ``size`` that follow, a power of two."""
    reach = 1
    while reach < size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[:-1], values[1:])


def stretches(equal: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of True that are long enough."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).view(np.int8)))
    starts, lengths = edges[::2], np.diff(edges)[::2]
    long = lengths >= shortest
    return starts[long], lengths[long]


def same_from(words: np.ndarray, left: int, right: int) -> int:
    """How many words from ``left`` on equal those from ``right`` on, where left < right."""
    count, step = 0, 64
    while right + count < len(words):
        ahead = words[right + count : right + count + step]
        wrong = np.flatnonzero(words[left + count : left + count + len(ahead)] != ahead)
        if len(wrong):
            return count + int(wrong[0])
        count, step = count + len(ahead), step * 2
    return count


def same_before(words: np.ndarray, left: int, right: int) -> int:
    """How many words before ``left`` equal those before ``right``, where left < right."""
    count, step = 0, 64
    while count < left:
        size = min(step, left - count)
        wrong = np.flatnonzero(
            words[left - count - size : left - count] != words[right - count - size : right - count]
        )
        if len(wrong):
            return count + size - 1 - int(wrong[-1])
        count, step = count + size, step * 2
    return count


class Runs:
    """Runs of one array of word numbers, by (start, end) with the least period seen."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.period_of: dict[tuple[int, int], int] = {}

    def add(self, start: int, length: int, period: int) -> None:
        # A multiple of the period of a run covers the same stretch.
        key = (start, start + length)
        self.period_of[key] = min(period, self.period_of.get(key, period))

    def small_periods(self) -> None:
        for period in range(1, min(FIRST_SCALE, len(self.words))):
            need = max(SHORTEST, REPEATS * period) - period
            for start, length in zip(*stretches(self.words[:-period] == self.words[period:], need)):
                self.add(int(start), int(length) + period, period)

    def highly_periodic(self, scale: int) -> np.ndarray:
        """For each position, whether its window of ``scale`` words has a period of a fourth or less."""
        depth = np.zeros(len(self.words) + 1, np.int32)
        for (start, end), period in self.period_of.items():
            if period * REPEATS <= scale <= end - start:
                depth[start] += 1
                depth[end - scale + 1] -= 1
        return np.cumsum(depth) > 0

    def follow(self, positions: np.ndarray, periods: np.ndarray) -> None:
        """Runs around the proposed positions; what lies in a stretch followed already is passed over."""
        order = np.lexsort((positions, periods))
        seen_period = seen_end = -1
        for position, period in zip(positions[order].tolist(), periods[order].tolist()):
            if period == seen_period and position < seen_end:
                continue
            start = position - same_before(self.words, position, position + period)
            seen_period = period
            seen_end = position + same_from(self.words, position, position + period)
            length = seen_end + period - start
            if length >= max(SHORTEST, REPEATS * period):
                self.add(start, length, period)

    def large_periods(self, scale: int, hashes: np.ndarray) -> None:
        """Periods from ``scale`` to 2 * ``scale`` - 1; ``hashes`` are those of windows of ``scale`` words."""
        never = np.uint64(2**64 - 1)
        ids = np.where(self.highly_periodic(scale)[: len(hashes)], never, hashes)
        least = least_of_next(ids, scale)
        last = ids[scale : scale + len(least)]
        places = np.flatnonzero(((ids[: len(least)] == least) | (last == least)) & (least != never))
        contexts = doubled(hashes, scale)[places]
        order = np.argsort(contexts, kind="stable")
        places, contexts = places[order], contexts[order]
        apart = np.diff(places)
        near = (contexts[1:] == contexts[:-1]) & (apart >= scale) & (apart < 2 * scale)
        self.follow(places[:-1][near], apart[near])


def runs_of(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each text, given as numbers of its words from 0 on, its runs as sorted (start, length, period).

    The texts are laid one behind the other, parted by numbers that occur once, and best are of like length.
    """
    top = 1 + max((int(text.max()) for text in texts if len(text)), default=0)
    parted = [part for i, text in enumerate(texts) for part in (text, np.array([top + i], np.int64))]
    starts = np.cumsum([0] + [len(text) + 1 for text in texts])
    words = np.concatenate(parted) if parted else np.empty(0, np.int64)
    runs = Runs(words)
    runs.small_periods()
    longest = max(map(len, texts), default=0)
    hashes, size = mixed(words.astype(np.uint64) + np.uint64(1)), 1
    scale = FIRST_SCALE
    while REPEATS * scale <= longest:
        while size < scale:
            hashes, size = doubled(hashes, size), size * 2
        runs.large_periods(scale, hashes)
        scale *= 2
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, end), period in sorted(runs.period_of.items()):
        text = int(np.searchsorted(starts, start, "right")) - 1
        found[text].append((start - int(starts[text]), end - start, period))
    return [sorted(some) for some in found]


def size_class(words: int) -> int:
    return (words // (REPEATS * FIRST_SCALE)).bit_length()


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that repeat the first period of a run."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()])


def some_at_a_time(texts: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(row, words of this and the following texts), about ``WORDS`` words each time."""
    first, words, total = 0, [], 0
    for row in range(len(texts)):
        # Splitting bytes parts at ASCII white space alone, which is what the contract calls white space.
        words.append((texts[row].as_py() or b"").split())
        total += len(words[-1])
        if total >= WORDS:
            yield first, words
            first, words, total = row + 1, [], 0
    if words:
        yield first, words


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): all runs by start and period, and the text with each run cut to one period.

    ``collapsed`` is UTF-8, its words are joined by one space; ``runs`` and starts count words from 0.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for first, texts in some_at_a_time(batch.column(1)):
                number: dict[bytes, int] = {}
                numbers = [np.array([number.setdefault(w, len(number)) for w in words], np.int64) for words in texts]
                runs: list = [None] * len(texts)
                classes: dict[int, list[int]] = {}
                for i, words in enumerate(texts):
                    classes.setdefault(size_class(len(words)), []).append(i)
                for members in classes.values():
                    for i, some in zip(members, runs_of([numbers[i] for i in members])):
                        runs[i] = some
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in some] for some in runs]
                short = [collapsed(words, some) for words, some in zip(texts, runs)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(rows, kind), pa.array(short, pa.binary())],
                    ["doc_id", "runs", "collapsed"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), F.encode(text, "UTF-8").alias("text")).mapInArrow(found, RUNS)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth document, by the checksum of its id, repeats a period up to its end.

    With h the CRC-32 of the decimal id and g = h div 10, words from a = g mod n on repeat the p words that
    stand there, p = 1 + (n - a) div (3 + g mod 8). A NULL id and a text without words are left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), h.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    some = some.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    g = F.expr("h div 10")
    some = some.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    some = some.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)").cast("int"))
    root = F.slice("words", F.col("a") + 1, "p")
    times = F.expr("cast((n - a + p - 1) div p as int)")
    tail = F.slice(F.flatten(F.array_repeat(root, times)), 1, (F.col("n") - F.col("a")).cast("int"))
    repeated = F.array_join(F.concat(F.slice("words", F.lit(1), "a"), tail), " ")
    return some.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    # The first of the greatest: greater length, then smaller start, then smaller period.
    rank = F.transform(
        "runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = F.col("best")
    return found.withColumn("best", F.array_max(rank)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-best["back"]).alias("start"),
        best["length"].alias("length"),
        (-best["small"]).alias("period"),
        F.expr("1000 * best.length div -best.small").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
