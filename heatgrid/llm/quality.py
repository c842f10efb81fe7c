"""Document quality by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Each rule looks at counts of one text and votes good (1), bad (-1) or nothing (0). Votes are counted
per combination over all documents, of which there are at most 3 to the number of rules at any size,
and expectation-maximisation on these counts estimates how often each rule votes how for good and for
bad documents. A document is kept if the posterior probability that it is good reaches a threshold,
unless it fails the base rules, which are not up for a vote.

Defined cases: a NULL text counts as empty, has no words and fails the base rules; an empty table
gives an empty result; repeated rows each count and are each returned; a NULL doc_id is returned as it
is; other columns are neither read nor returned.
"""

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
ROWS = 256
COUNTS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words n_lines n_upper n_digits n_stop_words n_distinct_words n_marked_words"
).split()

# Frequent function words of the languages of the corpus.
STOP_WORDS = frozenset(
    b"a an and as at be by en for from in is it of on or that the this to was with "
    b"au aux avec dans de des du en est et la le les ou par pas pour que qui sur un une "
    b"auf das dem den der des die ein eine ist im in mit nicht sich und von zu "
    b"al como con del el en es la las los no para por que se su un una y".split()
)
MARKED = re.compile(rb"[^A-Za-z0-9\x80-\xff.,;:?'\"()-]")


def repeated_words(codes: np.ndarray) -> int:
    """How many words lie in a window of five that occurs twice or more. Windows are compared by
    numbering pairs, then pairs of pairs, then those with a fifth word, so equal numbers mean equal words."""
    if len(codes) < WINDOW + 1:
        return 0

    def number(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)[1]

    pairs = number(codes[:-1], codes[1:])
    fours = number(pairs[:-2], pairs[2:])
    fives = number(fours[:-1], codes[WINDOW - 1 :])
    starts = np.flatnonzero(np.bincount(fives)[fives] > 1)
    edges = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def counts_of(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes are split at SPACES exactly
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(word, len(number)) for word in words), np.int64, len(words))
    seen: set[str] = set()
    lines = repeats = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            repeats += line in seen
            seen.add(line)
    often = np.bincount(codes, minlength=len(number)) if words else np.zeros(0, np.int64)
    stop = marked = 0
    for word, code in number.items():
        bare = word.lower().strip(b".,;:!?")
        if bare in STOP_WORDS:
            stop += int(often[code])
        if len(word) > 1 and MARKED.search(word[-3:]):
            marked += int(often[code])
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        repeats,
        repeated_words(codes),
        lines,
        sum(1 for c in text if c.isupper()) if not text.islower() else 0,
        sum(map(text.count, "0123456789")),
        stop,
        len(number),
        marked,
    )


def text_counts(docs: DataFrame, *carried: str) -> DataFrame:
    """The carried columns and the counts of every whole text."""
    carried_fields = docs.select(*carried).schema.fields
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in carried_fields), *(f"{c} long" for c in COUNTS)])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.name for f in carried_fields] + COUNTS
        for batch in batches:
            for some in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                rows = [counts_of(text.as_py() or "") for text in some.column(some.num_columns - 1)]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], *columns], names)

    return docs.select(*carried, "text").mapInArrow(counted, schema)


def share(part: str, whole: str = "n_words") -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The vote of each rule, by name."""
    words, mean = F.col("n_words"), share("word_chars")
    return {
        "length": vote(words >= 50, words < 20),
        "word_length": vote(mean.between(3.5, 9), (mean < 2.5) | (mean > 12)),
        "symbols": vote(F.col("n_symbols") == 0, share("n_symbols") > 0.1),
        "repeated_lines": vote((F.col("n_dup_lines") == 0) & (F.col("n_lines") > 2), share("n_dup_lines", "n_lines") > 0.3),
        "repeated_words": vote(share("n_repeat_words") < 0.02, share("n_repeat_words") > 0.1),
        "stop_words": vote(share("n_stop_words") > 0.15, share("n_stop_words") < 0.05),
        "capitals": vote(share("n_upper", "word_chars") < 0.1, share("n_upper", "word_chars") > 0.3),
        "marks": vote(share("n_marked_words") < 0.02, share("n_marked_words") > 0.2),
    }


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior probability of "good" for each combination of votes.

    Votes are taken as independent given whether the document is good. The start says that rules are
    right more often than wrong, which fixes which of the two classes is the good one; one imagined
    vote of each kind keeps all rates above zero.
    """
    chosen = votes[:, :, None] == np.array([-1, 0, 1])  # combination, rule, vote
    good = np.full((votes.shape[1], 3), (0.1, 0.3, 0.6))
    bad = good[:, ::-1].copy()
    prior = 0.8
    posterior = np.full(len(counts), prior)
    for _ in range(rounds):
        ratio = np.log(prior) - np.log1p(-prior) + (chosen * (np.log(good) - np.log(bad))).sum((1, 2))
        posterior = 1 / (1 + np.exp(-np.clip(ratio, -700, 700)))
        for rates, weight in ((good, counts * posterior), (bad, counts * (1 - posterior))):
            rates[:] = (chosen * weight[:, None, None]).sum(0) + 1
            rates /= rates.sum(1, keepdims=True)
        # A rule that would speak against its own vote has nothing to say: both classes get the mean.
        for vote, sign in ((0, -1), (2, 1)):
            wrong = sign * (good[:, vote] - bad[:, vote]) < 0
            good[wrong, vote] = bad[wrong, vote] = (good[wrong, vote] + bad[wrong, vote]) / 2
        prior = float(((counts * posterior).sum() + 1) / (counts.sum() + 2))
    return posterior


def voted(counts: DataFrame) -> DataFrame:
    """The counts with ``votes``, all of a row as one number, and ``base_failed``."""
    code = sum(((rule + 1) * 3**i for i, rule in enumerate(rules().values())), F.lit(0))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts.withColumn("votes", code.cast("int")).withColumn("base_failed", base)


def posteriors(counts: DataFrame) -> DataFrame:
    """(votes, quality): the probability of being good for each combination of votes that occurs."""
    coded = voted(counts)
    names = list(rules())
    # At most 3 ** len(rules) rows, whatever the size of the corpus. What fails the base rules has no weight.
    weight = F.sum(F.when(F.col("base_failed"), 0).otherwise(1)).alias("n")
    met = {row.votes: row.n for row in coded.groupBy("votes").agg(weight).collect()}
    every = {sum((v + 1) * 3**i for i, v in enumerate(way)): way for way in product((-1, 0, 1), repeat=len(names))}
    order = sorted(met)
    if not order:
        return counts.sparkSession.createDataFrame([], "votes int, quality double")
    posterior = estimate(np.array([every[c] for c in order]), np.array([met[c] for c in order], float))
    spark = counts.sparkSession
    return spark.createDataFrame(
        [(c, float(round(p, 12))) for c, p in zip(order, posterior, strict=True)], "votes int, quality double"
    )


def judged(counts: DataFrame, table: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """The counts with the votes, ``base_failed``, ``quality`` (posterior) and ``kept``.

    ``table`` is that of ``posteriors``, of the same counts unless given.
    """
    coded = voted(counts)
    table = posteriors(counts) if table is None else table
    verdict = ~F.col("base_failed") & (F.col("quality") >= threshold)
    return coded.join(F.broadcast(table), "votes").withColumn("kept", verdict)
