"""Personal data by base patterns, and further identifiers by bootstrapped contexts.

Base patterns find e-mail and IP addresses, card and phone numbers; seed patterns may name further kinds. What
they find are the seed instances. Candidates of unknown kind are digit groups with separators, tokens with dots,
at-signs or dashes, addresses that spell out their signs, and letters with digits; the shape of each tells which kinds
it may be of. Each occurrence stands, for each of these kinds, in a context: the two words and the signs before it.
So seeds and candidates of a kind share their contexts, however different they look. Contexts and instances form a
graph, which Spark scores in rounds: a context is as good as the share of its different instances that are
known to be of its kind, and is trusted from a confidence and a number of known instances on. Where two words have
been met with too few instances to tell, one word decides, for instances of the same form and on more evidence.
An instance is known from a mean confidence above one half over its contexts on, so that it brings in contexts not
trusted yet. Where a trusted context holds an instance that became known, a span is added. Base spans always stay.

Shapes have limits, numbers of rows and spans have none: a hexadecimal secret has 32 to 128 digits, the local part of a
spelled-out address at most 64 characters, a digit group 2 to 6 digits; a context is up to two words of at most 20
letters with at most 8 signs after each, and a longer word counts as none.

Defined cases: a NULL text counts as empty and has no spans; repeated rows give repeated rows with the same
spans, and count as one instance; a NULL doc_id is returned as it is; an empty table gives an empty result. All
patterns take time in proportion to the text. Columns other than doc_id and text are neither read nor returned.
"""

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.shared import stored

KINDS = ("email", "ip", "card", "phone")
MIN_CONFIDENCE, MIN_KNOWN, ROUNDS = 0.8, 5, 3
#: One word needs so many times the known instances that two words need; an instance needs more than this score.
ONE_WORD, MIN_SCORE = 4, 0.5
ROWS = 256

# The part of an address before @ is found backwards from it, and runs of digits are entered at their start
# only, so that long runs do not cost their square.
AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Seeds of kinds beyond the base ones: access keys, and long hexadecimal strings of letters and digits.
SEEDS = {"secret": r"AKIA[0-9A-Z]{16}|(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{32,128}"}
#: Runs of letters and digits; and what else can be an identifier, as a whole: a spelled-out address, digit groups
#: with separators, IPv6, tokens with dots, at-signs or dashes, and what follows a quote or an equals sign.
TOKEN = re.compile(r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*[0-9])[A-Za-z0-9_]{6,}+")
SPELLED = r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,63}+)\x20?[(\[{<]\x20?(?i:at)\x20?[)\]}>]\x20?[A-Za-z0-9-]++"
SPELLED += r"(?:(?:\.|\x20?[(\[{<]\x20?(?i:dot)\x20?[)\]}>]\x20?)[A-Za-z0-9-]++)*+"
GROUPS = r"(?:\+?[0-9]{1,3}[\x20.-]?)?\([0-9]{2,5}\)[\x20.-]?[0-9]{2,6}+(?:[\x20./-][0-9]{2,6}+)*+"
GROUPS += r"|[0-9]{2,6}+(?:\x20[0-9]{2,6}+){2,}+"
IPV6 = r"[0-9A-Fa-f]{1,4}+(?:::?[0-9A-Fa-f]{1,4}+){2,7}+(?:::)?"
JOINED = r"(?=[A-Za-z_]*+[0-9.@+~-])[A-Za-z0-9_]++(?:[.@+~-]{1,2}[A-Za-z0-9_]++)++"
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9_])(?:{SPELLED}|{GROUPS}|{IPV6}|{JOINED})|(?<=[\"`=])[A-Za-z0-9_+/~.-]{{6,}}+")
#: For the JVM: the last word and the signs after it.
LAST_WORD = r"[\p{L}\p{N}]+[^\p{L}\p{N}]*$"
WORD = re.compile(r"[A-Za-z0-9_]")
LETTER = re.compile(r"[A-Za-z]")
BRACKETS = re.compile(r"[(\[{<]")
BEFORE = re.compile(r"(?:[^\W_]{1,20}[\W_]{1,8}){1,2}$")

Span = tuple[int, int, str]


def luhn(digits: list[int]) -> bool:
    doubled = (sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def emails(text: str) -> Iterator[Span]:
    end = 0
    for found in AT.finditer(text):
        start = found.start()
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        if start < found.start():
            end = found.end()
            yield start, end, "email"


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches per kind; those that fail their check are dropped."""
    spans = list(emails(text)) if "@" in text else []
    if DIGIT.search(text):
        for found in IP.finditer(text):
            # Numbers of more than three digits count too if zeros lead; few digits decide without a long conversion.
            if all(len(n) <= 3 and int(n) <= 255 for n in (p.lstrip("0") or "0" for p in found[0].split("."))):
                spans.append((*found.span(), "ip"))
        for found in CARD.finditer(text):
            digits = digits_of(found[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((*found.span(), "card"))
        if "+" in text:
            for found in PHONE.finditer(text):
                if 10 <= len(digits_of(found[0])) <= 15:
                    spans.append((*found.span(), "phone"))
    return spans


def possible_kinds(value: str, further: list[str]) -> list[str]:
    """Of which kinds something that looks like this may be; ``further`` are the kinds of the seed patterns."""
    if not LETTER.search(value):
        n = len(digits_of(value))
        kinds = ["card"] * (6 <= n <= 128) + ["phone"] * (7 <= n <= 15)
        return kinds + ["ip"] * (value.count(".") > 1 or ":" in value)
    kinds = ["email"] if "@" in value or "." in value or BRACKETS.search(value) else []
    kinds += ["ip"] * ("@" not in value and not BRACKETS.search(value) and ("." in value or ":" in value))
    return kinds + further * (len(value) >= 6 and "@" not in value and "\x20" not in value)


def words_before(text: str, start: int) -> str:
    before = BEFORE.search(text[max(0, start - 56) : start])
    return re.sub(r"\s+", " ", before[0].lower()) if before else ""


def form(value: str) -> str:
    """What instances behind a single word must share: about as many digits, or about as long."""
    if LETTER.search(value):
        return f"l{len(value).bit_length()}"
    return f"d{min((len(digits_of(value)) + 1) // 3, 8)}"


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Where further identifiers may be. A run inside a longer candidate is one too."""
    ends = set()
    for found in CANDIDATE.finditer(text):
        start, end = found.span()
        if not WORD.match(text, end):
            ends.add((start, end))
            yield start, end
    if DIGIT.search(text):
        yield from (found.span() for found in TOKEN.finditer(text) if found.span() not in ends)


def occurrences(text: str, base: list[Span], seeds: dict[str, re.Pattern]) -> list[tuple]:
    """(start, end, instance, words, form, kinds, kind) of base spans, seeds, and candidates, whose kind is None."""
    further = list(seeds)
    known = [(start, end, kind, [kind]) for start, end, kind in base]
    taken = bytearray(len(text)) if base else None
    for start, end, _ in base:
        taken[start:end] = b"\1" * (end - start)
    for start, end in candidates(text):
        if taken is None or 1 not in taken[start:end]:
            value = text[start:end]
            kind = next((kind for kind, seed in seeds.items() if seed.fullmatch(value)), None)
            if kinds := possible_kinds(value, further):
                known.append((start, end, kind, kinds))
    out = []
    for start, end, kind, kinds in known:
        value = text[start:end]
        number = int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "big", signed=True)
        out.append((start, end, number, words_before(text, start), form(value), kinds, kind))
    return out


SPAN = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
MET = pa.struct(
    [
        ("start", pa.int32()), ("end", pa.int32()), ("instance", pa.int64()), ("words", pa.string()),
        ("form", pa.string()), ("kinds", pa.list_(pa.string())), ("kind", pa.string()),
    ]
)


def extracted(docs: DataFrame, seeds: dict[str, str]) -> DataFrame:
    """(row_no, doc_id, base, met) of every row, as a table; ``row_no`` tells rows apart."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = {kind: re.compile(seed) for kind, seed in seeds.items()}
        for batch in batches:
            for some in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                base, met = [], []
                for value in some.column(2):
                    text = value.as_py() or ""
                    spans = base_spans(text)
                    base.append([(start, kind, end) for start, end, kind in spans])
                    met.append(occurrences(text, spans, patterns))
                columns = [
                    pa.array([[dict(zip(t.names, s, strict=True)) for s in row] for row in rows], pa.list_(t))
                    for rows, t in ((base, SPAN), (met, MET))
                ]
                yield pa.RecordBatch.from_arrays([*some.columns[:2], *columns], ["row_no", "doc_id", "base", "met"])

    schema = (
        "row_no long, doc_id long, base array<struct<start:int,kind:string,end:int>>, "
        "met array<struct<start:int,end:int,instance:long,words:string,form:string,kinds:array<string>,kind:string>>"
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return stored(rows.mapInArrow(found, schema), "extracted")


def by_kind(met: DataFrame) -> DataFrame:
    """Occurrences once for each kind they may be of, with both contexts; ``seed`` is the kind they are known to be of."""
    each = met.withColumnRenamed("kind", "seed").withColumn("kind", F.explode("kinds"))
    last = F.regexp_extract("words", LAST_WORD, 0)
    return each.select(
        *(name for name in each.columns if name not in ("kinds", "words", "form")),
        F.concat_ws("|", "words", "kind").alias("context"),
        F.concat_ws("|", last, "form", "kind").alias("one_word"),
    )


def confidences(edges: DataFrame, by: str, least: int, min_confidence: float, told_from: int) -> DataFrame:
    """Confidence of the contexts in ``by`` with instances enough to tell; 0 where they are not trusted."""
    counts = edges.groupBy(by).agg(F.count("*").alias("instances"), F.count_if("known").alias("known"))
    share = F.col("known") / F.col("instances")
    trusted = (share >= min_confidence) & (F.col("known") >= least)
    return counts.where(trusted | (F.col("instances") >= told_from)).select(by, F.when(trusted, share).otherwise(0.0).alias(f"{by}_confidence"))


def scored(rows: DataFrame, two: DataFrame, one: DataFrame) -> DataFrame:
    """Rows with the confidence of their context: of two words if these tell, else of one."""
    both = rows.join(two, "context", "left").join(one, "one_word", "left")
    return both.withColumn("confidence", F.coalesce("context_confidence", "one_word_confidence", F.lit(0.0)))


def bootstrapped(
    met: DataFrame, min_confidence: float, min_known: int, rounds: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contexts of two words and of one with their confidence, and the instances that became known (instance, kind)."""
    edges = stored(met.groupBy("context", "one_word", "kind", "instance").agg(F.min("seed").alias("seed")), "edges")
    unknown = edges.where("seed IS NULL").drop("seed")
    learned = None
    for _ in range(rounds):
        if learned is None:
            labelled = edges.withColumn("known", F.coalesce(F.col("seed") == F.col("kind"), F.lit(False)))
        else:
            new = learned.withColumn("new", F.lit(True))
            labelled = edges.join(new, ["instance", "kind"], "left")
            labelled = labelled.withColumn("known", F.coalesce(F.col("seed") == F.col("kind"), "new", F.lit(False)))
        two = stored(confidences(labelled, "context", min_known, min_confidence, min_known), "two_words")
        short = labelled.groupBy("one_word", "instance").agg(F.bool_or("known").alias("known"))
        # What one word cannot tell counts as nothing, so only trusted ones are needed.
        one = confidences(short, "one_word", ONE_WORD * min_known, min_confidence, 1 << 62)
        one = stored(one, "one_word")
        learned = (
            scored(unknown, two, one)
            .groupBy("instance", "kind")
            .agg(F.avg("confidence").alias("score"))
            .where(F.col("score") > MIN_SCORE)
            # Contexts of different kinds may claim an instance; the better score has it.
            .groupBy("instance")
            .agg(F.max(F.struct("score", "kind"))["kind"].alias("kind"))
        )
        learned = stored(learned, "learned")
    return two, one, learned


def listed(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end by start, then by kind in the order given."""
    order = F.create_map(*(F.lit(x) for i, kind in enumerate(kinds) for x in (kind, i)))
    keyed = F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), F.element_at(order, s["kind"]).alias("no"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    written = F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(written, ",")


def find_personal_data(
    docs: DataFrame,
    seeds: dict[str, str] = SEEDS,
    min_confidence: float = MIN_CONFIDENCE,
    min_known: int = MIN_KNOWN,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, base, added) of every row; both are arrays of (start, kind, end) in code points."""
    found = extracted(docs, seeds)
    met = found.select("row_no", F.explode("met").alias("at")).select("row_no", "at.*")
    kinds = by_kind(met)
    two, one, learned = bootstrapped(kinds, min_confidence, min_known, rounds)
    span = F.struct("start", "kind", "end")
    seeded = met.where(F.col("kind").isNotNull() & ~F.col("kind").isin(*KINDS)).select("row_no", span.alias("span"))
    discovered = (
        scored(kinds.where("seed IS NULL").join(learned, ["instance", "kind"]), two, one)
        .where("confidence > 0")
        .select("row_no", span.alias("span"))
    )
    added = seeded.unionAll(discovered).groupBy("row_no").agg(F.collect_list("span").alias("added"))
    return found.select("row_no", "doc_id", "base").join(added, "row_no", "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:string,end:int>>")).alias("added")
    )


def digests(found: DataFrame, kinds: list[str]) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(listed(F.col("base"), kinds), 256).alias("base_sha256"),
        listed(F.concat("base", "added"), kinds).alias("spans"),
    )
