"""Main text of web pages by wrappers, which are union-free regular expressions inferred per host.

A page is a stream of tags and texts. Streams of one host are aligned with each other, within each pair of
matching tags in turn: equal tags are matched in order, what only one side has becomes optional, neighbours
of one kind become a repeated element, neighbouring sequences of one kind a repeated group, and texts
become slots. What comes of it is a wrapper, which is aligned with the next one. A list of more than
``LONGEST`` parts is turned into a repeated group of optional parts, one of each kind, so a wrapper stays as
small as a page has kinds of blocks. There are no alternatives in it.

Wrappers are inferred over all pages: each page becomes a wrapper of its own in the task that reads it,
equal ones of a host are merged by a grouping, and different ones are aligned in rounds of about
``TOGETHER`` per task until one is left, whatever share of the pages a host has. What every slot holds is then
counted over all pages: text, link text, and whether the text is always the same. From that and the names
of elements, a wrapper is told which slots are main text:

* the slots below ``article``, else ``main``, else below the lowest container with most of the running text;
* but none in or below blocks that are menus, headers, footers, sidebars, notices, adverts, forms or
  comments by their element or by a word of their class, id or role;
* no slot that is link text nearly throughout on three pages or more, and none that has the same text on
  five pages or more while others vary.

A word is not believed of a block around the article, of one with most of the text of its host, of ``main``,
or of an ``article`` where no other article is without such a word.

Defined cases: a NULL html is an empty page and gives ''; a NULL url, or one without a host, belongs to the
host ''; repeated rows give repeated rows; NULL ids stay NULL; other columns are neither read nor returned.
"""

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatgrid.llm.html_pages import Block, Text, parse
from heatgrid.llm.shared import stored, text_or_empty

LONGEST = 40
GROUP = 4  # longest repeated sequence that is looked for
CELLS = 200_000  # lists up to this product of lengths are matched by longest common subsequence
ALIKE = 0.5
TOGETHER = 16
LINKED, LINKED_PAGES = 0.9, 3
SAME_PAGES = 5
MOST = 0.5

# A part of a wrapper is [sign, flags, parts]. Signs of text slots and groups are no tag names.
SLOT, SEVERAL = "#", "("
OPTIONAL, REPEATED, ANY_ORDER = 1, 2, 4

# Elements, and words of class, id and role, of what is no main text.
ASIDE_NAMES = frozenset("nav header footer aside form menu dialog fieldset legend".split())
ASIDE_WORDS = re.compile(
    r"ad|ads|adv|advert\w*|adsense|ad(box|slot|unit)|banner\w*|promo\w*|sponsor\w*|"
    r"nav|nav(bar|igation)\w*|\w*menu|breadcrumb\w*|pager|pagination|toolbar|topbar|masthead|"
    r"sidebar\w*|aside|rail|widget\w*|complementary|contentinfo|search\w*|login|signin|signup|"
    r"notices?|cookies?\w*|consent|gdpr|alerts?|popup\w*|modal\w*|overlay|newsletter\w*|subscri\w*|disclaimer|"
    r"comments?|comment(list|area|form|section)\w*|disqus\w*|repl(y|ies)|respond|discussion|"
    r"shar(e|ing)\w*|social\w*|related\w*|recommend\w*|trending|popular|foot|footer\w*|header\w*|copyright|form"
)
MAIN_NAMES = ("article", "main")
CONTAINERS = frozenset("html body div section center table tbody tr td".split())
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*@)?([^/?#:]*)"

Part = list


def kinds(parts: list[Part]) -> tuple[str, ...]:
    return tuple(part[0] if part[0] != SEVERAL else "(" + " ".join(kinds(part[2])) for part in parts)


def merged(one: Part, other: Part) -> Part:
    """What matches both; parts of one kind."""
    return [one[0], one[1] | other[1], aligned(one[2], other[2])]


def next_to_each_other(one: Part, other: Part) -> Part:
    """Two neighbours of one kind as a repeated part, optional only if both are."""
    both = merged(one, other)
    both[1] = (one[1] & other[1] & OPTIONAL) | ((one[1] | other[1]) & ~OPTIONAL) | REPEATED
    return both


def alike(one: Part, other: Part) -> bool:
    """Whether two parts of one sign hold mostly the same kinds of parts."""
    left, right = set(kinds(one[2])), set(kinds(other[2]))
    return not left or not right or len(left & right) > ALIKE * len(left | right)


def folded(parts: list[Part]) -> list[Part]:
    """Neighbours of one kind become repeated parts, sequences that follow each other repeated groups."""
    out: list[Part] = []
    for part in parts:
        if out and kinds([out[-1]]) == kinds([part]) and alike(out[-1], part):
            out[-1] = next_to_each_other(out[-1], part)
        else:
            out.append(part)
    for size in range(2, GROUP + 1):
        i = 0
        while i + 2 * size <= len(out):
            names = kinds(out[i : i + size])
            if SEVERAL in "".join(names) or names != kinds(out[i + size : i + 2 * size]):
                i += 1
                continue
            group = out[i : i + size]
            while kinds(out[i + size : i + 2 * size]) == names:
                group = [merged(a, b) for a, b in zip(group, out[i + size : i + 2 * size])]
                del out[i + size : i + 2 * size]
            out[i : i + size] = [[SEVERAL, REPEATED, group]]
            i += 1
    return out if len(out) <= LONGEST else [in_any_order(out)]


def in_any_order(parts: list[Part]) -> Part:
    """A repeated group of optional parts, one of each kind."""
    known: dict[str, Part] = {}

    def add(some: list[Part]) -> None:
        for part in some:
            if part[0] == SEVERAL:
                add(part[2])
            elif part[0] in known:
                known[part[0]] = merged(known[part[0]], part)
            else:
                known[part[0]] = part

    add(parts)
    every = [[known[sign][0], known[sign][1] | OPTIONAL, known[sign][2]] for sign in sorted(known)]
    return [SEVERAL, REPEATED | OPTIONAL | ANY_ORDER, every]


def with_groups_of(parts: list[Part], others: list[Part]) -> list[Part]:
    """``parts`` where a sequence that is a group among the others stands as a group too."""
    for group in others:
        if group[0] != SEVERAL:
            continue
        names, size, i = kinds(group[2]), len(group[2]), 0
        parts = list(parts)
        while i + size <= len(parts):
            if kinds(parts[i : i + size]) == names:
                parts[i : i + size] = [[SEVERAL, 0, parts[i : i + size]]]
            i += 1
    return parts


def matches(one: tuple[str, ...], other: tuple[str, ...]) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence; of very long lists, of one taken from left to right."""
    pairs, start = [], 0
    while start < min(len(one), len(other)) and one[start] == other[start]:
        pairs.append((start, start))
        start += 1
    n, m = len(one), len(other)
    tail = []
    while n > start and m > start and one[n - 1] == other[m - 1]:
        n, m = n - 1, m - 1
        tail.append((n, m))
    rows, columns = n - start, m - start
    if rows * columns > CELLS:
        j = start
        for i in range(start, n):
            if one[i] in other[j:m]:
                j = other.index(one[i], j, m)
                pairs.append((i, j))
                j += 1
    elif rows and columns:
        best = [[0] * (columns + 1) for _ in range(rows + 1)]
        for i in range(rows - 1, -1, -1):
            for j in range(columns - 1, -1, -1):
                same = one[start + i] == other[start + j]
                best[i][j] = best[i + 1][j + 1] + 1 if same else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < rows and j < columns:
            if one[start + i] == other[start + j]:
                pairs.append((start + i, start + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return pairs + tail[::-1]


def aligned(one: list[Part], other: list[Part]) -> list[Part]:
    """One list of parts that matches what either of the two matches."""
    if one == other:
        return one
    if any(part[1] & ANY_ORDER for part in (*one, *other)):
        return [in_any_order([*one, *other])]
    one, other = with_groups_of(one, other), with_groups_of(other, one)
    out: list[Part] = []
    i = j = 0
    for p, q in [*matches(kinds(one), kinds(other)), (len(one), len(other))]:
        out += [[sign, flags | OPTIONAL, parts] for sign, flags, parts in (*one[i:p], *other[j:q])]
        if p < len(one):
            out.append(merged(one[p], other[q]))
        i, j = p + 1, q + 1
    return folded(out)


def wrapper_of(block: Block) -> list[Part]:
    """The wrapper of a single page."""
    parts = []
    for child in block.children:
        if isinstance(child, Block):
            parts.append([child.sign, 0, wrapper_of(child)])
        elif child.clean():
            parts.append([SLOT, 0, []])
    return folded(parts)


def written(wrapper: list[Part]) -> str:
    return json.dumps(wrapper, separators=(",", ":"))


class Places:
    """The parts of a wrapper numbered in order, and for every list of parts where its kinds stand."""

    def __init__(self, wrapper: list[Part]):
        self.signs: list[str] = [""]
        self.above: list[int] = [0]
        self.lists: list[dict[str, list[int]]] = [{}]
        self.next: list[int] = [0]  # where the list may go on after a part
        self._number(wrapper, 0, 0, None)

    def _number(self, parts: list[Part], above: int, owner: int, group: int | None) -> None:
        for sign, flags, inner in parts:
            place = len(self.signs)
            self.signs.append(sign)
            self.above.append(above)
            self.next.append(group or (place if flags & REPEATED else place + 1))
            self.lists.append({})
            if sign == SEVERAL:
                # What is in a group stands in the list that holds the group.
                self._number(inner, place, owner, place if flags & REPEATED else group)
            else:
                self.lists[owner].setdefault(sign, []).append(place)
                self._number(inner, place, place, None)

    def find(self, owner: int, sign: str, after: int) -> int:
        """The next part of a kind, else the last one; -1 if the list has none."""
        known = self.lists[owner].get(sign) if owner >= 0 else None
        if not known:
            return -1
        return next((place for place in known if place >= after), known[-1])

    def texts(self, page: Block) -> Iterator[tuple[int, int, Text, str]]:
        """(slot or -1, lowest block matched, text, its clean form) of a page in order."""
        open_ = [(iter(page.children), 0, 0, 0)]
        while open_:
            children, owner, block, after = open_.pop()
            for child in children:
                sign = child.sign if isinstance(child, Block) else SLOT
                place = self.find(owner, sign, after)
                after = self.next[place] if place > 0 else after
                if isinstance(child, Block):
                    if place < 0 and is_aside(child.sign):
                        continue
                    open_.append((children, owner, block, after))
                    open_.append((iter(child.children), place, place if place > 0 else block, 0))
                    break
                if shown := child.clean():
                    yield place, block, child, shown


@lru_cache(2_000)
def places_of(wrapper: str) -> Places:
    return Places(json.loads(wrapper))


def is_aside(sign: str) -> bool:
    name, *words = sign.split(".")
    return name in ASIDE_NAMES or any(map(ASIDE_WORDS.fullmatch, words))


def main_parts(places: Places, counts: dict[int, dict]) -> list[int]:
    """The blocks and slots of main text, by number.

    ``counts`` has for a slot its pages, characters, linked characters and whether its text is the same
    throughout.
    """
    size = len(places.signs)
    names = [sign.split(".")[0] for sign in places.signs]
    slots = [i for i in range(1, size) if places.signs[i] == SLOT]
    text = [0] * size
    for i in slots:
        text[i] = counts.get(i, {}).get("chars", 0)
    for i in range(size - 1, 0, -1):
        text[places.above[i]] += text[i]

    around = set()  # blocks around an article or main
    for i in range(1, size):
        if names[i] in MAIN_NAMES:
            while i := places.above[i]:
                around.add(i)
    plain_article = any(names[i] == "article" and not is_aside(places.signs[i]) for i in range(1, size))
    aside = [False] * size
    for i in range(1, size):
        by_name = names[i] in ASIDE_NAMES
        if names[i] in MAIN_NAMES:
            believed = names[i] == "article" and plain_article
        else:
            believed = i not in around and text[i] <= MOST * text[0]
        aside[i] = aside[places.above[i]] or by_name or (believed and is_aside(places.signs[i]))

    varies = any(not counts[i]["same"] for i in slots if i in counts and not aside[i])

    def running(i: int) -> bool:
        slot = counts.get(i)
        if aside[i] or slot is None:
            return not aside[i]
        links = slot["linked"] >= LINKED * slot["chars"] and slot["pages"] >= LINKED_PAGES
        return not links and not (slot["same"] and varies and slot["pages"] >= SAME_PAGES)

    good = {i for i in slots if running(i)}
    roots = next((found for name in MAIN_NAMES if (found := [i for i in range(1, size) if names[i] == name and not aside[i]])), None)
    if roots is None:
        roots = [densest(places, good, counts)]
    inside = [False] * size
    for i in range(size):
        inside[i] = (i in roots or (i > 0 and inside[places.above[i]])) and not aside[i]
    return [i for i in range(size) if inside[i] and (places.signs[i] != SLOT or i in good)]


def densest(places: Places, good: set[int], counts: dict[int, dict]) -> int:
    """The lowest container with most of the running text."""
    size = len(places.signs)
    weight = [0] * size
    for i in good:
        weight[i] = counts.get(i, {}).get("chars", 0)
    for i in range(size - 1, 0, -1):
        weight[places.above[i]] += weight[i]
    # A repeated block is one of several paragraphs or rows, whatever its element.
    blocks = [i for i in range(1, size) if places.signs[i].split(".")[0] in CONTAINERS and places.next[i] > i]
    most = [i for i in blocks if weight[i] > MOST * weight[0]]
    return max(most, default=0)


def hosts(url: Column | str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 2), F.lit("")))


def one_by_one(columns: list[pa.Array]) -> Iterator[list]:
    """Rows as Python values, one at a time since one page may be long."""
    for row in zip(*columns):
        yield [value.as_py() for value in row]


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of each host of (host, html)."""

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = {(host.as_py(), written(wrapper_of(parse(page.as_py())))) for host, page in zip(*batch.columns)}
            yield pa.RecordBatch.from_pylist([{"host": h, "wrapper": w} for h, w in sorted(known)], schema)

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, some in zip(*batch.columns):
                wrapper: list[Part] = []
                for k, one in enumerate(some.as_py()):
                    wrapper = aligned(wrapper, json.loads(one)) if k else json.loads(one)
                rows.append({"host": host.as_py(), "wrapper": written(wrapper)})
            yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("host", pa.string()), ("wrapper", pa.string())])
    kinds_ = "host string, wrapper string"
    wrappers = stored(pages.select("host", "html").mapInArrow(single, kinds_).distinct(), "page-wrappers")
    while True:
        sizes = wrappers.groupBy(F.col("host").alias("of")).agg(F.count(F.lit(1)).alias("n"))
        most = sizes.agg(F.max("n").alias("most")).first().most
        if most is None or most <= 1:
            return wrappers
        # Dealt by content, so the outcome does not depend on how the pages are stored.
        deal = F.pmod(F.xxhash64("wrapper"), F.ceil(F.col("n") / TOGETHER))
        dealt = wrappers.join(sizes, F.col("host") == F.col("of")).groupBy("host", deal.alias("deal"))
        together = dealt.agg(F.sort_array(F.collect_set("wrapper")).alias("some")).select("host", "some")
        wrappers = stored(together.mapInArrow(combined, kinds_).distinct(), "wrappers")


def slot_counts(pages: DataFrame) -> DataFrame:
    """(host, slots) of (html, host, wrapper): for every slot that is met its pages, text and link text."""
    kinds_ = "host string, slot int, pages long, chars long, linked long, least long, most long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals: dict[tuple[str, int], list[int]] = {}
            for page, host, wrapper in one_by_one(batch.columns):
                met = set()
                for slot, _, text, shown in places_of(wrapper).texts(parse(page)):
                    if slot < 0:
                        continue
                    value = int.from_bytes(hashlib.blake2b(shown.encode(), digest_size=7).digest())
                    total = totals.setdefault((host, slot), [0, 0, 0, value, value])
                    total[0] += slot not in met
                    met.add(slot)
                    total[1] += len(shown.replace(" ", ""))
                    total[2] += text.linked
                    total[3], total[4] = min(total[3], value), max(total[4], value)
            names = ("pages", "chars", "linked", "least", "most")
            rows = [{"host": h, "slot": s, **dict(zip(names, total))} for (h, s), total in totals.items()]
            yield pa.RecordBatch.from_pylist(rows, schema)

    whole = pa.int64()
    schema = pa.schema([("host", pa.string()), ("slot", pa.int32()), *((n, whole) for n in ("pages", "chars", "linked", "least", "most"))])
    sums = [F.sum(name).alias(name) for name in ("pages", "chars", "linked")]
    counts = pages.select("html", "host", "wrapper").mapInArrow(counted, kinds_).groupBy("host", "slot")
    counts = counts.agg(*sums, (F.min("least") == F.max("most")).alias("same"))
    return counts.groupBy("host").agg(F.collect_list(F.struct("slot", "pages", "chars", "linked", "same")).alias("slots"))


def judged(wrappers: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, wrapper, main): the numbers of its blocks and slots that are main text."""

    def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            main = []
            for wrapper, slots in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                main.append(main_parts(places_of(wrapper), {slot["slot"]: slot for slot in slots or []}))
            arrays = [batch.column(0), batch.column(1), pa.array(main, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "wrapper", "main"])

    counts = counts.withColumnRenamed("host", "of")
    both = wrappers.join(counts, F.col("host") == F.col("of"), "left").select("host", "wrapper", "slots")
    return both.mapInArrow(decided, "host string, wrapper string, main array<int>")


def main_text(docs: DataFrame) -> DataFrame:
    """(page_id, url, text): the blocks of main text of every page, parted by an empty line."""
    pages = docs.select(F.col("page_id").cast("long"), F.col("url").cast("string"), text_or_empty("html").alias("html"))
    pages = pages.withColumn("host", hosts("url"))
    wrappers = infer_wrappers(pages).withColumnRenamed("host", "of")
    # Spark broadcasts the wrappers by their size, and otherwise splits a partition that one host fills.
    counts = slot_counts(pages.join(wrappers, F.col("host") == F.col("of")))
    table = stored(judged(wrappers.withColumnRenamed("of", "host"), counts), "judged").withColumnRenamed("host", "of")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, wrapper, main in one_by_one(batch.columns[2:]):
                keep = set(main)
                found = places_of(wrapper).texts(parse(page))
                # A text without a slot goes with the block around it.
                texts.append("\n\n".join(shown for slot, block, _, shown in found if (slot if slot >= 0 else block) in keep))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    joined = pages.join(table, F.col("host") == F.col("of")).select("page_id", "url", "html", "wrapper", "main")
    return joined.mapInArrow(extracted, "page_id long, url string, text string")
