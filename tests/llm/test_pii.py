"""Base spans against plain patterns, and what contexts add."""

import hashlib
import random
import re
import time

import pytest

from heatgrid.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = [int(c) for c in re.findall("[0-9]", text)]
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        check = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and check % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def plain_spans(text):
    return {(*m.span(), kind) for kind, p in PLAIN.items() for m in re.finditer(p, text) if valid(kind, m[0])}


@pytest.mark.parametrize("seed", range(40))
def test_base_spans(seed):
    rng = random.Random(seed)
    pieces = ["1", "25", "255", "999", ".", ".", "@", "a", "b-c", "+", "+1 ", "(0)", " ", "-", "é", "4111111111111111", "x.y", "\n"]
    text = "".join(rng.choice(pieces) for _ in range(60))
    assert set(pii.base_spans(text)) == plain_spans(text)
    assert len(pii.base_spans(text)) == len(plain_spans(text))


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 150_000, "@a" * 150_000, "1 " * 150_000, "a1_" * 100_000])
def test_time_is_in_proportion_to_the_text(text):
    start = time.process_time()
    pii.occurrences(text, pii.base_spans(text), {})
    assert time.process_time() - start < 5


def digest(spans):
    order = list(pii.KINDS)
    written = ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], order.index(x[2]))))
    return hashlib.sha256(written.encode()).hexdigest()


def test_odd_rows_and_none(odd, odd_rows, table, empty):
    found = pii.digests(pii.find_personal_data(odd), [*pii.KINDS, *pii.SEEDS]).collect()
    expected = sorted(((i, digest(plain_spans(t or ""))) for i, t, _ in odd_rows), key=repr)
    assert sorted(((r.doc_id, r.base_sha256) for r in found), key=repr) == expected
    assert pii.find_personal_data(empty).count() == 0


def test_contexts_find_unseen_identifiers_and_leave_others_alone(table):
    """Cards stand behind two words; numbers there that fail the check are found, others are not."""

    def card(n):
        for last in range(10):
            if valid("card", number := f"4{n:014d}{last}"):
                return number

    rows = [(i, f"lines of prose, card no {card(i * 7919)} and more", "a") for i in range(30)]
    rows += [(100, "charged to card no 4000000000000001 again", "a"), (101, "in the year 4000000000000001 or so", "a")]
    rows += [(102, "the order no 777000111 was late", "a")] * 20
    rows += [(103, "see room 123456 and table 98765432", "b")]
    found = {r.doc_id: r for r in pii.find_personal_data(table(rows)).collect()}
    assert all(len(found[i].base) == 1 and not found[i].added for i in range(30))
    # The same number in another context lowers the trust in it to a half.
    assert not found[100].added and not found[101].added
    rows = [r for r in rows if r[0] != 101]
    found = {r.doc_id: r for r in pii.find_personal_data(table(rows)).collect()}
    start = rows[30][1].index("4000")
    assert [tuple(s) for s in found[100].added] == [(start, "card", start + 16)]
    assert not found[102].added and not found[103].added


def test_seeds_beyond_the_base_kinds(table):
    rows = [(i, f'my token = "{i:040x}" set' if i else 'my token = "ab12cd34ef" set', "a") for i in range(0, 4000, 97)]
    found = {r.doc_id: [tuple(s) for s in r.added] for r in pii.find_personal_data(table(rows)).collect()}
    assert found[0] == [(12, "secret", 22)]
    # Hexadecimal strings of digits only are no seeds, but stand in the same context.
    assert all(found[i] in ([(12, "secret", 52)], []) for i in found if i)


PLANTED = [
    ("email", "please write to {}, thanks", [f"user{i}@mail.org" for i in range(12)], ["jane (at) mail.org", "joe [at] mail [dot] org", "ann.lee"]),
    ("ip", "came from host {} at night", [f"10.0.{i}.7" for i in range(12)], ["2001:db8::8a2e:370:7334", "db1.example.org", "10.0.300.7"]),
    ("card", "charged the card {} today", None, ["1234 5678 9012 345", "4000-0000-0000-0001"]),
    ("phone", "please call me {} today", [f"+1 (415) 555-{i:04d}" for i in range(12)], ["555-123-4567", "123-45-6789", "(555) 123-4567"]),
    ("secret", 'set my token = "{}" now', [f"{i:039x}a1" for i in range(12)], ["abcDEFghijkl", "k7" * 100, "ab12-cd34.ef56"]),
]


@pytest.mark.parametrize(("kind", "text", "seeds", "unseen"), PLANTED, ids=[case[0] for case in PLANTED])
def test_every_kind_finds_forms_its_pattern_does_not_know(table, kind, text, seeds, unseen):
    seeds = seeds or [n for i in range(200) if valid("card", n := f"4{i:015d}")]
    rows = [(i, text.format(value), "a") for i, value in enumerate(seeds)]
    rows += [(1000 + i, text.format(value), "a") for i, value in enumerate(unseen)]
    rows += [(2000 + i, f"an ordinary thing {value} elsewhere", "a") for i, value in enumerate(["777-000-1111", "a.b.c", "x1y2z3"])]
    found = {r.doc_id: [tuple(s) for s in r.added] for r in pii.find_personal_data(table(rows)).collect()}
    start = text.index("{")
    for i, value in enumerate(unseen):
        assert found[1000 + i] == [(start, kind, start + len(value))], value
    assert not any(found[2000 + i] for i in range(3))


def test_rounds_reach_contexts_that_hold_no_seed(table):
    """Numbers in two trusted contexts make a third one trusted, which brings in numbers seen nowhere else."""
    cards = [n for i in range(700) if valid("card", n := f"4{i:015d}")]
    unknown = [n for i in range(900, 960) if not valid("card", n := f"4{i:015d}")][:8]
    texts = [f"charged the card {n} today" for n in cards] + [f"paid with visa {n} today" for n in cards]
    texts += [t for n in unknown[:6] for t in (f"charged the card {n} today", f"paid with visa {n} today", f"saved on file {n} today")]
    texts += [f"saved on file {unknown[6]} today"]
    rows = [(i, text, "a") for i, text in enumerate(texts)]

    def added(rounds):
        got = pii.find_personal_data(table(rows), rounds=rounds).collect()
        return {texts[r.doc_id]: [tuple(s)[1] for s in r.added] for r in got if r.added}

    last = f"saved on file {unknown[6]} today"
    assert last not in added(1) and added(3)[last] == ["card"]
    assert all(added(3)[f"saved on file {n} today"] == ["card"] for n in unknown[:6])


def test_one_word_tells_where_two_are_rare(table):
    """Every pair of words occurs once; the last word tells, for numbers of the same form only."""
    cards = [n for i in range(400) if valid("card", n := f"4{i:015d}")][:30]
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [(i, f"the {words[i]} card {n} today", "a") for i, n in enumerate(cards)]
    bad = next(n for i in range(900, 960) if not valid("card", n := f"4{i:015d}"))
    rows += [(100, f"the {words[40]} card {bad} today", "a"), (101, f"the {words[41]} card 7770001 today", "a")]
    found = {r.doc_id: [tuple(s)[1] for s in r.added] for r in pii.find_personal_data(table(rows)).collect()}
    assert found[100] == ["card"] and not found[101]
