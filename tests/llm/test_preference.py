"""Preference pairs against a plain rendering."""

from heatgrid.llm import preference

TURNS = "pair_id long, side string, turn long, role string, text string, prompt int, chosen int"


def plain(turns):
    """(prompt, chosen, rejected, spans of both) of one pair, turns being sorted (role, text) per side."""
    chosen, rejected = turns["chosen"], turns["rejected"]
    common = 0
    while common < min(len(chosen), len(rejected)) and chosen[common] == rejected[common]:
        common += 1

    def show(part):
        text, spans = "", []
        for role, said in part:
            text += f"<|{role}|>\n"
            start = len(text)
            text += said + "<|end|>\n"
            if role == "assistant":
                spans.append(f"{start}:{len(text)}")
        return text, ",".join(spans)

    (prompt, _), (a, a_spans), (b, b_spans) = show(chosen[:common]), show(chosen[common:]), show(rejected[common:])
    return common, prompt, a, b, a_spans, b_spans


CASES = {
    1: {"chosen": [("user", "hi"), ("assistant", "good\nday")], "rejected": [("user", "hi"), ("assistant", "go away")]},
    2: {"chosen": [("system", "s"), ("user", "u")], "rejected": [("system", "s"), ("user", "u")]},  # alike throughout
    3: {"chosen": [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "ü")], "rejected": [("user", "a")]},
    4: {"chosen": [("user", "x"), ("assistant", "")], "rejected": []},
    5: {"chosen": [("assistant", "1"), ("assistant", "2")], "rejected": [("user", "1"), ("assistant", "2")]},
    6: {"chosen": [("user", "w " * 50_000), ("assistant", "long")], "rejected": [("user", "w " * 50_000), ("assistant", "lang")]},
}


def test_pairs(spark):
    rows = [
        (pair, side, turn, role, text, 1, 2)
        for pair, sides in CASES.items() for side, turns in sides.items() for turn, (role, text) in enumerate(turns)
    ]
    got = {r.pair_id: tuple(r)[1:] for r in preference.preference_examples(spark.createDataFrame(rows, TURNS)).collect()}
    assert got == {pair: plain(sides) for pair, sides in CASES.items()}
    for _, _, chosen, _, spans, _ in got.values():
        for span in filter(None, spans.split(",")):
            start, end = map(int, span.split(":"))
            assert chosen[start - 13 : start] == "<|assistant|>"[-12:] + "\n" and chosen[:end].endswith("<|end|>\n")


def test_nulls_and_repeats(spark):
    rows = [
        (None, "chosen", None, None, None, 1, 2), (None, "rejected", None, "user", "", 1, 2),
        (1, "chosen", 0, "user", "a", 1, 2), (1, "chosen", 0, "user", "a", 1, 2), (1, "rejected", 0, "user", "a", 1, 2),
        (2, None, 0, "user", "neither side", 1, 2),
    ]
    got = {r.pair_id: r for r in preference.preference_examples(spark.createDataFrame(rows, TURNS)).collect()}
    assert got[None].n_common == 1 and got[None].prompt == "<|user|>\n<|end|>\n"
    assert got[1].n_common == 1 and got[1].chosen == "<|user|>\na<|end|>\n" and got[1].rejected == ""
    assert (got[2].prompt, got[2].chosen, got[2].rejected) == ("", "", "")
    assert preference.preference_examples(spark.createDataFrame([], TURNS)).count() == 0


CONVERSATIONS = [
    # Gaps between ids; ranks 0 to 4.
    (10, [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")]),
    (17, [("user", "e"), ("assistant", "f"), ("user", "g"), ("assistant", "h")]),
    (400, [("system", "s"), ("user", "i"), ("assistant", "j"), ("user", "k"), ("assistant", "l"), ("user", "m")]),
    (401, [("user", "without an answer")]),
    (9000, [("user", "n"), ("assistant", "o")]),
]


def branches(spark, conversations):
    rows = [(i, n, role, text, 1, True) for i, turns in conversations for n, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rank int, cut boolean")
    out = {}
    for r in preference.branched(df).orderBy("turn").collect():
        out.setdefault((r.pair_id, r.side), []).append((r.role, r.text))
    return out


def test_branches_go_on_as_the_next_conversation_there_is(spark):
    got = branches(spark, CONVERSATIONS)
    own = dict(CONVERSATIONS)
    assert {i: got[i, "chosen"] for i in own} == own
    assert got[10, "rejected"] == own[10][:3] + own[17][3:]  # even rank: last answer
    assert got[17, "rejected"] == own[17][:1] + own[400][2:]  # odd rank: first answer, and on
    for alone in (400, 401, 9000):  # the next has no answer, none of its own, no next one
        assert got[alone, "rejected"] == own[alone]


def test_no_conversations_and_one_without_id(spark):
    assert branches(spark, []) == {}
    got = branches(spark, [(None, [("user", None), ("assistant", "x")]), (1, [("assistant", "y")])])
    assert got[None, "rejected"] == got[None, "chosen"] and got[1, "rejected"] == [("assistant", "y")]
