"""Time mentions: values worked out by hand from the rules, and places found by a plain walk."""

import inspect
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lectern.functions import rules as R
from lectern.operators import mentions as M
from lectern.plans import mention_queries as Q


def of(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(M.mentions(df).collect(), key=lambda r: (r.doc_id, r.start, r.pattern))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("The sitting opens at 09:15:30 in the hall.", [(9, 18, 32400, "medium", "session_start"), (0, 21, 33330, "high", "session_start"), (2, 21, 33300, "high", "session_start")]),
        ("x 14.05.59 y", [(1, 2, 50759, "high", "speech_start"), (3, 2, 50700, "medium", "speech_start"), (3, 5, 21540, "medium", "speech_start")][:2]),
        ("ouverte 15h30", [(4, 8, 55800, "medium", "speech_start")]),
        ("until 12:05 am", [(2, 6, 43500, "medium", "speech_start"), (7, 6, 300, "medium", "speech_start")]),
        ("3:40 P.M.x", [(2, 0, 13200, "medium", "speech_start"), (8, 0, 56400, "medium", "speech_start")]),
        ("about 19 now", [(10, 0, 68400, "low", "speech_start")]),
        ("half past 12", [(11, 0, 43200, "low", "speech_start")]),
        ("recess at 14 hours and 30 minutes", [(9, 7, 52200, "low", "break_end")]),
        ("25.10 and 7:75", []),
        ("voting, 12:30", [(2, 8, 45000, "medium", "vote_end")]),
    ],
)
def test_mentions_by_hand(spark, text, want):
    assert [(r.pattern, r.start, r.seconds, r.confidence, r.event) for r in of(spark, text)] == want


def test_every_pattern_class_and_event_has_rows(spark):
    got = of(spark, *Q.PHRASES)
    assert {r.pattern for r in got} == set(range(len(R.MENTION_PATTERNS)))
    assert {r.confidence for r in got} == {"high", "medium", "low"} and len({r.event for r in got}) == 7


def test_places_equal_a_walk_and_awkward_texts(spark):
    texts = [None, "", "é😀 12:30 " * 50, "no digit", "at 5" + " " * 50_000 + "6", "12:30" * 3, *Q.PHRASES]
    got = [(r.doc_id, r.start, r.pattern, r.match, r.stop) for r in of(spark, *texts)]
    want = []
    for i, t in enumerate(texts):
        for k, (kind, _, p) in enumerate(R.MENTION_PATTERNS):
            for m in re.finditer(p, t or "", re.I):
                hour, minute = int(m[1]), int(m[2] or 0) if m.re.groups > 1 else 0
                if hour < 24 and minute < 60:
                    want.append((i, m.start(), k, m[0], m.end()))
    assert got == sorted(want)
    assert of(spark, *texts[:2]) == []


def test_repeats_and_association(spark):
    df = spark.createDataFrame([(1, "Mr Silva. 10:30 then 10:30 and 10:30:00" + " " * 300 + "10:30")], "doc_id long, text string")
    once = M.without_repeats(M.mentions(df))
    assert sorted((r.start, r.pattern) for r in once.collect()) == [(10, 2), (339, 2)]
    speeches = spark.createDataFrame([(1, 0, "Silva"), (1, 20, None), (1, 200, ""), (1, 600, "x"), (2, 0, "y"), (1, 300, "Nobody here at all then")], "doc_id long, speech_start long, speaker string")
    got = {(r.doc_id, r.speech_start): (r.mention_start, None if r.score is None else round(r.score, 6)) for r in M.associated(speeches, once).collect()}
    timing = 0.8
    assert got == {
        (1, 0): (10, round(0.95 * 0.4 + timing * 0.3 + 0.3, 6)),
        (1, 20): (10, round(0.95 * 0.4 + timing * 0.3 + 0.1, 6)),
        (1, 200): (339, round((1 - 139 / 200) * 0.4 + timing * 0.3 + 0.1, 6)),
        (1, 300): (339, round((1 - 39 / 200) * 0.4 + timing * 0.3 + 0.1, 6)),
        (1, 600): (None, None),
        (2, 0): (None, None),
    }


def test_equal_scores_go_to_the_earlier_mention(spark):
    told = spark.createDataFrame([(1, p, s, "low", "vote_end", "", "", 60) for p, s in ((3, 110), (2, 90), (5, 90))], "doc_id long, pattern int, start long, confidence string, event string, context_before string, context_after string, seconds int")
    speeches = spark.createDataFrame([(1, 100, "a")], "doc_id long, speech_start long, speaker string")
    out = M.associated(speeches, told.withColumn("confidence", F.lit("low"))).first()
    assert out.mention_start == 90


def test_matches_at_digits_are_all_matches():
    rng = random.Random(3)
    compiled = [re.compile(p, re.IGNORECASE) for _, _, p in R.MENTION_PATTERNS]
    parts = ["at", "AT", " ", "  ", "\n", "around", "About", "approximately", "approxımately", "quarter", "half ", "paſt", "PAST ", "mınuteſ", "minute ", "hours", "and", "5", "12", "23", "59", "07", "123", "٣", "１２", ":", ".", "h", "H", "am", "PM", "p.m.", "x", "é", "_", "😀", "\x1c", "past 5", "quarter past ", "at 9"]
    told = lambda found, t: sorted((a, k, m.end(), m[0], m.groups()) for a, k, m in found(t, compiled))
    for _ in range(20_000):
        t = "".join(rng.choice(parts) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 14)))
        assert told(M.at_digits, t) == told(M.everywhere, t), t
    t = "at" + " " * 3_000 + "6, half" + " " * 3_000 + "past" + " " * 200 + "7"
    assert told(M.at_digits, t) == told(M.everywhere, t) and len(told(M.at_digits, t)) == 2


def test_a_text_is_not_walked_once_for_each_pattern():
    """Texts with few digits cost about as much as finding these."""
    text = "the members about the vote at a past hour and then, 12:30, " + "words without any number " * 40_000

    def seconds(run):
        begin = time.process_time()
        run()
        return time.process_time() - begin

    compiled = [re.compile(p, re.IGNORECASE) for _, _, p in R.MENTION_PATTERNS]
    found = []
    slow = seconds(lambda: list(M.everywhere(text, compiled)))
    fast = seconds(lambda: found.extend(M.at_digits(text, compiled)))
    assert fast < slow / 5 and len(found) == 1 and "at_digits" in inspect.getsource(M.mentions)
