"""Values that the rules must give, typed as data and independent of the layers that compute them."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import transcript as T
from lectern.plans.layers import applied

SPEAKERS = [
    ("<strong>García Pérez, María (PPE)</strong>. − Thank you.", "García Pérez, María"),
    ("MÜLLER, Hans (S&D). − I agree completely.", "MÜLLER, Hans"),
    ("Vice-President Timmermans. − The Commission position is clear.", "Vice-President Timmermans"),
    ("The President. − We shall now proceed.", "The President"),
    ("President of the European Parliament. − Welcome.", "President of the European Parliament"),
    # by the order of the patterns a hyphen ends a name before a colon does
    ("LÓPEZ-ISTÚRIZ WHITE, Antonio (PPE): In Spain, we face challenges.", "LÓPEZ"),
]
PROCEDURAL = [
    "The sitting opened at 09:00", "Voting time", "(Applause from the PPE Group)", "Next item on the agenda", "Written statements (Rule 171)", "Point of order by Mr Smith",
    "Mr President, I believe we must address climate change urgently.", "The debate is closed", "Ladies and gentlemen, we shall proceed", "(Applause)", "The sitting was suspended at 12:30",
]
SPEECH = [
    "The Commission's proposal fails to address the concerns of our constituents.",
    "In my country, we have implemented successful policies in this area.", "I would like to thank the rapporteur for this excellent work.", "This directive will have significant impact on small businesses.",
]
HINTS = [("The sitting opened at 14:30", "14:30"), ("(The sitting suspended at 12.30)", "12:30"), ("No timestamp here", None)]


def over(spark, texts, layers, *columns, speaker="Test Speaker"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq long, text string").withColumns({"session_id": F.lit(1), "speaker": F.lit(speaker)})
    return [tuple(r)[1:] for r in sorted(applied(df, layers).select("seq", *columns).collect())]


def test_speakers(spark):
    got = over(spark, [t for t, _ in SPEAKERS], T.speaker_match, "who")
    assert [w.lower() in (g or "").lower() for (g,), (_, w) in zip(got, SPEAKERS)] == [True] * len(SPEAKERS), got


def test_procedural_lines(spark):
    got = over(spark, PROCEDURAL + SPEECH, lambda d: [*T.speaker_match(d), *T.procedural_line(d)], "procedural")
    assert [g for (g,) in got] == [True] * len(PROCEDURAL) + [False] * len(SPEECH)


def test_time_hints(spark):
    assert [g for (g,) in over(spark, [t for t, _ in HINTS], T.time_hint, "hint")] == [h for _, h in HINTS]


@pytest.mark.parametrize(
    ("speaker", "text", "kinds", "least"),
    [
        ("President", "The sitting is opened. We shall proceed with the agenda.", {"announcement"}, 0.625),
        ("President", "Voting time. The vote is taken on Amendment 1.", {"procedural", "announcement"}, 0.7),
        ("García Pérez, María (PPE)", "Mr President, I would like to address the critical issue of climate change policy. We need comprehensive action across all member states.", {"speech"}, 0.45),
    ],
)
def test_classes(spark, speaker, text, kinds, least):
    ((kind, sure),) = over(spark, [text], T.classified, "content_type", "class_confidence", speaker=speaker)
    assert kind in kinds and round(sure, 6) >= least


def test_speeches_are_speeches_or_unsure(spark):
    texts = ["Mr President, I believe we must act now", "In my opinion, this proposal is flawed", "We must ensure that our citizens are protected", *SPEECH[2:]]
    assert all(kind == "speech" or sure < 0.8 for kind, sure in over(spark, texts, T.classified, "content_type", "class_confidence"))
