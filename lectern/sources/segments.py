"""The transcript view of the conversations table: one speech segment per turn.

The test tables hold no debate vocabulary, so a fixed phrase and speaker, chosen by position, are laid over each
turn; every rule then has rows that meet it and rows that nearly do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.dialect import DUCK, SPARK, Spark

SPEAKERS = ["President", "Vice-President Kovar", "Anna Berg", "Commissioner Olsen", "J. Meyer", "Lena Ruiz", "The rapporteur", "M"]
PHRASES = [
    "The sitting is opened at 9:00.", "Voting time", "Next item on the agenda is the debate on the report by Mr Lund.", "I believe we must act, and this is why.",
    "(Applause and laughter)", "Written statements", "Anna Berg (GRN). - Thank you, I would like to speak at 14.30 hrs.", "The vote is taken now and adopted by a majority.",
    "Lena Ruiz: let me say what the regulation, the directive and the budget proposal mean.", "Is it so? Why? When?", "The sitting was suspended for a break of ten minutes.",
    "Ladies and gentlemen, honourable members", "Point of order under rule 12 of the procedure", "plain words only here", "(The sitting closed at 23h15)", "<b>Olsen</b>: a <i>short</i> <u>note</u>",
    "President. - That concludes the item.", "Order of business and discussion on the agenda", "Session begins. Good morning, dear colleagues.", "",
]


def _columns(d: Spark) -> dict[str, str]:
    phrase = d.item(PHRASES, f"(conv_id * 3 + turn) % {len(PHRASES)}")
    return {
        "session_id": "conv_id",
        "seq": "cast(turn + 1 as bigint)",
        "speaker": d.item(SPEAKERS, f"(conv_id * 5 + turn) % {len(SPEAKERS)}"),
        "text": f"CASE WHEN (conv_id + turn) % 3 = 0 THEN {phrase} ELSE concat({phrase}, ' ', coalesce(text, '')) END",
    }


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("conv_id is not null and turn is not null")
    return df.select(*[F.expr(e).alias(c) for c, e in _columns(SPARK).items()])


SEGMENTS_SQL = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _columns(DUCK).items()) + " FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL"
