"""Operators that no plain window expresses: the breaker's state machine, fuzzy names, marks near positions."""

from __future__ import annotations

import functools
import itertools
import math
import unicodedata
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lectern.sources.stores import kept

CLOSED, OPEN, HALF = "closed", "open", "half_open"
#: Characters of a key that tell names apart, keys of a member for one cut, and characters of a name that is cut into keys at most.
KEY, MOST_KEYS, LONGEST = 5, 400, 40


class Breaker:
    """Opens after so many failures, tries again after a while, closes after so many successes."""

    def __init__(self, failures: int = 5, wait: float = 60.0, successes: int = 3, close_at_once: bool = False):
        self.failures, self.wait, self.needed, self.close_at_once = failures, wait, successes, close_at_once
        self.state, self.count, self.good, self.since = CLOSED, 0, 0, 0.0

    def step(self, at: float, ok: bool) -> tuple[bool, str]:
        """Whether the call was let through, and the state after it."""
        if self.state == OPEN:
            if at - self.since < self.wait:
                return False, self.state
            self.state, self.good = HALF, 0
        if ok:
            if self.state == HALF:
                self.good += 1
                if self.close_at_once or self.good >= self.needed:
                    self.state, self.count, self.good = CLOSED, 0, 0
            else:
                self.count = max(0, self.count - 1)
        else:
            self.count += 1
            if self.state == HALF or self.count >= self.failures:
                self.state, self.since = OPEN, at
        return True, self.state


def breaker_states(events: DataFrame, key: str, at: str, order: str, ok: str, **limits) -> DataFrame:
    """key, order, allowed, state: the breaker of each key over its events in order of time.

    The rows of a key stream through in sorted order, so a key with most of the events needs no more memory."""
    rows = events.select(key, F.col(at).cast("timestamp").cast("double").alias("at"), order, F.col(ok).alias("ok"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, breaker = None, Breaker(**limits)
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                if r[0] != now:
                    now, breaker = r[0], Breaker(**limits)
                out.append((r[0], r[2], *breaker.step(r[1], bool(r[3]))))
            yield pd.DataFrame(out, columns=[key, order, "allowed", "state"])

    dealt = rows.repartition(F.col(key)).sortWithinPartitions(key, "at", order)
    return dealt.mapInPandas(run, f"{key} long, {order} long, allowed boolean, state string")


def plain_name(name: str | None) -> str:
    """Without titles, brackets and marks other than ' and -."""
    import re

    name = re.sub(r"\b(Mr|Mrs|Ms|Miss|Dr|Prof|President|Vice-President|Commissioner|Minister)\b\.?\s*", "", name or "", flags=re.I)
    name = unicodedata.normalize("NFKD", re.sub(r"\([^)]*\)", "", name))
    return " ".join(re.sub(r"[^\w\s'-]", " ", name).split())


def normalized_names(df: DataFrame, column: str) -> DataFrame:
    @F.pandas_udf("string")
    def plain(s: pd.Series) -> pd.Series:
        return s.map(plain_name)

    return df.withColumn("plain_name", plain(column))


def similarity(a: str, b: str) -> float:
    """The better of the plain and the word-sorted ratio, 0 to 100."""
    words = lambda s: " ".join(sorted(s.split()))
    return 100 * max(SequenceMatcher(None, a, b).ratio(), SequenceMatcher(None, words(a), words(b)).ratio())


def _letters(name: Column) -> Column:
    """The characters of a name, the second of a kind apart from the first, so that common ones can be counted as a set."""
    chars = F.array_sort(F.split(name, "(?!^)"))
    return F.transform(chars, lambda c, i: F.concat(c, (i + 1 - F.array_position(chars, c)).cast("string")))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, which no ratio's matched characters exceed; a column of bits a character."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = rows = (1 << len(a)) - 1
    for c in b:
        hit = rows & where.get(c, 0)
        rows = (rows + hit | rows - hit) & full
    return len(a) - rows.bit_count()


def _forms(name: str) -> list[str]:
    """The forms whose ratio counts: plain and word-sorted, in small letters."""
    low = name.lower()
    return [low, " ".join(sorted(low.split()))]


def _needed(both: int, least: float) -> int:
    """Matched characters that two names of together `both` characters need."""
    return math.ceil(least * both / 2 - 1e-9)


@functools.cache
def _cut(own: int, other: int, least: float) -> tuple[int, int, int, int] | None:
    """How a member of `other` characters is cut for names of `own`: pieces, losses a piece may have, and how many characters
    each side leaves unmatched, own first; None if no such pair is close.

    Pieces of n characters with c losses give keys of n - c or more. Of the cuts with a bounded number of keys the one is taken
    whose keys come nearest to KEY characters, then the one of fewest; members are many, so theirs count more."""
    need = _needed(own + other, least)
    if need > min(own, other):
        return None
    a, b = own - need, other - need
    best = None
    for p in range(1, max(1, min(other, a + b + 1)) + 1):
        c, n = (a + b) // p, other // p
        lost = min(b, c)
        if p == 1:
            theirs, ours = math.comb(other, b), math.comb(own, a)
        else:
            theirs = p * sum(math.comb(n + 1, x) for x in range(lost + 1))
            stretches = sum(math.comb(n + 1 - x + y, y) for x in range(lost + 1) for y in range(min(a, c - x) + 1))
            ours = (2 + (p - 2) * (a + b + 1)) * stretches
        cost = theirs + ours / 8
        rank = (0, max(0, KEY - n + lost), cost) if theirs <= MOST_KEYS and ours <= 10 * MOST_KEYS else (1, cost, 0)
        best = min(best or (rank, p, c), (rank, p, c))
    return best[1], best[2], a, b


def _without(s: str, n: int) -> set[str]:
    """s without any n of its characters."""
    return {"".join(x) for x in itertools.combinations(s, len(s) - n)} if n else {s}


def _key(p: int, i: int, other: int, s: str) -> int:
    """Piece i of p of a member of `other` characters and what is left of it, as one number; equal ones are only candidates."""
    return (other * 64 + p) * 64 + i << 32 | zlib.crc32(s.encode("utf-8", "surrogatepass"))


def member_keys(form: str, lengths: list[int], least: float) -> set[int]:
    """Keys of a member for names of the lengths given: its pieces without as many characters as they may lose."""
    n, most = len(form), {}
    for own in lengths:
        if cut := _cut(own, n, least):
            p, c, _, b = cut
            most.setdefault(p, set()).update([b] if p == 1 else range(min(b, c) + 1))
    return {_key(p, i, n, s) for p, lost in most.items() for i in range(p) for x in lost for s in _without(form[i * n // p : (i + 1) * n // p], x) if x <= (i + 1) * n // p - i * n // p}


def name_keys(form: str, lengths: list[int], least: float) -> set[int]:
    """Keys of a name for members of the lengths given: the stretches that may lie under a piece, without what is too much.

    Stretches under the pieces tile the name: the first begins it, the last ends it, others are off by what is lost before."""
    own, out = len(form), set()
    for n in lengths:
        if not (cut := _cut(own, n, least)):
            continue
        p, c, a, b = cut
        if p == 1:
            out.update(_key(1, 0, n, s) for s in _without(form, a))
            continue
        for i in range(p):
            start, size = i * n // p, (i + 1) * n // p - i * n // p
            for x in range(min(b, c, size) + 1):
                for y in range(min(a, c - x) + 1):
                    long = size - x + y
                    starts = [0] if i == 0 else [own - long] if i == p - 1 else range(max(0, start - (b - x)), min(own - long, start + a - y) + 1)
                    out.update(_key(p, i, n, s) for at in starts if 0 <= at <= own - long for s in _without(form[at : at + long], y))
    return out


def _by_letters(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """nid, mid: pairs that may have `least` of their letters in common. Each side's rarest letters, as many as could all be
    missing plus one, must meet (a prefix filter). For names too long to be cut into keys."""
    lettered = lambda df, i, c: df.select(F.col(i), _letters(F.lower(F.col(c))).alias("__letters"))
    a, b = lettered(a, "nid", "name"), lettered(b, "mid", "member")
    counts = a.select(F.explode("__letters").alias("__l")).unionByName(b.select(F.explode("__letters").alias("__l"))).groupBy("__l").agg(F.count("*").alias("__n"))
    needed = lambda n: F.ceil(n * F.lit(least / (2 - least)) - 1e-9)

    def rare(df: DataFrame, c: str) -> DataFrame:
        size = F.size("__letters")
        told = df.select(c, (size - needed(size) + 1).alias("__most"), F.explode("__letters").alias("__l")).join(counts, "__l")
        order = W.partitionBy(c).orderBy("__n", "__l")
        return told.withColumn("__k", F.row_number().over(order)).where(F.col("__k") <= F.col("__most")).select(c, "__l")

    return rare(a, "nid").join(rare(b, "mid"), "__l").select("nid", "mid")


def similar_candidates(names: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """name, member: every pair whose ratio may be over `least` (0 to 1), and few others.

    A ratio is twice the matched characters over both lengths, and these are a common subsequence, so a pair over `least`
    leaves few characters unmatched. A member is cut into pieces; of the unmatched characters of both sides one piece has at
    most its share. So the piece without what it loses equals what lies under it in the name without what is too much there:
    pairs meet on these keys, a bounded number for each name, and are then held to their longest common subsequence. Names of
    over LONGEST characters meet by their rarest letters. None is lost."""

    def side(df: DataFrame, i: str, c: str) -> DataFrame:
        size = F.udf(lambda s: [len(f) for f in _forms(s)], "array<int>")
        some = df.select(F.col(c)).distinct().where(F.length(c) > 0)
        return kept(some.select(F.monotonically_increasing_id().alias(i), c, size(c).alias("__sizes")), "names")

    def keyed(df: DataFrame, i: str, c: str, keys, lengths: list[int]) -> DataFrame:
        @F.pandas_udf("array<long>")
        def told(s: pd.Series) -> pd.Series:
            return s.map(lambda n: list(set().union(*(keys(f, lengths, least) for f in set(_forms(n))))))

        return df.where(short).select(i, F.explode(told(c)).alias("__key"))

    a, b = side(names, "nid", "name"), side(members, "mid", "member")
    short = F.array_max("__sizes") <= LONGEST
    lengths = lambda df: sorted(r[0] for r in df.where(short).select(F.explode("__sizes")).distinct().collect())
    met = keyed(a, "nid", "name", name_keys, lengths(b)).join(keyed(b, "mid", "member", member_keys, lengths(a)), "__key").select("nid", "mid")
    # Nothing close to a long name is shorter than this.
    near = F.array_max("__sizes") >= math.floor(LONGEST * least / (2 - least))
    if not a.where(~short).isEmpty():
        met = met.unionByName(_by_letters(a.where(~short), b.where(near), least))
    if not b.where(~short).isEmpty():
        met = met.unionByName(_by_letters(a.where(near & short), b.where(~short), least))

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([any(_common(f, g) >= _needed(len(f) + len(g), least) for f, g in zip(_forms(n), _forms(m))) for n, m in zip(x, y)], dtype=bool)

    pairs = met.distinct().join(a.select("nid", "name"), "nid").join(b.select("mid", "member"), "mid")
    return kept(pairs.where(close("name", "member")).select("name", "member"), "pairs")


def resolved_names(names: DataFrame, members: DataFrame, least: float = 75.0, accept: float = 0.8) -> DataFrame:
    """name, member, confidence, method: exact match, else the most similar member if its rounded score is over `least`
    and as a confidence over `accept`, else none with 0.0.

    White space is collapsed and case ignored; names and members are made distinct first, null and empty ones of no avail."""
    plain = lambda df, c: df.select(F.trim(F.regexp_replace(c, r"\s+", " ")).alias(c)).distinct()
    distinct, known = plain(names, "name"), plain(members, "member")
    exact = distinct.join(known, F.lower("name") == F.lower("member")).groupBy("name").agg(F.min("member").alias("__exact"))
    told = kept(distinct.join(exact, "name", "left"), "names")
    rest = told.where("__exact IS NULL").select("name")
    # A score is a whole number: the first that passes both gates, less the half point of rounding.
    first = next((k for k in range(101) if k > least and k / 100 > accept), 101)
    met = similar_candidates(rest, known, (first - 0.5) / 100)

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([float(round(similarity(x.lower(), y.lower()))) for x, y in zip(a, b)], dtype=float)

    scored = met.withColumn("score", ratio("name", "member")).where((F.col("score") > least) & (F.col("score") / 100 > accept))
    best = scored.groupBy("name").agg(F.max("score").alias("__score"), F.min_by("member", F.struct(-F.col("score"), "member")).alias("__close"))
    out = told.join(best, "name", "left")
    method = F.when(F.col("__exact").isNotNull(), "exact").when(F.col("__close").isNotNull(), "fuzzy").otherwise("none")
    sure = F.when(F.col("__exact").isNotNull(), 1.0).otherwise(F.coalesce(F.col("__score") / 100, F.lit(0.0)))
    return out.select("name", F.coalesce("__exact", "__close").alias("member"), sure.alias("confidence"), method.alias("method"))


def near_marks(marks: DataFrame, spots: DataFrame, reach: int = 200) -> DataFrame:
    """Each spot (key, spot) with its best mark (key, pos, weight) within reach: a band join on buckets of that width,
    so a row meets three buckets and never the whole key."""
    b = marks.withColumn("bucket", F.floor(F.col("pos") / reach))
    s = spots.withColumn("bucket", F.explode(F.array(*[F.floor(F.col("spot") / reach) + k for k in (-1, 0, 1)])))
    met = s.join(b, ["key", "bucket"]).where(F.abs(F.col("pos") - F.col("spot")) <= reach)
    score = 0.4 * (1 - F.abs(F.col("pos") - F.col("spot")) / reach) + 0.3 * F.col("weight")
    best = W.partitionBy("key", "spot").orderBy(F.desc("score"), "pos")
    return met.withColumn("score", score).withColumn("k", F.row_number().over(best)).where("k = 1").select("key", "spot", "pos", "score")
