"""Personal data: fixed kinds, and identifiers found by bootstrapped contextual extraction.

Base spans are e-mail and IP addresses, card and phone numbers, by fixed patterns. They are also seeds, as are the values
of a fixed list of keys: every candidate token (one that holds a digit, or a sign that prose lacks, and is as long as an
identifier) has lexical patterns, each a context with the token's own form: one and two words before it, the word
behind it, the words on both sides, its assignment key ("password="), and the sign right before it, if any ("=", "#").
A long token that mixes letters and digits has its form alone as one more; digits alone never do. Pattern and instance form a graph. Spark scores it in ROUNDS rounds: a pattern's confidence is
the smoothed mean belief of the distinct instances that it extracts, an instance's belief is that of its best pattern,
seeds having belief one. Known negatives, runs of digits as long as a card's that fail its check, have belief
zero for good, so they lower their patterns and are never told. Candidates of patterns with a
confidence of at least CONFIDENCE and SUPPORT distinct instances become spans of the kind "id", values of the fixed
list's keys without further proof.

Only candidates take part in the graph, few for each document, and it is joined and summed by hashes, so no table is
broadcast; hot patterns are summed before each shuffle.

Defined cases
    null or empty text: no spans; base_sha256 is that of the empty string.
    overlapping kinds: all base spans stay; a span found by context that overlaps a base span is dropped.
    values and tokens of any length are told whole; only their form is taken from the first LONGEST characters. Values
    of the fixed list's keys need no digit, values of other keys and free tokens do.
    very long texts and runs without breaks: each pattern starts from its sign or digit run, so time stays linear.
    null doc_id and repeated rows: each row is judged by itself; equal instances count once in the graph.
    ties: spans are ordered by start, then kind as listed. Empty table: empty result. Extra columns: ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import durable, table

KINDS = ("email", "ip", "card", "phone", "id")
ROUNDS, CONFIDENCE, SUPPORT, LONGEST = 3, 0.6, 3, 256
#: From so many characters on, a token of letters and digits in turn may be told by its form.
MIXED = 16

# The fixed patterns of the contract, from their signs on: a run that cannot match is tried once, not from each of its characters.
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Keys whose values are secrets: the lexical seeds.
KEYS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "ssn", "passport", "iban")
TOKEN = re.compile(r"[^\x20\x09-\x0D\"'<>()\[\]{};,|]+")
ASSIGNED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z_][A-Za-z0-9_-]{1,30})[\x20]?[=:][\x20]?[\"']?([^\x20\x09-\x0D\"',;<>]{4,})")
DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_NAME:
            start -= 1
        m = EMAIL_HOST.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        # characters before a sign that failed stay available only up to it: the class excludes the sign
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed kinds, by start, then kind."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def form(token: str) -> str:
    """The token's shape: runs of one class as one letter, with a rough length."""
    out = []
    for m in re.finditer(r"[0-9]+|[a-z]+|[A-Z]+|[^\x00-\x7f]+|.", token[:LONGEST], re.S):
        c = m[0][0]
        kind = "9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "u" if ord(c) > 127 else c
        out.append(kind)
    shape = "".join(out)
    mixed = re.sub(r"[aA9]{4,}", "x", shape)
    return f"{mixed}:{min(len(token), 64) // 8}"


def _hash(*parts: str) -> int:
    return xxhash.xxh64("\x1f".join(parts).encode("utf-8", "surrogatepass")).intdigest() - (1 << 63)


def negative(token: str) -> bool:
    """Whether a token is told by its own check to be no identifier: digits as many as a card's that fail Luhn."""
    digits = token.replace("-", "")
    return 12 <= len(digits) <= 19 and digits.isascii() and digits.isdigit() and not luhn(digits)


def contexts(text: str, start: int, end: int, key: str) -> list[tuple[str, ...]]:
    """The lexical patterns of a token: contexts of words on either side, each with the token's form."""
    shape = form(text[start:end])
    left, right = text[max(0, start - LONGEST) : start].lower().split()[-2:], text[end : end + LONGEST].lower().split()[:1]
    before, behind = left[-1] if left else "", right[0] if right else ""
    out = [("left", before, shape), ("right", behind, shape), ("both", before, behind, shape)]
    if len(left) > 1:
        out.append(("two", *left, shape))
    if key:
        out.append(("key", key.lower(), shape.partition(":")[2]))
    if start and not text[start - 1].isspace() and not text[start - 1].isalnum():
        out.append(("sign", text[start - 1], shape))
    if "x" in shape and end - start >= MIXED:
        out.append(("shape", shape))
    return out


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int, list[int], float]]:
    """(start, end, instance, patterns, belief) of every token that may be an identifier; base spans have belief one,
    known negatives minus one."""
    out = []

    def add(start: int, end: int, key: str, belief: float) -> None:
        token = text[start:end]
        out.append((start, end, _hash("i", token), [_hash(*c) for c in contexts(text, start, end, key)], -1.0 if belief < 1.0 and negative(token) else belief))

    taken = [(a, b) for _, a, b in spans]
    for a, b in list(taken):
        add(a, b, "", 1.0)

    def clear(a: int, b: int) -> bool:
        k = bisect_left(taken, (a, b))
        return (k == 0 or taken[k - 1][1] <= a) and (k == len(taken) or taken[k][0] >= b)

    for m in ASSIGNED.finditer(text) if "=" in text or ":" in text else ():
        a, b = m.span(2)
        known = m[1].lower() in KEYS
        if (known or DIGIT.search(m[2])) and clear(a, b):
            add(a, b, m[1], 1.0 if known else 0.0)
            insort(taken, (a, b))
    if DIGIT.search(text):
        for m in TOKEN.finditer(text):
            a, b = m.span()
            token = m[0].rstrip(".:!?")
            b = a + len(token)
            digits = len(DIGIT.findall(token))
            if len(token) >= 6 and (digits >= 3 or digits and len(token) >= 12) and clear(a, b):
                add(a, b, "", 0.0)
    return out


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, rid long, found array<struct<s:long,e:long,i:long,p:array<long>,b:double>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("i", pa.int64()), ("p", pa.list_(pa.int64())), ("b", pa.float64())]))
    for batch in batches:
        counts, base, found = {k: [] for k in KINDS[:4]}, [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            spans = base_spans(text)
            for k in counts:
                counts[k].append(sum(s[0] == k for s in spans))
            base.append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
            found.append([{"s": s, "e": e, "i": i, "p": p, "b": b} for s, e, i, p, b in candidates(text, spans)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS[:4]), pa.array(base), batch.column("rid"), pa.array(found, kind)],
            ["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base", "rid", "found"],
        )


def confident(found: DataFrame) -> DataFrame:
    """p, belief of the patterns to extract by; found: i, p, b of every candidate and pattern."""
    edges = durable(found.groupBy("i", "p").agg(F.max("b").alias("b")))
    seeds = edges.groupBy("i").agg(F.max("b").alias("seed"))
    held = F.greatest("seed", F.lit(0.0))
    belief = seeds.select("i", held.alias("belief"))
    score = None
    for _ in range(ROUNDS):
        told = edges.select("i", "p").join(belief.select("i", "belief"), "i")
        score = durable(told.groupBy("p").agg((F.sum("belief") / (F.count("*") + 1.0)).alias("score"), F.count("*").alias("n")))
        best = edges.select("i", "p").join(score.where(F.col("n") >= SUPPORT).select("p", "score"), "p").groupBy("i").agg(F.max("score").alias("best"))
        belief = durable(seeds.join(best, "i", "left").select("i", F.when(F.col("seed") < 0, 0.0).otherwise(F.greatest("seed", F.coalesce("best", F.lit(0.0)))).alias("belief")))
    return score.where((F.col("score") >= CONFIDENCE) & (F.col("n") >= SUPPORT)).select("p", "score")


def _told(base: str, more: list[tuple[int, int]]) -> str:
    spans = [(s.split(":")[0], *map(int, s.split(":")[1:])) for s in base.split(",") if s]
    spans += [("id", a, b) for a, b in more]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base = batch.column("base").to_pylist()
        more = [sorted({(x["s"], x["e"]) for x in m or []}) for m in batch.column("more").to_pylist()]
        digest = [hashlib.sha256(b.encode()).hexdigest() for b in base]
        spans = [_told(b, m) if m else b for b, m in zip(base, more)]
        names = ["doc_id", *(f"n_{k}" for k in KINDS[:4])]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(digest), pa.array(spans), pa.array([len(m) for m in more], pa.int64()), pa.array([x.count(",") + 1 if x else 0 for x in spans], pa.int64())],
            [*names, "base_sha256", "spans", "n_id", "n_spans"],
        )


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts, base_sha256, spans, n_id (spans found by context) and n_spans (all spans) of every row."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid"))
    seen = durable(rows.mapInArrow(_scan, SCHEMA))
    flat = seen.where(F.size("found") > 0).select("rid", F.explode("found").alias("x")).select("rid", "x.s", "x.e", "x.i", "x.b", F.explode("x.p").alias("p"))
    flat = durable(flat)
    good = confident(flat.select("i", "p", "b"))
    # spans of base kinds are told already; keys of the fixed list are told without further proof
    marked = flat.join(good.select("p", F.lit(True).alias("good")), "p", "left").groupBy("rid", "s", "e").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max("b").alias("b"))
    spans = marked.where((F.col("good") & (F.col("b") >= 0)) | (F.col("b") >= 1.0)).groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("more"))
    told = seen.drop("found").join(spans, "rid", "left")
    # a base span is a candidate with belief one as well: drop what equals or overlaps one
    return told.mapInArrow(_finish_without_base, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_id long, n_spans long")


def _finish_without_base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def cleared():
        for batch in batches:
            out = []
            for base, more in zip(batch.column("base").to_pylist(), batch.column("more").to_pylist()):
                taken = [tuple(map(int, s.split(":")[1:])) for s in base.split(",") if s] if more else []
                starts, reach = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
                # of the base spans that start before a span's end, none may reach beyond its start
                clear = lambda x: (k := bisect_left(starts, x["e"])) == 0 or reach[k - 1] <= x["s"]
                out.append([x for x in more or [] if clear(x)])
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            i = batch.schema.get_field_index("more")
            yield batch.set_column(i, "more", pa.array(out, kind))

    yield from _finish(cleared())


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
