"""Rules are data; an expression over them is written once for each SQL dialect.

``SPARK`` writes what Spark evaluates, inside whole-stage code generation; ``DUCK`` writes the same rule for an
independent check in DuckDB. Only leaves differ: how to match, count, cut and split.
"""

from __future__ import annotations


class Spark:
    name = "spark"

    def lit(self, s: str) -> str:
        return "r'" + s + "'" if "'" not in s else 'r"' + s.replace('"', "\\x22") + '"'

    def rlike(self, x: str, p: str) -> str:
        return f"({x} rlike {self.lit(p)})"

    def ext(self, x: str, p: str, g: int = 0) -> str:
        return f"regexp_extract({x}, {self.lit(p)}, {g})"

    def rep(self, x: str, p: str, r: str = "") -> str:
        return f"regexp_replace({x}, {self.lit(p)}, {self.lit(r)})"

    def count(self, x: str, p: str) -> str:
        return f"cast(regexp_count({x}, {self.lit(p)}) as bigint)"

    def has(self, x: str, s: str) -> str:
        return f"contains({x}, {self.lit(s)})"

    def words(self, x: str) -> str:
        return self.count(x, r"\S+")

    def tail(self, x: str, n: str) -> str:
        return f"substring({x}, cast({n} as int) + 1)"

    def compact(self, items: list[str]) -> str:
        return f"array_compact(array({', '.join(items)}))"

    def joined(self, items: list[str], by: str) -> str:
        return f"array_join(array_compact(array({', '.join(items)})), '{by}')"

    def item(self, values: list[str], at: str) -> str:
        return f"element_at(array({', '.join(map(self.lit, values))}), cast({at} as int) + 1)"

    def two(self, x: str) -> str:
        return f"format_string('%.2f', round({x}, 2))"


class Duck(Spark):
    name = "duck"

    def lit(self, s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def rlike(self, x: str, p: str) -> str:
        return f"regexp_matches({x}, {self.lit(p)})"

    def rep(self, x: str, p: str, r: str = "") -> str:
        return f"regexp_replace({x}, {self.lit(p)}, {self.lit(r)}, 'g')"

    def count(self, x: str, p: str) -> str:
        return f"cast(len(regexp_extract_all({x}, {self.lit(p)})) as bigint)"

    def compact(self, items: list[str]) -> str:
        return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"

    def joined(self, items: list[str], by: str) -> str:
        return f"concat_ws('{by}', {', '.join(items)})"

    def item(self, values: list[str], at: str) -> str:
        return f"([{', '.join(map(self.lit, values))}])[cast({at} as int) + 1]"

    def two(self, x: str) -> str:
        return f"format('{{:.2f}}', round({x}, 2))"


SPARK, DUCK = Spark(), Duck()


def strip(d: Spark, x: str) -> str:
    return d.rep(x, r"^\s+|\s+$")


def case(arms: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in arms) + f" ELSE {otherwise} END"


def total(terms: list[tuple[str, float]], base: str = "0.0D") -> str:
    """base plus the weights of the conditions that hold, added in that order."""
    out = base
    for condition, weight in terms:
        out = f"({out} + CASE WHEN {condition} THEN {weight!r}D ELSE 0.0D END)"
    return out


def for_duck(sql: str) -> str:
    """Numbers like 0.5D are doubles in Spark; DuckDB casts."""
    import re

    return re.sub(r"(?<![\w.'])(-?\d+\.\d+)D\b", r"\1::DOUBLE", sql)
