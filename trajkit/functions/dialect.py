"""Expressions that Spark and DuckDB spell differently; one query text serves both."""

from __future__ import annotations

EARTH_M = 6_371_000


class Dialect:
    """Renders table names and functions for one engine."""

    spark = False

    def __init__(self, sf_dir: str = ""):
        self.sf_dir = sf_dir

    def t(self, name: str) -> str:
        return name

    def f(self, x: float) -> str:
        return f"CAST({x} AS DOUBLE)"

    def us(self, ts: str) -> str:
        return f"epoch_us({ts})"

    def pmod(self, a: str, b: str) -> str:
        return f"((({a}) % ({b})) + ({b})) % ({b})"

    def hex(self, text: str, n: int = 8) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, {n}) AS BIGINT)"

    def pct(self, x: str, q: float) -> str:
        return f"quantile_cont({x}, {q})"

    def disc(self, x: str, q: float) -> str:
        return f"quantile_disc({x}, {q})"

    def joined(self, x: str, order: str, sep: str) -> str:
        return f"string_agg({x}, '{sep}' ORDER BY {order})"

    def sha(self, x: str) -> str:
        return f"sha256({x})"

    def json_int(self, x: str, key: str) -> str:
        return f"CAST(json_extract_string({x}, '$.{key}') AS BIGINT)"

    def only(self, x: str, chars: str) -> str:
        return f"regexp_replace({x}, '[^{chars}]', '', 'g')"

    def series(self, lo: str, hi: str) -> str:
        return f"unnest(range({lo}, {hi} + 1))"

    # what follows is spelled alike
    def uniform(self, *parts: str) -> str:
        """Keyed draw in (0, 1): the same for the same key on any partitioning."""
        text = " || '|' || ".join(f"CAST({p} AS STRING)" for p in parts)
        return f"(({self.hex(text)} + {self.f(0.5)}) / {self.f(4294967296.0)})"

    def normal(self, *parts: str) -> str:
        return f"(sqrt(-2 * ln({self.uniform(*parts, "'a'")})) * cos(2 * pi() * {self.uniform(*parts, "'b'")}))"

    def haversine(self, a: str, b: str, c: str, d: str) -> str:
        """Metres between two places; null where a part of one is (least() would pass over it)."""
        half, one = self.f(0.5), self.f(1)
        h = f"(power(sin(radians({c} - {a}) * {half}), 2) + cos(radians({a})) * cos(radians({c})) * power(sin(radians({d} - {b}) * {half}), 2))"
        return f"(2 * {self.f(EARTH_M)} * asin(sqrt(CASE WHEN {h} > {one} THEN {one} ELSE {h} END)))"

    def bearing(self, a: str, b: str, c: str, d: str) -> str:
        y = f"sin(radians({d} - {b})) * cos(radians({c}))"
        x = f"cos(radians({a})) * sin(radians({c})) - sin(radians({a})) * cos(radians({c})) * cos(radians({d} - {b}))"
        raw = f"(degrees(atan2({y}, {x})) + 360)"
        return f"({raw} - 360 * floor({raw} / 360))"


class SparkSql(Dialect):
    spark = True

    def t(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`"

    def us(self, ts: str) -> str:
        return f"unix_micros(CAST({ts} AS TIMESTAMP))"

    def pmod(self, a: str, b: str) -> str:
        return f"pmod({a}, {b})"

    def hex(self, text: str, n: int = 8) -> str:
        return f"CAST(conv(substr(md5({text}), 1, {n}), 16, 10) AS BIGINT)"

    def pct(self, x: str, q: float) -> str:
        return f"percentile({x}, {q})"

    def disc(self, x: str, q: float) -> str:
        return f"percentile_disc({q}) WITHIN GROUP (ORDER BY {x})"

    def joined(self, x: str, order: str, sep: str) -> str:
        return f"array_join(transform(array_sort(collect_list(struct({order} AS o, {x} AS x))), s -> s.x), '{sep}')"

    def sha(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def json_int(self, x: str, key: str) -> str:
        return f"CAST(get_json_object({x}, '$.{key}') AS BIGINT)"

    def only(self, x: str, chars: str) -> str:
        return f"regexp_replace({x}, '[^{chars}]', '')"

    def series(self, lo: str, hi: str) -> str:
        return f"explode(sequence({lo}, {hi}))"
