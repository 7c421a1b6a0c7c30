"""URL filters: prefix rules first, then exact membership by a Bloom filter cascade.

The cascade alternates filters: level 1 encodes the listed keys, level 2 the keys
of the universe that pass level 1 without being listed, level 3 the listed keys
that pass level 2, and so on until a level lets nothing wrong through.  A key of
the universe is then decided exactly by the number of the first level that
rejects it, with no join at query time.  A list too long for one cascade becomes
several, by a hash of the key.  All of it is DataFrame expressions.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule, and is listed nowhere; equal URLs get equal verdicts; an empty
table gives an empty result; an empty list blocks nothing; other columns of the
input, whatever their names, pass through unless they are named like an output,
which then replaces them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismarq.llm.common import fresh, lower_ascii, write_table

#: (host, path prefix, verdict) of the query's rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Domains whose pages, and whose subdomains' pages, the query blocks where no rule fits.
LISTED = ("spam-farm.example.org", "spam-farm.example.com", "spam-farm.example.net", "cheap-pills.example.org", "cheap-pills.example.com", "cheap-pills.example.net")
#: A cascade whose first filter would have more bits is split by key into several: filters travel with each task.
MAX_BITS = 1 << 27


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its 64-bit words, number of probes and salt."""

    words: list[int]
    probes: int
    salt: int

    @property
    def bits(self) -> int:
        return 64 * len(self.words)


def _positions(key: Column, bits: int, probes: int, salt: int) -> Column:
    """Bit positions of ``key``; both parts stay below 2**31, so nothing overflows."""
    step = F.pmod(F.xxhash64(F.lit(salt), key), F.lit(bits - 1)) + 1
    start = F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(bits))
    return F.array(*[F.pmod(start + F.lit(i) * step, F.lit(bits)) for i in range(probes)])


def _build(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """Encode the ``n`` rows of ``keys`` (column ``key``) with false-positive rate ``rate``."""
    per_key = math.log2(1 / rate)
    bits = max(64, 64 * math.ceil(1.4427 * per_key * n / 64))
    probes = max(1, round(per_key))
    words = [0] * (bits // 64)
    spread = keys.select(F.explode(_positions(F.col("key"), bits, probes, salt)).alias("p"))
    found = spread.groupBy((F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("b"))
    for w, b in found.collect():  # at most bits / 64 rows
        words[w] = b
    return Level(words, probes, salt)


def _passes(level: Level, key: Column) -> Column:
    # One string crosses to the JVM and becomes one literal there, however long.
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")
    test = lambda p: F.call_function("shiftrightunsigned", F.get(words, (p / 64).cast("int")), (p % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    return F.forall(_positions(key, level.bits, level.probes, level.salt), test)


def build_cascade(listed: DataFrame, universe: DataFrame, rate: float = 0.5, most_levels: int = 64) -> list[Level]:
    """Levels that decide, for every key of ``universe``, whether it is in ``listed``.

    Both have one column ``key``.  Listed keys outside the universe are left out;
    null keys are in neither.  The first level's rate makes its false positives
    about as many as the listed keys; later levels use ``rate``.
    """
    universe = write_table(universe.where("key is not null").distinct())
    wanted = write_table(universe.join(listed.select("key").distinct(), "key", "left_semi"))
    n, total = wanted.count(), universe.count()
    if n == 0:
        return []
    levels = [_build(wanted, n, _first_rate(n, total), 1)]
    right, wrong = wanted, universe.join(wanted, "key", "left_anti")
    while len(levels) < most_levels:
        wrong = write_table(wrong.where(_passes(levels[-1], F.col("key"))))
        n = wrong.count()
        if n == 0:
            return levels
        levels.append(_build(wrong, n, rate, len(levels) + 1))
        right, wrong = wrong, right
    raise ValueError("the cascade did not end; raise most_levels")


@dataclass(frozen=True)
class Cascades:
    """Cascades of keys that are told apart by hash; each decides the keys of its part."""

    parts: list[list[Level]]


def part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(parts))


def build_cascades(listed: DataFrame, universe: DataFrame, rate: float = 0.5, most_bits: int = MAX_BITS) -> Cascades:
    """As many cascades as keep each filter near ``most_bits``."""
    listed, universe = write_table(listed.select("key").where("key is not null").distinct()), write_table(universe.where("key is not null").distinct())
    n, total = listed.count(), universe.count()
    first = 1.4427 * math.log2(1 / _first_rate(n, total)) * n
    parts = max(1, math.ceil(first / most_bits))
    return Cascades([build_cascade(listed.where(part_of(F.col("key"), parts) == i), universe.where(part_of(F.col("key"), parts) == i), rate) for i in range(parts)])


def listed_in(cascades: Cascades, key: Column) -> Column:
    """Whether ``key``, a key of the universe, is listed (false for null)."""
    out = listed_by(cascades.parts[0], key)
    for i, levels in enumerate(cascades.parts[1:], 1):
        out = F.when(part_of(key, len(cascades.parts)) == i, listed_by(levels, key)).otherwise(out)
    return out


def _first_rate(n: int, total: int) -> float:
    """Rate at which the first level's false positives are about as many as the listed keys."""
    return min(0.5, max(1e-9, n / (math.sqrt(2) * max(1, total - n)))) if n else 0.5


def listed_by(levels: Sequence[Level], key: Column) -> Column:
    """Whether ``key``, a key of the universe, is listed (false for null)."""
    if not levels:
        return F.lit(False)
    out = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels), 0, -1):
        out = F.when(_passes(levels[depth - 1], key), out).otherwise(F.lit(depth % 2 == 0))
    return F.coalesce(F.when(key.isNotNull(), out), F.lit(False))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    return lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def domains_of(host: Column, labels: int) -> Column:
    """The host and its parent domains that have at most ``labels`` labels, longest first."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.greatest(F.lit(1), n - (labels - 1)), n), lambda i: F.array_join(F.slice(parts, i, n), "."))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; ties go to the later host in code-point order."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0], r[1])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(df: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, listed: Sequence[str] | DataFrame = LISTED) -> DataFrame:
    """``df`` with ``host, path, rule, verdict``: the longest fitting rule's verdict, else ``block`` for listed domains and ``allow`` for others."""
    if not isinstance(listed, DataFrame):
        listed = df.sparkSession.createDataFrame([(k,) for k in listed], "key string")
    # No longer name can be listed, so longer ones need not be looked up.
    labels = listed.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).first()["n"] or 1
    host, path = url_parts(F.col(url))
    hosts = df.select(host.alias("host")).distinct()
    universe = hosts.select(F.explode(domains_of(F.col("host"), labels)).alias("key"))
    cascades = build_cascades(listed, universe)
    (best,) = fresh(df, "best")
    out = df.withColumns({"host": host, "path": path})
    blocked = F.exists(domains_of(F.col("host"), labels), lambda k: listed_in(cascades, k))
    out = out.withColumn(best, best_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col(best)["verdict"], F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    return out.withColumns({"rule": F.col(best)["rule"], "verdict": verdict}).drop(best)


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict of every ``pages`` URL."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def _oracle() -> str:
    fit = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    order = sorted(RULES, key=lambda r: (len(r[0] + r[1]), r[0], r[1]), reverse=True)
    rule = "CASE " + " ".join(f"WHEN {fit(h, p)} THEN '{h + p}'" for h, p, _ in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fit(h, p)} THEN '{v}'" for h, p, v in order)
    verdict += " WHEN " + " OR ".join(f"host = '{d}' OR ends_with(host, '.{d}')" for d in LISTED) + " THEN 'block' ELSE 'allow' END"
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict FROM parts"""


ORACLE_SQL = _oracle()
