"""URL filters by a cascade of Bloom filters over the corpus's complete key universe.

A rule names a host and the start of a path.  It fits a URL if one of the URL's keys (a host suffix and a path prefix)
is the rule's.  Whether a key is listed is told by a cascade: level 1 holds the listed keys, level 2 those keys of the
corpus that level 1 holds by mistake, level 3 the listed keys that level 2 holds by mistake, and so on until a level
makes no mistake.  For every key of the corpus that it was built over, the answer is exact, and it needs no join.

Sizing follows the usual rule for cascades: level 1 may err on about as many corpus keys as there are listed keys, the
others on half.  So a cascade has O(listed * log(corpus keys / listed)) bits however large the corpus is; listed keys
are bounded by ``MAX_LISTED``.  Everything is Spark expressions; the driver sees counts and the filters' words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.shared import folded, stored

MAX_LISTED = 100_000
MAX_LEVELS = 64
LEAST_BITS = 64


@dataclass(frozen=True)
class Rule:
    action: str  # block or allow
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]  # 64 bits each

    def places(self, key: Column, depth: int) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(depth), F.lit(i), key), F.lit(self.bits)) for i in range(self.hashes)]

    def holds(self, key: Column, depth: int) -> Column:
        # Folded to one constant array before the job starts.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        found = F.lit(True)
        for place in self.places(key, depth):
            found = found & (F.get(words, _word(place)).bitwiseAND(_bit(place)) != 0)
        return found


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Whether ``key`` is listed; exact for every key of the universe that the cascade was built over."""
        out = F.lit(len(self.levels) % 2 == 1)
        for depth in reversed(range(len(self.levels))):
            out = F.when(self.levels[depth].holds(key, depth), out).otherwise(F.lit(depth % 2 == 1))
        return out


def _level(keys: DataFrame, count: int, rate: float, depth: int) -> Level:
    bits = max(LEAST_BITS, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    level = Level(bits, min(max(1, round(-math.log2(rate))), 32), ())
    found = (
        keys.select(F.explode(F.array(*level.places(F.col("key"), depth))).alias("place"))
        .groupBy(_word(F.col("place")).alias("word"))
        .agg(F.bit_or(_bit(F.col("place"))).alias("bits"))
        .collect()  # at most one row per word of the filter
    )
    words = [0] * -(-bits // 64)
    for row in found:
        words[row["word"]] = row["bits"]
    return Level(bits, level.hashes, tuple(words))


def build(universe: DataFrame, listed: list[str]) -> Cascade:
    """The cascade that tells the ``listed`` keys from all other keys in column ``key`` of ``universe``.

    ``universe`` holds distinct keys and should be stored: it is read once per level.  Listed keys that the corpus
    lacks are held as well.  Without listed keys the cascade is one empty level and contains nothing.
    """
    listed = sorted(set(listed))
    if len(listed) > MAX_LISTED:
        raise ValueError(f"{len(listed)} keys are listed; one cascade takes {MAX_LISTED}")
    if not listed:
        return Cascade((Level(LEAST_BITS, 1, (0,)),))
    spark = universe.sparkSession
    inside = spark.range(1).select(F.explode(F.array(*map(F.lit, listed))).alias("key"))
    outside = universe.where(~F.col("key").isin(listed))
    total = outside.count()
    rate = min(0.5, len(listed) / (math.sqrt(2) * max(total, 1)))
    levels: list[Level] = []
    own, other, count = inside, outside, len(listed)
    while count:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade does not end; are two keys of one hash?")
        depth = len(levels)
        levels.append(_level(own, count, rate if depth == 0 else 0.5, depth))
        own, other = other.where(levels[-1].holds(F.col("key"), depth)), own
        count = own.count()
    return Cascade(tuple(levels))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where no ``://`` stands."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    return folded(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Every host suffix with every path prefix of a length that some rule has."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.array_compact(
        F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(path_lengths)])
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, *, url_column: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with a struct column ``url_filter``: host, path, the longest fitting rule and the verdict.

    A rule fits its host and all subdomains if the path starts with the rule's.  Where none fits, ``rule`` is null and
    the verdict ``default``: a URL that is not listed passes.  Null and malformed URLs have empty host and path.  An
    own column ``url_filter`` is replaced; an empty table stays empty.
    """
    if len({r.key for r in rules}) != len(rules):
        raise ValueError("a key has two rules")
    pages = pages.drop("url_filter")
    host, path = split_url(F.col(url_column))
    lengths = sorted({len(r.path) for r in rules})
    own = pages.select(host.alias("host"), path.alias("path")).distinct()
    universe = stored(own.select(F.explode(keys(F.col("host"), F.col("path"), lengths)).alias("key")).distinct())
    listed = build(universe, [r.key for r in rules])
    blocked = build(universe, [r.key for r in rules if r.action == "block"])
    parts = pages.withColumn("url_filter", F.struct(host.alias("host"), path.alias("path")))
    host, path = F.col("url_filter.host"), F.col("url_filter.path")
    fitting = F.filter(keys(host, path, lengths), listed.contains)
    # The longest; of two equally long the one with the longer host, which comes first.
    best = F.reduce(
        fitting,
        F.lit(None).cast("string"),
        lambda a, b: F.when(a.isNull() | (F.length(b) > F.length(a)), b).otherwise(a),
    )
    parts = parts.withColumn("url_filter", F.struct(host.alias("host"), path.alias("path"), best.alias("rule")))
    rule = F.col("url_filter.rule")
    verdict = F.when(rule.isNull(), F.lit(default)).when(blocked.contains(rule), "block").otherwise("allow")
    return parts.withColumn("url_filter", F.struct("url_filter.*", verdict.alias("verdict")))
