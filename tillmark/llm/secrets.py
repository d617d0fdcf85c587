"""Secret scans with corpus-wide ownership frequency.

Patterns name candidates; whether a candidate is live is told by who has it.  Every candidate's value is hashed, and
the hashes are counted by distinct repositories and owners over the whole corpus: a value that many owners have is a
copied example, one that stays with few looks like a live credential.

Only Spark expressions are used.  Places are found without a regular-expression library of our own: the pieces between
the matches of a pattern (``split``) and the matches themselves (``regexp_extract_all``) add up to the text.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.shared import stored, text_key

# A value of at least so many owners is a copied example.
COMMON_OWNERS = 4
MASK = "<secret>"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORD = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    group: int  # that holds the value
    least: int  # characters of the value
    signs: tuple[str, ...]  # lower-case pieces of which a text with a match has one

    @property
    def base(self) -> bool:
        return self.name in ("assign", "access", "hex")


# The base kinds of the contract, in its order.
BASE = (
    Kind("assign", rf"""({_KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, ("passw", "secret", "token", "apikey", "api_key")),
    Kind("access", "AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    Kind("hex", "[0-9a-f]+", 0, 24, ()),
)
MORE = (
    Kind("prefixed", "(?:ghp|gho|ghu|ghs|ghr|glpat|sk|xoxa|xoxb|xoxp)[_-][A-Za-z0-9_-]+", 0, 20, ("_", "-")),
    Kind("bearer", rf"{either_case('bearer')}\x20+([A-Za-z0-9._~+/-]+)", 1, 20, ("bearer",)),
    Kind("login", r"://[^\x00-\x20/:@]+:([^\x00-\x20/@]+)@", 1, 6, ("://",)),
    Kind("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, ("-----begin",)),
)
KINDS = BASE + MORE

SPAN = "struct<start:bigint,end:bigint,rank:int,kind:string,value_hash:string>"


def likely(text: Column, kinds: tuple[Kind, ...]) -> Column:
    """Whether ``text`` has a match of any kind: never false where it has a long enough one.

    Plain searches come first, as nearly all texts end there.  ``lower`` stands in an array of one, so that it is
    computed once for all of them.
    """

    def any_sign(lowered: Column) -> Column:
        kinds_with_signs = [kind for kind in kinds if kind.signs]
        found = [
            reduce(operator.or_, [F.contains(lowered, F.lit(sign)) for sign in kind.signs]) & text.rlike(kind.pattern)
            for kind in kinds_with_signs
        ]
        return reduce(operator.or_, found, F.lit(False))

    runs = [text.rlike(f"[0-9a-f]{{{kind.least}}}") for kind in kinds if not kind.signs]
    return reduce(operator.or_, runs, F.exists(F.array(F.lower(text)), any_sign))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Of whole numbers, none negative: what ``combine`` makes of all values before each, 0 before the first.

    Values are taken in blocks as long as there are blocks, so n of them cost n times the square root of n, in simple
    steps; a list that grows by one value at a time would be copied n times.
    """
    total = lambda some: F.aggregate(some, F.lit(0).cast("bigint"), lambda a, b: combine(a, b))
    count = lambda n: F.sequence(F.lit(0), n - 1)

    def blocks(v: Column, long: Column) -> Column:
        sums = F.transform(count(F.ceil(F.size(v) / long).cast("int")), lambda k: total(F.slice(v, k * long + 1, long)))

        def within(before: Column) -> Column:
            def one(_: Column, i: Column) -> Column:
                block = F.floor(i / long).cast("int")
                return combine(F.get(before, block), total(F.slice(v, block * long + 1, i - block * long)))

            return F.transform(v, one)

        upto = lambda s: F.transform(count(F.size(s)), lambda k: total(F.slice(s, F.lit(1), k)))
        return _bound(sums, lambda s: _bound(upto(s), within))

    def of(v: Column) -> Column:
        long = F.ceil(F.sqrt(F.size(v))).cast("int")
        return F.when(F.size(v) > 0, _bound(long, lambda n: blocks(v, n))).otherwise(v)

    return _bound(values, of)


def _spans(text: Column, kind: Kind, rank: int) -> Column:
    """Matches of one kind, leftmost and non-overlapping, those with too short a value dropped."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    empty = F.array().cast(f"array<{SPAN}>")

    def placed(pairs: Column) -> Column:
        lengths = F.transform(pairs, lambda p: (F.length(p["gap"]) + F.length(p["match"])).cast("bigint"))
        before = _running(lengths, lambda a, b: a + b)
        return F.transform(F.arrays_zip(pairs.alias("pair"), before.alias("before")), span)

    def span(found: Column) -> Column:
        begin = found["before"] + F.length(found["pair"]["gap"])
        value = F.regexp_extract(found["pair"]["match"], kind.pattern, kind.group)
        return F.when(
            F.length(value) >= kind.least,
            F.struct(
                begin.alias("start"),
                (begin + F.length(found["pair"]["match"])).alias("end"),
                F.lit(rank).alias("rank"),
                F.lit(kind.name).alias("kind"),
                F.sha2(value.cast("binary"), 256).alias("value_hash"),
            ).cast(SPAN),
        )

    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), matches.alias("match")), lambda p: p["match"].isNotNull())
    found = F.filter(_bound(pairs, placed), lambda s: s.isNotNull())
    return F.when(text.rlike(kind.pattern), found).otherwise(empty)


def spans(text: Column, kinds: tuple[Kind, ...] = KINDS) -> Column:
    """All candidates of a text by start, then kind; places are code points, the end exclusive."""
    found = F.array_sort(F.concat(*[_spans(text, kind, rank) for rank, kind in enumerate(kinds)]))
    return F.when(likely(text, kinds), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def ownership(candidates: DataFrame, common_owners: int = COMMON_OWNERS) -> DataFrame:
    """value_hash, n_repositories, n_owners, live, from rows of (value_hash, repository, owner).

    Rows are folded to (hash, repository, owner) before they meet, so a value that a third of all rows hold reaches
    the last grouping as one row per repository.  A null repository or owner counts as one of its own.
    """
    once = candidates.groupBy("value_hash", "repository", "owner").agg(F.lit(1).alias("one"))
    named = lambda c: F.struct(F.col(c).isNull(), F.col(c))
    return once.groupBy("value_hash").agg(
        F.count_distinct(named("repository")).alias("n_repositories"),
        F.count_distinct(named("owner")).alias("n_owners"),
    ).withColumn("live", F.col("n_owners") < common_owners)


def found_spans(documents: DataFrame, *, keep: list[str], text_column: str, repository: str, owner: str) -> DataFrame:
    """The columns ``keep``, text_key, repository, owner and spans of every row, without the text; stored."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    columns = [F.struct(*[F.col(c) for c in keep]).alias("kept")] if keep else []
    return stored(
        documents.select(
            *columns,
            text_key(F.col(text_column)).alias("text_key"),
            F.col(repository).cast("string").alias("repository"),
            F.col(owner).cast("string").alias("owner"),
            spans(text).alias("spans"),
        )
    )


def judged_spans(found: DataFrame, common_owners: int = COMMON_OWNERS) -> DataFrame:
    """text_key and judged, its spans with ``live``: one row per text that has candidates."""
    with_spans = found.where(F.size("spans") > 0)
    exploded = with_spans.select("repository", "owner", "text_key", F.explode("spans").alias("span"))
    counted = ownership(
        exploded.select(F.col("span.value_hash").alias("value_hash"), "repository", "owner"), common_owners
    )
    # One row per text before the join: copies of a text hold the same candidates.
    once = exploded.select("text_key", "span").dropDuplicates(["text_key", "span"])
    return (
        once.withColumn("value_hash", F.col("span.value_hash"))
        .join(counted, "value_hash")
        .groupBy("text_key")
        .agg(F.array_sort(F.collect_list(F.struct("span.start", "span.end", "span.kind", "live"))).alias("judged"))
    )


def scanned(
    documents: DataFrame,
    *,
    keep: list[str],
    text_column: str = "text",
    repository: str = "source",
    owner: str = "source",
    common_owners: int = COMMON_OWNERS,
) -> DataFrame:
    """The columns ``keep`` of every row, its ``spans`` and ``judged``: the same spans with their ``live``.

    Null texts count as empty and have no spans; repeated rows are all returned.  A value is ``live`` if fewer than
    ``common_owners`` owners have it anywhere in ``documents``.
    """
    found = found_spans(documents, keep=keep, text_column=text_column, repository=repository, owner=owner)
    judged = judged_spans(found, common_owners).withColumnRenamed("text_key", "_key")
    out = found.join(judged, F.col("text_key") == F.col("_key"), "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string,live:boolean>>")
    return out.select(*[F.col("kept")[c].alias(c) for c in keep], "spans", F.coalesce("judged", none).alias("judged"))


PIECE = 1024


def masked(text: Column, judged: Column, mask: str = MASK) -> Column:
    """``text`` with every live span replaced; overlapping ones become one mask.

    The text between masks is taken from pieces of bounded length, as a place far into a long text is dear to reach.
    """
    zero = F.lit(0).cast("bigint")
    spans_ = F.filter(judged, lambda s: s["live"])

    def between(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        some = F.array_join(F.slice(pieces, first + 1, F.ceil(end / PIECE).cast("int") - first), "")
        return F.when(end > start, F.substr(some, (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))).otherwise("")

    def of(live: Column) -> Column:
        reached = _running(F.transform(live, lambda s: s["end"]), F.greatest)
        placed = F.arrays_zip(live.alias("span"), reached.alias("reached"))
        fresh = F.filter(placed, lambda p: p["span"]["start"] >= p["reached"])
        end = F.aggregate(live, zero, lambda a, s: F.greatest(a, s["end"]))

        def joined(pieces: Column) -> Column:
            kept = F.transform(fresh, lambda p: between(pieces, p["reached"], p["span"]["start"]))
            rest = between(pieces, end, F.length(text).cast("bigint"))
            return F.array_join(F.concat(kept, F.array(rest)), mask)

        return _bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), joined)

    return _bound(spans_, of)


def redacted(
    documents: DataFrame,
    *,
    text_column: str = "text",
    repository: str = "source",
    owner: str = "source",
    common_owners: int = COMMON_OWNERS,
) -> DataFrame:
    """``documents`` with live-looking secrets masked; copied examples and all other text stay.

    Only rows that hold candidates are joined; all others, null texts included, pass by untouched.  A text may hold any
    number of candidates; an empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = found_spans(documents, keep=[], text_column=text_column, repository=repository, owner=owner)
    judged = judged_spans(found, common_owners)
    holds = likely(text, KINDS)
    own = documents.where(holds).select(F.struct("*").alias("row"), text_key(F.col(text_column)).alias("key"))
    own = own.join(judged, F.col("key") == F.col("text_key"), "left")
    old = F.col("row").getField(text_column)
    new = F.when(F.col("judged").isNull(), old).otherwise(masked(old, F.col("judged")))
    own = own.select(F.col("row").withField(text_column, new).alias("row")).select("row.*")
    return documents.where(~holds).unionByName(own)
