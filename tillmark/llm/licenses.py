"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line, or a passage: consecutive words over any line ends, as many as the template has and ``SLACK`` more,
so that a wrapped notice is one block.  A template's tokens are its distinct words; a block meets it if it holds at
least ``CONTAINMENT`` of them.  The join is the exact prefix-filter join: all tokens of the templates are ordered by how
many lines of the whole corpus hold them, rarest first; a block that meets a template with *t* tokens, of which *k* are
needed, holds one of the template's first ``t - k + 1`` tokens.  So only texts with such a rare token are split into
words.  For lines a length filter and a positional filter bound what a pair can still share; for passages the words
around the rare token, in which all passages with it lie, must hold enough.  What is left is counted exactly.

Only Spark expressions are used.  What the driver sees are the counts of the templates' own tokens.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.shared import folded, text_key

CONTAINMENT = 0.9
# By how much a passage may be longer than its template: words put in, marks of comment lines.
SLACK = 0.25

# A word after A-Z are lower-cased, and what parts two words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LINE_END = r"[\n\r]+"

# Phrases and labels of the contract.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices as their licenses ask for them.
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files to deal in the software without restriction",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl-3",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation either version 3 of the license",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)


def needed(tokens: int) -> int:
    return math.ceil(CONTAINMENT * tokens - 1e-9)


def passage_size(text: str) -> int:
    return math.ceil((1 + SLACK) * len(text.split()) - 1e-9)


def _either(words: list[str]) -> str:
    return f"(?i)(?:^|{GAP})(?:{'|'.join(sorted(words))})(?={GAP}|$)"


def token_order(documents: DataFrame, text_column: str, templates=TEMPLATES) -> list[str]:
    """The tokens of the templates, those in the fewest lines of the corpus first; ties by the token.

    The order decides only how much is compared, never what is found, so ``lower`` may stand for the exact folding.
    """
    vocabulary = sorted({word for _, text in templates for word in text.split()})
    block = F.explode(F.split(F.lower(F.col(text_column)), LINE_END)).alias("block")
    held = F.array_intersect(F.split("block", f"{GAP}+"), F.array(*map(F.lit, vocabulary)))
    counted = documents.select(block).select(F.explode(held).alias("token")).groupBy("token").count()
    counts = dict(counted.collect())  # at most one row per word of the templates
    return sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))


def _template_table(spark: SparkSession, order: list[str], templates) -> DataFrame:
    """One row per template and prefix token; as many rows as the templates have words at most."""
    rank = {word: place for place, word in enumerate(order)}
    rows = []
    for number, (label, text) in enumerate(templates):
        tokens = sorted(set(text.split()), key=rank.__getitem__)
        for place in range(len(tokens) - needed(len(tokens)) + 1):
            rows.append(
                F.struct(
                    F.lit(number).alias("template"),
                    F.lit(label).alias("label"),
                    F.lit(tokens[place]).alias("token"),
                    F.lit(place).alias("template_place"),
                    F.array(*map(F.lit, tokens)).alias("template_tokens"),
                    F.lit(needed(len(tokens))).alias("needed"),
                    F.lit(passage_size(text)).alias("passage_size"),
                )
            )
    sizes = max(len(text.split()) for _, text in templates)
    assert len(rows) <= sizes * len(templates)
    return spark.range(1).select(F.inline(F.array(*rows)))


def licensed_blocks(documents: DataFrame, *, text_column: str = "text", templates=TEMPLATES) -> DataFrame:
    """Every block that meets a template: text_key, block, template, label, containment, without repetitions.

    Null and empty texts have no block.  Two blocks of one text that read alike give one row.  Of the passages around
    one rare token, which overlap, the fullest one is named, by its words.
    """
    spark = documents.sparkSession
    order = token_order(documents, text_column, templates)
    table = _template_table(spark, order, templates)
    rare = sorted({row for _, text in templates for row in _prefix(order, text)})
    documents = documents.select(text_column).where(F.col(text_column).rlike(_either(rare)))
    block = F.explode(F.filter(F.split(F.col(text_column), LINE_END), lambda line: line.rlike(_either(rare))))
    blocks = documents.select(text_key(F.col(text_column)).alias("text_key"), block.alias("block")).distinct()
    # The words that the block shares with any template, in the global order.
    shared = F.array_intersect(
        F.array(*map(F.lit, order)), F.regexp_extract_all(folded(F.col("block")), F.lit(WORD), F.lit(0))
    )
    # Of both in this order: what stands before the common token can match pairwise at most, so can the rest.
    rest = F.least(F.size("template_tokens") - F.col("template_place"), F.size("tokens") - F.col("block_place"))
    pairs = (
        blocks.withColumn("tokens", shared)
        .select("*", F.posexplode("tokens").alias("block_place", "token"))
        .join(F.broadcast(table), "token")  # as small as the templates are
        .where(F.size("tokens") >= F.col("needed"))
        .where(F.least(F.col("template_place"), F.col("block_place")) + rest >= F.col("needed"))
        .dropDuplicates(["text_key", "block", "template"])
    )
    common = F.size(F.array_intersect("tokens", "template_tokens"))
    lines = pairs.where(common >= F.col("needed")).select(
        "text_key", "block", "template", "label", (common / F.size("template_tokens")).alias("containment")
    )
    return lines.unionByName(_passages(documents, text_column, order, templates, table)).distinct()


def _passages(documents: DataFrame, text_column: str, order: list[str], templates, table: DataFrame) -> DataFrame:
    """The fullest passage around each rare token that meets a template, as ``licensed_blocks`` gives it."""
    least: dict[str, int] = {}
    for _, text in templates:
        for token in _prefix(order, text):
            least[token] = min(needed(len(set(text.split()))), least.get(token, len(order)))
    longest = max(passage_size(text) for _, text in templates)
    vocabulary = F.array(*map(F.lit, order))
    bound = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])

    def around(words: Column, place: Column, size) -> Column:
        """The words of which a passage of ``size`` words that holds the one at ``place`` (from 0) can consist."""
        before = F.least(place, F.lit(size) - 1)
        return F.slice(words, place - before + 1, before + F.lit(size))

    def near(words: Column) -> Column:
        places = F.array_compact(F.transform(words, lambda word, i: F.when(word.isin(list(least)), i)))
        token = lambda place: F.get(words, place)
        enough = F.filter(
            places,
            lambda i: F.size(F.array_intersect(around(words, i, longest), vocabulary)) >= F.element_at(bound, token(i)),
        )
        return F.transform(
            enough,
            lambda i: F.struct(
                token(i).alias("token"), F.least(i, F.lit(longest - 1)).alias("place"), around(words, i, longest).alias("near")
            ),
        )

    # In a lambda's variable, so that a text is split once.
    split = F.array(F.regexp_extract_all(folded(F.col(text_column)), F.lit(WORD), F.lit(0)))
    found = documents.select(
        text_key(F.col(text_column)).alias("text_key"), F.inline(F.element_at(F.transform(split, near), 1))
    ).distinct()
    pairs = (
        found.join(F.broadcast(table), "token")  # as small as the templates are
        .withColumn("near", around(F.col("near"), F.col("place"), F.col("passage_size")))
        .where(F.size(F.array_intersect("near", "template_tokens")) >= F.col("needed"))
    )
    starts = F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("passage_size") + 1, F.lit(1)))
    held = lambda i: F.size(F.array_intersect(F.slice("near", i, F.col("passage_size")), F.col("template_tokens")))
    best = F.array_max("counts")
    return (
        pairs.withColumn("counts", F.transform(starts, held))
        .where(best >= F.col("needed"))
        .select(
            "text_key",
            F.array_join(F.slice("near", F.array_position("counts", best).cast("int"), F.col("passage_size")), " ").alias("block"),
            "template",
            "label",
            (best / F.size("template_tokens")).alias("containment"),
        )
    )


def _prefix(order: list[str], text: str) -> list[str]:
    rank = {word: place for place, word in enumerate(order)}
    tokens = sorted(set(text.split()), key=rank.__getitem__)
    return tokens[: len(tokens) - needed(len(tokens)) + 1]


def _phrase_places(text: Column, phrases: dict[str, str]) -> Column:
    """For each phrase that stands in the text: label, places, first and last word place."""
    gap = f"{GAP}+"
    maybe = text.rlike("(?i)" + "|".join(gap.join(p.split()) for p in phrases))
    line = F.concat(F.lit(" "), F.trim(F.regexp_replace(folded(text), gap, " ")), F.lit(" "))

    def places(line: Column) -> Column:
        words_to = lambda part: F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit(""))) - 1
        found = []
        for phrase, label in phrases.items():
            padded, size = f" {phrase} ", len(phrase.split())
            back = F.reverse(line)
            before = words_to(F.substr(line, F.lit(1), F.locate(padded, line)))
            after = words_to(F.substr(back, F.lit(1), F.locate(padded[::-1], back)))
            one = F.struct(
                F.lit(label).alias("label"),
                F.regexp_count(line, F.lit(f"(?={padded})")).cast("long").alias("n"),
                before.cast("long").alias("first"),
                (words_to(line) - after - size).cast("long").alias("last"),
            )
            found.append(F.when(F.contains(line, F.lit(padded)), one))
        return F.array_compact(F.array(*found))

    inner = F.element_at(F.transform(F.array(line), places), 1)
    return F.when(maybe, inner).otherwise(F.array().cast("array<struct<label:string,n:bigint,first:bigint,last:bigint>>"))


def scanned(documents: DataFrame, *, text_column: str = "text", phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """``documents`` with a struct column ``licenses``.

    It holds n_words, n_base, first_word, last_word, base_labels (of the phrases), labels (the join's too; both sorted
    arrays) and score: the largest containment of a template, 1 where a phrase stands, else 0.  Null counts as empty.
    Rows keep their number; an own column ``licenses`` is replaced.  Labels follow the text, so equal texts share them.
    """
    documents = documents.drop("licenses")
    text = F.coalesce(F.col(text_column), F.lit(""))
    found = licensed_blocks(documents, text_column=text_column, templates=templates)
    labels = (
        found.groupBy("text_key")
        .agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment"))
        .withColumnRenamed("text_key", "_key")
    )
    # The caller's columns travel as one, so that none of their names matters.
    base = documents.select(
        F.struct("*").alias("row"),
        text_key(F.col(text_column)).alias("_key"),
        F.regexp_count(text, F.lit(ANY_WORD)).cast("long").alias("_words"),
        _phrase_places(text, phrases).alias("_base"),
    )
    own = F.array_sort(F.array_distinct(F.transform("_base", lambda b: b["label"])))
    total = F.reduce("_base", F.lit(0).cast("long"), lambda a, b: a + b["n"])
    return base.join(labels, "_key", "left").select(
        "row.*",
        F.struct(
            F.col("_words").alias("n_words"),
            total.alias("n_base"),
            F.array_min(F.transform("_base", lambda b: b["first"])).alias("first_word"),
            F.array_max(F.transform("_base", lambda b: b["last"])).alias("last_word"),
            own.alias("base_labels"),
            F.array_sort(F.array_union(own, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
            F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        ).alias("licenses"),
    )
