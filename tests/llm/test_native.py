"""Operators that are Spark expressions: properties that their SQL does not show."""

import random
import re
import time

import fixtures
from pyspark.sql import functions as F

from tillmark.llm import licenses, queries, secrets, url_filter

PYTHON = ("Python", "Pandas", "Arrow", "ExistingRDD")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_the_plans(spark):
    for name in ("op4_license_scan", "op8_secret_scan", "op10_url_filters"):
        text = plan(queries.queries()[name](spark, "/root/testdata/sf0.001"))
        assert not [p for p in PYTHON if p in text], name


def test_columns_of_the_caller_stay(spark):
    documents = fixtures.clashing(spark)
    for out in (licenses.scanned(documents), secrets.redacted(documents)):
        fixtures.kept_clashes(documents, out)
        assert out.count() == documents.count()


def test_empty_tables(spark):
    none = fixtures.empty(spark)
    assert licenses.scanned(none).count() == 0
    assert secrets.scanned(none, keep=["doc_id"]).count() == 0
    assert secrets.redacted(none).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judged(pages).count() == 0


MIT = """Copyright (c) 2020 Q. All rights kept.

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights"""
GPL = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without\r
modification, are permitted provided that the following conditions\r
are met:"""
MPL = """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy of the MPL was not distributed with this"""


def met_by_brute_force(text):
    """Label to containment: over the lines, and over all passages of the text."""
    own, found = fixtures.words(text, fixtures.LETTERS), {}
    lines = [fixtures.words(line, fixtures.LETTERS) for line in re.split("[\n\r]+", text or "")]
    for label, template in licenses.TEMPLATES:
        tokens, size = set(template.split()), licenses.passage_size(template)
        blocks = lines + [own[i : i + size] for i in range(max(1, len(own) - size + 1))]
        most = max(len(tokens & set(block)) for block in blocks)
        if most >= licenses.needed(len(tokens)):
            found[label] = max(most / len(tokens), found.get(label, 0))
    return found


def test_wrapped_notices_are_found(spark):
    rng = random.Random(1)
    texts = [MIT, GPL, BSD, MPL, f"{fixtures.sentence(rng, 300)}\n\n{GPL}\n{fixtures.sentence(rng, 300)}\n{MIT}"]
    texts += ["licensed under\nthe\nApache License,\nVersion 2.0", "released under the\n", None, "", "a mit b"]
    texts.append("released\n" + "far " * 40 + "under\nthe\nmit\nlicense")  # too far apart for a passage
    for _ in range(150):
        own = rng.choice(licenses.TEMPLATES)[1].split()
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(own))
            own[at : at + rng.randint(0, 1)] = [rng.choice(["x", "mit", "license", "the"])] * rng.randint(1, 3)
        own[:0], own[len(own) :] = ["y"] * rng.randint(0, 50), ["z"] * rng.randint(0, 50)
        texts.append("".join(word + rng.choice([" ", " ", "\n"]) for word in own))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in licenses.scanned(documents).collect()}
    for place, label in enumerate(["mit", "gpl-3", "bsd", "mpl-2"]):
        assert label in got[place].labels and got[place].score >= 0.9 and got[place].base_labels == []
    for place, text in enumerate(texts):
        want = met_by_brute_force(text)
        assert set(got[place].labels) == set(want) | set(got[place].base_labels), text
        if not got[place].base_labels:
            assert got[place].score == max(want.values(), default=0), text


def test_copied_values_are_examples_and_live_ones_are_masked(spark):
    copied, own = "password=example123", 'api_key: "zzTop99zz"'
    rows = [(i, f"é {copied} end", "en", f"s{i}", 0) for i in range(6)] + [(50, f"a {own} b {copied}", "en", "s1", 0)]
    rows += [(51, None, "en", None, 0), (52, "", "en", None, 0)]
    documents = spark.createDataFrame(rows, fixtures.SCHEMA)
    found = {r.doc_id: r for r in secrets.scanned(documents, keep=["doc_id"]).collect()}
    assert [j.live for j in found[0].judged] == [False] and [j.live for j in found[50].judged] == [True, False]
    assert found[51].judged == [] and found[52].spans == []
    masked = {r.doc_id: r.text for r in secrets.redacted(documents).collect()}
    assert masked[50] == f'a {secrets.MASK}" b {copied}' and masked[0] == rows[0][1] and masked[51] is None


def masked_by_hand(text, spans):
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], secrets.MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_masks_equal_plain_cuts(spark):
    rng = random.Random(6)
    rows = []
    for i in range(120):
        text = "".join(rng.choice("abé🎉\n x") for _ in range(rng.choice([0, 1, 5, 1023, 1024, 1025, 5000])))
        spans = []
        for _ in range(rng.choice([0, 1, 3, 40])):
            if text:
                start = rng.randrange(len(text))
                spans.append((start, min(len(text), start + rng.randint(1, 30)), rng.random() < 0.8))
        rows.append((i, text, sorted(spans)))
    frame = spark.createDataFrame(rows, "id long, text string, judged array<struct<start:long,end:long,live:boolean>>")
    got = {r.id: r.m for r in frame.select("id", secrets.masked(F.col("text"), F.col("judged")).alias("m")).collect()}
    for i, text, spans in rows:
        assert got[i] == masked_by_hand(text, [s[:2] for s in spans if s[2]]), rows[i]


def test_running_totals(spark):
    rng = random.Random(2)
    rows = [([rng.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 3, 4, 9, 10, 17, 400)]
    frame = spark.createDataFrame(rows, "v array<long>")
    sums = secrets._running(F.col("v"), lambda a, b: a + b)
    tops = secrets._running(F.col("v"), F.greatest)
    for r in frame.select("v", sums.alias("s"), tops.alias("t")).collect():
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v))] and r.t == [max(r.v[:i], default=0) for i in range(len(r.v))]


def test_a_text_of_very_many_secrets(spark):
    """Three megabytes of keys, some of them copied by others."""
    many = " ".join(f"password=hunter{i:07d}" for i in range(130_000))
    rows = [(1, many, "en", "a", 0)] + [(2 + i, "password=hunter0000003 end", "en", f"s{i}", 0) for i in range(5)]
    documents = spark.createDataFrame(rows, fixtures.SCHEMA)
    documents.where("doc_id > 1").select(secrets.spans(F.col("text"))).collect()
    start = time.perf_counter()
    found = {r.doc_id: r for r in secrets.scanned(documents, keep=["doc_id"]).select("doc_id", F.size("spans").alias("n"), F.element_at("spans", -1).alias("last")).collect()}
    assert found[1].n == 130_000 and (found[1].last.start, found[1].last.end) == (len(many) - 22, len(many))
    masked = {r.doc_id: r.text for r in secrets.redacted(documents).collect()}
    taken = time.perf_counter() - start
    assert masked[1] == " ".join("password=hunter0000003" if i == 3 else secrets.MASK for i in range(130_000))
    assert masked[4] == "password=hunter0000003 end"
    assert taken < 60  # two scans and a mask


def test_a_value_of_many_owners_counts_each_once(spark):
    rows = [("h", "r1", "o1")] * 3 + [("h", "r2", "o1"), ("h", None, None), ("h", None, None)]
    got = secrets.ownership(spark.createDataFrame(rows, "value_hash string, repository string, owner string"), 2).first()
    assert (got.n_repositories, got.n_owners, got.live) == (3, 2, False)


def test_cascade_is_exact_over_its_universe(spark):
    keys = [f"k{i}" for i in range(5000)]
    listed = keys[::37] + ["elsewhere"]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    cascade = url_filter.build(universe, listed)
    assert len(cascade.levels) > 1
    got = universe.where(cascade.contains(F.col("key"))).collect()
    assert sorted(r.key for r in got) == sorted(keys[::37])
    bits = sum(level.bits for level in cascade.levels)
    assert bits < 64 * len(listed)


def test_longest_rule_wins(spark):
    rules = (url_filter.Rule("block", "a.b", ""), url_filter.Rule("allow", "b", "/xy"), url_filter.Rule("block", "b", "/xyz/"))
    urls = ["u://a.b", "u://c.b/xyz/1", "u://c.b/xy", "u://a.b/xy", "u://b/x", "u://q"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: (r.url_filter.rule, r.url_filter.verdict) for r in url_filter.judged(pages, rules).collect()}
    assert got == {
        "u://a.b": ("a.b", "block"),
        "u://c.b/xyz/1": ("b/xyz/", "block"),
        "u://c.b/xy": ("b/xy", "allow"),
        "u://a.b/xy": ("b/xy", "allow"),
        "u://b/x": (None, "allow"),
        "u://q": (None, "allow"),
    }
