"""Samples for fitting are bounded whatever the keys are."""

import random

from tillmark.llm import html_extract
from tillmark.llm.learning import bounded_sample


def test_sample_is_bounded_for_null_repeated_and_copied_rows(spark):
    rows = [(None, f"n{i}") for i in range(1000)] + [(7, f"r{i}") for i in range(1000)] + [(i, "u") for i in range(1000)]
    rows += [(9, "copy")] * 1000
    random.Random(2).shuffle(rows)
    table = spark.createDataFrame(rows, "id long, text string")
    got = [sorted(map(repr, bounded_sample(table.repartition(n), 100, "id").collect())) for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == len(set(got[0])) == 100
    assert any("id=None" in r for r in got[0]) and any("id=7," in r for r in got[0]) and any("text='u'" in r for r in got[0])
    assert bounded_sample(table, 4000, "id").count() == 4000
    copies = spark.createDataFrame([(i % 20, "c") for i in range(2000)], "id long, text string")
    assert bounded_sample(copies, 100, "id").count() == 20


def test_pages_without_id_are_sampled_too(spark, monkeypatch):
    monkeypatch.setattr(html_extract, "MAX_PAGES", 50)
    seen = []
    monkeypatch.setattr(html_extract, "training_pages", lambda pages: seen.extend(pages))
    rows = [(None if i % 3 else i, f"<p>{i}</p>") for i in range(900)]
    assert html_extract.fit(spark.createDataFrame(rows, "page_id long, html string")) is None
    assert len(seen) == 50
