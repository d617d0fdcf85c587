import hashlib
import random

import pytest
from pyspark.sql import functions as F

import fixtures
from tillmark.llm import decontaminate, queries, words

ITEMS = "item_id long, text string"


def brute(texts, items, window=10):
    grams = {}
    for number, text in items:
        own = fixtures.words(text, fixtures.LETTERS)
        size = min(window, len(own))
        for i in range(len(own) - size + 1) if size else []:
            grams.setdefault(tuple(own[i : i + size]), set()).add(number)
    sizes = {len(g) for g in grams}
    out = []
    for text in texts:
        own = fixtures.words(text, fixtures.LETTERS)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if tuple(own[i : i + size]) in grams:
                    hit.update(range(i, i + size))
                    found |= grams[tuple(own[i : i + size])]
        out.append((len(own), len(hit), sorted(str(f) for f in found if f is not None)))
    return out


def items(rng, texts):
    found = [(1, "One"), (2, None), (3, ""), (4, "two three"), (None, "abc abd abe")]
    for number in range(10, 40):
        own = (rng.choice(texts) or "").split()
        start = rng.randrange(max(1, len(own)))
        found.append((number, " ".join(own[start : start + rng.randint(1, 25)])))
    return found


@pytest.mark.parametrize("block", [8_000_000, 400])
def test_windows_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_TEXT", block)
    rng = random.Random(3)
    rows = fixtures.rows()
    found_items = items(rng, [r[1] for r in rows if r[1]])
    documents = fixtures.clashing(spark)
    out = decontaminate.contamination(documents, spark.createDataFrame(found_items, ITEMS))
    fixtures.kept_clashes(documents, out)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    got = sorted([(r.doc_id, r.contamination.n_words, r.contamination.n_hit, r.contamination["items"]) for r in out.collect()], key=key)
    want = sorted([(r[0], *b) for r, b in zip(rows, brute([r[1] for r in rows], found_items))], key=key)
    assert got == want


def test_no_window_is_left_and_clean_rows_stay(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    texts = [f"before {passage} after it all comes some more text that is clean and long enough to stay for sure", passage]
    # What is left of the first removal makes up a window again.
    texts.append(" ".join(f"w{i}" for i in range(6)) + f" {passage} " + " ".join(f"w{i}" for i in range(6, 14)) + " and " * 60)
    documents = fixtures.documents(spark, [(100 + i, t, "en", "a", 0) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame([(1, passage)], ITEMS)
    out = decontaminate.decontaminated(documents, benchmark)
    assert out.columns == documents.columns
    again = decontaminate.contamination(out, benchmark)
    assert again.where("contamination.n_hit > 0").count() == 0
    kept = {r.doc_id: r.text for r in out.collect()}
    assert 101 not in kept and kept[100].startswith("before") and "after it all" in kept[100]
    clean = documents.where("doc_id < 100 or doc_id is null")
    assert clean.exceptAll(out).count() == 0 and out.count() == documents.count() - 1


def test_several_blocks_clean_as_one_does(spark, monkeypatch):
    rng = random.Random(7)
    plain = [r[1] for r in fixtures.rows() if r[1] and len(r[1]) < 1000]
    passages = [(100 + i, " ".join(f"p{i}q{j}" for j in range(18))) for i in range(12)]
    found_items = items(rng, plain) + passages
    rows = []
    for i in range(60):  # of several items, which no single block hits by half; side by side, or inside each other
        first, second, third = (p.split() for _, p in rng.sample(passages, 3))
        own = first + ([",", "-"] if i % 2 else ["mid"]) + second + [f"f{j}" for j in range(rng.randint(20, 140))]
        at = rng.randint(1, 17)
        own += third[:at] + rng.choice([first, second]) + third[at:] + ["end"]
        rows.append((200 + i, " ".join(own), "en", "a", 0))
    documents = fixtures.documents(spark, rows + rows[:3])
    benchmark = spark.createDataFrame(found_items, ITEMS)
    got = []
    for block in (8_000_000, 400):
        monkeypatch.setattr(decontaminate, "BLOCK_TEXT", block)
        out = decontaminate.decontaminated(documents, benchmark)
        assert out.columns == documents.columns
        got.append(sorted(map(repr, out.collect())))
    assert got[0] == got[1]
    stay = {r.doc_id for r in out.collect() if r.doc_id and r.doc_id >= 200}
    assert 10 < len(stay) < 50
    kept = [r.text for r in out.collect()]
    assert not any(hit for _, hit, _ in brute(kept, found_items))


def test_automata_are_packed_and_built_in_tasks(spark, monkeypatch):
    """Some 15 bytes a character, and none is built on the driver."""
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(50_000)}" for _ in range(60_000))
    packed = decontaminate.ItemAutomaton([("a", words.hash_text(text, words.LETTERS))], 10).packed()
    assert len(packed) < 20 * len(text)
    monkeypatch.setattr(decontaminate, "BLOCK_TEXT", 400)
    found_items = [(i, f"{i} a b c d e f g h i j k {i}") for i in range(100)]
    benchmark = spark.createDataFrame(found_items, ITEMS)
    built = []
    monkeypatch.setattr(decontaminate.ItemAutomaton, "_pack", lambda self: built.append(self))
    sent = list(decontaminate._blocks_of_items(benchmark, "item_id", "text", 10))
    assert len(sent) > 3 and not built


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(fixtures.documents(spark), none).where("contamination.n_hit > 0").count() == 0
    assert decontaminate.contamination(fixtures.empty(spark), none).count() == 0
    assert decontaminate.decontaminated(fixtures.empty(spark), none).count() == 0


def test_query_names_items(spark, tmp_path):
    item = " ".join(f"q{i}" for i in range(12))
    spark.createDataFrame([(1, f"x {item}"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, item), (9, item.upper())], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    first, second = queries.op1_decontamination(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert (first.n_words, first.n_hit, first.n_items, first.contaminated) == (13, 12, 2, True)
    assert first.items_sha256 == hashlib.sha256(b"10,9").hexdigest()
    assert (second.n_words, second.n_hit, second.items_sha256) == (0, 0, hashlib.sha256(b"").hexdigest())
