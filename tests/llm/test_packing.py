import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import fixtures
from tillmark.llm import packing, words


def brute(sizes, capacities):
    """Best fit by looking at every open bin."""
    room, used, where = [], [], {}
    left = int(sum(sizes))
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = int(sizes[i])
        left -= size
        fitting = [b for b in range(len(room)) if room[b] >= size]
        if fitting:
            b = min(fitting, key=lambda b: (room[b], b))
        else:
            b = len(room)
            room.append(packing.opened(size, left, capacities))
            used.append(0)
        where[i] = (b, used[b])
        used[b] += size
        room[b] -= size
    return where, [min(c for c in capacities if c >= u) for u in used]


@pytest.mark.parametrize("seed", range(4))
def test_bins_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    capacities = (64, 128, 256)
    sizes = rng.integers(0, 257, 400)
    bins, offsets, held = packing.pack(sizes, capacities)
    where, want = brute(sizes, capacities)
    assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == [where[i] for i in range(len(sizes))]
    assert held.tolist() == want


@pytest.mark.parametrize("shard", [100_000, 7])
def test_every_token_is_placed_once(spark, monkeypatch, shard):
    monkeypatch.setattr(packing, "SHARD", shard)
    documents = fixtures.clashing(spark)
    rows = packing.packed(documents, packing.word_tokens(F.col("text"))).collect()
    lengths = {}
    for row in documents.select("doc_id", packing.word_tokens(F.col("text")).alias("n")).collect():
        lengths.setdefault(row.doc_id, []).append(row.n or 0)
    placed = {}
    bins = {}
    for r in rows:
        placed[r.doc_id] = placed.get(r.doc_id, 0) + r.n_tokens
        bins.setdefault(r.bin_id, []).append(r)
    assert placed == {k: sum(v) for k, v in lengths.items()}
    for own in bins.values():
        own.sort(key=lambda r: (r.bin_offset, r.n_tokens))
        ends = [r.bin_offset + r.n_tokens for r in own]
        assert [r.bin_offset for r in own] == [0, *ends[:-1]]
        assert {r.bin_capacity for r in own} == {min(c for c in packing.CAPACITIES if c >= ends[-1])}


TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"


@pytest.mark.parametrize("block", [1 << 22, 8])
def test_token_counts_equal_the_pattern(monkeypatch, block):
    monkeypatch.setattr(words, "BLOCK_BYTES", block)
    rng = np.random.default_rng(2)
    texts = [r[1] for r in fixtures.rows()] + ["a", "a", "-", "aé b--c\x7f\x00d", "é", " "]
    texts += ["".join(rng.choice(list("aZ0é -_\n~\x7f"), rng.integers(0, 12))) for _ in range(300)]
    found = [len(re.findall(TOKEN, t or "")) for t in texts]
    assert packing.token_counts(pa.array(texts)).tolist() == [n + 1 if n else 0 for n in found]
    assert packing.token_counts(pa.array([], pa.string())).tolist() == []


def test_several_lengths_are_in_use_and_nearly_full():
    sizes = np.random.default_rng(1).integers(20, 3000, 3000)
    bins, _, held = packing.pack(sizes, packing.CAPACITIES)
    assert len(set(held.tolist())) > 1
    assert sizes.sum() / held.sum() > 0.97
    one, _, alone = packing.pack(sizes, packing.CAPACITIES[-1:])
    costs = [sum(packing.default_cost(int(c)) for c in h) for h in (held, alone)]
    assert costs[0] < costs[1]


def test_empty_table_and_bad_capacities(spark):
    assert packing.packed(fixtures.empty(spark), F.lit(5)).count() == 0
    with pytest.raises(ValueError):
        packing.packed(fixtures.empty(spark), F.lit(5), capacities=())
