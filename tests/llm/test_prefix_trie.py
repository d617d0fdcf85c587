"""The prefix trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tillmark.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed=3):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):  # many common openings, nested conversations, copies
        texts = [rng.choice("abc") * rng.randint(1, 2) for _ in range(rng.randint(0, 6))]
        rows += [(conv, t, rng.choice(["user", "user", None]), x) for t, x in enumerate(texts)]
    rows += [(conv, t, "user", "same") for conv in range(100, 400) for t in range(3)]  # one large group of copies
    rows += [(conv, t, "user", "same" if t < 2 else f"é{conv}") for conv in range(400, 750) for t in range(3)]  # one opening
    rows += [(900, t, "user", f"{t}") for t in range(300)]
    rows += [(901 + n, t, "user", f"{t}") for n, size in enumerate((299, 1, 120)) for t in range(size)]
    rows += [(950, None, "a", "late"), (950, 0, None, None), (950, 0, "a", ""), (950, 0, None, None), (951, 0, "", "")]
    rows += [(-3, 0, "user", "same"), (-5, 0, "user", "same"), (None, 0, "user", "x"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def listed(rows):
    """Conversation to its turns in order, as the operator orders them."""
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found.setdefault(conv, []).append(((turn is not None, turn or 0, key), role, text))
    return {conv: [t[1:] for t in sorted(own)] for conv, own in found.items()}


def spliced(found):
    out = {}
    for conv, own in found.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (abs(conv) % 5) * (1 if conv >= 0 else -1)
        out[conv] = found.get(base, [])[:h] + own[h:]
    return out


def brute(found):
    members, children = {}, {}
    for conv, turns in found.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    below = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        leaves = [below[c] for c in children.get(path, [])]
        below[path] = (sum(x for x, _ in leaves) or 1, own + sum(s for _, s in leaves))
    out = []
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(found[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), len(children.get(path, [])), *below[path], sha))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(conversations(), SCHEMA).repartition(3)


@pytest.mark.parametrize("keys, ids, parts", [(4096, 1 << 16, 4), (3, 7, 4), (1, 1, 3), (5, 1 << 16, 40), (50, 20, 1)])
def test_nodes_equal_brute_force(spark, table, monkeypatch, keys, ids, parts):
    monkeypatch.setattr(prefix_trie, "CHUNK_KEYS", keys)
    monkeypatch.setattr(prefix_trie, "RUN_IDS", ids)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        turns = prefix_trie.turns(table)
        found = listed(conversations())
        assert rows_of(prefix_trie.trie(prefix_trie.sequences(turns))) == brute(found)
        conv = F.col("conv_id")
        h = F.crc32(conv.cast("string").cast("binary")) % 9
        members = prefix_trie.spliced_sequences(turns, conv - conv % 5, h)
        assert rows_of(prefix_trie.trie(members)) == brute(spliced(found))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_awkward_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.sequences(prefix_trie.turns(none))).count() == 0
    only_null = spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)
    assert prefix_trie.trie(prefix_trie.sequences(prefix_trie.turns(only_null))).count() == 0
    turnless = spark.createDataFrame([(b"", [], 7), (b"", [], 4)], "key binary, sizes array<int>, conv_id long")
    want = hashlib.sha256(b"4,7").hexdigest()
    assert rows_of(prefix_trie.trie(turnless)) == [(4, 0, None, 2, 0, 1, 0, want)]
    more = spark.createDataFrame(conversations(), SCHEMA).selectExpr("*", "1 as key", "2 as sizes", "3 as id", "4 as node")
    assert rows_of(prefix_trie.trie(prefix_trie.sequences(prefix_trie.turns(more)))) == brute(listed(conversations()))


def test_a_very_long_turn_and_conversation(spark):
    rows = [(1, 0, "user", "x" * 1_000_000)] + [(2, t, "user", "y") for t in range(5000)]
    rows += [(3, t, "user", "y") for t in range(4000)]
    got = prefix_trie.trie(prefix_trie.sequences(prefix_trie.turns(spark.createDataFrame(rows, SCHEMA)))).collect()
    assert len(got) == 5002
    root = next(r for r in got if r.depth == 0)
    assert (root.n_convs, root.n_children, root.n_leaves, root.saved_tokens) == (3, 2, 2, 4000)


def test_layouts_grow_and_keep_order():
    for size, layout in ((4, 4), (5, 16), (17, 48), (49, 256), (256, 256)):
        order = list(range(256))[:size]
        random.Random(size).shuffle(order)
        node = prefix_trie.Node(b"")
        for byte in order:
            node.add(byte, prefix_trie.Node(bytes([byte])))
        assert node.layout == layout
        assert [c.prefix[0] for c in node.in_order()] == sorted(order)
        node.replace(order[0], prefix_trie.Node(b"new"))
        assert node.child(order[0]).prefix == b"new"
        assert (node.child(255) is None) == (255 not in order)


@pytest.mark.parametrize("width", [1, 2, 5])
def test_only_aligned_depths_are_nodes(width):
    rng = random.Random(width)
    keys = sorted({bytes(rng.choice(b"\x00\x01\xff") for _ in range(width * rng.randint(0, 5))) for _ in range(200)})
    depths, parents, firsts, ends = prefix_trie.turn_nodes(keys, width)
    paths = [keys[f][: d * width] for d, f in zip(depths, firsts)]
    assert sorted(paths) == sorted({k[: d * width] for k in keys for d in range(len(k) // width + 1)})
    assert [None if p < 0 else paths[p] for p in parents] == [q[:-width] if q else None for q in paths]
    assert [keys[e] if e >= 0 else None for e in ends] == [q if q in keys else None for q in paths]
    assert all(next(k for k in keys if k.startswith(q)) == keys[f] for q, f in zip(paths, firsts))
