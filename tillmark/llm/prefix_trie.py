"""Prefix trie of conversations, built from adaptive radix trees over turn ids.

A turn (role and text) has an id of sixteen bytes, most significant byte first; a conversation's key is the ids of its
turns one after the other.  Keys are sorted over the cluster by (key, conversation), so that copies of one conversation
and conversations with one common opening are spread over tasks however many they are.  A task goes through its run
of keys in chunks of bounded size and puts each chunk into an adaptive radix tree: nodes grow from 4 over 16 and 48 to
256 children, and bytes without a branch are kept as one compressed path.  Most nodes of that tree lie inside a turn;
only byte depths that are a multiple of the id's width are nodes of the trie.

A node whose conversations all lie in one chunk is finished there.  The others are prefixes of a chunk's first or last
key; chunks count a shared node's text, its leaves and its place among its parent's children only where they meet it
first, so that what remains is one sum for each shared node.  Where a run begins, the task cannot see the key
before; one row for each task tells the overlap of neighbouring runs, and what was counted twice is taken back.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.shared import stored

WIDTH = 16  # bytes of a turn id
CHUNK_KEYS, CHUNK_BYTES = 4096, 4 << 20
RUN_IDS = 1 << 16  # conversations of one key that are written as one piece of its digest
SALTS = 32
OUT_ROWS = 8192

ROWS = (
    "kind int, node binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends string, first_key binary, last_key binary, "
    "sizes array<int>, task int"
)
CLOSED, OPEN, PIECE, RUN = range(4)
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Node:
    """A node of the radix tree.

    ``prefix`` is the compressed path between the branch above and this node.  Up to 4 or 16 children stand in the
    order of their bytes; up to 48 are found by a table of 256 slots, more by their byte alone.
    """

    __slots__ = ("prefix", "value", "layout", "keys", "children")

    def __init__(self, prefix: bytes, value: int | None = None):
        self.prefix, self.value = prefix, value
        self.layout, self.keys, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            place = self.keys.find(byte)
            return self.children[place] if place >= 0 else None
        if self.layout == 48:
            slot = self.keys[byte]
            return self.children[slot - 1] if slot else None
        return self.children[byte]

    def add(self, byte: int, child: Node) -> None:
        if self.layout == 256:
            self.children[byte] = child
            return
        if len(self.children) == self.layout:
            self._grow()
            self.add(byte, child)
        elif self.layout == 48:
            self.children.append(child)
            self.keys[byte] = len(self.children)
        else:
            place = bisect_left(self.keys, byte)
            self.keys.insert(place, byte)
            self.children.insert(place, child)

    def replace(self, byte: int, child: Node) -> None:
        if self.layout <= 16:
            self.children[self.keys.index(byte)] = child
        elif self.layout == 48:
            self.children[self.keys[byte] - 1] = child
        else:
            self.children[byte] = child

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
        elif self.layout == 16:
            slots = bytearray(256)
            for slot, byte in enumerate(self.keys):
                slots[byte] = slot + 1
            self.layout, self.keys = 48, slots
        else:
            table: list[Node | None] = [None] * 256
            for byte, slot in enumerate(self.keys):
                if slot:
                    table[byte] = self.children[slot - 1]
            self.layout, self.keys, self.children = 256, bytearray(), table

    def in_order(self) -> list[Node]:
        if self.layout == 48:
            return [self.children[slot - 1] for slot in self.keys if slot]
        return [child for child in self.children if child is not None]


def common(a: bytes, b: bytes) -> int:
    """How many leading bytes are equal."""
    size = min(len(a), len(b))
    if a[:size] == b[:size]:
        return size
    low, high = 0, size
    while low < high:  # the first ``low`` bytes agree, the first ``high + 1`` do not
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def radix_tree(keys: list[bytes]) -> Node:
    """The tree of different keys; the value of a key is its place in the list."""
    root = Node(b"")
    for value, key in enumerate(keys):
        node, above, at = root, None, 0
        while True:
            path = node.prefix
            if path and not key.startswith(path, at):
                same = common(path, key[at : at + len(path)])
                fork = Node(path[:same])
                above.replace(key[at - 1], fork)
                node.prefix = path[same + 1 :]
                fork.add(path[same], node)
                at += same
                if at == len(key):
                    fork.value = value
                else:
                    fork.add(key[at], Node(key[at + 1 :], value))
                break
            at += len(path)
            if at == len(key):
                node.value = value
                break
            below = node.child(key[at])
            if below is None:
                node.add(key[at], Node(key[at + 1 :], value))
                break
            node, above, at = below, node, at + 1
    return root


def turn_nodes(keys: list[bytes], width: int = WIDTH) -> tuple[list[int], list[int], list[int], list[int]]:
    """Depth, place of the parent (-1: none), first key below, and number of the key that ends there (-1: none) of
    every node at a byte depth that is a multiple of ``width``; a parent comes before its children.

    ``keys`` are sorted and different, their lengths multiples of ``width``.
    """
    depths, parents, firsts, ends = [], [], [], []
    seen = 0
    todo = [(radix_tree(keys), -1, -1)]  # node, byte depth of the branch above, the trie's node above
    while todo:
        node, start, above = todo.pop()
        stop = start + 1 + len(node.prefix)
        for at in range((start // width + 1) * width, stop + 1, width):
            depths.append(at // width)
            parents.append(above)
            firsts.append(seen)
            ends.append(-1)
            above = len(depths) - 1
        if node.value is not None:
            ends[above] = node.value
            seen += 1
        todo += [(child, stop, above) for child in reversed(node.in_order())]
    return depths, parents, firsts, ends


def path_ids(key: bytes) -> list[bytes]:
    """A digest of every turn-aligned prefix of ``key``, the empty one first."""
    running = hashlib.blake2b(digest_size=16)
    found = [running.digest()]
    for at in range(0, len(key), WIDTH):
        running.update(key[at : at + WIDTH])
        found.append(running.digest())
    return found


@dataclass
class _Run:
    """The conversations of one key, as far as they are read."""

    key: bytes
    sizes: list[int]
    least: int
    count: int = 0
    ids: list[int] = field(default_factory=list)
    split: bool = False  # pieces of the digest are written already


class _Chunks:
    """Rows of one task's sorted run of keys."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.runs: list[_Run] = []
        self.held = 0
        self.before: bytes | None = None  # last key of the chunk before
        self.first: _Run | None = None

    def piece(self, run: _Run, node: bytes | None = None) -> None:
        node = path_ids(run.key)[-1] if node is None else node
        text = ",".join(map(str, run.ids))
        self.rows.append((PIECE, node, None, None, run.ids[0], *[None] * 5, text, *[None] * 4))
        run.ids = []

    def finish(self, following: bytes | None) -> None:
        """Write the nodes of the runs held; ``following`` is the next key, None where the task cannot see it."""
        runs, keys = self.runs, [r.key for r in self.runs]
        depths, parents, firsts, ends = turn_nodes(keys)
        n = len(depths)
        shared_before = n if self.before is None else common(self.before, keys[0]) // WIDTH
        shared_after = n if following is None else common(keys[-1], following) // WIDTH
        counts, least, children, leaves, saved = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        is_open = [False] * n
        last = next(i for i in range(n - 1, -1, -1) if ends[i] == len(keys) - 1)
        at = last
        while at >= 0:  # the path of the last key
            is_open[at] = depths[at] <= shared_after
            at = parents[at]
        for i in range(n - 1, -1, -1):
            end = ends[i]
            if end >= 0:
                run = runs[end]
                least[i] = min(least[i], run.least) if counts[i] else run.least
                counts[i] += run.count
                is_open[i] |= run.split
                # The following key is the only one that could still extend the last.
                if not children[i] and not (i == last and following is not None and following.startswith(run.key)):
                    leaves[i] += 1
            depth = depths[i]
            on_first = firsts[i] == 0
            known = on_first and self.before is not None and depth <= shared_before
            is_open[i] |= on_first and depth <= shared_before
            size = runs[firsts[i]].sizes[depth - 1] if depth else 0
            saved[i] += (counts[i] - (not known)) * size
            above = parents[i]
            if above >= 0:
                least[above] = min(least[above], least[i]) if counts[above] else least[i]
                counts[above] += counts[i]
                # A child that the chunk before has met too is told apart below, once its count is used.
                children[above] += 1
                leaves[above] += leaves[i]
                saved[above] += saved[i]
        if self.before is not None:
            at = next(i for i in range(n) if ends[i] == 0)
            while at >= 0:
                if parents[at] >= 0 and depths[at] <= shared_before:
                    children[parents[at]] -= 1
                at = parents[at]
        self._write(depths, parents, firsts, ends, is_open, (least, counts, children, leaves, saved))
        self.before = keys[-1]
        self.runs, self.held = [], 0

    def _write(self, depths, parents, firsts, ends, is_open, values) -> None:
        least, counts, children, leaves, saved = values
        ids: dict[int, list[bytes]] = {}  # of few keys: only shared nodes need one

        def digest(i: int) -> bytes:
            if firsts[i] not in ids:
                ids[firsts[i]] = path_ids(self.runs[firsts[i]].key)
            return ids[firsts[i]][depths[i]]

        for i, depth in enumerate(depths):
            run = self.runs[ends[i]] if ends[i] >= 0 else None
            above = parents[i]
            outside = above >= 0 and is_open[above]
            node = ends_digest = None
            if is_open[i]:
                node = digest(i)
                if run and run.ids:
                    self.piece(run, node)
            else:
                ends_digest = hashlib.sha256(",".join(map(str, run.ids)).encode()).hexdigest() if run else NO_ENDS
            self.rows.append(
                (
                    OPEN if is_open[i] else CLOSED,
                    node,
                    digest(above) if outside else None,
                    depth,
                    least[i],
                    least[above] if above >= 0 and not outside else None,
                    counts[i],
                    children[i],
                    leaves[i],
                    saved[i],
                    ends_digest,
                    *[None] * 4,
                )
            )

    def read(self, key: bytes, sizes, conv_id: int) -> None:
        run = self.runs[-1] if self.runs else None
        if run is None or run.key != key:
            if run is not None and (len(self.runs) >= CHUNK_KEYS or self.held >= CHUNK_BYTES):
                self.finish(key)
            run = _Run(key, sizes.as_py(), conv_id)
            self.first = self.first or _Run(key, run.sizes, conv_id)
            self.runs.append(run)
            self.held += 2 * len(key) + 64
        run.count += 1
        run.ids.append(conv_id)
        if len(run.ids) >= RUN_IDS:
            run.split = True
            self.piece(run)

    def batches(self, schema: pa.Schema, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) > least:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self.rows), schema)]
            self.rows = []
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


_ARROW = pa.schema(
    [("kind", pa.int32()), ("node", pa.binary()), ("parent", pa.binary())]
    + [(c, pa.int64()) for c in "depth conv_id parent_conv_id n_convs n_children n_leaves saved_tokens".split()]
    + [("ends", pa.string()), ("first_key", pa.binary()), ("last_key", pa.binary())]
    + [("sizes", pa.list_(pa.int32())), ("task", pa.int32())]
)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of one sorted run: key, sizes, conv_id, task."""
    chunks, task = _Chunks(), None
    for batch in batches:
        keys, sizes, ids = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
        if keys and task is None:
            task = batch.column(3)[0].as_py()
        for place, key in enumerate(keys):
            chunks.read(key, sizes[place], ids[place])
            if len(chunks.rows) > OUT_ROWS:
                yield from chunks.batches(_ARROW, OUT_ROWS)
    if chunks.runs:
        chunks.finish(None)
        first = chunks.first
        chunks.rows.append((RUN, *[None] * 10, first.key, chunks.before, first.sizes, task))
    yield from chunks.batches(_ARROW, 0)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What neighbouring runs count twice: the last key of the run before, a run's first key and its sizes."""
    for batch in batches:
        rows = []
        for last, first, sizes in zip(*(batch.column(c).to_pylist() for c in range(3))):
            shared = common(last, first) // WIDTH
            extended = -1 if shared * WIDTH == len(last) else 0
            ids, text = path_ids(first[: shared * WIDTH]), 0
            for depth in range(shared, -1, -1):
                text += sizes[depth - 1] if depth else 0
                rows.append((ids[depth], 0, -1 if depth < shared else 0, extended, text))
        columns = list(zip(*rows)) if rows else [()] * 5
        types = [pa.binary(), *[pa.int64()] * 4]
        names = ["node", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each node from its pieces in order; a piece is read and let go."""
    node, running, out = None, None, []
    for batch in batches:
        for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            if own != node:
                if node is not None:
                    out.append((node, running.hexdigest()))
                node, running = own, hashlib.sha256()
            else:
                running.update(b",")
            running.update(text.as_py().encode())
    if node is not None:
        out.append((node, running.hexdigest()))
    columns = list(zip(*out)) if out else [(), ()]
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["node", "ends"])


def turn_id(role: Column, text: Column) -> Column:
    """Id of a turn as hexadecimal digits; null counts as empty."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def turns(
    conversations: DataFrame,
    *,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """conv_id, turn, id, size (UTF-8 bytes of the text) of every row; the text itself goes no further.

    Rows without a conversation belong to none and are left out.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = conversations.where(F.col(id_column).isNotNull())
    return rows.select(
        F.col(id_column).cast("long").alias("conv_id"),
        F.col(turn_column).alias("turn"),
        turn_id(F.col(role_column), text).alias("id"),
        F.octet_length(text).alias("size"),
    )


def _keyed(ordered: Column) -> list[Column]:
    key = F.unhex(F.array_join(F.transform(ordered, lambda t: t["id"]), ""))
    return [key.alias("key"), F.transform(ordered, lambda t: t["size"]).alias("sizes")]


def sequences(rows: DataFrame) -> DataFrame:
    """conv_id, key and sizes of every conversation of ``turns``, by turn (null first, of equal ones by id)."""
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "size"))).alias("own"))
    return own.select("conv_id", *_keyed(F.col("own")))


def spliced_sequences(rows: DataFrame, family: Column, opening: Column) -> DataFrame:
    """Like ``sequences``, but a conversation takes its first ``opening`` turns from the one that ``family`` names.

    Conversations of one family meet in one row, so a family must be few conversations; the one it is named after need
    not be there.  A conversation without turns of its own beyond its opening keeps that opening alone.
    """
    turn = F.struct("conv_id", "turn", "id", "size")
    met = rows.groupBy(family.alias("family")).agg(F.sort_array(F.collect_list(turn)).alias("all"))
    each = met.select("family", "all", F.explode(F.array_distinct(F.col("all.conv_id"))).alias("conv_id"))
    of = lambda name: F.filter("all", lambda t: t["conv_id"] == F.col(name))
    parts = each.select("conv_id", of("family").alias("base"), of("conv_id").alias("own"), opening.cast("int").alias("h"))
    return parts.select(
        "conv_id",
        *_keyed(
            F.concat(
                F.slice("base", F.lit(1), F.col("h")),
                F.slice("own", F.col("h") + 1, F.size("own")),
            )
        ),
    )


def trie(members: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of ``members`` (conv_id long, key binary, sizes array<int>; one row a conversation).

    conv_id, the smallest conversation of the node; depth; parent_conv_id (null at the root); n_convs; n_children;
    n_leaves, childless nodes of its subtree, itself included; saved_tokens, over its subtree the size of each node's
    turn for every conversation but one; ends_sha256, of the conversations that end there.  A conversation without
    turns ends at the root; no conversation gives no node.  Conversations may be alike in any number, nested, or of any
    length that one row holds.
    """
    spark = members.sparkSession
    members = stored(members.select("key", "sizes", "conv_id"))  # sampled for the ranges, then read again
    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    run = members.repartitionByRange(tasks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    run = run.select("key", "sizes", "conv_id", F.spark_partition_id().alias("task"))
    rows = stored(run.mapInArrow(_nodes, ROWS))
    kind = F.col("kind")

    # One row for each task: a window over all of them is as small as the number of tasks.
    neighbours = rows.where(kind == RUN).select("task", "first_key", "last_key", "sizes")
    neighbours = neighbours.withColumn("before", F.lag("last_key").over(Window.orderBy("task"))).where("before is not null")
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    twice = neighbours.select("before", "first_key", "sizes").mapInArrow(
        _overlaps, "node binary, n_convs long, n_children long, n_leaves long, saved_tokens long"
    )
    parts = rows.where(kind == OPEN).select("node", "parent", "depth", "conv_id", "parent_conv_id", *sums)
    shared = (
        parts.unionByName(twice, allowMissingColumns=True)
        .groupBy("node")
        .agg(
            *[F.max(c).alias(c) for c in ("parent", "depth", "parent_conv_id")],
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )
    pieces = rows.where(kind == PIECE).select("node", "ends", F.col("conv_id").alias("first"))
    digests = pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "ends")
    digests = digests.mapInArrow(_joined_digests, "node binary, ends string")
    shared = stored(shared.join(digests, "node", "left"))

    # A shared node may have very many finished children: they meet its name salted.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    names = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("name"), salts.alias("salt"))
    whole = ["depth", "conv_id", "parent_conv_id", *sums, "ends"]
    closed = rows.where(kind == CLOSED).select("parent", *whole)
    below = closed.where("parent is not null").unionByName(shared.where("parent is not null").select("parent", *whole))
    below = below.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int"))
    below = below.join(names, ["parent", "salt"]).withColumn("parent_conv_id", F.col("name")).select(*whole)
    found = below.unionByName(closed.where("parent is null").select(*whole))
    found = found.unionByName(shared.where("parent is null").select(*whole))
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        *sums,
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
