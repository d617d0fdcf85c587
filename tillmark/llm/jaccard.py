"""N-gram Jaccard join with signature trees.

Two texts link when their sets of word shingles have a Jaccard similarity of at least the threshold.  The join is
exact and runs in four steps.

1. *Sets.*  Texts with the same set are one set from here on; nothing is ever expanded into pairs of copies.
2. *Blocks.*  Linked sets of *a* and *b* shingles differ in at most ``D = (a + b)(1 - t)/(1 + t)`` shingles.  The hash
   space is cut into more than *D* parts, so linked sets agree completely in at least one part.  A set's parts are its
   block keys.  Parts that hold hardly a shingle say little; some are left out, and as many parts more than needed are
   cut, so that one that says more always remains.  An empty part says nothing but that all shingles are in the others: it
   is replaced by the parts of another cut of the whole set, of which linked sets agree in one for the same reason.  How many parts there are depends on the size class of the set, and
   every set is cut for its own class and the next one.  (For thresholds well below 0.9 the parts get too small to say
   anything; another source of block keys can be given, such as MinHash bands.)
3. *Groups.*  Sets that share a block are candidates; connected candidates form a group.  Large groups are cut into
   tiles by size class and hash, and tiles of neighbouring classes meet in pairs.
4. *Signature trees.*  Each tile becomes a tree whose nodes hold the OR of their sets' token bitmaps and the range of
   their sizes.  Two trees are walked at once; a pair of nodes is left as soon as its sizes do not fit or the bits that
   both have cannot add up to the overlap needed.  Pairs of sets that are left are counted exactly.  As the result is
   components, a pair of nodes that already lies in one component is left as well.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm import words
from tillmark.llm.components import components
from tillmark.llm.shared import stored, text_key

SHINGLE = 3
THRESHOLD = Fraction(90, 100)
TILE_SHINGLES = 2_000_000  # 16 MB of sets
# What a set adds to a tile besides its shingles: at most 4,000 sets meet in a task, as their pairs may have to be looked at.
SET_WEIGHT = 500
SALTS = 256  # over which the copies of one set are spread
LEAF, FANOUT = 8, 4
TREE_BITS, LEAST_BITS = 1 << 29, 1 << 10
WEAK = 3  # a part with fewer shingles says little
DEPTH = 3  # how often an empty part is replaced by parts of another cut

Signer = Callable[[words.Block, np.ndarray, np.ndarray, np.ndarray], list[np.ndarray]]


class Parts:
    """Block keys of shingle sets: their parts, for a given threshold."""

    def __init__(self, threshold: Fraction):
        self.threshold = threshold

    def size_class(self, size: int) -> int:
        """Sizes of linked sets are in the same or in neighbouring classes."""
        low, number = 1, 0
        while True:
            low = max(low + 1, -(-low * self.threshold.denominator // self.threshold.numerator))
            if size < low:
                return number
            number += 1

    def top(self, number: int) -> int:
        """The largest size in class ``number``."""
        low = 1
        for _ in range(number + 1):
            low = max(low + 1, -(-low * self.threshold.denominator // self.threshold.numerator))
        return low - 1

    def cuts(self, number: int) -> tuple[int, int]:
        """Parts, and how many weak ones may be left out, for sets of classes ``number`` and ``number - 1``."""
        t = self.threshold
        differ = int(2 * self.top(number) * (1 - t) / (1 + t))
        spare = 0 if differ < 8 else 1 + differ // 20
        return differ + 1 + spare, spare

    def __call__(self, block: words.Block, hashes: np.ndarray, bounds: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(words.mix(hashes), out=sums[1:])
        out: list[np.ndarray] = [np.zeros(0, np.uint64)] * (len(bounds) - 1)
        known: dict[int, tuple[np.ndarray, int, np.ndarray]] = {}
        for row in np.flatnonzero(wanted):
            low, high = bounds[row], bounds[row + 1]
            if low == high:
                continue
            own, found = hashes[low:high], []
            first = self.size_class(high - low)
            for number in (first, first + 1):
                if number not in known:
                    parts, spare = self.cuts(number)
                    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
                    known[number] = edges, spare, words.mix(np.arange(parts, dtype=np.uint64) + np.uint64(number << 32))
                edges, spare, names = known[number]
                at = np.concatenate(([0], np.searchsorted(own, edges), [high - low]))
                keys = words.mix((sums[low + at[1:]] - sums[low + at[:-1]]) ^ names)
                weak = np.diff(at) < WEAK
                if weak.sum() <= spare:
                    found.append(keys[~weak])
                    continue
                empty = np.diff(at) == 0
                found.append(keys[~empty])
                found.extend(_cut_again(own, name, edges, DEPTH) for name in names[empty])
            out[row] = np.concatenate(found)
        return out


def _cut_again(own: np.ndarray, name: np.uint64, edges: np.ndarray, depth: int) -> np.ndarray:
    """Keys of the parts of another cut of a set, which ``name`` decides; what is empty there is cut again."""
    other = np.sort(words.mix(own ^ name))
    sums = np.zeros(len(other) + 1, np.uint64)
    np.cumsum(words.mix(other), out=sums[1:])
    at = np.concatenate(([0], np.searchsorted(other, edges), [len(other)]))
    names = words.mix(np.arange(len(edges) + 1, dtype=np.uint64) ^ name)
    keys = words.mix((sums[at[1:]] - sums[at[:-1]]) ^ names)
    empty = np.diff(at) == 0
    if depth == 1 or not empty.any():
        return keys
    return np.concatenate([keys[~empty], *(_cut_again(own, one, edges, depth - 1) for one in names[empty])])


def _sets(block: words.Block, size: int):
    """Set hashes, bounds, and one number for each whole set."""
    hashes, bounds = words.distinct_sets(block, size)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(words.mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1:])
    counts = np.diff(bounds)
    whole = words.mix(sums[bounds[1:]] - sums[bounds[:-1]] + counts.astype(np.uint64))
    return hashes, bounds, counts, whole.view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    cuts = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=cuts[1:])
    values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(values.view(np.int64)))


def keyed(documents: DataFrame, id_column: str, text_column: str, size: int, signer: Signer) -> DataFrame:
    """id, text_key, set_id, n, salt and the block keys of every row; a set that a batch repeats has its keys once.

    The salt is a running number, so that copies, repeated rows included, are spread.
    """
    rows = documents.select(
        F.col(id_column).alias("id"), text_key(F.col(text_column)).alias("text_key"), F.col(text_column).alias("text")
    )

    def keys(batches):
        count = 0
        for batch in batches:
            seen: set[int] = set()
            for block in words.blocks(batch.column(2), words.SOLID):
                hashes, bounds, counts, whole = _sets(block, size)
                wanted = np.zeros(len(counts), bool)
                wanted[np.unique(whole, return_index=True)[1]] = True
                wanted &= counts > 0
                wanted &= ~np.isin(whole, list(seen)) if seen else True
                seen.update(whole[wanted].tolist())
                part = batch.slice(block.first, block.last - block.first)
                salt = ((count + np.arange(len(whole))) % SALTS).astype(np.int32)
                count += len(whole)
                arrays = [part.column(0), part.column(1), pa.array(whole), pa.array(counts), pa.array(salt)]
                arrays.append(_lists(signer(block, hashes, bounds, wanted)))
                yield pa.RecordBatch.from_arrays(arrays, ["id", "text_key", "set_id", "n", "salt", "keys"])

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(keys, f"id {kind}, text_key long, set_id long, n long, salt int, keys array<long>")


def _candidates(batches):
    """From rows (key, set_id) sorted by both: every set of a key with the key's smallest set."""
    key = first = None
    for batch in batches:
        keys, sets = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(keys):
            continue
        opens = np.ones(len(keys), bool)
        opens[1:] = keys[1:] != keys[:-1]
        opens[0] = key is None or keys[0] != key
        heads = np.where(opens, np.arange(len(keys)), 0)
        heads = np.maximum.accumulate(heads)
        smallest = sets[heads]
        if not opens[0]:
            smallest[: int(np.argmax(opens)) if opens.any() else len(keys)] = first
        key, first = keys[-1], smallest[-1]
        other = smallest != sets
        pairs = np.unique(np.stack([smallest[other], sets[other]], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])


class Tree:
    """A signature tree over sets: nodes of OR-combined bitmaps, size ranges and the most bits any set shares."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        self.maps = np.zeros((len(sets), bits // 64), np.uint64)
        for row, one in enumerate(sets):
            places = (one >> np.uint64(64 - (bits - 1).bit_length())).astype(np.int64)
            np.bitwise_or.at(self.maps[row], places >> 6, np.uint64(1) << (places & 63).astype(np.uint64))
        self.double = self.sizes - np.bitwise_count(self.maps).sum(axis=1).astype(np.int64)
        # A node is (first set, last set, children); sets are in order, so a node is a run of them.
        level = [(i, min(i + LEAF, len(sets)), ()) for i in range(0, len(sets), LEAF)]
        while len(level) > 1:
            level = [
                (level[i][0], level[min(i + FANOUT, len(level)) - 1][1], tuple(level[i : i + FANOUT]))
                for i in range(0, len(level), FANOUT)
            ]
        self.root = level[0]
        self.seen: dict[tuple, tuple] = {}

    def node(self, node: tuple):
        """(OR of the bitmaps, smallest size, largest size, most doubled bits)"""
        key = node[:2]
        if key not in self.seen:
            low, high = key
            sizes = self.sizes[low:high]
            either = np.bitwise_or.reduce(self.maps[low:high], axis=0)
            self.seen[key] = either, int(sizes.min()), int(sizes.max()), int(self.double[low:high].max())
        return self.seen[key]


class Forest:
    """Disjoint sets of the numbers 0 to n - 1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def roots(self, low: int, high: int) -> np.ndarray:
        at = self.parent[low:high]
        while True:
            up = self.parent[at]
            if (up == at).all():
                return at
            at = up

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)


def tree_join(left: Tree, right: Tree, shift: int, forest: Forest, num: int, den: int) -> None:
    """Join in ``forest`` what links between two trees; sets of ``right`` have numbers from ``shift`` on.

    For ``left is right`` each pair is met once.
    """
    same = left is right

    def least(a, b):
        """Shingles that two sets of sizes a and b share at least if they link."""
        return -(-num * (a + b) // (num + den))

    stack = [(left.root, right.root)]
    while stack:
        x, y = stack.pop()
        bits_x, low_x, high_x, double_x = left.node(x)
        bits_y, low_y, high_y, double_y = right.node(y)
        if high_x * den < num * low_y or high_y * den < num * low_x:
            continue
        one = same and x[:2] == y[:2]
        if not one:
            common = int(np.bitwise_count(bits_x & bits_y).sum()) + min(double_x, double_y)
            if common < least(low_x, low_y):
                continue
        roots_x, roots_y = forest.roots(x[0], x[1]), forest.roots(shift + y[0], shift + y[1])
        if (roots_x == roots_x[0]).all() and (roots_y == roots_x[0]).all():
            continue
        if x[2] or y[2]:
            xs = x[2] or (x,)
            ys = y[2] or (y,)
            pairs = [(a, b) for i, a in enumerate(xs) for b in ys[i if one else 0 :]]
            stack.extend(reversed(pairs))
            continue
        for i in range(x[0], x[1]):
            js = np.arange(max(y[0], i + 1) if one else y[0], y[1])
            if not len(js):
                continue
            shared = np.bitwise_count(left.maps[i] & right.maps[js]).sum(axis=1).astype(np.int64)
            shared += np.minimum(left.double[i], right.double[js])
            for j in js[shared >= least(left.sizes[i], right.sizes[js])]:
                if forest.root(i) == forest.root(shift + int(j)):
                    continue
                a, b = left.sets[i], right.sets[j]
                both = len(a) + len(b) - len(np.union1d(a, b))
                if den * both >= num * (len(a) + len(b) - both):
                    forest.join(i, shift + int(j))


def _ordered(ids: np.ndarray, sets: list[np.ndarray]) -> list[int]:
    """Alike sets next to each other: by size, then by their smallest hashes."""
    return sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:4].tolist(), int(ids[i])))


def joined_group(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Edges that span the components of one tile (``sides`` all 0) or of a pair of tiles (0 and 1)."""
    # Some 64 bits a shingle, as far as the bitmaps of all sets stay within TREE_BITS.
    bits = 64 * max(len(s) for s in sets)
    bits = max(LEAST_BITS, 1 << min((bits - 1).bit_length(), (TREE_BITS // len(sets)).bit_length() - 1))
    order = _ordered(ids, sets)
    parts = [[i for i in order if sides[i] == side] for side in (0, 1)]
    numbers = parts[0] + parts[1]
    forest = Forest(len(numbers))
    trees = [Tree([sets[i] for i in part], bits) for part in parts if part]
    if len(trees) == 2:
        tree_join(trees[0], trees[1], len(parts[0]), forest, num, den)
    elif not parts[1]:
        tree_join(trees[0], trees[0], 0, forest, num, den)
    return [(int(ids[numbers[r]]), int(ids[numbers[i]])) for i, r in enumerate(forest.roots(0, len(numbers))) if r != i]


def _tiles(members: DataFrame, parts: Parts) -> DataFrame:
    """members (set_id, grp, n) with the groups they are compared in: (tile, side), several for sets of large groups.

    A group within ``TILE_SHINGLES``, each set counted as ``SET_WEIGHT`` more than it has, is one tile.  Otherwise each size class is hashed into tiles of about that weight,
    and every tile meets itself, the other tiles of its class and those of the next class.
    """
    t = parts.threshold
    size_class = F.floor(F.log(F.col("n").cast("double")) / float(np.log(float(1 / t)))).cast("int")
    members = members.withColumn("cls", size_class)
    heavy = F.sum(F.col("n") + SET_WEIGHT)
    weight = members.groupBy("grp").agg(heavy.alias("total"))
    buckets = members.groupBy("grp", "cls").agg(
        F.greatest(F.lit(1), F.ceil(heavy / TILE_SHINGLES)).cast("int").alias("buckets")
    )
    after = buckets.select("grp", (F.col("cls") - 1).alias("cls"), F.col("buckets").alias("next_buckets"))
    before = buckets.select("grp", (F.col("cls") + 1).alias("cls"), F.col("buckets").alias("last_buckets"))
    small = F.col("total") <= TILE_SHINGLES
    bucket = F.pmod(F.xxhash64("set_id"), F.col("buckets")).cast("int")

    def tile(cls, one, other_cls, other, side):
        return F.struct(
            F.concat_ws(":", "grp", cls, one, other_cls, other).alias("tile"), F.lit(side).alias("side")
        )

    cls, none = F.col("cls"), F.array().cast("array<struct<tile:string,side:int>>")
    own = F.transform(
        F.sequence(F.lit(0), F.col("buckets") - 1),
        lambda k: tile(cls, F.least(k, bucket), cls, F.greatest(k, bucket), 0).withField(
            "side", F.when(k < bucket, 1).otherwise(0)
        ),
    )
    up = F.transform(
        F.sequence(F.lit(0), F.coalesce("next_buckets", F.lit(1)) - 1), lambda k: tile(cls, bucket, cls + 1, k, 0)
    )
    down = F.transform(
        F.sequence(F.lit(0), F.coalesce("last_buckets", F.lit(1)) - 1), lambda k: tile(cls - 1, k, cls, bucket, 1)
    )
    places = F.concat(
        own,
        F.when(F.col("next_buckets").isNotNull(), up).otherwise(none),
        F.when(F.col("last_buckets").isNotNull(), down).otherwise(none),
    )
    whole = F.array(F.struct(F.col("grp").cast("string").alias("tile"), F.lit(0).alias("side")))
    return (
        members.join(weight, "grp")
        .join(buckets, ["grp", "cls"])
        .join(after, ["grp", "cls"], "left")
        .join(before, ["grp", "cls"], "left")
        .select("set_id", F.when(small, whole).otherwise(places).alias("places"))
    )


def linked_sets(
    rows: DataFrame, documents: DataFrame, id_column: str, text_column: str, size: int, threshold: Fraction
) -> DataFrame:
    """(set_id, component) of every set that links with another one; ``rows`` as of ``keyed``, stored."""
    spread = rows.select(F.explode("keys").alias("key"), "set_id").repartition("key").sortWithinPartitions("key", "set_id")
    pairs = spread.mapInArrow(_candidates, "u long, v long")
    groups = components(pairs).select(F.col("node").alias("set_id"), F.col("component").alias("grp"))
    firsts = rows.where("n > 0").groupBy("set_id").agg(F.min("id").alias("first_id"), F.first("n").alias("n"))
    members = stored(groups.join(firsts, "set_id"))
    num, den = threshold.numerator, threshold.denominator
    kept = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # Texts are shuffled at every size: a plan that broadcasts the ids of few sets only shows its cost beyond them.
    wanted = members.select("first_id").distinct().hint("merge")
    kept = kept.join(wanted, F.col("id").eqNullSafe(F.col("first_id")), "left_semi")

    def sets(batches):
        for batch in batches:
            for block in words.blocks(batch.column(batch.schema.get_field_index("text")), words.SOLID):
                hashes, bounds, _, whole = _sets(block, size)
                raw = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(whole), pa.array(raw, pa.binary())], ["set_id", "hashes"])

    tiles = _tiles(members, Parts(threshold))
    placed = kept.select("text").mapInArrow(sets, "set_id long, hashes binary").join(tiles, "set_id")
    placed = placed.select("set_id", "hashes", F.inline("places"))

    def join(group: pa.Table) -> pa.Table:
        ids, at = np.unique(np.asarray(group["set_id"]), return_index=True)
        raw, sides = group["hashes"], np.asarray(group["side"])[at]
        own = [np.frombuffer(raw[int(i)].as_buffer(), np.uint64) for i in at]
        edges = np.array(joined_group(ids, sides, own, num, den), np.int64).reshape(-1, 2)
        return pa.table({"u": edges[:, 0], "v": edges[:, 1]})

    edges = placed.groupBy("tile").applyInArrow(join, "u long, v long")
    return components(edges).select(F.col("node").alias("set_id"), "component")


def linked(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    threshold: Fraction = THRESHOLD,
    signer: Signer | None = None,
) -> DataFrame:
    """One row per row of ``documents``: id, text_key, n_shingles, component_id (the smallest id reachable by links).

    Words are runs of other than ASCII white space after A-Z are lower-cased; a text of fewer words than ``size`` is
    one shingle.  Null and empty texts have no shingle and link with nothing.  Repeated rows and ids are all returned;
    a null id names a component only where no other id is in it.  Shingles and sets are
    compared by 64-bit hashes: one wrong match is to be expected among some 10^9 different texts.
    """
    rows = stored(keyed(documents, id_column, text_column, size, signer or Parts(threshold)))
    found = linked_sets(rows, documents, id_column, text_column, size, threshold)
    salted = rows.where("n > 0").groupBy("set_id", "salt").agg(F.min("id").alias("salt_min"))
    ids = salted.groupBy("set_id").agg(F.min("salt_min").alias("set_min"))
    smallest = found.join(ids, "set_id").groupBy("component").agg(F.min("set_min").alias("component_min"))
    wider = found.join(smallest, "component").select("set_id", "component_min")
    names = ids.join(wider, "set_id", "left").select(
        F.col("set_id"), F.coalesce("component_min", "set_min").alias("name")
    )
    own = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("id"))
    # A set meets its name at most once for each salt, and its copies meet it by salt: none gathers in one task.
    spread = salted.select("set_id", "salt").join(names, "set_id")
    full = rows.where("n > 0").drop("keys").join(spread, ["set_id", "salt"], "left")
    # Rows without a shingle would all meet under one key.
    bare = rows.where("n = 0").drop("keys").withColumn("name", F.col("id"))
    return full.select(bare.columns).unionByName(bare).select(
        F.col("id").alias(id_column), "text_key", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def deduplicated(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    size: int = SHINGLE,
    threshold: Fraction = THRESHOLD,
    signer: Signer | None = None,
) -> DataFrame:
    """``documents`` with one of each component: the row whose id names it.  A row that repeats id and text stays once.

    Null and empty texts link with nothing, so they stay.  Rows without an id stay unless a row with one is in their
    component.
    """
    found = linked(
        documents, id_column=id_column, text_column=text_column, size=size, threshold=threshold, signer=signer
    )
    keep = found.where(F.col(id_column).eqNullSafe(F.col("component_id")))
    keep = keep.select(F.col(id_column).alias("kept_id"), F.col("text_key").alias("kept_key")).distinct()
    own = documents.select(
        F.struct("*").alias("row"), F.col(id_column).alias("id"), text_key(F.col(text_column)).alias("key")
    )
    match = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    return own.join(keep, match, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
