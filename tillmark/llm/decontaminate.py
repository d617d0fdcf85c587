"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one automaton whose states stand for all runs of words that occur in some item.
Documents are streamed through it: after each word the state tells the longest run that ends there and occurs in an
item.  Where that run is at least a window long, its last window is contaminated.

The items are a stated query set.  They are cut into blocks of about ``BLOCK_TEXT`` characters of item text; a task
builds one automaton of each block and packs it into arrays of some 15 bytes a character, which are broadcast, one block
after the other, and all documents pass by each.  Documents are never shuffled for one block, and only rows with hits are
grouped for several.
"""

from __future__ import annotations

import pickle
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tillmark.llm import words
from tillmark.llm.shared import stored

WINDOW = 10
MAX_COVERAGE = 0.5
BLOCK_TEXT = 4_000_000

FOUND = "n_words long, n_hit long, longest long, items array<string>, spans array<struct<start: long, end: long>>"


class ItemAutomaton:
    """Generalised suffix automaton over word numbers, with the windows of the items marked.

    An item is a sequence of word hashes.  Items with at least ``window`` words contribute all their windows, shorter
    ones themselves; items without words contribute nothing.
    """

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.window = window
        self.vocabulary = words.Vocabulary(np.concatenate([h for _, h in items] or [np.zeros(0, np.uint64)]))
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ids = [self.vocabulary.find(h)[1].tolist() for _, h in items]
        for one in ids:
            last = 0
            for word in one:
                last = self._extend(last, word)
        self.least = min([min(len(one), window) for one in ids if one], default=window)
        # Items by the state that stands for a whole window, and short items by the state that stands for them.
        self.windows: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        self.names = [name for name, _ in items]
        for number, one in enumerate(ids):
            self._mark(number, one)
        self.window_state = [self._ancestor(v) for v in range(len(self.size))]
        self.short_state = [-1] * len(self.size)
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__):
            self.short_state[v] = v if v in self.short else self.short_state[self.link[v]]
        self._pack()

    def _pack(self) -> None:
        """The finished automaton in arrays: steps by (state, word), owners by state, in their order."""
        keys = np.fromiter((state << 32 | word for state, own in enumerate(self.steps) for word in own), np.int64)
        targets = np.fromiter((to for own in self.steps for to in own.values()), np.int32)
        order = np.argsort(keys)
        self.edges, self.targets = array("q", keys[order].tobytes()), array("i", targets[order].tobytes())
        windows = [(state, number) for state in sorted(self.windows) for number in sorted(self.windows[state])]
        short = [(state, *one) for state in sorted(self.short) for one in self.short[state]]
        self.window_at, self.window_item = (array("i", [row[i] for row in windows]) for i in range(2))
        self.short_at, self.short_size, self.short_item = (array("i", [row[i] for row in short]) for i in range(3))
        self.link, self.size = array("i", self.link), array("i", self.size)
        self.window_state, self.short_state = array("i", self.window_state), array("i", self.short_state)
        del self.steps, self.windows, self.short

    def packed(self) -> bytes:
        return pickle.dumps(vars(self) | {"vocabulary": self.vocabulary.hashes})

    @classmethod
    def unpacked(cls, data: bytes) -> ItemAutomaton:
        own = cls.__new__(cls)
        vars(own).update(pickle.loads(data))
        own.vocabulary = words.Vocabulary(own.vocabulary)
        return own

    @staticmethod
    def _rows_of(state: int, states: array) -> range:
        return range(bisect_left(states, state), bisect_left(states, state + 1))

    def _extend(self, last: int, word: int) -> int:
        known = self.steps[last].get(word)
        if known is not None and self.size[known] == self.size[last] + 1:
            return known
        if known is not None:
            return self._clone(last, word, known)
        new = self._state(self.size[last] + 1, {})
        at = last
        while at != -1 and word not in self.steps[at]:
            self.steps[at][word] = new
            at = self.link[at]
        if at == -1:
            self.link[new] = 0
        else:
            target = self.steps[at][word]
            self.link[new] = target if self.size[target] == self.size[at] + 1 else self._clone(at, word, target)
        return new

    def _state(self, size: int, steps: dict[int, int]) -> int:
        self.steps.append(steps)
        self.link.append(0)
        self.size.append(size)
        return len(self.size) - 1

    def _clone(self, at: int, word: int, target: int) -> int:
        copy = self._state(self.size[at] + 1, dict(self.steps[target]))
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at != -1 and self.steps[at].get(word) == target:
            self.steps[at][word] = copy
            at = self.link[at]
        return copy

    def _ancestor(self, state: int) -> int:
        """The state of the last ``window`` words of what ``state`` stands for, -1 where that is shorter."""
        if self.size[state] < self.window:
            return -1
        while self.size[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _mark(self, number: int, one: list[int]) -> None:
        state = 0
        for count, word in enumerate(one, 1):
            state = self.steps[state][word]
            if count >= self.window:
                self.windows.setdefault(self._ancestor(state), set()).add(number)
        if 0 < len(one) < self.window:
            self.short.setdefault(state, []).append((len(one), number))

    def stream(self, sequence: list[int]) -> tuple[list[tuple[int, int]], set[int], int]:
        """Windows that occur in a run of known words (from, to), the items they belong to, the longest match."""
        edges, targets, link, size, window = self.edges, self.targets, self.link, self.size, self.window
        state = length = longest = 0
        hits, items = [], set()
        for place, word in enumerate(sequence, 1):
            while True:
                key = state << 32 | word
                at = bisect_left(edges, key)
                if at < len(edges) and edges[at] == key:
                    state, length = targets[at], length + 1
                    break
                if state == 0:
                    length = 0
                    break
                state = link[state]
                length = size[state]
            if length > longest:
                longest = length
            if length >= window:
                hits.append((place - window, place))
                items.update(self.window_item[i] for i in self._rows_of(self.window_state[state], self.window_at))
            at = self.short_state[state] if state else -1
            while at > 0:
                for i in self._rows_of(at, self.short_at):
                    count = self.short_size[i]
                    if length >= count:
                        hits.append((place - count, place))
                        items.add(self.short_item[i])
                at = self.short_state[link[at]]
        return hits, items, longest


def _known_runs(block: words.Block, automaton: ItemAutomaton):
    """Runs of words of one text that all occur in items and are long enough to hold a window: (text, from, numbers)."""
    at, numbers = automaton.vocabulary.find(block.hashes)
    if not len(at):
        return
    rows = np.searchsorted(block.bounds, at, "right") - 1
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(at) != 1) | (np.diff(rows) != 0)
    opens = np.flatnonzero(first)
    closes = np.append(opens[1:], len(at))
    for low, high in zip(opens, closes):
        if high - low >= automaton.least:
            yield int(rows[low]), int(at[low]), numbers[low:high].tolist()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping spans joined."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def scan(column: pa.Array, automaton: ItemAutomaton) -> list[tuple[int, int, int, list, list]]:
    """For each text: words, words hit, longest match, item ids, hit spans as byte places of the UTF-8 text."""
    out = []
    for block in words.blocks(column, words.LETTERS):
        hits: dict[int, list[tuple[int, int]]] = {}
        items: dict[int, set[int]] = {}
        longest: dict[int, int] = {}
        if len(automaton.vocabulary):
            for row, start, numbers in _known_runs(block, automaton):
                found, owners, most = automaton.stream(numbers)
                longest[row] = max(longest.get(row, 0), most)
                if found:
                    hits.setdefault(row, []).extend((start + a, start + b) for a, b in found)
                    items.setdefault(row, set()).update(owners)
        counts = np.diff(block.bounds)
        for row in range(block.last - block.first):
            spans = merged(hits.get(row, []))
            places = [
                (int(block.starts[a] - block.offsets[row]), int(block.ends[b - 1] - block.offsets[row]))
                for a, b in spans
            ]
            names = sorted({automaton.names[i] for i in items.get(row, ()) if automaton.names[i] is not None})
            out.append((int(counts[row]), sum(b - a for a, b in spans), longest.get(row, 0), names, places))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the byte spans; what stood on both sides of one is parted by a line end."""
    data, kept, last = text.encode(), [], 0
    for start, end in spans:
        kept.append(data[last:start].decode())
        last = end
    kept.append(data[last:].decode())
    return "\n".join(part.strip(" ") for part in kept if part.strip(" "))


def clean(text: str, automaton: ItemAutomaton) -> str:
    """``text`` without any window: removing a span can join words to a new one, so until none is left."""
    while True:
        spans = scan(pa.array([text]), automaton)[0][4]
        if not spans:
            return text
        text = cut(text, spans)


def _blocks_of_items(
    benchmark: DataFrame, id_column: str, text_column: str, window: int
) -> Iterator[Broadcast[bytes]]:
    """One broadcast automaton after the other; the driver holds one packed automaton at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_column).cast("string").alias("id"), F.col(text_column).alias("text"))
    items = items.where(F.length("text") > 0)
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-total // BLOCK_TEXT) or 1

    def build(block: pa.Table) -> pa.Table:
        rows = zip(block["id"].to_pylist(), block["text"].to_pylist())
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
        automaton = ItemAutomaton([(name, words.hash_text(text, words.LETTERS)) for name, text in rows], window)
        return pa.table({"part": block["part"].slice(0, 1), "automaton": pa.array([automaton.packed()], pa.binary())})

    part = F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int").alias("part")
    blocks = items.distinct().select("id", "text", part).groupBy("part")
    built = stored(blocks.applyInArrow(build, "part int, automaton binary"))
    for number in range(parts):
        row = built.where(F.col("part") == number).first()
        yield spark.sparkContext.broadcast(bytes(row.automaton) if row else ItemAutomaton([], window).packed())


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``documents`` with a struct column ``contamination``: words, words hit, longest match, items and byte spans.

    Words are runs of a-z, 0-9 and non-ASCII characters after A-Z are lower-cased.  A null text has no words.  Rows
    keep their order and number, repeated rows and clashing column names included (an own column ``contamination``
    is replaced); an item without an id contaminates but is not named; an empty benchmark hits nothing.
    """
    documents = documents.drop("contamination")
    automata = _blocks_of_items(benchmark, item_id, item_text, window)
    results = [_streamed(documents, text_column, a) for a in automata]
    if len(results) == 1:
        return results[0]
    return _several(documents, text_column, results)


def _streamed(documents: DataFrame, text_column: str, sent: Broadcast[bytes]) -> DataFrame:
    kind = StructType.fromDDL(FOUND)
    schema = StructType([*documents.schema.fields, StructField("contamination", kind)])
    names = [f.name for f in kind.fields]

    def stream(batches):
        automaton = ItemAutomaton.unpacked(sent.value)
        for batch in batches:
            rows = scan(batch.column(batch.schema.get_field_index(text_column)), automaton)
            columns = [[r[i] for r in rows] for i in range(4)]
            columns.append([[{"start": a, "end": b} for a, b in r[4]] for r in rows])
            types = [pa.int64()] * 3 + [pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            found = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "contamination"])

    return documents.mapInArrow(stream, schema)


def _joined(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte spans joined where they overlap or no word stands between them, as one automaton would find them."""
    whole = merged(spans)
    data = text.encode()
    between = pa.array([data[a[1] : b[0]].decode() for a, b in zip(whole, whole[1:])], pa.large_string())
    empty = [n == 0 for block in words.blocks(between, words.LETTERS) for n in np.diff(block.bounds)]
    out = whole[:1]
    for span, adjoins in zip(whole[1:], empty):
        if adjoins:
            out[-1] = (out[-1][0], span[1])
        else:
            out.append(span)
    return out


def _hits_by_text(text_column: str, results: list[DataFrame]) -> DataFrame:
    """The findings of several blocks of items, one row for each text that is hit: spans of different items may
    overlap, words count once."""
    hits = None
    for result in results:
        own = result.where(F.size("contamination.spans") > 0)
        own = own.select(F.col(text_column).alias("_text"), "contamination").dropDuplicates(["_text"])
        hits = own if hits is None else hits.unionByName(own)
    joined = hits.groupBy("_text").agg(
        F.max("contamination.n_words").alias("n_words"),
        F.max("contamination.longest").alias("longest"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("contamination.items")))).alias("items"),
        F.flatten(F.collect_list("contamination.spans")).alias("spans"),
    )
    names = ["_text", "_n_words", "_n_hit", "_longest", "_items", "_spans"]

    def merge(batches):
        for batch in batches:
            texts, spans = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            whole = [_joined(text, [(s["start"], s["end"]) for s in one]) for text, one in zip(texts, spans)]
            n_hit = []
            for text, one in zip(texts, whole):
                parts = pa.array([text.encode()[a:b].decode() for a, b in one])
                n_hit.append(sum(len(b.hashes) for b in words.blocks(parts, words.LETTERS)))
            rows = [[{"start": a, "end": b} for a, b in one] for one in whole]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [*batch.columns[:2], pa.array(n_hit, pa.int64()), *batch.columns[2:4], pa.array(rows, kind)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    spans = "_spans array<struct<start: long, end: long>>"
    return joined.mapInArrow(merge, f"_text string, _n_words long, _n_hit long, _longest long, _items array<string>, {spans}")


def _several(documents: DataFrame, text_column: str, results: list[DataFrame]) -> DataFrame:
    """``documents`` with the findings of several blocks of items."""
    found = _hits_by_text(text_column, results)
    own = "contamination"
    first = results[0].select(F.struct(*documents.columns).alias("row"), F.col(text_column).alias("own_text"), own)
    out = first.join(found, F.col("own_text") == F.col("_text"), "left")
    value = F.struct(
        F.col(f"{own}.n_words").alias("n_words"),
        F.coalesce("_n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.greatest(f"{own}.longest", F.coalesce("_longest", F.lit(0))).alias("longest"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("_spans", F.array().cast("array<struct<start: long, end: long>>")).alias("spans"),
    )
    return out.select("row.*", value.alias(own))


def decontaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    text_column: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
) -> DataFrame:
    """``documents`` without the spans that occur in items, and without documents of which they cover too much.

    A document of whose words more than ``max_coverage`` are hit is dropped.  Otherwise the spans go, and again until
    the text that is left holds no window.  Documents without a hit, null and empty texts included, stay as they are.
    Coverage, and each removal, is judged on what all items hit together, however many blocks they are cut into.
    """
    automata = list(_blocks_of_items(benchmark, item_id, item_text, window))
    if len(automata) == 1:
        return _cleaned(documents, text_column, automata[0], max_coverage)
    return _cleaned_by_all(documents, text_column, automata, max_coverage)


def _cleaned_by_all(documents: DataFrame, text_column: str, automata: list[Broadcast[bytes]], max_coverage: float) -> DataFrame:
    """Rounds over all blocks of items; each sees only the texts that the one before has cut."""
    texts = documents.select(F.col(text_column).alias("_now"))
    hits = stored(_hits_by_text("_now", [_streamed(texts, "_now", a) for a in automata]))
    # A dropped text has no new one.
    keep = ~(F.col("_n_hit") > F.lit(max_coverage) * F.col("_n_words"))
    changes = hits.where(~keep).select(F.col("_text").alias("_was"), F.lit(None).cast("string").alias("_now"))
    open_ = stored(_cut(hits.where(keep).withColumn("_was", F.col("_text"))))
    while not open_.isEmpty():
        hits = stored(_hits_by_text("_now", [_streamed(open_.select("_now"), "_now", a) for a in automata]))
        more = open_.join(hits, F.col("_now") == F.col("_text"), "left")
        changes = changes.unionByName(more.where(F.col("_text").isNull()).select("_was", "_now"))
        open_ = stored(_cut(more.where(F.col("_text").isNotNull())))
    row = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"))
    found = row.join(changes, F.col("row")[text_column] == F.col("_was"), "left")
    found = found.where(F.col("_was").isNull() | F.col("_now").isNotNull())
    text = F.coalesce("_now", F.col("row")[text_column])
    return found.select([(text if c == text_column else F.col("row")[c]).alias(c) for c in documents.columns])


def _cut(found: DataFrame) -> DataFrame:
    """Of rows with _was, _text and _spans: _was, and as _now the text without the spans."""

    def stream(batches):
        for batch in batches:
            texts, spans = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            now = [cut(text, [(s["start"], s["end"]) for s in one]) for text, one in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(now, pa.string())], ["_was", "_now"])

    return found.select("_was", "_text", "_spans").mapInArrow(stream, "_was string, _now string")


def _cleaned(
    documents: DataFrame, text_column: str, sent: Broadcast[bytes], max_coverage: float
) -> DataFrame:
    def stream(batches):
        automaton = ItemAutomaton.unpacked(sent.value)
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            column = batch.column(at)
            rows = scan(column, automaton)
            hit = [i for i, r in enumerate(rows) if r[1]]
            if hit:
                texts = column.to_pylist()
                for i in hit:
                    texts[i] = None if rows[i][1] > max_coverage * rows[i][0] else clean(texts[i], automaton)
                keep = pa.array([not (r[1] > max_coverage * r[0]) for r in rows])
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type)).filter(keep)
            yield batch

    return documents.mapInArrow(stream, documents.schema)
