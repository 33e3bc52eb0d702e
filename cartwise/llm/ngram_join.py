r"""N-gram Jaccard self-join by set-relation skipping, and the components of its links.

A document's set holds its distinct 5-word shingles (64-bit hashes, A-Z
lower-cased); two link when ``100 * |intersection| >= 80 * |union|``. Equal sets form one class, told by
a 64-bit digest; all work below is on classes, so copies cost nothing.

Index. Shingles have one global order: rare ones by hash, then the most
frequent ones (at most ``MOST_HOT``, counted over all documents), so that shared
passages come last. A set is listed under its first ``n - ceil(0.8 n) + 1``
shingles; linked sets share one of them. A list is skipped by block: entries
whose sizes or positions rule a link out never meet, nor (in long lists) those that
share too little in all lists.

Set relations. Each list has a leader: first the class most of whose shingles are
shared (the set that near copies come from), then one by chance. Every class is
compared with the leader that it has most in common with, and overlap and answer
are kept. Later work is derived from those answers:

* classes linked with one leader are connected: a list all of whose entries
  are connected is skipped whole, and pairs inside a component are not met;
* for two classes compared with the same leader R, the overlap lies between
  ``o(x,R) + o(y,R) - |R|`` and ``min(o(x,R) + |y| - o(y,R), o(y,R) + |x| - o(x,R))``:
  the upper bound skips a pair, the lower bound links it without reading it.

All other pairs of a list that may link are compared on their texts (each class's
closest first, then those still between components), so no link between components
is lost and no cap applies. Result rows carry the component's
smallest doc_id; groups of copies are never expanded into pairs.

Defined results: null, empty or word-free texts have empty sets and link with
nothing; 1 to 4 words are one shingle; rows with equal doc_id are separate rows
compared by their own texts; a row with a null doc_id links with nothing and its
component is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.llm import textvec
from cartwise.llm.common import Scratch, annotate, id_text, lean, shuffle_parts, ship, table
from cartwise.llm.components import components

ship(__name__)

SHINGLE = 5
#: Shingles kept at the end of the order, at most, and how many documents (of one task, of all) make one.
MOST_HOT = 1 << 18
HOT_IN_TASK = 2
HOT_IN_ALL = 16
#: Shingles that a task counts at once (a worker keeps the memory that this took).
COUNT_BLOCK = 1 << 20
#: Classes that a task remembers to list copies once.
CLASS_MEMORY = 1 << 18
#: Rounds of comparing every class with one leader, before lists are gone through pair by pair.
LEADS = 2
#: Entries from which on a list's pairs are first held against all that the two classes share.
LONG_LIST = 16
#: Rows up to which a list of wanted documents, classes, pairs or components is broadcast; beyond, it is joined by a shuffle of the larger side.
BROADCAST_ROWS = 1 << 20
#: Entries from which on a list is cut into blocks; every pair of blocks is a group of its own.
SPLIT_LIST = 1 << 12
#: Pairs, and numbers of a dense block, that a task looks at together.
PAIRS_AT_ONCE = 1 << 18
DENSE_CELLS = 1 << 21


def row_sets(text) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row of an Arrow string column."""
    data, borders = textvec.column(text)
    for _, block, edges in textvec.blocks(data, borders):
        found = textvec.words(textvec.LOWER[block], edges, textvec.NOT_SPACE)
        grams = textvec.grams(found.hash, SHINGLE)
        for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
            if b - a >= SHINGLE:
                yield np.unique(grams[a:b - SHINGLE + 1])
            else:
                yield textvec.grams(found.hash[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def needed_overlap(sizes):
    """The least overlap of two linked sets whose sizes sum to ``sizes``: 180 o >= 80 (x + y)."""
    return -(-4 * sizes // 9)


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1 if n else 0


def hot_shingles(docs: DataFrame, most: int = MOST_HOT, in_task: int = HOT_IN_TASK, in_all: int = HOT_IN_ALL) -> np.ndarray:
    """The most frequent shingles, sorted. Tasks send only shingles frequent in themselves; the result's size is bounded."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held):
            values = np.concatenate(held)
            values.sort()
            heads = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
            times = np.diff(np.r_[heads, len(values)])
            often = times >= in_task
            return pa.RecordBatch.from_arrays([pa.array(values[heads[often]].view(np.int64)), pa.array(times[often])], names=["token", "times"])

        held, size, known = [], 0, set()
        for batch in batches:
            for own in row_sets(batch.column("text")):
                if len(own) == 0 or (cls := class_of(own)) in known:
                    continue  # copies never meet: only different sets make a shingle frequent
                known.add(cls)
                held.append(own)
                size += len(own)
                if size >= COUNT_BLOCK:
                    yield flush(held)
                    held, size = [], 0
                    known.clear()
        if size:
            yield flush(held)

    counted = docs.select("text").mapInArrow(lean(count), "token long, times long").groupBy("token").agg(F.sum("times").alias("times"))
    top = counted.where(F.col("times") >= in_all).orderBy(F.desc("times"), "token").limit(most).select("token").toArrow()
    return np.sort(top["token"].to_numpy().astype(np.int64).view(np.uint64))


class Order:
    """The global order of shingles: rare by hash, then hot by hash."""

    def __init__(self, hot: np.ndarray) -> None:
        self.hot = hot
        self.maybe = np.zeros(1 << 21, bool)
        self.maybe[hot >> np.uint64(43)] = True

    def prefix(self, own: np.ndarray) -> np.ndarray:
        p = prefix_length(len(own))
        if len(self.hot) == 0:
            return own[:p]
        late = np.flatnonzero(self.maybe[own >> np.uint64(43)])
        if len(late):
            at = np.searchsorted(self.hot, own[late])
            at[at == len(self.hot)] = 0
            late = late[self.hot[at] == own[late]]
        if len(late) == 0:
            return own[:p]
        return np.r_[np.delete(own, late), own[late]][:p]


def class_of(own: np.ndarray) -> int:
    return int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def describe(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """doc_id, n, cls, and for the first copy of a class in a task the shingles that it is listed under."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)  # size: MOST_HOT numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, known = Order(shared.value), set()
        for batch in batches:
            sizes, classes, prefixes = [], [], []
            for own, key in zip(row_sets(batch.column("text")), batch.column("doc_id"), strict=True):
                sizes.append(len(own))
                if len(own) == 0 or not key.is_valid:
                    classes.append(None)
                    prefixes.append(None)
                    continue
                classes.append(cls := class_of(own))
                if cls in known:
                    prefixes.append(None)
                    continue
                if len(known) >= CLASS_MEMORY:
                    known.clear()
                known.add(cls)
                prefixes.append(order.prefix(own).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int32()), pa.array(classes, pa.int64()),
                                              pa.array(prefixes, pa.list_(pa.int64()))], names=["doc_id", "n", "cls", "tokens"])

    return docs.mapInArrow(lean(run), "doc_id long, n int, cls long, tokens array<long>")


LISTED = "token long, cls long, n int, pos int"


def shared_lists(entries: DataFrame) -> DataFrame:
    """The entries of lists with two or more classes, each class once.

    Rows arrive sorted by (token, cls), so a list is streamed and only its
    first entry is ever held back. ``token`` is the list's number from here on: lists are counted in their task,
    and the count is dealt over the tasks, so numbers are exact and no larger than the lists are many.
    """
    names = [c.split()[0] for c in LISTED.split(", ")]
    parts = shuffle_parts(entries.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pending, held_token, lists, task = (None, None), None, None, 0, TaskContext.get().partitionId()
        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in names]
            if len(cols[0]) == 0:
                continue
            token, cls = cols[0], cols[1]
            fresh = np.r_[(token[0], cls[0]) != last, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])]
            cols = [c[fresh] for c in cols]
            if len(cols[0]) == 0:
                continue
            token = cols[0]
            heads = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            many = np.diff(np.r_[heads, len(token)]) > 1
            goes_on = token[0] == last[0]
            many[0] |= goes_on
            out = [c[np.repeat(many, np.diff(np.r_[heads, len(token)]))] for c in cols]
            if goes_on and pending is not None:
                out = [np.r_[p, c] for p, c in zip(pending, out, strict=True)]
            pending = None if many[-1] else [c[-1:] for c in cols]
            last = (token[-1], cols[1][-1])
            if len(out[0]):
                if goes_on and held_token == out[0][0]:
                    lists -= 1
                held_token = out[0][-1]
                number = lists + np.cumsum(np.r_[False, out[0][1:] != out[0][:-1]])
                lists = int(number[-1]) + 1
                out[0] = number * parts + task
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)

    return entries.repartition(parts, "token").sortWithinPartitions("token", "cls").mapInArrow(lean(run), LISTED)


def few(rows: DataFrame) -> DataFrame:
    """A written table, broadcast up to ``BROADCAST_ROWS`` rows."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def texts_of(classes: DataFrame, members: DataFrame, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(cls, text): the text of one document of each class, written once for all comparisons."""
    ids = scratch.write(members.join(classes, "cls").groupBy("cls").agg(F.min("doc_id").alias("doc_id")), "ids")
    # rows that share a doc_id may be of other classes: those are told apart by their class when compared
    return scratch.write(docs.join(few(ids), "doc_id").select("cls", "text"), "texts")


COMPARED = "a long, b long, overlap int, a_n int, b_n int"


def compare(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(a, b, overlap, a_n, b_n) of class pairs, from their texts.

    The pairs are written first: a text meets them where it lies and is shuffled once, to its pair's other text,
    and only texts that a pair names are shuffled.
    """
    pairs = scratch.write(pairs.select("a", "b"), f"{name}-pairs")
    near = pairs.count() <= BROADCAST_ROWS

    def side(key: str) -> DataFrame:
        return texts.select(F.col("cls").alias(key), F.col("text").alias(f"{key}_text"))

    lefts = side("a").join(F.broadcast(pairs) if near else pairs, "a")
    rights = side("b").join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi") if near else side("b")
    sides = lefts.join(rights, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_set = None, None
        for batch in batches:
            out = []
            lefts = row_sets(batch.column("a_text"))
            for a, b, left, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), lefts, batch.column("b_text"), strict=True):
                if b != held:
                    right = next(row_sets(pa.array([text.as_py()], pa.large_string())))
                    if class_of(right) != b:
                        continue
                    held, held_set = b, right
                if class_of(left) == a:
                    out.append((a, b, len(np.intersect1d(left, held_set, assume_unique=True)), len(left), len(held_set)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), *[pa.int32()] * 3), strict=True)],
                                                 names=["a", "b", "overlap", "a_n", "b_n"])

    compared = scratch.write(sides.mapInArrow(lean(run), COMPARED), name)
    scratch.drop(f"{name}-pairs")
    return compared


def linked(overlap, sizes):
    return 9 * overlap >= 4 * sizes


def may_link(common, a_n, a_pos, b_n, b_pos):
    """Whether sets can link that share ``common`` prefix shingles, the last at these positions.

    Up to the end of the prefix that ends first, ``common`` is all they share.
    """
    after = lambda n: n - F.floor(n / 5) - 1  # what a prefix leaves over
    rest = F.least(F.least(a_n - a_pos, b_n - b_pos) - 1, F.greatest(after(a_n), after(b_n)))
    return linked(common + rest, a_n + b_n)


class Shared:
    """How many shingles the classes of one list share, from sorted arrays of them; dense blocks of bounded size."""

    def __init__(self, arrays: np.ndarray) -> None:
        self.values, inverse, times = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        common = times > 1
        self.values = self.values[common]
        held = common[inverse]
        self.row = np.repeat(np.arange(len(arrays)), [len(x) for x in arrays])[held]
        self.column = (np.cumsum(common) - 1)[inverse[held]]
        self.block = max(64, DENSE_CELLS // max(1, len(self.values)))

    def dense(self, a: int, b: int, width: int) -> np.ndarray:
        x, y = np.searchsorted(self.row, (a, b))
        row, column = self.row[x:y] - a, self.column[x:y]
        out = np.zeros((b - a, width), np.float32)
        out[row[column < width], column[column < width]] = 1
        return out

    def count(self, a: int, b: int, left: np.ndarray, right: np.ndarray, below: int | None = None) -> np.ndarray:
        """For pairs with ``a <= left < b``: shared values, or those smaller than ``below``."""
        width = len(self.values) if below is None else int(np.searchsorted(self.values, below))
        out = np.zeros(len(left), np.int64)
        first = self.dense(a, b, width)
        for c in range(a, int(right.max()) + 1 if len(right) else a, self.block):
            at = np.flatnonzero((right >= c) & (right < c + self.block))
            if len(at):
                last = int(right[at].max()) + 1
                out[at] = (first @ self.dense(c, last, width).T)[left[at] - a, right[at] - c]
        return out


def cross_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of one list in different components that sizes, positions and known overlaps leave open.

    Input columns: cell, side, token, cls, n, pos, comp, leader, overlap, leader_n (the last
    three null where a class was compared with no leader). A cell is a list or two blocks
    of a long one: rows of side -1 meet all others, those of a side only other sides. ``sure`` marks pairs
    that the lower bound links. In long lists ``long`` holds the numbers of the long open
    lists that a class is in, ``short`` 16-bit hashes of the others (they only bound a count from above; ``spare``:
    how many of a class's own fell together): pairs that share too few are left out, the others make one row, in the first long list that they
    share, with ``times`` such lists.
    """
    schema = "a long, b long, a_n int, b_n int, a_pos int, b_pos int, sure boolean, times int"

    def pairs_of(_, side, token, n, pos, cls, comp, leader, over, lead_n, spare, brief, lengthy) -> Iterator[pa.RecordBatch]:
        m = len(cls)
        by_short, by_long = (Shared(brief), Shared(lengthy)) if m > 1 and lengthy[0] is not None else (None, None)
        step = max(1, PAIRS_AT_ONCE // m)
        if by_long is not None:
            step = max(1, min(step, by_short.block, by_long.block))
        for i0 in range(0, m - 1, step):
            i = np.arange(i0, min(m - 1, i0 + step))
            upto = np.searchsorted(n, (n[i] * 5) // 4, side="right")  # sizes ascend: later blocks are skipped
            counts = np.maximum(0, upto - i - 1)
            if not counts.sum():
                continue
            left = np.repeat(i, counts)
            right = np.arange(len(left)) - np.repeat(np.cumsum(counts) - counts, counts) + left + 1
            need = needed_overlap(n[left] + n[right])
            ok = (comp[left] != comp[right]) & ((side[left] < 0) | (side[left] != side[right])) & (np.minimum(pos[left], pos[right]) + np.minimum(n[left] - pos[left], n[right] - pos[right]) >= need)
            most = np.minimum(n[left], n[right])
            same = (leader[left] == leader[right]) & (over[left] >= 0) & (over[right] >= 0)
            bound = np.minimum(over[left] + n[right] - over[right], over[right] + n[left] - over[left])
            most = np.where(same, np.minimum(most, bound), most)
            sure = same & (over[left] + over[right] - lead_n[left] >= need)
            ok &= most >= need
            left, right, sure, need = left[ok], right[ok], sure[ok], need[ok]
            times = np.ones(len(left), np.int32)
            if by_long is not None and len(left):
                until = int(i[-1]) + 1
                after = lambda k: n[k] - n[k] // 5 - 1
                times = by_long.count(i0, until, left, right)
                ok = sure | (by_short.count(i0, until, left, right) + spare[left] + times + np.maximum(after(left), after(right)) >= need)
                ok &= by_long.count(i0, until, left, right, below=token[0]) == 0
                times = times.astype(np.int32)[ok]
                left, right, sure = left[ok], right[ok], sure[ok]
            if len(left) == 0:
                continue
            swap = cls[left] > cls[right]
            a, b = np.where(swap, right, left), np.where(swap, left, right)
            yield pa.RecordBatch.from_arrays([pa.array(cls[a]), pa.array(cls[b]), pa.array(n[a].astype(np.int32)), pa.array(n[b].astype(np.int32)),
                                              pa.array(pos[a].astype(np.int32)), pa.array(pos[b].astype(np.int32)), pa.array(sure), pa.array(times)],
                                             names=["a", "b", "a_n", "b_n", "a_pos", "b_pos", "sure", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            cols = [batch.column(c).fill_null(-1).to_numpy().astype(np.int64) for c in ("cell", "side", "token", "n", "pos", "cls", "comp", "leader", "overlap", "leader_n", "spare")]
            for name in ("short", "long"):
                arrays = np.empty(batch.num_rows, object)
                arrays[:] = [v.values.to_numpy() if v.is_valid else None for v in batch.column(name)]
                cols.append(arrays)
            if rest is not None:
                cols = [np.r_[r, c] for r, c in zip(rest, cols, strict=True)]
            if len(cols[0]) == 0:
                continue
            heads = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
            for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True):
                yield from pairs_of(*(c[a:b] for c in cols))
            rest = [c[heads[-1]:] for c in cols]
        if rest is not None and len(rest[0]):
            yield from pairs_of(*rest)

    parts = shuffle_parts(rows.sparkSession)
    return rows.repartition(parts, "cell").sortWithinPartitions("cell", "n", "pos", "cls").mapInArrow(lean(run), schema)


def cells(rows: DataFrame, split: int) -> DataFrame:
    """``rows`` of entries with their list's ``size``, placed in cells (``cell``, ``side``).

    A list of up to ``split`` entries is one cell. A longer one is cut into bands of set sizes (linked
    sets are in one band or in neighbours, as 1.3 > 5 / 4) and blocks by hash; a cell holds two blocks of
    one band, or one block each of two neighbours, so every pair that may link meets once.
    """
    rows = (rows.withColumn("blocks", F.ceil(F.col("size") / split)).withColumn("band", F.floor(F.log("n") / math.log(1.3)))
            .withColumn("part", F.pmod(F.xxhash64("cls", "token"), F.col("blocks"))))
    whole = "array(named_struct('cell', token, 'side', -1))"
    meets = ("flatten(transform(sequence(0L, blocks - 1), x -> array("
             "named_struct('cell', xxhash64(token, band, band, least(x, part), greatest(x, part)), 'side', if(x = part, -1, if(x < part, 1, 0))), "
             "named_struct('cell', xxhash64(token, band, band + 1, part, x), 'side', 0), "
             "named_struct('cell', xxhash64(token, band - 1, band, x, part), 'side', 1))))")
    placed = rows.withColumn("at", F.explode(F.expr(f"if(blocks = 1, {whole}, {meets})")))
    return placed.select("*", "at.cell", "at.side").drop("at", "blocks", "band", "part", "size")


def candidates(met: DataFrame) -> DataFrame:
    """(a, b, a_n, b_n, common) of pairs that met in lists and may link; ``met`` has a row for each list."""
    pairs = met.groupBy("a", "b", "a_n", "b_n").agg(F.count("*").cast("int").alias("common"), F.max("a_pos").alias("a_pos"),
                                                    F.max("b_pos").alias("b_pos"))
    return pairs.where(may_link(*(F.col(c) for c in ("common", "a_n", "a_pos", "b_n", "b_pos")))).select("a", "b", "a_n", "b_n", "common")


def closest(pairs: DataFrame) -> DataFrame:
    """Each class's pair with the largest common share."""
    share = F.col("common") / (F.col("a_n") + F.col("b_n"))
    return pairs.groupBy("a").agg(F.max_by("b", share).alias("b"))


def with_leaders(rows: DataFrame, score: Column) -> DataFrame:
    """(a, b, ...) rows of entries and their list's leader (largest score in a band of sizes) in another component.

    The score is taken after the shuffle, so that it is not moved.
    """
    rows = rows.withColumn("band", F.floor(F.log("n") / math.log(1.25)))
    # one shuffle by list: a window, where an aggregate joined back would move the entries twice; what it compares is made after it
    rows = rows.repartition("token", "band")
    lead = F.max(F.struct(score, "cls", "n", "pos", "comp")).over(Window.partitionBy("token", "band"))
    return rows.withColumn("lead", lead).where("comp <> lead.comp").select(
        F.col("cls").alias("a"), F.col("lead.cls").alias("b"), F.col("n").alias("a_n"), F.col("lead.n").alias("b_n"),
        F.col("pos").alias("a_pos"), F.col("lead.pos").alias("b_pos"))


def links(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, n, cls), and (cls, comp): the component of every class that has a link."""
    described = scratch.write(describe(docs, hot_shingles(docs)), "described")
    members = described.select("doc_id", "n", "cls")
    entries = described.where("tokens IS NOT NULL").select("cls", "n", F.posexplode("tokens").alias("pos", "token")).select("token", "cls", "n", "pos")
    listed = scratch.write(shared_lists(entries), "listed")
    texts = texts_of(listed.select("cls").distinct(), members, docs, scratch)
    of_list, of_class = Window.partitionBy("token"), Window.partitionBy("cls")
    # a set that holds what its near copies share has most of its prefix listed: it leads first
    central = F.floor(1000 * F.col("entries") / (F.floor(F.col("n") / 5) + 1)) * (1 << 40) + F.pmod(F.xxhash64("cls"), F.lit(1 << 40))

    def placed(comps: DataFrame | None) -> DataFrame:
        """Listed entries with the component so far (a class's own digest where it has no link)."""
        if comps is None:
            return listed.withColumn("comp", F.col("cls"))
        return listed.join(few(comps), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))

    def grown(comps: DataFrame | None, tables: list[DataFrame], name: str) -> DataFrame:
        """The components after the links of ``tables``: only links between two of ``comps`` go through rounds, as links of their smallest classes."""
        edges = reduce(DataFrame.unionByName, (t.where(linked(F.col("overlap"), F.col("a_n") + F.col("b_n"))).select(
            F.col("a").alias("u"), F.col("b").alias("v")) for t in tables))
        if comps is not None:
            known = few(comps)
            for end in ("u", "v"):
                edges = edges.join(known.withColumnRenamed("cls", end), end, "left").withColumn(end, F.coalesce("comp", end)).drop("comp")
        merged = components(edges, scratch, name).select(F.col("u").alias("cls"), F.col("v").alias("comp"))
        if comps is None:
            return merged
        moved = comps.join(few(merged.select(F.col("cls").alias("comp"), F.col("comp").alias("now"))), "comp", "left")
        return scratch.write(moved.select("cls", F.coalesce("now", "comp").alias("comp")).unionByName(merged), f"{name}-all")

    answers, comps = [], None
    for turn in range(LEADS):
        rows = placed(comps)
        rows, score = (rows.withColumn("entries", F.count("*").over(of_class)), central.cast("long")) if turn == 0 else (rows, F.xxhash64("cls", F.lit(turn)))
        answers.append(compare(closest(candidates(with_leaders(rows, score))), texts, scratch, f"led-{turn}"))
        comps = grown(comps, answers[-1:], f"lead-comps-{turn}")

    # lists that still hold several components; each class with its best answer so far
    best = reduce(DataFrame.unionByName, answers).groupBy(F.col("a").alias("cls")).agg(
        F.max_by("b", "overlap").alias("leader"), F.max("overlap").alias("overlap"), F.max_by("b_n", "overlap").alias("leader_n"))
    mixed = placed(comps).withColumns({"low": F.min("comp").over(of_list), "high": F.max("comp").over(of_list), "size": F.count("*").over(of_list)})
    rows = scratch.write(mixed.where("low < high").drop("low", "high"), "mixed")
    long_list = F.col("size") >= LONG_LIST
    # a class has at most its prefix in lists, so its arrays are no longer than a text
    most = rows.agg(F.max("token")).first()[0] or 0
    number = F.col("token").cast("int" if most < 1 << 31 else "long")
    hashed = (F.pmod(F.xxhash64("token"), F.lit(1 << 16)) - (1 << 15)).cast("short")
    held = {name: F.when(long_list, F.sort_array(F.collect_list(value).over(of_class))) for name, value in
            (("short", F.when(~long_list, hashed)), ("long", F.when(long_list, number)))}
    rows = rows.withColumns(held).withColumn("spare", F.size("short") - F.size(F.array_distinct("short")))
    met = cross_pairs(cells(rows.join(best, "cls", "left"), SPLIT_LIST))
    # positions are those of one shared list, at most the last one's: the bound stays an upper one
    found = met.groupBy("a", "b", "a_n", "b_n").agg(F.sum("times").cast("int").alias("common"), F.max("a_pos").alias("a_pos"),
                                                    F.max("b_pos").alias("b_pos"), F.max("sure").alias("sure"))
    may = may_link(*(F.col(c) for c in ("common", "a_n", "a_pos", "b_n", "b_pos")))
    left = scratch.write(found.where(F.col("sure") | may).select("a", "b", "a_n", "b_n", "common", "sure"), "open")
    # a sure pair is as good as compared
    answers.append(left.where("sure").select("a", "b", F.least("a_n", "b_n").alias("overlap"), F.least("a_n", "b_n").alias("a_n"), F.least("a_n", "b_n").alias("b_n")))
    answers.append(compare(closest(left.where("NOT sure")), texts, scratch, "closest"))
    comps = grown(comps, answers[-2:], "closest-comps")
    done = answers[-1].select("a", "b")
    known = few(comps)
    sides = (left.where("NOT sure").join(done, ["a", "b"], "left_anti")
             .join(known.select(F.col("cls").alias("a"), F.col("comp").alias("a_comp")), "a", "left")
             .join(known.select(F.col("cls").alias("b"), F.col("comp").alias("b_comp")), "b", "left"))
    rest = sides.where(F.coalesce("a_comp", "a") != F.coalesce("b_comp", "b"))
    answers.append(compare(rest, texts, scratch, "rest"))
    comps = grown(comps, answers[-1:], "comps")
    scratch.drop("listed", "texts", "open", "mixed")
    return members, comps


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, n, cls (null: an empty set or a null id) and component_id of every document."""
    scratch = Scratch(docs.sparkSession, "ngram-join")
    members, comps = links(docs, scratch)
    named = members.join(few(comps), "cls", "left").withColumn("top", F.coalesce("comp", "cls"))
    least = named.where("top IS NOT NULL").groupBy("top").agg(F.min("doc_id").alias("least"))
    return named.join(least, "top", "left").select("doc_id", "n", "cls", F.coalesce("least", "doc_id").alias("component_id"))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return judged(id_text(docs)).select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id")


def class_column(docs: DataFrame) -> DataFrame:
    """``docs`` with the digest of each row's shingles (null: an empty set)."""
    def make():
        return lambda text: [pa.array([class_of(own) if len(own) else None for own in row_sets(text)], pa.int64())]

    return annotate(docs, "__ngram_", "cls long", make)


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns, without those whose component has a smaller id.

    Rows with one doc_id are judged by their own texts: of those with equal sets one row stays (if the
    component keeps any), those with other sets are told apart by their class. Rows with a null doc_id stay.
    """
    found = judged(id_text(docs)).where("doc_id IS NOT NULL")
    # the classes of an id; rows without a class (empty sets) are components of their own
    per_class = found.groupBy("doc_id", "cls").agg(F.min("component_id").alias("component_id"), F.count("*").alias("copies"))
    odd = per_class.where("doc_id <> component_id OR copies > 1").select(
        F.col("doc_id").alias("__ngram_key"), F.col("cls").alias("__ngram_of"), (F.col("doc_id") != F.col("component_id")).alias("__ngram_gone"))
    odd = Scratch(docs.sparkSession, "ngram-odd").write(odd, "odd")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = class_column(docs)
    same = (F.col("doc_id").cast("long") == F.col("__ngram_key")) & F.col("__ngram_cls").eqNullSafe(F.col("__ngram_of"))
    # broadcast, so that texts stay where they lie: only a list beyond BROADCAST_ROWS has them shuffled, once
    kept = marked.join(few(odd.where("__ngram_gone")), same, "left_anti")
    repeated = few(odd.where("NOT __ngram_gone"))
    if repeated.isEmpty():
        return kept.select(*columns)
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "__ngram_cls"])
    return kept.join(repeated, same, "left_anti").unionByName(once).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
