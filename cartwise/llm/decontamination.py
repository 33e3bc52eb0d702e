"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters.
Of every ``WINDOW - GRAM + 1`` consecutive ``GRAM``-word hashes the minimum (the
rightmost of equals) is a fingerprint, in documents and benchmark items alike.
Two equal spans of ``WINDOW`` words hold the same run of gram hashes, so they
always share a fingerprint: joining fingerprints misses no such span. Each hit
is extended to the document windows that contain it, and those are looked up
among the items' windows; every word of an occurring window is hit. An item
of fewer than ``WINDOW`` words is one window; winnowing guarantees nothing
that short, so such windows are looked up at every document word.

The benchmark is the query set: it is read in blocks of at most about
``BLOCK_BYTES`` of text (by a hash of the item), each indexed in numpy on the
driver (about 12 bytes a benchmark word, no Python object per word) and
broadcast as sorted arrays, and documents pass through one map per block
without any shuffle.

Defined results: null and empty texts have no words and are clean; items
without words occur nowhere; items with the same id count once, a null
item_id is written as an empty string; repeated documents give repeated rows;
an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import textvec
from cartwise.llm.common import Scratch, annotate, id_text, ship, table

ship(__name__)

WINDOW = 10
GRAM = 6
BLOCK_BYTES = 16 << 20
#: Blocks that documents pass in one stage; then they are written and read again.
BLOCKS_IN_STAGE = 8

PREFIX = "__decontamination_"
FIELDS = "n_words long, hit_start array<long>, hit_end array<long>, items array<string>"


class Index(NamedTuple):
    """Fingerprints, item names, and by window length: sorted window hashes, where the items of each begin, item numbers."""

    fingerprints: np.ndarray
    names: list[str]
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def winnow(gram_hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the minimum (rightmost of equals) of every ``width`` consecutive hashes."""
    n = len(gram_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least, at = gram_hashes[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        other = gram_hashes[j:j + n]
        lower = other <= least
        least[lower] = other[lower]
        at[lower] = j
    return np.unique(at + np.arange(n))


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted array, or -1."""
    if len(ordered) == 0 or len(values) == 0:
        return np.full(len(values), -1, np.int64)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return np.where(ordered[at] == values, at, -1)


def build_index(items: pa.Table) -> Index:
    """Index of a table of (item, text), built in blocks of whole items."""
    import pyarrow.compute as pc

    ids = items["item"].combine_chunks()
    names = pc.unique(ids)
    number = np.asarray(pc.index_in(ids, names), np.int32)
    data, borders = textvec.column(items["text"])
    prints, held = [], {}
    for at, block, edges in textvec.blocks(data, borders):
        found = textvec.words(textvec.LOWER[block], edges, textvec.ALNUM)
        n_words = np.diff(found.first)
        row = np.repeat(np.arange(len(n_words)), n_words)
        row_end, size = found.first[1:][row], np.minimum(n_words, WINDOW)[row]
        for length in np.unique(size).tolist():
            starts = np.flatnonzero(size == length)
            starts = starts[starts + length <= row_end[starts]]
            held.setdefault(length, []).append((textvec.grams(found.hash, length)[starts], number[at + row[starts]]))
        grams = textvec.grams(found.hash, GRAM)
        picked = winnow(grams, WINDOW - GRAM + 1)
        # fingerprints of windows across two items are left out where their gram is, and are harmless otherwise
        prints.append(np.unique(grams[picked[picked + GRAM <= row_end[picked]]]))
    tables = {}
    for length, parts in held.items():
        hashes, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((owner, hashes))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
        order, first = np.unique(hashes, return_index=True)
        tables[length] = (order, np.append(first, len(hashes)), owner)
    return Index(np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64), names.to_pylist(), tables)


def find_windows(index: Index, found: textvec.Words) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each window length: positions (in the block's words) where an item's window begins, and which window."""
    out = []
    n = len(found.hash)
    row_end = np.repeat(found.first[1:], np.diff(found.first))
    for length, (hashes, _, _) in index.windows.items():
        if length == WINDOW:
            grams = textvec.grams(found.hash, GRAM)
            picked = winnow(grams, WINDOW - GRAM + 1)
            picked = picked[among(grams[picked], index.fingerprints) >= 0]
            starts = np.unique((picked[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
            starts = starts[(starts >= 0) & (starts + WINDOW <= n)]
        else:
            starts = np.arange(max(0, n - length + 1))
        starts = starts[starts + length <= row_end[starts]]
        if len(starts):
            if length == WINDOW:
                keys = textvec.grams(found.hash[(starts[:, None] + np.arange(WINDOW)).ravel()], WINDOW)[::WINDOW]
            else:
                keys = textvec.grams(found.hash, length)[starts]
            at = among(keys, hashes)
            out.append((length, starts[at >= 0], at[at >= 0]))
    return out


def match(index: Index, text: pa.Array) -> list[pa.Array]:
    """The added columns of one batch: word count, hit word ranges, and items of every row."""
    data, borders = textvec.column(text)
    n_rows = len(borders) - 1
    n_words, starts, ends, items = np.zeros(n_rows, np.int64), [[] for _ in range(n_rows)], [[] for _ in range(n_rows)], [set() for _ in range(n_rows)]
    for at, block, edges in textvec.blocks(data, borders):
        found = textvec.words(textvec.LOWER[block], edges, textvec.ALNUM)
        n_words[at:at + len(edges) - 1] = np.diff(found.first)
        if len(found.hash) == 0:
            continue
        for length, begin, which in find_windows(index, found):
            _, first, owner = index.windows[length]
            rows = np.searchsorted(found.first, begin, side="right") - 1
            for r, b, w in zip(rows.tolist(), (begin - found.first[rows]).tolist(), which.tolist(), strict=True):
                if ends[at + r] and starts[at + r][-1] <= b <= ends[at + r][-1]:
                    ends[at + r][-1] = max(ends[at + r][-1], b + length)
                else:
                    starts[at + r].append(b)
                    ends[at + r].append(b + length)
                items[at + r].update(owner[first[w]:first[w + 1]].tolist())
    return [pa.array(n_words), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())),
            pa.array([sorted(index.names[i] for i in s) for s in items], pa.list_(pa.string()))]


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The benchmark in blocks of bounded size, one at a time on the driver."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // block_bytes)
    for b in range(n):
        yield items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).toArrow()


def mark(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with one struct column ``PREFIX + "blocks"``: word count, hit ranges and items over all blocks."""
    spark = docs.sparkSession
    columns = docs.columns
    held = PREFIX + "blocks"
    out, scratch, count = docs, None, 0
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def one_block(out: DataFrame, items: pa.Table | None) -> DataFrame:
        index = build_index(items) if items is not None else Index(np.zeros(0, np.uint64), [], {})
        shared = spark.sparkContext.broadcast(tuple(index))  # size: a block's; plain types, as broadcasts pickle classes by name
        out = annotate(out, PREFIX, FIELDS, lambda: lambda text: match(Index(*shared.value), text))
        new = F.struct(*(F.col(PREFIX + f).alias(f) for f in names))
        old = [F.col(held)] if held in out.columns else []
        return out.select(*(F.col(f"`{c}`") for c in columns), F.concat(*old, F.array(new)).alias(held))

    for items in benchmark_blocks(benchmark, block_bytes):
        out = one_block(out, items)
        count += 1
        if count % BLOCKS_IN_STAGE == 0:
            scratch = scratch or Scratch(spark, "decontamination")
            out = scratch.write(out, f"pass-{count}")
    return out if count else one_block(out, None)


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the hit word ranges of every document."""
    marked = mark(id_text(docs), benchmark, block_bytes).select("doc_id", F.col(PREFIX + "blocks").alias("blocks"))
    ranges = F.flatten(F.transform("blocks", lambda b: F.arrays_zip(b["hit_start"].alias("hit_start"), b["hit_end"].alias("hit_end"))))
    # overlapping ranges (of different windows or blocks) counted once, in order
    step = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    covered = F.aggregate(F.sort_array(ranges), step, lambda acc, r: F.struct(
        (acc["n"] + F.greatest(F.lit(0), r["hit_end"] - F.greatest(acc["upto"], r["hit_start"]))).alias("n"),
        F.greatest(acc["upto"], r["hit_end"]).alias("upto")), lambda acc: acc["n"])
    items = F.sort_array(F.array_distinct(F.flatten(F.transform("blocks", lambda b: b["items"]))))
    return marked.select("doc_id", F.col("blocks")[0]["n_words"].alias("n_words"), covered.alias("n_hit"),
                         F.size(items).cast("long").alias("n_items"),
                         F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
                         (covered > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns, that no benchmark window touches."""
    marked = mark(docs, benchmark, block_bytes)
    dirty = F.exists(F.col(PREFIX + "blocks"), lambda b: F.size(b["hit_start"]) > 0)
    return marked.where(~dirty).select(*(F.col(f"`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH low AS (
  SELECT 'd' AS side, row_number() OVER () AS n, doc_id, '' AS item, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(item_id::VARCHAR, ''), text FROM benchmark),
split AS (
  SELECT side, n, doc_id, item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
items AS (SELECT item, w, least(10, len(w)) AS size FROM split WHERE side = 'b' AND len(w) > 0),
item_windows AS (
  SELECT DISTINCT item, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM items)),
docs AS (SELECT n, doc_id, w, len(w) AS n_words FROM split WHERE side = 'd'),
sizes AS (SELECT DISTINCT size FROM items),
doc_windows AS (
  SELECT n, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
  FROM (SELECT n, w, size, unnest(range(1, n_words - size + 2)) AS i FROM docs, sizes)),
hits AS (SELECT d.n, d.i, d.size, b.item FROM doc_windows d JOIN item_windows b USING (size, win)),
hit_words AS (
  SELECT n, count(*) AS n_hit FROM (SELECT DISTINCT n, unnest(range(i, i + size)) AS i FROM (SELECT DISTINCT n, i, size FROM hits)) GROUP BY n),
hit_items AS (SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT n, item FROM hits) GROUP BY n)
SELECT doc_id, n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (n) LEFT JOIN hit_items USING (n)
"""
