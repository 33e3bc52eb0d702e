r"""SimHash near-duplicates by multi-index hashing.

A text is lower-cased (A-Z) and cut into words at ASCII white space; each of its
3-word shingles (repeats included, joined by one space; a shorter text is one
shingle) is hashed with XXH64, seed 42. A bit of the 64-bit fingerprint is set if
more than half of the hashes have it.

Two fingerprints link at ``RADIUS`` = 3 or fewer differing bits. Multi-index hashing:
the fingerprint is cut into two segments of 32 bits; of two linked ones at least one
segment differs in at most one bit. Every distinct fingerprint is put into a table
under both its segments (it *owns* these keys) and looks up the ball of radius one
around each. Of two segments one bit apart only one has a 0 there, so a ball needs
only the keys with one more bit set: 16 on average in place of 32. Keys that
nobody owns are dropped; what meets under a key is verified on the whole fingerprint.

All work is on distinct fingerprints, so copies cost one row each. A key under
which more than ``CELL`` fingerprints meet is cut into blocks by hash, and every
pair of blocks is a cell of its own, so no task holds more than two blocks. A cell
answers with edges that connect what it found linked, not with all pairs: at
most one less than its fingerprints, or 28 in cells of up to ``SMALL``. Components
come from all edges together; no cap applies and no link is lost. Joins are merge
joins, so nothing that grows with the documents passes through the driver.

Defined results: null, empty and word-free texts have fingerprint zero, linked like
any other; very long texts are hashed in pieces; repeated rows give repeated
results; a row with a null doc_id has its fingerprint, links with nothing and its
component is null; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import textvec
from cartwise.llm.common import Scratch, id_text, shuffle_parts, ship, table
from cartwise.llm.components import components

ship(__name__)

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints that meet under one key in one task.
CELL = 2048
#: Fingerprints up to which a group's pairs are compared by their distance in the sorted rows, many groups at once.
SMALL = 8
#: Shingles whose bits are counted at once.
PIECE = 1 << 17


def text_fingerprint(low: bytes) -> int:
    """The fingerprint of one lower-cased text."""
    from xxhash import xxh64_intdigest

    words = low.split()  # of bytes: at 0x20 and 0x09-0x0D, as the contract says
    n = max(1, len(words) - SHINGLE + 1)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    ends = (ends[SHINGLE - 1:] if len(words) >= SHINGLE else ends[-1:]).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, PIECE):
        hashes = np.array([xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[at:at + PIECE], ends[at:at + PIECE], strict=True)], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, borders = textvec.column(batch.column("text"))
            out = np.zeros(batch.num_rows, np.uint64)
            for first, block, edges in textvec.blocks(data, borders):
                low = textvec.LOWER[block].tobytes()
                for r, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
                    out[first + r] = text_fingerprint(low[a:b])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out.view(np.int64))], names=["doc_id", "fp"])

    return docs.mapInArrow(run, "doc_id long, fp long")


def table_rows(prints: DataFrame) -> DataFrame:
    """(key, fp, own) of distinct fingerprints: the keys that each owns, and those of its balls."""
    segment = "explode(array(struct(0L AS part, fp & 4294967295L AS value), struct(4294967296L AS part, shiftrightunsigned(fp, 32) AS value))) AS s"
    ball = ("explode(concat(array(struct(s.value AS v, true AS own)), transform(filter(sequence(0, 31), b -> (s.value & shiftleft(1L, b)) = 0), "
            "b -> struct(s.value | shiftleft(1L, b) AS v, false AS own)))) AS e")
    return prints.selectExpr("fp", segment).selectExpr("fp", "s.part", ball).selectExpr("part | e.v AS key", "fp", "e.own AS own")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def connect(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect the linked fingerprints of one cell: from each reached one to all that it reaches first."""
    edges, left = [], np.arange(len(prints))
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            now = reached.pop()
            near = distance(prints[left], prints[now]) <= RADIUS
            if near.any():
                found, left = left[near], left[~near]
                edges.append((np.full(len(found), prints[now]), prints[found]))
                reached.extend(found.tolist())
    return edges


def verified(rows: DataFrame) -> DataFrame:
    """(u, v) edges between fingerprints that meet in a cell (key, i, j) and link."""
    def of_groups(cells: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole cells: rows of equal ``cells`` numbers are consecutive."""
        heads = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
        sizes = np.diff(np.r_[heads, len(cells)])
        edges = []
        few = np.repeat(sizes <= SMALL, sizes)
        small, number = prints[few], cells[few]
        for lag in range(1, min(SMALL, len(small))):
            near = (number[lag:] == number[:-lag]) & (distance(small[lag:], small[:-lag]) <= RADIUS)
            edges.append((small[:-lag][near], small[lag:][near]))
        for h, n in zip(heads[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
            edges.extend(connect(prints[h:h + n]))
        if edges:
            u, v = (np.concatenate(side).view(np.int64) for side in zip(*edges, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, last, number = None, None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key, i, j = (batch.column(c).to_numpy() for c in ("key", "i", "j"))
            prints = batch.column("fp").to_numpy().view(np.uint64)
            fresh = np.r_[last != (key[0], i[0], j[0]), (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
            cells = number + np.cumsum(fresh)
            last, number = (key[-1], i[-1], j[-1]), int(cells[-1])
            if rest is not None:
                cells, prints = np.r_[rest[0], cells], np.r_[rest[1], prints]
            whole = int(np.searchsorted(cells, number))  # the last cell may go on in the next batch
            yield from of_groups(cells[:whole], prints[:whole])
            rest = cells[whole:], prints[whole:]
        if rest is not None:
            yield from of_groups(*rest)

    parts = shuffle_parts(rows.sparkSession)
    return rows.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, "u long, v long")


def edges(prints: DataFrame, cell: int = CELL) -> DataFrame:
    """Edges whose components are those of all links between distinct fingerprints."""
    rows = table_rows(prints)
    live = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("owned")).where("owned AND n > 1").select(
        "key", F.ceil(F.col("n") / cell).alias("blocks"))
    # a merge join whatever the planner expects: it judges the rows by the file before each fingerprint became 34 of them
    met = rows.join(live.hint("merge"), "key").withColumn("block", F.pmod(F.xxhash64("fp", "key"), F.col("blocks")))
    cells = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda x: F.struct(F.least(x, "block").alias("i"), F.greatest(x, "block").alias("j")))
    placed = met.select("key", "fp", F.explode(cells).alias("c")).select("key", "c.i", "c.j", "fp")
    return verified(placed)


def near_duplicates(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    docs = id_text(docs)
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.write(fingerprints(docs), "fingerprints")
    classes = scratch.write(marked.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    comps = components(edges(classes.select("fp"), cell), scratch).select(F.col("u").alias("fp"), F.col("v").alias("comp"))
    named = classes.join(comps.hint("merge"), "fp", "left").withColumn("top", F.coalesce("comp", "fp"))
    least = named.groupBy("top").agg(F.min("least").alias("component_id"))
    of_class = named.join(least.hint("merge"), "top").select("fp", "component_id")
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return marked.join(of_class.hint("merge"), "fp", "left").select("doc_id", hexed.alias("fingerprint"),
                                                      F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
