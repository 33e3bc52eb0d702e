r"""Ranked lexical search: accumulator-limited term-at-a-time over document shards.

Terms are maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased.
A term's weight is ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``; a document's
score for an item sums ``w * ((10^9 tf) div (1000 tf + 8 m))`` over the item's
terms, with ``m = 100 - 90 + (90 n N) div L``.

The items are the stated query set. They are taken in blocks of at most about
``BLOCK_BYTES`` of text (by a hash of the item), whose vocabulary is broadcast. One
map over the documents writes each one's length and its (term, tf) pairs of that
vocabulary; N, L and df are sums over that table. A second map ranks: each Arrow
batch of documents is a shard with its own inverted lists, and each item goes
through its terms one at a time, rarest first:

* while new accumulators may still matter, a term's documents all get one;
* once the sum of the remaining terms' bounds (weight times the shard's largest
  contribution) is below the 10th best partial score (of this shard, or of an earlier
  shard of the task), no document without an accumulator can reach the list: none is
  created any more. Equal is not below, as ties go by doc_id;
* survivors are then updated exactly, and dropped when their partial score and
  the remaining bounds fall below the 10th best.

A shard answers with at most 10 rows an item; those are merged in two steps (by a
hash of the document, then by item), so that no task reads all shards' rows at once.

Words are compared by 64-bit hashes; a wrong answer needs a collision with one of
the items' terms (2^-64 a pair).

Defined results: null, empty and term-free texts add nothing to N and L and are never
ranked; items without terms or without a matching document return no row; rows with
one item_id (null too) are one item with the terms of all; documents that repeat are
ranked each; a null doc_id comes last among equal scores; empty tables give an empty
result; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwise.llm import textvec
from cartwise.llm.common import Scratch, id_text, ship, table

ship(__name__)

BEST = 10
BLOCK_BYTES = 4 << 20
#: Parts of an item's rows that are ranked on their own before the item is.
SALTS = 16
LAST_ID = np.iinfo(np.int64).max


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of bounded size, one at a time on the driver; rows of one id share a block."""
    rows = items.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = -(-size // block_bytes)
    for b in range(n):
        yield [(r.item, r.text) for r in rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b).collect()]


def item_terms(items: list[tuple[str | None, str]]) -> tuple[list[str | None], np.ndarray, list[np.ndarray]]:
    """Item ids, the sorted vocabulary of term hashes, and each item's terms as places in it."""
    data, borders = textvec.column(pa.array([text for _, text in items], pa.large_string()))
    found = textvec.words(textvec.LOWER[data], borders, textvec.ALNUM)
    held: dict = {}
    for i, (item, _) in enumerate(items):
        held.setdefault(item, []).append(found.hash[found.row(i)])
    vocabulary = np.unique(found.hash)
    return list(held), vocabulary, [np.unique(np.searchsorted(vocabulary, np.concatenate(h))) for h in held.values()]


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """(doc_id, n, terms, tfs): all terms of a document counted, those of the vocabulary listed."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # size: the terms of one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        maybe = np.zeros(1 << 20, bool)
        maybe[known >> np.uint64(44)] = True
        width = max(1, len(known))
        for batch in batches:
            data, borders = textvec.column(batch.column("text"))
            length, count = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            terms, tfs = [], []
            for at, block, edges in textvec.blocks(data, borders):
                found = textvec.words(textvec.LOWER[block], edges, textvec.ALNUM)
                rows = np.diff(found.first)
                length[at:at + len(rows)] = rows
                hit = np.flatnonzero(maybe[found.hash >> np.uint64(44)])
                if len(hit) == 0:
                    continue
                place = np.searchsorted(known, found.hash[hit])
                place[place == len(known)] = 0
                same = known[place] == found.hash[hit]
                row = (np.searchsorted(found.first, hit[same], side="right") - 1).astype(np.int64)
                pairs, tf = np.unique(row * width + place[same], return_counts=True)
                count[at:at + len(rows)] = np.bincount(pairs // width, minlength=len(rows))
                terms.append((pairs % width).astype(np.int32))
                tfs.append(tf.astype(np.int64))
            offsets = pa.array(np.r_[0, np.cumsum(count)].astype(np.int32))
            flat = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((terms, np.int32), (tfs, np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(length), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in flat)],
                                             names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


class Shard:
    """The inverted lists of one batch of documents: per term, documents ascending and their contributions."""

    def __init__(self, counts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n: np.ndarray, total: int, length: int) -> None:
        doc = np.repeat(np.arange(len(counts)), counts)
        m = 10 + (90 * n * total) // length
        order = np.argsort(terms, kind="stable")
        terms = terms[order]
        self.doc = doc[order]
        tf = tfs[order]
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc])
        heads = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
        most = np.maximum.reduceat(self.gain, heads) if len(heads) else heads
        self.lists = {t: (a, b, g) for t, a, b, g in zip(terms[heads].tolist(), heads.tolist(), [*heads[1:].tolist(), len(terms)], most.tolist(), strict=True)}
        self.score = np.zeros(len(counts), np.int64)

    def rank(self, terms: list[int], weight: np.ndarray, ids: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of one item, best first, at most ``BEST``; ``terms`` rarest first.

        ``floor`` is a score that ``BEST`` documents are known to reach: what stays below it may be left out.
        """
        lists = [(*self.lists[t], int(weight[t])) for t in terms if t in self.lists]
        rest = np.r_[np.cumsum([g * w for _, _, g, w in lists][::-1])[::-1], 0].tolist()
        score, touched, step = self.score, [], 0
        for step, (a, b, _, w) in enumerate(lists):  # noqa: B007
            if rest[step] < floor:
                break  # no document without an accumulator can reach the list
            score[self.doc[a:b]] += w * self.gain[a:b]
            touched.append(self.doc[a:b])
            if len(score) > BEST:
                floor = max(floor, int(np.partition(score, len(score) - BEST)[-BEST]))
        else:
            step = len(lists)
        alive = np.unique(np.concatenate(touched)) if touched else np.zeros(0, np.int64)
        own = score[alive]
        score[alive] = 0
        for at in range(step, len(lists)):
            stay = own + rest[at] >= floor
            alive, own = alive[stay], own[stay]
            a, b, _, w = lists[at]
            docs = self.doc[a:b]
            place = np.searchsorted(docs, alive)
            place[place == len(docs)] = 0
            hit = docs[place] == alive
            own[hit] += w * self.gain[a:b][place[hit]]
            if len(own) > BEST:
                floor = max(floor, int(np.partition(own, len(own) - BEST)[-BEST]))
        stay = (own > 0) & (own >= floor)
        alive, own = alive[stay], own[stay]
        order = np.lexsort((ids[alive], -own))[:BEST]
        return alive[order], own[order]


def ranked(lists: DataFrame, names: list[str | None], terms: list[list[int]], weight: np.ndarray, total: int, length: int) -> DataFrame:
    """(item, doc_id, score): every shard's best documents of every item."""
    shared = lists.sparkSession.sparkContext.broadcast((names, terms, weight))  # size: one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms, weight = shared.value
        best = [np.zeros(0, np.int64) for _ in names]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            counts = np.diff(batch.column("terms").offsets.to_numpy())
            shard = Shard(counts, batch.column("terms").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy(),
                          batch.column("n").to_numpy(), total, length)
            ids = batch.column("doc_id").fill_null(LAST_ID).to_numpy()
            out = []
            for item, own in enumerate(terms):
                held = best[item]
                docs, scores = shard.rank(own, weight, ids, int(held[0]) if len(held) == BEST else 0)
                if len(docs):
                    best[item] = np.sort(np.r_[held, scores])[-BEST:]
                    out.append((np.full(len(docs), item), docs, scores))
            if out:
                item, docs, scores = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(item)), batch.column("doc_id").take(pa.array(docs)),
                                                  pa.array(scores)], names=["item", "doc_id", "score"])

    return lists.mapInArrow(run, "item string, doc_id long, score long")


def top(rows: DataFrame, by: list[str]) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return rows.withColumn("rank", place).where(F.col("rank") <= BEST)


def search(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``BEST`` documents."""
    docs = id_text(docs)
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    out = spark.createDataFrame([], "item string, doc_id long, score long")
    for b, block in enumerate(item_blocks(items, block_bytes)):
        names, vocabulary, terms = item_terms(block)
        lists = scratch.write(postings(docs, vocabulary), f"postings-{b}")
        total, length = lists.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not total:
            break
        frequency = np.zeros(len(vocabulary), np.int64)
        for term, df in lists.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's terms
            frequency[term] = df
        weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)
        rarest = [own[np.lexsort((own, frequency[own]))].tolist() for own in terms]
        found = ranked(lists.where(F.size("terms") > 0), names, rarest, weight, total, length)
        out = out.unionByName(scratch.write(found, f"found-{b}"))
        scratch.drop(f"postings-{b}")
    salted = top(out.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))), ["item", "salt"])
    kind = items.schema["item_id"].dataType
    return top(salted.drop("rank"), ["item"]).select(F.col("item").cast(kind).alias("item_id"), "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
whole AS (SELECT count(*) FILTER (len(w) > 0) AS total, CAST(coalesce(sum(len(w)), 0) AS BIGINT) AS length FROM docs),
occurrences AS (SELECT d, unnest(w) AS term FROM docs),
postings AS (SELECT d, term, count(*) AS tf FROM occurrences WHERE term IN (SELECT term FROM items) GROUP BY d, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(total) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM postings, whole GROUP BY term),
lengths AS (SELECT d, doc_id, 10 + (90 * len(w) * total) // length AS m FROM docs, whole WHERE len(w) > 0),
scores AS (
  SELECT item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM items JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (d) GROUP BY item_id, d, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
