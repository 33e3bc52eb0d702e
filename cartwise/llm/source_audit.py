r"""Source divergence audit by a minimal-perfect-hash recount.

Terms are maximal runs of letters and non-ASCII characters, A-Z lower-cased. How far
the term shares of two sources of a language, or of a source and its language, lie
apart is an integer (``shares``, ``apart``).

1. Exact frequency filter: a map counts, per language, the documents that hold a
   term (partial counts leave a task when ``TABLE_TERMS`` strings are held), the
   strings are grouped, and those in at least ``MIN_DOCS`` documents are kept.
2. Kept terms are dealt into shards of a language by hash (``SHARD_TERMS`` a shard
   on average). One task a shard builds a minimal perfect hash: level after level
   of bits, a key that is alone on its bit stays, the rest go on; a key's slot is the
   number of bits before its own. The shard stores its keys in slot order.
3. Recount: shards are broadcast, about ``PASS_TERMS`` terms at a time. The words of
   each (lang, source) group are looked up in blocks; a slot counts only if its
   stored key is the word itself. Every group has a dense array of slots, which the
   counts are added to; arrays leave a task as (slot, count) lists when they hold
   ``DENSE_CELLS`` numbers. Several passes over the documents are made where the
   kept terms need more shards than one broadcast may hold.
4. One task a shard compares all its groups over the shard's slots (a matrix of
   sources x slots) and answers with a partial sum for each pair of sources and the
   ``TOP`` terms of each source. Pairs of sources are the result itself.

Counts are integers; beyond 64 bits (``count > 9e9``) shares are computed with
unbounded integers. Words of one block of text are told apart by 64-bit hashes, all
else by the strings.

Defined results: null text, lang and source count as empty strings; a group without
terms has its pairs and no terms; a language without kept terms has pairs of value 0;
a language with one source has no pairs; repeated rows are documents of their own; texts of any
length are read whole; ties go by the item's UTF-8 bytes; an empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwise.llm import textvec
from cartwise.llm.common import Scratch, ship, table

ship(__name__)

MIN_DOCS = 10
TOP = 10
TABLE_TERMS = 1 << 18
SHARD_TERMS = 1 << 12
#: Terms broadcast at once, on average (shards are dealt by hash); they fix the number of shards in a pass.
PASS_TERMS = 1 << 19
DENSE_CELLS = 1 << 23
#: Positions of a level for each key that reaches it.
SPARSITY = 1.5
LEVELS = 64
SCALE = 1_000_000_000

_SEED = 0x9E3779B97F4A7C15

#: Letters (after lower-casing, A-Z cannot occur) and all bytes of non-ASCII characters.
LETTERS = np.zeros(256, bool)
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = LETTERS[0x80:] = True


def grouped_words(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, bytes, textvec.Words, slice]]:
    """For each run of rows of one group in a block of text: its key, the block's bytes, the block's words, the run's rows.

    Rows are taken in the order of their groups, so a block holds few of them.
    """
    names = [batch.column(k).dictionary_encode() for k in keys]
    group = np.zeros(batch.num_rows, np.int64)
    for n in names:
        group = group * max(1, len(n.dictionary)) + n.indices.to_numpy()
    order = np.argsort(group, kind="stable")
    group = group[order]
    places = [n.indices.to_numpy()[order] for n in names]
    data, borders = textvec.column(batch.column("text").cast(pa.large_string()).take(pa.array(order)))
    for at, block, edges in textvec.blocks(data, borders):
        low = textvec.LOWER[block]
        found = textvec.words(low, edges, LETTERS)
        own = group[at:at + len(edges) - 1]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]).tolist()
        raw = low.tobytes()
        for a, b in zip(heads, [*heads[1:], len(own)], strict=True):
            yield tuple(n.dictionary[int(p[at + a])].as_py() for n, p in zip(names, places, strict=True)), raw, found, slice(a, b)


def distinct(found: textvec.Words, rows: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of some rows: one occurrence of each, how many occurrences, in how many rows."""
    first = found.first[rows.start:rows.stop + 1]
    if first[0] == first[-1]:
        none = np.zeros(0, np.int64)
        return none, none, none
    hashes = found.hash[first[0]:first[-1]]
    order = np.argsort(hashes, kind="stable")
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))[order]
    hashes = hashes[order]
    new = np.r_[True, hashes[1:] != hashes[:-1]]
    heads = np.flatnonzero(new)
    in_rows = np.add.reduceat(np.r_[True, row[1:] != row[:-1]] | new, heads, dtype=np.int64)
    return order[heads] + first[0], np.diff(np.r_[heads, len(hashes)]), in_rows


def document_counts(docs: DataFrame, most: int = TABLE_TERMS) -> DataFrame:
    """(lang, term, docs): partial numbers of documents that hold a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, terms in held.items():
                if terms:
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(terms)), pa.array(list(terms), pa.binary()).cast(pa.string()),
                                                      pa.array(list(terms.values()), pa.int64())], names=["lang", "term", "docs"])
            held.clear()

        for batch in batches:
            for (lang,), raw, found, rows in grouped_words(batch, ["lang"]):
                at, _, docs = distinct(found, rows)
                terms = held.setdefault(lang, {})
                for s, e, n in zip(found.start[at].tolist(), found.end[at].tolist(), docs.tolist(), strict=True):
                    term = raw[s:e]
                    terms[term] = terms.get(term, 0) + n
                if sum(map(len, held.values())) >= most:
                    yield from flush()
        yield from flush()

    return docs.select("lang", "text").mapInArrow(run, "lang string, term string, docs long")


def term_hashes(terms: pa.Array) -> np.ndarray:
    data, borders = textvec.column(terms)
    return textvec.words(data, borders, LETTERS).hash


def level_hash(hashes: np.ndarray, level: int) -> np.ndarray:
    return textvec.mix(hashes + np.uint64(_SEED * (level + 1) % (1 << 64)))


def route(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (level_hash(hashes, LEVELS) % np.uint64(shards)).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, the bits of all levels, and the keys in slot order."""
    sizes, bits, order = [], [], []
    left = np.arange(len(hashes))
    while len(left):
        if len(sizes) == LEVELS:
            raise ValueError(f"two of {len(hashes)} terms share a 64-bit hash")
        size = int(SPARSITY * len(left)) + 1
        at = (level_hash(hashes[left], len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        stays = alone[at]
        order.append(left[stays][np.argsort(at[stays])])
        left = left[~stays]
        sizes.append(size)
        bits.append(alone)
    return sizes, np.concatenate(bits), np.concatenate(order)


SHARD = "lang string, shard int, sizes array<long>, bits binary, terms array<string>"


def build_shards(kept: DataFrame, shards: int) -> DataFrame:
    """One row a shard: its perfect hash and its terms in slot order."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = route(term_hashes(batch.column("term")), shards).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("term"), pa.array(shard)], names=["lang", "term", "shard"])

    def build(own: pa.Table) -> pa.Table:
        terms = own.column("term").combine_chunks()
        sizes, bits, order = perfect_hash(term_hashes(terms))
        return pa.table([pa.array([own.column("lang")[0].as_py()]), pa.array([own.column("shard")[0].as_py()], pa.int32()), pa.array([sizes], pa.list_(pa.int64())),
                         pa.array([np.packbits(bits).tobytes()]), pa.array([terms.take(pa.array(order)).to_pylist()], pa.list_(pa.string()))],
                        names=["lang", "shard", "sizes", "bits", "terms"])

    dealt = kept.select("lang", "term").mapInArrow(deal, "lang string, term string, shard int")
    return dealt.groupBy("lang", "shard").applyInArrow(build, SHARD)


class Index:
    """The shards of one language in one pass, put together: slots count on from shard to shard."""

    def __init__(self, own: list[tuple], shards: int) -> None:
        """``own``: (shard, level sizes, packed bits, terms) of each shard."""
        self.shards = shards
        self.names = [s for s, *_ in own]
        depth = max(len(sizes) for _, sizes, _, _ in own)
        self.size, self.offset = np.zeros((depth, shards), np.int64), np.zeros((depth, shards), np.int64)
        bits, at = [], 0
        for shard, sizes, packed, _ in own:
            self.size[:len(sizes), shard] = sizes
            self.offset[:len(sizes), shard] = at + np.r_[0, np.cumsum(sizes)[:-1]]
            bits.append(np.unpackbits(np.frombuffer(packed, np.uint8), count=sum(sizes)).astype(bool))
            at += sum(sizes)
        self.bits = np.concatenate(bits)
        self.slot = np.cumsum(self.bits, dtype=np.int32) - 1
        self.first = np.r_[0, np.cumsum([len(terms) for *_, terms in own])]
        self.keys = [t.encode() for *_, terms in own for t in terms]

    def slots(self, hashes: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The slot of each word, or -1 where its stored key is another."""
        out = np.full(len(hashes), -1, np.int64)
        left = np.arange(len(hashes))
        shard = route(hashes, self.shards)
        for level in range(len(self.size)):
            size = self.size[level, shard[left]]
            left, size = left[size > 0], size[size > 0]
            if len(left) == 0:
                break
            at = self.offset[level, shard[left]] + (level_hash(hashes[left], level) % size.astype(np.uint64)).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.slot[at[hit]]
            left = left[~hit]
        for i in np.flatnonzero(out >= 0).tolist():
            if self.keys[out[i]] != raw[start[i]:end[i]]:
                out[i] = -1
        return out


def recount(docs: DataFrame, shards: int, loaded: list[tuple], cells: int = DENSE_CELLS) -> DataFrame:
    """(lang, source, shard, slot, n): partial counts of one pass. ``loaded``: the rows of ``SHARD`` of this pass."""
    by_lang: dict[str, list[tuple]] = {}
    for lang, *own in loaded:
        by_lang.setdefault(lang, []).append(tuple(own))
    shared = docs.sparkSession.sparkContext.broadcast(by_lang)  # size: about PASS_TERMS terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {lang: Index(own, shards) for lang, own in shared.value.items()}
        dense: dict[tuple, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in dense.items():
                own = index[lang]
                used = np.flatnonzero(counts)
                parts = np.searchsorted(used, own.first)
                slots = [used[a:b] - base for a, b, base in zip(parts[:-1], parts[1:], own.first[:-1], strict=True)]
                offsets = pa.array(parts.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own.names)), pa.array([source] * len(own.names)), pa.array(own.names, pa.int32()),
                                                  pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(slots).astype(np.int32))),
                                                  pa.ListArray.from_arrays(offsets, pa.array(counts[used]))], names=["lang", "source", "shard", "slot", "n"])
            dense.clear()

        for batch in batches:
            for key, raw, found, rows in grouped_words(batch, ["lang", "source"]):
                own = index.get(key[0])
                if own is None:
                    continue
                at, times, _ = distinct(found, rows)
                if len(at) == 0:
                    continue
                slots = own.slots(found.hash[at], raw, found.start[at], found.end[at])
                if key not in dense:
                    if dense and sum(map(len, dense.values())) + len(own.keys) > cells:
                        yield from flush()
                    dense[key] = np.zeros(len(own.keys), np.int64)
                dense[key][slots[slots >= 0]] += times[slots >= 0]
        yield from flush()

    packed = docs.mapInArrow(run, "lang string, source string, shard int, slot array<int>, n array<long>")
    return packed.select("lang", "source", "shard", F.inline(F.arrays_zip("slot", "n")))


def shares(counts: np.ndarray, total, kept: int) -> np.ndarray:
    """``1 + floor(SCALE (count + 2) / (total + 2 kept))``, exact for counts of any size."""
    room = total + 2 * kept
    if int(counts.max(initial=0)) + 2 > np.iinfo(np.int64).max // SCALE:
        return np.array([1 + SCALE * (int(c) + 2) // int(room) for c in counts.ravel()], np.int64).reshape(counts.shape)
    return 1 + SCALE * (counts + 2) // np.int64(room)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def compare(cells: pa.Table, shard: pa.Table) -> pa.Table:
    """One shard: (part, source, item, value) partial sums of pairs (source < item) and each source's best terms.

    ``cells`` has a row with slot -1 for each source (``n``: its total over all
    shards, ``kept``: the language's number of kept terms) and the counts.
    """
    lang = shard.column("lang")[0].as_py()
    terms = shard.column("terms")[0].as_py()
    slot, n = cells.column("slot").to_numpy(), cells.column("n").to_numpy()
    source = np.array(cells.column("source").to_pylist(), object)
    head = slot < 0
    order = np.argsort(source[head])
    names, totals = source[head][order].tolist(), n[head][order]
    kept = int(cells.column("kept").to_numpy()[head][0])
    place = {s: i for i, s in enumerate(names)}
    counts = np.zeros((len(names), len(terms)), np.int64)
    counts[[place[s] for s in source[~head]], slot[~head]] = n[~head]
    p = np.stack([shares(c, total, kept) for c, total in zip(counts, totals, strict=True)])
    q = shares(counts.sum(axis=0), totals.sum(), kept)
    rows = []
    for a in range(len(names) - 1):
        value = apart(p[a], p[a + 1:]).sum(axis=1)
        rows.extend(("pair", names[a], b, v) for b, v in zip(names[a + 1:], value.tolist(), strict=True))
    for a, name in enumerate(names):
        more = np.flatnonzero((counts[a] > 0) & (p[a] > q))
        value = apart(p[a][more], q[more])
        if len(more) > TOP:  # ties with the last place stay until they are sorted by term
            stay = value >= np.partition(value, len(value) - TOP)[-TOP]
            more, value = more[stay], value[stay]
        best = sorted(zip((-value).tolist(), (terms[i] for i in more.tolist()), strict=True))[:TOP]
        rows.extend(("term", name, term, -v) for v, term in best)
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.table([pa.array([lang] * len(rows), pa.string()), *(pa.array(list(c), t) for c, t in zip(columns, (pa.string(),) * 3 + (pa.int64(),), strict=True))],
                    names=["lang", "part", "source", "item", "value"])


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, shard_terms: int = SHARD_TERMS, pass_terms: int = PASS_TERMS) -> DataFrame:
    """lang, source, part, item, value and rank: every pair of sources of a language, and the terms that set a source apart."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "source-audit")
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    groups = docs.select("lang", "source").distinct()
    counted = document_counts(docs).groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
    kept = scratch.write(counted.select("lang", "term"), "kept")
    n_kept = kept.count()
    shards = -(-n_kept // shard_terms)
    pairs = groups.join(groups.withColumnRenamed("source", "item"), "lang").where("source <> item")
    place = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    if not shards:
        nothing = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
        return nothing.withColumn("rank", F.row_number().over(place))

    built = scratch.write(build_shards(kept, shards), "shards")
    pass_shards = max(1, built.count() * pass_terms // n_kept)
    numbered = built.select("lang", "shard").withColumn("turn", F.floor((F.row_number().over(Window.orderBy("shard", "lang")) - 1) / pass_shards).cast("int"))
    turns = scratch.write(numbered, "turns")  # one small row a shard
    counts = None
    for turn in range(turns.agg(F.max("turn")).first()[0] + 1):
        loaded = built.join(turns.where(F.col("turn") == turn), ["lang", "shard"]).select("lang", "shard", "sizes", "bits", "terms").collect()
        one = recount(docs, shards, [tuple(r) for r in loaded]).groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))
        one = scratch.write(one, f"counts-{turn}")
        counts = one if counts is None else counts.unionByName(one)

    totals = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left").na.fill(0, ["n"])
    kept_in = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    heads = totals.join(kept_in, "lang").join(turns.select("lang", "shard"), "lang").select("lang", "shard", "source", F.lit(-1).alias("slot"), "n", "kept")
    cells = heads.unionByName(counts.withColumn("kept", F.lit(None).cast("long")).select("lang", "shard", "source", "slot", "n", "kept"))
    found = scratch.write(cells.groupBy("lang", "shard").cogroup(built.select("lang", "shard", "terms").groupBy("lang", "shard")).applyInArrow(
        compare, "lang string, part string, source string, item string, value long"), "found")

    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    valued = pairs.join(both, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    all_rows = valued.unionByName(found.where("part = 'term'").select("lang", "source", "part", "item", "value"))
    return all_rows.withColumn("rank", F.row_number().over(place)).where((F.col("part") == "pair") | (F.col("rank") <= TOP))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occurrences AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term FROM occurrences GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM occurrences JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT s.lang, s.source, coalesce(sum(c), 0) AS n FROM sources s LEFT JOIN counts USING (lang, source) GROUP BY s.lang, s.source),
own AS (
  SELECT t.lang, t.source, k.term, coalesce(c, 0) AS c,
         1 + (1000000000 * (coalesce(c, 0) + 2)) // CAST(t.n + 2 * v AS BIGINT) AS p
  FROM totals t JOIN kept k USING (lang) JOIN size USING (lang) LEFT JOIN counts x ON x.lang = t.lang AND x.source = t.source AND x.term = k.term),
whole AS (
  SELECT lang, term, 1 + (1000000000 * (c + 2)) // CAST(n + 2 * v AS BIGINT) AS q
  FROM (SELECT lang, term, CAST(sum(c) AS BIGINT) AS c FROM counts GROUP BY lang, term)
  JOIN (SELECT lang, sum(n) AS n FROM totals GROUP BY lang) USING (lang) JOIN size USING (lang)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM own a JOIN own b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT)
  FROM own JOIN whole USING (lang, term) WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""
