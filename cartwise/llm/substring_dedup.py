r"""Substring dedup by hashing text units: the earliest occurrence of a unit stays, later ones go.

A unit is a line, or with ``units="sentence"`` (the default) a sentence of a
line: a line is cut after ``.``, ``!`` or ``?`` and before a capitalised word.
A passage pasted into the middle of a line need not hold such a border. So texts are also
cut where their words alone say so: before a word whose hash (of it and the next word) is
smaller than those of the ``REACH`` words on either side. Such pieces have at least ``REACH`` + 1
words, 7 on average, and are cut alike wherever the passage stands; two adjacent
pieces, so 8 words or more, are a unit. Of a passage without sentence borders everything
between its first and its last own cut goes; on average 6 words at either end stay.
For pieces, a code point of a script without spaces is a word (half a
word when a run is measured), and only ASCII letters change case. Units are
normalised (lower case, single spaces) and hashed; the smallest doc_id that has
a key keeps it (inside a document the first position does; units that overlap
their first position stay). Repeated units of a document go in runs: a run
is removed if it has at least ``MIN_WORDS`` words or ``WORD_POINTS``
times as many code points, so that a short phrase which happens to recur is left
alone. Whole lines and paragraphs have no minimum.

Keys are 64 bits, shuffled packed (8 bytes and a share of a doc_id each) into
parts that a task sorts one at a time. A document lists only keys that an
earlier document has, never another document's text. A key that every document
has costs its part 16 bytes a document.

Defined results: null text stays null and has no units; a text may become
empty; texts of any length are read whole, one batch of them at a time; an empty table gives an
empty result. Rows of one doc_id rank together, so repeated rows keep the same units;
rows with a null doc_id are left as they are and rank nowhere. A column of ``docs`` that begins
with ``__substring_`` is refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwise.llm import textvec
from cartwise.llm.common import id_text, lean, shuffle_parts, ship, table

ship(__name__)

MIN_WORDS = 8
#: Words on either side that a cut inside a text is the smallest of.
REACH = 3
#: Code points that count as a word where a run of units between borders has few spaces.
WORD_POINTS = 6
#: Keys that a task packs at once.
PACK = 2 << 20
PREFIX = "__substring_"

#: What separates two units.
BORDERS = {"line": r"\n", "paragraph": r"\n\s*\n",
           "sentence": r"\n|(?<=[.!?])[^\S\n]+|[^\S\n]+(?=\p{Lu}(?:\p{Ll}|\s|$))"}


def sentences(text: str, border: regex.Pattern) -> list[tuple[int, int, bytes, int]]:
    """Start, end, digest and word count of each unit between borders that has a word."""
    out, at = [], 0
    edges = [m.span() for m in border.finditer(text)]
    edges.append((len(text), len(text)))
    for begin, end in edges:
        words = text[at:begin].lower().split()
        if words:
            out.append((at, begin, blake2b(" ".join(words).encode(), digest_size=16).digest(), len(words)))
        at = end
    return out


def lone(data: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Marks of the bytes at which a code point of a script without spaces begins, and of those and the bytes after one."""
    if len(data) == 0 or data.max() < 0xE0:
        return None
    second = np.r_[data[1:], np.uint8(0)]
    lead = (((data >= 0xE3) & (data <= 0xE9)) | ((data == 0xE0) & (second >= 0xB8) & (second <= 0xBB))
            | ((data == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F)))
            | ((data == 0xF0) & (second >= 0xA0)))
    cuts = lead.copy()
    at = np.flatnonzero(lead)
    after = at + np.where(data[at] == 0xF0, 4, 3)
    cuts[after[after < len(data)]] = True
    return lead, cuts


def tokens(data: np.ndarray, borders: np.ndarray) -> textvec.Words:
    """Words of a block of texts, ASCII letters in lower case; a code point of a script without spaces is one."""
    marks = lone(data)
    return textvec.words(textvec.LOWER[data], borders, textvec.NOT_SPACE, None if marks is None else marks[1])


def whole_text(border: regex.Pattern) -> bool:
    """Whether passages are looked for at every word, too, and not only between borders."""
    return border.pattern == BORDERS["sentence"]


def pieces(found: textvec.Words) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of a block's texts begin (word numbers), and the row of each."""
    n, rows = len(found.hash), np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    if n == 0:
        return np.zeros(0, np.int64), rows
    score = np.r_[textvec.grams(found.hash, 2), np.uint64(0)]
    score[found.first[1:][np.diff(found.first) > 0] - 1] = 0  # a text's last word has no next one: no cut within its reach
    low = np.ones(n, bool)
    for d in range(1, REACH + 1):  # the words on both sides exist, and score higher
        less = (rows[:-d] == rows[d:]) & (score[:-d] < score[d:])
        more = (rows[:-d] == rows[d:]) & (score[:-d] > score[d:])
        low &= np.r_[less, np.zeros(min(d, n), bool)] & np.r_[np.zeros(min(d, n), bool), more]
    low[found.first[:-1][np.diff(found.first) > 0]] = True
    begin = np.flatnonzero(low)
    return begin, rows[begin]


def text_units(found: textvec.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word, last word + 1 and key of each unit of a block: two adjacent pieces, or a text that is one piece."""
    begin, row = pieces(found)
    if len(begin) == 0:
        return begin, begin, begin, np.zeros(0, np.int64)
    end = np.r_[begin[1:], len(found.hash)]
    at = np.arange(len(found.hash)) - np.repeat(begin, end - begin)
    key = textvec.mix(np.add.reduceat(found.hash * textvec.powers("word", int(at.max()) + 1)[at], begin) + (end - begin).astype(np.uint64))
    both = np.r_[row[1:] == row[:-1], False]
    alone = ~both & ~np.r_[False, both[:-1]] & (end - begin >= MIN_WORDS)
    keys = np.where(both, np.r_[textvec.grams(key, 2), np.uint64(0)], key)
    last = np.where(both, np.r_[end[1:], 0], end)
    use = both | alone
    return row[use], begin[use], last[use], keys[use].view(np.int64)


def text_keys(values: pa.Array) -> Iterator[np.ndarray]:
    """The keys of all such units, text by text."""
    for _, block, edges in textvec.blocks(*textvec.column(values)):
        row, _, _, keys = text_units(tokens(block, edges))
        first = np.searchsorted(row, np.arange(len(edges)))
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            yield keys[a:b]


def split_units(text: str, border: regex.Pattern) -> list[tuple[int, int, bytes, int]]:
    """Start, end, digest and word count of each unit: those between borders, then those between its own cuts."""
    out = sentences(text, border)
    if whole_text(border):
        data = np.frombuffer(text.encode(), np.uint8)
        found = tokens(data, np.array([0, len(data)]))
        point = np.cumsum((data & 0xC0) != 0x80)  # code points up to and with each byte
        out += [(int(point[found.start[b]]) - 1, int(point[found.end[e - 1] - 1]), key.tobytes(), e - b)
                for _, b, e, key in zip(*(x.tolist() if i < 3 else x for i, x in enumerate(text_units(found))), strict=True)]
    return out


def as_pair(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def digests(docs: DataFrame, units: str, parts: int) -> DataFrame:
    """Keys of all units, packed: for each batch and part of the keys the keys, and the documents with how many each has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border = regex.compile(BORDERS[units])

        def packed(keys, ids, counts):
            keys, doc, names = np.concatenate(keys), np.repeat(np.arange(len(ids)), counts), np.array(ids, np.int64)
            part = (keys.view(np.uint64) >> np.uint64(24)) % np.uint64(parts)
            order = np.argsort(part.astype(np.int32), kind="stable")
            keys, doc, part = keys[order], doc[order], part[order]
            heads = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            rows = []
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(part)], strict=True):
                firsts = np.flatnonzero(np.r_[True, doc[a + 1:b] != doc[a:b - 1]])
                sizes = np.diff(np.r_[firsts, b - a]).astype(np.int32)
                steps = np.diff(names[doc[a + firsts]], prepend=0)  # mostly small: they compress
                rows.append((int(part[a]), keys[a:b].tobytes(), zlib.compress(steps.tobytes(), 1), zlib.compress(sizes.tobytes(), 1)))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), *[pa.binary()] * 3), strict=True)],
                                              names=["part", "keys", "ids", "counts"])

        keys, ids, counts, size = [], [], [], 0
        for batch in batches:
            texts = batch.column("text")
            windows = text_keys(texts) if whole_text(border) else [np.zeros(0, np.int64)] * len(texts)
            for text, doc_id, own in zip(texts, batch.column("doc_id").to_pylist(), windows, strict=True):
                found = sentences(text.as_py(), border)
                if found:
                    own = np.r_[own, as_pair([d for _, _, d, _ in found])[:, 0]]
                keys.append(own)
                ids.append(doc_id)
                counts.append(len(own))
                size += len(own)
                if size >= PACK:
                    yield packed(keys, ids, counts)
                    keys, ids, counts, size = [], [], [], 0
        if size:
            yield packed(keys, ids, counts)

    return id_text(docs).where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(lean(run), "part int, keys binary, ids binary, counts binary")


def seen_earlier(docs: DataFrame, units: str) -> DataFrame:
    """For each document that has any: the keys of its units that a smaller doc_id has, one row a key before they are listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def later(blocks):
            keys, ids = (np.concatenate(x) for x in zip(*blocks, strict=True))
            order = np.argsort(keys)
            keys, ids = keys[order], ids[order]
            heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            late = ids > np.repeat(np.minimum.reduceat(ids, heads), np.diff(np.r_[heads, len(keys)]))
            keys, ids = keys[late], ids[late]
            new = np.ones(len(keys), bool)
            order = np.lexsort((ids, keys))
            keys, ids = keys[order], ids[order]
            new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])  # once for a document that has a key often
            yield pa.RecordBatch.from_arrays([pa.array(ids[new]), pa.array(keys[new])], names=["doc_id", "key"])

        last, blocks = None, []
        for batch in batches:
            for part, *packed in zip(*(batch.column(c) for c in ("part", "keys", "ids", "counts")), strict=True):
                if blocks and part.as_py() != last:
                    yield from later(blocks)
                    blocks = []
                last = part.as_py()
                keys, steps, counts = (x.as_buffer() for x in packed)
                ids = np.cumsum(np.frombuffer(zlib.decompress(steps), np.int64))
                blocks.append((np.frombuffer(keys, np.int64).copy(), np.repeat(ids, np.frombuffer(zlib.decompress(counts), np.int32))))
        if blocks:
            yield from later(blocks)

    tasks = shuffle_parts(docs.sparkSession)
    held = digests(docs, units, 2 * tasks).repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(lean(run), "doc_id long, key long")
    return held.groupBy(F.col("doc_id").alias(PREFIX + "key")).agg(F.collect_list("key").alias(PREFIX + "seen"))


def repeated_windows(text: str, seen: set[int], min_words: int) -> list[tuple[int, int]]:
    """(start, end) of runs of words that lie in units which were seen, or which the text has further up without overlap."""
    data = np.frombuffer(text.encode(), np.uint8)
    found = tokens(data, np.array([0, len(data)]))
    _, begin, end, keys = text_units(found)
    if len(keys) == 0:
        return []
    _, first, which = np.unique(keys, return_index=True, return_inverse=True)
    gone = begin >= end[first[which]]
    if seen:
        gone |= np.isin(keys, np.fromiter(seen, np.int64, len(seen)))
    if not gone.any():
        return []
    begin, end = begin[gone], end[gone]
    breaks = np.flatnonzero(begin[1:] > end[:-1])
    point = np.cumsum((data & 0xC0) != 0x80)
    marks = lone(data)
    # two code points of a script without spaces count as a word
    measure = np.r_[0, np.cumsum(np.ones(len(found.start)) if marks is None else np.where(marks[0][found.start], 0.5, 1))]
    out = []
    for a, b in zip(begin[np.r_[0, breaks + 1]].tolist(), end[np.r_[breaks, len(end) - 1]].tolist(), strict=True):
        if measure[b] - measure[a] >= min_words:
            out.append((int(point[found.start[a]]) - 1, int(point[found.end[b - 1] - 1])))
    return out


def cut(text: str, seen: set[int], border: regex.Pattern, min_words: int) -> tuple[str, list[tuple[int, int]], int]:
    """The text without its repeated runs, their (start, end) in the given text, and how many units they held."""
    units = sentences(text, border)
    firsts = as_pair([d for _, _, d, _ in units])[:, 0].tolist() if units else []
    met: set[bytes] = set()
    gone = []
    for i, (_, _, digest, _) in enumerate(units):
        if firsts[i] in seen or digest in met:
            gone.append(i)
        met.add(digest)
    runs, j = [], 0  # start, end, and where the kept text goes on
    while j < len(gone):
        k = j
        while k + 1 < len(gone) and gone[k + 1] == gone[k] + 1:
            k += 1
        first, last = gone[j], gone[k]
        points = sum(len(text[b:e].strip()) for b, e, _, _ in units[first:last + 1])
        if points >= WORD_POINTS * min_words or sum(u[3] for u in units[first:last + 1]) >= min_words:
            runs.append((units[first][0], units[last][1], units[last + 1][0] if last + 1 < len(units) else len(text)))
        j = k + 1
    if whole_text(border):
        for begin, end in repeated_windows(text, seen, min_words):
            runs.append((begin, end, len(text) - len(text[end:].lstrip())))
        runs.sort()
    merged: list[tuple[int, int, int]] = []
    for begin, end, on in runs:
        if merged and begin <= merged[-1][2]:
            before = merged.pop()
            begin, end, on = before[0], max(end, before[1]), max(on, before[2])
        merged.append((begin, end, on))
    kept, at, n = [], 0, 0
    for begin, end, on in merged:
        kept.append(text[at:begin])
        at = on
        n += max(1, sum(begin <= b and e <= end for b, e, _, _ in units))
    kept.append(text[at:])
    return "".join(kept), [(begin, end) for begin, end, _ in merged], n


def deduplicate(docs: DataFrame, units: str = "sentence", min_words: int | None = None) -> DataFrame:
    """All columns of ``docs`` with the text cut, and ``PREFIX`` columns: removed (start, end) spans and unit count.

    ``min_words`` is the least length of a run; if none is given, ``MIN_WORDS``
    for sentences, and none for whole lines and paragraphs.
    """
    if min_words is None:
        min_words = MIN_WORDS if units == "sentence" else 0
    if any(c.lower().startswith(PREFIX) for c in docs.columns):
        raise ValueError(f"a column begins with {PREFIX}")
    seen = seen_earlier(docs, units)
    joined = docs.join(seen, F.col("doc_id").cast("long") == F.col(PREFIX + "key"), "left").drop(PREFIX + "key")
    plain = joined.toDF(*(f"c{i}" for i in range(len(joined.columns))))  # names with dots cannot be addressed
    added = StructType.fromDDL(f"{PREFIX}removed array<struct<start: int, end: int>>, {PREFIX}n_units int")
    at = [c.lower() for c in docs.columns].index("text")
    seen_at = len(docs.columns)
    keyed = [c.lower() for c in docs.columns].index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border = regex.compile(BORDERS[units])
        for batch in batches:
            texts, spans, counts = [], [], []
            ids = batch.column(keyed)
            for text, known, key in zip(batch.column(at), batch.column(seen_at), ids, strict=True):
                text, known = text.as_py(), set(known.values.to_pylist() if known.is_valid else ())
                if text is None or not key.is_valid:
                    texts.append(text)
                    spans.append([])
                    counts.append(0)
                    continue
                text, gone, n = cut(text, known, border, min_words)
                texts.append(text)
                spans.append([{"start": b, "end": e} for b, e in gone])
                counts.append(n)
            columns = list(batch.columns[:seen_at])
            columns[at] = pa.array(texts, columns[at].type)
            spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, spans_type), pa.array(counts, pa.int32())],
                                             names=[*batch.schema.names[:seen_at], *added.names])

    return plain.mapInArrow(lean(run), StructType([*plain.schema.fields[:seen_at], *added.fields])).toDF(*docs.columns, *added.names)


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with repeated passages cut and ``n_chars`` (if there) brought up to date."""
    out = deduplicate(docs).select(*(F.col(f"`{c}`") for c in docs.columns))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deduplicate(id_text(table(spark, sf_dir, "documents")))
    removed = F.col(PREFIX + "removed")
    return out.select("doc_id", "text", F.col(PREFIX + "n_units").alias("n_removed_units"),
                      F.aggregate(removed, F.lit(0), lambda n, s: n + s["end"] - s["start"]).alias("n_removed_chars"), removed.alias("removed"))
