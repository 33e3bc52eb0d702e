"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Statistics of each whole text (``STATS``) are standardised by means and spreads
over all documents. ``FOURIER`` cosine features with Gaussian frequencies
approximate a Gaussian kernel of width ``WIDTH`` on them. Every task sums its
share of the normal equations (a matrix of fixed size), the sums are added in
two levels, and the driver solves them. Raw scores of the labelled rows are
counted in ``BINS`` fixed bins and pooled to a non-decreasing curve (pool
adjacent violators), which maps raw scores to probabilities.

All labelled rows that are not held out are learned from; nothing is sampled.
Defined results: null text is empty; an empty text has all-zero statistics and
gets their score. Without labels of both classes every text scores the share
of label 1 (1 without labels). Null labels are ignored, several labels
of one doc_id count as their largest. Repeated documents give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cartwise.llm import textvec
from cartwise.llm.common import Scratch, id_text, remainder, shuffle_parts, ship, table

ship(__name__)

STATS = ("log_words", "word_length", "capitals", "digits", "symbols", "exclaims", "stops", "lines", "distinct_words",
         "distinct_pairs", "repeated_next", "repeated_lines", "non_ascii")
FOURIER = 256
WIDTH = 4.0
RIDGE = 1.0
BINS = 512
FOLDS, HELD_OUT = 4, 2
CUT = 0.7
SEED = 11


def _bytes(chars: bytes) -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[list(chars)] = True
    return mask


_CLASSES = {"capitals": _bytes(bytes(range(0x41, 0x5B))), "letters": _bytes(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B)])),
            "digits": _bytes(b"0123456789"), "symbols": _bytes(b"#*$%&|<>"), "exclaims": _bytes(b"!"), "stops": _bytes(b".,;:?"),
            "lines": _bytes(b"\n"), "non_ascii": _bytes(bytes(range(0xC0, 0x100)))}


def distinct_per_row(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """How many different hashes each row holds."""
    key = np.sort(rows.astype(np.uint64) << np.uint64(42) | hashes >> np.uint64(22))
    first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    return np.bincount((key[first] >> np.uint64(42)).astype(np.int64), minlength=n_rows)


def statistics(text: pa.Array) -> np.ndarray:
    """One row of ``STATS`` per text."""
    data, borders = textvec.column(text)
    out = np.zeros((len(borders) - 1, len(STATS)))
    for at, block, edges in textvec.blocks(data, borders):
        n_rows = len(edges) - 1
        found = textvec.words(block, edges, textvec.NOT_SPACE)
        n = np.diff(found.first)
        rows = np.repeat(np.arange(n_rows), n)
        size = np.bincount(rows, found.end - found.start, n_rows)
        count = {}
        for name, mask in _CLASSES.items():
            upto = np.r_[0, np.cumsum(mask[block])]
            count[name] = upto[edges[1:]] - upto[edges[:-1]]
        lines = textvec.words(block, edges, ~_CLASSES["lines"])
        line_rows = np.repeat(np.arange(n_rows), np.diff(lines.first))
        n_lines = np.maximum(1, np.diff(lines.first))
        same_row = rows[1:] == rows[:-1]
        again = np.bincount(rows[1:][same_row & (found.hash[1:] == found.hash[:-1])], minlength=n_rows)
        pairs = textvec.grams(found.hash, 2)[same_row]
        pair_rows = rows[1:][same_row]
        n_pairs = np.maximum(1, n - 1)
        some = np.maximum(1, n)
        spread = np.sqrt(some)  # a long text repeats words by chance: counted against the root of its length
        values = (np.log1p(n), size / some, count["capitals"] / np.maximum(1, count["letters"]), count["digits"] / np.maximum(1, size),
                  count["symbols"] / some, count["exclaims"] / some, count["stops"] / some, count["lines"] / some,
                  distinct_per_row(found.hash, rows, n_rows) / spread, distinct_per_row(pairs, pair_rows, n_rows) / n_pairs, again / some,
                  1 - distinct_per_row(lines.hash, line_rows, n_rows) / n_lines, count["non_ascii"] / np.maximum(1, size))
        values = np.stack(values, axis=1)
        values[n == 0] = 0
        out[at:at + n_rows] = values
    return out


def frequencies() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(0, 1 / WIDTH, (len(STATS), FOURIER)), rng.uniform(0, 2 * np.pi, FOURIER)


def features(stats: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Fourier features of standardised statistics (clipped to 8 spreads), and a constant."""
    w, phase = frequencies()
    z = np.clip((stats - centre) / spread, -8, 8)
    return np.hstack([np.sqrt(2 / FOURIER) * np.cos(z @ w + phase), np.ones((len(z), 1))])


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def describe(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(batch.column("text"))
            lists = pa.ListArray.from_arrays(np.arange(len(stats) + 1, dtype=np.int32) * len(STATS), pa.array(stats.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "stats"])

    return id_text(docs).mapInArrow(run, "doc_id long, stats array<double>")


def summed(parts: DataFrame, n_parts: int) -> DataFrame:
    """Adds rows of one binary column of doubles, within each partition of a coarser dealing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column("sums"):
                one = np.frombuffer(row.as_py())
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return parts.repartition(n_parts).mapInArrow(run, "sums binary")


def normal_equations(labelled: DataFrame, centre: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOURIER + 1, FOURIER + 2))
        for batch in batches:
            if batch.num_rows:
                z = features(matrix(batch.column("stats")), centre, spread)
                y = batch.column("quality").to_numpy().astype(float)
                total += z.T @ np.hstack([z, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = labelled.select("stats", "quality").mapInArrow(run, "sums binary")
    rows = summed(parts, max(1, int(shuffle_parts(labelled.sparkSession) ** 0.5))).collect()
    total = sum((np.frombuffer(r.sums) for r in rows), np.zeros((FOURIER + 1) * (FOURIER + 2))).reshape(FOURIER + 1, FOURIER + 2)
    return total[:, :-1], total[:, -1]


def isotonic(weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit of total / weight, in order."""
    blocks: list[list[float]] = []
    for w, t in zip(weight.tolist(), total.tolist(), strict=True):
        blocks.append([t, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            t, w, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + w, blocks[-1][2] + k]
    return np.repeat([t / w for t, w, _ in blocks], [k for _, _, k in blocks])


def raw_score(described: DataFrame, model: tuple) -> DataFrame:
    """``described`` with its ridge score; ``model`` holds arrays of fixed size."""
    shared = described.sparkSession.sparkContext.broadcast(model)
    schema = StructType([*described.schema.fields, StructField("raw", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, spread, beta = shared.value
        for batch in batches:
            raw = features(matrix(batch.column("stats")), centre, spread) @ beta if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw)], names=[*batch.schema.names, "raw"])

    return described.mapInArrow(run, schema)


def bin_of(raw):
    return F.floor(F.least(F.lit(1.5), F.greatest(F.lit(-0.5), raw)) * (BINS / 2)).cast("int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scratch = Scratch(docs.sparkSession, "quality")
    described = scratch.write(describe(docs), "stats")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .where(F.col("quality").isin(0, 1) & (remainder("doc_id", FOLDS) != HELD_OUT)).groupBy("doc_id").agg(F.max("quality").alias("quality")))
    at = [F.get("stats", i) for i in range(len(STATS))]
    moments = described.agg(*(F.avg(c) for c in at), *(F.stddev_pop(c) for c in at)).first()
    moments = np.array([0.0 if v is None else v for v in moments])
    centre, spread = moments[:len(STATS)], np.maximum(moments[len(STATS):], 1e-3)
    labelled = described.join(known, "doc_id")
    share = labelled.agg(F.avg("quality")).first()[0]
    held = (remainder("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    if share in (None, 0.0, 1.0):
        score = F.lit(1.0 if share is None else float(share))
        return described.select("doc_id", held, score.alias("score"), (score >= CUT).cast("int").alias("predicted"))
    gram, target = normal_equations(labelled, centre, spread)
    beta = np.linalg.solve(gram + RIDGE * np.diag([1.0] * FOURIER + [1e-6]), target)
    model = (centre, spread, beta)
    counted = (raw_score(labelled, model).groupBy(bin_of(F.col("raw")).alias("bin"))
               .agg(F.count("*").alias("n"), F.sum("quality").alias("ones")).orderBy("bin").collect())
    centres = (np.array([r.bin for r in counted]) + 0.5) / (BINS / 2)
    curve = isotonic(np.array([r.n for r in counted], float), np.array([r.ones for r in counted], float))

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = np.interp(batch.column("raw").to_numpy(), centres, curve)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"])

    scored = raw_score(described, model).select("doc_id", "raw").mapInArrow(calibrate, "doc_id long, score double")
    return scored.select("doc_id", held, "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
