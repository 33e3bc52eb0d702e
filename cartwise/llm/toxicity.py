"""Toxicity: bags of subword embeddings, averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the embeddings of itself and its character
n-grams (hashed into ``BUCKETS`` rows); a text's vector is the mean over its
words; a softmax over two classes sits on top. Embeddings and softmax are
trained together by full-batch descent on a bounded sample of labelled rows, so a
misspelling that was never seen shares most of its n-grams' vectors with the
words it comes from. Scoring needs one number per word (the model is linear
in the words), kept in a bounded memory per task.

Bound of the training sample: ``SAMPLE`` labelled rows, half of each class as
far as there are, those with the smallest hash of their id; texts of over
``LONGEST`` words are not trained on (all are scored whole).

Defined results: null text is empty; an empty text gets the share that the
bias alone gives. Labels that are null, or rows held out, are not learned. With
no labels of one class every text scores the smoothed share of label 1.
Repeated documents give repeated rows, an empty table an empty result.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.common import annotate, id_text, lean, remainder, ship, table

ship(__name__)

SAMPLE = 4000
LONGEST = 20_000
BUCKETS = 1 << 16
DIM = 4
LEAST_TEXTS = 3
SMOOTH = 0.5
#: Neutral words that every text's mean holds besides its own, so that a few words alone decide little.
PRIOR_WORDS = 40
STEPS = 30
RATE = 0.1
MOMENTUM = 0.8
CACHE_SIZE = 1 << 18
FOLDS = 5
PREFIX = "__toxicity_"

WORD = r"[^\W_]+"


def subwords(word: str) -> list[int]:
    """Buckets of a word and of its 3- to 6-character n-grams, ends marked."""
    marked = f"<{word}>"
    n = len(marked)
    parts = [marked, *(marked[i:i + k] for k in range(3, 7) for i in range(n - k + 1) if k < n)]
    return [zlib.crc32(p.encode()) % BUCKETS for p in parts]


def word_counts(text: str) -> Counter:
    return Counter(re.findall(WORD, text.lower()))


def weight(count: int) -> float:
    """Of a word that occurs ``count`` times in a text: repetition adds less and less."""
    return math.log2(1 + count)


def group_sum(values: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows; ``heads[g]:heads[g + 1]`` is group g, none empty."""
    return np.add.reduceat(values, heads[:-1], axis=0)


def borders(keys: np.ndarray) -> np.ndarray:
    return np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)]


def train(labels: np.ndarray, doc: np.ndarray, word: np.ndarray, count: np.ndarray, words: pa.Array) -> tuple[np.ndarray, float]:
    """One number per bucket and a bias: the difference of the two classes' logits.

    ``doc``, ``word`` (an index into ``words``) and ``count`` list the words of
    each text, by text. Words of fewer than ``LEAST_TEXTS`` texts are not trained
    on. Steps are scaled by a whole matrix's gradient, not entry by entry, so an
    n-gram moves as far as texts agree on it.
    """
    y = labels.astype(np.float32)
    prior = (y.sum() + 0.5) / (len(y) + 2)
    usual = np.bincount(word, minlength=len(words)) >= LEAST_TEXTS
    if len(y) == 0 or y.min() == y.max() or not usual.any():
        return np.zeros(BUCKETS), math.log(prior / (1 - prior))
    total = (PRIOR_WORDS + np.bincount(doc, np.log2(1 + count), len(y))).astype(np.float32)
    known = usual[word]
    doc, word = doc[known], (np.cumsum(usual) - 1)[word[known]]
    share = (np.log2(1 + count[known]).astype(np.float32) / total[doc])[:, None]
    vocabulary = words.filter(pa.array(usual))
    parts, sizes = array("i"), np.empty(len(vocabulary), np.int64)
    for k, w in enumerate(vocabulary):
        own = subwords(w.as_py())
        parts.extend(own)
        sizes[k] = len(own)
    owner = np.repeat(np.arange(len(vocabulary), dtype=np.int32), sizes)
    sizes = sizes.astype(np.float32)
    used, bucket = np.unique(np.frombuffer(parts, np.int32), return_inverse=True)
    by_word, by_bucket = np.argsort(word, kind="stable"), np.argsort(bucket, kind="stable")
    doc_heads, word_heads = borders(doc), borders(word[by_word])
    owner_heads, bucket_heads = borders(owner), borders(bucket[by_bucket])
    filled = doc[doc_heads[:-1]]
    # an n-gram's spread over texts is about the root of its mean: put all n-grams on one scale
    mean = group_sum((group_sum(share[by_word], word_heads) / sizes[:, None])[owner[by_bucket]], bucket_heads) / len(y)
    scale = (1 / np.sqrt(mean + mean.mean() * SMOOTH)).astype(np.float32)

    rng = np.random.default_rng(7)
    e = rng.uniform(-1e-3, 1e-3, (len(used), DIM)).astype(np.float32)
    w = rng.uniform(-1, 1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    target = np.stack([1 - y, y], axis=1)
    balance = (np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))[:, None]).astype(np.float32)
    speed = [np.zeros_like(e), np.zeros_like(w), np.zeros_like(bias)]
    for step in range(STEPS):
        words = group_sum((e * scale)[bucket], owner_heads) / sizes[:, None]
        vectors = np.zeros((len(y), DIM), np.float32)
        vectors[filled] = group_sum(words[word] * share, doc_heads)
        logits = vectors @ w + bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        error = (p - target) * balance
        back = error @ w.T
        words_back = group_sum(back[doc[by_word]] * share[by_word], word_heads) / sizes[:, None]
        grads = (group_sum(words_back[owner[by_bucket]], bucket_heads) * scale, vectors.T @ error, error.sum(axis=0))
        rate = RATE * (1 - step / STEPS)
        for matrix, v, g, top in zip((e, w, bias), speed, grads, (1.0, 0.1, 0.1), strict=True):
            v *= MOMENTUM
            v += g / max(1e-12, float(np.abs(g).max()))
            matrix -= rate * top * v
    per_bucket = np.zeros(BUCKETS)
    per_bucket[used] = (e * scale).astype(np.float64) @ (w[:, 1] - w[:, 0]).astype(np.float64)
    return per_bucket, float(bias[1] - bias[0])


class Scorer:
    """Scores texts in one task."""

    def __init__(self, per_bucket: np.ndarray, bias: float) -> None:
        self.per_bucket, self.bias = per_bucket, bias
        self.find = re.compile(WORD).findall
        self.cache: dict[str, float] = {}

    def score(self, text: str) -> float:
        words = Counter(self.find(text.lower()))
        cache = self.cache
        missing = [w for w in words if w not in cache]
        if len(cache) + len(missing) > CACHE_SIZE:
            cache.clear()
            missing = list(words)
        for w in missing:
            parts = subwords(w)
            cache[w] = float(self.per_bucket[parts].sum()) / len(parts)
        weights = list(map(weight, words.values()))
        logit = self.bias + sum(map(mul, map(cache.__getitem__, words), weights)) / (PRIOR_WORDS + sum(weights))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Train on the bounded sample; only ids, labels and word counts of sampled texts reach the driver."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", FOLDS) != 0))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    halves = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for t in (0, 1)]
    picked = halves[0].unionByName(halves[1])
    texts = id_text(docs).join(F.broadcast(picked), "doc_id")  # picked: at most `sample` rows

    def bags(batches):
        for batch in batches:
            keys, marks, bag = [], [], []
            for key, mark, text in zip(*(batch.column(c) for c in ("doc_id", "toxic", "text")), strict=True):
                counted = word_counts(text.as_py() or "")
                if 0 < sum(counted.values()) <= LONGEST:
                    keys.append(key.as_py())
                    marks.append(mark.as_py())
                    bag.append(counted)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(marks, pa.int32()), pa.array([list(c) for c in bag], pa.list_(pa.string())),
                                              pa.array([list(c.values()) for c in bag], pa.list_(pa.int32()))], names=["doc_id", "toxic", "words", "counts"])

    got = texts.mapInArrow(lean(bags), "doc_id long, toxic int, words array<string>, counts array<int>").toArrow().sort_by("doc_id")
    lists = got["words"].combine_chunks()
    named = lists.flatten().dictionary_encode()
    doc = np.repeat(np.arange(len(lists), dtype=np.int32), lists.value_lengths().to_numpy())
    model = train(got["toxic"].to_numpy(), doc, named.indices.to_numpy(), got["counts"].combine_chunks().flatten().to_numpy(), named.dictionary)
    del got, lists, named, doc
    pa.default_memory_pool().release_unused()  # else the driver keeps the sample's memory through all later steps
    return model


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``docs`` with the column ``PREFIX + "score"``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # size: BUCKETS numbers

    def make():
        scorer = Scorer(*shared.value)
        return lambda text: [pa.array([scorer.score(t.as_py() or "") for t in text], pa.float64())]

    return annotate(docs, PREFIX, "score double", make)


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(id_text(docs), fit(docs, labels, sample))
    at = F.col(PREFIX + "score")
    return scored.select("doc_id", (remainder("doc_id", FOLDS) == 0).alias("held_out"), at.alias("score"), (at >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents, all columns, that are not predicted toxic."""
    scored = score(docs, fit(docs, labels, sample))
    return scored.where(F.col(PREFIX + "score") < 0.5).select(*(F.col(f"`{c}`") for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
