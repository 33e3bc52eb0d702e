"""Every operator on odd rows and on empty tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import cases  # noqa: E402
import public_tokenizers  # noqa: E402
from conftest import SF_SMALL  # noqa: E402

import corpus_pipeline  # noqa: E402
from cartwise.llm import (bpe, decontamination, ngram_join, quality_classifier, quality_rules, sharding,  # noqa: E402
                          substring_dedup, toxicity)

LABELS = [(i, i % 2, (i + 1) % 2) for i in range(1, 13)] + [(None, 1, 0), (3, None, None), (4, 1, 1), (4, 0, 0)]
ITEMS = [(1, "brown fox jumps"), (1, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10"), (None, "lazy dog"), (2, None), (3, "")]

OPERATORS = {
    "join": lambda s, d, full: ngram_join.jaccard_components(d),
    "toxicity": lambda s, d, full: toxicity.toxicity(d, cases.labels(s, LABELS if full else ())),
    "bpe": lambda s, d, full: bpe.encode_documents(d, public_tokenizers.path(bpe.RANK_FILE), public_tokenizers.PATTERN, keep_ids=True),
    "benchmark": lambda s, d, full: decontamination.contamination(d, cases.benchmark(s, ITEMS if full else ())),
    "rules": lambda s, d, full: quality_rules.judge(d),
    "quality": lambda s, d, full: quality_classifier.classify(d, cases.labels(s, LABELS if full else ())),
    "shards": lambda s, d, full: sharding.shard(d),
    "passages": lambda s, d, full: substring_dedup.deduplicate(d),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_one_result_each(spark, name):
    docs = cases.documents(spark)
    got = OPERATORS[name](spark, docs, True).select("doc_id").collect()
    order = lambda v: (v is None, v)
    assert sorted((r.doc_id for r in got), key=order) == sorted((r.doc_id for r in docs.select("doc_id").collect()), key=order)
    none = OPERATORS[name](spark, docs, False)
    assert none.count() == docs.count()


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, cases.empty(spark), True).collect() == []


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_keeps_columns(spark, stage):
    work = dict(corpus_pipeline.STAGES)[stage]
    docs = cases.documents(spark)
    out = work(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}
    assert work(spark, cases.empty(spark), SF_SMALL).collect() == []


def test_values_of_odd_rows(spark):
    docs = cases.documents(spark)
    join = {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert {(2, 0, 2), (3, 0, 3), (4, 0, 4), (6, 1, 6), (7, 56, 7), (8, 57, 7), (9, 56, 7), (None, 56, None), (None, 0, None)} <= join
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in sharding.shard(docs).collect() if r.doc_id}
    assert sizes[2] == (8, 0) and sizes[3] == (8, 0) and sizes[6][0] == 21
    rules = {r.doc_id: r for r in quality_rules.judge(docs).collect() if r.doc_id}
    assert (rules[12].n_words, rules[12].n_dup_lines, rules[12].n_repeat_words, rules[12].kept) == (10, 9, 10, False)
    assert (rules[2].n_words, rules[2].base_failed) == (0, True)
    hits = {r.doc_id: r for r in decontamination.contamination(docs, cases.benchmark(spark, ITEMS)).collect() if r.doc_id}
    assert (hits[1].n_hit, hits[1].n_items, hits[7].n_hit, hits[2].contaminated) == (5, 2, 11, False)
    scores = [r.score for r in toxicity.toxicity(docs, cases.labels(spark, LABELS)).collect()]
    scores += [r.score for r in quality_classifier.classify(docs, cases.labels(spark, LABELS)).collect()]
    assert all(0 <= s <= 1 for s in scores)
