"""SimHash near-duplicates, ranked search and the source audit against brute force."""

import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import cases  # noqa: E402
import duckdb  # noqa: E402
from conftest import SF_CHECK, SF_SMALL  # noqa: E402

from cartwise.llm import lexical_search, simhash, source_audit  # noqa: E402
from cartwise.llm.common import Scratch  # noqa: E402
from cartwise.llm.components import components  # noqa: E402

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(name, sf):
    return duckdb.sql(f"SELECT * FROM '{sf}/{name}.parquet'").df()


# ---- 12: SimHash

def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(rows):
    """(id, fingerprint) rows: the smallest id reachable by links."""
    ids, prints = [i for i, _ in rows], np.array([f for _, f in rows], np.uint64)
    parent = list(range(len(ids)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(prints[:a] ^ prints[a]) <= 3).tolist():
            x, y = sorted((top(a), top(b)), key=lambda t: ids[t])
            parent[y] = x
    return {i: ids[top(k)] for k, i in enumerate(ids)}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_simhash_whole_table(spark, sf):
    docs = rows_of("documents", sf)
    prints = [(i, fingerprint(t)) for i, t in zip(docs.doc_id.tolist(), docs.text.tolist())]
    want = near(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.query(spark, sf).collect()}
    assert got == {i: (f"{f:016x}", want[i]) for i, f in prints}


@pytest.mark.parametrize("cell", [simhash.CELL, 5])
def test_simhash_links_of_every_kind(spark, cell):
    """Chains, dense clouds around a centre, and pairs at exactly 3 and 4 bits over all segment splits."""
    rng = random.Random(3)
    prints = [0, (1 << 64) - 1]
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.append(base)
        for bits in (3, 3, 4):
            prints.append(base ^ sum(1 << b for b in rng.sample(range(64), bits)))
    centre = rng.getrandbits(64)
    prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(250)]
    low = rng.getrandbits(32)
    prints += [low | rng.getrandbits(5) << 40 | rng.getrandbits(3) << 60 for _ in range(200)]  # one hot segment
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.edges(spark.createDataFrame([(p,) for p in signed], "fp long"), cell)
    assert all(bin((r.u ^ r.v) & (1 << 64) - 1).count("1") <= 3 for r in edges.collect())
    found = {r.u: r.v for r in components(edges, Scratch(spark, "t-simhash")).collect()}
    assert {p: found.get(p, p) for p in signed} == near(list(zip(signed, prints)))


def test_simhash_broadcasts_no_fingerprints(spark):
    """The planner sees a small file of fingerprints, not the 34 keys of each: no join may send them through the driver."""
    plain = simhash.edges(spark.range(200).selectExpr("id * 2654435761 AS fp"))
    stars = components(spark.range(200).selectExpr("id + 1 AS u", "id AS v"), Scratch(spark, "t-stars"))
    whole = simhash.near_duplicates(cases.documents(spark))
    assert stars.count() == 200 and {r.v for r in stars.collect()} == {0}
    for df in (plain, whole):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicates(cases.documents(spark)).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == 15 and simhash.near_duplicates(cases.empty(spark)).collect() == []
    assert [by_id[i].fingerprint for i in (2, 3, 4)] == ["0" * 16] * 3 and {by_id[i].component_id for i in (2, 3, 4)} == {2}
    assert by_id[9].component_id == 7 and {r.component_id for r in got if r.doc_id is None} == {None}
    assert by_id[5].fingerprint == f"{fingerprint(cases.LONG):016x}"
    assert by_id[6].fingerprint == f"{fingerprint('one two three'):016x}"
    assert {r.fingerprint for r in got if r.doc_id is None} == {by_id[7].fingerprint, "0" * 16}


# ---- 13: search

def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def search(docs, items):
    words = [(i, search_terms(t)) for i, t in docs]
    total, length = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    tf = [(i, Counter(w), len(w)) for i, w in words]
    df = Counter(t for _, c, _ in tf for t in c)
    own = defaultdict(set)
    for item, text in items:
        own[item] |= set(search_terms(text))
    out = set()
    for item, terms in own.items():
        weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) for t in terms}
        scored = []
        for i, c, n in tf:
            s = sum(weight[t] * (1000000000 * c[t] // (1000 * c[t] + 8 * (10 + 90 * n * total // length))) for t in terms if c[t])
            if s > 0:
                scored.append((-s, i is None, i))
        out |= {(item, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scored)[:10])}
    return out


def found(df):
    return {(r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("block", [lexical_search.BLOCK_BYTES, 700])
def test_search_ranks(spark, block):
    rng = random.Random(11)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}é" for i in range(300)]
    docs = [(i, " ".join(rng.choices(common, k=rng.randint(0, 40)) + rng.choices(rare, k=rng.randint(0, 6)))) for i in range(600)]
    docs += [(k, docs[7][1]) for k in range(1000, 1030)]  # ties
    items = [(i, " ".join(rng.sample(common, rng.randint(0, 9)) + rng.sample(rare, rng.randint(0, 5)))) for i in range(30)] + [(50, docs[7][1])]
    frame = cases.texts(spark, docs).repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # many shards a task
    try:
        assert found(lexical_search.search(frame, cases.benchmark(spark, items), block)) == search(docs, items)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_search_odd_rows(spark):
    items = [(1, "brown FOX jumps"), (1, "w0 w1"), (None, "lazy dog one"), (2, None), (3, ""), (4, "wort5 été7 aaaa"), (5, "A")]
    docs = cases.documents(spark)
    want = search([(r.doc_id, r.text) for r in docs.collect()], items)
    got = found(lexical_search.search(docs, cases.benchmark(spark, items)))
    assert got == want and {i for i, *_ in got} == {1, None, 4, 5}
    assert lexical_search.search(cases.empty(spark), cases.benchmark(spark, items)).collect() == []
    assert lexical_search.search(docs, cases.benchmark(spark)).collect() == []


# ---- 11: audit

def audit(rows, least=10):
    words = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(UPPER))) for lang, source, text in rows]
    frequency = Counter((lang, t) for lang, _, w in words for t in set(w))
    kept = defaultdict(list)
    for (lang, t), n in frequency.items():
        if n >= least:
            kept[lang].append(t)
    counts = defaultdict(Counter)
    for lang, source, w in words:
        own = set(kept[lang])
        counts[lang, source].update(t for t in w if t in own)

    def share(c, terms):
        return {t: 1 + 1000000000 * (c[t] + 2) // (sum(c.values()) + 2 * len(terms)) for t in terms}

    def apart(p, q):
        return (p - q) ** 2 // (p + q)

    out = set()
    for lang, source in counts:
        terms, own = kept[lang], counts[lang, source]
        p = share(own, terms)
        pairs = []
        for (other_lang, other), c in counts.items():
            if other_lang == lang and other != source:
                q = share(c, terms)
                pairs.append((-sum(apart(p[t], q[t]) for t in terms), other))
        whole = share(sum((c for (x, _), c in counts.items() if x == lang), Counter()), terms)
        best = sorted((-apart(p[t], whole[t]), t) for t in terms if own[t] and p[t] > whole[t])[:10]
        for part, ranked in (("pair", sorted(pairs)), ("term", best)):
            out |= {(lang, source, part, item, -v, k + 1) for k, (v, item) in enumerate(ranked)}
    return out


def audited(df):
    return {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()}


@pytest.mark.parametrize("bounds", [{}, {"shard_terms": 40, "pass_terms": 60}])
def test_audit_against_brute_force(spark, monkeypatch, bounds):
    if bounds:  # many shards, passes and flushes
        monkeypatch.setattr(source_audit, "TABLE_TERMS", 50)
    rng = random.Random(2)
    vocabulary = [f"{a}{b}" for a in ("wo", "Éa", "zz", "日") for b in map(chr, range(97, 123))]
    rows = []
    for k in range(420):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "b", "c", None])
        own = vocabulary[:60] if source == "a" else vocabulary[30:]
        rows.append((lang, source, "-".join(rng.choices(own, k=rng.randint(0, 30))) + " 12 solo" + "x" * (k % 40)))
    rows += [("fr", s, "un deux") for s in "abc"] + [("it", "only", None)] + [("en", "empty", None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    assert audited(source_audit.audit(docs, **bounds)) == audit(rows)


def test_audit_odd_rows(spark):
    docs = cases.documents(spark)
    want = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert audited(source_audit.audit(docs)) == audit(want)
    assert audited(source_audit.audit(docs, min_docs=2)) == audit(want, 2)
    assert source_audit.audit(cases.empty(spark)).collect() == []


def test_perfect_hash_is_minimal_and_checks_keys(spark):
    import pyarrow as pa
    terms = pa.array([f"t{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(700)])
    hashes = source_audit.term_hashes(terms)
    sizes, bits, order = source_audit.perfect_hash(hashes)
    assert bits.sum() == 700 and sorted(order.tolist()) == list(range(700))
    index = source_audit.Index([(0, sizes, np.packbits(bits).tobytes(), terms.take(pa.array(order)).to_pylist())], 1)
    raw = "".join(terms.to_pylist()).encode()
    ends = np.cumsum([len(t) for t in terms.to_pylist()])
    slots = index.slots(hashes, raw, ends - [len(t) for t in terms.to_pylist()], ends)
    assert [index.keys[s].decode() for s in slots.tolist()] == terms.to_pylist()
    assert (index.slots(hashes[::-1].copy(), raw, ends - [len(t) for t in terms.to_pylist()], ends) >= 0).sum() == 0
    with pytest.raises(ValueError):
        source_audit.perfect_hash(np.array([5, 5], np.uint64))


def test_shares_beyond_64_bits():
    counts = np.array([10**13, 0, 7])
    assert source_audit.shares(counts, 10**13 + 7, 3).tolist() == [1 + 10**9 * (c + 2) // (10**13 + 13) for c in (10**13, 0, 7)]
