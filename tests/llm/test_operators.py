"""Operators against brute force, exact round trips, the tokenizer library and held-out accuracy."""

import hashlib
import os
import random
import re
import struct
import sys
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import cases  # noqa: E402
import public_tokenizers  # noqa: E402
from conftest import SF_CHECK, SF_SMALL  # noqa: E402

import corpus_pipeline  # noqa: E402
from cartwise.llm import (bpe, chat_format, components, decontamination, ngram_join, quality_classifier, quality_rules,  # noqa: E402
                          queries, sharding, substring_dedup, toxicity, url_filters)
from cartwise.llm.common import Scratch  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(name, sf=SF_CHECK):
    return duckdb.sql(f"SELECT * FROM '{sf}/{name}.parquet'").df()


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_CHECK}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got = queries.QUERIES[name](spark, SF_CHECK)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=key) == sorted(want.fetchall(), key=key)


# ---- 1: join

def shingles(text):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return {i: (len(s), top(i)) for i, s in sets}


def test_join_whole_table(spark):
    docs = table("documents", SF_SMALL)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.query(spark, SF_SMALL).collect()}
    assert got == brute_components(list(zip(docs.doc_id, docs.text)))


@pytest.mark.parametrize("hot", [False, True])
def test_join_borderline_groups(spark, monkeypatch, hot):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for g in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(6, 90))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own = own[:rng.randint(3, len(own))]
            if g % 4 == 0:
                own += passage
            rows.append((len(rows) + 1, " ".join(own)))
    docs = cases.texts(spark, rows)
    if hot:
        monkeypatch.setattr(ngram_join, "LONG_LIST", 2)
        monkeypatch.setattr(ngram_join, "SPLIT_LIST", 3)
        monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)  # no side is broadcast
        monkeypatch.setattr(ngram_join, "hot_shingles", lambda d, f=ngram_join.hot_shingles: f(d, most=500, in_task=1, in_all=3))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == brute_components(rows)


def test_join_numbers_lists_and_moves_entries_once_for_leaders(spark):
    rng = random.Random(11)
    rows = sorted({(rng.getrandbits(62) if k % 3 else 7 + k // 90, c) for k in range(300) for c in rng.sample(range(40), rng.randint(1, 6))})
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # lists go on over several batches
    try:
        entries = spark.createDataFrame([(t, c, 10, 0) for t, c in rows + rows[:50]], ngram_join.LISTED)
        got = [tuple(r) for r in ngram_join.shared_lists(entries).select("token", "cls").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    lists = {}
    for t, c in rows:
        lists.setdefault(t, set()).add(c)
    numbered = {}
    for t, c in got:
        numbered.setdefault(t, []).append(c)
    assert sorted(map(sorted, numbered.values())) == sorted(sorted(v) for v in lists.values() if len(v) > 1)
    assert max(numbered) < len(rows) * 8  # numbers of lists, not hashes
    from pyspark.sql import functions as F

    listed = spark.createDataFrame([(1, 1, 10, 0, 1), (1, 2, 10, 1, 2)], "token long, cls long, n int, pos int, comp long")
    plan = ngram_join.with_leaders(listed, F.xxhash64("cls"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_join_ignores_ascii_case_only(spark):
    words = [f"Wort{i}" for i in range(30)]
    rows = [(1, " ".join(words)), (2, " ".join(words).upper()), (3, " ".join(words).lower()), (4, "ÉTÉ a b c d"), (5, "été a b c d"), (6, "ÉTÉ A B C D")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(cases.texts(spark, rows)).collect()}
    assert got == brute_components(rows) == {1: (26, 1), 2: (26, 1), 3: (26, 1), 4: (1, 4), 5: (1, 5), 6: (1, 4)}


def test_clean_documents_judges_repeated_ids_by_their_texts(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(12)) for c in "xyz")
    rows = [(3, one), (7, one), (7, two), (8, two), (8, three), (8, three), (9, None), (9, ""), (9, one), (None, one), (None, one)]
    got = sorted((str(r.doc_id), str(r.text)) for r in ngram_join.clean_documents(cases.texts(spark, rows)).collect())
    want = [(3, one), (7, two), (8, three), (None, one), (None, one)]
    empty = [t for i, t in got if i == "9"]
    assert [r for r in got if r[0] != "9"] == sorted((str(i), str(t)) for i, t in want)
    assert len(empty) == 1 and empty[0] in ("None", "")


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 199), (199, 200)]
    got = components.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t-cc")).collect()
    top = {r.u: r.v for r in got}
    assert len(got) == len(top)
    assert top == {i: 1 for i in range(2, 41)} | {i: 100 for i in range(101, 160)} | {200: 199}


def test_components_of_stars_take_no_rounds(spark, monkeypatch):
    def refused(edges):
        raise AssertionError("a round")

    monkeypatch.setattr(components, "_large_star", refused)
    for edges in ([], [(1, 2), (3, 1), (1, 3), (9, 8), (4, 4)]):
        got = components.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t-few")).collect()
        assert sorted((r.u, r.v) for r in got) == ([(2, 1), (3, 1), (9, 8)] if edges else [])


def test_clean_documents_leaves_texts_where_they_lie(spark):
    """Texts were shuffled as soon as the list of removed documents passed the session's broadcast limit."""
    rows = [(i, " ".join(f"{i // 2}w{k}" for k in range(12))) for i in range(40)]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        cleaned = ngram_join.clean_documents(cases.texts(spark, rows))
        got = sorted(r.doc_id for r in cleaned.collect())
        plan = cleaned._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert got == list(range(0, 40, 2))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


# ---- 2, 6: classifiers

def test_toxicity_learns_held_out_and_misspelt(spark):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}" for a in ("lor", "mip", "dol", "sit", "ame") for b in ("an", "et", "is", "um", "or", "ix", "ea")]
    rows, marks = [], []
    for i in range(900):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(20, 90))]
        toxic = i % 3 == 0
        if toxic:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(["vilegoon", "scabrat", "vilegoonx"])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    rows += [(5001, "lorum mipan vilegoom dolis"), (5002, "lorum mipan dolis sitor")]
    got = {r.doc_id: r for r in toxicity.toxicity(cases.texts(spark, rows), cases.labels(spark, marks)).collect()}
    held = [i for i, _, _ in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in marks)
    assert sum(got[i].predicted == int(i % 3 == 0) for i in held) >= 0.97 * len(held)
    assert got[5001].score > 0.5 > got[5002].score


def test_quality_held_out_accuracy(spark):
    marks = table("labels")
    got = {r.doc_id: r for r in quality_classifier.query(spark, SF_CHECK).collect()}
    assert len(got) == len(table("documents"))
    held = [(got[i], q) for i, q in zip(marks.doc_id, marks.quality) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == q for r, q in held) >= 0.95 * len(held)


def test_isotonic_is_monotone_and_fits():
    got = quality_classifier.isotonic(np.array([1., 2, 1, 4]), np.array([1., 0, 1, 4]))
    assert np.allclose(got, [1 / 3, 1 / 3, 1, 1])


# ---- 3: tokenizer

def test_bpe_is_the_rank_library(spark):
    import tiktoken
    ranks = bpe.read_ranks(public_tokenizers.path(bpe.RANK_FILE))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = table("documents", SF_SMALL)
    rows = [*zip(docs.doc_id, docs.text), (90001, "  \n\n x\t\u00a0 '\u2019s 1234 <unk> \u2581 \U0001f600"), (90002, "ab" * 9000), (90003, None)]
    got = {r.doc_id: r for r in bpe.encode_documents(cases.texts(spark, rows), public_tokenizers.path(bpe.RANK_FILE),
                                                     public_tokenizers.PATTERN, keep_ids=True).collect()}
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


# ---- 4: decontamination

def brute_hits(text, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        k = min(10, len(b))
        wins = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(w) - k + 1):
            if k and tuple(w[i:i + k]) in wins:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(w), len(hit), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_decontamination_brute_force(spark, block_bytes):
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.choice((1, 2, 5, 9, 10, 11, 25))))) for i in range(12)]
    items += [(50, " ".join(f"q{i}" for i in range(30))), (51, "Z " * 40)]
    rows = []
    for i in range(60):
        words = [rng.choice("abcdefghijklmnop") + str(rng.randint(0, 9)) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            src = rng.choice(items)[1].split()
            a = rng.randrange(len(src))
            at = rng.randint(0, len(words))
            words[at:at] = src[a:a + rng.randint(1, 20)]
        rows.append((i, " ".join(words).upper() if i % 2 else ", ".join(words)))
    got = decontamination.contamination(cases.texts(spark, rows), cases.benchmark(spark, items), block_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.items_sha256) for r in got} == {i: brute_hits(t, items) for i, t in rows}


def test_benchmark_index_holds_every_window_in_bounded_memory():
    import tracemalloc

    import pyarrow as pa
    rng = random.Random(5)
    items = [(f"i{i % 900}", " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 300)) for _ in range(rng.choice((0, 1, 4, 9, 10, 11, 300)))))
             for i in range(2000)]
    rows = pa.table({"item": pa.array([i for i, _ in items]), "text": pa.array([t for _, t in items])})
    tracemalloc.start()
    index = decontamination.build_index(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # a block of a MB and arrays; no object per word
    want = {}
    for item, t in items:
        w = t.split()
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            want.setdefault((k, " ".join(w[i:i + k])), set()).add(item)
    have = {k: {tuple(sorted(index.names[j] for j in owner[a:b])) for a, b in zip(first[:-1], first[1:])}
            for k, (_, first, owner) in index.windows.items()}
    assert sum(len(h) for h, _, _ in index.windows.values()) == len(want)
    assert have == {k: {tuple(sorted(v)) for (n, _), v in want.items() if n == k} for k in have}


# ---- 5: rules

def test_rule_counts_brute_force(spark):
    docs = table("documents", SF_SMALL)
    got = {r.doc_id: r for r in quality_rules.query(spark, SF_SMALL).collect()}
    for i, text in zip(docs.doc_id, docs.text):
        w = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        times = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if times[tuple(w[k:k + 5])] > 1 for j in range(5)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_rule_plan_is_native(spark):
    plan = quality_rules.query(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rules_keep_clean_and_reject_junk(spark):
    marks = table("labels")
    got = {r.doc_id: r for r in quality_rules.query(spark, SF_CHECK).collect()}
    judged = [(got[i], q) for i, q in zip(marks.doc_id, marks.quality) if not got[i].base_failed]
    assert sum(r.kept for r, q in judged if q) >= 0.99 * sum(q for _, q in judged)
    assert sum(not r.kept for r, q in judged if not q) >= 0.9 * sum(not q for _, q in judged)


def prose(rng, n):
    words = [rng.choice("abdegilmnoprstuv") + rng.choice("aeiou") * rng.randint(1, 2) + rng.choice("dlmnrst") * rng.randint(0, 2) for _ in range(400)]
    return " ".join(rng.choice(words) for _ in range(n))


def junk(rng, n):
    return " ".join("".join(rng.choice("#*$%&|<>ABCDEFGH") for _ in range(rng.randint(15, 60))) for _ in range(n))


@pytest.mark.parametrize("rare", [58, 14, 3])
def test_rules_judge_rare_languages_and_small_sources(spark, rare):
    rng = random.Random(rare)
    rows = [(i, prose(rng, rng.randint(30, 200)), "en", "web" if i % 2 else "books") for i in range(300)]
    rows += [(1000 + i, prose(rng, rng.randint(30, 200)), "xx", "web") for i in range(rare - 1)] + [(1999, junk(rng, 60), "xx", "web")]
    rows += [(2000 + i, prose(rng, rng.randint(30, 200)), "en", None) for i in range(5)] + [(2999, junk(rng, 60), "en", None)]
    got = {r.doc_id: r for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert {i for i, r in got.items() if not r.kept} == {1999, 2999}
    assert all(r.distance is not None for r in got.values())


def test_rules_against_numpy(spark):
    """Concentration steps with exact quantiles over the whole group, in place of bins."""
    rng = random.Random(8)
    texts = [prose(rng, rng.randint(12, 400)) for _ in range(470)] + [junk(rng, rng.randint(12, 90)) for _ in range(30)]
    frame = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules.judge(frame).collect()}
    x = []
    for i, t in enumerate(texts):
        r, capitals = got[i], len(re.findall("[A-Z]", t))
        x.append((np.log1p(r.n_words), (r.word_chars + 125) / (r.n_words + 25), np.log1p(100 * r.n_symbols / (r.n_words + 10)),
                  np.log1p(100 * (r.n_repeat_words + 5 * r.n_dup_lines) / (r.n_words + 10)), np.log1p(100 * capitals / (r.word_chars + 50))))
    x = np.array(x)
    floors = np.diag([f ** 2 for _, f in quality_rules.FEATURES.values()])
    low, middle, high = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    mean, cov = middle, np.diag(((high - low) / 1.349) ** 2) + floors
    far = lambda: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    for _ in range(quality_rules.STEPS):
        near = x[far() <= np.median(far())]
        mean, cov = near.mean(axis=0), np.cov(near.T, bias=True) + floors
    d = far() / max(np.median(far()) / quality_rules.CHI2_MEDIAN, 0.5)
    mine = np.array([got[i].distance for i in range(len(texts))])
    assert np.allclose(mine, d, rtol=0.1, atol=0.1)
    clear = abs(d / quality_rules.CUT - 1) > 0.1
    assert clear.sum() >= 480 and (np.array([got[i].kept for i in range(len(texts))]) == (d <= quality_rules.CUT))[clear].all()
    assert not any(got[i].kept for i in range(470, 500))


def test_rules_bins_are_bounded(spark):
    rows = [(i, "x" * (10 ** (i % 6)) + " y" * (12 + i), "en", "s") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert quality_rules.judge(frame).count() == 40


# ---- 7: chat

def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "\\</s>", "\\\\[ANS] x \\", "", None, "[/ROLE]\\", " [/INST]", "<s>[TURN] a [/ROLE] ", "<<SYS>>\\\\<</SYS>>"]
    rows = [(c, k, role, text) for c in range(3) for k, (role, text) in enumerate(
        (r, t) for t in odd for r in ("user", "assistant", "system", "tool", None, "x [/ROLE] y"))]
    rows += [(None, 1, "user", "q"), (9, None, "user", "a"), (9, None, "assistant", "b"), (10, 0, "user", "q"), (10, 0, "user", "q")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(frame)).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -1, r or "", x or "") for i, t, r, x in rows if i == c))
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert not got[0].valid and not got[10].valid and got[None].valid is False


def test_chat_whole_table(spark):
    turns = table("conversations").sort_values(["conv_id", "turn"])
    got = {r.conv_id: r for r in chat_format.query(spark, SF_CHECK).collect()}
    assert got.pop(-1).valid
    want = {i: hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in zip(g.role, g.text)).encode()).hexdigest() for i, g in turns.groupby("conv_id")}
    assert {i: r.turns_sha256 for i, r in got.items()} == want


def test_chat_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_conversations(none)).collect() == []


# ---- 8: sharding

def test_shards_of_the_table(spark):
    docs = dict(zip(table("documents").doc_id, table("documents").text))
    got = sharding.query(spark, SF_CHECK).collect()
    assert {r.doc_id for r in got} == set(docs) and {r.shard for r in got} == set(range(24))
    where, slots, load = {}, {}, Counter()
    for r in got:
        raw = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        assert where.setdefault(docs[r.doc_id], r.shard) == r.shard
        slots.setdefault(r.shard, []).append(r.slot)
        load[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) <= 1.02 * sum(load.values()) / 24 and min(load.values()) >= 0.95 * sum(load.values()) / 24


def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(1)
    sizes = sorted((rng.randint(1, 100) for _ in range(400)), reverse=True)
    left, want = [], []
    for s in sizes:
        fits = [(r, b) for b, r in enumerate(left) if r >= s]
        if not fits:
            left.append(120)
            fits = [(120, len(left) - 1)]
        b = min(fits)[1]
        left[b] -= s
        want.append(b)
    assert sharding.best_fit_decreasing(sizes, 120) == want


def test_pack_with_a_huge_group():
    bins = sharding.pack([1000, *[10] * 230], 24)
    load = Counter()
    for size, b in zip([1000, *[10] * 230], bins):
        load[b] += size
    assert bins[0] == 0 and load[0] == 1000 and len(load) == 24 and max(load[b] for b in range(1, 24)) <= 110


# ---- 9: passages

def test_passages_are_cut_once_and_offsets_hold(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8)))
    sentence = lambda: " ".join([word().capitalize(), *(word() for _ in range(rng.randint(5, 12)))]) + "."
    passage = " ".join(sentence() for _ in range(7))
    rows = []
    for i in range(40):
        host = [sentence() for _ in range(12)]
        if i % 3 == 1:
            cut = host[5].split()
            host[5] = " ".join([*cut[:4], passage, *cut[4:]])
        rows.append((i, "\n".join(host) if i % 2 else " ".join(host)))
    got = {r.doc_id: r for r in substring_dedup.deduplicate(cases.texts(spark, rows)).collect()}
    removed = lambda r: r[substring_dedup.PREFIX + "removed"]
    for i, text in rows:
        spans = removed(got[i])
        if i % 3 == 1 and i > 1:
            assert passage not in got[i].text and passage in " ".join(text[s.start:s.end] for s in spans)
            assert sum(len(got[i].text.split()) + len(text[s.start:s.end].split()) for s in spans) == len(text.split())
        else:
            assert got[i].text == text and spans == []


def test_passages_match_a_sequential_pass(spark):
    import regex
    docs = table("documents").sort_values("doc_id")
    border = regex.compile(substring_dedup.BORDERS["sentence"])
    keeper, want = {}, {}
    for i, text in zip(docs.doc_id, docs.text):
        units = substring_dedup.split_units(text, border)
        seen = {int.from_bytes(d[:8], "little", signed=True) for _, _, d, _ in units if keeper.setdefault(d, i) < i}
        want[i] = substring_dedup.cut(text, seen, border, substring_dedup.MIN_WORDS)[0]
    got = {r.doc_id: r.text for r in substring_dedup.query(spark, SF_CHECK).collect()}
    assert got == want


def test_passages_without_borders_go_between_their_own_cuts(spark):
    """Of a passage without sentence borders the middle goes, wherever it stands; what is not repeated stays whole."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 8)))
    rows, passages, sides = [], [], []
    for k in range(30):
        passage = " ".join(word() for _ in range(60))
        for copy in range(2):
            left, right = (" ".join(word() for _ in range(rng.randint(1, 30))) for _ in range(2))
            rows.append((2 * k + copy, f"{left} {passage.upper() if k % 3 == 0 and copy else passage} {right}"))
            sides.append((left, right))
        passages.append(passage)
    short = " ".join(passages[0].split()[:7])
    rows.append((100, f"{word()} {short} {word()}"))
    chinese = ["".join(chr(rng.randint(0x4E00, 0x9FA0)) for _ in range(90)) for _ in range(3)]
    rows += [(101, chinese[0] + chinese[1]), (102, f"{chinese[2]}{chinese[1]}。")]
    got = {r.doc_id: r for r in substring_dedup.deduplicate(cases.texts(spark, rows)).collect()}
    left_over = []
    for i, text in rows:
        spans = [(s.start, s.end) for s in got[i][substring_dedup.PREFIX + "removed"]]
        if i % 2 == 0 and i < 100 or i in (100, 101):
            assert got[i].text == text and spans == []
        elif i < 100:
            (start, end), (left, right) = spans[0], sides[i]
            assert len(spans) == 1 and start > len(left) and end < len(text) - len(right)  # only words of the passage
            assert got[i].text == text[:start] + text[end:].lstrip()
            left_over.append(60 - len(text[start:end].split()))
        else:
            (start, end), = spans
            assert start >= 90 and end <= 180 and end - start >= 50
    assert sum(left_over) / len(left_over) <= 14 and max(left_over) <= 40


def test_units_inside_a_text_depend_on_its_words_alone():
    """Brute force: cuts where a pair of words has the smallest hash of all within reach, units of two pieces."""
    import pyarrow as pa

    from cartwise.llm import textvec
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "cc", "ddd", "é", "f"]) for _ in range(n)) for n in (0, 1, 3, 7, 8, 9, 40, 300, 2)] + ["x " * 50]
    got = list(substring_dedup.text_keys(pa.array(texts)))
    assert len(got) == len(texts)
    data, borders = textvec.column(pa.array(texts))
    found = substring_dedup.tokens(data, borders)
    rows, begins, ends, keys = substring_dedup.text_units(found)
    by_words = {}
    for r, text in enumerate(texts):
        words = text.split()
        score = [int(textvec.grams(found.hash[found.row(r)][i:i + 2], 2)[0]) if i + 1 < len(words) else None for i in range(len(words))]
        cuts = [i for i in range(len(words)) if i == 0 or (3 <= i < len(words) - 3 and all(
            score[j] is not None and score[i] < score[j] for j in range(i - 3, i + 4) if j != i))]
        edges = [*cuts, len(words)]
        want = [(a, c) for a, _, c in zip(edges, edges[1:], edges[2:])] or ([(0, len(words))] if len(words) >= 8 else [])
        own = rows == r
        base = found.first[r]
        assert list(zip((begins[own] - base).tolist(), (ends[own] - base).tolist())) == want, (r, want)
        assert np.array_equal(keys[own], got[r])
        for (a, b), key in zip(want, got[r].tolist()):
            assert by_words.setdefault(tuple(words[a:b]), key) == key
    assert len(set(by_words.values())) == len(by_words)


def test_lines_and_paragraphs(spark):
    a, b = "one two three four five six seven eight nine", "x y z"
    rows = [(1, f"{a}\n{b}"), (2, f"{b}\n{a.upper()}\nend"), (3, f"{b}\n\n{a}")]
    got = {r.doc_id: r.text for r in substring_dedup.deduplicate(cases.texts(spark, rows), units="line").collect()}
    assert got == {1: f"{a}\n{b}", 2: "end", 3: ""}
    got = {r.doc_id: r.text for r in substring_dedup.deduplicate(cases.texts(spark, rows), units="paragraph", min_words=3).collect()}
    assert got[1] == rows[0][1] and got[2] == rows[1][1] and got[3] == rows[2][1]


def test_short_lines_and_lines_without_spaces_go(spark):
    thai = "".join(chr(0x0E01 + i * 7 % 40) for i in range(30))
    rows = [(1, f"home | about\n{thai}\nfirst text"), (2, f"home | about\nsecond text\n{thai}")]
    for units, gap in (("line", "\n"), ("paragraph", "\n\n")):
        given = [(i, t.replace("\n", gap)) for i, t in rows]
        got = {r.doc_id: r.text for r in substring_dedup.deduplicate(cases.texts(spark, given), units=units).collect()}
        assert got == {1: given[0][1], 2: "second text" + gap}
    long = "".join(chr(0xAC00 + i * 131 % 11_000) for i in range(60))  # one word of a script with spaces
    rows = [(1, f"{long}\nfirst text"), (2, f"{long}\nsecond text"), (3, f"{long[:20]}\nthird"), (4, f"{long[:20]}\nfourth")]
    got = {r.doc_id: r.text for r in substring_dedup.deduplicate(cases.texts(spark, rows)).collect()}
    assert got == dict(rows) | {2: "second text"}


# ---- 10: urls

def test_url_rules_and_terms():
    rules = url_filters.by_length(url_filters.RULES)
    judge = lambda url: (lambda h, p: (h, p, url_filters.fitting_rule(rules, h, p)))(*url_filters.split_url(url))
    assert judge("HTTP://WWW.Example.COM/en/1?x#y") == ("www.example.com", "/en/1", ("allow", "www.example.com", "/en/"))
    assert judge("http://m.example.com/en/1")[2] == ("block", "example.com", "/en/")
    assert judge("http://badexample.com/en/1")[2] == ("allow", "com", "/")
    assert judge("http://a.net?x=/es/") == ("a.net", "", None) and judge("a.com/x") == ("", "", None) and judge(None) == ("", "", None)
    found = url_filters.automaton(url_filters.STRICT, url_filters.SOFT)
    assert url_filters.term_hits(found, "http://casino-x.org/") == ({"casino"}, set())
    assert url_filters.term_hits(found, "http://casinos.org/FREE/bets?free") == (set(), {"free", "bets"})
    assert url_filters.term_hits(found, None) == (set(), set())


# ---- pipeline

def test_pipeline_stages_and_result(spark):
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    scratch = Scratch(spark, "t-pipeline")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = scratch.write(stage(spark, docs, SF_SMALL), name)
        assert out.columns == docs.columns and out.count() <= docs.count()
        docs = out
    texts = {r.doc_id: r.text for r in docs.collect()}
    import tiktoken
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANK_FILE)))
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in texts.items()}
    assert all(c == (len(shingles(t)), i) for i, t in texts.items() for c in [brute_components([(i, t)])[i]])
