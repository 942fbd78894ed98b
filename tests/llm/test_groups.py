"""Similarity join, decontamination, sharding and rollup where groups are large, rows repeat or writers race."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from martforge.llm import decontaminate, graph, jaccard_join, sharding, token_rollup

rng = np.random.default_rng(11)
LEXICON = ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(4000)]


def fresh(n):
    return list(rng.choice(LEXICON, n))


def edited(words, k):
    out = list(words)
    for at in rng.choice(len(out), k, replace=False):
        out[at] = "x" + fresh(1)[0]
    return out


def crowd():
    """Texts with a passage in common, a large family of near copies, copies, and small families."""
    texts = []
    passage, template = fresh(60), fresh(150)
    texts += [" ".join(fresh(int(rng.integers(0, 40))) + passage + fresh(int(rng.integers(0, 60)))) for _ in range(90)]
    texts += [" ".join(edited(template, int(rng.integers(0, 6)))) for _ in range(120)]
    texts += [" ".join(template)] * 40
    other = fresh(140)
    texts += [" ".join(passage + other[:k]) for k in range(20, 140, 3)]
    for _ in range(20):
        base = fresh(int(rng.integers(5, 200)))
        texts += [" ".join(edited(base, min(len(base), int(k)))) for k in rng.integers(0, 4, 5)]
    texts += ["a b", "a b", "c", "", None, "one two three four five six", "one two three four five six seven"]
    return texts


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) or frozenset([tuple(words)])


def brute_components(texts):
    sets = [shingles(t) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    common = Counter()
    for h in holders.values():
        common.update((a, b) for i, a in enumerate(h) for b in h[i + 1:])
    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("few", [1 << 20, 0])
def test_components_of_crowded_keys(spark, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW_ROWS", few)  # 0: nothing is sent to all tasks
    texts = crowd()
    df = spark.createDataFrame([(i, t, {"k": i}) for i, t in enumerate(texts)], "doc_id long, text string, label map<string,int>")
    members, links = jaccard_join.ngram_jaccard(df.repartition(7))
    sizes, want = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in members.collect()}
    assert got == {i: (n, c) for i, (n, c) in enumerate(zip(sizes, want))}
    digest = {r.doc_id: r.digest for r in members.collect()}
    by = {d: shingles(texts[i]) for i, d in digest.items()}
    for r in links.collect():
        a, b = by[r.left_digest], by[r.right_digest]
        assert r.n_common == len(a & b) and r.n_union == len(a | b) and 100 * r.n_common >= 80 * r.n_union
    assert links.count() < 4 * len(texts)
    # map columns do not hinder the choice of one row of each component
    kept = jaccard_join.one_per_component(df)
    worded = [i for i, n in enumerate(sizes) if n]
    assert sorted(r.doc_id for r in kept.collect()) == sorted({want[i] for i in worded} | {i for i, n in enumerate(sizes) if not n})


def test_text_ids(spark):
    texts = crowd()[-110:]
    df = spark.createDataFrame([(f"id-{i:04d}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    members, _ = jaccard_join.ngram_jaccard(df)
    _, want = brute_components(texts)
    assert {r.doc_id: r.component_id for r in members.collect()} == {f"id-{i:04d}": f"id-{c:04d}" for i, c in enumerate(want)}
    assert jaccard_join.one_per_component(df).schema == df.schema


def test_equal_digests_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b c"), (2, "d e f")], "doc_id long, text string")
    profile, classes, seed = jaccard_join._profiles(df.select("doc_id", "text"), "bigint")
    assert seed == 0 and classes.count() == 2
    other = {jaccard_join.digest(np.arange(5, dtype=np.uint64), k) for k in range(4)}
    assert len(other) == 4


def test_groups_over_batches():
    import pyarrow as pa
    rows = [(1, 5), (1, 6), (1, 6), (2, 9), (3, None), (3, 1), (3, 2), *[(4, i) for i in range(50)], (5, 1), (5, 2), (6, 3),
            (7, None), (8, 1), (8, 4)]
    for size in (1, 2, 3, 7, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows[i:i + size]], pa.int64()),
                                               pa.array([d for _, d in rows[i:i + size]], pa.int64()),
                                               pa.array([0] * len(rows[i:i + size]), pa.int32())], names=["key", "digest", "hot"])
                   for i in range(0, len(rows), size)]
        out = [r for b in jaccard_join._groups(iter(batches)) for r in b.to_pylist()]
        assert [r["members"] for r in out if r["members"]] == [[5, 6], [1, 2], [1, 4]]
        assert {r["heavy"] for r in out if r["heavy"] is not None} == set(range(50))


def brute_hits(text, items, size=10):
    low = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = low(text), set(), set()
    for item, body in items:
        b = low(body)
        for w in {tuple(b[i:i + size]) for i in range(max(1, len(b) - size + 1))} if b else ():
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_decontamination_of_many_windows(spark):
    short = ["of", "the", "a", "in", "b"]
    prose = lambda n: " ".join(rng.choice(short, n))
    items = [(i, prose(int(rng.integers(1, 40))).title()) for i in range(200)] + [(None, "Lonely words here"), (900, ""),
             (901, None), (902, "zzz"), (903, "q r")]
    texts = [prose(int(n)) for n in rng.integers(0, 80, 60)]
    texts += [None, "", "x zzz y", "q, R! zzz", "some " + items[3][1].upper() + " more", "lonely WORDS here lonely words"]
    texts += texts[:3]
    docs = spark.createDataFrame([(i % 65, t, 0, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_hit int, items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in decontaminate.contamination(docs, bench).collect()]
    want = []
    for i, t in enumerate(texts):
        n, hit, found = brute_hits(t, items)
        want.append((i % 65, n, hit, found, hit > 0))
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(w[0] for w in want if not w[4])
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(texts)


def test_full_sieve_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SIEVE_BITS", 64)
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five six")], "doc_id long, text string")
    bench = spark.createDataFrame([("a", "two three"), ("b", "six five")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontaminate.contamination(docs, bench).collect()}
    assert got == {1: (2, ["a"]), 2: (0, [])}


def test_repeated_rows_are_spread(spark):
    rows = [(7, "z" * 1000)] * 400 + [(i, "y" * int(n)) for i, n in enumerate(rng.integers(10, 300, 598))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sharding.shard(df, 8).collect()
    loads, slots = Counter(), defaultdict(list)
    for r in out:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(loads.values()) / 8
    assert len(out) == len(rows) and max(loads.values()) < 1.05 * mean and min(loads.values()) > 0.9 * mean
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    same = sharding.shard(spark.createDataFrame([(1, "a")] * 800, "doc_id long, text string"), 8).groupBy("shard").count().collect()
    assert len(same) == 8 and max(r["count"] for r in same) <= 110


def test_losing_writer_changes_nothing(spark, scratch):
    path = scratch("race")
    one, two = token_rollup.Rollup(spark, path), token_rollup.Rollup(spark, path)
    row = lambda n: spark.createDataFrame([("s", "en", "t", 1, n, n)], token_rollup.SCHEMA)
    publish = two._publish

    def meanwhile(batch_id, folder):  # the other writer commits while this one is between its write and its marker
        assert one.commit(batch_id, row(10))
        return publish(batch_id, folder)
    two._publish = meanwhile
    assert two.commit("b", row(99)) is False
    assert [r.n_tokens for r in one.totals().collect()] == [10]
    two._publish = publish
    assert two.commit("b", row(99)) is False and two.commit("c", row(5)) is True
    assert [r.n_tokens for r in one.totals().collect()] == [15]
