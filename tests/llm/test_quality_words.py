"""op10: word trigrams, the estimator against dictionaries, and texts whose words are not in order."""

import math
import random
import re
import threading
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np

from martforge.llm import quality, text as tx, word_model
from martforge.session import shared_dir

SF = "/root/testdata/sf0.001"


def brute(grams: list[tuple], half: int):
    """p(w1, w2, w3) of interpolated modified Kneser-Ney over the trigrams of one half."""
    three = Counter((a, b, c) for h, a, b, c in grams if h == half)
    two = Counter((b, c) for _, b, c in three)
    one = Counter(c for _, c in two)

    def discounts(counts):
        t = [max(1, sum(n == k for n in counts.values())) for k in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1])
        return [0] + [min(max(k - (k + 1) * y * t[k] / t[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]

    def order(counts, lower):
        d, by = discounts(counts), defaultdict(list)
        for g, n in counts.items():
            by[g[:-1] if isinstance(g, tuple) else ()].append(n)
        left = {c: (sum(ns), sum(d[min(n, 3)] for n in ns)) for c, ns in by.items()}

        def p(context, word):
            low = lower(context[1:], word)
            if context not in left:
                return low
            total, rest = left[context]
            n = counts.get((*context, word) if context else word, 0)
            return (n - d[min(n, 3)] + rest * low) / total
        return p
    p1 = order(one, lambda c, w: 1 / (len(one) + 1))
    return order(three, order(two, p1)), set(one)


def test_word_grams_and_kneser_ney_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    docs = docs.union(docs.limit(20)).union(spark.createDataFrame(
        [(1, "en", "Only ONE half"), (2, None, "no language here"), (3, "en", ""), (4, "en", " \n"), (5, "en", None)], docs.schema))
    texts = quality.distinct_texts(docs).cache()
    source = {r.t: (r.l, r.text) for r in texts.collect()}
    assert len(source) == docs.filter("text <> ''").selectExpr("coalesce(lang, 'und')", "text").distinct().count()
    by, name = defaultdict(list), {0: None}
    for r in quality.word_grams(texts).collect():
        by[r.t].append(r)
    for t, (_, text) in source.items():
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        assert len(words) == len(by[t]) and len({r.half for r in by[t]}) <= 1
        for w, r in zip(words, by[t]):
            assert name.setdefault(r.w3, w) == w
        before = [None, None, *words]
        assert [(name[r.w1], name[r.w2], name[r.w3]) for r in by[t]] == list(zip(before, before[1:], words))
    assert len(set(name.values())) == len(name)
    got = {r.t: r.log_perplexity for r in quality.perplexities(docs).collect()}
    assert set(got) == set(by) - {t for t in by if not by[t]}
    for lang in {x for x, _ in source.values()}:
        mine = {t: by[t] for t in got if source[t][0] == lang}
        rows = [(r.half, r.w1, r.w2, r.w3) for rs in mine.values() for r in rs]
        models = [brute(rows, h) for h in (0, 1)]
        for p, words in models:
            if words:
                for _, a, b, _ in rows[:3]:
                    assert math.isclose(sum(p((a, b), w) for w in words) + p((a, b), "?"), 1, abs_tol=1e-9)
        for t, rs in mine.items():
            p, words = models[1 - rs[0].half]
            want = -np.mean([math.log(p((r.w1, r.w2), r.w3)) for r in rs]) if words else None
            assert (got[t] is None) == (want is None) and (want is None or abs(got[t] - want) < 1e-5)


def test_words_out_of_order_are_rejected(spark):
    """Each word has three followers; the same words shuffled, and words of equal chance, are no text of the language."""
    rnd = random.Random(4)
    words = ["".join(rnd.choices("aeioulnrst", k=rnd.randint(3, 8))) for _ in range(120)]
    after = {w: rnd.sample(words, 3) for w in words}

    def prose():
        out = [rnd.choice(words)]
        while len(out) < 60:
            out.append(rnd.choice(after[out[-1]]))
        return out
    clean = [prose() for _ in range(300)]
    rows = [(i, "xx", " ".join(w)) for i, w in enumerate(clean)]
    rows += [(1000 + i, "xx", " ".join(rnd.sample(w, len(w)))) for i, w in enumerate(clean[:20])]
    rows += [(2000 + i, "xx", " ".join(rnd.choices(words, k=60))) for i in range(20)]
    rows += [(3000 + i, "xx", rows[0][2]) for i in range(500)]
    out = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect()}
    assert len(out) == len(rows)
    good = [r for i, r in out.items() if i < 300 and not r.base_failed]
    assert len(good) > 250 and sum(r.kept for r in good) >= 0.97 * len(good)
    assert not any(out[i].kept for i in out if 1000 <= i < 3000)
    assert len({(r.kept, r.log_perplexity) for i, r in out.items() if i >= 3000 or i == 0}) == 1


def test_hashes_are_ordered_as_by_a_stable_sort():
    rnd = np.random.default_rng(1)
    for keys in (rnd.integers(0, 1 << 63, 1000).astype(np.uint64), rnd.integers(0, 40, 1000).astype(np.uint64), np.empty(0, np.uint64),
                 rnd.integers(0, 3, 1000).astype(np.uint64) << np.uint64(62)):
        assert np.array_equal(tx.order(keys), np.argsort(keys, kind="stable"))


def test_rounds_ask_for_every_trigram_once_and_tables_stay_off_the_disk(spark):
    rnd = random.Random(7)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(3, 9))) for _ in range(5000)]
    rows = [(i, ["en", "de", None][i % 3], " ".join(rnd.choices(words, k=100))) for i in range(1000)]
    docs = spark.createDataFrame(rows + rows[:300], "doc_id long, lang string, text string")
    n_words = 100 * len(rows)
    held = word_model.chunks(quality.distinct_texts(docs))
    for context, rounds in ((False, word_model.PAIR_ROUNDS), (True, word_model.CONTEXT_ROUNDS)):
        asked = sum(len(r.subs) // 6 for k in range(rounds) for r in
                    held.mapInArrow(word_model._ask(context, k, rounds, 8), word_model.QUESTION).collect())
        want = sum(len(set(zip(c.w1, c.w2, c.w3, c.lang))) for c in (word_model.Chunk(r.asDict()) for r in held.collect()))
        assert asked == want
    word_model.discard(held)
    # all that is written on the way, as it grows; texts have 7 bytes a word, a table of trigrams some 30
    folder = Path(shared_dir(spark))
    old = set(folder.rglob("*.parquet"))
    most, ended = [0], threading.Event()

    def watch():
        while not ended.wait(0.02):
            size = 0
            for p in set(folder.rglob("*.parquet")) - old:
                try:
                    size += p.stat().st_size
                except FileNotFoundError:
                    pass
            most[0] = max(most[0], size)
    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        assert quality.perplexities(docs).count() == len(rows)
    finally:
        ended.set()
        watcher.join()
    assert 0 < most[0] < 25 * n_words, most[0] / n_words
