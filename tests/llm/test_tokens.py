"""Token alignment, importance resampling and trie BPE against plain loops and the tokenizers' libraries."""

import hashlib
import math
import os
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from martforge.llm import bpe_trie, importance, queries, token_alignment

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "   \n\n\t x", "Solo", "the thing isn't here, it's 12.5 naïve ΩΩ #$% <x>", "a▁b", "<|endoftext|>",
         "<s>one</s> <|endoftext|>two<|endoftext|> <unk> <0x0A>", "日本 語 éé 😀 é", "A" * 3000, "=-" * 700,
         "\x00\x1f\x85　  end ", "\U00010940 ࢏ word", "The THE the Été " * 60, "x " * 5000,
         "don't we'll they've I'm you're he'd"]
SCHEMA = "doc_id long, text string, ids string, n_tokens int, links string, bucket int, rank int, part int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1, None, 0, 0, 0) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[14], (None, "null id " + "of the in " * 20, None, None, None, None, None, None),
             (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe_trie.VOCABULARY_PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe_trie.load_vocabulary().coder


def by_row(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ---- 13
def test_trie_equals_the_library(docs, library):
    coded = bpe_trie.encode(docs, ["doc_id", "text", "rank"])
    back = bpe_trie.decode(coded, ["doc_id", "text", "ids", "n_tokens"]).collect()
    assert len(back) == docs.count()
    for r in back:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(r.ids) // 4}I", r.ids)) == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False) == (r.text or "")
    assert bpe_trie.encode(docs.limit(0), ["doc_id"]).count() == 0
    plain = bpe_trie.encode(docs, ["doc_id", "text"], special=False).filter("doc_id = 7").first()
    assert plain.n_tokens > 1


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n'setThaing0189<|>-=_"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_trie_equals_the_library_on_any_text(text):
    from tokenizers import Tokenizer
    library, coder = _shared(Tokenizer)
    ids = np.frombuffer(coder.encode(text), "<u4").tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert coder.decode(coder.encode(text)) == text


_kept = []


def _shared(tokenizer):
    if not _kept:
        _kept.extend([tokenizer.from_file(bpe_trie.VOCABULARY_PATH), bpe_trie.load_vocabulary().coder])
    return _kept


def test_trie_starts_anew_when_full(monkeypatch, library):
    monkeypatch.setattr(bpe_trie, "NODES", 50)
    monkeypatch.setattr(bpe_trie, "CACHE_WORDS", 8)
    monkeypatch.setattr(bpe_trie, "LONG", 12)
    monkeypatch.setattr(bpe_trie, "ONE_CALL", 40)
    monkeypatch.setattr(bpe_trie, "RUN", 5)
    small = bpe_trie.Coder(bpe_trie.load_vocabulary())
    texts = [t for t in TEXTS if t] + ["understanding the transformation of extraordinary interpretations " * 3]
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode_step(texts)] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


def test_trie_shares_prefixes(coder):
    fresh = bpe_trie.Coder(bpe_trie.load_vocabulary())
    fresh.learn(sorted(["inter", "internal", "internet"]))
    assert len(fresh.up) == 1 + len("internal") + len("et")


def test_known_words_stay_when_the_cache_is_full(monkeypatch, library):
    monkeypatch.setattr(bpe_trie, "CACHE_WORDS", 5)
    small, learned = bpe_trie.Coder(bpe_trie.load_vocabulary()), []
    learn = small.learn
    monkeypatch.setattr(small, "learn", lambda words: (learned.extend(words), learn(words)))
    texts = ["one two three", "two three four five six", "seven one two"]
    for t in texts:
        ids = np.frombuffer(small.encode_step([t])[0], "<u4").tolist()
        assert ids == library.encode(t, add_special_tokens=False).ids
    # " three" is known when the second text fills the cache
    assert learned.count(" three") == 1


def test_fast_split_equals_the_library(coder):
    assert "\x1c" in coder.slow and not {"a", "\u00e9", "1", "_", " "} & coder.slow
    for t in ("it's we'll 'd x's", "a_b __ 1_2", "x\u00b2 \u0663\u0664 \u2167", "a\x1cb \x1d\x1f 1", "\u00e9t\u00e9  \n\n b ", " \x85\u00a0 c"):
        assert [w for run in coder.runs(t) for w in run] == [t[s:e] for _, (s, e) in coder.splitter.pre_tokenize_str(t)]


def test_pair_numbers_are_places_among_the_linkable():
    m = token_alignment.load_models()
    a, b = np.divmod(m.pairs, len(m.b_pieces))
    assert np.array_equal(m.pair_of(a, b), np.arange(len(m.pairs)))
    assert len(m.pair_of(a[:0], b[:0])) == 0


def test_trie_query(spark, library):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op13_bpe_trie(spark, SF).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = library.encode(rows[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((rows[r.doc_id] or "").encode()).hexdigest()


# ---- 11
def plain_alignment(rows):
    """Per row the eight columns, by loops over bytes."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_lib = Tokenizer.from_file(bpe_trie.VOCABULARY_PATH)
    a_lib.encode_special_tokens = True
    b_lib = SentencePieceProcessor(model_file=token_alignment.MODEL_PATH)
    letters = bpe_trie.byte_letters()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = [], []
        if text:
            a = [(i, bytes(letters[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
            for i in b_lib.encode(text):
                p = b_lib.id_to_piece(i)
                b.append((i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()))
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a, b = [], []
        ends = [np.cumsum([len(x) for _, x in s]).tolist() for s in (a, b)]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = defaultdict(lambda: ([], []))
        for side, (s, e) in enumerate(zip((a, b), ends)):
            for (i, _), end in zip(s, e):
                groups[next(c for c in cuts if c >= end)][side].append(i)
        links = [(i, j) for (i, _), x in zip(a, ends[0]) for (j, _), y in zip(b, ends[1]) if x == y]
        counts.update(links)
        written = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for _, (p, q) in sorted(groups.items()))
        docs.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(written.encode()).hexdigest() if a else ""))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return sorted([(d, na, nb, g, len(l), sum(counts[p] == best[p[1]] for p in l), sum(counts[p] for p in l), h)
                   for d, na, nb, g, l, h in docs], key=str), counts


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_equals_loops(docs):
    digests, pairs = token_alignment.align_corpus(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(d, t if t is None or len(t) < 2000 else t) for d, t in rows]
    want, counts = plain_alignment(rows)
    assert by_row(digests, *COLUMNS) == want
    assert {(r.a_id, r.b_id): r["count"] for r in pairs.collect()} == dict(counts)
    changed = next(r for r in want if r[0] == 6)  # a text with the model's own mark
    assert changed[1:] == (0, 0, 0, 0, 0, 0, "")
    digests, pairs = token_alignment.align_corpus(docs.limit(0))
    assert digests.count() == 0 and pairs.count() == 0


def test_alignment_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.op11_token_alignment(spark, SF)
    assert out.columns == list(COLUMNS) and all(t in ("bigint", "string") for _, t in out.dtypes)
    assert by_row(out, *COLUMNS) == plain_alignment(rows)[0]


def test_groups_of_any_intervals():
    rng = np.random.default_rng(3)
    for _ in range(50):
        cuts = [np.sort(rng.choice(np.arange(1, 40), rng.integers(1, 20), replace=False)) for _ in range(2)]
        ends = [np.append(c, 40) for c in cuts]
        starts = [np.append(0, c) for c in cuts]
        order, group = token_alignment.coalesce(np.concatenate(starts), np.concatenate(ends))
        assert group[-1] + 1 == len(set(ends[0]) & set(ends[1]))
        left, right = token_alignment.overlaps(starts[0], ends[0], starts[1], ends[1])
        assert set(zip(left, right)) == {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
                                         if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]}


def test_links_are_among_the_linkable():
    m = token_alignment.load_models()
    known = set(m.pairs.tolist())
    rng = np.random.default_rng(5)
    by = defaultdict(list)
    for j, p in enumerate(m.b_pieces):
        by[p[-1:]].append(j)
    for i in rng.choice(len(m.a.pieces), 300):
        for j in by[m.a.pieces[i][-1:]][:200]:
            x, y = m.a.pieces[i], m.b_pieces[j]
            assert ((i * len(m.b_pieces) + j) in known) == (x.endswith(y) or y.endswith(x))


# ---- 12
def plain_importance(rows, target, setting=importance.Setting()):
    def features(text):
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
        grams = [" ".join(words[i:i + n]) for n in range(1, setting.longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(g.encode()) % setting.buckets for g in grams]
    found = [features(t) for _, t in rows]
    s = Counter(b for _, f in found for b in f)
    t = Counter(b for x in target for b in features(x)[1])
    total_s, total_t, k = float(sum(s.values()) + setting.buckets), float(sum(t.values()) + setting.buckets), setting.buckets
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * total_s / ((s[b] + 1.0) * total_t))) for b in range(k)]
    out = []
    for (doc_id, _), (n, f) in zip(rows, found):
        h = int(hashlib.sha256(f"{setting.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc_id, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= setting.least_words),
                  key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[3], r[2]))
    for i, r in enumerate(able[:setting.percent * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=str)


IMPORTANCE = ("doc_id", "n_words", "n_features", "weight", "score", "rank")


@pytest.mark.parametrize("setting", [importance.Setting(), importance.Setting(3, 70_000, 7, 60, 4), importance.Setting(2, 5, 1, 100, 0)])
def test_importance_equals_loops(spark, docs, setting):
    target = spark.createDataFrame([("the of é word",), (None,), ("",), ("don't x x 日本",)], "text string")
    out = importance.resample(docs, target, setting)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert by_row(out, *IMPORTANCE) == plain_importance(rows, [r.text for r in target.collect()], setting)


def test_importance_edges(spark, docs):
    target = spark.createDataFrame([("the of",)], "text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert by_row(importance.resample(docs, target.limit(0)), *IMPORTANCE) == plain_importance(rows, [])
    assert importance.resample(docs.limit(0), target).count() == 0
    same = spark.createDataFrame([(4, "a b c d " * 10)] * 50, "doc_id long, text string")
    ranks = sorted(r["rank"] for r in importance.resample(same, target, importance.Setting(percent=30)).filter(
        "rank is not null").collect())
    assert ranks == list(range(1, 16))


def test_spans_are_the_ngrams():
    text = importance.collapse("  One,two--THREE é3 \n four!")
    assert text == "one two three é3 four".encode()
    assert list(importance.scanner(2)(text)) == [b"one two", b"two three", "three é3".encode(), "é3 four".encode()]
    assert list(importance.scanner(5)(text)) == [text] and list(importance.scanner(6)(text)) == []


def test_importance_query(spark):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    want = plain_importance([(r.doc_id, r.text) for r in read("documents").collect()],
                            [r.text for r in read("benchmark").collect()])
    assert by_row(queries.op12_importance(spark, SF), "doc_id", "n_features", "weight", "score", "rank") == sorted(
        [(d, f, w, s, k) for d, _, f, w, s, k in want], key=str)
