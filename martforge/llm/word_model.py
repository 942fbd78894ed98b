"""Interpolated modified Kneser-Ney model over word trigrams, one for each language and half of the texts.

The distinct texts are written once, as chunks of one half. A chunk asks three
tables, each dealt by its key, for counts in the other half: the trigrams by
the pair of words before them (their counts, and those of the context), the
pairs by themselves (how many distinct words stand before each), and the words
(how many pairs begin and end with each). A chunk asks once for each distinct
key; sorted arrays cross the shuffle, in rounds over ranges of the key's hash,
so that the disk holds one range at a time. An answer has the order of its
question, so it needs no keys: the chunk works them out again, computes the
probabilities and adds them up for its texts.

Every table grows with the corpus and is dealt by its key; only the counts of
counts, a row per language, go to the driver and to every task.
"""

from __future__ import annotations

from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path, size_text_batches
from . import text as tx
from .graph import discard, materialize, release

#: Bytes of text in a chunk, and rounds in which texts, pairs, words, contexts and chunks cross the shuffle.
CHUNK_BYTES = 8 << 20
TEXT_ROUNDS, PAIR_ROUNDS, WORD_ROUNDS, CONTEXT_ROUNDS, CHUNK_ROUNDS = 2, 4, 6, 6, 6
#: Log probabilities are added as whole numbers of 1 / UNIT, so that the sum has no order.
UNIT = 1 << 20

CHUNK = "chunk long, half byte, l binary, t binary, offsets binary, data binary"
QUESTION = "q int, chunk long, half byte, langs binary, lang binary, keys binary, runs binary, subs binary, counts array<binary>"
ANSWER = "chunk long, q int, answers array<binary>, l long, counts array<long>"


def _small(a: np.ndarray) -> bytes:
    """Counts in the least number of bytes each."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0)).tobytes()


def _ints(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, f"u{len(blob) // n}").astype(np.int64) if n else np.empty(0, np.int64)


def _planes(a: np.ndarray, size: int = 8) -> bytes:
    """The low ``size`` bytes of numbers, byte by byte, which packs better than number by number."""
    return np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _from_planes(blob: bytes, size: int = 8) -> np.ndarray:
    out = np.zeros((len(blob) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(blob, np.uint8).reshape(size, -1).T
    return out.view("<u8").ravel()


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """w1, w2, w3 (hashes of the lower-cased words, 0 before the first) and the text of each word."""
    words, rows, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(offsets) - 1:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + tx.STEP_BYTES, "right")) - 1)
        part = data[offsets[at]:offsets[stop]]
        starts, ends, row = tx.spans(part, offsets[at:stop + 1] - offsets[at], tx.NOT_SPACE)
        words.append(tx.hash_spans(part, starts, ends, tx.VALUES_LOWER))
        rows.append(row + at)
        at = stop
    w3, row = np.concatenate(words), np.concatenate(rows)
    w2, w1 = np.zeros_like(w3), np.zeros_like(w3)
    w2[1:] = np.where(row[1:] == row[:-1], w3[:-1], 0)
    w1[2:] = np.where(row[2:] == row[:-2], w3[:-2], 0)
    return w1, w2, w3, row


def halves(w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """The half (0 or 1) of each of n texts: its least trigram deals it, so that near copies mostly share theirs."""
    least = np.full(n, -1, np.int64).view(np.uint64)
    np.minimum.at(least, row, tx.mix(tx.mix(tx.mix(w1) + w2) + w3))
    return (tx.mix(least) & np.uint64(1)).astype(np.int8)


def _pack(batches):
    """Chunks of the texts of one half that have words."""
    held, seq, task = {0: [], 1: []}, 0, TaskContext.get().partitionId()

    def chunk(half):
        nonlocal seq
        l, t, sizes, data = zip(*held[half])
        held[half] = []
        seq += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([task << 32 | seq]), pa.array([half], pa.int8()), pa.array([b"".join(l)]), pa.array([b"".join(t)]),
             pa.array([np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int64).tobytes()]), pa.array([b"".join(data)])],
            names=["chunk", "half", "l", "t", "offsets", "data"])
    for step in tx.steps(batches, "text"):
        w1, w2, w3, row = trigrams(*tx.utf8(step.column("text")))
        half = halves(w1, w2, w3, row, step.num_rows)
        worded = np.bincount(row, minlength=step.num_rows) > 0
        for h in (0, 1):
            mine = step.filter(pa.array(worded & (half == h)))
            if mine.num_rows:
                data, offsets = tx.utf8(mine.column("text"))
                held[h].append((mine.column("l").to_numpy().tobytes(), mine.column("t").to_numpy().tobytes(),
                                np.diff(offsets), data.tobytes()))
                if sum(len(x[3]) for x in held[h]) >= CHUNK_BYTES:
                    yield chunk(h)
    for h in (0, 1):
        if held[h]:
            yield chunk(h)


def chunks(texts: DataFrame) -> DataFrame:
    """The texts (l, t, text) written as chunks, in rounds over their hashes."""
    spark = texts.sparkSession
    path = scratch_path(spark, "quality-chunks")
    for r in range(TEXT_ROUNDS):
        (texts.filter(f"pmod(t, {TEXT_ROUNDS}) = {r}").mapInArrow(_pack, CHUNK).withColumn("chunk", F.expr(f"chunk * {TEXT_ROUNDS} + {r}"))
         .write.mode("append").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "6").parquet(path))
        release(spark)
    out = spark.read.schema(CHUNK).parquet(path)
    out.scratch = path
    return out


class Chunk:
    """The words of a chunk: language numbers, trigrams, and hashes of the pairs that end at and before each word."""

    def __init__(self, row: dict):
        offsets = np.frombuffer(row["offsets"], np.int64)
        self.id, self.half, self.texts = row["chunk"], row["half"], len(offsets) - 1
        self.langs, lang = np.unique(np.frombuffer(row["l"], np.int64), return_inverse=True)
        self.w1, self.w2, self.w3, self.row = trigrams(np.frombuffer(row["data"], np.uint8), offsets)
        self.lang = lang[self.row]
        self.seed = tx.mix(self.langs.view(np.uint64))[self.lang]
        # the pair before a word is the one that ends at the word before
        self.pair = tx.mix(tx.mix(self.seed + self.w2) + self.w3)

    @cached_property
    def context(self) -> np.ndarray:
        return np.where(self.same, np.roll(self.pair, 1), tx.mix(tx.mix(tx.mix(self.langs.view(np.uint64))))[self.lang])

    @property
    def same(self) -> np.ndarray:
        """Whether the word before is of the same text."""
        return np.append(False, self.row[1:] == self.row[:-1])[:len(self.row)]

    def word_keys(self) -> tuple[np.ndarray, ...]:
        """Sorted hashes of the words and of "none before the first", the places in them of the word before each word and
        of the word, and their languages."""
        lang = np.append(self.lang, np.arange(len(self.langs)))
        key = np.append(tx.mix(self.seed + self.w3), tx.mix(tx.mix(self.langs.view(np.uint64))))
        order = tx.order(key)
        found = key[order]
        new = np.append(True, found[1:] != found[:-1])
        place = np.empty(len(key), np.int64)
        place[order] = np.cumsum(new) - 1
        word, none = place[:len(self.w3)], place[len(self.w3):]
        return found[new], np.where(self.same, np.roll(word, 1), none[self.lang]), word, lang[order[new]]


class Distinct:
    """Distinct (key, sub) of some entries, sorted: ``order`` of the entries, ``new`` (where in it a pair starts), ``first``
    (where in ``new`` a key starts)."""

    def __init__(self, key: np.ndarray, sub: np.ndarray):
        self.order = tx.order(sub)
        self.order = self.order[tx.order(key[self.order])]
        k, s = key[self.order], sub[self.order]
        new_key = np.append(True, k[1:] != k[:-1])[:len(k)]
        new = new_key | np.append(True, s[1:] != s[:-1])[:len(k)]
        self.new, self.first = np.flatnonzero(new), np.flatnonzero(new_key[new])
        self.at = self.order[self.new]           # an entry of each pair
        self.keys, self.subs = k[self.new][self.first], s[self.new]
        self.runs = np.diff(np.append(self.first, len(self.new)))
        self.key_of = np.repeat(np.arange(len(self.keys)), self.runs)
        self.place = np.empty(len(k), np.int64)  # the pair of each entry
        self.place[self.order] = np.cumsum(new) - 1

    def counts(self) -> np.ndarray:
        return np.diff(np.append(self.new, len(self.order)))


def _range(key: np.ndarray, ranges: int) -> np.ndarray:
    """The range (of equal ones, in the order of the keys) of each hash."""
    return ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


#: Sub-keys are the high 48 bits of a word's hash, beside the 64 of the pair.
_sub = lambda w: w & np.uint64(0xFFFFFFFFFFFF0000)


def _question(c: Chunk, ranges: int, keys, lang, runs=None, subs=None, counts=()) -> pa.RecordBatch:
    """A row for each range that holds keys."""
    q = _range(keys, ranges)
    cut = np.append(np.flatnonzero(np.append(True, q[1:] != q[:-1])[:len(q)]), len(q))
    ends = np.append(0, np.cumsum(runs)) if runs is not None else np.arange(len(keys) + 1)
    rows = []
    for a, b in zip(cut[:-1], cut[1:]):
        x, y = ends[a], ends[b]
        there = np.bincount(lang[a:b], minlength=len(c.langs)) > 0
        rows.append({"q": int(q[a]), "chunk": c.id, "half": c.half, "langs": c.langs[there].tobytes(),
                     "lang": _small((np.cumsum(there) - 1)[lang[a:b]]),
                     "keys": _planes(np.append(keys[a:a + 1], np.diff(keys[a:b]))), "runs": b"" if runs is None else _small(runs[a:b]),
                     "subs": b"" if subs is None else _planes(subs[x:y] >> np.uint64(16), 6), "counts": [_small(n[x:y]) for n in counts]})
    return pa.RecordBatch.from_pylist(rows, schema=_QUESTION)


_QUESTION = pa.schema([("q", pa.int32()), ("chunk", pa.int64()), ("half", pa.int8()), ("langs", pa.binary()), ("lang", pa.binary()),
                       ("keys", pa.binary()), ("runs", pa.binary()), ("subs", pa.binary()), ("counts", pa.list_(pa.binary()))])
_ANSWER = pa.schema([("chunk", pa.int64()), ("q", pa.int32()), ("answers", pa.list_(pa.binary())), ("l", pa.int64()),
                     ("counts", pa.list_(pa.int64()))])


def _ask(context: bool, r: int, rounds: int, parts: int):
    """Questions of round r: trigrams by their contexts, with their counts, or by the pairs that end them."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                key, sub = (c.context, c.w3) if context else (c.pair, c.w1)
                mine = np.flatnonzero(_range(key, rounds) == r)
                if len(mine):
                    d = Distinct(key[mine], _sub(sub[mine]))
                    yield _question(c, rounds * parts, d.keys, c.lang[mine[d.at[d.first]]], d.runs, d.subs,
                                    [d.counts()] if context else [])
    return run


def _counts_of_counts(langs: np.ndarray, lang: np.ndarray, counts, more=lambda n: []) -> list[dict]:
    """For each language and half: how many counts are 1, 2, 3, 4; then ``more``."""
    out = []
    for n in counts:
        out += [*np.bincount(lang * 6 + np.minimum(n, 5), minlength=6 * len(langs)).reshape(-1, 6).T[1:5],
                *(np.bincount(lang, x, len(langs)).astype(np.int64) for x in more(n))]
    return [{"l": int(x), "counts": [int(v[i]) for v in out]} for i, x in enumerate(langs)]


def _keys_asked(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """Keys, languages, the number of each key's language, and the first key of each row of questions (and the end)."""
    keys = [np.cumsum(_from_planes(r["keys"]), dtype=np.uint64) for r in rows]
    own = [np.frombuffer(r["langs"], np.int64) for r in rows]
    langs = np.unique(np.concatenate(own))
    lang = [np.searchsorted(langs, x)[_ints(r["lang"], len(k))] for r, x, k in zip(rows, own, keys)]
    return np.concatenate(keys), langs, np.concatenate(lang), np.append(0, np.cumsum([len(k) for k in keys]))


def _answer(context: bool):
    """Contexts: the sum of each context in the other half; of those that are there, the counts of the trigrams asked for and how
    many are 1, 2 and 3 or more. Pairs: how many distinct words stand before each in the other half, whether this row is the one
    to report the pair, and the pairs' numbers in its own half if so."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, langs, lang, start = _keys_asked(rows)
        runs = np.concatenate([_ints(r["runs"], n) for r, n in zip(rows, np.diff(start))])
        subs = [_from_planes(r["subs"], 6) << np.uint64(16) for r in rows]
        ends = np.append(0, np.cumsum([len(s) for s in subs]))
        half = np.repeat([r["half"] for r in rows], np.diff(ends))
        d = Distinct(np.repeat(keys, runs), np.concatenate(subs))
        one = np.concatenate([_ints(r["counts"][0], n) for r, n in zip(rows, np.diff(ends))]) if context else np.ones(ends[-1])
        n = [np.bincount(d.place, one * (half == f), len(d.new)).astype(np.int64) for f in (0, 1)]
        asked = d.key_of[d.place[np.append(0, np.cumsum(runs))[:-1]]]     # the distinct key of each key asked for
        of = np.empty(len(d.keys), np.int64)
        of[asked] = lang
        per_key = lambda x: np.bincount(d.key_of, x, len(d.keys)).astype(np.int64)
        out = []
        if context:
            sums = [[per_key(n[f]), *(per_key(y) for y in (n[f] == 1, n[f] == 2, n[f] >= 3))] for f in (0, 1)]
            for i, r in enumerate(rows):
                mine, there = asked[start[i]:start[i + 1]], sums[1 - r["half"]]
                seen = there[0][mine] > 0
                counted = n[1 - r["half"]][d.place[ends[i]:ends[i + 1]]][np.repeat(seen, runs[start[i]:start[i + 1]])]
                out.append([_small(there[0][mine]), _small(counted), *(_small(x[mine[seen]]) for x in there[1:])])
            stats = _counts_of_counts(langs, of[d.key_of], n)
        else:
            k = [per_key(x > 0) for x in n]
            reporter = np.empty(len(d.keys), np.int64)
            reporter[asked[::-1]] = np.arange(len(asked))[::-1]
            for i, r in enumerate(rows):
                mine = asked[start[i]:start[i + 1]]
                report = reporter[mine] == np.arange(start[i], start[i + 1])
                out.append([_small(k[1 - r["half"]][mine]), np.packbits(report).tobytes(), _small(k[r["half"]][mine[report]])])
            stats = _counts_of_counts(langs, of, k)
        return pa.Table.from_pylist([{"chunk": r["chunk"], "q": r["q"], "answers": a} for r, a in zip(rows, out)] + stats, schema=_ANSWER)
    return run


def _answer_words(table: pa.Table) -> pa.Table:
    """In the other half: the pairs that a word ends, and the sum and how many are 1, 2 and 3 or more of the pairs it begins."""
    rows = table.to_pylist()
    keys, langs, lang, start = _keys_asked(rows)
    distinct, first, place = np.unique(keys, return_index=True, return_inverse=True)
    sums = [np.bincount(place, np.concatenate([_ints(r["counts"][i], n) for r, n in zip(rows, np.diff(start))]),
                        len(distinct)).astype(np.int64) for i in range(10)]
    out = [{"chunk": r["chunk"], "q": r["q"], "answers": [_small(x[place[a:b]]) for x in sums[5 * (1 - r["half"]):][:5]]}
           for r, a, b in zip(rows, start, start[1:])]
    return pa.Table.from_pylist(out + _counts_of_counts(langs, lang[first], (sums[0], sums[5]), lambda u: [u, u > 0]),
                                schema=_ANSWER)


PAIRS, WORDS, CONTEXTS = 0, 1, 2


def _in_order(table: pa.Table, kind: int, decode) -> list[np.ndarray]:
    """The answers to a chunk's questions of one kind, in the order of its sorted keys; ``decode`` turns the answer of a range into
    arrays."""
    rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["q"])
    return [np.concatenate(x) for x in zip(*(decode(r["q"], r["answers"]) for r in rows))]


def _ends(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted keys (and the end)."""
    return np.append(0, np.cumsum(np.bincount(_range(keys, ranges), minlength=ranges)))


def _report_words(parts: int):
    """Questions for the words of a chunk, with what the pairs that it reports add to their counts: for each half, the pairs that
    a word ends, and the sum and how many are 1, 2 and 3 or more of the pairs it begins."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c = Chunk(left.to_pylist()[0])
        d = Distinct(c.pair, _sub(c.w1))
        start = _ends(d.keys, PAIR_ROUNDS * parts)

        def decode(q, answers):
            n = start[q + 1] - start[q]
            report = np.unpackbits(np.frombuffer(answers[1], np.uint8))[:n].astype(bool)
            own = np.zeros(n, np.int64)
            own[report] = _ints(answers[2], report.sum())
            return own, _ints(answers[0], n), report
        *k, report = _in_order(right, PAIRS, decode)
        keys, begins, ends, lang = c.word_keys()
        begins, ends = begins[d.at[d.first]], ends[d.at[d.first]]
        counts = []
        for f in (0, 1):
            x = np.where(report, k[f ^ c.half], 0)
            counts.append(np.bincount(ends, x > 0, len(keys)))
            counts += [np.bincount(begins, y, len(keys)) for y in (x, x == 1, x == 2, x >= 3)]
        return pa.Table.from_batches([_question(c, WORD_ROUNDS * parts, keys, lang, counts=[x.astype(np.int64) for x in counts])])
    return run


def _discounts(t: np.ndarray) -> list[float]:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3 and 4."""
    t = np.maximum(t, 1).astype(float)
    y = t[0] / (t[0] + 2 * t[1])
    return [0.0, *(min(max(k - (k + 1) * y * t[k] / t[k - 1], 0.05), k - 0.05) for k in (1, 2, 3))]


def _interpolated(n, sums, d, lower):
    """Probability of counts in their contexts (sum, and how many are 1, 2, 3 or more): discounted, plus what the context leaves to
    the lower order."""
    total, one, two, three = sums
    left = d[:, 1] * one + d[:, 2] * two + d[:, 3] * three
    return np.where(total > 0, (n - d[np.arange(len(n)), np.minimum(n, 3)] + left * lower) / np.maximum(total, 1), lower)


def _score(parts: int, totals: dict):
    """t and log_perplexity of a chunk's texts."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        c = Chunk(row)
        f = 1 - c.half
        # of each language of the chunk, in the other half
        of = {kind: [totals[kind, int(x)][f * size:(f + 1) * size] for x in c.langs] for kind, size in ((PAIRS, 4), (WORDS, 6), (CONTEXTS, 4))}
        cut = {kind: np.array([_discounts(t[:4]) for t in of[kind]]) for kind in of}
        ends, words = np.array([t[4:] for t in of[WORDS]]).T
        three = np.array([t[5] - t[0] - t[1] for t in of[WORDS]])
        d = Distinct(c.pair, _sub(c.w1))
        keys, begins, last, lang = c.word_keys()
        begins, last = begins[d.at[d.first]], last[d.at[d.first]]
        at = _ends(keys, WORD_ROUNDS * parts)
        u, *begun = _in_order(right, WORDS, lambda q, answers: [_ints(x, at[q + 1] - at[q]) for x in answers])
        one, two = np.array([t[:2] for t in of[WORDS]]).T
        p1 = _interpolated(u, [x[lang] for x in (ends, one, two, three)], cut[WORDS][lang], 1 / (words[lang] + 1))
        of_pairs = _ends(d.keys, PAIR_ROUNDS * parts)
        k = _in_order(right, PAIRS, lambda q, answers: [_ints(answers[0], of_pairs[q + 1] - of_pairs[q])])[0]
        p2 = _interpolated(k, [x[begins] for x in begun], cut[PAIRS][c.lang[d.at[d.first]]], p1[last])
        pair = d.key_of[d.place]
        d = Distinct(c.context, _sub(c.w3))
        start = _ends(d.keys, CONTEXT_ROUNDS * parts)

        def decode(q, answers):
            total = _ints(answers[0], start[q + 1] - start[q])
            seen = total > 0
            known = np.repeat(seen, d.runs[start[q]:start[q + 1]])
            out = [np.zeros(len(known), np.int64), total, *(np.zeros(len(total), np.int64) for _ in range(3))]
            out[0][known] = _ints(answers[1], known.sum())
            for x, counted in zip(out[2:], answers[2:]):
                x[seen] = _ints(counted, seen.sum())
            return out
        n, *sums = _in_order(right, CONTEXTS, decode)
        p3 = _interpolated(n, [x[d.key_of] for x in sums], cut[CONTEXTS][c.lang[d.at]], p2[pair[d.at]])
        logs = np.rint(np.log(p3) * UNIT).astype(np.int64)[d.place]
        total = -np.bincount(c.row, logs, c.texts) / np.bincount(c.row, minlength=c.texts) / UNIT
        t, l = np.frombuffer(row["t"], np.int64), np.searchsorted(c.langs, np.frombuffer(row["l"], np.int64))
        return pa.table({"t": t, "log_perplexity": pa.array(total, mask=ends[l] == 0)})
    return run


def perplexities(texts: DataFrame) -> DataFrame:
    """t and log_perplexity (per word) of each text (l, t, text) that has words, under the model of its language in the half that
    it is not in (null where that half has no text of the language)."""
    spark: SparkSession = texts.sparkSession
    size_text_batches(spark)
    parts = 2 * int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
                    or spark.conf.get("spark.sql.shuffle.partitions"))
    held = chunks(texts)
    found = {PAIRS: [], WORDS: [], CONTEXTS: []}

    def answered(kind: int, questions: DataFrame, answer) -> None:
        found[kind].append(materialize(spark, questions.groupBy("q").applyInArrow(answer, ANSWER).withColumn("kind", F.lit(kind)),
                                       "quality-answers", codec="zstd"))
        release(spark)

    def with_answers(kinds, run, schema: str, name: str) -> list[DataFrame]:
        """``run`` over each chunk and its answers, in rounds over the chunks, as whole texts cross the shuffle."""
        right = reduce(DataFrame.union, [a for kind in kinds for a in found[kind]]).select("chunk", "q", "answers", "kind")
        if WORDS in kinds:
            right = right.withColumn("answers", F.expr(f"if(kind = {PAIRS}, slice(answers, 1, 1), answers)"))
        out = []
        for r in range(CHUNK_ROUNDS):
            mine = [x.filter(f"pmod(chunk, {CHUNK_ROUNDS}) = {r}").groupBy("chunk") for x in (held, right.filter("chunk is not null"))]
            out.append(materialize(spark, mine[0].cogroup(mine[1]).applyInArrow(run, schema), name, codec="zstd"))
            release(spark)
        return out
    for r in range(PAIR_ROUNDS):
        answered(PAIRS, held.mapInArrow(_ask(False, r, PAIR_ROUNDS, parts), QUESTION), _answer(False))
    asked = with_answers([PAIRS], _report_words(parts), QUESTION, "quality-words")
    for r in range(WORD_ROUNDS):
        answered(WORDS, reduce(DataFrame.union, asked).filter(f"q div {parts} = {r}"), _answer_words)
    discard(*asked)
    for r in range(CONTEXT_ROUNDS):
        answered(CONTEXTS, held.mapInArrow(_ask(True, r, CONTEXT_ROUNDS, parts), QUESTION), _answer(True))
    # a row for each kind, language and count
    totals = {}
    for x in (reduce(DataFrame.union, [a for kind in found.values() for a in kind]).filter("l is not null")
              .select("kind", "l", F.posexplode("counts")).groupBy("kind", "l", "pos").agg(F.sum("col").alias("n")).orderBy("pos").collect()):
        totals.setdefault((x.kind, x.l), []).append(x.n)
    out = with_answers(found, _score(parts, {k: np.array(v) for k, v in totals.items()}), "t long, log_perplexity double",
                       "quality-perplexities")
    discard(held, *(a for kind in found.values() for a in kind))
    return reduce(DataFrame.union, out)
