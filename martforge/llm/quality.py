r"""Quality rules: base rules of repetition and length, and bands of n-gram perplexity.

The language model is an interpolated modified Kneser-Ney model of order 3 over
the words `[^\x20\x09-\x0D]+` (A-Z lowered; 64-bit hashes stand for them) of all
distinct texts, one for each language and half of the texts: a text is scored by
the model of the half that it is not in, so its own trigrams never speak for it.
A text's least trigram hash deals it to a half, so near copies mostly share one.
``word_model`` counts the trigrams, and from them the distinct words before each
pair and each word, in tables dealt by their keys, which grow with the corpus;
only one row per language is sent to every task. An unknown word has one of
words + 1 equal shares at the bottom.

Counts and bands are of distinct texts, one of each language and text hash, so
that copies do not shift them; every row is scored.

A language's band of log perplexity is the median over its texts of at least
``MIN_WORDS`` words, plus and minus ``width`` robust standard deviations, wider
for short texts. Documents outside are rejected, on the upper side as noise, on
the lower as repetition.

Defined results: null and empty texts have no words and fail the base rule; a
null language is the language ``und``; a language whose other half has no
text accepts its documents;
repeated rows each give a row; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx, word_model
from .graph import materialize

#: Base rules: least words, and the largest percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT = 10, 20
REPEAT_WORDS = 5
#: Robust standard deviations of a band, the least deviation, and the bytes at which a band is half as wide again.
WIDTH, LEAST_DEVIATION, SHORT_BYTES = 3.0, 0.02, 100
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_LOWER = np.arange(256, dtype=np.int32)
_LOWER[65:91] += 32


def codes(data: np.ndarray) -> np.ndarray:
    """Code of the trigram that ends at each byte of one text (two blanks before the first). With ``fit`` the same
    estimator over bytes and in memory, which a test holds to; documents are judged by ``word_model``."""
    b = np.concatenate([np.full(2, 32, np.int32), _LOWER[data]])
    return (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]


@dataclass
class Language:
    keys: np.ndarray     # sorted trigram codes
    logs: np.ndarray     # their log probabilities
    back: np.ndarray     # log weight of the lower order, by context (2 bytes)
    pair: np.ndarray     # log probability of the lower order, by pair


def _discounts(n: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more."""
    t = np.array([max(1, int((n == k).sum())) for k in (1, 2, 3, 4)], float)
    y = t[0] / (t[0] + 2 * t[1])
    d = [k - (k + 1) * y * t[k] / t[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(x, 0.05), k - 0.05) for k, x in zip((1, 2, 3), d))])


def _order(n: np.ndarray, context: np.ndarray, contexts: int, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each counted event and the weight that its context leaves to the lower order."""
    cut = _discounts(n)[np.minimum(n, 3).astype(int)]
    total = np.bincount(context, n, contexts)
    left = np.where(total > 0, np.bincount(context, cut, contexts) / np.maximum(total, 1), 1.0)
    return (n - cut) / total[context] + left[context] * lower, left


def fit(keys: np.ndarray, counts: np.ndarray) -> Language:
    """Model of one language from its distinct trigrams and their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order].astype(np.int64), counts[order].astype(float)
    follows = np.bincount(keys & 0xFFFF, minlength=1 << 16).astype(float)     # bytes before each pair
    pairs = np.flatnonzero(follows)
    single = np.bincount(pairs & 0xFF, minlength=256).astype(float)           # bytes before each byte
    seen = np.flatnonzero(single)
    one = np.full(256, 1 / 256)
    p, left = _order(single[seen], np.zeros(len(seen), int), 1, one[seen])
    one *= left[0]
    one[seen] = p
    p, left = _order(follows[pairs], pairs >> 8, 256, one[pairs & 0xFF])
    two = left[np.arange(1 << 16) >> 8] * one[np.arange(1 << 16) & 0xFF]
    two[pairs] = p
    p, left = _order(counts, keys >> 8, 1 << 16, two[keys & 0xFFFF])
    return Language(keys.astype(np.int32), np.log(p).astype(np.float32), np.log(left).astype(np.float32),
                    np.log(two).astype(np.float32))


def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text"))


def _grams(batches):
    """Word trigrams of each text, as hashes of the lower-cased words (0 before the first)."""
    for step in tx.steps(batches, "text"):
        w1, w2, w3, rows = word_model.trigrams(*tx.utf8(step.column("text")))
        half = word_model.halves(w1, w2, w3, rows, step.num_rows)
        yield pa.RecordBatch.from_arrays(
            [step.column("l").take(pa.array(rows)), step.column("t").take(pa.array(rows)), pa.array(half[rows]),
             *(pa.array(w.view(np.int64)) for w in (w1, w2, w3))], names=["l", "t", "half", "w1", "w2", "w3"])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """l, t (hashes of language, and of language and text) and text, once for each."""
    # copies become one within their task before the texts are dealt out
    return (_text_rows(docs).filter("text <> ''").groupBy("lang", F.xxhash64("text").alias("text_hash"))
            .agg(F.min("text").alias("text"))
            .select(F.xxhash64("lang").alias("l"), F.xxhash64("lang", "text_hash").alias("t"), "text"))


def word_grams(texts: DataFrame) -> DataFrame:
    """l, t, half (0 or 1), w1, w2, w3: a row for each word of each distinct text."""
    return texts.mapInArrow(_grams, "l long, t long, half byte, w1 long, w2 long, w3 long")


def perplexities(docs: DataFrame) -> DataFrame:
    """t and log_perplexity (per word) of each distinct text, under the model of the half that it is not in."""
    return word_model.perplexities(distinct_texts(docs))


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(column)
    data, offsets = tx.utf8(column)
    per_text = lambda mask: np.diff(np.append(0, np.cumsum(mask))[offsets])
    starts, ends, rows = tx.spans(data, offsets, tx.NOT_SPACE)
    words = tx.hash_spans(data, starts, ends, tx.VALUES)
    first_byte = (data & 0xC0) != 0x80
    out = {"n_words": np.bincount(rows, minlength=n),
           "word_chars": per_text(first_byte & tx.NOT_SPACE[data]),
           "n_symbols": per_text(SYMBOLS[data])}
    # lines: runs without a line feed that hold a word; hashed whole
    not_feed = np.ones(256, bool)
    not_feed[10] = False
    ls, le, lr = tx.spans(data, offsets, not_feed)
    with_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, lr = ls[with_word], le[with_word], lr[with_word]
    lines = tx.hash_spans(data, ls, le, tx.VALUES)
    distinct = np.unique(np.stack([lr.astype(np.uint64), lines]), axis=1)[0].astype(np.int64) if len(lr) else lr
    out["n_dup_lines"] = np.bincount(lr, minlength=n) - np.bincount(distinct, minlength=n)
    hashes, at = tx.windows(words, rows, REPEAT_WORDS)
    covered = np.zeros(len(words) + 1, np.int64)
    if len(at):
        order = tx.order(hashes)     # of equal ones by row, as they are
        h, r = hashes[order], rows[at][order]
        same = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
        twice = at[order[np.append(same, False) | np.append(False, same)]]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WORDS, -1)
    out["n_repeat_words"] = np.bincount(rows[np.cumsum(covered)[:-1] > 0], minlength=n)
    return out


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text_hash, n_bytes and base counts of each document."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = _text_rows(docs).withColumn("text_hash", F.xxhash64("text"))

    def run(batches):
        for step in tx.steps(batches, "text"):
            _, offsets = tx.utf8(step.column("text"))
            counted = base_counts(step.column("text"))
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), step.column("lang"), step.column("text_hash"), pa.array(np.diff(offsets), pa.int64()),
                 *(pa.array(counted[c], pa.int64()) for c in names)],
                names=["doc_id", "lang", "text_hash", "n_bytes", *names])
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, lang string, text_hash long, n_bytes long, "
                           + ", ".join(f"{c} long" for c in names))


def judge(docs: DataFrame, width: float = WIDTH) -> DataFrame:
    """The measures with log_perplexity, base_failed, lower, upper (the document's band) and kept."""
    rows = measure(docs).withColumn("t", F.xxhash64("lang", "text_hash"))
    rows = materialize(docs.sparkSession, rows.join(perplexities(docs), "t", "left"), "quality-measures")
    # of distinct texts that are long enough to be kept
    texts = rows.filter(f"n_words >= {MIN_WORDS}").groupBy("lang", "t").agg(F.min("log_perplexity").alias("log_perplexity"))
    middle = texts.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, 10000).alias("middle"))
    spread = texts.join(F.broadcast(middle), "lang").groupBy("lang").agg(
        F.first("middle").alias("middle"),
        F.greatest(1.4826 * F.percentile_approx(F.abs(F.col("log_perplexity") - F.col("middle")), 0.5, 10000),
                   F.lit(LEAST_DEVIATION)).alias("deviation"))
    # one row per language
    wide = width * F.col("deviation") * (1 + F.sqrt(F.lit(float(SHORT_BYTES)) / F.greatest("n_bytes", F.lit(1))) / 2)
    failed = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT} * n_words"
    return (rows.join(F.broadcast(spread), "lang", "left")
            .withColumns({"base_failed": F.expr(failed), "lower": F.col("middle") - wide, "upper": F.col("middle") + wide})
            .withColumn("kept", F.expr("not base_failed and coalesce(log_perplexity between lower and upper, true)"))
            .drop("middle", "deviation", "text_hash", "t"))
