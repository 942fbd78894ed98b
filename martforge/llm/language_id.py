"""Language identification by the nearest of several centroids per language.

A text is a vector of byte n-grams (2 to 4 bytes, lower case, other ASCII than
letters as blanks) hashed into a fixed number of dimensions, weighted by log
term frequency and IDF, and scaled to length 1. The vectors of a language's
training texts are clustered (spherical k-means; clusters of under ``LEAST_MEMBERS`` texts
join the others); the language of the centroid with the greatest cosine is the
answer. How near a text must be depends on its language and length (distinct
n-grams, so that repetition makes no text longer): in each band of lengths, the cosine that 99% of the training texts reach, each held against
the centroids without itself. A text under ``reject`` times that is rejected.

The model is fitted on a bounded sample of labelled rows: ``sample`` distinct
texts per language, those of the least hash of doc_id. Predictions cover every row.

Defined results: null texts and texts without a letter are ``und``, score 0,
rejected; with no training rows every text is ``und``; equal cosines go to the
alphabetically first language; repeated rows each give a row; an empty table
gives no rows; other columns are ignored unless kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from . import text as tx

DIMENSIONS = 1 << 13
CLUSTERS = 3
#: Training texts per language.
SAMPLE = 300
LEAST_MEMBERS = 5
#: Lengths (distinct n-grams) that part the bands, and the texts that a language needs for a limit of its own in a band.
BANDS, BAND_TEXTS = (128, 256, 512, 1024), 20
#: A text is rejected under this share of the cosine that all but QUANTILE of the training texts of its band reach.
REJECT, QUANTILE = 0.6, 0.01
#: Least cosine where no training text has that length or less.
FLOOR = 0.02
UNDETERMINED = "und"

_BLANK = np.arange(256, dtype=np.uint32)
_BLANK[:128] = 32
_BLANK[97:123] = np.arange(97, 123)


@dataclass
class Model:
    idf: np.ndarray         # per dimension
    centroids: np.ndarray   # dimensions x centroids
    languages: np.ndarray   # of each centroid
    least: np.ndarray       # least cosine of a text, centroids x bands


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of a whole text."""
    b = _BLANK[np.frombuffer((" " + text.lower() + " ").encode(), np.uint8)]
    out = np.zeros(DIMENSIONS, np.int64)
    gram = b
    for n in (2, 3, 4):
        gram = (gram[:-1] << np.uint32(8)) | b[n - 1:]
        h = (gram + np.uint32(n)) * np.uint32(2654435761)
        out += np.bincount(h >> np.uint32(32 - 13), minlength=DIMENSIONS)
        if len(gram) < 2:
            break
    return out


def vectors(texts: list[str], idf: np.ndarray | None) -> np.ndarray:
    x = np.log1p(np.array([counts(t) for t in texts], np.float32).reshape(len(texts), DIMENSIONS))
    if idf is not None:
        x *= idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return x


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _scaled(c: np.ndarray) -> np.ndarray:
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Sums of the members of each cluster by spherical k-means; seeds are equal parts along the first principal axis."""
    centered = x - x.mean(0)
    axis = np.linalg.eigh((centered @ centered.T).astype(np.float64))[1][:, -1]
    c = np.array([x[p].sum(0) for p in np.array_split(np.argsort(axis, kind="stable"), min(k, len(x)))])
    for _ in range(10):
        near = np.argmax(x @ _scaled(c).T, axis=1)
        c = np.array([x[near == i].sum(0) for i in range(len(c)) if (near == i).any()])
    while len(c) > 1:
        near = np.argmax(x @ _scaled(c).T, axis=1)
        size = np.bincount(near, minlength=len(c))
        if size.min() >= LEAST_MEMBERS:
            break
        rest = np.delete(c, size.argmin(), axis=0)
        near = np.argmax(x @ _scaled(rest).T, axis=1)
        c = np.array([x[near == i].sum(0) for i in range(len(rest)) if (near == i).any()])
    return c


def _bands(x: np.ndarray) -> np.ndarray:
    return np.searchsorted(BANDS, (x > 0).sum(1), "right")


def _least(cosine: np.ndarray, band: np.ndarray, lang: np.ndarray, name: str) -> list[float]:
    """Least cosine of a text of ``name`` by band; bands with too few texts of it take those of all languages."""
    out = []
    for k in range(len(BANDS) + 1):
        own, all_ = cosine[(band == k) & (lang == name)], cosine[band == k]
        own = own if len(own) >= BAND_TEXTS else all_
        out.append(max(FLOOR, REJECT * float(np.quantile(own, QUANTILE))) if len(own) else out[-1] if out else FLOOR)
    return out


def fit(labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Model | None:
    """Fit on ``labelled(doc_id, text, lang)``; at most ``sample`` texts per language reach the driver."""
    ok = labelled.filter("text is not null and lang is not null").select("doc_id", "lang", "text")
    # repeated texts of a language count once; row_number <= k keeps k rows per language and task before the shuffle
    chosen = (ok.groupBy("lang", F.xxhash64("text").alias("h")).agg(
                  F.min(F.xxhash64(F.col("doc_id").cast("string"))).alias("id"))
              .withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("id", "h")))
              .filter(F.col("nth") <= sample).select("lang", "h", "nth"))
    rows = (ok.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "h"])
            .groupBy("lang", "nth").agg(F.min("text").alias("text")).orderBy("lang", "nth")
            .select("lang", "text").collect())
    rows = [(r[0], r[1]) for r in rows if has_letter(r[1])]
    if not rows:
        return None
    raw = vectors([t for _, t in rows], None)
    idf = (np.log((1 + len(rows)) / (1 + (raw > 0).sum(0))) + 1).astype(np.float32)
    x = raw * idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    langs = np.array([lang for lang, _ in rows])
    centroids, names, without = [], [], np.zeros(len(x))
    for lang in sorted(set(langs)):
        own = x[langs == lang]
        sums = _cluster(own, clusters)
        near = np.argmax(own @ _scaled(sums).T, axis=1)
        sums = np.array([own[near == i].sum(0) for i in range(len(sums)) if (near == i).any()])
        cosine = own @ _scaled(sums).T
        near = np.argmax(cosine, axis=1)
        cosine[np.arange(len(own)), near] = np.sum(own * _scaled(sums[near] - own), axis=1)
        without[langs == lang] = cosine.max(1)
        centroids += list(_scaled(sums))
        names += [lang] * len(sums)
    band = _bands(x)
    least = {lang: _least(without, band, langs, lang) for lang in set(names)}
    return Model(idf, np.array(centroids, np.float32).T, np.array(names), np.array([least[n] for n in names]))


def predict(texts: list[str | None], m: Model | None) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score (cosine, 0 to 1) and rejection of each text."""
    n = len(texts)
    lang, score, rejected = [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
    at = [i for i, t in enumerate(texts) if has_letter(t)] if m is not None else []
    for j in range(0, len(at), 64):
        part = at[j:j + 64]
        x = vectors([texts[i] for i in part], m.idf)
        cosine = x @ m.centroids
        best = cosine.argmax(1)
        for i, k, b, c in zip(part, best, _bands(x), cosine[np.arange(len(part)), best]):
            lang[i], score[i] = str(m.languages[k]), min(1.0, max(0.0, float(c)))
            rejected[i] = c < m.least[k, b]
    return lang, score, rejected


def identify(docs: DataFrame, keep: list[str], model: Model | None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``lang_pred``, ``score`` and ``rejected``."""
    new = [StructField("lang_pred", StringType()), StructField("score", DoubleType()),
           StructField("rejected", BooleanType())]
    keep = [c for c in keep if c not in {f.name for f in new}]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))

    def run(batches):
        for step in tx.steps(batches, "_text"):
            lang, score, rejected = predict(step.column("_text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([*(step.column(c) for c in keep), pa.array(lang), pa.array(score),
                                              pa.array(rejected)], names=[*keep, *(f.name for f in new)])
    return rows.mapInArrow(run, StructType([*rows.select(*keep).schema.fields, *new]))
