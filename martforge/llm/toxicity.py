"""Toxicity by a linear-chain conditional random field over the words of a text.

Training (a bounded sample, below): labelled documents give labelled tokens: a
word of a toxic document is toxic if it, or its beginning of ``begin`` letters,
is found in at least ``share`` of the toxic documents and ``lift`` times as
often, by share of documents, as in the others. Near copies among the toxic
documents count once. The field has two states, a weight per known word, per
known beginning for other words (the rest share one) and transition weights,
fitted by gradient on the forward-backward marginals with an L2 penalty.

Scoring runs forward-backward over whole texts, many texts side by side. The
score of a document is its greatest marginal; words past ``SPAN`` are offending
spans, given as code points (end exclusive).

Defined results: null and empty texts and texts without words score 0; with no
toxic or no other training document every text scores 0; conflicting labels of
one doc_id count as toxic; null labels are ignored; repeated rows each give a
row; an empty table gives no rows; other columns are ignored unless kept.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import text as tx

#: Training documents per label at most (those of the least hash of doc_id), and others whose words are counted.
SAMPLE, COUNTED = 800, 3200
MIN_DOCUMENTS = 3
SPAN = 0.5
STEPS, RATE, CHUNK = 120, 0.3, 64
_WORD = re.compile(r"[^\W\d_]+")
_LIMIT = 30.0


@dataclass(frozen=True)
class Setting:
    """Chosen among several by a split inside the labelled rows that may be learned from (README)."""
    share: float = 0.015
    lift: float = 30.0
    penalty: float = 2e-5
    begin: int = 6


def _begin(word: str, n: int) -> str:
    """The beginning of a longer word, as a key that no word has."""
    return word[:n] + "*" if n and len(word) > n else ""


@dataclass
class Model:
    words: dict[str, int]    # known words and beginnings to their index, others 0
    weight: np.ndarray       # emission of state 1 by word
    start: float
    move: np.ndarray         # transitions, state 0 is (0, 0)
    begin: int = 0

    def index(self, word: str) -> int:
        return self.words.get(word) or self.words.get(_begin(word, self.begin), 0)


def _chain(e: np.ndarray, active: np.ndarray, start: float, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of state 1 from the left (the word itself included) and from the right; ``e`` is steps x texts.

    Texts are in falling order of length; ``active[t]`` of them have a step t.
    """
    m = np.exp(move)
    f, b = np.zeros_like(e), np.zeros_like(e)
    last = np.empty(0)
    for t in range(len(e)):
        n = active[t]
        if t == 0:
            f[0, :n] = e[0, :n] + start
        else:
            x = np.exp(np.clip(last[:n], -_LIMIT, _LIMIT))
            f[t, :n] = e[t, :n] + np.log((m[0, 1] + m[1, 1] * x) / (m[0, 0] + m[1, 0] * x))
        last = f[t, :n]
    for t in range(len(e) - 2, -1, -1):
        n = active[t + 1]
        x = np.exp(np.clip(e[t + 1, :n] + b[t + 1, :n], -_LIMIT, _LIMIT))
        b[t, :n] = np.log((m[1, 0] + m[1, 1] * x) / (m[0, 0] + m[0, 1] * x))
    return f, b


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -_LIMIT, _LIMIT)))


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Steps x texts matrix of rows in falling order of length, the texts active per step, and the order."""
    size = np.array([len(r) for r in rows])
    order = np.argsort(-size, kind="stable")
    out = np.zeros((size.max(initial=0), len(rows)), np.int64)
    for j, i in enumerate(order):
        out[:size[i], j] = rows[i]
    return out, np.searchsorted(-size[order], -np.arange(1, len(out) + 1), "right"), order


def _train(rows: list[np.ndarray], gold: list[np.ndarray], n_words: int, penalty: float):
    """Weights by Adam on the log likelihood of chunks of the token rows."""
    parts = [(r[i:i + CHUNK], g[i:i + CHUNK]) for r, g in zip(rows, gold) for i in range(0, len(r), CHUNK)]
    x, active, order = _pad([p[0] for p in parts])
    y, _, _ = _pad([p[1] for p in parts])
    inside = np.arange(x.shape[1])[None, :] < active[:, None]
    theta, m1, m2 = np.zeros(n_words + 5), 0.0, 0.0
    theta[n_words] = -3.0
    total = inside.sum()
    for step in range(1, STEPS + 1):
        w, start, move = theta[:n_words], theta[n_words], theta[n_words + 1:].reshape(2, 2)
        f, b = _chain(w[x], active, start, move)
        p = _sigmoid(f + b) * inside
        diff = (y - p) * inside
        grad = np.zeros_like(theta)
        grad[:n_words] = np.bincount(x.ravel(), diff.ravel(), n_words)
        grad[n_words] = diff[0].sum()
        # pair marginals: state s before t from the left, state u at t with all that follows
        left, right = _sigmoid(f[:-1]), _sigmoid((w[x] + b)[1:])
        joint = [[(left if s else 1 - left) * (right if u else 1 - right) * np.exp(move[s, u]) for u in (0, 1)]
                 for s in (0, 1)]
        norm = sum(joint[s][u] for s in (0, 1) for u in (0, 1))
        both = inside[1:]
        for s in (0, 1):
            for u in (0, 1):
                if (s, u) != (0, 0):
                    seen = (y[:-1] == s) & (y[1:] == u) & both
                    grad[n_words + 1 + 2 * s + u] = (seen - joint[s][u] / norm * both).sum()
        grad = grad / total * 100 - penalty * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad ** 2
        theta = theta + RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return theta[:n_words], float(theta[n_words]), theta[n_words + 1:].reshape(2, 2)


def _distinct(texts: list[str]) -> list[list[str]]:
    """Token lists of texts, without those that share most words with an earlier one."""
    out, seen = [], []
    for t in texts:
        tokens = _WORD.findall(t.lower())
        have = set(tokens)
        if have and not any(2 * len(have & s) > len(have | s) for s in seen):
            out.append(tokens)
            seen.append(have)
    return out


def train(toxic: list[str], clean: list[str], setting: Setting = Setting()) -> Model | None:
    bad, good = _distinct(toxic), [t for t in (_WORD.findall(x.lower()) for x in clean) if t]
    if not bad or not good:
        return None
    with_begins = lambda t: {x for w in set(t) for x in (w, _begin(w, setting.begin)) if x}
    df_bad = Counter(w for t in bad for w in with_begins(t))
    df_good = Counter(w for t in good for w in with_begins(t))
    marked = {w for w, n in df_bad.items() if n >= max(MIN_DOCUMENTS, setting.share * len(bad))
              and n / len(bad) >= setting.lift * (df_good[w] + 0.5) / len(good)}
    words = {w: i for i, w in enumerate(sorted(
        w for w, n in (df_bad + df_good).items() if w in marked or n >= 0.01 * (len(bad) + len(good))), 1)}
    known = Model(words, np.empty(0), 0.0, np.empty(0), setting.begin)
    good = good[:SAMPLE]
    rows = [np.array([known.index(w) for w in t]) for t in bad + good]
    gold = [np.array([int(w in marked or _begin(w, setting.begin) in marked) for w in t]) for t in bad] + [
        np.zeros(len(t), int) for t in good]
    return Model(words, *_train(rows, gold, len(words) + 1, setting.penalty), setting.begin)


def fit(labelled: DataFrame, documents: DataFrame, sample: int = SAMPLE, counted: int = COUNTED) -> Model | None:
    """Fit on ``labelled(doc_id, toxic)`` and the texts of ``documents``: at most ``sample`` toxic ids, and ``counted``
    others, the first SAMPLE of which are trained on."""
    rows = labelled.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
    ids = rows.withColumn("nth", F.row_number().over(order)).filter(
        F.col("nth") <= F.when(F.col("toxic") == 1, sample).otherwise(counted)).select("doc_id", "toxic", "nth")
    # repeated rows of an id give one text
    texts = (documents.filter("text is not null").select("doc_id", "text").join(F.broadcast(ids), "doc_id")
             .groupBy("toxic", "nth").agg(F.min("text").alias("text")).orderBy("toxic", "nth").collect())
    return train([r.text for r in texts if r.toxic == 1], [r.text for r in texts if r.toxic == 0])


def _ratio(a, b, x):
    """Log of (a[0] + b[0] X) / (a[1] + b[1] X), where X are the odds of ``x``."""
    x = np.exp(np.clip(x, -_LIMIT, _LIMIT))
    return np.log((a[0] + b[0] * x) / (a[1] + b[1] * x))


def posterior(rows: list[np.ndarray], m: Model) -> list[np.ndarray]:
    """Marginal of state 1 at each step of each row, by forward-backward in blocks.

    The steps of a block are a product of 2 x 2 matrices, taken for all blocks
    side by side; messages then pass from block to block of a row, and inside
    all blocks side by side. So a row of n steps takes n / CHUNK rounds.
    """
    size = np.array([len(r) for r in rows], np.int64)
    blocks = -(-size // CHUNK)
    base = np.concatenate([[0], np.cumsum(blocks)])
    n = int(base[-1])
    if not n:
        return [np.empty(0) for _ in rows]
    flat, at = np.concatenate(rows), np.concatenate([[0], np.cumsum(size)])
    where = np.arange(len(flat)) + np.repeat(base[:-1] * CHUNK - at[:-1], size)
    inside = np.zeros(n * CHUNK, bool)
    inside[where] = True
    e = np.zeros(n * CHUNK)
    e[where] = m.weight[flat]
    inside, e = np.ascontiguousarray(inside.reshape(n, CHUNK).T), np.ascontiguousarray(e.reshape(n, CHUNK).T)
    t = np.exp(m.move)
    odds = np.exp(np.clip(e, -_LIMIT, _LIMIT))
    # product of the steps' matrices [[t00, t10], [t01 E, t11 E]], scaled
    p = [np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)]
    for k in range(CHUNK):
        q = [t[0, 0] * p[0] + t[1, 0] * p[2], t[0, 0] * p[1] + t[1, 0] * p[3],
             odds[k] * (t[0, 1] * p[0] + t[1, 1] * p[2]), odds[k] * (t[0, 1] * p[1] + t[1, 1] * p[3])]
        scale = 1 / (q[0] + q[1] + q[2] + q[3])
        p = [np.where(inside[k], x * scale, y) for x, y in zip(q, p)]
    order = np.argsort(-blocks, kind="stable")
    active = np.searchsorted(-blocks[order], -np.arange(1, blocks.max() + 1), "right")
    first = np.zeros(n, bool)
    first[base[:-1][blocks > 0]] = True
    step = lambda x: _ratio((t[0, 1], t[0, 0]), (t[1, 1], t[1, 0]), x)

    def forward(which, entry):
        f = np.zeros((CHUNK, len(which)))
        x = entry
        for k in range(CHUNK):
            x = np.where(inside[k, which], e[k, which] + (step(x) if k else np.where(first[which], m.start, step(x))), x)
            f[k] = x
        return f

    entry, after = np.zeros(n), np.zeros(n)
    begin = base[:-1][order]
    last = forward(begin[:active[0]], np.zeros(active[0]))[-1]
    for k in range(1, len(active)):
        b = begin[:active[k]] + k
        entry[b] = last[:active[k]]
        last = _ratio((p[2][b], p[0][b]), (p[3][b], p[1][b]), entry[b])
    for k in range(len(active) - 1, 0, -1):
        b = begin[:active[k]] + k
        after[b - 1] = _ratio((p[1][b], p[0][b]), (p[3][b], p[2][b]), after[b])
    f = forward(np.arange(n), entry)
    back = np.zeros((CHUNK, n))
    x = after
    for k in range(CHUNK - 1, -1, -1):
        back[k] = x
        x = np.where(inside[k], _ratio((t[1, 0], t[0, 0]), (t[1, 1], t[0, 1]), e[k] + x), x)
    out = _sigmoid(f + back).T.ravel()[where]
    return [out[at[i]:at[i + 1]] for i in range(len(rows))]


def marginals(texts: list[str | None], m: Model) -> list[np.ndarray]:
    """Marginal of the toxic state for each word of each text."""
    return posterior([np.array([m.index(w) for w in _WORD.findall(t.lower())], np.int64) if t else np.empty(0, np.int64)
                      for t in texts], m)


def spans(text: str, p: np.ndarray) -> list[dict]:
    """Words past SPAN; offsets are those of the text if lower-casing keeps its length, else of the lowered text."""
    return [{"start": w.start(), "end": w.end(), "p": float(p[i])}
            for i, w in enumerate(_WORD.finditer(text.lower())) if p[i] > SPAN]


def score(docs: DataFrame, keep: list[str], model: Model | None) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``score`` and ``spans`` (start, end, p)."""
    keep = [c for c in keep if c not in ("score", "spans")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def run(batches):
        for step in tx.steps(batches, "_text"):
            texts = step.column("_text").to_pylist()
            p = marginals(texts, shared.value) if shared.value is not None else [np.empty(0)] * len(texts)
            top = [float(x.max(initial=0.0)) for x in p]
            found = [spans(t, x) if s > SPAN else [] for t, x, s in zip(texts, p, top)]
            yield pa.RecordBatch.from_arrays([*(step.column(c) for c in keep), pa.array(top, pa.float64()),
                                              pa.array(found, kind)], names=[*keep, "score", "spans"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.mapInArrow(run, f"{fields}, score double, spans array<struct<start:bigint,end:bigint,p:double>>")
