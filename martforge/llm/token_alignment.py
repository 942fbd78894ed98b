"""Alignment of two tokenizers' tokens by coalescing their byte intervals.

Each text is encoded by a byte-level BPE (A, with a space before it) and by a
SentencePiece model (B, which adds that space). The tokens of both are byte
intervals of the same bytes. Sorted by start, with the running maximum of the
ends, a new group begins where a start reaches that maximum: there both sides
have a token end. Inside the groups the overlapping pairs are expanded by binary
search; those that also end together are the links.

Two tokens that end together are one the end of the other's bytes. So the two
vocabularies bound the id pairs that can ever be linked (some 10^5, whatever the
corpus): their counts are added up per task in one array, summed by Spark, and
sent back to every worker. The first pass writes each document's digest and the
numbers of its links' pairs; the second reads those only.

Defined results: null and empty texts, and texts whose tokens of either side do
not spell a space and the text (characters that a model changes), have no tokens;
special strings are plain text; repeated rows each give their own row and count
each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import bpe_trie, text as tx
from .graph import materialize
from .sentencepiece import MODEL_PATH, SPACE

_EMPTY = np.empty(0, np.int64)


def coalesce(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by start of intervals, and the group of each in that order; groups do not overlap."""
    order = np.lexsort((ends, starts))
    first = starts[order]
    reached = np.maximum.accumulate(ends[order])
    return order, np.cumsum(np.append(False, first[1:] >= reached[:-1]))


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of overlapping tokens, A's and B's each in order of their places."""
    low = np.searchsorted(b_end, a_start, "right")
    n = np.searchsorted(b_start, a_end, "left") - low
    a = np.repeat(np.arange(len(a_start)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + low[a]


def linkable(a_pieces: list[bytes], b_pieces: list[bytes]) -> np.ndarray:
    """Sorted a * len(b_pieces) + b of all ids of which one's bytes end the other's."""
    def by_bytes(pieces):
        out: dict[bytes, list[int]] = {}
        for i, p in enumerate(pieces):
            out.setdefault(p, []).append(i)
        return out
    of_a, of_b, n, found = by_bytes(a_pieces), by_bytes(b_pieces), len(b_pieces), []
    for i, p in enumerate(a_pieces):
        for k in range(len(p)):
            found.extend(i * n + j for j in of_b.get(p[k:], ()))
    for j, p in enumerate(b_pieces):
        for k in range(1, len(p)):
            found.extend(i * n + j for i in of_a.get(p[k:], ()))
    return np.array(sorted(found), np.int64)


@dataclass
class Side:
    """Token bytes by id, one after another."""
    pieces: list[bytes]

    @cached_property
    def size(self) -> np.ndarray:
        return np.array([len(p) for p in self.pieces], np.int64)

    @cached_property
    def data(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.pieces), np.uint8)

    @cached_property
    def at(self) -> np.ndarray:
        return np.cumsum(self.size) - self.size

    @cached_property
    def number(self) -> np.ndarray:
        """Decimal ids, each followed by the two marks that may follow it."""
        return np.array([[f"{i}{m}" for i in range(len(self.pieces))] for m in ",|;"], object)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        total = np.cumsum(size)
        return self.data[np.arange(total[-1] if len(ids) else 0) - np.repeat(total - size - self.at[ids], size)]


@dataclass
class Models:
    a_vocabulary: bpe_trie.Vocabulary
    b_file: bytes
    b_pieces: list[bytes]
    pairs: np.ndarray

    @cached_property
    def slots(self) -> np.ndarray:
        """Number of the pair in each slot (-1: none): a pair stands in the first free one from its own on."""
        bits = max(4, (8 * len(self.pairs)).bit_length())
        out = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(self.pairs), dtype=np.int32), self._slot(self.pairs, bits)
        while len(left):
            free = out[at] < 0
            out[at[free]] = left[free]
            lost = out[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(out) - 1)
        return out

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)

    def pair_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number in ``pairs`` of each pair of linked ids."""
        keys = a * len(self.b_pieces) + b
        at = self._slot(keys, len(self.slots).bit_length() - 1)
        pair = self.slots[at]
        left = np.flatnonzero(self.pairs[pair] != keys)
        while len(left):
            at[left] = (at[left] + 1) & (len(self.slots) - 1)
            pair[left] = self.slots[at[left]]
            if (pair[left] < 0).any():
                raise ValueError("linked ids of which none ends the other")
            left = left[self.pairs[pair[left]] != keys[left]]
        return pair

    @cached_property
    def a(self) -> Side:
        return Side(self.a_vocabulary.pieces)

    @cached_property
    def b(self) -> Side:
        return Side(self.b_pieces)

    @cached_property
    def b_coder(self):
        from sentencepiece import SentencePieceProcessor
        return SentencePieceProcessor(model_proto=self.b_file)


def load_models(a_path: str = bpe_trie.VOCABULARY_PATH, b_path: str = MODEL_PATH) -> Models:
    """Both tokenizers' files (their sizes do not follow the data)."""
    from sentencepiece import SentencePieceProcessor
    with open(b_path, "rb") as f:
        b_file = f.read()
    sp = SentencePieceProcessor(model_proto=b_file)
    pieces = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
              sp.id_to_piece(i).replace(SPACE, " ").encode() for i in range(sp.get_piece_size())]
    a = bpe_trie.load_vocabulary(a_path)
    return Models(a, b_file, pieces, linkable(a.pieces, pieces))


@dataclass
class Aligned:
    """Tokens of several texts; places are bytes of all texts one after another, each with a space before it."""
    a: np.ndarray          # ids
    b: np.ndarray
    a_text: np.ndarray     # text of each token
    b_text: np.ndarray
    a_end: np.ndarray
    b_end: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    left: np.ndarray       # overlapping pairs: index of the A token, of the B token
    right: np.ndarray

    @property
    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The overlapping pairs that end together."""
        together = self.a_end[self.left] == self.b_end[self.right]
        return self.left[together], self.right[together]


def align(m: Models, texts: list[str | None]) -> Aligned:
    """Encode and align whole texts."""
    spaced = [" " + t if t else None for t in texts]
    a_ids = [np.frombuffer(x, "<u4").astype(np.int64) for x in m.a_vocabulary.coder.encode_step(spaced, special=False)]
    b_ids = m.b_coder.encode([t or "" for t in texts], out_type=int, num_threads=1)
    sizes = np.zeros(len(texts), np.int64)
    for i, t in enumerate(spaced):
        b_ids[i] = np.array(b_ids[i] if t else [], np.int64)
        if t:
            data = np.frombuffer(t.encode(), np.uint8)
            if np.array_equal(m.a.spell(a_ids[i]), data) and np.array_equal(m.b.spell(b_ids[i]), data):
                sizes[i] = len(data)
                continue
        a_ids[i] = b_ids[i] = _EMPTY
    a, b = np.concatenate([_EMPTY, *a_ids]), np.concatenate([_EMPTY, *b_ids])
    a_size, b_size = m.a.size[a], m.b.size[b]
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    order, group = coalesce(np.concatenate([a_end - a_size, b_end - b_size]), np.concatenate([a_end, b_end]))
    of = np.empty(len(order), np.int64)
    of[order] = group
    left, right = overlaps(a_end - a_size, a_end, b_end - b_size, b_end)
    row = np.arange(len(texts))
    return Aligned(a, b, np.repeat(row, [len(x) for x in a_ids]), np.repeat(row, [len(x) for x in b_ids]), a_end, b_end,
                   of[:len(a)], of[len(a):], left, right)


def _written(m: Models, x: Aligned, n: int) -> list[str]:
    """Per text its groups as `a1,a2|b1;a3|b2,b3`."""
    def marks(group, end):
        return np.where(np.append(group[1:] != group[:-1], True), end, 0) if len(group) else _EMPTY
    out = np.concatenate([m.a.number[marks(x.a_group, 1), x.a], m.b.number[marks(x.b_group, 2), x.b]])
    # a group's A tokens come before its B tokens, each in their order
    order = np.lexsort((np.arange(len(out)), np.concatenate([x.a_group, x.b_group])))
    out = out[order].tolist()
    cut = np.searchsorted(np.concatenate([x.a_text, x.b_text])[order], np.arange(n + 1))
    return ["".join(out[cut[i]:cut[i + 1]])[:-1] for i in range(n)]


def _first_pass(models):
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                        ("groups_sha256", pa.string()), ("links", pa.binary()), ("pair", pa.int32()), ("count", pa.int64())])

    def run(batches):
        m = models.value
        total = np.zeros(len(m.pairs), np.int64)
        for step in tx.steps(batches, "text"):
            x, n = align(m, step.column("text").to_pylist()), step.num_rows
            left, right = x.links
            pair = m.pair_of(x.a[left], x.b[right])
            total += np.bincount(pair, minlength=len(total))
            rows = np.arange(n + 1)
            link_cut = np.searchsorted(x.a_text[left], rows)
            a_cut, b_cut = np.searchsorted(x.a_text, rows), np.searchsorted(x.b_text, rows)
            last = np.append(x.a_group[1:] != x.a_group[:-1], True) if len(x.a) else np.empty(0, bool)
            groups = np.append(0, np.cumsum(last))[a_cut]
            yield pa.RecordBatch.from_arrays([
                step.column("doc_id"), pa.array(np.diff(a_cut)), pa.array(np.diff(b_cut)), pa.array(np.diff(groups)),
                pa.array(np.diff(link_cut)),
                pa.array([sha256(w.encode()).hexdigest() if w else "" for w in _written(m, x, n)], pa.string()),
                pa.array([pair[link_cut[i]:link_cut[i + 1]].astype("<i4").tobytes() for i in range(n)], pa.binary()),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], schema=schema)
        some = np.flatnonzero(total)
        n = len(some)
        yield pa.RecordBatch.from_arrays([
            *(pa.nulls(n, t) for t in schema.types[:7]), pa.array(some, pa.int32()), pa.array(total[some])], schema=schema)
    return run


def align_corpus(docs: DataFrame, a_path: str = bpe_trie.VOCABULARY_PATH, b_path: str = MODEL_PATH
                 ) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text, ...)`` to its digests and its linked id pairs.

    * per row: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is
      their B id's highest), count_sum (of the links' counts), groups_sha256;
    * pairs: a_id, b_id, count (corpus-wide), best.
    """
    spark = docs.sparkSession
    loaded = load_models(a_path, b_path)
    models = spark.sparkContext.broadcast(loaded)
    passed = materialize(spark, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _first_pass(models), "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                             "links binary, pair int, count long"), "alignment")
    # at most as many rows as linkable pairs
    found = passed.filter("pair is not null").groupBy("pair").agg(F.sum("count").alias("n")).toPandas()
    pair, n = found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    counts, highest = np.zeros(len(loaded.pairs), np.int64), np.zeros(len(loaded.b_pieces), np.int64)
    b_of = loaded.pairs % len(loaded.b_pieces)
    counts[pair] = n
    np.maximum.at(highest, b_of, counts)
    best = counts == highest[b_of]
    table = spark.sparkContext.broadcast((counts, best))

    def second_pass(batches):
        counts, best = table.value
        for batch in batches:
            links = [np.frombuffer(x, "<i4") for x in batch.column("links").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([int(best[x].sum()) for x in links], pa.int64()),
                 pa.array([int(counts[x].sum()) for x in links], pa.int64())],
                names=[*batch.schema.names[:-1], "n_best", "count_sum"])
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    digests = passed.filter("pair is null").select(*kept, "links").mapInArrow(
        second_pass, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                     "n_best long, count_sum long")
    pairs = spark.createDataFrame(pa.table({
        "a_id": loaded.pairs[pair] // len(loaded.b_pieces), "b_id": b_of[pair], "count": n, "best": best[pair]}).to_pandas(),
        "a_id long, b_id long, count long, best boolean")
    return digests, pairs
