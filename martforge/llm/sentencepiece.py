"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

The best segmentation maximises the sum of piece scores. A text is cut into
words before every run of spaces (no piece goes on past one, which loading
checks), so words are searched alone: words of one length advance together,
the hashes of all their substrings probe the sorted piece hashes, and one
maximum per position over all start positions stores the backpointers. Ties go
to the earliest start. A character without a piece costs the least score less
10 and becomes its UTF-8 bytes.

Defined results: null gives null ids and a null text; an empty text gives no
ids; a text that has U+2581 itself decodes with a space there (as the format
defines); an empty table gives no rows; other columns are ignored unless kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import text as tx

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Finer cuts, for models in which no piece has a line feed or goes on from a Latin letter or digit to a mark.
_MARK = ".,;:!?#$%&*"
_LATIN = "A-Za-z0-9\u00C0-\u024F"
_FINE = re.compile(rf"\n|{SPACE}*(?:[{_LATIN}]+(?=[{_MARK}\n{SPACE}]|\Z)|[^{SPACE}\n]+)|{SPACE}+")
_P = np.uint64(0x9E3779B97F4A7C15)
#: Words kept with their ids in one task, and cells of one search matrix.
CACHE_WORDS = 1 << 17
CELLS = 1 << 18


@dataclass
class Model:
    keys: list[np.ndarray]      # by length: sorted hashes
    slots: list[np.ndarray]     # by length: which of 2^18 slots have a hash
    ids: list[np.ndarray]
    scores: list[np.ndarray]
    byte_ids: np.ndarray        # id of each byte, -1 where the model has none
    unknown: int
    unknown_score: float
    pieces: list[bytes]         # by id
    word: re.Pattern            # the words of a text, past which no piece goes on


def _hash(s: str) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for c in s:
        h = h * _P + np.uint64(ord(c) + 1)
    return h[0]


def _slot(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(46)).astype(np.int32)


def load_model(path: str = MODEL_PATH) -> Model:
    """The pieces of a model file (its size does not follow the data)."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    by: dict[int, list] = {}
    word = _FINE
    pieces, byte_ids, least = [], np.full(256, -1, np.int32), 0.0
    for i in range(sp.get_piece_size()):
        s = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(s[3:5], 16)] = i
            pieces.append(bytes([int(s[3:5], 16)]))
            continue
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            pieces.append(" ⁇ ".encode() if sp.is_unknown(i) else b"")
            continue
        if re.search(f"[^{SPACE}]{SPACE}", s):
            raise ValueError(f"piece {i} goes on past a space: {s!r}")
        if "\n" in s or re.search(f"[{_LATIN}][{_MARK}]", s):
            word = _WORD
        pieces.append(s.replace(SPACE, " ").encode())
        least = min(least, sp.get_score(i))
        by.setdefault(len(s), []).append((_hash(s), i, sp.get_score(i)))
    keys, slots, ids, scores = [], [], [], []
    for k in range(1, max(by) + 1):
        rows = sorted(by.get(k, []))
        keys.append(np.array([r[0] for r in rows], np.uint64))
        ids.append(np.array([r[1] for r in rows], np.int32))
        scores.append(np.array([r[2] for r in rows], np.float64))
        slots.append(np.zeros(1 << 18, bool))
        slots[-1][_slot(keys[-1])] = True
        if len(np.unique(keys[-1])) < len(rows):
            raise ValueError("two pieces share a hash")
    return Model(keys, slots, ids, scores, byte_ids, sp.unk_id(), least - 10, pieces, word)


def _search(m: Model, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best pieces of words of one length (a matrix of code points): row, start and id (-1: no piece)."""
    n, length = chars.shape
    most = min(len(m.keys), length)
    # by start position (most - k for a piece of k characters), end, word
    score = np.full((most, length + 1, n), -np.inf)
    ident = np.full((most, length + 1, n), -1, np.int32)
    code = np.ascontiguousarray(chars.T).astype(np.uint64) + np.uint64(1)
    h = np.zeros((length + 1, n), np.uint64)
    for k in range(1, most + 1):
        h = h[:-1] * _P + code[k - 1:]
        keys = m.keys[k - 1]
        maybe = np.flatnonzero(m.slots[k - 1][_slot(h)].ravel())
        if len(maybe):
            probe = h.ravel()[maybe]
            at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
            hit = keys[at] == probe
            score[most - k, k:].reshape(-1)[maybe[hit]] = m.scores[k - 1][at[hit]]
            ident[most - k, k:].reshape(-1)[maybe[hit]] = m.ids[k - 1][at[hit]]
    single = score[most - 1, 1:]
    single[np.isneginf(single)] = m.unknown_score
    best = np.full((most + length + 1, n), -np.inf)
    best[most] = 0
    back = np.zeros((length + 1, n), np.int32)  # length of the piece that ends here
    rows = np.arange(n)
    for end in range(1, length + 1):
        sums = score[:, end] + best[end:end + most]
        first = sums.argmax(0)
        best[most + end] = sums[first, rows]
        back[end] = most - first
    begins, chosen = np.zeros((n, length), bool), np.zeros((n, length), np.int32)
    end = np.full(n, length)
    while len(rows):
        k = back[end, rows]
        begins[rows, end - k] = True
        chosen[rows, end - k] = ident[most - k, end, rows]
        end = end - k
        rows, end = rows[end > 0], end[end > 0]
    row, start = np.nonzero(begins)
    return row, start, chosen[row, start]


def encode_words(m: Model, words: list[str]) -> dict[str, bytes]:
    """The ids (little-endian int32) of distinct words."""
    out, by = {}, {}
    for w in words:
        by.setdefault(len(w), []).append(w)
    for length, group in by.items():
        size = max(1, CELLS // (length + 1) // len(m.keys))
        for i in range(0, len(group), size):
            part = group[i:i + size]
            chars = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).reshape(len(part), length)
            row, start, ids = _search(m, chars)
            if (ids < 0).any():
                spell = [[int(x)] if x >= 0 else
                         [int(b) if b >= 0 else m.unknown for b in m.byte_ids[list(chr(chars[r, s]).encode())]]
                         for r, s, x in zip(row, start, ids)]
                row = np.repeat(row, [len(x) for x in spell])
                ids = np.array([y for x in spell for y in x], np.int32)
            cut = np.searchsorted(row, np.arange(len(part) + 1))
            for j, w in enumerate(part):
                out[w] = ids[cut[j]:cut[j + 1]].astype("<i4").tobytes()
    return out


def encode_texts(m: Model, texts: list[str | None], cache: dict[str, bytes]) -> list[np.ndarray | None]:
    cut = [None if t is None else m.word.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    new = {w for words in cut if words for w in words} - cache.keys()
    if len(cache) + len(new) > CACHE_WORDS:
        new = {w for words in cut if words for w in words}
        cache.clear()
    cache.update(encode_words(m, list(new)))
    return [None if w is None else np.frombuffer(b"".join(map(cache.__getitem__, w)), "<i4") for w in cut]


def decode_ids(m: Model, ids) -> str:
    out = b"".join(map(m.pieces.__getitem__, ids)).decode("utf-8", "replace")
    return out[1:] if out.startswith(" ") else out


def _arrays(column: list[np.ndarray | None]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in column])]).astype(np.int32)
    values = np.concatenate([x for x in column if x is not None] or [np.empty(0, np.int32)]).astype(np.int32)
    mask = pa.array([x is None for x in column], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=mask)


def encode(docs: DataFrame, keep: list[str], model_path: str = MODEL_PATH) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``ids``, the piece ids of the whole text."""
    model = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    keep = [c for c in keep if c != "ids"]
    kept = "text" in keep and docs.schema["text"].dataType == StringType()
    source = "text" if kept else "_text"
    rows = docs.select(*keep, *([] if kept else [F.col("text").cast("string").alias("_text")]))

    def run(batches):
        cache: dict[str, bytes] = {}
        for step in tx.steps(batches, source):
            ids = encode_texts(model.value, step.column(source).to_pylist(), cache)
            yield pa.RecordBatch.from_arrays([*(step.column(c) for c in keep), _arrays(ids)], names=[*keep, "ids"])
    return rows.mapInArrow(run, StructType([*rows.select(*keep).schema.fields,
                                            StructField("ids", ArrayType(IntegerType()))]))


def decode(rows: DataFrame, keep: list[str], model_path: str = MODEL_PATH) -> DataFrame:
    """The columns ``keep`` of ``rows`` with ``decoded``, the text of the ``ids``."""
    model = rows.sparkSession.sparkContext.broadcast(load_model(model_path))
    keep = [c for c in keep if c != "decoded"]
    rows = rows.select(*dict.fromkeys([*keep, "ids"]))

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                column = part.column("ids")
                offsets = column.offsets.to_numpy()
                # of this slice only: ``values`` are those of the whole batch
                flat = column.values[offsets[0]:offsets[-1]].to_numpy(zero_copy_only=False).tolist()
                offsets = offsets - offsets[0]
                null = column.is_null().to_pylist()
                texts = [None if x else decode_ids(model.value, flat[offsets[j]:offsets[j + 1]])
                         for j, x in enumerate(null)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string())],
                                                 names=[*keep, "decoded"])
    return rows.mapInArrow(run, StructType([*rows.select(*keep).schema.fields, StructField("decoded", StringType())]))
