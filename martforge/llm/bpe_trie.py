"""Byte-level BPE encoding and decoding by traversing a trie of distinct words.

BPE has this property: a token sequence is the encoding of its bytes exactly if
each two neighbours stand side by side, that is, no merge across their border
comes before the merges that made them. So the encoding of a prefix ends in one
token that is fixed by the prefix, and what lies before that token is the
encoding of the shorter prefix.

The distinct words are put into a trie, whose nodes are found by the bytes that
lead to them: a word enters at its longest prefix that is there. Each new node
takes the last token of its prefix from its ancestors: of the tokens that end
there (found by a search automaton over the tokens, whose state a node keeps) the
longest that stands beside the last token of the node where it begins. A prefix
that many words share is so computed once. A word's ids are read along the
begins of its last tokens, back to the root.

A word of more than LONG bytes is a path of its own, held in flat arrays. The
trie starts anew past NODES nodes and the words kept with their ids past
CACHE_WORDS, so a task's memory is bounded; one text is read in runs of words.

Words are cut as the byte-level split of the file's library does it. Characters
that the two libraries class differently (their Unicode versions differ) are
found by asking the splitter about each new character; texts with such
characters are cut by the splitter itself.

Defined results: null and empty texts have no ids and decode to an empty text;
special strings of the file become their ids (unless ``special=False``);
repeated rows each give their own row; an empty table gives no rows; other
columns are ignored unless kept.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx

VOCABULARY_PATH = "/opt/tokenizers/byte_bpe_50k.json"
#: The byte-level split (fixed value of the public tokenizers).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same words of characters that Python's own expressions class alike, found faster.
FAST_PATTERN = r""" ?[^\W\d_]+|'(?:[stmd]|re|ve|ll)| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"""
#: Nodes of one trie, words kept with their ids, bytes of a word in the trie, words of one run.
NODES = 1 << 20
CACHE_WORDS = 1 << 18
LONG = 256
RUN = 1 << 17
#: Bytes that lead to a node, on average at most; bits of a node that hold its token.
NODE_BYTES = 16
TOKEN = (1 << 24) - 1
#: Characters of a text that is cut in one call.
ONE_CALL = 1 << 22


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others
    for the letters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabulary:
    """Tokens and merges of a byte-level BPE file (their number does not follow the data)."""
    pieces: list[bytes]                 # by id; special strings too
    merges: list[tuple[int, int, int]]  # by rank: left, right, made
    special: dict[str, int]

    @cached_property
    def coder(self) -> Coder:
        return Coder(self)


def load_vocabulary(path: str = VOCABULARY_PATH) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or spec["normalizer"] or split.get("type") != "ByteLevel" or not split.get("use_regex", True) \
            or split.get("add_prefix_space") or model.get("dropout") or model.get("ignore_merges"):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    letters, ids = byte_letters(), model["vocab"]
    special = {}
    for t in spec["added_tokens"]:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"special token with stripping: {t['content']!r}")
        special[t["content"]] = t["id"]
    pieces = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for s, i in ids.items():
        pieces[i] = bytes(letters[c] for c in s)
    for s, i in special.items():
        pieces[i] = s.encode()
    merges = []
    for m in model["merges"]:
        left, right = m.split(" ") if isinstance(m, str) else m
        merges.append((ids[left], ids[right], ids[left + right]))
    return Vocabulary(pieces, merges, special)


class Coder:
    """Encoder of words and texts; one per Python worker."""

    def __init__(self, v: Vocabulary):
        n = self.size = len(v.pieces)
        self.pieces = v.pieces
        self.rank, self.left, self.right = [-1] * n, [-1] * n, [-1] * n
        self.merge: dict[int, int] = {}
        self.byte_id = [-1] * 256
        specials = set(v.special.values())
        for i, p in enumerate(v.pieces):
            if len(p) == 1 and i not in specials:
                self.byte_id[p[0]] = i
        if min(self.byte_id) < 0:
            raise ValueError("the vocabulary lacks single bytes")
        sound = set(self.byte_id)
        usable = set(self.byte_id)
        for r, (a, b, made) in enumerate(v.merges):
            # the border rule asks that parts come before what is made of them, in one way only
            if a not in sound or b not in sound or made in sound:
                raise ValueError(f"merge {r} is out of order or makes a token a second time")
            sound.add(made)
            self.merge[a * n + b] = r
            self.rank[made], self.left[made], self.right[made] = r, a, b
        for r, (a, b, made) in enumerate(v.merges):
            if a in usable and b in usable and self.stands(a, b, r):
                usable.add(made)  # the others are never an encoding's token
        self._automaton(sorted(usable))
        self.beside: dict[int, bool] = {}
        self.words: dict[str, bytes] = {}
        self.special = v.special
        self.cut_special = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(v.special, key=len, reverse=True)) + ")") if v.special else None
        import regex
        from tokenizers import pre_tokenizers
        self.cut, self.fast_cut = regex.compile(PATTERN), re.compile(FAST_PATTERN)
        self.splitter = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.known, self.odd, self.slow = set(), set(), set()
        self._class_new(set(map(chr, range(128))))
        self._fresh()

    def _fresh(self) -> None:
        # a node by the bytes that lead to it: its state, the begin of its last token and that token
        self.up: dict[bytes, int] = {b"": 0}
        self.held = 0

    def _automaton(self, usable: list[int]) -> None:
        """States of the search for the tokens that end at a byte: the beginnings of tokens."""
        pieces = self.pieces
        self.spelled = sorted({pieces[i][:k] for i in usable for k in range(len(pieces[i]) + 1)})
        self.state = {s: i for i, s in enumerate(self.spelled)}  # the root is 0
        of = {pieces[i]: i for i in usable}
        longest = lambda s, k: next((of[s[j:]] for j in range(k, len(s)) if s[j:] in of), -1)
        #: the longest token that ends a state, and the next shorter one that ends a token
        self.tail = array("i", [longest(s, 0) for s in self.spelled])
        self.shorter = array("i", [-1]) * self.size
        for s, i in of.items():
            self.shorter[i] = longest(s, 1)
        self.length = [len(p) for p in pieces]
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        self.goto: dict[int, int] = {}

    def _next(self, state: int, byte: int) -> int:
        """The longest beginning of a token that ends after ``byte``."""
        s = self.spelled[state] + bytes((byte,))
        while s not in self.state:
            s = s[1:]
        if len(self.goto) >= NODES:
            self.goto.clear()
        to = self.goto[state << 8 | byte] = self.state[s]
        return to

    def stands(self, a: int, b: int, limit: int = 1 << 60) -> bool:
        """Whether no merge across the border a | b comes before those that made a and b (or before ``limit``)."""
        rank, merge, n = self.rank, self.merge, self.size
        while True:
            m = merge.get(a * n + b)
            if m is not None and m < limit:
                return False
            if rank[a] > rank[b]:  # undo the later one; of equal merges the left one comes first
                limit, a = rank[a], self.right[a]
            elif rank[b] >= 0:
                limit, b = rank[b] + 1, self.left[b]
            else:
                return True

    def _beside(self, a: int, b: int) -> bool:
        if len(self.beside) >= NODES:
            self.beside.clear()
        ok = self.beside[a * self.size + b] = self.stands(a, b)
        return ok

    def _long(self, word: bytes) -> bytes:
        tail, shorter, length, beside, goto, n = self.tail, self.shorter, self.length, self.beside, self.goto, self.size
        token, begin, state = array("i", [0]), array("i", [0]), 0
        for k, byte in enumerate(word, 1):
            to = goto.get(state << 8 | byte)
            state = self._next(state, byte) if to is None else to
            t = tail[state]
            at = k - length[t]
            while at:
                ok = beside.get(token[at] * n + t)
                if ok or ok is None and self._beside(token[at], t) or shorter[t] < 0:
                    break
                t = shorter[t]
                at = k - length[t]
            token.append(t)
            begin.append(at)
        ids, k = [], len(word)
        while k:
            ids.append(token[k])
            k = begin[k]
        return np.array(ids[::-1], "<u4").tobytes()

    def learn(self, words: list[str]) -> None:
        """Keep the ids (little-endian unsigned 32-bit) of sorted distinct words."""
        tail, shorter, length, beside, goto, n = self.tail, self.shorter, self.length, self.beside, self.goto, self.size
        packed, up, kept = self.packed, self.up, self.words
        for word in words:
            data = word.encode()
            end = len(data)
            if end > LONG:
                kept[word] = self._long(data)
                continue
            if len(up) > NODES or self.held > NODE_BYTES * NODES:
                self._fresh()
                up = self.up
            k = end
            while (node := up.get(data[:k])) is None:
                k -= 1
            self.held += (end * (end + 1) - k * (k + 1)) // 2
            state = node >> 40
            while k < end:
                byte = data[k]
                k += 1
                to = goto.get(state << 8 | byte)
                state = self._next(state, byte) if to is None else to
                # of the tokens that end here the longest that stands beside the last one of the node where it begins
                t = tail[state]
                at = k - length[t]
                while at:
                    before = up[data[:at]] & TOKEN
                    ok = beside.get(before * n + t)
                    if ok or ok is None and self._beside(before, t) or shorter[t] < 0:
                        break
                    t = shorter[t]
                    at = k - length[t]
                node = up[data[:k]] = (state << 16 | at) << 24 | t
            ids = b""
            while end:
                ids = packed[node & TOKEN] + ids
                end = node >> 24 & 0xFFFF
                node = up[data[:end]]
            kept[word] = ids

    def _class_new(self, chars: set[str]) -> None:
        for c in chars:
            probe = f"a{c}1{c}.{c} {c}{c}b"
            words = [probe[s:e] for _, (s, e) in self.splitter.pre_tokenize_str(probe)]
            if not c.isascii() and self.cut.findall(probe) != words:
                self.odd.add(c)
            if self.fast_cut.findall(probe) != self.cut.findall(probe):
                self.slow.add(c)
        self.known |= chars

    def runs(self, text: str) -> Iterator[list[str]]:
        """The words of a text, in runs."""
        chars = set(text)
        if not chars <= self.known:
            self._class_new(chars - self.known)
        if not self.odd.isdisjoint(chars):
            yield [text[s:e] for _, (s, e) in self.splitter.pre_tokenize_str(text)]
            return
        cut = self.fast_cut if self.slow.isdisjoint(chars) else self.cut
        if len(text) <= ONE_CALL:
            yield cut.findall(text)
            return
        found = (m.group() for m in cut.finditer(text))
        while run := list(islice(found, RUN)):
            yield run

    def _learn_new(self, new: set[str], needed) -> None:
        """Learn the words ``new``; if the kept ones are too many, only those of ``needed`` stay."""
        if new and len(self.words) + len(new) > CACHE_WORDS:
            stay = {w: self.words[w] for w in needed() - new}
            self.words.clear()
            self.words.update(stay)
        self.learn(sorted(new))

    def _run_ids(self, run: list[str]) -> bytes:
        words = self.words
        self._learn_new({w for w in run if w not in words}, lambda: set(run))
        return b"".join(map(words.__getitem__, run))

    def _parts(self, text: str, special: bool) -> list[str]:
        """The text cut at special strings (at odd places)."""
        if special and self.special and any(s in text for s in self.special):
            return self.cut_special.split(text)
        return [text]

    def encode_step(self, texts: list[str | None], special: bool = True) -> list[bytes]:
        """The ids of several texts, packed as little-endian unsigned 32-bit integers.

        Texts of one call are cut once and their distinct words enter the trie together.
        """
        cut = []
        for t in texts:
            if not t or len(t) > ONE_CALL:
                cut.append(None)
                continue
            cut.append([[p] if k % 2 else [w for run in self.runs(p) for w in run]
                        for k, p in enumerate(self._parts(t, special))])
        every = lambda: set().union(*(words for parts in cut if parts for words in parts[::2]))
        self._learn_new({w for w in every() if w not in self.words}, every)
        out = []
        for t, parts in zip(texts, cut):
            if parts is None:
                out.append(b"".join(self._special_ids(p) if k % 2 else b"".join(map(self._run_ids, self.runs(p)))
                                    for k, p in enumerate(self._parts(t, special))) if t else b"")
                if t:  # the words of the step may be gone
                    self._learn_new({w for w in every() if w not in self.words}, every)
            else:
                out.append(b"".join(self._special_ids(words[0]) if k % 2 else b"".join(map(self.words.__getitem__, words))
                                    for k, words in enumerate(parts)))
        return out

    def _special_ids(self, s: str) -> bytes:
        return self.special[s].to_bytes(4, "little")

    def encode(self, text: str | None, special: bool = True) -> bytes:
        return self.encode_step([text], special)[0]

    def decode(self, packed: bytes | None) -> str:
        ids = np.frombuffer(packed or b"", "<u4").tolist()
        return b"".join(map(self.pieces.__getitem__, ids)).decode("utf-8", "replace")


def _fields(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)


def encode(docs: DataFrame, keep: list[str], path: str = VOCABULARY_PATH, special: bool = True) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ids (packed, little-endian unsigned 32-bit) and n_tokens."""
    keep = [c for c in keep if c not in ("ids", "n_tokens")]
    vocabulary = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    rows = docs.select(*keep, F.col("text").cast("string").alias("_bpe_text"))

    def run(batches):
        coder = vocabulary.value.coder
        for step in tx.steps(batches, "_bpe_text"):
            ids = coder.encode_step(step.column("_bpe_text").to_pylist(), special)
            yield pa.RecordBatch.from_arrays(
                [*(step.column(c) for c in keep), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                names=[*keep, "ids", "n_tokens"])
    return rows.mapInArrow(run, _fields(rows.select(*keep)) + "ids binary, n_tokens long")


def decode(coded: DataFrame, keep: list[str], path: str = VOCABULARY_PATH) -> DataFrame:
    """The columns ``keep`` of ``coded`` with the decoded text of its packed ids (special strings included)."""
    keep = [c for c in keep if c != "decoded"]
    vocabulary = coded.sparkSession.sparkContext.broadcast(load_vocabulary(path))
    rows = coded.select(*keep, F.col("ids").alias("_bpe_ids"))

    def run(batches):
        coder = vocabulary.value.coder
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                text = [coder.decode(x) for x in part.column("_bpe_ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(text, pa.string())],
                                                 names=[*keep, "decoded"])
    return rows.mapInArrow(run, _fields(rows.select(*keep)) + "decoded string")
