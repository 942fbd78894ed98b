"""Secret scan: Aho-Corasick keyword prefilter, anchored expressions at the hits, checksum validation.

One automaton finds every keyword of every kind in a pass over the text; the
expression of a kind is tried at its hits only. Runs of hexadecimal digits have
no keyword; they are found as byte runs of a whole batch at once. Tokens with an
embedded checksum (six base-62 digits of a CRC-32, prefixes gh?_ and npm_) and
web tokens (a base64 JSON header) count only if that part is valid. A private
key runs from its first marker to its last, or, if that is missing before the
next marker or the end of the text, over the base64 lines that follow.

Defined results: null and empty texts have no findings; offsets are code
points, end exclusive; within a kind, findings never overlap (leftmost first);
an empty table gives no rows; other columns are ignored unless kept.
"""

from __future__ import annotations

import base64
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import text as tx

#: Kinds in the order in which findings of equal start are listed; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm", "slack", "stripe", "google", "jwt", "private_key")
BASE = KINDS[:3]
#: After a private key's first marker: all up to its last marker, or header and base64 lines (line feeds may be escaped).
_GAP = r"(?:\s|\\[nr])+"
_KEY_BODY = (r"(?:(?s:(?:(?!-----BEGIN ).)*?)-----END (?:[A-Z]+ ){0,2}PRIVATE KEY-----"
             rf"|(?:{_GAP}[A-Z][A-Za-z]*-[A-Za-z]+:[^\n\\]*)*"
             rf"(?:(?:{_GAP}[A-Za-z0-9+/]{{20,}}={{0,2}})+(?:{_GAP}[A-Za-z0-9+/]{{1,19}}={{0,2}}(?=[\x20\t\r]*(?:\n|\\[nr]|[\"']|\Z)))?"
             rf"|{_GAP}[A-Za-z0-9+/]{{1,19}}={{0,2}}(?=\s*\Z))?)")
#: Keywords in lower case, and the expression that starts at the keyword.
RULES = {
    "assign": (("password", "passwd", "secret", "token", "apikey", "api_key"),
               re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII)),
    "access": (("akia",), re.compile(r"AKIA[A-Z0-9]+")),
    "github": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "npm": (("npm_",), re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")),
    "slack": (("xoxb-", "xoxp-", "xoxa-", "xoxr-", "xoxs-"), re.compile(r"xox[bpars]-[0-9A-Za-z-]{20,}")),
    "stripe": (("sk_live_", "rk_live_"), re.compile(r"[sr]k_live_[0-9A-Za-z]{24,}")),
    "google": (("aiza",), re.compile(r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])")),
    "jwt": (("eyj",), re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")),
    "private_key": (("-----begin ",), re.compile(r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----" + _KEY_BODY)),
}
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(body: str) -> str:
    """Six base-62 digits of the CRC-32 of ``body``."""
    x, out = zlib.crc32(body.encode()), ""
    while x:
        x, d = divmod(x, 62)
        out = _DIGITS[d] + out
    return out.rjust(6, "0")


def valid(kind: str, m: re.Match) -> bool:
    s = m.group()
    if kind == "assign":
        return len(m.group(2)) >= 8
    if kind == "access":
        return len(s) >= 16
    if kind in ("github", "npm"):
        return checksum(s[4:-6]) == s[-6:]
    if kind == "jwt":
        head = s.split(".", 1)[0]
        try:
            return "alg" in json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
        except (ValueError, TypeError):
            return False
    return True


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for kind, (words, _) in RULES.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


def scan_text(a: ahocorasick.Automaton, text: str) -> list[tuple[int, int, str]]:
    """Findings (start, end, kind) of one text, without the hex runs."""
    low = text.encode().lower().decode()  # A-Z only, so offsets stay
    free, out = dict.fromkeys(RULES, 0), []
    hits = sorted((end - size + 1, kind) for end, (kind, size) in a.iter(low))
    for start, kind in hits:
        if start >= free[kind] and (m := RULES[kind][1].match(text, start)):
            free[kind] = m.end()
            if valid(kind, m):
                out.append((start, m.end(), kind))
    return out


def _hex_runs(column: pa.Array) -> dict[int, list[tuple[int, int, str]]]:
    data, offsets = tx.utf8(column)
    starts, ends, rows = tx.spans(data, offsets, _HEX)
    take = ends - starts >= 32
    out: dict[int, list] = {}
    if take.any():
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
        for s, e, r in zip(starts[take], ends[take], rows[take]):
            base = chars[offsets[r]]
            out.setdefault(int(r), []).append((int(chars[s] - base), int(chars[e] - base), "hex"))
    return out


def find(column: pa.Array, a: ahocorasick.Automaton) -> list[list[tuple[int, int, str]]]:
    runs = _hex_runs(column)
    return [sorted(scan_text(a, t or "") + runs.get(i, []), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
            for i, t in enumerate(column.to_pylist())]


def redact(text: str | None, found: list) -> str | None:
    """The text with every finding replaced by its kind in brackets (overlapping ones as one)."""
    if not found or text is None:
        return text
    out, at, i = [], 0, 0
    while i < len(found):
        start, end, kind = found[i]
        while i < len(found) and found[i][0] < end:
            end = max(end, found[i][1])
            i += 1
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join(out) + text[at:]


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, the ``findings`` and the ``clean_text`` without them."""
    keep = [c for c in keep if c not in ("findings", "clean_text")]
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        a = automaton()
        for step in tx.steps(batches, "_text"):
            texts = step.column("_text")
            found = find(texts, a)
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in f] for f in found]
            clean = [redact(t, f) for t, f in zip(texts.to_pylist(), found)]
            yield pa.RecordBatch.from_arrays([*(step.column(c) for c in keep), pa.array(spans, kind),
                                              pa.array(clean, pa.string())], names=[*keep, "findings", "clean_text"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema.fields)
    return rows.mapInArrow(run, f"{fields}, findings array<struct<kind:string,start:bigint,end:bigint>>, "
                                "clean_text string")
