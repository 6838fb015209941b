"""Secret scan: Aho-Corasick keyword prefilter, regular expressions anchored at its hits, embedded checksums.

One pass of the automaton over the lower-cased text gives the places where a keyword starts. The expression of a keyword
is only tried there, so scanning from hit to hit equals a leftmost, non-overlapping search of the whole text. Runs of
hexadecimal digits have no keyword; they are searched directly.
"""
from __future__ import annotations

import base64
import binascii
import json
import re
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, workers_ready

# Kinds in the order in which spans of one start are listed, with the keywords that lead to them.
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "api_key", "apikey"],
    "access": ["akia"],
    "hex": [],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
    "slack": ["xoxb-", "xoxa-", "xoxp-", "xoxr-", "xoxs-"],
    "stripe": ["sk_live_", "rk_live_"],
    "pem": ["-----begin"],
    "jwt": ["eyj"],
}
PATTERNS = {
    "assign": re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "hex": re.compile(rb"[0-9a-f]{32,}"),
    "github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "npm": re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
    "slack": re.compile(rb"xox[baprs]-[0-9]{10,13}-[A-Za-z0-9-]{10,}"),
    "stripe": re.compile(rb"[sr]k_live_[A-Za-z0-9]{24,}"),
    "pem": re.compile(rb"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    "jwt": re.compile(rb"(eyJ[A-Za-z0-9_-]+)\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
}
#: What an expression reads on to an open end and may then fail on: any other hit in the same run fails as well.
RUNS = {"jwt": re.compile(rb"[A-Za-z0-9_-]+")}
KINDS = list(KEYWORDS)
BASE = KINDS[:3]
_DIGITS = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def base62(n: int, width: int = 6) -> bytes:
    out = bytearray()
    for _ in range(width):
        n, d = divmod(n, 62)
        out.append(_DIGITS[d])
    return bytes(out[::-1])


def _valid(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[2]) >= 8
    if kind == "access":
        return len(m[0]) >= 16
    if kind in ("github", "npm"):  # the last six characters are the checksum of the thirty before
        return base62(zlib.crc32(m[1])) == m[2]
    if kind == "jwt":
        try:
            head = json.loads(base64.urlsafe_b64decode(m[1] + b"=" * (-len(m[1]) % 4)))
        except (ValueError, binascii.Error, RecursionError):
            return False
        return isinstance(head, dict) and "alg" in head
    return True


def automaton() -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for w in words:
            auto.add_word(w, (kind, len(w)))
    auto.make_automaton()
    return auto


def scan(text: bytes, auto: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) in bytes, sorted."""
    found = [(m.start(), 2, m.end()) for m in PATTERNS["hex"].finditer(text)]
    free: dict[str, int] = {}
    for end, (kind, size) in auto.iter(text.lower().decode("latin-1")):
        at = end + 1 - size
        if at < free.get(kind, 0):
            continue
        m = PATTERNS[kind].match(text, at)
        if m:
            free[kind] = m.end()
            if _valid(kind, m):
                found.append((at, KINDS.index(kind), m.end()))
        elif kind in RUNS and (run := RUNS[kind].match(text, at)):
            free[kind] = run.end()
    found.sort()
    return found


def code_points(text: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not found or text.isascii():
        return found
    upto = np.append(0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))
    return [(int(upto[a]), k, int(upto[b])) for a, k, b in found]


def _scan(batches):
    auto = automaton()
    span = pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32())])
    for batch in batches:
        rows = []
        for t in batch.column("bin"):
            text = t.as_py() or b""
            rows.append([{"kind": KINDS[k], "a": a, "b": b} for a, k, b in code_points(text, scan(text, auto))])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, spans (kind, a, b in code points, b not included; by start, then kind).

    Null and empty texts have no spans; doc_id is passed on as it is, null or repeated. Other columns are ignored; an
    empty table gives an empty result.
    """
    workers_ready(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("bin")).mapInArrow(
        _scan, "doc_id long, spans array<struct<kind:string,a:int,b:int>>")


def op10(spark, sf_dir) -> DataFrame:
    out = find_secrets(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return out.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
                      F.sha2(listed(of(*BASE)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
