"""Secret scans: Aho-Corasick keyword prefilter, anchored expressions near hits, embedded checksums.

``scan_secrets`` adds to any table with a text column the spans of secrets in it. Every text is
read once by a keyword automaton; regular expressions are only tried at the places it names. Hexadecimal
keys have no keyword: each of 24 digits or more covers two neighbours among every 12th byte, so those
bytes are looked at in one vector step and a run is measured only around such a pair.

Kinds: ``assign``, ``access``, ``hex`` (the base), and with checks inside the value ``github`` and ``npm``
(last six characters are the CRC-32 of the rest in base 62) and ``pem`` (private key whose DER length fits).

Defined results: a null or empty text has no spans; equal rows get equal results; texts of any
length are scanned whole; further columns are passed through or ignored by the caller's choice of ``keep``.
"""

from __future__ import annotations

import base64
import binascii
import functools
import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "github", "npm", "pem")

# Base patterns, token prefixes and the digits of their checksums.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
GITHUB = re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
PEM = re.compile(rb"-----BEGIN ([A-Z ]{0,20}PRIVATE KEY)-----([A-Za-z0-9+/=\s\\]+)-----END \1-----")
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign",
            "api_key": "assign", "akia": "access", "ghp_": "github", "gho_": "github", "ghu_": "github",
            "ghs_": "github", "ghr_": "github", "npm_": "npm", "-----begin ": "pem"}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_STRIDE = 12

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])


@functools.lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def base62_crc(value: bytes) -> bytes:
    """CRC-32 of a token's random part as six base-62 digits."""
    number, digits = zlib.crc32(value), ""
    for _ in range(6):
        number, rest = divmod(number, 62)
        digits = BASE62[rest] + digits
    return digits.encode()


def _der_fits(body: bytes) -> bool:
    """The base64 body is one DER sequence (0x30) whose long-form length covers all of it."""
    try:
        der = base64.b64decode(re.sub(rb"\\[nr]|\s", b"", body), validate=True)
    except (binascii.Error, ValueError):
        return False
    if len(der) < 4 or der[0] != 0x30:
        return False
    size = der[1] & 0x7F
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    return len(der) == 2 + size + int.from_bytes(der[2:2 + size], "big")


def _valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= 6
    if kind == "access":
        return len(match[0]) >= 20
    if kind == "pem":
        return _der_fits(match[2])
    return base62_crc(match[1]) == match[2]


_ANCHORED = {"assign": ASSIGN, "access": ACCESS, "github": GITHUB, "npm": NPM, "pem": PEM}


def _hex_runs(data: bytes) -> Iterator[tuple[int, int]]:
    raw = np.frombuffer(data, np.uint8)
    sampled = _HEX[raw[::_STRIDE]]
    done = 0
    for i in np.flatnonzero(sampled[:-1] & sampled[1:]).tolist():
        at = i * _STRIDE
        if at < done:
            continue
        begin, end = at, at
        while begin > 0 and _HEX[raw[begin - 1]]:
            begin -= 1
        while end < len(raw) and _HEX[raw[end]]:
            end += 1
        done = end
        if end - begin >= 24:
            yield begin, end


def find(data: bytes) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in UTF-8 bytes, by start, then kind as listed."""
    hits = sorted((end + 1 - n, kind) for end, (kind, n) in _automaton().iter(data.lower().decode("latin-1")))
    spans, past = [], dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        # Matches of one kind never overlap, dropped ones included.
        if start >= past[kind] and (match := _ANCHORED[kind].match(data, start)):
            past[kind] = match.end()
            if _valid(kind, match):
                spans.append((kind, start, match.end()))
    spans.extend(("hex", begin, end) for begin, end in _hex_runs(data))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _in_code_points(data: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    if not spans or data.isascii():
        return spans
    offsets, at, n = {}, 0, 0
    for offset in sorted({x for s in spans for x in s[1:]}):
        n += len(data[at:offset].decode("utf-8"))
        offsets[offset], at = n, offset
    return [(kind, offsets[a], offsets[b]) for kind, a, b in spans]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_secrets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, out: str = "secrets") -> DataFrame:
    """``keep`` columns (default: all) and ``out``: array of (kind, start, end), in code points, end exclusive."""
    keep = docs.columns if keep is None else keep
    chosen = docs.select(*[docs[c].alias(f"k{i}") for i, c in enumerate(keep)], docs[text_col].alias("t"))
    schema = T.StructType([f for f in chosen.schema.fields[:-1]] + [T.StructField(out, T.ArrayType(SPAN))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            found = []
            for text in texts:
                data = text.as_py() or b""
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in _in_code_points(data, find(data))])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*batch.schema.names[:-1], out])

    return chosen.mapInArrow(scan, schema).toDF(*keep, out)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(joined([s for s in spans if s[0] in BASE]).encode()).hexdigest()


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same table with every secret replaced by ``<secret>``; overlapping spans become one."""
    from pyspark.sql import functions as F

    columns = docs.columns
    found = scan_secrets(docs, text_col, out="_secrets")
    # Spans by start: a piece of text before each span that begins behind all former ones, then the mark.
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    step = lambda s, x: F.struct(
        F.when(x["start"] >= s["at"], F.concat(s["out"], F.substr(F.col(text_col), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")),
                                               F.lit("<secret>"))).otherwise(s["out"]).alias("out"),
        F.greatest(s["at"], x["end"]).alias("at"))
    rest = lambda s: F.concat(s["out"], F.substr(F.col(text_col), (s["at"] + 1).cast("int"), F.length(text_col)))
    return found.withColumn(
        text_col, F.when(F.size("_secrets") == 0, F.col(text_col)).otherwise(F.aggregate("_secrets", state, step, rest))
    ).select(*columns)
