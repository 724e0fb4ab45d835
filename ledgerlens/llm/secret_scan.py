"""Secret scans: an Aho-Corasick keyword prefilter, anchored expressions at its hits, checksums inside tokens.

All patterns are ASCII, so texts are scanned as UTF-8 bytes; offsets become code points at the end, in texts
with a finding only.
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

from .rows import row_type, rows_and_text
from .textkernel import spans, utf8

MASK = "[secret]"
_BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _crc_token(m: re.Match) -> bool:
    """The last six characters are the base-62 CRC-32 of the random part before them."""
    body = m.group(1)
    value = zlib.crc32(body[:-6])
    digits = bytearray()
    while value:
        value, d = divmod(value, 62)
        digits.append(_BASE62[d])
    return bytes(reversed(digits)).rjust(6, b"0") == body[-6:]


def _signed_header(m: re.Match) -> bool:
    """The first part of a signed web token decodes to an object that names its algorithm."""
    part = m.group(1)
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (ValueError, binascii.Error, TypeError):
        return False


def _always(m: re.Match) -> bool:
    return True


#: kind: keywords in lower case, expression anchored at the keyword, test that a match must pass.
RULES = {
    "assign": (
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m.group(2)) >= 6,
    ),
    "access": (("akia",), rb"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 20),
    "hex": ((), None, None),
    "forge": (("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", _crc_token),
    "package": (("npm_",), rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", _crc_token),
    "webtoken": (("eyj",), rb"(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", _signed_header),
    "chat": (("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), rb"xox[abprs]-[A-Za-z0-9-]{10,}", _always),
    "pem": (
        ("-----begin",),
        rb"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z0-9 ]*PRIVATE KEY-----",
        _always,
    ),
}
KINDS = list(RULES)
BASE_KINDS = ("assign", "access", "hex")
HEX_LENGTH = 24

_COMPILED = {kind: re.compile(rule[1]) for kind, rule in RULES.items() if rule[1]}
#: Where a kind's expression failed, no later hit of these characters can match: they are not tried again.
_FAILED = {"webtoken": re.compile(rb"eyJ[A-Za-z0-9_-]*")}
_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True
_HEX_RUN = re.compile(rb"[0-9a-f]{%d}" % HEX_LENGTH)


def _prefilter() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, (keywords, _, _) in RULES.items():
        for word in keywords:
            automaton.add_word(word, (len(word), kind))
    automaton.make_automaton()
    return automaton


_AUTOMATON = _prefilter()


def _hex_runs(data: bytes) -> list[tuple[int, int, str]]:
    found, at = [], 0
    while at < len(data):
        piece = data[at : at + (1 << 20)]
        if at + len(piece) < len(data) and _HEX[piece[-1]]:
            end = at + len(piece)
            while end < len(data) and _HEX[data[end]]:
                end += 1
            piece = data[at:end]
        if _HEX_RUN.search(piece):
            s, e = spans(np.frombuffer(piece, dtype=np.uint8), _HEX)
            long = e - s >= HEX_LENGTH
            found += [(int(a) + at, int(b) + at, "hex") for a, b in zip(s[long], e[long])]
        at += len(piece)
    return found


def find_secrets(data: bytes) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in bytes, by start, then kind; matches of one kind don't overlap."""
    found = _hex_runs(data)
    done = dict.fromkeys(RULES, 0)
    hits = [(end - length + 1, kind) for end, (length, kind) in _AUTOMATON.iter(data.lower().decode("latin-1"))]
    for start, kind in sorted(hits):
        if start < done[kind]:
            continue
        if m := _COMPILED[kind].match(data, start):
            done[kind] = m.end()
            if RULES[kind][2](m):
                found.append((start, m.end(), kind))
        elif kind in _FAILED and (run := _FAILED[kind].match(data, start)):
            done[kind] = run.end()
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _masked(data: bytes, found: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for start, end, _ in found:
        if start >= at:
            out += [data[at:start], MASK.encode()]
        else:
            start = at
        at = max(at, end)
    return b"".join([*out, data[at:]]).decode("utf-8", "replace")


_SECRET = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _run(batches):
    for batch in batches:
        rows, texts = [], batch.column("text").to_pylist()
        for i, data in enumerate(utf8(batch.column("text"))):
            found = find_secrets(data)
            rows.append([])
            if found:
                point = np.zeros(len(data) + 1, dtype=np.int64)
                np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80, out=point[1:])
                rows[-1] = [{"kind": k, "start": int(point[a]), "end": int(point[b])} for a, b, k in found]
                texts[i] = _masked(data, found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(rows, _SECRET), pa.array(texts, pa.string())],
            names=["row", "secrets", "masked_text"],
        )


def scan_secrets(documents: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row with its columns in ``row``, its ``secrets`` and ``masked_text`` beside it.

    ``secrets`` is a list of ``kind, start, end`` (code points, end exclusive) by start, then kind in the order
    of ``KINDS``. Assignments, access keys and hexadecimal runs are the base; forge, package and signed web
    tokens count only if the checksum or header inside them holds. ``masked_text`` has each finding, and
    findings that overlap together, replaced by ``MASK``. A null text has no secrets and stays null; an empty
    table gives an empty result; repeated rows are answered each.
    """
    df = rows_and_text(documents, text_col, carry)
    return df.mapInArrow(
        _run, f"row {row_type(df)}, secrets array<struct<kind: string, start: bigint, end: bigint>>, masked_text string"
    )
