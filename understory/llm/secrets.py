"""Secret scans: fixed patterns, and sliding-window Shannon entropy for each character class.

A candidate is a run of ``LEAST`` or more characters that keys are written in. The entropy of a window of ``window``
characters (of the whole candidate, if it is shorter) is kept up by incremental counts: when the window moves by one,
two counts change and the sum of c*log2(c) is corrected by four table values, so a candidate of n characters costs
O(n). Overlapping windows above the border of the candidate's class and the window's length become one span, of the kind
``entropy``, also where a fixed pattern has a span of its own kind.

The allow-list suppresses windows, not candidates: those without both a letter and a digit, those that hold a
placeholder and those that reach into a UUID.

Defined results: null and empty texts have no spans; texts are scanned whole; repeated rows give repeated results;
an empty table gives an empty table; other columns are ignored (only ``id_col`` and ``text_col`` are read).
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_texts, table

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
WINDOW, LEAST = 20, 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Class of a candidate: its pattern, and the bits a character that a window of 16, 17, ... 20 needs. These are the 1 per
#: cent quantiles of the entropy that as many random characters of the class's alphabet have (simulated, 200,000 each;
#: 16, 36, 62, 38 and 64 characters), rounded down.
CLASSES = (
    ("hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), (2.65, 2.73, 2.79, 2.83, 2.88)),
    ("one case", re.compile(r"[a-z0-9]+|[A-Z0-9]+"), (3.15, 3.21, 3.28, 3.32, 3.40)),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), (3.32, 3.45, 3.50, 3.57, 3.64)),
    ("one case, signs", re.compile(r"[a-z0-9+/_=-]+|[A-Z0-9+/_=-]+"), (3.15, 3.21, 3.30, 3.36, 3.42)),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), (3.37, 3.45, 3.53, 3.57, 3.64)),
)
#: The allow-list: identifiers, and pieces that only made-up keys hold.
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
PLACEHOLDER = re.compile(r"(?i)example|placeholder|xxxx|abcdefgh|01234567|12345678")
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
_CLOG = [0.0] + [c * math.log2(c) for c in range(1, 257)]


def allowed(s: str, window: int) -> bytearray:
    """1 for each start of a window of s that the allow-list suppresses."""
    n = len(s) - window + 1
    out = bytearray(n)
    for kind in (_DIGIT, _LETTER):  # windows between two of the kind hold none
        at = 0
        for m in kind.finditer(s):
            if (end := m.start() - window + 1) > at:
                out[at:end] = b"\1" * (end - at)
            at = m.end()
        if n > at:
            out[at:n] = b"\1" * (n - at)
    for m in PLACEHOLDER.finditer(s):
        for i in range(max(0, m.end() - window), min(m.start() + 1, n)):
            out[i] = 1
    for m in UUID.finditer(s):
        for i in range(max(0, m.start() - window + 1), min(m.end(), n)):
            out[i] = 1
    return out


def entropy_runs(s: str, window: int, bits: float, skip: bytes | bytearray = b"") -> list[tuple[int, int]]:
    """Merged [start, end) of the windows of s, but those marked in skip, whose entropy is at least bits a character."""
    if len(s) < window:
        return []
    counts: dict[str, int] = {}
    total = 0.0
    for c in s[:window]:
        k = counts.get(c, 0)
        total += _CLOG[k + 1] - _CLOG[k]
        counts[c] = k + 1
    limit, runs = (math.log2(window) - bits) * window + 1e-9, []
    for i in range(len(s) - window + 1):
        if i:
            old, new = s[i - 1], s[i + window - 1]
            k = counts[old]
            total += _CLOG[k - 1] - _CLOG[k]
            counts[old] = k - 1
            k = counts.get(new, 0)
            total += _CLOG[k + 1] - _CLOG[k]
            counts[new] = k + 1
        if total <= limit and not (skip and skip[i]):
            if runs and i <= runs[-1][1]:
                runs[-1][1] = i + window
            else:
                runs.append([i, i + window])
    return [(a, b) for a, b in runs]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; a match that is too short is dropped."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8] if _has_key(text) else []
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return out


_KEY = re.compile(r"password|passwd|secret|token|api_?key", re.A | re.I)


def _has_key(text: str) -> bool:
    return _KEY.search(text) is not None


def entropy_spans(text: str, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(start, kind, end). Windows have 16 to 20 characters."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, at = m[0], m.start()
        if not (_DIGIT.search(s) and _LETTER.search(s)):
            continue
        size = min(window, len(s))
        bits = next(b for _, p, b in CLASSES if p.fullmatch(s))[size - LEAST]
        out += [(at + a, 3, at + b) for a, b in entropy_runs(s, size, bits, allowed(s, size))]
    return out


def scan(text: str | None, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """All (start, kind, end) of a text, by start, then kind."""
    return sorted(base_spans(text or "") + entropy_spans(text or "", window))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each input row: its id and ``found``, an array of (kind, start, end, value), in order.

    Narrow: no shuffle; each text is scanned once in an Arrow batch of bounded size.
    """

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))
        for b in batches:
            rows = [[{"kind": KINDS[k], "start": s, "end": e, "value": t[s:e]} for s, k, e in scan(t, window)] if t else [] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, kind)], ["id", "found"])

    kind = dict(df.dtypes)[id_col]
    out = map_texts(df.select(id_col, text_col), run, f"id {kind}, found array<struct<kind:string,start:int,end:int,value:string>>")
    return out.withColumnRenamed("id", id_col)


def digest(spans) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def op5_secret_scan(spark, sf_dir):
    """The contract's digests, derived from the operator's spans by SQL functions."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    one = "concat_ws(':', x.kind, x.start, x.end)"
    base = f"concat_ws(',', transform(filter(found, x -> x.kind <> 'entropy'), x -> {one}))"
    n = lambda k: f"cast(size(filter(found, x -> x.kind = '{k}')) as bigint)"
    return found.selectExpr("doc_id", f"{n('assign')} as n_assign", f"{n('access')} as n_access", f"{n('hex')} as n_hex", f"sha2({base}, 256) as base_sha256", f"concat_ws(',', transform(found, x -> {one})) as spans", f"{n('entropy')} as n_entropy")
