"""Secret scans: plain patterns, and structural confirmation of encoded candidates.

The base patterns report what looks like an assignment, an access key or a hex string. Beyond them, base64 and hex
candidates are decoded and reported only when the bytes prove to be a key: DER with nested lengths that add up,
an OpenSSH container, a PEM block around either, base64 of such a PEM block, or a signed token whose header names an
algorithm. Line breaks within a candidate, real ones or escaped ones (backslash and n), don't count.

Defined cases: a null text counts as empty; a text of any length is read whole; offsets are code points, end exclusive;
spans of one kind don't overlap, spans of different kinds may; every row of the input gives one row, repeated rows included,
and an empty table none; ids pass as they are, null ones too; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re

from pyspark.sql import DataFrame

from tidewright.llm.common import per_text

#: Kinds in the order in which spans with one start are listed: base kinds, then confirmed ones.
KINDS = ("assign", "access", "hex", "pem", "jwt", "der", "ssh")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 16 or more is the leftmost match of the plain run that passes the length test.
_HEX = re.compile(r"[0-9a-f]{16,}")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
_JWT = re.compile(r"(?<![A-Za-z0-9_.-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_MARKER = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_PEM_BODY = re.compile(r"(?:[A-Za-z0-9+/=\s:,-]|\\+[nr])*")
_ESCAPED_BREAK = re.compile(r"\\+[nr]")
_BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\+r)?\\+n)[ \t]*")
_RUN = re.compile("[A-Za-z0-9+/_-]+")
_HEX_RUN = re.compile("[0-9A-Fa-f]+")
#: Where a key may begin that is wrapped over lines or follows an escaped break, and base64 of a PEM block.
_HEAD = re.compile(r"(?:M[A-P]|b3Bl|LS0t|30|6[Ff])[A-Za-z0-9+/_-]{14,}")
_BEFORE_HEAD = re.compile(r"(?<![A-Za-z0-9+/_-])|(?<=\\[nr])")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base kinds."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]


def _der_items(data: bytes, depth: int = 0) -> list[tuple[int, object]] | None:
    """The elements of a DER body as (tag, bytes or elements), or None where a length doesn't fit."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or depth > 8:
            return None
        tag, n, at = data[at], data[at + 1], at + 2
        if n & 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > len(data) or data[at] == 0:
                return None
            n, at = int.from_bytes(data[at : at + size], "big"), at + size
            if n < 128:
                return None
        if at + n > len(data):
            return None
        body: object = data[at : at + n]
        if tag in (0x30, 0x31):
            body = _der_items(data[at : at + n], depth + 1)
            if body is None:
                return None
        items.append((tag, body))
        at += n
    return items


def is_der_key(data: bytes) -> bool:
    """A private key in PKCS#1, PKCS#8 (plain or encrypted) or SEC 1 form, whose lengths all add up."""
    top = _der_items(data)
    if not top or len(top) != 1 or top[0][0] != 0x30 or not top[0][1]:
        return False
    tags = [t for t, _ in top[0][1]]
    first = top[0][1][0][1]
    if tags[0] == 0x02 and len(first) == 1:
        if tags[1:3] == [0x30, 0x04]:
            return bool(top[0][1][1][1]) and top[0][1][1][1][0][0] == 0x06
        if tags[1:2] == [0x04]:
            return first == b"\1" and len(top[0][1][1][1]) >= 16
        return len(tags) >= 6 and all(t == 0x02 for t in tags[:6]) and len(top[0][1][1][1]) >= 32
    return tags == [0x30, 0x04] and bool(first) and first[0][0] == 0x06 and len(top[0][1][1][1]) >= 16


def is_openssh_key(data: bytes) -> bool:
    """An OpenSSH container: the magic, then four length-prefixed fields of which the first three are read."""
    if not data.startswith(b"openssh-key-v1\0"):
        return False
    at = 15
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 4 <= len(data)


def _key_length(data: bytes) -> int | None:
    """How many bytes the key that begins in data says it has, if it says so there."""
    if data.startswith(b"openssh-key-v1\0"):
        at, fields = 15, 3
        while fields:
            if at + 4 > len(data):
                return None
            at, fields = at + 4 + int.from_bytes(data[at : at + 4], "big"), fields - 1
        if at + 4 > len(data):
            return None
        at, fields = at + 4, int.from_bytes(data[at : at + 4], "big") + 1  # the public keys and the private part
        while fields:
            if at + 4 > len(data):
                return None
            at, fields = at + 4 + int.from_bytes(data[at : at + 4], "big"), fields - 1
        return at
    if len(data) < 6 or data[0] != 0x30:
        return None
    size = data[1] & 0x7F if data[1] & 0x80 else 0
    return 2 + size + int.from_bytes(data[2 : 2 + size], "big") if 1 <= size <= 4 else 2 + data[1] if not size else None


def _runs(text: str, start: int, run: re.Pattern, least: int | None = None) -> list[tuple[int, int]]:
    """(begin, end) of the run at start and of those that follow it with only a line break between, until they have `least`
    characters."""
    out, at, total = [], start, 0
    while (least is None or total < least) and (m := run.match(text, at)):
        out.append(m.span())
        total += m.end() - m.start()
        gap = _BREAK.match(text, m.end())
        if not gap:
            break
        at = gap.end()
    return out


def _end_of(runs: list[tuple[int, int]], n: int) -> int | None:
    """Where the n-th character of the runs ends, if they have so many."""
    for a, b in runs:
        if n <= b - a:
            return a + n
        n -= b - a
    return None


def _bytes_of(text: str, runs: list[tuple[int, int]], is_hex: bool) -> bytes:
    chars = "".join(text[a:b] for a, b in runs)
    return bytes.fromhex(chars[: len(chars) // 2 * 2]) if is_hex else _decoded(chars[: len(chars) - (len(chars) % 4 == 1)]) or b""


def _key_over_lines(text: str, start: int) -> tuple[int, str, int] | None:
    """The key that begins at start in base64 or hex, over as many lines as its own lengths ask for. Lines beyond the first are
    only read for what begins as a key and says how long it is."""
    is_hex = text.startswith("30", start) or text[start : start + 2].lower() == "6f"
    run = _HEX_RUN if is_hex else _RUN
    head = _bytes_of(text, [(a, min(b, a + 64)) for a, b in _runs(text, start, run, 16)], is_hex)
    if head.startswith(b"-----BEGIN "):
        runs = _runs(text, start, run)
        for _, inner_end in _pem_keys(_bytes_of(text, runs, False).decode("latin-1"))[:1]:  # the rest of the run belongs to the same value
            last = _end_of(runs, -(-inner_end * 4 // 3))
            end = _RUN.match(text, last)
            return start, "pem", _padded(text, end.end() if end else last)
        return None
    if head.startswith(b"openssh-key"):
        n = _key_length(_bytes_of(text, _runs(text, start, run), is_hex))
    else:
        n = _key_length(head)
    if n is None:
        return None
    chars = 2 * n if is_hex else -(-n * 4 // 3)
    runs = _runs(text, start, run, chars)
    end = _end_of(runs, chars)
    if end is None or not (kind := _key_kind(_bytes_of(text, runs, is_hex)[:n])):
        return None
    if any(a < end < b for a, b in runs):  # more of the same line
        return None
    return start, kind, end if is_hex else _padded(text, end)


def _padded(text: str, end: int) -> int:
    for _ in range(2):
        end += text.startswith("=", end)
    return end


def _pem_keys(text: str) -> list[tuple[int, int]]:
    """(start, end) of the armoured blocks around a key. Each BEGIN is paired with the next marker if that ends the same kind,
    so the text is read once however many lack an end."""
    out, begun = [], None
    for m in _MARKER.finditer(text):
        if m[1] == "BEGIN":
            begun = m
        elif begun is not None:
            if begun[2] == m[2] and _PEM_BODY.fullmatch(text, begun.end(), m.start()) and _holds_key(text[begun.end() : m.start()]):
                out.append((begun.start(), m.end()))
            begun = None
    return out


def _holds_key(body: str) -> bool:
    """Whether an armoured body decodes to a key. In the older form of encryption, which headers announce with a cipher and its
    initial value, the data are whole cipher blocks of at least a key's size; in the newer one they are DER."""
    lines = _ESCAPED_BREAK.sub("\n", body).splitlines()
    headers = dict(x.split(":", 1) for x in lines if ":" in x)
    data = _decoded("".join("".join(x.split()) for x in lines if ":" not in x))
    if "ENCRYPTED" in headers.get("Proc-Type", ""):
        info = re.fullmatch(r"\s*(AES-(?:128|192|256)-CBC|DES-EDE3-CBC|DES-CBC)\s*,\s*((?:[0-9A-Fa-f]{2})+)\s*", headers.get("DEK-Info", ""))
        block = 0 if info is None else 16 if info[1].startswith("AES") else 8
        return bool(data and block and len(info[2]) == 2 * block and len(data) >= 48 and len(data) % block == 0)
    return bool(_key_kind(data))


def _decoded(text: str) -> bytes | None:
    try:
        text = text.rstrip("=").replace("-", "+").replace("_", "/")
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "ssh" if is_openssh_key(data) else "der" if data[0] == 0x30 and is_der_key(data) else None


def _is_token(header: str, claims: str) -> bool:
    try:
        head, body = (json.loads(_decoded(x) or b"") for x in (header, claims))
    except ValueError:
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def confirmed_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of what decodes to the structure of a key or a signed token."""
    found = []
    if "-----BEGIN " in text:
        found += [(a, "pem", b) for a, b in _pem_keys(text)]
    armoured, done = list(found), 0
    starts = [a for a, _, _ in armoured]
    _within = lambda at: (k := bisect.bisect_right(starts, at) - 1) >= 0 and at < armoured[k][2]
    if "eyJ" in text:
        found += [(m.start(), "jwt", m.end()) for m in _JWT.finditer(text) if _is_token(m[1], m[2])]
    for m in _BASE64.finditer(text):
        run = m[0]
        if (run[0] == "M" or run[:4] == "b3Bl") and (kind := _key_kind(_decoded(run))):
            found.append((m.start(), kind, m.end()))
        elif run[:2].lower() in ("30", "6f") and len(run) % 2 == 0 and re.fullmatch("[0-9A-Fa-f]+", run) and (kind := _key_kind(bytes.fromhex(run))):
            found.append((m.start(), kind, m.end()))
    for m in _HEAD.finditer(text):
        if m.start() >= done and _BEFORE_HEAD.match(text, m.start()) and not _within(m.start()) and (key := _key_over_lines(text, m.start())):
            found = [x for x in found if x[:2] != key[:2]] + [key]
            done = key[2]
    return found


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda x: (x[0], KINDS.index(x[1]), x[2])))


def _report(text: str) -> list[tuple]:
    base = base_spans(text)
    count = [sum(k == kind for _, k, _ in base) for kind in KINDS[:3]]
    return [(*count, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + confirmed_spans(text)))]


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id_col, n_assign, n_access, n_hex, base_sha256, spans."""
    return per_text(docs, id_col, text_col, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", _report)
