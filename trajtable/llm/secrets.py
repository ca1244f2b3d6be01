"""Secret scan with structural confirmation.

Three plain rules find assignments, access keys and long hex strings. Beyond them, runs of base64 or
hex are decoded and reported only when their structure holds: DER keys whose nested lengths add up,
SSH keys whose length-prefixed fields fill the data, and signed tokens whose header is JSON that
names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import annotate, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "ssh", "token")  # the last three are confirmed by structure

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # starts at the first character of a run, so short runs are never cut
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
#: a key in lines; line ends may be written as escapes, header lines may come first
LINE = r"(?:\s|\\[rn])"
BROKEN_RUN = re.compile(rf"-----BEGIN [A-Z0-9 ]*KEY-----{LINE}*(?:[A-Za-z][A-Za-z-]*: [^\n\\]*{LINE}+)*((?:[A-Za-z0-9+/=]|{LINE})+?){LINE}*-----END")
GLUED = re.compile(r"(?<=[/_-])(?=M[A-J]|AAAA|b3Bl|30)")  # where a key may begin inside a run: how keys and lengths encode
SIGNED = re.compile(r"ey[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-")


def der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """Length of the element whose length field is at ``at``, and where its content begins."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 0x80:
        return first, at + 1
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 1 + n > len(data):
        return None
    return int.from_bytes(data[at + 1 : at + 1 + n], "big"), at + 1 + n


def der_elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents when the elements fill the data exactly."""
    out, at = [], 0
    while at < len(data):
        length = der_length(data, at + 1)
        if length is None or length[1] + length[0] > len(data):
            return None
        out.append((data[at], data[length[1] : length[1] + length[0]]))
        at = length[1] + length[0]
    return out


def is_der_key(data: bytes) -> bool:
    """One sequence that fills the data, of elements that fill it, with an integer, an algorithm or a key inside."""
    outer = der_elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_elements(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    for tag, content in inner:
        if tag == 0x30 and not der_elements(content):
            return False
    tags = [tag for tag, _ in inner]
    numbers = tags[:1] == [0x02] and inner[0][1] in (b"\x00", b"\x01")
    public = tags[:2] == [0x30, 0x03]  # algorithm and bit string
    plain = len(tags) == 2 and tags == [0x02, 0x02] and len(inner[0][1]) > 16
    return numbers or public or plain


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields that fill the data, the first a key type; or the private key magic."""
    if data.startswith(b"openssh-key-v1\x00"):
        data, fields = data[15:], 0
        while fields < 3:
            if len(data) < 4 or int.from_bytes(data[:4], "big") > len(data) - 4:
                return False
            data, fields = data[4 + int.from_bytes(data[:4], "big") :], fields + 1
        return len(data) >= 4 and 1 <= int.from_bytes(data[:4], "big") <= 64
    fields = []
    while data:
        if len(data) < 4 or int.from_bytes(data[:4], "big") > len(data) - 4:
            return False
        n = int.from_bytes(data[:4], "big")
        fields.append(data[4 : 4 + n])
        data = data[4 + n :]
    return len(fields) >= 2 and fields[0].startswith(SSH_NAMES)


def is_signed_header(part: str) -> bool:
    try:
        head = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def decoded(run: str) -> list[bytes]:
    """What a run may encode: hex of an even number of digits, and base64 of either alphabet."""
    out = []
    if len(run) % 2 == 0 and re.fullmatch("[0-9a-fA-F]+", run):
        out.append(bytes.fromhex(run))
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 != 1:
        try:
            out.append(base64.b64decode(body + "=" * (-len(body) % 4)))
        except binascii.Error:
            pass
    return out


def structure(data: bytes) -> str | None:
    return "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def kind_of(run: str) -> str | None:
    return next(filter(None, map(structure, decoded(run))), None)


def confirmed(text: str, a: int, b: int) -> list[tuple[str, int, int]]:
    """The keys in a run: the whole run, or what follows an escape or is glued to ``/``, ``-`` or ``_``."""
    run = text[a:b]
    kind = kind_of(run)
    if kind:
        return [(kind, a, b)]
    out, done = [], 0
    starts = [1] if a and text[a - 1] == "\\" else []
    for start in [*starts, *(m.start() for m in GLUED.finditer(run))]:
        if start < done or b - a - start < 24:
            continue
        # up to the end of the run, or up to a mark that standard base64 does not have
        stop = re.search("[_-]", run[start:])
        for end in dict.fromkeys([b - a, start + stop.start() if stop else b - a]):
            kind = kind_of(run[start:end]) if end - start >= 24 else None
            if kind:
                out.append((kind, a + start, a + end))
                done = end
                break
    return out


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """Spans (kind, start, end) in code points, by start and then kind in the order of KINDS."""
    spans = []
    if ":" in text or "=" in text:
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    runs = [(m.start(), m.end()) for m in RUN.finditer(text)]
    if runs:
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    for a, b in runs:
        spans += confirmed(text, a, b)
    if "-----BEGIN" in text:
        for m in BROKEN_RUN.finditer(text):
            kind = kind_of(re.sub(LINE, "", m[1]))
            if kind and (kind, *m.span(1)) not in spans:
                spans.append((kind, *m.span(1)))
    if "ey" in text and "." in text:
        spans += [("token", m.start(), m.end()) for m in SIGNED.finditer(text) if is_signed_header(m[0].split(".")[0])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (default: all) and ``spans``: array of (kind, start, end).

    Whole texts are read; null counts as empty and has no spans. Equal rows get equal spans. A
    result column replaces an input column of the same name.
    """

    def prepare():
        def work(texts: pa.Array) -> dict[str, pa.Array]:
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in texts.to_pylist()]
            return {"spans": pa.array(rows, pa.list_(SPAN))}

        return work

    return annotate(docs, [("spans", "array<struct<kind:string,start:bigint,end:bigint>>")], prepare, text, keep)


def joined(spans):
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), keep=["doc_id"])
    number = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s.kind.isin(*BASE_KINDS))
    return found.select("doc_id", *map(number, BASE_KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))
