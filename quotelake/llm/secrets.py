"""Secret scans: keyword automaton, anchored expressions, embedded checksums.

Everything works on UTF-8 bytes, whose A-Z alone change case; offsets leave as
code points.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.llm.common import unused_name

#: Kinds every scan reports, in their order among spans of one start.
BASE_KINDS = ("assign", "access", "hex")
#: Kinds whose value carries a checksum; reported only if it holds.
CHECKED_KINDS = ("checked_token", "iban")
KINDS = BASE_KINDS + CHECKED_KINDS

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"

# Names of secrets, prefixes of tokens that end in a CRC-32.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
TOKEN_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASSIGN = re.compile(
    rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE,
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_TOKEN = re.compile(rb"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_IBAN = re.compile(rb"(?:iban)[:\x20]{0,3}([A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![A-Za-z0-9])", re.IGNORECASE)

_HEX_RUN = 32
_IS_HEX = bytes(104 if chr(b) in "0123456789abcdef" else 46 for b in range(256))


def base62_crc32(body: bytes) -> bytes:
    """CRC-32 of ``body`` as six base-62 digits, leading zeros kept."""
    value, digits = zlib.crc32(body), []
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits.append(BASE62[digit])
    return "".join(reversed(digits)).encode()


def iban_holds(value: bytes) -> bool:
    """ISO 7064 mod 97-10 over the rearranged account number."""
    moved = value[4:] + value[:4]
    return int("".join(str(int(chr(c), 36)) for c in moved)) % 97 == 1


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in (
        ("assign", ASSIGN_WORDS),
        ("access", ("akia",)),
        ("checked_token", TOKEN_PREFIXES),
        ("iban", ("iban",)),
    ):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _match(kind: str, text: bytes, at: int) -> tuple[int, bool] | None:
    """End of the expression anchored at ``at``, and whether the match counts."""
    if kind == "assign":
        m = _ASSIGN.match(text, at)
        return m and (m.end(), len(m[1]) >= 8)
    if kind == "access":
        m = _ACCESS.match(text, at)
        return m and (m.end(), m.end() - at >= 16)
    if kind == "checked_token":
        m = _TOKEN.match(text, at)
        return m and (m.end(), m[2] == base62_crc32(m[1]))
    m = _IBAN.match(text, at)
    return m and (m.end(), iban_holds(m[1].upper()))


def find_spans(text: bytes, words: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """Spans of one text, as byte offsets, by start and then by kind."""
    found, last = [], dict.fromkeys(KINDS, 0)
    for end, (kind, length) in words.iter(text.lower().decode("latin-1")):
        at = end - length + 1
        if at < last[kind]:
            continue
        m = _match(kind, text, at)
        if m:
            last[kind] = m[0]
            if m[1]:
                found.append((kind, at, m[0]))
    runs = text.translate(_IS_HEX)
    at = runs.find(b"h" * _HEX_RUN)
    while at >= 0:
        end = runs.find(b".", at)
        end = len(runs) if end < 0 else end
        found.append(("hex", at, end))
        at = runs.find(b"h" * _HEX_RUN, end)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def to_points(text: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The same spans as code points."""
    if text.isascii():
        return spans
    at, points, where = 0, 0, {}
    for offset in sorted({x for s in spans for x in s[1:]}):
        points += len(text[at:offset].decode())
        at, where[offset] = offset, points
    return [(kind, where[start], where[end]) for kind, start, end in spans]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _automaton()
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = []
        for text in batch.column("text").cast(pa.large_binary()):
            raw = text.as_py() or b""
            found = find_spans(raw, words)
            spans.append([dict(zip(("kind", "start", "end"), s)) for s in to_points(raw, found)])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in batch.schema.names), pa.array(spans, kind)],
            names=[*batch.schema.names, "spans"],
        )


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and all spans of secrets of every whole text, one row per document.

    A null text is an empty one and has no spans. Repeated rows each give a row;
    other columns of ``docs`` are left out. Within a kind, spans are leftmost and
    do not overlap; spans of different kinds may. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(
        _scan, f"doc_id {kind}, text string, spans {SPANS}"
    )
    return found.select("doc_id", "spans")


def _masked(mask: str, counted: str):
    def mask_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, put = _automaton(), mask.encode()
        for batch in batches:
            texts, counts = [], []
            for text in batch.column("text").cast(pa.large_binary()):
                raw = text.as_py()
                spans = find_spans(raw, words) if raw else []
                counts.append(len(spans))
                if spans:
                    kept, at = [], 0
                    for _, start, end in spans:
                        if start >= at:
                            kept += [raw[at:start], put]
                        at = max(at, end)
                    raw = b"".join([*kept, raw[at:]])
                texts.append(None if raw is None else raw.decode())
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, "text", pa.array(texts, pa.string()))
            yield batch.append_column(counted, pa.array(counts, pa.int64()))

    return mask_texts


def mask_secrets(docs: DataFrame, mask: str = "<secret>") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced; no document is dropped.

    Spans that overlap get one mask. ``n_chars``, where there is one, follows the
    new text. A null text stays null; all other columns stay as they are.
    """
    counted = unused_name("secrets", docs.columns)
    shape = T.StructType([*docs.schema.fields, T.StructField(counted, T.LongType())])
    masked = docs.mapInArrow(_masked(mask, counted), shape)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col(counted) > 0, F.length("text")).otherwise(F.col("n_chars"))
        masked = masked.withColumn("n_chars", changed.cast(kind))
    return masked.select(*docs.columns)
