"""Harmonic packing of token ids into sequences of a fixed capacity.

A piece longer than ``capacity / (k + 1)`` and at most ``capacity / k`` is of
class ``k``; a sequence of class ``k`` takes ``k`` pieces, whichever they are.
Every worker fills its own sequences, so nothing is shuffled and no worker waits
for another. Documents may be cut freely: one that would leave more than
``slack`` of its share empty gives a piece of exactly the next class's share and
goes on with the rest, so little is padded.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quotelake.llm.tokens import ID_BYTES, PIECE, encoder, in_pieces, little_endian

PIECES = (
    "doc_id {doc_id}, start bigint, length bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)

#: A worker numbers its sequences from its partition times this.
SEQUENCES_OF_A_WORKER = 1 << 40


@dataclass(frozen=True)
class PackingConfig:
    capacity: int = 2048
    end_id: int = 1
    slack: float = 1 / 32


def piece_lengths(length: int, cfg: PackingConfig) -> list[int]:
    """Lengths of a document's pieces, in its order."""
    pieces = []
    while length:
        if length >= cfg.capacity:
            piece = cfg.capacity
        else:
            k = cfg.capacity // length
            share = cfg.capacity // k
            piece = length if share - length <= cfg.slack * share else cfg.capacity // (k + 1)
        pieces.append(piece)
        length -= piece
    return pieces


class Packer:
    """Open sequences of one worker: at most ``k - 1`` pieces of each class ``k``."""

    def __init__(self, cfg: PackingConfig, first: int):
        self.cfg, self.next_id = cfg, first
        self.open: dict[int, list[tuple]] = defaultdict(list)

    def add(self, length: int, piece: tuple) -> Iterator[tuple]:
        """``piece`` with its place, and those that its full sequence held back."""
        k = self.cfg.capacity // length
        held = self.open[k]
        held.append((length, piece))
        if len(held) == k:
            del self.open[k]
            yield from self._placed(held)

    def rest(self) -> Iterator[tuple]:
        """What fills no sequence of its class: best fit, longest first."""
        pieces = [x for held in self.open.values() for x in held]
        rooms: list[tuple[int, int]] = []
        bins: list[list[tuple]] = []
        for length, piece in sorted(pieces, key=lambda x: -x[0]):
            at = bisect_left(rooms, (length, -1))
            room, number = rooms.pop(at) if at < len(rooms) else (self.cfg.capacity, len(bins))
            if number == len(bins):
                bins.append([])
            bins[number].append((length, piece))
            insort(rooms, (room - length, number))
        for held in bins:
            yield from self._placed(held)

    def _placed(self, held: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for length, piece in held:
            yield (*piece, self.next_id, offset)
            offset += length
        self.next_id += 1


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*found)) if found else [[]] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )


def _packing(path: str, cfg: PackingConfig, id_kind: pa.DataType):
    names = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
    kinds = (id_kind, *[pa.int64()] * 5, pa.binary())
    schema = pa.schema(list(zip(names, kinds)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(path).encode, little_endian([cfg.end_id])
        worker = TaskContext.get().partitionId()
        packer = Packer(cfg, worker * SEQUENCES_OF_A_WORKER)
        shown = lambda p: (p[0], p[1], p[2], p[3], p[5], p[6], p[4])
        for batch in in_pieces(batches, rows=4096, size=PIECE):
            docs = batch.column("doc_id").to_pylist()
            texts = pc.fill_null(batch.column("text"), "")
            found = []
            for doc, ids in zip(docs, ids_of(texts)):
                ids += end
                total, start = len(ids) // ID_BYTES, 0
                for length in piece_lengths(total, cfg):
                    own = ids[start * ID_BYTES : (start + length) * ID_BYTES]
                    found += packer.add(length, (doc, start, length, total, own))
                    start += length
            yield _rows([shown(p) for p in found], schema)
        yield _rows([shown(p) for p in packer.rest()], schema)

    return pack


def pack_documents(docs: DataFrame, path: str, cfg: PackingConfig = PackingConfig()) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Columns: doc_id, start, length, doc_tokens, sequence_id, offset, and ids as
    little-endian unsigned 32-bit integers. ``path`` names a file of the
    tokenizers library that every worker can open. Each document ends with
    ``end_id``; a null or empty text is that id alone. Repeated rows are packed
    one by one; other columns are left out; an empty table gives no rows. Padding
    up to ``capacity`` is left to the reader. A worker holds fewer than ``k``
    pieces of class ``k``, so its memory does not grow with its input. Sequence
    numbers do not follow on one another between workers.
    """
    field = docs.select("doc_id").schema["doc_id"]
    from pyspark.sql.pandas.types import to_arrow_type

    shape = PIECES.format(doc_id=field.dataType.simpleString())
    pack = _packing(path, cfg, to_arrow_type(field.dataType))
    return docs.select("doc_id", "text").mapInArrow(pack, shape)
