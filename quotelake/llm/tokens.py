"""Token ids of whole texts, from a file of the ``tokenizers`` library.

The library encodes each *part* (a word, or the marks or space beside it) once and the
worker remembers the ids of parts, which in natural text repeat far more often than
texts do. A text is cut only where the tokenizer's own pre-tokenizer must cut,
so the ids equal those of the whole text; a text where that is not certain is
encoded whole.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Ids are four little-endian bytes each.
ID_BYTES = 4

#: Bytes of what a worker remembers, and the longest part of it in bytes. Others are
#: encoded again; the ids are the same.
MEMORY = 32_000_000
LONGEST = 48
#: What a remembered part holds beside its text and ids: two offsets.
ENTRY = 12
#: Bytes of a piece of a batch, of which only distinct units are held.
PIECE = 8_000_000
#: New parts in one text for the library.
TOGETHER = 512

#: Fixed value: ASCII marks that are neither letters, digits nor white space. The
#: apostrophe is apart, as it may begin a token with letters.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
APOSTROPHE = "'"
#: White space that a unit may be cut at.
BREAKS = "\t\n\r"

#: Kinds of characters; ``SOLID`` and above are certainly not white space.
OTHER, BLANK, BREAK, SOLID = 0, 1, 2, 3
APOSTROPHE_KIND, MARK, LETTER = 3, 4, 5


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """Kind of each character of the basic plane; the last stands for all beyond it.

    Letters are those of Unicode 3.2 that still are, so every version in use agrees, and
    that a normalizer leaves letters: a capital I with a dot becomes a letter and a mark.
    """
    kinds = np.zeros(0x10000, np.uint8)
    for code in range(0xFFFF):
        c = chr(code)
        if c.isspace():
            kinds[code] = BLANK
        elif unicodedata.ucd_3_2_0.category(c)[0] == "L":
            normal = c + unicodedata.normalize("NFC", c).lower()
            if all(unicodedata.category(x)[0] == "L" for x in normal):
                kinds[code] = LETTER
    for some, kind in ((MARKS, MARK), (APOSTROPHE, APOSTROPHE_KIND), (BREAKS, BREAK)):
        kinds[[ord(c) for c in some]] = kind
    kinds[ord(" ")] = OTHER
    return kinds


def little_endian(ids: Iterable[int]) -> bytes:
    values = array("I", ids)
    if values.itemsize != ID_BYTES:
        raise TypeError("unsigned int has not four bytes here")
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """The worker process's encoder, with what it remembers from earlier tasks."""
    return TextEncoder(path)


class TextEncoder:
    """Encodes texts with the tokenizer at ``path``.

    Byte-level files with the usual word expression keep the space before a word
    in its token: ``spaced``. Other files drop white space. A batch is cut at its spaces
    and its distinct units into parts by Arrow and numpy, each distinct part is looked up
    once, and many new ones are one text for the library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        normalizer = self.tokenizer.normalizer
        self.spaced = normalizer is None
        self.lowers = normalizer is not None and normalizer.normalize_str("A") == "a"
        self.known = pa.array([], pa.string())
        self.known_ids = pa.array([], pa.large_binary())
        self.used = 0
        mark = "\u0120" if self.spaced else "</w>"
        self.edge = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.edge[number] = token.startswith(mark) if self.spaced else token.endswith(mark)
        self.gap_id = np.frombuffer(self.whole(["\n"])[0], "<u4") if self.spaced else None

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [little_endian(x.ids) for x in found]

    def words(self, words: list[str], gap: str) -> list[bytes]:
        """Ids of words that begin or end a token each, many in one text for the library.

        With a line end as ``gap`` its own token tells words apart. Otherwise a token
        tells whether it starts a word (or, where white space is dropped, whether it
        ends one).
        """
        found = []
        for at in range(0, len(words), TOGETHER):
            some = words[at : at + TOGETHER]
            ids = np.frombuffer(self.whole([gap.join(some)])[0], "<u4")
            if gap == "\n":
                gaps = np.flatnonzero(ids == self.gap_id)
                starts, ends = np.append(0, gaps + 1), np.append(gaps, len(ids))
            else:
                marked = np.flatnonzero(self.edge[ids])
                starts = marked if self.spaced else np.append(0, marked[:-1] + 1)
                ends = np.append(starts[1:], len(ids))
            if len(starts) != len(some):
                found += self.whole(some)
                continue
            text = ids.tobytes()
            found += [text[a:b] for a, b in zip((ID_BYTES * starts).tolist(), (ID_BYTES * ends).tolist())]
        return found

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as bytes."""
        if not len(texts):
            return []
        found = self._encoded(texts)
        # Else a worker keeps what it needed for its largest piece.
        pa.default_memory_pool().release_unused()
        return found

    def _encoded(self, texts: list[str] | pa.Array) -> list[bytes]:
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        # A copy, whose offsets begin at 0.
        texts = pa.concat_arrays([texts]).cast(pa.string())
        split = pc.split_pattern(texts, " ")
        starts, cut = split.offsets.to_numpy(), split.flatten().dictionary_encode()
        units, codes = cut.dictionary, cut.indices.to_numpy().copy()
        if self.spaced:
            # A text's first unit has no space before it.
            first = units.take(pa.array(codes[starts[:-1]]))
            codes[starts[:-1]] = len(units) + np.arange(len(texts))
            units = pa.concat_arrays([pc.binary_join_element_wise(" ", units, ""), first])
        ids, depends = self._unit_ids(units)

        unsafe = np.add.reduceat(depends[codes].astype(np.int64), starts[:-1]) > 0
        for token in self.added:
            # The library finds added tokens in a text before anything else.
            unsafe |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        data, offsets = _buffers(ids.take(pa.array(codes)))
        held, ends = memoryview(data), offsets[starts].tolist()
        found = [bytes(held[a:b]) for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(unsafe).tolist():
            found[i] = self.whole([texts[i].as_py()])[0]
        return found

    def _unit_ids(self, units: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Ids of each unit, and whether these depend on what is around it.

        Units that begin with white space, or are empty, do where spaces are kept.
        """
        data, offsets = _buffers(units)
        data = data.copy()
        at = np.flatnonzero((data & 0xC0) != 0x80)
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
        kinds = character_kinds()[np.minimum(chars, 0xFFFF)]
        begin, size = np.searchsorted(at, offsets[:-1]), np.diff(offsets)
        depends = np.zeros(len(units), bool)
        if self.spaced:
            own = begin + (np.append(chars, 0)[begin] == ord(" "))
            after = np.append(begin[1:], len(chars))
            blank = np.isin(np.append(kinds, OTHER), (BLANK, BREAK))
            depends = (own >= after) | blank[own]

        cut = _cuts(kinds)
        cut[begin[size > 0]] = True
        parts = np.flatnonzero(cut)
        if not len(parts):
            return pa.array([b""] * len(units), pa.large_binary()), depends
        count = np.diff(np.append(parts, len(chars)))
        letters = np.minimum.reduceat(kinds, parts) == LETTER
        if self.lowers:
            upper = np.repeat(letters, count) & (chars >= ord("A")) & (chars <= ord("Z"))
            data[at[upper]] += ord("a") - ord("A")
        texts = _array(pa.string(), data, np.append(at[parts], len(data)).astype(np.int32))
        of_unit = np.searchsorted(parts, np.append(begin, len(chars)))
        if self.spaced:
            together = np.where(np.minimum.reduceat(kinds, parts) >= SOLID, 1, 2)
            together[chars[parts] == ord(" ")] = 0
            together[np.repeat(depends, np.diff(of_unit))] = 2
        else:
            together = np.where(letters, 1, 2)
        data, offsets = _buffers(self._part_ids(texts, together))
        return _array(pa.large_binary(), data, offsets[of_unit]), depends

    def _part_ids(self, parts: pa.Array, together: np.ndarray) -> pa.Array:
        """Ids of each part. ``together``: 0 if a space tells it from others in one text,
        1 if a gap does, 2 if it is a text of its own for the library."""
        cut = parts.dictionary_encode()
        distinct, codes = cut.dictionary, cut.indices.to_numpy()
        places = pc.index_in(distinct, value_set=self.known)
        new = np.flatnonzero(places.is_null().to_numpy(zero_copy_only=False))
        places = places.fill_null(0).to_numpy().copy()
        kind = np.empty(len(distinct), np.int8)
        kind[codes] = together
        ids, ids_of_new = [], np.empty(0, np.int64)
        for k, gap in enumerate(("", "\n" if self.spaced else " ", None)):
            some = new[kind[new] == k]
            texts = distinct.take(pa.array(some)).to_pylist()
            ids += self.whole(texts) if gap is None else self.words(texts, gap)
            ids_of_new = np.append(ids_of_new, some)
        places[ids_of_new] = len(self.known) + np.arange(len(ids_of_new))
        found = pa.array(ids, pa.large_binary())
        table = pa.concat_arrays([self.known_ids, found])
        self._remember(distinct.take(pa.array(ids_of_new)), found)
        return table.take(pa.array(places[codes]))

    def _remember(self, parts: pa.Array, ids: pa.Array) -> None:
        """Keep what is new while there is room."""
        lengths = pc.binary_length(parts).to_numpy()
        sizes = np.where(lengths <= LONGEST, ENTRY + lengths + pc.binary_length(ids).to_numpy(), 0)
        kept = pa.array((sizes > 0) & (self.used + np.cumsum(sizes) <= MEMORY))
        self.used += int(sizes[kept.to_numpy(zero_copy_only=False)].sum())
        self.known = pa.concat_arrays([self.known, parts.filter(kept)])
        self.known_ids = pa.concat_arrays([self.known_ids, ids.filter(kept)])


def _cuts(kinds: np.ndarray) -> np.ndarray:
    """Whether a tokenizer of words must cut before each character, by it and two before.

    A word ends at a mark, and marks but the apostrophe at a word; both end at white
    space, and one line end or tab between them stands alone. Whatever else is near a
    character leaves it uncut.
    """
    before, here = kinds[:-1], kinds[1:]
    cut = np.zeros(len(kinds), bool)
    cut[1:] = (before == LETTER) & ((here == MARK) | (here == APOSTROPHE_KIND))
    cut[1:] |= (before == MARK) & (here == LETTER)
    cut[1:] |= (before >= SOLID) & (here == BREAK)
    cut[2:] |= (kinds[:-2] >= SOLID) & (kinds[1:-1] == BREAK) & (kinds[2:] >= SOLID)
    return cut


def _buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts or byte strings that begin at 0."""
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, kind)[: len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[: offsets[-1]], offsets


def _array(kind: pa.DataType, data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data)]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)


def in_pieces(batches: Iterator[pa.RecordBatch], rows: int = 2048, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of few, so that little of a batch is held split; with
    ``size``, also of no more bytes than that, but for single rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from _halved(batch.slice(at, rows), size)


def _halved(batch: pa.RecordBatch, size: int | None) -> Iterator[pa.RecordBatch]:
    if size is None or batch.num_rows < 2 or batch.nbytes <= size:
        yield batch
        return
    half = batch.num_rows // 2
    for part in (batch.slice(0, half), batch.slice(half)):
        yield from _halved(part, size)
