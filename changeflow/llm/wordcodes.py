"""Whole texts to token ids, each distinct word encoded once.

A text is cut before every run of ASCII white space that follows something else, and where an ASCII letter is
followed by another ASCII character that is none. No token of the tokenizers used here crosses such a cut, so the ids of a text are those of its pieces in order. Equal pieces
of a batch are found by Arrow's dictionary encoding and encoded once. Texts with other Unicode or control
white space, next to which a cut could change the result, stay in one piece.
"""

from __future__ import annotations

import itertools
import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters next to which a cut could change the result: control and Unicode white space, joiners, and the mark
#: that SentencePiece writes for a space.
ODD_WHITE = "[\x1c-\x1f\u0085\u00a0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff\u2581]"
#: First bytes of those characters in UTF-8.
ODD_BYTE = np.zeros(256, dtype=bool)
ODD_BYTE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
SIGN = ~LETTER & (np.arange(256) < 128)


def text_batches(batches, text: str = "text", limit: int = 4 << 20):
    """Slices of Arrow record batches whose texts hold about ``limit`` bytes: (slice, texts without nulls)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        filled = pc.fill_null(column.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(filled).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(first, last - first), filled.slice(first, last - first)
            first = last
    pa.default_memory_pool().release_unused()  # the worker lives on


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the offset of each (one more than texts)."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_pieces(texts: pa.Array, at_signs: bool = True) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Codes of the pieces of all texts, the distinct pieces, and each text's first piece (one more than texts).

    ``at_signs``: cut after ASCII letters too.
    """
    data, offsets = raw(texts)
    if not len(data):
        return np.zeros(0, np.int64), [], np.zeros(len(texts) + 1, np.int64)
    blank = BLANK[data]
    cut = np.zeros(len(data), dtype=bool)
    np.greater(blank[1:], blank[:-1], out=cut[1:])
    if at_signs:
        cut[1:] |= LETTER[data[:-1]] & SIGN[data[1:]]
    if ODD_BYTE[data].any():
        odd = pc.match_substring_regex(texts, ODD_WHITE).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd):
            cut[offsets[i]:offsets[i + 1]] = False
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts, len(data)).astype(np.int64)
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())).dictionary_encode()
    return pieces.indices.to_numpy().astype(np.int64), pieces.dictionary.to_pylist(), np.searchsorted(starts, offsets)


def of_worker(name: str, make):
    """``make()``, made once in the life of a Python worker and used by all of its tasks."""
    kept = sys.modules.setdefault("changeflow_worker", types.ModuleType("changeflow_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


class PieceIds:
    """Ids of word pieces. When over ``limit`` pieces are held, the half met in fewer batches is forgotten."""

    def __init__(self, encode_many, limit: int = 500_000, at_signs: bool = True):
        self.encode_many, self.limit, self.at_signs = encode_many, limit, at_signs
        self.at: dict[str, int] = {}
        self.met, self.lengths, self.pool = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def forget(self):
        often = np.sort(self.met)[-(self.limit // 2):]
        keep = self.met > max(1, int(often[0]))
        self.at = dict(zip((p for p, k in zip(self.at, keep.tolist()) if k), range(int(keep.sum()))))
        self.pool = self.pool[np.repeat(keep, self.lengths)]
        self.lengths, self.met = self.lengths[keep], np.ones(int(keep.sum()), np.int32)

    def lookup(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pool of ids, and where each piece starts in it and how long it is."""
        if len(self.at) > self.limit:
            self.forget()
        held = len(self.at)
        at = np.fromiter((self.at.setdefault(p, len(self.at)) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(at >= held)
        if len(new):
            flat, lengths = self.encode_many([pieces[i] for i in new])
            self.lengths, self.pool = np.concatenate([self.lengths, lengths]), np.concatenate([self.pool, flat])
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        self.met[at] += 1
        starts = np.cumsum(self.lengths) - self.lengths
        return self.pool, starts[at], self.lengths[at]

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offset of each; ``end`` is appended to each text."""
        codes, pieces, first = word_pieces(texts, self.at_signs)
        pool, starts, lengths = self.lookup(pieces)
        if end is not None:  # as one more piece after each text
            codes = np.insert(codes, first[1:], len(pieces))
            first = first + np.arange(len(first))
            starts, lengths, pool = np.append(starts, len(pool)), np.append(lengths, 1), np.append(pool, np.int32(end))
        n = lengths[codes] if len(codes) else np.zeros(0, np.int64)
        upto = np.append(0, np.cumsum(n))
        at = np.repeat((starts[codes] if len(codes) else n) - upto[:-1], n)
        at += np.arange(len(at))
        return pool[at], upto[first]


def library_ids(path: str) -> PieceIds:
    """The worker's encoder for a file of the tokenizers library."""
    return of_worker(path, lambda: load_library(path))


def load_library(path: str) -> PieceIds:
    """Ids by the tokenizers library; strings of special tokens in a text are ordinary text.

    Pieces of plain Latin letters skip the library's normaliser and splitter, which leave such a piece whole: their
    characters are replaced by what those steps make of each, and the library's model encodes them as they are.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    full, model = Tokenizer.from_file(path), Tokenizer.from_file(path)
    full.encode_special_tokens = model.encode_special_tokens = True

    def prepared(s):
        s = full.normalizer.normalize_str(s) if full.normalizer else s
        return "".join(x for x, _ in full.pre_tokenizer.pre_tokenize_str(s))

    letters = {c: prepared(chr(c)) for c in range(65, 256) if chr(c).isalpha() and chr(c) not in "ªµº"}
    table = letters | {32: prepared(" a")[:-1]}
    plain = re.compile(" ?[" + "".join(map(chr, letters)) + "]+").fullmatch
    model.normalizer = model.pre_tokenizer = model.post_processor = None

    def some(pieces):
        simple = [bool(plain(p)) for p in pieces]
        fast = iter(model.encode_batch_fast([p.translate(table) for p, s in zip(pieces, simple) if s], add_special_tokens=False))
        slow = iter(full.encode_batch_fast([p for p, s in zip(pieces, simple) if not s], add_special_tokens=False))
        ids = [next(fast if s else slow).ids for s in simple]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

    def encode_many(pieces):
        # The library's results are large objects: a few thousand at a time.
        done = [some(pieces[i:i + 8192]) for i in range(0, len(pieces), 8192)]
        return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])

    return PieceIds(encode_many)
