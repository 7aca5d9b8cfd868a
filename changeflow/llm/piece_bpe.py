"""SentencePiece BPE by vectorised merge rounds.

The words of a batch lie in one flat array of symbols. In each round every word
finds the least rank among its neighbouring pairs, merges all its occurrences of
that pair at once, leftmost first, and the array is compacted; words without a
mergeable pair leave the array. Pieces of equal rank, and pairs that touch where
the first merge would open a better one, are merged one at a time, as the library
does. Characters outside the vocabulary become byte pieces.

Defined results: null text counts as empty and gives only the end id. Texts of any
length are encoded whole, in one task each. Repeated rows are encoded row by row;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordcodes import PieceIds, of_worker, text_batches

SPACE = "▁"
NONE = np.int64(1) << 40


class Merges:
    """Pair ranks of a model file: symbols are piece ids, then characters that only occur inside pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.library
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(len(pieces))]
        normal = {p: i for i, p in enumerate(pieces) if not special[i]}
        if any(sp.is_unused(i) for i in range(len(pieces))) or any(SPACE in p.lstrip(SPACE) for p in normal):
            raise ValueError("unused pieces, or pieces with an inner space mark, are not supported")
        symbols = dict(normal)
        for p in normal:
            for c in p:
                symbols.setdefault(c, len(pieces) + len(symbols))
        self.symbols, self.n_pieces, self.unknown = symbols, len(pieces), sp.unk_id()
        self.bytes_at = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in normal.values()}, reverse=True))}
        shared = {}
        for i in normal.values():
            shared[sp.get_score(i)] = shared.get(sp.get_score(i), 0) + 1
        keys, made, ranks = [], [], []
        for p, i in normal.items():
            for cut in range(1, len(p)):
                if p[:cut] in symbols and p[cut:] in symbols:
                    keys.append(symbols[p[:cut]] << 32 | symbols[p[cut:]])
                    made.append(i)
                    # The lowest bit marks ranks that several pieces share.
                    ranks.append(order[sp.get_score(i)] << 1 | (shared[sp.get_score(i)] > 1))
        # An open-addressed table of pairs, filled and probed by array operations.
        self.bits = max(4, int(len(keys) * 4).bit_length())
        self.key, self.made, self.rank = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64), np.full(1 << self.bits, NONE)
        keys, made, ranks = np.array(keys, np.int64), np.array(made, np.int64), np.array(ranks, np.int64)
        at, left = self.home(keys), np.arange(len(keys))
        while len(left):
            free = left[self.key[at[left]] == -1]
            self.key[at[free]] = keys[free]
            placed = self.key[at[left]] == keys[left]
            here = left[placed]
            self.made[at[here]], self.rank[at[here]] = made[here], ranks[here]
            left = left[~placed]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the table; a free place where it is no pair."""
        keys = left << 32 | right
        at = self.home(keys)
        open_ = np.flatnonzero((self.key[at] != keys) & (self.key[at] != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            open_ = open_[(self.key[at[open_]] != keys[open_]) & (self.key[at[open_]] != -1)]
        return at

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and lengths of the words after all merges."""
        n_words = len(lengths)
        done_symbols, done_words = [], []
        word = np.repeat(np.arange(n_words), lengths)
        place = np.full(len(symbols), -1, np.int64)
        rank = np.full(len(symbols), NONE)

        def look(i):
            """The pair of each symbol in ``i`` and its follower, if they are of one word."""
            i = i[i + 1 < len(symbols)]
            i = i[word[i] == word[i + 1]]
            place[i] = self.find(symbols[i], symbols[i + 1])
            rank[i] = self.rank[place[i]]

        look(np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            best = np.minimum.reduceat(rank, starts)
            over = np.repeat(best == NONE, sizes)
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                stay = ~over
                symbols, word, place, rank = symbols[stay], word[stay], place[stay], rank[stay]
                continue_with = best != NONE
                best, sizes = best[continue_with], sizes[continue_with]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            # Overlapping occurrences follow each other: every second one of such a run is merged.
            new_run = np.append(True, np.diff(hit) > 1) | np.append(True, word[hit[1:]] != word[hit[:-1]])
            run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
            first = np.append(True, word[hit[1:]] != word[hit[:-1]])
            alone = (rank[hit] & 1).astype(bool)
            touch = np.flatnonzero(np.append(False, (np.diff(hit) == 2) & ~first[1:]))
            if len(touch):
                opened = self.rank[self.find(self.made[place[hit[touch - 1]]], symbols[hit[touch]])]
                better = touch[opened < rank[hit[touch]]]
                alone |= np.isin(word[hit], word[hit[better]])
            hit = hit[first | ~alone]
            symbols[hit] = self.made[place[hit]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            to = np.cumsum(stay) - 1
            symbols, word, place, rank = symbols[stay], word[stay], place[stay], rank[stay]
            hit = to[hit]
            changed = np.unique(np.concatenate([hit, hit[hit > 0] - 1]))
            rank[changed] = NONE
            look(changed)
        if not done_symbols:
            return np.zeros(0, np.int64), np.zeros(n_words, np.int64)
        word = np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return np.concatenate(done_symbols)[order], np.bincount(word, minlength=n_words)

    def encode_many(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and the number of each."""
        extra: dict[str, int] = {}
        points = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        chars, which = np.unique(points, return_inverse=True)
        ids = np.zeros(len(chars), np.int64)
        for k, c in enumerate(map(chr, chars)):
            c = SPACE if c == " " else c
            ids[k] = self.symbols[c] if c in self.symbols else extra.setdefault(c, (1 << 31) - 1 - len(extra))
        symbols, lengths = self.merge(ids[which], np.fromiter(map(len, pieces), np.int64, len(pieces)))
        lost = symbols >= self.n_pieces
        if not lost.any():
            return symbols.astype(np.int32), lengths
        # Characters without a piece: their UTF-8 bytes, each as its byte piece.
        names = {i: c for c, i in self.symbols.items() if i >= self.n_pieces} | {i: c for c, i in extra.items()}
        word = np.repeat(np.arange(len(lengths)), lengths)
        at = np.flatnonzero(lost)
        spelled = [[self.bytes_at[b] for b in names[s].encode()] for s in symbols[at].tolist()]
        times = np.ones(len(symbols), np.int64)
        times[at] = list(map(len, spelled))
        out, word = np.repeat(symbols, times), np.repeat(word, times)
        out[np.repeat(lost, times)] = [b for s in spelled for b in s]
        return out.astype(np.int32), np.bincount(word, minlength=len(lengths))


def piece_ids(path: str) -> tuple[PieceIds, Merges]:
    """The worker's encoder for a model file."""

    def load():
        merges = Merges(path)
        return PieceIds(merges.encode_many, at_signs=False), merges

    return of_worker(path, load)


def marked(texts: pa.Array) -> pa.Array:
    """Texts with the leading space that the model puts before each text that is not empty."""
    return pa.array([" " + t if t else t for t in texts.to_pylist()], pa.large_string())


def encode_texts(docs: DataFrame, path: str, digest: bool = False) -> DataFrame:
    """Ids of each whole text with the end id: doc_id, n_tokens and ``ids``, or digests of ids and decoded text."""

    def task(batches):
        encoder, merges = piece_ids(path)
        end = merges.library.eos_id()
        names = np.array([str(i) for i in range(merges.n_pieces)], object)
        for batch, texts in text_batches(batches):
            ids, offsets = encoder.encode(marked(texts), end=end)
            parts = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            out = {"doc_id": batch.column(0), "n_tokens": pa.array(np.diff(offsets))}
            if digest:
                lists = [p.tolist() for p in parts]
                out["ids_sha256"] = pa.array([hashlib.sha256(" ".join(names[p]).encode()).hexdigest() for p in parts])
                out["decoded_sha256"] = pa.array([hashlib.sha256(merges.library.decode(p).encode()).hexdigest() for p in lists])
            else:
                out["ids"] = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_pydict(out)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(task, schema)


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``text`` from the ids of ``encode_texts``."""

    def task(batches):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            texts = [library.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return encoded.select("doc_id", "ids").mapInArrow(task, f"doc_id {dict(encoded.dtypes)['doc_id']}, text string")
