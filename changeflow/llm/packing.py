"""Best-fit packing of documents into sequences, after Martello-Toth dominance reduction.

Documents become pieces of at most ``capacity`` tokens; only longer ones are cut.
A plan needs nothing but the number of pieces of each length. Dominance fixes,
largest length first, sets that no other packing can beat: a piece that nothing
fits beside, two pieces that fill a sequence exactly, and a piece with its largest
partner where no better set fits. What is left is packed by best-fit decreasing.
Both work on counts of equal lengths, so the plan has a few rows per length,
whatever the input, and pieces find their place from their length and their rank
among pieces of that length.

Defined results: a null text is empty and packs its end id alone. Repeated rows
are packed row by row; null ids are kept. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, written
from .wordcodes import library_ids, text_batches

CAPACITY = 1024


def reduce_counts(counts: np.ndarray) -> tuple[list[tuple[list[tuple[int, int]], int]], np.ndarray]:
    """Sequences fixed by dominance as (contents, how many), and the counts that remain.

    ``counts[n]`` pieces have length n. Contents are (length, times) pairs.
    """
    capacity = len(counts) - 1
    left, fixed = counts.astype(object).copy(), []
    for big in range(capacity, 0, -1):
        while left[big]:
            room = capacity - big
            beside = left[: room + 1].copy()
            if big <= room:
                beside[big] -= 1
            fits = np.flatnonzero(beside)
            if not len(fits):  # nothing fits beside it
                fixed.append(([(big, 1)], left[big]))
                left[big] = 0
                break
            largest, smallest = int(fits[-1]), int(fits[0])
            second = smallest if beside[smallest] > 1 else int(fits[1]) if len(fits) > 1 else capacity + 1
            # Exact filling, or no two pieces fit beside it: the largest partner dominates every other set.
            if largest != room and smallest + second <= room:
                break
            if largest == big:
                times = left[big] // 2
                fixed.append(([(big, 2)], times))
                left[big] -= 2 * times
            else:
                times = min(left[big], left[largest])
                fixed.append(([(big, 1), (largest, 1)], times))
                left[big] -= times
                left[largest] -= times
    return fixed, left


def best_fit(left: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-fit decreasing on counts: (contents, how many) of the sequences.

    A piece goes where least room stays. Once it is in, that sequence has the least room again, so a sequence
    takes as many pieces of a length as fit, and equal sequences are handled together.
    """
    capacity = len(left) - 1
    open_: list[list[tuple[list[tuple[int, int]], int]]] = [[] for _ in range(capacity + 1)]  # by room
    for size in range(capacity, 0, -1):
        n, moved = left[size], []
        for room in range(size, capacity + 1):
            times = room // size
            while n and open_[room]:
                contents, many = open_[room].pop()
                full = min(many, n // times)
                rest = (n - full * times) if full < many else 0
                rest = min(rest, times - 1)
                if full:
                    moved.append((room - times * size, ([*contents, (size, times)], full)))
                if rest:
                    moved.append((room - rest * size, ([*contents, (size, rest)], 1)))
                unused = many - full - (1 if rest else 0)
                n -= full * times + rest
                if unused:
                    open_[room].append((contents, unused))
                    break
            if not n:
                break
        times = capacity // size
        if n // times:
            moved.append((capacity - times * size, ([(size, times)], n // times)))
        if n % times:
            moved.append((capacity - (n % times) * size, ([(size, n % times)], 1)))
        for room, group in moved:
            open_[room].append(group)
    return [g for groups in open_ for g in groups]


def plan_rows(groups: list[tuple[list[tuple[int, int]], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, times, offset), ordered: where the pieces of a length go by rank."""
    rows, rank, sequence = [], {}, 0
    for contents, many in groups:
        offset = 0
        for size, times in contents:
            first = rank.get(size, 0)
            rows.append((size, first, sequence, times, offset))
            rank[size] = first + many * times
            offset += size * times
        sequence += many
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def cut_pieces(docs: DataFrame, tokenizer: str, end: int = 2, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pieces of all documents with, for each, the task that cut it and its rank among the task's pieces of its length."""
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches):
        encoder, seen, part = library_ids(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch, texts in text_batches(batches):
            tokens, offsets = encoder.encode(texts, end=end)
            n = np.diff(offsets)
            n_pieces = -(-n // capacity)
            doc = np.repeat(np.arange(len(n)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            head = (n - (n_pieces - 1) * capacity)[doc]
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            order = np.argsort(length, kind="stable")
            grouped = length[order]
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - np.searchsorted(grouped, grouped) + seen[grouped]
            seen += np.bincount(length, minlength=capacity + 1)
            first = offsets[:-1][doc] + start
            tokens = tokens.astype("<u4")
            out = {
                "doc_id": batch.column(0).take(pa.array(doc)),
                "piece": pa.array(piece.astype(np.int32)),
                "start": pa.array(start),
                "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(tokens[a:b].tobytes()) for a, b in zip(first, first + length)], pa.int64()),
                "part": pa.array(np.full(len(doc), part, np.int32)),
                "rank": pa.array(rank),
            }
            if ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(np.append(first, offsets[-1]).astype(np.int32)), pa.array(tokens.astype(np.int32)))
            yield pa.RecordBatch.from_pydict(out)

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long" + (", ids array<int>" if ids else "")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(task, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written, with length, part and rank) with their ``sequence_id`` and ``offset``."""
    per_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    per_part = written(per_part, "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        counts[r["length"]] = r["n"]
    fixed, left = reduce_counts(counts)
    plan = plan_rows([g for g in [*fixed, *best_fit(left)] if g[1]])
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    ranked = pieces.join(broadcast_if_small(offsets, offsets.count()), ["part", "length"])
    ranked = ranked.select(*[c for c in pieces.columns if c not in ("part", "rank")], (F.col("rank") + F.col("__before")).alias("rank"))

    def task(batches):
        by_length = np.searchsorted(plan[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank")).to_numpy()
            row = np.empty(len(length), np.int64)
            for size in np.unique(length):
                at = length == size
                a, b = by_length[size], by_length[size + 1]
                row[at] = a + np.searchsorted(plan[a:b, 1], rank[at], "right") - 1
            _, first, sequence, times, offset = plan[row].T
            step = rank - first
            keep = [batch.column(i) for i, n in enumerate(names) if n != "rank"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence + step // times), pa.array(offset + step % times * length)], names=[n for n in names if n != "rank"] + ["sequence_id", "offset"])

    names = ranked.columns
    types = ", ".join(f"`{n}` {t}" for n, t in ranked.dtypes if n != "rank")
    return ranked.mapInArrow(task, types + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end: int = 2, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and its ids, if asked)."""
    pieces = written(cut_pieces(docs, tokenizer, end, capacity, ids), "pieces")
    out = pack(pieces, capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence (at most ``capacity``) and its documents, from pieces packed with their ids."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    out = packed.groupBy("sequence_id").agg(rows.alias("rows"))
    return out.select("sequence_id", F.col("rows.doc_id").alias("doc_ids"), F.flatten("rows.ids").alias("ids"))
