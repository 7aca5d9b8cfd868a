"""Token ids in files, entropy-coded by a static range asymmetric numeral system (rANS).

A file is a Parquet part whose rows are segments of whole documents in ascending
id order. A segment counts its tokens into one frequency table that all of its
blocks share. Blocks are independent; the tokens of a block go round-robin over
interleaved lanes, each a 64-bit rANS state that spills 32-bit words. Checkpoints
(lane states and place in the words) every ``STRIDE`` steps let a reader start
inside a block, so all stretches of a segment are decoded side by side; a CRC-32
per block guards the ids. Parts are written by Spark's committer, so a lost task
leaves no half file.

Defined results: a null text is empty and gives the end id alone. Documents of one
id follow each other, ordered by a hash of the text; null ids come first. A document of any
length stays within one segment. An empty table gives an empty folder of segments.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, prefix_sums
from .wordcodes import library_ids, text_batches

LANES = 32
BLOCK = 1 << 16
STRIDE = 512
SEGMENT = 1 << 21
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
LOW_WORD = np.uint64((1 << 32) - 1)


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The ids that occur, their frequencies (adding up to 2**bits, one at least each) and bits."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    bits = max(12, int(len(symbols)).bit_length() + 4)
    exact = counts[symbols].astype(np.float64) * ((1 << bits) / len(ids))
    freqs = np.maximum(1, exact.astype(np.int64))
    over = int(freqs.sum()) - (1 << bits)
    if over < 0:
        freqs[np.argmax(freqs)] -= over
    while over > 0:  # take from the most frequent, a sixteenth of each at a time
        largest = np.argsort(-freqs, kind="stable")
        give = np.maximum(freqs[largest] >> 4, freqs[largest] > 1).astype(np.int64)
        take = np.clip(over - (np.cumsum(give) - give), 0, give)
        freqs[largest] -= take
        over -= int(take.sum())
    return symbols, freqs, bits


def shape(n_tokens: int) -> tuple[int, int, int]:
    """Blocks, steps of a block and steps between checkpoints for a segment."""
    blocks = max(1, -(-n_tokens // BLOCK))
    steps = max(1, -(-n_tokens // (blocks * LANES)))
    stride = min(STRIDE, steps)
    return blocks, -(-steps // stride) * stride, stride


def encode_segment(ids: np.ndarray) -> dict[str, bytes]:
    """The coded parts of a segment."""
    symbols, freqs, bits = frequency_table(ids)
    blocks, steps, stride = shape(len(ids))
    rank = np.zeros(int(symbols[-1]) + 1, np.int32)
    rank[symbols] = np.arange(len(symbols))
    cells = np.full(blocks * steps * LANES, int(np.argmax(freqs)), np.int32)  # the rest is padding
    cells[: len(ids)] = rank[ids]
    cells = cells.reshape(blocks, steps, LANES).transpose(1, 0, 2).reshape(steps, blocks * LANES)
    f_of, c_of = freqs.astype(np.uint64), (np.cumsum(freqs) - freqs).astype(np.uint64)
    shift = np.uint64(bits)
    limit_of = ((LOW >> shift) << WORD) * f_of
    state = np.full(blocks * LANES, LOW, np.uint64)
    words, spilled = np.empty(cells.shape, np.uint32), np.empty(cells.shape, bool)
    saved = np.empty((steps // stride, blocks * LANES), np.uint64)
    for t in range(steps - 1, -1, -1):
        s = cells[t]
        f = f_of[s]
        spill = state >= limit_of[s]
        words[t], spilled[t] = state.astype(np.uint32), spill
        state = np.where(spill, state >> WORD, state)
        whole = state // f
        state = (whole << shift) + (state - whole * f) + c_of[s]
        if t % stride == 0:
            saved[t // stride] = state
    # Words of a block in reading order: by step, then lane. A checkpoint's place counts the words before its step.
    by_block = spilled.reshape(steps, blocks, LANES).transpose(1, 0, 2)
    payload = words.reshape(steps, blocks, LANES).transpose(1, 0, 2)[by_block]
    per_stretch = by_block.reshape(blocks, steps // stride, stride * LANES).sum(2)
    places = (np.cumsum(per_stretch.ravel()) - per_stretch.ravel()).astype(np.uint64)
    states = saved.reshape(steps // stride, blocks, LANES).transpose(1, 0, 2)
    size = steps * LANES
    sums = [zlib.crc32(ids[b * size:(b + 1) * size].astype("<u4").tobytes()) for b in range(blocks)]
    return {
        "symbols": np.diff(symbols, prepend=0).astype("<u4").tobytes(),
        "freqs": freqs.astype("<u4").tobytes(),
        "words": payload.astype("<u4").tobytes(),
        "states": states.astype("<u8").tobytes(),
        "places": places.astype("<u8").tobytes(),
        "checksums": np.array(sums, "<u4").tobytes(),
    }


def decode_segment(row: dict, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """Ids of the blocks from ``first_block`` to before ``last_block`` (all if None); checks their checksums."""
    n_tokens = row["n_tokens"]
    blocks, steps, stride = shape(n_tokens)
    last_block = blocks if last_block is None else last_block
    symbols = np.cumsum(np.frombuffer(row["symbols"], "<u4").astype(np.int64))
    freqs = np.frombuffer(row["freqs"], "<u4").astype(np.int64)
    bits = int(freqs.sum()).bit_length() - 1
    slot_rank = np.repeat(np.arange(len(symbols), dtype=np.int32), freqs)
    f_of, c_of = freqs.astype(np.uint64), (np.cumsum(freqs) - freqs).astype(np.uint64)
    shift, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    words = np.append(np.frombuffer(row["words"], "<u4"), np.zeros(LANES, np.uint32)).astype(np.uint64)
    n = steps // stride
    states = np.frombuffer(row["states"], "<u8").reshape(blocks * n, LANES)[first_block * n:last_block * n].copy()
    place = np.frombuffer(row["places"], "<u8").astype(np.int64)[first_block * n:last_block * n]
    out = np.empty((stride, len(states), LANES), np.int32)
    for t in range(stride):
        slot = states & mask
        s = slot_rank[slot]
        out[t] = s
        states = f_of[s] * (states >> shift) + slot - c_of[s]
        need = states < LOW
        at = np.cumsum(need, axis=1)
        following = words[np.minimum(place[:, None] + at - need, len(words) - 1)]
        states = np.where(need, (states << WORD) | following, states)
        place = place + at[:, -1]
    size = steps * LANES
    ids = symbols[out.transpose(1, 0, 2).ravel()][: max(0, n_tokens - first_block * size)].astype("<u4")
    sums = np.frombuffer(row["checksums"], "<u4")
    for b in range(first_block, last_block):
        if zlib.crc32(ids[(b - first_block) * size:(b + 1 - first_block) * size].tobytes()) != sums[b]:
            raise ValueError(f"checksum of block {b} differs")
    return ids


SEGMENTS = (
    "part int, segment int, n_tokens long, doc_ids binary, null_ids binary, lengths binary, symbols binary, freqs binary, "
    "words binary, states binary, places binary, checksums binary"
)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end: int = 1) -> None:
    """Tokenise whole texts and write them, in ascending id order, as segments under ``path``."""

    def task(batches):
        part = TaskContext.get().partitionId()
        encoder = library_ids(tokenizer)
        held, n_held, number = [], 0, 0

        def segment():
            ids = np.concatenate([h[0] for h in held])
            return pa.RecordBatch.from_pylist([
                {"part": part, "segment": number, "n_tokens": len(ids), "doc_ids": np.concatenate([h[1] for h in held]).tobytes(), "null_ids": np.packbits(np.concatenate([h[2] for h in held])).tobytes(), "lengths": np.concatenate([h[3] for h in held]).tobytes()}
                | encode_segment(ids)
            ], schema=out)

        for batch, texts in text_batches(batches):
            ids, offsets = encoder.encode(texts, end=end)
            doc_ids = batch.column(0)
            held.append((ids, doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"), doc_ids.is_null().to_numpy(zero_copy_only=False), np.diff(offsets).astype("<u4")))
            n_held += len(ids)
            if n_held >= SEGMENT:
                yield segment()
                held, n_held, number = [], 0, number + 1
        if held:
            yield segment()

    out = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()), *[(n.split()[0], pa.binary()) for n in SEGMENTS.split(", ")[3:]]])
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("__tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("__tie")]
    rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie").mapInArrow(task, SEGMENTS).write.option("compression", "zstd").parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def read_documents(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 and, if asked, its ids."""

    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens = decode_segment(row)
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=len(lengths)).astype(bool)
                parts = [tokens[a:b] for a, b in zip(ends - lengths, ends)]
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(lengths), row["part"], np.int32)),
                    "segment": pa.array(np.full(len(lengths), row["segment"], np.int32)),
                    "doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=null),
                    "at": pa.array(ends - lengths),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
                } | ({"ids": pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(tokens.astype(np.int32)))} if ids else {}))

    segments = read_segments(spark, path)
    bases, _ = prefix_sums(segments.select("part", "segment", "n_tokens"), ["part", "segment"], {"base": F.col("n_tokens")})
    read = segments.mapInArrow(task, "part int, segment int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else ""))
    joined = read.join(broadcast_if_small(bases.drop("n_tokens"), bases.count()), ["part", "segment"])
    return joined.select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))
