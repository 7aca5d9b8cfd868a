import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import DOCS, documents
from tokenizers import Tokenizer

from changeflow.llm import packing

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def groups_of(lengths, capacity):
    fixed, left = packing.reduce_counts(np.bincount(lengths, minlength=capacity + 1))
    return [g for g in [*fixed, *packing.best_fit(left)] if g[1]]


@pytest.mark.parametrize("seed", range(30))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 60))
    lengths = rng.integers(1, capacity + 1, int(rng.integers(0, 200)))
    plan = packing.plan_rows(groups_of(lengths, capacity))
    used, rank = {}, np.zeros(capacity + 1, int)
    for n in lengths:
        rows = plan[plan[:, 0] == n]
        _, first, sequence, times, offset = rows[np.searchsorted(rows[:, 1], rank[n], "right") - 1]
        step = rank[n] - first
        used.setdefault(sequence + step // times, []).append((offset + step % times * n, n))
        rank[n] += 1
    for parts in used.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and sum(n for _, n in parts) <= capacity


def fewest(lengths, capacity):
    best = len(lengths)

    def go(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(lengths):
            best = len(room)
            return
        for r in sorted({r for r in room if r >= lengths[i]}):
            k = room.index(r)
            go(i + 1, room[:k] + [r - lengths[i]] + room[k + 1:])
        go(i + 1, [*room, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(40))
def test_dominance_loses_no_sequence(seed):
    """Fixed sets and an optimal packing of the rest are as few sequences as an optimal packing of all."""
    rng = np.random.default_rng(seed)
    capacity = 20
    lengths = rng.integers(1, capacity + 1, 9).tolist()
    fixed, left = packing.reduce_counts(np.bincount(lengths, minlength=capacity + 1))
    rest = [n for n, k in enumerate(left) for _ in range(k)]
    assert sum(m for _, m in fixed) + (fewest(rest, capacity) if rest else 0) == fewest(lengths, capacity)


def test_near_the_bound():
    lengths = np.random.default_rng(1).integers(1, 1025, 20_000)
    n = sum(m for _, m in groups_of(lengths, 1024))
    assert n <= 1.005 * -(-int(lengths.sum()) // 1024)


def test_pieces_and_sequences(spark):
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    packed = packing.pack_documents(documents(spark, clash=True), BYTES, ids=True)
    got = packed.collect()
    expected = []
    for i, t, *_ in DOCS:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        n = -(-len(ids) // 1024)
        cuts = [0] + [len(ids) - (n - 1 - k) * 1024 for k in range(n)]
        expected += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(expected, key=repr)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["ids"]))
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for s, parts in by.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(parts, parts[1:])) and sum(p[1] for p in parts) <= 1024
        assert whole[s] == [i for p in parts for i in p[2]]
    assert packing.pack_documents(documents(spark, []), BYTES).count() == 0
