"""Brown class-based bigram model: exchange clustering of words, class transitions, word emissions.

P(word | before) = P(class | class before) * P(word | class). Both factors are smoothed: transitions
with the class frequencies, emissions by leaving the share of words seen once to unknown words, so that
the probabilities of all known words, one unknown word and the end add up to one after any history. An
unknown word is summed over classes and leaves the history as it was.

Texts are kept as blocks: documents of a task as codes into the block's own word list. Only word lists
are shuffled, one row per block and word, to count words over all documents and to bring counts and
classes back to the blocks. Classes come from the exchange algorithm. For a start, the most frequent words
(a fixed number, whose bigram counts over all training documents fit the driver) are exchanged one at
a time until no move raises the likelihood, and every other word takes the class that these neighbours say.
Then all training words are exchanged in ``ROUNDS`` rounds: blocks count the classes of each word's neighbours, all of them
classed, words are dealt to parts, and each takes its best move against the class bigrams of all documents. A round
that does not raise the likelihood is taken back and half as many words move at once, down to an eighth;
the rounds end earlier when no word moves or the likelihood stays still.

Defined results: a null text counts as empty and is scored on its end alone. Repeated rows are learnt and
scored row by row. Equal counts are ordered by word, equal moves by class number. Without training
documents every probability is one (score 0). An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, release, written
from .wordcodes import BLANK, raw, text_batches

#: Words that are exchanged one at a time, and classes besides that of the end.
FREQUENT = 512
CLASSES = 24
#: A rise of the likelihood below this, in nats a token, counts as still; the least share of words that move at once.
STILL = 1e-3
SHARE = 8
#: Rounds over all training words, like the epochs of any other training.
ROUNDS = 2
#: Words of a part, about.
PART = 1 << 15
#: Bytes of text in a block.
BLOCK = 12 << 20

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2


def packed(a: np.ndarray) -> bytes:
    return zstandard.compress(a.tobytes(), 1)


def unpacked(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), dtype)


def word_blocks(docs: DataFrame) -> DataFrame:
    """Blocks: documents with their lengths in words, codes of all words, and the block's words with training counts."""
    kind = dict(docs.dtypes)["doc_id"]

    def task(batches):
        part = TaskContext.get().partitionId()
        for number, (batch, texts) in enumerate(text_batches(batches, limit=BLOCK)):
            data, offsets = raw(texts)
            blank = BLANK[data]
            begins = ~blank
            begins[1:] &= blank[:-1]
            begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = ~blank[offsets[:-1][offsets[:-1] < offsets[1:]]]
            starts = np.flatnonzero(begins)
            lengths = np.diff(np.searchsorted(starts, offsets))
            solid = np.cumsum(~blank) if len(data) else np.zeros(0, np.int64)
            ends = np.append(solid[starts] - 1, solid[-1] if len(solid) else 0).astype(np.int64)
            letters = FOLD[data[~blank]]
            words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(letters.tobytes())).dictionary_encode()
            codes = words.indices.to_numpy().astype(np.int32)
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            learnt = np.repeat(~held, lengths)
            counts = np.bincount(codes[learnt], minlength=len(words.dictionary))
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([part * (1 << 32) + number], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), batch.column(0)),
                "held": pa.array([packed(held)], pa.binary()),
                "lengths": pa.array([packed(lengths.astype(np.int32))], pa.binary()),
                "codes": pa.array([packed(codes)], pa.binary()),
                "learnt_docs": pa.array([int((~held).sum())], pa.int64()),
                "words": pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), words.dictionary.cast(pa.string())),
                "counts": pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.array(counts)),
            })

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), held_out().alias("held"))
    return rows.mapInArrow(task, f"block long, doc_ids array<{kind}>, held binary, lengths binary, codes binary, learnt_docs long, words array<string>, counts array<long>")


def running(values: np.ndarray, lengths: np.ndarray, end: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents in ``which`` as one sequence, each followed by ``end``; and where each document's part starts."""
    keep = np.repeat(which, lengths)
    n = lengths[which]
    starts = np.cumsum(n + 1) - (n + 1)
    out = np.full(int((n + 1).sum()), end, np.int64)
    out[np.arange(int(n.sum())) + np.repeat(np.arange(len(n)), n)] = values[keep]
    return out, starts


def codes_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return unpacked(row["codes"], np.int32), unpacked(row["lengths"], np.int32).astype(np.int64), unpacked(row["held"], bool)


def bigram_counts(blocks: DataFrame, frequent: list[str]) -> np.ndarray:
    """Counts of neighbours among the frequent words, all other words (one row) and the end, over all training documents."""
    k = len(frequent)

    def task(batches):
        listed = pa.array(frequent, pa.string())
        for batch in batches:
            for row in batch.to_pylist():
                codes, lengths, held = codes_of(row)
                ids = pc.fill_null(pc.index_in(pa.array(row["words"], pa.string()), value_set=listed), k).to_numpy(zero_copy_only=False)
                seq, _ = running(ids[codes] if len(codes) else codes, lengths, k + 1, ~held)
                if len(seq):
                    cells = np.bincount(np.append(k + 1, seq[:-1]) * (k + 2) + seq, minlength=(k + 2) ** 2)
                    at = np.flatnonzero(cells)
                    yield pa.RecordBatch.from_pydict({"cell": pa.array(at.astype(np.int32)), "n": pa.array(cells[at])})

    rows = blocks.select("held", "lengths", "codes", "words").mapInArrow(task, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = rows.toArrow()  # at most (FREQUENT + 2) squared rows
    out = np.zeros((k + 2) ** 2)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out.reshape(k + 2, k + 2)


def entropy_term(a: np.ndarray) -> np.ndarray:
    return a * np.log(np.maximum(a, 1))


def exchange(counts: np.ndarray, classes: int = CLASSES, sweeps: int = 20) -> np.ndarray:
    """Classes of the frequent words by the exchange algorithm; words come most frequent first.

    The last two rows of ``counts`` (other words, the end) are fixed context classes. A word moves to the
    class that raises the class bigram likelihood most: sums of n log n over class pairs, less those over classes twice.
    """
    k = len(counts) - 2
    classes = max(1, min(classes, k))
    of = np.append(np.arange(k) % classes, [classes, classes + 1])
    c = classes + 2
    member = np.zeros((k + 2, c))
    member[np.arange(k + 2), of] = 1
    grid = member.T @ counts @ member
    for _ in range(sweeps):
        moved = 0
        for w in range(k):
            a = of[w]
            right, left, own = counts[w] @ member, counts[:, w] @ member, counts[w, w]
            right[a] -= own
            left[a] -= own
            # The grid without the word, then the gain of putting it into each class.
            grid[a] -= right
            grid[:, a] -= left
            grid[a, a] -= own
            to = np.arange(classes)
            gain = (entropy_term(grid[to] + right) - entropy_term(grid[to])).sum(1) + (entropy_term(grid[:, to] + left[:, None]) - entropy_term(grid[:, to])).sum(0)
            d = grid[to, to]
            gain += entropy_term(d + right[to] + left[to] + own) - entropy_term(d + right[to]) - entropy_term(d + left[to]) + entropy_term(d)
            for axis, n in ((1, right.sum() + own), (0, left.sum() + own)):
                total = grid.sum(axis)[to]
                gain -= entropy_term(total + n) - entropy_term(total)
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = a
            grid[b] += right
            grid[:, b] += left
            grid[b, b] += own
            if b != a:
                member[w, a], member[w, b], of[w] = 0, 1, b
                moved += 1
        if not moved:
            break
    return of[:k]


def assign_rest(blocks: DataFrame, frequent: list[str], of: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(word, class) of every other training word: one exchange move given the classes of its neighbours."""
    k = len(frequent)
    c = int(of.max()) + 1
    class_of = np.append(of, [-1, c])  # other words say nothing, the end is a class

    def votes(batches):
        listed = pa.array(frequent, pa.string())
        for batch in batches:
            for row in batch.to_pylist():
                codes, lengths, held = codes_of(row)
                words = pa.array(row["words"], pa.string())
                ids = pc.fill_null(pc.index_in(words, value_set=listed), k).to_numpy(zero_copy_only=False)
                if not len(codes):
                    continue
                seq, _ = running(codes, lengths, len(words), ~held)
                ids = np.append(ids, k + 1)
                kinds, rest = class_of[ids[seq]], ids[seq] == k
                before = np.append(c, kinds[:-1])
                after = np.append(kinds[1:], -1)
                one, two = rest & (before >= 0), rest & (after >= 0)
                keys = np.concatenate([seq[one] * (2 * c + 2) + before[one], seq[two] * (2 * c + 2) + c + 1 + after[two]])
                keys, n = np.unique(keys, return_counts=True)
                if len(keys):
                    yield pa.RecordBatch.from_pydict({"word": words.take(pa.array(keys // (2 * c + 2))), "side": pa.array((keys % (2 * c + 2)).astype(np.int32)), "n": pa.array(n)})

    # What a neighbour on either side says for each class, from the frequent words: log of the observed over the independent.
    member = np.zeros((k + 2, c + 1))
    member[np.arange(k), of] = 1
    member[k + 1, c] = 1
    grid = member.T @ counts @ member + 0.5
    worth = np.log(grid) - np.log(grid.sum(1, keepdims=True)) - np.log(grid.sum(0, keepdims=True)) + np.log(grid.sum())
    table = np.concatenate([worth[:, :c], worth[:c, :].T])  # rows: neighbour before, neighbour after

    def choose(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            flat = lists.flatten()
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            gain = table[flat.field(0).to_numpy()] * flat.field(1).to_numpy()[:, None]
            best = np.add.reduceat(gain, np.append(0, ends[:-1]), axis=0).argmax(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best.astype(np.int32))], names=["word", "class"])

    rows = blocks.select("held", "lengths", "codes", "words").mapInArrow(votes, "word string, side int, n long")
    rows = rows.groupBy("word", "side").agg(F.sum("n").alias("n"))
    rows = rows.groupBy("word").agg(F.collect_list(F.struct("side", "n")).alias("votes"))  # at most two per class
    return rows.mapInArrow(choose, "word string, class int")


def likelihood(grid: np.ndarray) -> float:
    """The class bigram likelihood, but for what no move changes."""
    return float(entropy_term(grid).sum() - entropy_term(grid.sum(0)).sum() - entropy_term(grid.sum(1)).sum())


def gains(grid: np.ndarray, of: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """What the likelihood gains when words, taken out of their classes ``of``, are put into each class but the last (the end).

    ``sides``: for each word its counts by class before it, by class after it (both without itself) and next to itself.
    """
    c, n, at = len(grid), len(of), np.arange(len(of))
    before, after, own = sides[:, :c].astype(float), sides[:, c:2 * c].astype(float), sides[:, 2 * c].astype(float)
    gain = np.zeros((n, c - 1))
    for g, mine, other in ((grid, after, before), (grid.T, before, after)):
        w, j = np.nonzero(mine)
        count, a = mine[w, j], of[w]
        inner = j == a
        # But for neighbours of the word's own class, a term depends on both classes and the count alone: few of them differ.
        _, first, same = np.unique((count * c + j) * c + a, return_index=True, return_inverse=True)
        apart = np.flatnonzero(inner)
        rows = np.append(first, apart)
        cell = g[:-1, j[rows]].T.copy()  # the grid without the word
        cell[np.arange(len(rows)), a[rows]] -= count[rows]
        mine_too = np.arange(len(first), len(rows))
        cell[mine_too] -= other[w[apart], :-1]
        cell[mine_too, a[apart]] -= own[w[apart]]
        term = entropy_term(cell + count[rows][:, None]) - entropy_term(cell)
        same[apart] = mine_too
        term = term[same]
        first = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if len(w) else w
        gain[w[first]] += np.add.reduceat(term, first, axis=0) if len(w) else 0
        total = np.tile(g.sum(1)[:-1], (n, 1))  # whatever the class, it is next to the same words
        size = mine.sum(1) + own
        total[at, of] -= size
        gain -= entropy_term(total + size[:, None]) - entropy_term(total)
    d = np.tile(np.diag(grid)[:-1], (n, 1))
    d[at, of] -= before[at, of] + after[at, of] + own
    right, left = after[:, :-1], before[:, :-1]
    return gain + entropy_term(d + right + left + own[:, None]) - entropy_term(d + right) - entropy_term(d + left) + entropy_term(d)


def different_rows(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of ``a``, and which of them each row is: by a hash of 64 bits, whose collisions are looked for."""
    weights = np.random.default_rng(0).integers(1, 1 << 62, a.shape[1]) | 1
    _, first, which = np.unique(a @ weights, return_index=True, return_inverse=True)
    if len(a) and not (a[first][which] == a).all():
        kinds, which = np.unique(a, axis=0, return_inverse=True)
        return kinds, which.ravel()
    return a[first], which


def best_moves(grid: np.ndarray, of: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """The class of each word after its best move; words alike in class and counts are looked at once."""
    kinds, which = different_rows(np.concatenate([sides, of[:, None]], 1))
    best = np.zeros(len(kinds), np.int64)
    for a in range(0, len(kinds), 2048):
        some = kinds[a:a + 2048]
        now, gain = some[:, -1], gains(grid, some[:, -1], some[:, :-1])
        to = gain.argmax(1)
        at = np.arange(len(some))
        best[a:a + 2048] = np.where(gain[at, to] > gain[at, now] + 1e-9, to, now)
    return best[which]


LINKS = "part int, block long, codes binary, ids binary, classes binary, counts binary, moved long"


def deal_words(listed: DataFrame, named: DataFrame, parts: int) -> DataFrame:
    """Training words dealt to parts: a row for each block of a part (the block's codes, their numbers in the part, classes and counts), and block -1 with all."""

    def deal(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        words = table["word"].combine_chunks().dictionary_encode()
        words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
        order = pc.sort_indices(words.dictionary).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ids = rank[words.indices.to_numpy()].astype(np.int32)
        block, code, kind, n = (table[c].to_numpy() for c in ("block", "code", "class", "n"))
        all_, total = np.zeros(len(order), np.uint8), np.zeros(len(order), np.int64)
        all_[ids], total[ids] = kind, n
        by = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(block[by]) != 0))
        out = [(int(block[i[0]]), packed(code[i].astype(np.int32)), packed(ids[i]), packed(all_[ids[i]]), packed(total[ids[i]])) for i in np.split(by, cuts[1:])]
        out.append((-1, None, None, packed(all_), packed(total)))
        kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        columns = {n: pa.array(list(v), t) for n, v, t in zip(("block", "codes", "ids", "classes", "counts"), zip(*out), kinds)}
        return pa.table({"part": pa.array([key[0].as_py()] * len(out), pa.int32())} | columns | {"moved": pa.array([0] * len(out), pa.int64())})

    rows = listed.select("block", "code", "word").join(named.select("word", "class", "n"), "word")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int"))
    return rows.groupBy("part").applyInArrow(deal, LINKS)


def neighbour_counts(blocks: DataFrame, links: DataFrame, c: int) -> DataFrame:
    """For each block and part: words, sides and counts of neighbours by class; on a block's first row the class bigrams."""
    width = 2 * c + 1

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"part": [], "ids": [], "sides": [], "n": [], "cells": []}
        if left.num_rows and right.num_rows:
            row = left.to_pylist()[0]
            codes, lengths, held = codes_of(row)
            end = row["n_listed"]
            kind, part, number = np.full(end + 1, c - 1), np.full(end + 1, -1), np.zeros(end + 1, np.int64)
            for r in right.to_pylist():
                at = unpacked(r["codes"], np.int32)
                kind[at], part[at], number[at] = unpacked(r["classes"], np.uint8), r["part"], unpacked(r["ids"], np.int32)
            # Words are numbered by part, so that sorted keys come part by part.
            order = np.append(np.argsort(part[:-1].astype(np.int32), kind="stable"), end)
            place = np.empty(end + 1, np.int64)
            place[order] = np.arange(end + 1)
            kind, part, number = kind[order], part[order], number[order]
            seq, _ = running(place[codes], lengths, end, ~held)
            last = np.append(end, seq[:-1]) if len(seq) else seq
            cells = np.bincount(kind[last] * c + kind[seq], minlength=c * c)
            same = (last == seq) & (seq != end)
            one, two = (seq != end) & ~same, (last != end) & ~same
            keys = np.concatenate([seq[one] * width + kind[last[one]], last[two] * width + c + kind[seq[two]], seq[same] * width + 2 * c])
            if end * width <= 1 << 23:
                n = np.bincount(keys)
                keys = np.flatnonzero(n)
                n = n[keys]
            else:
                keys, n = np.unique(keys, return_counts=True)
            word, side = keys // width, keys % width
            of_part = part[word]
            cuts = np.flatnonzero(np.append(True, of_part[1:] != of_part[:-1])) if len(word) else word
            for i in map(slice, cuts, np.append(cuts[1:], len(word))):
                out["part"].append(int(of_part[i.start]))
                out["ids"].append(packed(number[word[i]].astype(np.int32)))
                out["sides"].append(packed(side[i].astype(np.uint8)))
                out["n"].append(packed(n[i].astype(np.int32)))
                out["cells"].append(None if out["cells"] else cells.tolist())
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    left = blocks.select("block", "held", "lengths", "codes", F.size("words").alias("n_listed"))
    right = links.where("block >= 0").select(F.col("block").alias("of_block"), "part", "codes", "ids", "classes")
    return left.groupBy("block").cogroup(right.groupBy("of_block")).applyInArrow(count, "part int, ids binary, sides binary, n binary, cells array<long>")


def summed_cells(rows: DataFrame, c: int) -> np.ndarray:
    grid = np.zeros(c * c)
    for r in rows.select(F.posexplode("cells").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n")).collect():  # a row per class pair
        grid[r["cell"]] = r["n"]
    return grid.reshape(c, c)


def moved_words(said: DataFrame, links: DataFrame, grid: np.ndarray, share: int, turn: int) -> DataFrame:
    """The links after the best moves of one in ``share`` words."""
    width = 2 * len(grid) + 1

    def choose(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = right.to_pylist()
        of = unpacked(next(r["classes"] for r in rows if r["block"] < 0), np.uint8).astype(np.int64)
        sides = np.zeros(len(of) * width, np.int64)
        for r in left.to_pylist():
            sides[unpacked(r["ids"], np.int32).astype(np.int64) * width + unpacked(r["sides"], np.uint8)] += unpacked(r["n"], np.int32)
        new = of.copy()
        mine = (np.arange(len(of)) + turn) % share == 0
        new[mine] = best_moves(grid, of[mine], sides.reshape(-1, width)[mine])
        moved, new = int((new != of).sum()), new.astype(np.uint8)
        classes = [packed(new if r["block"] < 0 else new[unpacked(r["ids"], np.int32)]) for r in rows]
        return pa.table({n: right[n] for n in ("part", "block", "codes", "ids")} | {"classes": pa.array(classes, pa.binary()), "counts": right["counts"], "moved": pa.array([moved * (r["block"] < 0) for r in rows], pa.int64())})

    left = said.select(F.col("part").alias("of_part"), "ids", "sides", "n")
    return left.groupBy("of_part").cogroup(links.select("part", "block", "codes", "ids", "classes", "counts").groupBy("part")).applyInArrow(choose, LINKS)


def exchanged(blocks: DataFrame, listed: DataFrame, named: DataFrame, c: int, types: int, tokens: int, rounds: int) -> DataFrame:
    """The links of all training words after ``rounds`` rounds of exchange moves from the classes in ``named``; ``c`` counts the end.

    Two generations of links and counts are kept at most.
    """
    links = written(deal_words(listed, named, -(-types // PART)), "links")
    share, turn, best = 1, 0, None
    # Each turn looks at what the last round did; the one after the last round only looks.
    while share <= SHARE and turn <= rounds:
        said = written(neighbour_counts(blocks, links, c), "said")
        grid = summed_cells(said, c)
        now = likelihood(grid)
        if best is not None and now <= best[0]:
            share *= 2
            discard(links)
            discard(said)
        else:
            still = best is not None and now - best[0] < STILL * tokens
            for old in best[1:3] if best is not None else ():
                discard(old)
            best = (now, links, said, grid)
            if still:
                break
        turn += 1
        if turn > rounds:
            break
        links = written(moved_words(best[2], best[1], best[3], share, turn), "links")
        release(blocks.sparkSession)
        if share == 1 and not links.agg(F.sum("moved")).first()[0]:
            break
    discard(best[2])
    return best[1]


def class_sums(links: DataFrame, c: int) -> tuple[np.ndarray, np.ndarray]:
    """For each class the occurrences of its words, and its words seen once."""

    def task(batches):
        for batch in batches:
            for kinds, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kinds, counts = unpacked(kinds, np.uint8), unpacked(counts, np.int64)
                n = np.zeros(c, np.int64)
                np.add.at(n, kinds, counts)
                yield pa.RecordBatch.from_pydict({"class": pa.array(np.arange(c, dtype=np.int32)), "n": pa.array(n), "once": pa.array(np.bincount(kinds[counts == 1], minlength=c).astype(np.int64))})

    mass, once = np.zeros(c), np.zeros(c)
    rows = links.where("block < 0").select("classes", "counts").mapInArrow(task, "class int, n long, once long")
    for r in rows.groupBy("class").agg(F.sum("n").alias("n"), F.sum("once").alias("once")).collect():  # a row per class
        mass[r["class"]], once[r["class"]] = r["n"], r["once"]
    return mass, once


def score(docs: DataFrame, frequent: int = FREQUENT, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each whole text (log10)."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    blocks = written(word_blocks(docs), "blocks")
    listed = blocks.select("block", F.posexplode(F.arrays_zip("words", "counts")).alias("code", "w")).select("block", "code", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    counted = written(listed.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")), "words")
    n_words, n_types = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_ends = blocks.agg(F.coalesce(F.sum("learnt_docs"), F.lit(0))).first()[0]
    total, types = n_words + n_ends, n_types + (n_ends > 0)

    top = [r["word"] for r in counted.orderBy(F.desc("n"), "word").limit(frequent).collect()]
    if top:
        pairs = bigram_counts(blocks, top)
        of = exchange(pairs, classes)
        rest = assign_rest(blocks, top, of, pairs)
        # Words without a frequent neighbour join the largest class.
        largest = int(np.bincount(of, weights=pairs[: len(top)].sum(1)).argmax())
        known = spark.createDataFrame([(w, int(c)) for w, c in zip(top, of)], "word string, class int")
        named = counted.join(rest.unionByName(known), "word", "left").select("word", "n", F.coalesce("class", F.lit(largest)).alias("class"))
        end = int(of.max()) + 1
        named = written(named, "seeds")
        release(spark)
        links = exchanged(blocks, listed, named, end + 1, n_types, total, rounds)
        discard(named)
    else:
        links, end = spark.createDataFrame([], LINKS), 0
    mass, once = class_sums(links, end + 1)

    # Counts and classes go back to the word list of each block.
    back = links.where("block >= 0").select(F.col("block").alias("of_block"), "codes", "classes", "counts")

    def with_model(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        codes, lengths, held = codes_of(row)
        n, cls = np.zeros(row["n_listed"] + 1, np.int64), np.full(row["n_listed"] + 1, 255, np.uint8)
        for r in right.to_pylist():
            at = unpacked(r["codes"], np.int32)
            n[at], cls[at] = unpacked(r["counts"], np.int64), unpacked(r["classes"], np.uint8)
        seq, _ = running(cls[codes] if len(codes) else codes, lengths, end, ~held)
        cells = np.bincount(np.append(end, seq[:-1]) * (end + 1) + seq, minlength=(end + 1) ** 2) if len(seq) else np.zeros((end + 1) ** 2, np.int64)
        out = {c: left[c] for c in ("block", "doc_ids", "held", "lengths", "codes")}
        return pa.table(out | {"n": pa.array([packed(n)], pa.binary()), "class": pa.array([packed(cls)], pa.binary()), "cells": pa.array([cells.tolist()], pa.list_(pa.int64()))})

    left = blocks.select("block", "doc_ids", "held", "lengths", "codes", F.size("words").alias("n_listed"))
    ready = left.groupBy("block").cogroup(back.groupBy("of_block")).applyInArrow(with_model, f"block long, doc_ids array<{kind}>, held binary, lengths binary, codes binary, n binary, class binary, cells array<long>")
    ready = written(ready, "ready")
    release(spark)
    grid = summed_cells(ready, end + 1)
    mass[end] = n_ends
    share = (mass + 1) / (mass.sum() + end + 1)
    step = (grid + (end + 1) * share) / (grid.sum(1, keepdims=True) + end + 1)
    spare = (once + 0.5) / (mass + 1)  # of each class, for words never seen
    spare[end] = 0.0
    log_step, log_unknown = np.log10(step), np.log10(np.maximum(step @ spare, 1e-300))
    log_known = np.log10(1 - spare) - np.log10(np.maximum(mass, 1))

    def scored(batches):
        for batch in batches:
            for row in batch.to_pylist():
                codes, lengths, held = codes_of(row)
                n, cls = unpacked(row["n"], np.int64), unpacked(row["class"], np.uint8).astype(np.int64)
                n, cls = np.append(n[:-1], n_ends), np.append(cls[:-1], end if n_ends else 255)
                every = np.ones(len(lengths), bool)
                seq, starts = running(codes, lengths, len(n) - 1, every)
                count, kinds = n[seq], cls[seq]
                known = count > 0
                # The history is the class of the last known token, the end at the start of a document.
                first = np.zeros(len(seq), bool)
                first[starts] = True
                source = np.where(np.append(True, known[:-1]) | first, np.arange(len(seq)), 0)
                source = np.maximum.accumulate(source)
                history = np.where(first[source], end, kinds[source - 1])
                kinds = np.where(known, kinds, end)
                model = np.where(known, log_step[history, kinds] + log_known[kinds] + np.log10(np.maximum(count, 1)), log_unknown[history]) if total else np.zeros(len(seq))
                base = np.log10((count + 1) / (total + types + 1))
                out = {"doc_id": row["doc_ids"], "held_out": held, "n_tokens": lengths + 1}
                out |= {"n_known": np.add.reduceat(known.astype(np.int64), starts), "train_tokens": np.full(len(starts), total)}
                out |= {"base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(model, starts)}
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in out.items()}, schema=schema)

    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = pa.schema([("doc_id", arrow), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    return ready.drop("cells").mapInArrow(scored, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
