import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import DOCS, documents

from changeflow.llm import divergence


def brute(rows, least):
    df, counts, groups = Counter(), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups.add((lang, source))
        df.update({(lang, t) for t in terms})
        counts[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in df.items() if x == lang and n >= least]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            best = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(best)[:50])):
                out += [(lang, s, part, item.decode(), -v, k + 1) for k, (v, item) in enumerate(found)]
    return sorted(out)


ROWS = DOCS + [(30 + i, " ".join(f"t{chr(97 + i * j % 23)} é{chr(97 + j)}" for j in range(i, 26)), ["en", "fr", None][i % 3], f"s{i % 4}", 1) for i in range(24)]


def audited(spark, rows, least):
    return sorted(tuple(r) for r in divergence.audit(documents(spark, rows, clash=True), least).collect())


@pytest.mark.parametrize("small", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, small):
    """Also with many shards, several broadcast sets and dense arrays that are handed on early."""
    if small:
        monkeypatch.setattr(divergence, "SHARD_CELLS", 64 * 5)
        monkeypatch.setattr(divergence, "BROADCAST_BYTES", 1 << 13)
        monkeypatch.setattr(divergence, "HELD_CELLS", 200)
        monkeypatch.setattr(divergence, "LEVELS", 2)
    got = audited(spark, ROWS, 3)
    assert got == brute(ROWS, 3) and len(got) > 100


def test_audit_without_terms(spark):
    assert audited(spark, [], 3) == []
    got = audited(spark, DOCS[3:8], 1000)
    assert got == brute(DOCS[3:8], 1000) and {r[4] for r in got} == {0}


def test_perfect_hash_is_minimal_and_verified():
    terms = pa.array([f"term{i}" for i in range(5000)], pa.large_string())
    digests = divergence.digests_of(terms)
    digests[4990:] = digests[4980]  # equal digests go to the list
    levels, order = divergence.build_levels(digests)
    bits = np.packbits(np.concatenate(levels)).tobytes()
    made = divergence.PerfectHash([len(b) for b in levels], bits, terms.take(pa.array(order)))
    slots = made.slots(digests, terms)
    assert sorted(slots.tolist()) == list(range(5000)) and len(made.rest) >= 10
    others = pa.array([f"other{i}" for i in range(5000)], pa.large_string())
    assert (made.slots(divergence.digests_of(others), others) == -1).all()
    assert (made.slots(digests, others) == -1).all()


def test_shares_are_exact():
    count = np.array([0, 5, 7, 2**52 - 1, 2**52], np.int64)
    total = np.array([3, 5, 9, 2**52 + 1, 2**53 - 1], np.int64)
    assert divergence.share(count, total).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(count, total)]
