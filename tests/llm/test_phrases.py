import re
from collections import Counter, defaultdict

import pytest
from llm_cases import DOCS, documents

from changeflow.llm import phrases

EXTRA = [
    (20 + i, t, lang, "s", 1)
    for i, (t, lang) in enumerate([
        ("new york city, New York City; new york.", "en"), ("in new york city in new york", "en"), ("a a a a a a", "en"), ("a a\ta a", None),
        ("x\ny\nx y", "fr"), ("über Über x y! x y? x y:", "fr"), ("x\x00y x\x00y z", "fr"), (",,;;..", "de"), ("q r s t u v q r s t u v", "de"), ("q r s t", "de"),
    ])
]


def brute(rows, least, top=phrases.TOP, most=phrases.WORDS):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, most + 1):
                f[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cands.items()):
                continue
            score, _, l, r = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


SMALL = [d for d in DOCS if d[0] not in (9, 10, 16)] + EXTRA


def mined(spark, rows, least, **options):
    found = phrases.mine(documents(spark, rows, clash=True), least=least, **options)
    return found, sorted(tuple(r) for r in phrases.top_phrases(found).collect())


def test_phrases_equal_brute_force(spark):
    _, got = mined(spark, SMALL, 2, one_in=2)
    assert got == brute(SMALL, 2) and len(got) > 20


@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_a_sample_that_proposes_nothing_changes_nothing(spark, monkeypatch, bits):
    """An empty sample, and a filter that is full or nearly so: failures of the border are counted by more passes."""
    monkeypatch.setattr(phrases, "FILTER_BITS", bits)
    found, got = mined(spark, SMALL[-14:], 2, one_in=1 << 40)
    assert got == brute(SMALL[-14:], 2)
    assert found.passes > (bits > 64)


def test_phrases_of_edge_tables(spark):
    assert mined(spark, [], 2)[1] == []
    assert mined(spark, [(1, None, None, None, None), (2, "", "en", "a", 0), (None, " . , ", "en", "a", 0)], 1)[1] == []
    long = [(1, " ".join(f"w{i % 50} v{i % 7}" for i in range(60_000)), "en", "a", 1)]
    assert mined(spark, long, 30)[1] == brute(long, 30)
