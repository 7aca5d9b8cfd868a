import pytest

from changeflow.llm import url_filter
from changeflow.llm.url_filter import ALLOW, BLOCK, LISTED

URLS = [
    (1, "http://Example.org/es/1"), (2, "https://a.example.org/en/12?x#y"), (3, "http://example.org/en/2"), (4, "http://notexample.org/es/"),
    (5, "http://example.com/de/1"), (6, "http://x.com/fr/"), (7, "http://x.com/it"), (8, "http://spam.example.net/a"), (9, "http://www.spam.example.net"),
    (10, None), (11, ""), (12, "example.org/es/"), (13, "://"), (14, "http://org#a?b"), (15, "http://org?b/es/"), (16, "http://spam.example.org/"),
    (17, "a://b.example.org/es/?u=http://x.com/de/"), (18, "http://" + "a." * 3000 + "com/de/" + "y" * 5000), (19, "http://..example.org./es/"),
    (20, "http://é日.com/de/\n"), (1, "http://Example.org/es/1"), (None, "http://x.com/de/"), (None, None),
]
RULES = [*url_filter.RULES, ("spam.example.net", "", LISTED), ("org", "/es/", ALLOW), ("dup.net", "/a", ALLOW), ("dup.net", "/a", BLOCK), ("", "/", BLOCK)]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    rest = rest.split("#")[0].split("?")[0]
    host, slash, path = rest.partition("/")
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = slash + path
    fits = [(len(h + p), len(h), k, h + p) for h, p, k in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    named = [f for f in fits if f[2] != LISTED]
    if named:
        best = max(named)
        return host, path, best[3], "allow" if best[2] == ALLOW else "block"
    return host, path, None, "block" if fits else "allow"


def pages(spark, rows=URLS):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string")
    return df.withColumns({n: F.lit("extra") for n in ("host", "path", "rule", "kind", "entry", "html")})


def index(spark, rules, **options):
    return url_filter.build_index(spark.createDataFrame(rules, "host string, path string, kind int"), **options)


@pytest.mark.parametrize("dealt", [False, True])
def test_verdicts_equal_brute_force(spark, monkeypatch, dealt):
    made = index(spark, RULES, shard_entries=4)
    if dealt:
        monkeypatch.setattr(url_filter, "MAPPED_BYTES", 0)
    got = sorted((tuple(r) for r in url_filter.judge(pages(spark), made).collect()), key=repr)
    assert got == sorted(((i, *brute(u, RULES)) for i, u in URLS), key=repr)
    assert url_filter.judge(pages(spark, []), made).count() == 0


def test_empty_index_allows(spark):
    made = index(spark, [])
    assert {r["verdict"] for r in url_filter.judge(pages(spark), made).collect()} == {"allow"}


def test_equal_digests_are_told_apart():
    """Entries of one digest: the stored strings decide."""
    import numpy as np
    import pyarrow as pa

    table = pa.table({"digest": pa.array([3, 7, 7, 7, 9], pa.uint64()), "entry": pa.array(["x", "a", "b", "c", "d"], pa.large_string()), "kind": pa.array([1, 0, 1, 2, 3], pa.int8())})
    shard = url_filter.Shard(table.replace_schema_metadata({"shard": "0"}))
    asked = ["c", "z", "a", "d", "x", "q"]
    assert shard.find(np.array([7, 7, 7, 9, 3, 11], np.uint64), asked) == [[2], [], [0], [3], [1], []]


def test_shards_of_one_file_are_told_apart():
    import numpy as np
    import pyarrow as pa

    sizes = [*range(1, 40), 500]
    blobs = [url_filter.shard_bytes(n, np.arange(n, dtype=np.uint64), pa.array(["x" * k for k in range(n)]), np.zeros(n)) for n in sizes]
    got = url_filter.read_shards(pa.BufferReader(b"".join(b + b"\n" for b in blobs)))
    assert [(s.number, len(s.entries)) for s in got] == [(n, n) for n in sizes]
    assert [s.number for b in blobs for s in url_filter.read_shards(pa.BufferReader(b))] == sizes


def test_digests_are_those_of_spark(spark):
    import xxhash
    from pyspark.sql import functions as F

    texts = ["", "a", "example.org/es/", "é日" * 40]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()]
    assert [g % (1 << 64) for g in got] == [xxhash.xxh64_intdigest(t.encode(), url_filter.SEED) for t in texts]
