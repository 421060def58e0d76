import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from freshcat.llm import simhash as S
from freshcat.llm.common import table
from freshcat.llm.components import components

SCHEMA = "doc_id long, text string, fp string, root string"


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(rows, bits=3):
    fps = [slow_fingerprint(t) for _, t in rows]
    own = list(range(len(rows)))

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= bits:
            own[find(a)] = find(b)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(k)] = min(i, ids.get(find(k), i))
    return sorted((str(i), f"{f:016x}", str(ids.get(find(k)))) for k, ((i, _), f) in enumerate(zip(rows, fps)))


def near_texts():
    rng = np.random.default_rng(9)
    base = [f"w{x}" for x in rng.integers(0, 5000, 600)]
    texts = [None, "", " \n", "One", "one", "one two", "A É b", "a É B", "x\x85y z"]
    for k in range(60):  # chains of near copies, changed at one more place each
        base = list(base)
        base[int(rng.integers(0, 600))] = f"n{k}"
        texts.append(" ".join(base))
    return texts + texts[9:12] * 3 + [" ".join(f"q{i}" for i in rng.integers(0, 99, 30)) for _ in range(40)]


@pytest.mark.parametrize("tile", [4096, 4])  # 4: groups are dealt into chunks
def test_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(S.near_links, "__defaults__", (S.MAX_BITS, tile))
    rows = [(None if k == 5 else k + 10, t) for k, t in enumerate(near_texts())]
    found = S.near_duplicates(spark.createDataFrame([(*r, "clash", "") for r in rows], SCHEMA)).collect()
    assert sorted((str(r.doc_id), f"{r.fp % 2**64:016x}", str(r.component_id)) for r in found) == slow_components(rows)


def test_query_equals_brute_force(spark):
    from freshcat.llm.queries import op7_simhash

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    got = op7_simhash(spark, folder).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == slow_components(rows)


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(3, text, "a", ""), (2, text, "b", ""), (2, text, "b", ""), (None, text, "c", ""), (None, "else where", "d", ""), (7, "other", "", "")], SCHEMA)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, [(2, text, "b", ""), (None, "else where", "d", ""), (7, "other", "", "")]))
    assert S.keep_one(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pivots_never_lose_a_pair():
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 2**64, 50, dtype=np.uint64)
    near = fps ^ (np.uint64(1) << rng.integers(0, 64, 50, dtype=np.uint64))
    assert (np.abs(S.pivot_table(fps).astype(int) - S.pivot_table(near)) <= 1).all()


def test_components_of_paths_hubs_and_repeats(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(500, i) for i in range(501, 900)] + [(1000, 1000), (1001, 1002), (1002, 1001), (1001, 1002)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 500 for i in range(500, 900)}, 1001: 1001, 1002: 1001}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
