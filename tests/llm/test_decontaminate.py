import re
from collections import Counter

import numpy as np
import pytest

from freshcat.llm import decontaminate as D
from freshcat.llm.common import table

DOCS = "doc_id long, text string, item_id string, similarity string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, similarity=0.8):
    """Every window of the item's size at every place, without any index."""
    found = set()
    for i, t in docs:
        w = words(t)
        for item, it in items:
            v = words(it)
            if not v or not w:
                continue
            k = min(5, len(v))
            want = shingles(v, k)
            best = 0
            for s in range(max(len(w) - len(v), 0) + 1):
                have = shingles(w[s:s + len(v)], k)
                both = sum((want & have).values())
                best = max(best, both / (sum(want.values()) + sum(have.values()) - both) if have else 0)
            if best >= similarity:
                found.add((str(i), item, round(best, 6)))
    return found


def made():
    rng = np.random.default_rng(12)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 3000, n)]
    items = [(k, " ".join(prose(int(rng.integers(14, 60))))) for k in range(12)] + [(50, "one two"), (51, ""), (52, None), (53, "echo " * 30)]
    items += [(60, items[0][1])]  # an equal item
    docs = [(0, None), (1, ""), (2, "One, TWO!"), (3, "echo " * 100), (None, items[1][1])]
    for k, (item, text) in enumerate(items[:12]):
        v = text.split()
        docs.append((100 + k, " ".join(prose(30)) + " " + text.upper().replace(" ", ",  ") + " " + " ".join(prose(20))))
        docs.append((200 + k, " ".join(prose(9) + v[:len(v) // 2] + ["new"] + v[len(v) // 2:] + prose(9))))
        docs.append((300 + k, " ".join(v[2:])))
        docs.append((400 + k, " ".join(prose(40) + v[:len(v) // 2] + prose(10))))
        docs.append((500 + k, " ".join(prose(20) + v[:-1])))
    return docs + [docs[5]] * 2 + [(900, "é " + docs[6][1])], items


@pytest.mark.parametrize("rows", [10**6, 0])  # broadcast or shuffled item tables: the same rows
def test_equals_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(D, "BROADCAST_ROWS", rows)
    docs, items = made()
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    got = D.contaminated(spark.createDataFrame([(*d, "", "") for d in docs], DOCS), bench).collect()
    assert {(str(r.doc_id), r.item_id, r.similarity) for r in got} == brute(docs, items)
    assert len(got) == len({(r.doc_id, r.item_id, r.th) for r in got})


def test_filter_keeps_clean_rows(spark):
    docs, items = made()
    df = spark.createDataFrame([(*d, "", "") for d in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    hit = {i for i, _, _ in brute(docs, items)}
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if str(i) not in hit)
    none, empty = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(none, bench).collect() == [] and D.contaminated(df, empty).collect() == []


def test_query_equals_brute_force(spark):
    from freshcat.llm.queries import op9_decontaminate

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, folder, "benchmark").select("item_id", "text").collect()]
    got = op9_decontaminate(spark, folder).collect()
    assert {(str(r.doc_id), r.item_id, r.similarity) for r in got} == brute(docs, items)


def test_fingerprint_bits(spark):
    import xxhash

    text = [["a b c", "d e", "a b c", "é"], ["x"]]
    got = D.fingerprints(spark.createDataFrame(list(enumerate(text)), "k int, shingles array<string>"), ["k"], "shingles").collect()
    for r in got:
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in text[r.k]]
        assert r.fp % 2**64 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("rows", [10**6, 0])
def test_reordered_items_in_other_text(spark, monkeypatch, rows):
    monkeypatch.setattr(D, "BROADCAST_ROWS", rows)
    rng = np.random.default_rng(15)
    prose = lambda n: [f"w{x}" for x in rng.integers(0, 10**6, n)]
    a, b, c = prose(30), prose(30), prose(59)
    echo = prose(12) * 3 + prose(14)  # shingles that occur three times
    items = [(1, " ".join(a + b)), (2, " ".join(c)), (3, " ".join(echo))]
    turned = [b + a, c[49:] + c[:49], a[20:] + b + a[:20], echo[12:] + echo[:12], echo[-14:] + echo[:-14], echo[24:36] + echo[:24] + echo[36:]]
    docs = []
    for k, v in enumerate(turned):
        docs += [(10 * k, " ".join(prose(40) + v + prose(25))), (10 * k + 1, " ".join(v)), (10 * k + 2, " ".join(prose(3) + v)), (10 * k + 3, " ".join(v + prose(70)))]
    docs += [(200, " ".join(prose(9) + b + prose(9) + a)), (None, docs[0][1]), (None, docs[0][1])]
    want = brute(docs, items)
    assert {i for _, i, _ in want} == {1, 2, 3} and {"0", "10"} <= {d for d, _, _ in want} and ("0", 1, round(52 / 60, 6)) in want
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(spark.createDataFrame([(*d, "", "") for d in docs], DOCS), bench).collect()
    assert {(str(r.doc_id), r.item_id, r.similarity) for r in got} == want
    assert len(got) == len(want)


def first_best(text, item):
    w, v = words(text), words(item)
    k = min(5, len(v))
    want, best = shingles(v, k), (0, 0)
    for s in range(max(len(w) - len(v), 0) + 1):
        have = shingles(w[s:s + len(v)], k)
        both = sum((want & have).values())
        best = max(best, (both / (sum(want.values()) + sum(have.values()) - both) if have else 0, -s))
    return -best[1]


def test_start_is_the_first_of_the_most_similar_windows(spark):
    docs, items = made()
    texts, by_item = {(str(i), D_hash(t)): t for i, t in docs}, dict(items)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contaminated(spark.createDataFrame([(*d, "", "") for d in docs], DOCS), bench).collect()
    assert got
    for r in got:
        assert r.start == first_best(texts[(str(r.doc_id), r.th)], by_item[r.item_id])


def D_hash(text):
    import xxhash

    h = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def test_an_item_of_sixty_thousand_equal_shingles(spark):
    item = "echo " * 60_000
    docs = spark.createDataFrame([(1, item, "", ""), (2, "echo " * 30_000, "", ""), (3, "echo " * 55_000, "", "")], DOCS)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {(r.doc_id, round(r.similarity, 6)) for r in D.contaminated(docs, items).collect()}
    assert got == {(1, 1.0), (3, round(54_996 / 59_996, 6))}
