import hashlib
from collections import Counter

import numpy as np
import pytest

from freshcat.llm import suffix_dedup as S
from freshcat.llm.common import table

SCHEMA = "doc_id long, text string, kept string"


def brute(texts, length):
    """Removed bytes by looking up every window of every text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), dtype=bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        out.append((len(d), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), kept))
    return out


def made_texts():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdeé"), rng.integers(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, line = prose(60), prose(9)
    texts = [None, "", "x" * 39, "x" * 40, "short", prose(40)]
    for k in range(30):
        texts.append(prose(rng.integers(5, 40)) + passage[rng.integers(0, 30):] + prose(rng.integers(0, 40)))
        texts.append(prose(10) + "\n" + line + "\n" + prose(10))
    texts += [texts[7]] * 3 + [texts[9][:200] + "!" + texts[9][201:], "ab" * 300, "z" * 500, passage + passage, "\0" * 90 + prose(20)]
    return texts


@pytest.mark.parametrize("task_contexts", [50_000, 3])  # 3: common grams go window by window
def test_equals_brute_force(spark, task_contexts):
    texts = made_texts()
    docs = spark.createDataFrame([(None if i == 8 else i, t, "clash") for i, t in enumerate(texts)], SCHEMA)
    got = S.repeated_bytes(docs, length=40, gram=8, task_contexts=task_contexts)
    rows = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect())
    want = sorted((-1 if i == 8 else i, *x) for i, x in enumerate(brute(texts, 40)))
    assert rows == want
    assert sum(r[2] for r in rows) > 5000


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(80))
    twice = S.repeated_bytes(spark.createDataFrame([(1, text, ""), (1, text, "")], SCHEMA)).collect()
    assert [(r.n_removed, r.n_spans) for r in twice] == [(len(text), 1)] * 2
    assert S.repeated_bytes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text_is_cut_into_blocks_without_a_trace(monkeypatch):
    rng = np.random.default_rng(5)
    text = bytes(rng.integers(97, 105, 30_000).astype(np.uint8))
    whole = S.anchors([b"a" * 250, text])
    monkeypatch.setattr(S, "BLOCK", 1000)
    parts = S.anchors([b"a" * 250, text])
    key = lambda x: sorted(zip(*[a.tolist() for a in x]))
    assert key(whole) == key(parts)


def test_multikey_order_sorts_inside_groups():
    rng = np.random.default_rng(1)
    strings = rng.integers(0, 2, (500, 24)).astype(np.uint8)
    group = np.sort(rng.integers(0, 7, 500))
    order = S.multikey_order(group, strings)
    want = sorted(range(500), key=lambda i: (group[i], bytes(strings[i])))
    assert [bytes(strings[i]) for i in order] == [bytes(strings[i]) for i in want]
    lcp = S.neighbour_lcp(order, group, strings)
    for k in range(1, 500):
        a, b = order[k - 1], order[k]
        same = group[a] == group[b]
        n = next((i for i in range(24) if strings[a][i] != strings[b][i]), 24)
        assert lcp[k] == (n if same else -1)


def test_query_on_documents_equals_brute_force(spark):
    from freshcat.llm.queries import op6_suffix_dedup

    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents").orderBy("doc_id").collect()
    want = [(d.doc_id, n, r, s, hashlib.sha256(k).hexdigest()) for d, (n, r, s, k) in zip(docs, brute([d.text for d in docs], 200))]
    got = sorted(tuple(r) for r in op6_suffix_dedup(spark, folder).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == want
