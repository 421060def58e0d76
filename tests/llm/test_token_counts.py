import itertools

import pytest

from freshcat.llm import token_counts as T
from freshcat.llm.common import table
from freshcat.llm.queries import vocabulary_path

TEXTS = [None, "", " ", "   ", "Hello world", " two  spaces ", "line\nfeed", "é😀x", "aaaaaaaa", "ab" * 400, "<0x41> <s> x", "▁mark ▁", "日本 語", "the " * 500]


def exact(vocabulary, byte_fallback):
    """The tokenizer itself: an installed unigram model over the same vocabulary."""
    from tokenizers import Tokenizer, models, normalizers

    t = Tokenizer(models.Unigram(vocabulary, 0, byte_fallback))
    t.normalizer = normalizers.Sequence([normalizers.Prepend(T.SPACE), normalizers.Replace(" ", T.SPACE)])
    return lambda text: len(t.encode(text, add_special_tokens=False).ids) if text else 0


def paths(counter, text):
    """Best score over all ways to write a short text, by enumeration."""
    best = None
    for cuts in itertools.product([0, 1], repeat=max(len(text) - 1, 0)):
        pieces, start = [], 0
        for k, c in enumerate([*cuts, 1], 1):
            if c:
                pieces.append(text[start:k])
                start = k
        score = 0.0
        for p in pieces:
            if p in counter.scores:
                score += counter.scores[p]
            elif len(p) == 1:
                score += counter.unknown_score
            else:
                score = None
                break
        if score is not None and (best is None or score > best):
            best = score
    return best


def test_public_vocabulary_equals_the_tokenizer(spark):
    vocabulary = T.read_vocabulary(vocabulary_path("piece_bpe_32k.model"))
    count, counter = exact(vocabulary, True), T.UnigramCounter(vocabulary)
    assert counter.parts
    docs = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").select("text").collect()]
    for text in [t for t in TEXTS if t] + docs:
        got = counter.count(text)
        assert got[1] == count(text), text[:50]
        if len(text) < 3000:  # in parts or whole: the same
            assert got == counter.path(T.SPACE + text.replace(" ", T.SPACE))


@pytest.mark.parametrize("space", [True, False])
def test_small_vocabulary_ties_and_unknown_runs(space):
    vocabulary = [("<unk>", 0.0), ("a", -1.0), ("b", -2.0), ("ab", -3.0), ("ba", -3.0), ("aba", -4.0), ("bb", -4.0), ("b" + T.SPACE, -1.0)] + [(T.SPACE, -1.0)] * space
    count, counter = exact(vocabulary, False), T.UnigramCounter(vocabulary)
    for n in range(1, 7):
        for letters in itertools.product("abx ", repeat=n):
            text = "".join(letters)
            assert counter.count(text)[1] == count(text), text
            if n <= 5:
                assert counter.count(text)[0] == paths(counter, T.SPACE + text.replace(" ", T.SPACE))


def test_rows(spark):
    vocabulary = T.read_vocabulary(vocabulary_path("piece_bpe_32k.model"))
    docs = [(None if k == 4 else k, t, 1) for k, t in enumerate(TEXTS)] + [(5, TEXTS[5], 2)] * 2
    counter = T.UnigramCounter(vocabulary)
    got = T.count_tokens(spark.createDataFrame(docs, "doc_id long, text string, n_tokens int"), vocabulary).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.best_score) for r in got) == sorted((str(i), *counter.count(t or "")[::-1]) for i, t, _ in docs)
    assert T.count_tokens(spark.createDataFrame([], "doc_id long, text string"), vocabulary).collect() == []
