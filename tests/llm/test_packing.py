import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from freshcat.llm import packing as K
from freshcat.llm.common import table
from freshcat.llm.queries import vocabulary_path

SCHEMA = "doc_id long, text string, start string, length string"
PATH = vocabulary_path("word_bpe_49k.json")


def ids_of(text):
    from tokenizers import Tokenizer

    if not hasattr(ids_of, "t"):
        ids_of.t = Tokenizer.from_file(PATH)
    return ids_of.t.encode(text or "", add_special_tokens=False).ids + [2]


HARD = [None, "", " \n\t", "Hello  World's end", "naïve Ａ ﬁ İstanbul ΣΑΣ é", "a\x85b c\x1cd", "it's <|endoftext|>x<|startoftext|> y",
        "́ mark", "x" * 3000, "日本語 テキスト 12345", "word " * 9000, "😀😀 ok", "tab\tand\x0bfeed\x0c"]


def checked(rows, docs, window):
    """Every id in exactly one piece, sequences gapless and within the window."""
    want = Counter()
    for i, t in docs:
        ids = ids_of(t)
        for s in range(0, len(ids), window):
            part = ids[s:s + window]
            want[(i, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    return len(sequences)


@pytest.mark.parametrize("window,group", [(4096, 50_000), (64, 10)])
def test_hard_texts(spark, monkeypatch, window, group):
    monkeypatch.setattr(K, "CACHED_WORDS", 10 if window == 64 else K.CACHED_WORDS)
    docs = [(None if k == 4 else k, t) for k, t in enumerate(HARD)] + [(3, HARD[3]), (3, HARD[3])]
    df = spark.createDataFrame([(*d, "a", "b") for d in docs], SCHEMA)
    checked(K.pack_documents(df, PATH, window=window, group_pieces=group).collect(), docs, window)
    kept = K.pack_documents(df, PATH, window=window, keep_ids=True).where("doc_id = 3").first()
    assert kept.ids == ids_of(HARD[3])[:window]
    assert K.pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_query_and_padding(spark):
    from freshcat.llm.queries import op4_packing

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    rows = op4_packing(spark, folder).collect()
    n = checked(rows, docs, 4096)
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1


def test_best_fit_is_the_tightest_open_window():
    rng = np.random.default_rng(1)
    for _ in range(30):
        window = int(rng.integers(5, 200))
        lengths = rng.integers(1, window + 1, int(rng.integers(1, 120))).tolist()
        sequence, offset = K.best_fit_decreasing(lengths, window)
        used = []
        for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            rooms = [window - u for u in used if window - u >= lengths[k]]
            if not rooms:
                assert sequence[k] == len(used) and offset[k] == 0
                used.append(lengths[k])
            else:
                assert window - used[sequence[k]] == min(rooms) and offset[k] == used[sequence[k]]
                used[sequence[k]] += lengths[k]


def test_words_are_gathered_in_blocks():
    """Ids come by array operations over a block's distinct words, not word by word."""
    from freshcat.llm.block_ids import BlockIds

    words = K.WordIds(open(PATH, encoding="utf-8").read())
    assert isinstance(words, BlockIds)
    texts = [t or "" for t in HARD] + ["The end. the END, (the) end's \x1c end\x85the", " lead\r\n tail \x0b", "Ünï ünï! naïve<|endoftext|>..."] * 2
    for _ in range(2):  # again, with what the first pass remembered
        assert [r.tolist() + [2] for r in words.texts(texts)] == [ids_of(t) for t in texts]
    assert len(words.cores.place) <= K.CACHED_WORDS and list(words.texts([])) == []
