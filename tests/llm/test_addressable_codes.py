"""Token files against the tokenizer itself, and the codes against plain arrays."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshcat.llm import addressable_codes as ac
from freshcat.llm.block_ids import behind
from freshcat.llm.common import new_path
from freshcat.llm.queries import op13_token_files, vocabulary_path
from tests.conftest import SF_SMALL

TOKENIZER = vocabulary_path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, th int, part string, content binary"


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    return [[*e.ids, 2] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def codes(values):
    levels = ac.encode_codes(np.array(values, np.uint32))
    return ac.Codes(memoryview(b"".join(levels)), len(levels))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500), st.data())
def test_codes_give_every_value_and_run(values, data):
    c = codes(values)
    assert len(c) == len(values)
    assert c.run(0, len(values)).tolist() == values
    if values:
        a = data.draw(st.integers(0, len(values)))
        b = data.draw(st.integers(a, len(values)))
        assert c.run(a, b).tolist() == values[a:b]
        for i in {0, len(values) - 1, a % len(values)}:
            assert c[i] == values[i]
    with pytest.raises(IndexError):
        c[len(values)]


def test_long_codes_and_their_size():
    rng = np.random.default_rng(5)
    values = np.minimum(rng.zipf(1.3, 200_000), 50_256).astype(np.uint32)
    levels = ac.encode_codes(values)
    c = ac.Codes(memoryview(b"".join(levels)), len(levels))
    assert len(levels) > 1
    assert sum(map(len, levels)) < 2 * len(values)  # less than two bytes an id
    assert np.array_equal(c.run(0, len(values)), values)
    for i in rng.integers(0, len(values), 300).tolist():
        assert c[i] == values[i]
    for a in (0, 511, 512, 65_535, 65_536, 131_071):
        assert np.array_equal(c.run(a, a + 70_000), values[a:a + 70_000])


def test_widths_are_the_cheapest():
    def cost(values, widths):
        total, rest = 0, list(values)
        for k, w in enumerate(widths):
            total += len(rest) * (w + (1 + 32 / ac.BLOCK if k + 1 < len(widths) else 0))
            rest = [v >> w for v in rest if v >> w]
        return total

    def ways(bits):
        return [[]] if bits == 0 else [[w, *r] for w in range(1, bits + 1) for r in ways(bits - w)]

    rng = np.random.default_rng(3)
    for _ in range(10):
        values = np.minimum(rng.zipf(1.4, 300), 500).astype(np.uint32)
        top = int(values.max()).bit_length()
        assert cost(values.tolist(), ac.chunk_widths(values)) == pytest.approx(min(cost(values.tolist(), w) for w in ways(top)))


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a   b  ", "tab\tand\nline \n next", "a　b  c", "x\x1c y \x1f z", "don't can't we'll",
    "<|endoftext|>", "x  <|endoftext|>  y z", "emoji 😀😀 naïve", "汉字没有空格" * 40, "w" * 5000, "123 456,789", "  lead", "word " * 3000,
]


def check(rows, found):
    """Ids and counts by the tokenizer; starts without gaps in ascending id order."""
    want = sorted((d is not None, d or 0, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in zip([r[0] for r in rows], reference_ids([r[1] for r in rows]), strict=True))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == want
    at = 0
    ordered = sorted(found, key=lambda r: r.start)
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in ordered]
    assert keys == sorted(keys)


def test_files_of_odd_rows(spark):
    texts = ODD + ODD[3:9]
    rows = [(k if k % 5 else None, t, 1, "p", b"c") for k, t in enumerate(texts)] + [(7, "same", 1, "p", b"c")] * 40 + [(None, None, 1, "p", b"c")] * 40 + [(-5, "below zero", 1, "p", b"c")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = new_path(spark, "test-tokens")
    ac.write_token_files(docs, TOKENIZER, path, segment_tokens=50)
    found = ac.read_token_files(spark, path, keep_ids=True).collect()
    check(rows, found)
    by_crc = {zlib.crc32(np.array(i, "<u4").tobytes()): i for i in reference_ids([r[1] for r in rows])}
    assert all(r.ids == by_crc[r.ids_crc32] for r in found)


def test_one_id_read_from_a_file(spark):
    rows = [(k, f"some words {k} and {'more ' * k}") for k in range(60)]
    path = new_path(spark, "test-tokens")
    ac.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), TOKENIZER, path, segment_tokens=200)
    folder = path.removeprefix("file:")
    files = sorted(os.path.join(folder, f) for f in os.listdir(folder) if f.startswith("part-"))
    segments = sorted((ac.Segment(open(f, "rb").read()) for f in files), key=lambda s: (s.part, s.segment))
    ids = dict(zip([r[0] for r in rows], reference_ids([r[1] for r in rows]), strict=True))
    assert len(segments) > 3
    for s in segments:
        whole = [i for d in s.doc_ids for i in ids[d]]
        assert [s.codes[i] for i in range(s.tokens)] == whole
        assert [s.document(k).tolist() for k in range(len(s.doc_ids))] == [ids[d] for d in s.doc_ids]
    spoiled = bytearray(open(files[0], "rb").read())
    spoiled[ac.HEADER.size + 3] ^= 1
    with pytest.raises(ValueError):
        ac.Segment(bytes(spoiled))


def test_empty_table(spark):
    path = new_path(spark, "test-tokens")
    ac.write_token_files(spark.createDataFrame([], "doc_id long, text string"), TOKENIZER, path)
    assert ac.read_token_files(spark, path).collect() == []


def test_query_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check(rows, op13_token_files(spark, SF_SMALL).collect())


ALPHABET = st.text(alphabet=" \n\t'abzAZßéÀŸıİ.,!?-_#9１汉́　 \x1c\x85|<>", max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=30))
def test_block_ids_are_the_tokenizers_own(texts):
    """Byte-level ids by blocks (what one block remembers serves the next), and the packing
    operator's ids by words, against whole texts."""
    texts = texts + [f"{a} {b}\n{a}, {b}" for a, b in zip(texts, texts[1:], strict=False)]
    byte_level, by_words = both()
    want = [[*e.ids] for e in byte_level.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [r.tolist() for r in byte_level.texts([pa.array(texts, pa.string())])] == want
    want = [[*e.ids] for e in by_words.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(r, "<u4").tolist() for r in by_words.texts(texts)] == want


def test_a_worker_keeps_its_words_from_task_to_task(spark):
    docs = spark.createDataFrame([(k, f"one common word and {'own' * k}") for k in range(40)], "doc_id long, text string").repartition(8)
    ac.write_token_files(docs, TOKENIZER, new_path(spark, "test-tokens"))

    def held(batches):
        from freshcat.llm import addressable_codes as module

        words = {w for t in module._TOKENIZERS.values() for w in t.cores.place}
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(words & {"one", "common", "word", "and"})], pa.int64())], names=["n"])

    assert max(r.n for r in spark.range(8, numPartitions=8).mapInArrow(held, "n long").collect()) == 4


def test_words_of_a_block_go_through_the_tokenizer_once():
    """Also where nothing is remembered: six million bytes are two blocks of like size."""
    texts = [" ".join(chr(97 + k // 26) + chr(97 + k % 26) for k in range(600)) * 10] * 333
    tokenizer, calls = ac.ByteLevelIds(open(TOKENIZER, encoding="utf-8").read()), []
    tokenizer.remembered, encode = 0, tokenizer.encode_kind
    tokenizer.encode_kind = lambda kind, words: calls.append(len(words)) or encode(kind, words)
    want = tokenizer.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert all(r.tolist() == want for r in tokenizer.texts([pa.array(texts)]))
    assert sum(calls) == 2 * len(set(texts[0].split(" ")))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="aß汉", max_size=3), st.text(alphabet=".,", max_size=2)), max_size=12), st.integers(0, 3))
def test_what_is_behind_the_heads(parts, start):
    words, heads = pa.array([a + b for a, b in parts], pa.string()), pa.array([a for a, _ in parts], pa.string())
    assert behind(words.slice(start), heads.slice(start)).to_pylist() == [b for _, b in parts][start:]


def both(made=[]):  # noqa: B006
    from freshcat.llm.packing import WordIds

    if not made:
        made += [ac.ByteLevelIds(open(TOKENIZER, encoding="utf-8").read()), WordIds(open(vocabulary_path("word_bpe_49k.json"), encoding="utf-8").read())]
    return made
