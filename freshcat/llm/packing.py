"""Token windows packed best-fit decreasing.

A document's ids are cut into full windows and a remainder; remainders are packed longest
first, each into the open window with the least room that still takes it, found by a segment
tree indexed by remaining capacity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshcat.llm.block_ids import BlockIds, packed
from freshcat.llm.common import id_text, ship_package, stage

WINDOW = 4096
#: Remainders packed together by one task.
GROUP_PIECES = 50_000
#: Words that a Python worker remembers: some 50 MB, kept from task to task.
CACHED_WORDS = 250_000
#: Words of letters that are encoded in lower case, many in one call.
LETTERED = "\\A[A-Za-zÀ-ÖØ-öø-ÿ]+\\z"

_TOKENIZERS: dict[int, WordIds] = {}


class WordIds(BlockIds):
    """Token ids of texts.

    The tokenizer's pre-tokenization never joins what ASCII white space parts, so the ids of
    a text are the ids of its words one after another. It parts letters from other signs and
    lower-cases, so a word of letters below U+0100 is encoded in lower case without its final
    punctuation, many such words in one call: a token that ends a word ends its ids.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.remembered = CACHED_WORDS
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # the same model for words that are already lower-cased single words
        self.lettered = Tokenizer.from_str(tokenizer_json)
        self.lettered.normalizer = None
        self.lettered.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends[i] = token.endswith("</w>")

    def words(self, texts: pa.Array) -> pa.ListArray:
        """Words are what ASCII white space parts (an empty one at either end has no ids)."""
        return pc.ascii_split_whitespace(texts)

    def is_core(self, words: pa.Array) -> pa.Array:
        return pc.match_substring_regex(words, LETTERED)

    def kinds(self, words: pa.Array) -> np.ndarray:
        """1: words of letters below U+0100, 0: others."""
        return pc.match_substring_regex(words, LETTERED).to_numpy(zero_copy_only=False).astype(np.int8)

    def encode_kind(self, kind: int, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.lower_case(words) if kind else self.each(words)

    def each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return packed([np.array(e.ids, np.uint32) for e in found])

    def lower_case(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.lettered.encode_batch_fast([" ".join(words).lower()], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not end words with </w>")
        return ids, np.diff(ends, prepend=0)

    def encode_tails(self, tails: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self.each(tails)

    def texts(self, texts: Iterable[pa.Array] | list[str]) -> Iterator[np.ndarray]:
        """Ids of each text (unsigned 32-bit), from arrays of texts or a list of texts."""
        texts = list(texts)
        return super().texts([pa.array(texts, pa.string())] if texts and isinstance(texts[0], str) else texts)


def _word_ids(key: int, tokenizer_json) -> WordIds:
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordIds(tokenizer_json.value)
    return _TOKENIZERS[key]


def cut(tokens: int, window: int) -> list[tuple[int, int]]:
    """(start, length): full windows from the start, then the remainder."""
    return [(s, min(window, tokens - s)) for s in range(0, tokens, window)]


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = 2,
                    keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): the pieces of every document.

    Whole texts are tokenized, ``end_id`` ends each document, so an empty or null text is one
    piece of one id and every row of ``docs`` has a piece. With ``keep_ids`` the ids come too.
    The tokenizer file is read on the driver (its size does not grow with the data) and sent
    to the workers, so it need not exist on executors.
    """
    ship_package(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())
    key = zlib.crc32(sent.value.encode())
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * keep_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(key, sent)
        last = np.array([end_id], "<u4")
        for b in batches:
            rows, parts = [], []
            for doc_id, ids in zip(b["doc_id"].to_pylist(), words.texts([b["text"]]), strict=True):
                ids = np.concatenate([ids, last])
                tokens = len(ids)
                for start, length in cut(tokens, window):
                    part = ids[start:start + length]
                    rows.append((doc_id, start, length, zlib.crc32(part), tokens))
                    if keep_ids:
                        parts.append(part.astype(np.int32))
            out = [pa.array(column, pa.int64()) for column in (zip(*rows) if rows else [()] * 5)]
            if keep_ids:
                out.append(pa.array(parts, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, [x.split()[0] for x in schema.split(", ")])

    return id_text(docs, id_col, text_col).mapInArrow(pieces, schema)


class RoomTree:
    """Segment tree over remaining capacities 0..window: how many windows have each."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def tightest(self, need: int) -> int:
        """The least remaining capacity of at least ``need``, or -1."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:  # up to the first right neighbour with a window, then down its left edge
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i *= 2
                    if not self.count[i]:
                        i += 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_decreasing(lengths, window: int) -> tuple[list[int], list[int]]:
    """(sequence, offset) of every length, none over ``window``."""
    tree, open_at, used = RoomTree(window), {}, []
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    for k in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        need = int(lengths[k])
        room = tree.tightest(need)
        if room < 0:
            s, room = len(used), window
            used.append(0)
        else:
            tree.add(room, -1)
            s = open_at[room].pop()
        sequence[k], offset[k] = s, used[s]
        used[s] += need
        if room > need:
            tree.add(room - need, 1)
            open_at.setdefault(room - need, []).append(s)
    return sequence, offset


def pack(pieces: DataFrame, window: int = WINDOW, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` plus (sequence_id, offset); sequence ids are unique, not gapless.

    Every piece is in exactly one sequence and a sequence has no gap between pieces. Pieces
    are dealt by hash of (id, start, checksum, place in the written pieces) into groups of about ``group_pieces``; a task
    packs a group, so a group leaves a few windows partly empty and the share of padding
    falls with ``group_pieces``. Nothing else grows with the input than the number of groups.
    Ties (equal lengths) are taken in order of id, start and checksum; repeated pieces are
    packed each for itself. No pieces, no rows.
    """
    # the written scan position tells equal rows apart, so that they do not meet in one group
    pieces = stage(pieces.withColumn("seen", F.monotonically_increasing_id()), "pieces")
    groups = max(1, -(-pieces.count() // group_pieces))
    # a dealt-out row number would change with a retry; the hash does not
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "seen"), F.lit(groups)).cast("int"))
    ship_package(pieces.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.drop("seen").schema) + ", sequence_id long, `offset` long"

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start", "ids_crc32", "seen"], kind="stable").reset_index(drop=True)
        sequence, offset = best_fit_decreasing(group["length"].tolist(), window)
        base = int(group["pack_group"].iloc[0]) << 32
        return group.drop(columns=["pack_group", "seen"]).assign(sequence_id=np.asarray(sequence, dtype=np.int64) + base, offset=np.asarray(offset, dtype=np.int64))

    return dealt.groupBy("pack_group").applyInPandas(packed, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = 2, keep_ids: bool = False,
                   group_pieces: int = GROUP_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack: a row for each piece with its place (see the two steps)."""
    return pack(tokenize_pieces(docs, tokenizer_path, window, end_id, keep_ids, id_col, text_col), window, group_pieces)
