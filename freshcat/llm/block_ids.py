"""Token ids of many texts at a time, with what was encoded before remembered.

Texts are parted into words, the distinct words of a block into a core of letters and the
punctuation behind it (pre-tokenizers part these), and only cores not met before go through the
tokenizer, many in one call. The ids of the texts are then gathered by array operations. A
tokenizer's class says how words are parted and what is one call's worth.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Cores a Python worker remembers, and the longest it remembers: some 50 MB.
REMEMBERED, LONGEST = 250_000, 40
#: Bytes of text that are encoded together, and the rest of the last one: a block's distinct words
#: are looked up once each, so larger blocks save lookups, for some ten times their size in arrays.
BLOCK_BYTES = 4_000_000
#: Words of one call of the tokenizer.
TOGETHER = 1_000
#: ASCII punctuation; the apostrophe may begin a contraction, which is not cut.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class Runs:
    """Id runs by key: ``place`` numbers the keys, ``ids`` holds one run after the other."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.empty(0, np.uint32)
        self.ends = np.zeros(1, np.int64)

    def extended(self, ids: np.ndarray, lengths: np.ndarray) -> Runs:
        """These runs and more; the old ones keep their numbers. ``place`` stays as it was."""
        out = Runs()
        out.place = self.place
        out.ids = np.concatenate([self.ids, ids])
        out.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        return out


def listed(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def gathered(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` that begin at ``first``, one after the other."""
    upto = np.cumsum(length, dtype=np.int32)
    total = int(upto[-1]) if len(upto) else 0
    at = np.repeat((first - (upto - length)).astype(np.int32), length)
    at += np.arange(total, dtype=np.int32)
    return ids[at]


def behind(words: pa.Array, heads: pa.Array) -> pa.Array:
    """What is left of the words behind the heads that they begin with."""
    words = words.cast(pa.large_binary())
    places = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    skipped = pc.binary_length(heads).to_numpy()
    left = np.diff(places) - skipped
    ends = np.cumsum(left, dtype=np.int64)
    if not len(words) or not ends[-1]:
        return pa.array([""] * len(words), pa.string())
    rest = gathered(np.frombuffer(words.buffers()[2], np.uint8), places[:-1] + skipped, left)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(np.append(0, ends)), pa.py_buffer(rest)]).cast(pa.string())


def packed(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in runs], np.int64)
    return (np.concatenate(runs) if runs else np.empty(0, np.uint32)), lengths


class BlockIds:
    """See the module."""

    def __init__(self) -> None:
        self.cores, self.tails, self.remembered = Runs(), Runs(), REMEMBERED

    # what a tokenizer's class gives

    def words(self, texts: pa.Array) -> pa.ListArray:
        """Each text's words: its ids are theirs, one word after the other."""
        raise NotImplementedError

    def is_core(self, words: pa.Array) -> pa.Array:
        """Which words the tokenizer parts from punctuation behind them."""
        raise NotImplementedError

    def kinds(self, words: pa.Array) -> np.ndarray:
        """A number for each word: :meth:`encode_kind` gets words of one kind."""
        raise NotImplementedError

    def encode_kind(self, kind: int, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has."""
        raise NotImplementedError

    def encode_tails(self, tails: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def encode_heads(self, heads: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the words that texts begin with, where these differ; None: they do not."""
        return None

    def whole(self, texts: pa.Array) -> pa.Array:
        """Which texts must be encoded whole (a boolean array)."""
        return pa.array(np.zeros(len(texts), bool))

    def encode_whole(self, text: str) -> np.ndarray:
        raise NotImplementedError

    # the common way

    def _numbered(self, runs: Runs, keys: pa.Array, encode: Callable, bound: int) -> tuple[np.ndarray, Runs]:
        """Each key's number, and runs that hold them all. New keys are remembered up to ``bound``."""
        coded = keys.dictionary_encode()
        distinct = coded.dictionary
        numbers = np.fromiter(map(runs.place.get, listed(distinct), repeat(-1)), np.int64, len(distinct))
        new, full = np.flatnonzero(numbers < 0), runs
        if len(new):
            # words to remember first, and those of a kind together
            found = distinct.take(pa.array(new))
            kinds = self.kinds(found)
            short = pc.utf8_length(found).to_numpy() <= LONGEST
            order = np.lexsort((kinds, ~short))
            new, kinds, words = new[order], kinds[order], listed(found.take(pa.array(order)))
            base = len(runs.place)
            full = runs.extended(*encode(words, kinds))
            numbers[new] = np.arange(base, base + len(new))
            kept = words[:min(int(short.sum()), max(bound - base, 0))]
            if kept:
                n = base + len(kept)
                runs.place.update(zip(kept, range(base, n), strict=True))
                runs.ids, runs.ends = full.ids[:full.ends[n]].copy(), full.ends[:n + 1].copy()
        return numbers[coded.indices.to_numpy()], full

    def encode_words(self, words: list[str], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after the other, and how many each has."""
        bounds = [0, *(np.flatnonzero(np.diff(kinds)) + 1).tolist(), len(words)]
        ids, lengths = [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            for k in range(a, b, TOGETHER):
                found, own = self.encode_kind(int(kinds[a]), words[k:min(k + TOGETHER, b)])
                ids.append(found)
                lengths.append(own)
        return np.concatenate(ids), np.concatenate(lengths)

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one after the other, and how many each has."""
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        parts = self.words(texts)
        coded = parts.flatten().dictionary_encode()
        inverse, distinct = coded.indices.to_numpy(), coded.dictionary
        core = pc.utf8_rtrim(distinct, PUNCTUATION)
        core = pc.if_else(self.is_core(core), core, distinct)
        at_core, cores = self._numbered(self.cores, core, self.encode_words, self.remembered)
        at_tail, tails = self._numbered(self.tails, behind(distinct, core), lambda found, _: self.encode_tails(found), 10_000)
        # the ids of the distinct words, each its core's and its tail's
        first = np.stack([cores.ends[at_core], len(cores.ids) + tails.ends[at_tail]], axis=1).reshape(-1)
        length = np.stack([np.diff(cores.ends)[at_core], np.diff(tails.ends)[at_tail]], axis=1).reshape(-1)
        ids = gathered(np.concatenate([cores.ids, tails.ids]), first, length)
        length = length.reshape(-1, 2).sum(axis=1)
        first = np.cumsum(length) - length
        counts = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(counts) - counts
        begun = starts[counts > 0]  # places of words that begin a text
        heads = self.encode_heads(listed(distinct.take(pa.array(inverse[begun]))))
        word_first, word_length = first.astype(np.int32)[inverse], length.astype(np.int32)[inverse]
        if heads is not None:
            word_first[begun], word_length[begun] = len(ids) + np.cumsum(heads[1]) - heads[1], heads[1]
            ids = np.concatenate([ids, heads[0]])
        ends = np.concatenate([[0], np.cumsum(word_length, dtype=np.int64)])[np.cumsum(counts)]
        return gathered(ids, word_first, word_length), np.diff(ends, prepend=0)

    def texts(self, texts: Iterable[pa.Array]) -> Iterator[np.ndarray]:
        """Ids of each text (unsigned 32-bit), from arrays of texts without nulls."""
        for column in texts:
            sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
            total, at = int(sizes[-1]) if len(sizes) else 0, 0
            step = -(-total // max(1, -(-total // BLOCK_BYTES)))  # blocks of like size
            while at < len(column):
                base = sizes[at - 1] if at else 0
                end = min(int(np.searchsorted(sizes, base + step)) + 1, len(column))
                part = column.slice(at, end - at)
                alone = self.whole(part)
                ids, lengths = self.block(part.filter(pc.invert(alone)))
                runs = iter(np.split(ids, np.cumsum(lengths)[:-1])) if len(lengths) else iter(())
                for k, whole in enumerate(alone.to_pylist()):
                    yield self.encode_whole(part[k].as_py()) if whole else next(runs)
                at = end
