"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton lists every vocabulary piece that ends at a character; a dynamic
programme over the characters carries the best score and the number of pieces on the path.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from freshcat.llm.common import id_text, ship_package

SPACE = "▁"
#: Below the lowest score by this much: a character that no piece covers (fixed value of the
#: unigram model).
UNKNOWN_PENALTY = 10.0
#: Distinct chunks a Python worker remembers, and the longest it remembers.
CACHED_CHUNKS, CACHED_LENGTH = 500_000, 40

_COUNTERS: dict[int, object] = {}


def read_vocabulary(model_path: str) -> list[tuple[str, float]]:
    """(piece, score) by id of a sentencepiece file; the bound is the vocabulary's size."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())]


class UnigramCounter:
    """Best score and token count of a text, by the unigram tokenizer's rules.

    Spaces become U+2581 and one is put before the text. Of all ways to write the text in
    pieces the one with the highest sum of scores counts (double precision). Ties: paths to
    a character are tried by start, earliest first, and only a strictly better one replaces
    the best, so the longest last piece wins. A character without a piece of its own may
    also stand alone as unknown, at the lowest score less 10; a run of unknown characters is
    one unknown token, or a byte token for each UTF-8 byte where the vocabulary has them all.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: str = "<unk>"):
        import ahocorasick

        self.scores = dict(reversed(vocabulary))
        self.unknown_score = min(s for _, s in vocabulary) - UNKNOWN_PENALTY
        self.unknown = unknown
        self.bytes = all(f"<0x{b:02X}>" in self.scores for b in range(256))
        self.single = {p for p in self.scores if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # if no piece crosses from another character to a space mark, no path does, and each
        # run of marks with the characters after it can be counted by itself; whole-number
        # scores make the sums exact in any order
        self.parts = (SPACE in self.single and all(SPACE not in p.lstrip(SPACE) for p in self.scores)
                      and all(float(s).is_integer() for s in self.scores.values()))
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.known: dict[str, tuple[float, int]] = {}

    def path(self, text: str) -> tuple[float, int]:
        n, worst = len(text), float("-inf")
        best, count, open_run = [worst] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, (length, score) in self.automaton.iter(text):
            ends[last + 1].append((length, score))
        unknown_score, single = self.unknown_score, self.single
        for end in range(1, n + 1):
            found = ends[end]
            top, total, run = worst, 0, False
            if len(found) > 1:
                found.sort(reverse=True)
            for length, score in found:
                s = best[end - length] + score
                if s > top:
                    top, total, run = s, count[end - length] + 1, False
            if text[end - 1] not in single:
                s = best[end - 1] + unknown_score
                if s > top:
                    if self.bytes:
                        total = count[end - 1] + len(text[end - 1].encode())
                    else:
                        total = count[end - 1] + (not open_run[end - 1])
                    top, run = s, True
            best[end], count[end], open_run[end] = top, total, run
        return best[n], count[n]

    def count(self, text: str) -> tuple[float, int]:
        if not text:
            return 0.0, 0
        marked = SPACE + text.replace(" ", SPACE)
        if not self.parts:
            return self.path(marked)
        known, score, tokens = self.known, 0.0, 0
        for chunk in self.cut.findall(marked):
            got = known.get(chunk)
            if got is None:
                got = self.path(chunk)
                if len(chunk) <= CACHED_LENGTH:
                    if len(known) >= CACHED_CHUNKS:
                        known.clear()
                    known[chunk] = got
            score += got[0]
            tokens += got[1]
        return score, tokens


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, best_score) of every whole text; no shuffle.

    An empty or null text has 0 tokens and score 0. Rows are counted each for itself, so
    repeated rows and ids, null ids and extra columns do not matter.
    """
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    key = zlib.crc32(repr(vocabulary).encode())

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = UnigramCounter(sent.value)
        counter = _COUNTERS[key]
        for b in batches:
            got = [counter.count(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "n_tokens": [x[1] for x in got], "best_score": [x[0] for x in got]})

    return id_text(docs, id_col, text_col).mapInPandas(counted, "doc_id long, n_tokens long, best_score double")
