"""Token ids in files of directly addressable codes.

An id is cut into chunks of bits. Level 0 holds the lowest chunk of every id, level 1 the next
chunk of those ids that have one, and so on. Each level but the last has a bitmap that says
which ids go on, and a rank directory (ones before every 512 bits), so the place of an id's
next chunk is its rank in the bitmap: any id, and any run of ids, is read by itself.

A file is one segment, written by Spark's own writers (so by their commit protocol, to any
file system Spark writes to). All numbers are little-endian.

    header     magic "DAC1", part u32, segment u32, levels u32, documents u64, tokens u64,
               ids of the part before this segment u64, CRC-32 of all that follows u32
    documents  doc_id i64 each; ids of the segment up to its end u64 each; u8 each, 1: null id
    levels     each: codes u64, bits a chunk u32, 1 if a bitmap follows u32, then the chunks,
               packed from the lowest bit, and the bitmap in blocks of 64 bytes followed by
               its directory (u32 a block)
    end        a line feed, which Spark's writer adds
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freshcat.llm.block_ids import BlockIds, packed
from freshcat.llm.common import ship_package, stage

MAGIC = b"DAC1"
HEADER = struct.Struct("<4sIIIQQQI")
LEVEL = struct.Struct("<QII")
#: Bits of a bitmap between two entries of its directory.
BLOCK = 512
#: A segment is closed once it holds so many ids (documents are never cut).
SEGMENT_TOKENS = 1_000_000

# ------------------------------------------------------------------ codes


def chunk_widths(values: np.ndarray) -> list[int]:
    """Bits of each level's chunks with the least total size for these values."""
    lengths = np.bincount(np.frexp(values.astype(np.float64))[1], minlength=2)
    longer = len(values) - np.cumsum(lengths)  # values of over b bits
    top = max(1, len(lengths) - 1)
    best: list[tuple[float, list[int]]] = [(0.0, [])] * (top + 1)
    for b in range(top - 1, -1, -1):
        n = len(values) if b == 0 else int(longer[b])
        # a bitmap's bit and its share of the directory, where values go on
        best[b] = min((n * (w + (1 + 32 / BLOCK if b + w < top else 0)) + best[b + w][0], [w, *best[b + w][1]]) for w in range(1, top - b + 1))
    return best[0][1]


def _pack(values: np.ndarray, width: int) -> bytes:
    """Values side by side from the lowest bit: eight of them fill ``width`` bytes."""
    groups = np.zeros((-(-len(values) // 8), 8), np.uint64)
    groups.reshape(-1)[:len(values)] = values
    out = np.zeros((len(groups), width), np.uint8)
    for k in range(8):
        byte, bit = divmod(k * width, 8)
        moved = groups[:, k] << np.uint64(bit)
        for i in range((bit + width + 7) // 8):
            out[:, byte + i] |= (moved >> np.uint64(8 * i)).astype(np.uint8)
    return out.tobytes()[:-(-len(values) * width // 8)]


def _unpack(chunks: np.ndarray, width: int, a: int, b: int) -> np.ndarray:
    """Values ``a`` .. ``b - 1`` of packed ones."""
    first, last = a // 8, -(-b // 8)
    held = chunks[first * width:last * width]
    groups = np.zeros((last - first, width), np.uint8)
    groups.reshape(-1)[:len(held)] = held
    out = np.empty((last - first, 8), np.uint32)
    for k in range(8):
        byte, bit = divmod(k * width, 8)
        value = np.zeros(len(groups), np.uint64)
        for i in range((bit + width + 7) // 8):
            value |= groups[:, byte + i].astype(np.uint64) << np.uint64(8 * i)
        out[:, k] = (value >> np.uint64(bit)) & np.uint64((1 << width) - 1)
    return out.reshape(-1)[a - 8 * first:b - 8 * first]


def encode_codes(values: np.ndarray) -> list[bytes]:
    """The levels of unsigned 32-bit values, lowest chunk first."""
    rest = np.ascontiguousarray(values, dtype=np.uint32)
    widths, levels = chunk_widths(rest), []
    for k, w in enumerate(widths):
        more = k + 1 < len(widths)
        out = [LEVEL.pack(len(rest), w, more), _pack(rest & np.uint32((1 << w) - 1), w)]
        if more:
            high = rest >> np.uint32(w)
            on = high > 0
            blocks = -(-len(on) // BLOCK)
            bitmap = np.zeros(blocks * BLOCK, np.uint8)
            bitmap[:len(on)] = on
            ones = bitmap.reshape(blocks, BLOCK).sum(axis=1, dtype=np.uint32)
            out += [np.packbits(bitmap, bitorder="little").tobytes(), (np.cumsum(ones) - ones).astype("<u4").tobytes()]
            rest = high[on]
        levels.append(b"".join(out))
    return levels


class Level:
    """A view of one level in a buffer; nothing is decoded until it is asked for."""

    def __init__(self, buffer: memoryview, at: int):
        self.codes, self.width, more = LEVEL.unpack_from(buffer, at)
        at += LEVEL.size
        size = -(-self.codes * self.width // 8)
        self.chunks = np.frombuffer(buffer, np.uint8, size, at)
        at += size
        self.bitmap = self.directory = None
        if more:
            blocks = -(-self.codes // BLOCK)
            self.bitmap = np.frombuffer(buffer, np.uint8, blocks * BLOCK // 8, at)
            at += len(self.bitmap)
            self.directory = np.frombuffer(buffer, "<u4", blocks, at)
            at += 4 * blocks
        self.end = at

    def rank(self, i: int) -> int:
        """Ones of the bitmap before place ``i``."""
        block, bit = divmod(i, BLOCK)
        if not bit and block == len(self.directory):
            block, bit = block - 1, BLOCK
        if block < 0:
            return 0
        head = int.from_bytes(self.bitmap[block * BLOCK // 8:(block * BLOCK + bit + 7) // 8].tobytes(), "little")
        return int(self.directory[block]) + (head & ((1 << bit) - 1)).bit_count()

    def goes_on(self, a: int, b: int) -> np.ndarray:
        bits = np.unpackbits(self.bitmap[a // 8:-(-b // 8)], bitorder="little")
        return bits[a % 8:a % 8 + b - a].astype(bool)

    def chunk(self, a: int, b: int) -> np.ndarray:
        parts = [_unpack(self.chunks, self.width, k, min(k + (1 << 16), b)) for k in range(a, b, 1 << 16)]
        return np.concatenate(parts) if parts else np.empty(0, np.uint32)


class Codes:
    """Random access to the values of :func:`encode_codes`."""

    def __init__(self, buffer: memoryview, levels: int, at: int = 0):
        self.levels = []
        for _ in range(levels):
            self.levels.append(Level(buffer, at))
            at = self.levels[-1].end

    def __len__(self) -> int:
        return self.levels[0].codes if self.levels else 0

    def __getitem__(self, i: int) -> int:
        """One value: a chunk and a rank a level."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for level in self.levels:
            bit = i * level.width
            raw = int.from_bytes(level.chunks[bit // 8:(bit + level.width + 7) // 8].tobytes(), "little")
            value |= ((raw >> bit % 8) & ((1 << level.width) - 1)) << shift
            shift += level.width
            if level.bitmap is None or not level.bitmap[i >> 3] >> (i & 7) & 1:
                return value
            i = level.rank(i)
        return value

    def run(self, a: int, b: int) -> np.ndarray:
        """Values ``a`` .. ``b - 1``, as far as there are: the ones that go on are a run of the
        next level too."""
        b = min(b, len(self))
        if a >= b:
            return np.empty(0, np.uint32)
        level, shift = self.levels[0], 0
        values = level.chunk(a, b)
        places = np.arange(b - a)
        for below, level in zip(self.levels, self.levels[1:], strict=False):
            places = places[below.goes_on(a, b)]
            a = below.rank(a)
            b = a + len(places)
            if not len(places):
                break
            shift += below.width
            values[places] |= level.chunk(a, b) << np.uint32(shift)
        return values


# ------------------------------------------------------------------ segments


def encode_segment(part: int, segment: int, before: int, doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """One file's bytes; ``ids``: document after document."""
    levels = encode_codes(ids)
    body = b"".join([
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.cumsum(np.array(lengths, "<u8"), dtype="<u8").tobytes(),
        bytes(d is None for d in doc_ids),
        *levels,
    ])
    return HEADER.pack(MAGIC, part, segment, len(levels), len(doc_ids), len(ids), before, zlib.crc32(body)) + body


class Segment:
    """A file read back; documents and single ids are read without the rest."""

    def __init__(self, content: bytes):
        magic, self.part, self.segment, levels, n, self.tokens, self.before, crc = HEADER.unpack_from(content)
        if magic != MAGIC or content[-1:] != b"\n" or zlib.crc32(memoryview(content)[HEADER.size:-1]) != crc:
            raise ValueError("not a whole file of token codes")
        at = HEADER.size
        ids = np.frombuffer(content, "<i8", n, at).tolist()
        self.ends = np.frombuffer(content, "<u8", n, at + 8 * n).astype(np.int64)
        null = content[at + 16 * n:at + 17 * n]
        self.doc_ids = [None if z else d for d, z in zip(ids, null, strict=True)]
        self.codes = Codes(memoryview(content), levels, at + 17 * n)

    def document(self, k: int) -> np.ndarray:
        return self.codes.run(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


# ------------------------------------------------------------------ tokenizer


class ByteLevelIds(BlockIds):
    """Ids by a byte-level tokenizer file.

    Its pre-tokenization takes a space together with what follows, so a text may be cut before
    every space that something other than white space follows, and before a line end between
    other signs; letters and other signs are parted. A text with a space before white space or at its end, or with one of the tokenizer's
    special strings, is encoded whole.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.opens[i] = token.startswith("Ġ")  # the byte-level sign of a space
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        # every character that any of the libraries takes for white space
        spaces = r"\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
        self.odd = "|".join([f" [{spaces}]", r" \z", *special])
        self.line_end = f"([^{spaces}])\n([^{spaces}])"
        self.newline = self.encode_each(["\n"])[0]

    def encode_each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, texts: pa.Array) -> pa.ListArray:
        """Words are what follows a space, or a line end between other signs with that line end."""
        return pc.split_pattern(pc.replace_substring_regex(texts, self.line_end, "\\1 \n\\2"), " ")

    def is_core(self, words: pa.Array) -> pa.Array:
        return pc.or_(pc.utf8_is_alpha(words), self.is_line(words))

    def is_line(self, words: pa.Array) -> pa.Array:
        return pc.and_(pc.starts_with(words, "\n"), pc.utf8_is_alpha(pc.utf8_slice_codeunits(words, 1)))

    def kinds(self, words: pa.Array) -> np.ndarray:
        """2: words of letters, 1: lines, 0: others."""
        kinds = self.is_line(words).to_numpy(zero_copy_only=False).astype(np.int8)
        kinds[pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)] = 2
        return kinds

    def encode_kind(self, kind: int, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of " " + word, or of a word that begins with a line end. Words of letters go many
        at a time: a token that opens with a space opens a word, and so does the line end's."""
        if not kind:
            return packed(self.encode_each([w if w.startswith("\n") else " " + w for w in words]))
        text = "".join(words) if kind == 1 else " " + " ".join(words)
        found = self.encode_each([text])[0]
        starts = np.flatnonzero(found == self.newline[0] if kind == 1 else self.opens[found])
        if len(starts) != len(words):
            raise ValueError("the tokenizer does not part words at spaces and line ends")
        return found, np.diff(starts, append=len(found))

    def encode_tails(self, tails: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return packed(self.encode_each(tails))

    def encode_heads(self, heads: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return packed(self.encode_each(heads))

    def whole(self, texts: pa.Array) -> pa.Array:
        return pc.match_substring_regex(texts, self.odd)

    def encode_whole(self, text: str) -> np.ndarray:
        return self.encode_each([text])[0]


_TOKENIZERS: dict[int, ByteLevelIds] = {}


def _byte_level_ids(key: int, tokenizer_json) -> ByteLevelIds:
    """The worker's own, with the words that its tasks so far have met. A function inside
    another goes to the workers with a copy of the module's variables for each task, and would
    find none here; this one goes by name."""
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = ByteLevelIds(tokenizer_json.value)
    return _TOKENIZERS[key]

# ------------------------------------------------------------------ Spark


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, segment_tokens: int = SEGMENT_TOKENS,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every whole text, ``end_id`` after each, to new files under ``path``.

    Rows are range-partitioned by id, so part k's documents come before part k + 1's; a part's
    segments follow one another. Null ids come first; rows of one id are in order of their
    text's hash, equal rows in order of their place in the scan, which also spreads an id
    with very many rows over parts. A null or empty text is ``end_id`` alone. An empty table
    gives no segment. Texts cross the network once; they are tokenized behind the sort, in
    the task that writes the file.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    key = zlib.crc32(sent.value.encode())
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"), F.monotonically_increasing_id().alias("seen"))
    order = ["doc_id", "th", "seen"]

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, last = _byte_level_ids(key, sent), np.array([end_id], np.uint32)
        part = TaskContext.get().partitionId()
        before = held = number = 0
        ids, doc_ids, lengths = [], [], []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([encode_segment(part, number, before, doc_ids, lengths, np.concatenate(ids))], pa.binary())], names=["payload"])

        for b in batches:
            for doc_id, found in zip(b.column("doc_id"), tokenizer.texts([b.column("text")]), strict=True):
                ids += [found, last]
                doc_ids.append(doc_id.as_py())
                lengths.append(len(found) + 1)
                held += lengths[-1]
                if held >= segment_tokens:
                    yield closed()
                    before, number, held = before + held, number + 1, 0
                    ids, doc_ids, lengths = [], [], []
        if doc_ids:
            yield closed()

    done = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(segments, "payload binary")
    # the text writer puts a value's bytes and a line feed into the file; a row a file
    done.select(F.col("payload").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_token_files(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in the files.

    As all are wanted, a segment is read as one run and cut at the documents' ends; a reader of
    some uses :class:`Segment`. ``start``, the ids of all documents before it, is a document's
    place in its part plus the totals of the parts before (one row a part).
    """
    ship_package(spark)
    schema = "part int, at long, doc_id long, n_tokens long, ids_crc32 long" + ", ids array<int>" * keep_ids

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                s = Segment(bytes(content))
                ids, ends = s.codes.run(0, s.tokens), s.ends.tolist()
                starts = [0, *ends[:-1]]
                for k in range(0, len(ends), 5_000):
                    runs = [ids[a:b] for a, b in zip(starts[k:k + 5_000], ends[k:k + 5_000], strict=True)]
                    out = pd.DataFrame({
                        "part": s.part, "at": s.before + np.array(starts[k:k + 5_000], np.int64),
                        "doc_id": pd.array(s.doc_ids[k:k + 5_000], dtype="Int64"),
                        "n_tokens": [len(r) for r in runs], "ids_crc32": [zlib.crc32(r.astype("<u4", copy=False)) for r in runs],
                    })
                    yield out.assign(ids=[r.astype(np.int32) for r in runs]) if keep_ids else out

    # a task without documents may leave an empty file
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
    found = stage(files.select("content").mapInPandas(documents, schema), "token-files")
    totals = found.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return found.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)
