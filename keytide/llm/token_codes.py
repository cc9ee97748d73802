"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits.  Level 0 holds the lowest chunk of every
id, and a bitmap says which ids go on; level 1 holds the next chunk of those,
and so on.  A rank directory counts a bitmap's ones before each block, so the
place of an id's next chunk is one count away, and any token is read without
decoding those around it.

File (little-endian): a header of int64 values ``MAGIC, documents, ids, levels``
and the length of each level, then document ids, a null flag per document,
document ends, and per level its chunks, bitmap and rank directory, each padded
to eight bytes.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import cut, texts
from keytide.llm.storage import open_file, write_whole
from keytide.llm.text_arrays import slices

MAGIC = 0x3143414454  # "TDAC1" read as a number
BLOCK = 512  # bits between two entries of a rank directory
FILE_IDS = 4_000_000
CACHE_WORDS = 300_000  # about 60 MB
SUFFIX = ".dac"


def _padded(array: np.ndarray) -> bytes:
    data = array.tobytes()
    return data + bytes(-len(data) % 8)


def pack(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The parts of one file."""
    rest, levels = ids.astype(np.uint32), []
    while len(rest) or not levels:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more.astype(np.int64), np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0, np.int64)
        ranks = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        levels.append(((rest & 0xFF).astype(np.uint8), bits, ranks))
        rest = rest[more] >> 8
    header = np.array([MAGIC, len(doc_ids), len(ids), len(levels), *[len(c) for c, _, _ in levels]], dtype=np.int64)
    parts = [header.tobytes(), _padded(doc_ids.astype(np.int64)), _padded(nulls.astype(np.uint8)), _padded(ends.astype(np.int64))]
    return parts + [_padded(x) for level in levels for x in level]


class TokenFile:
    """One file; ``token`` and ``document`` read only the bytes they need."""

    def __init__(self, path: str):
        self.file = open_file(path)
        magic, self.documents, self.ids, levels = self._read(0, np.int64, 4)
        if magic != MAGIC:
            raise ValueError(f"{path}: no token file")
        self.lengths = self._read(32, np.int64, levels)
        self.at: dict = {}
        place = 32 + 8 * int(levels)
        sizes = {"doc_ids": 8 * self.documents, "nulls": self.documents, "ends": 8 * self.documents}
        for level, n in enumerate(self.lengths):
            sizes |= {("chunks", level): n, ("bits", level): -(-n // 8), ("ranks", level): 8 * (-(-n // BLOCK) + 1)}
        for name, size in sizes.items():
            self.at[name] = place
            place += int(size) + -int(size) % 8

    def _read(self, place: int, kind, n: int) -> np.ndarray:
        size = np.dtype(kind).itemsize
        return np.frombuffer(self.file.read_at(int(n) * size, int(place)), dtype=kind)

    def section(self, name, kind, n: int, first: int = 0) -> np.ndarray:
        return self._read(self.at[name] + first * np.dtype(kind).itemsize, kind, n)

    def token(self, i: int) -> int:
        """Id number ``i``, by one chunk and one rank per level."""
        if not 0 <= i < self.ids:
            raise IndexError(i)
        value = 0
        for level in range(len(self.lengths)):
            value |= int(self.section(("chunks", level), np.uint8, 1, i)[0]) << (8 * level)
            block = i // BLOCK
            bits = np.unpackbits(self.section(("bits", level), np.uint8, i // 8 + 1 - block * BLOCK // 8, block * BLOCK // 8), bitorder="little")
            if not bits[i % BLOCK]:
                break
            i = int(self.section(("ranks", level), np.int64, 1, block)[0]) + int(bits[: i % BLOCK].sum())
        return value

    def all_ids(self) -> np.ndarray:
        values = None
        for level in range(len(self.lengths) - 1, -1, -1):
            n = self.lengths[level]
            chunks = self.section(("chunks", level), np.uint8, n).astype(np.uint32)
            if values is not None:
                more = np.unpackbits(self.section(("bits", level), np.uint8, -(-n // 8)), bitorder="little", count=int(n)).astype(bool)
                chunks[more] |= values << np.uint32(8)
            values = chunks
        return values

    def ends(self) -> np.ndarray:
        return self.section("ends", np.int64, self.documents)

    def document(self, k: int) -> list[int]:
        ends = self.ends()
        return [self.token(i) for i in range(int(ends[k - 1]) if k else 0, int(ends[k]))]


class _Known(dict):
    """Ids of words, made when first asked for.

    Half of ``CACHE_WORDS`` words, or those of one call when they are more, are one generation,
    and that before it is kept too: words that come again stay, others go.
    """

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        self[word] = ids
        return ids

    def age(self) -> None:
        if len(self) >= max(CACHE_WORDS // 2, 1):
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Encodes texts word by word, with each known word encoded once.

    For a tokenizer that never joins across white space, the ids of a text are
    those of its words in order.  About ``CACHE_WORDS`` words stay known, or those of two calls.

    Fewer words are met, and cheaper ones, where the tokenizer's own steps allow it (``plain``):
    A-Z are lower-cased, marks between a letter and white space are a word of their own,
    and words of ``LETTERS`` alone go to the library's model without the steps before it.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.code = [i.to_bytes(4, "little") for i in range(1 + max(self.tokenizer.get_vocab().values(), default=-1))]
        self.known = _Known(self._ids)
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = sorted({content.lower().encode() for content in added})
        self.plain = None if any(content.strip().isalpha() for content in added) else _plain_letters(self.tokenizer)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit numbers."""
        self.known.age()
        ids = self.known.__getitem__
        return [b"".join(map(ids, text.split())) for text in (texts if self.plain is None else map(self._prepared, texts))]

    def _prepared(self, text: bytes) -> bytes:
        """The text in lower case and with its marks set off; as it is if it then had an added token."""
        lower = text.lower()
        if any(content in lower for content in self.added):
            return text
        data = np.frombuffer(lower, dtype=np.uint8)
        # Before marks that follow a letter and end a word; letters beyond a-z have two bytes.
        turns = np.diff(_MARK[data].view(np.int8), prepend=0, append=0)
        at, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        last = data[at - 1]
        cut = (at > 0) & (_LETTER[last] | (_SECOND[last] & (data[at - 2 * (at > 1)] == 0xC3)))
        at = at[cut & ((end == len(data)) | _SPACE[data[np.minimum(end, len(data) - 1)]])]
        return np.insert(data, at, 32).tobytes() if len(at) else lower

    def _ids(self, word: bytes) -> bytes:
        if self.plain is not None and _PLAIN_WORD.fullmatch(text := word.decode()):
            text = text if text.isascii() else text.translate(self.plain)
            return b"".join([self.code[token.id] for token in self.model.tokenize(text)])
        found = self.tokenizer.encode([word.decode()], is_pretokenized=True, add_special_tokens=False)
        return b"".join([self.code[i] for i in found.ids])


def _among(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


ASCII = "abcdefghijklmnopqrstuvwxyz"
LETTERS = ASCII + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)  # small ones; those beyond a-z start with the byte C3
MARKS = "".join(c for c in string.punctuation if c != "'")
_PLAIN_WORD = re.compile(f"[{LETTERS}]+")
_LETTER, _MARK, _SPACE = _among(ASCII.encode()), _among(MARKS.encode()), _among(b" \t\n\x0b\x0c\r")
_SECOND = _among(bytes(x.encode()[1] for x in LETTERS[len(ASCII) :]))


def _plain_letters(tokenizer) -> dict[int, str] | None:
    """What each of ``LETTERS`` is to the model, if the steps before it do no more to a word of them.

    They have to lower-case A-Z, keep a run of letters whole, letter by letter, a to z as they are, and cut marks from it.
    Every pair of letters is tried, each letter before each mark, and each pair of marks behind a letter.
    """
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
        return None
    normal = tokenizer.normalizer.normalize_str
    cuts = lambda text: [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    run = "".join(x + y for x in LETTERS for y in LETTERS)
    if normal(ASCII.upper()) != ASCII or normal(run) != run:
        return None
    table = {ord(x): "".join(cuts(x)) for x in LETTERS}
    marked = [x + mark for x in LETTERS for mark in MARKS]
    whole = cuts(run) == [run.translate(table)] and all(cuts(x) == [table[ord(x)]] for x in LETTERS) and ASCII.translate(table) == ASCII
    runs = [x + mark for x in MARKS for mark in MARKS]
    whole = whole and all(normal("a" + m) == "a" + m and cuts("a" + m) == ["a", *cuts(m)] for m in runs)
    return table if whole and all(normal(m) == m and cuts(m) == [table[ord(m[0])], m[1]] for m in marked) else None


@cache
def encoder(tokenizer_path: str) -> WordEncoder:
    """One per Python worker, which keeps it from task to task."""
    return WordEncoder(tokenizer_path)


def _writer(folder: str, tokenizer_path: str, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path).encode
        partition = TaskContext.get().partitionId()
        done = shard = 0
        ids, names, nulls, ends, size = [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal done, shard, ids, names, nulls, ends, size
            path = f"{folder}/part-{partition:06d}-{shard:06d}{SUFFIX}"
            packed = pack(np.frombuffer(b"".join(ids), dtype="<u4"), np.array(names, np.int64), np.array(nulls, np.uint8), np.array(ends, np.int64))
            write_whole(path, packed)
            row = {"partition": [partition], "path": [path], "before": [done], "n_tokens": [size]}
            done, shard = done + size, shard + 1
            ids, names, nulls, ends, size = [], [], [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("partition", pa.int64()), ("path", pa.string()), ("before", pa.int64()), ("n_tokens", pa.int64())]))

        for batch in batches:
            for row, to, data, offsets in slices(batch.column("text")):
                data = data.tobytes()
                codes = encode([data[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())])
                for doc_id, code in zip(batch.column("doc_id")[row:to], codes):
                    ids.append(code + end)
                    size += len(code) // 4 + 1
                    names.append(doc_id.as_py() or 0)
                    nulls.append(not doc_id.is_valid)
                    ends.append(size)
                    if size >= FILE_IDS:
                        yield flush()
        if names:
            yield flush()

    return write


def write_tokens(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode and write all documents in ascending id order, null ids last.

    Returns the list of files: ``path``, ``start`` (ids in all files before it)
    and ``n_tokens``.  A null text is empty and has the end id alone; rows that
    repeat an id follow each other, ordered by text.  Only one number per
    partition reaches the driver.
    """
    docs = texts(docs, id_column, text_column)
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc()]
    ordered = docs.repartitionByRange(order[0]).sortWithinPartitions(*order)
    files = ordered.mapInArrow(
        _writer(folder, tokenizer_path, end_id), "partition long, path string, before long, n_tokens long"
    )
    files = cut(files)
    sums = files.groupBy("partition").agg(F.sum("n_tokens").alias("n")).orderBy("partition").collect()
    starts, total = [], 0
    for row in sums:
        starts.append((row["partition"], total))
        total += row["n"]
    bases = docs.sparkSession.createDataFrame(starts, "partition long, base long")
    return files.join(bases, "partition").select("path", (F.col("base") + F.col("before")).alias("start"), "n_tokens")


def _read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            file = TokenFile(path)
            data = memoryview(file.all_ids().astype("<u4").tobytes())
            ends = file.ends()
            begins = np.concatenate([[0], ends[:-1]])
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
            doc_ids = file.section("doc_ids", np.int64, file.documents)
            nulls = file.section("nulls", np.uint8, file.documents).astype(bool)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(doc_ids, pa.int64(), mask=nulls),
                    "start": pa.array(start + begins, pa.int64()),
                    "n_tokens": pa.array(ends - begins, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )


def read_tokens(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, read back from the files."""
    tasks = max(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = files.repartition(tasks, "path")
    return dealt.mapInArrow(_read_files, "doc_id long, start long, n_tokens long, ids_crc32 long")
