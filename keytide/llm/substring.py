"""Repeated passages, by count-min prefilter and exact grouping.

A window is ``WINDOW`` consecutive words of a document.  Its minimizer, the
sub-window of ``PIECE`` words with the least hash, is the same wherever the
window occurs; a document has about a ninth as many minimizers as windows.

1. Each task counts its documents' minimizers in two rows of cells and passes on
   the cells it used.  Merged by addition, a cell is never below the number of
   documents with any minimizer in it, hence never below that of any window.
2. Windows whose cells all reach two are grouped exactly, by 96 bits of two
   independent hashes; every window that occurs in two documents is among them.

The sketch's width follows the size of the texts up to ``MAX_CELLS``; above that
the second pass gets more windows, never fewer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytide.llm.common import texts
from keytide.llm.text_arrays import Words, mix, signed, word_slices

WINDOW, PIECE = 50, 34
SPAN = WINDOW - PIECE + 1
ROWS = 2
BLOCK = 1 << 16
MIN_CELLS, MAX_CELLS = 1 << 20, 1 << 29  # at most 64 MB of bits per row on each worker
CELLS_PER_MINIMIZER = 10
NO_ID = (1 << 63) - 1  # a null id comes after all others


def _cells(minimizers: np.ndarray, row: int, cells: int) -> np.ndarray:
    return (mix(minimizers + np.uint64(row + 1)) & np.uint64(cells - 1)).astype(np.int64)


def _minimizers(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each window's minimizer hash and document."""
    pieces, at = words.windows(hashes, PIECE)
    n = np.maximum(words.counts - WINDOW + 1, 0)
    document = np.repeat(np.arange(len(n)), n)
    if not len(document):
        return np.zeros(0, np.uint64), document
    # The least of SPAN successive pieces: doubled runs, then two that overlap.
    least, run = pieces, 1
    while 2 * run <= SPAN:
        least = np.minimum(least[: len(least) - run], least[run:])
        run *= 2
    rest = SPAN - run
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    first = np.concatenate([[0], np.cumsum(np.maximum(words.counts - PIECE + 1, 0))])[:-1]
    offset = np.arange(len(document)) - np.repeat(np.cumsum(n) - n, n)
    return least[np.repeat(first, n) + offset], document


def _sketcher(cells: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(ROWS)]
        for batch in batches:
            for _, _, words in word_slices(batch.column("text"), lower=False):
                found, document = _minimizers(words, words.hashes())
                new = np.ones(len(found), dtype=bool)
                new[1:] = (found[1:] != found[:-1]) | (document[1:] != document[:-1])
                found, document = found[new], document[new]
                order = np.lexsort((found, document))  # once per document
                found, document = found[order], document[order]
                new = np.ones(len(found), dtype=bool)
                new[1:] = (found[1:] != found[:-1]) | (document[1:] != document[:-1])
                for row in range(ROWS):
                    held[row].append(_cells(found[new], row, cells))
        for row in range(ROWS):
            if not held[row]:
                continue
            used, n = np.unique(np.concatenate(held[row]), return_counts=True)
            blocks, starts = np.unique(used // BLOCK, return_index=True)
            for block, a, b in zip(blocks, starts, [*starts[1:], len(used)]):
                inside = (used[a:b] % BLOCK).astype(np.uint16)
                yield pa.RecordBatch.from_pydict(
                    {
                        "row": pa.array([row], pa.int32()),
                        "block": pa.array([int(block)], pa.int64()),
                        "once": pa.array([inside[n[a:b] == 1].tobytes()], pa.binary()),
                        "more": pa.array([inside[n[a:b] > 1].tobytes()], pa.binary()),
                    }
                )

    return sketch


def _merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block's counts over all tasks, as the bits of the cells that reach two."""
    count = np.zeros(BLOCK, dtype=np.uint8)
    for batch in batches:
        for once, more in zip(batch.column("once").to_pylist(), batch.column("more").to_pylist()):
            count[np.frombuffer(more, np.uint16)] = 2
            cells = np.frombuffer(once, np.uint16)
            count[cells] = np.minimum(count[cells] + 1, 2)
    if (count > 1).any():
        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.array([key[0].as_py()], pa.int32()),
                "block": pa.array([key[1].as_py()], pa.int64()),
                "bits": pa.array([np.packbits(count > 1, bitorder="little").tobytes()], pa.binary()),
            }
        )


class Repeats:
    """Which minimizers may occur in two documents or more."""

    def __init__(self, cells: int, blocks: list):
        self.cells = cells
        self.bits = np.zeros((ROWS, cells // 8), dtype=np.uint8)
        for row, block, bits in blocks:
            self.bits[row, block * BLOCK // 8 : (block + 1) * BLOCK // 8] = np.frombuffer(bits, np.uint8)

    def maybe(self, minimizers: np.ndarray) -> np.ndarray:
        out = np.ones(len(minimizers), dtype=bool)
        for row in range(ROWS):
            cell = _cells(minimizers, row, self.cells)
            out &= (self.bits[row, cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
        return out


def _emitter(shared):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows that may be repeated, once per document."""
        repeats = shared.value
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for row, to, words in word_slices(batch.column("text"), lower=False):
                first = words.hashes()
                least, document = _minimizers(words, first)
                keep = np.flatnonzero(repeats.maybe(least))
                if not len(keep):
                    continue
                one = words.windows(first, WINDOW)[0][keep]
                two = words.windows(words.hashes(1), WINDOW, 1)[0][keep]
                yield pa.RecordBatch.from_arrays(
                    [signed(one), pa.array((two >> np.uint64(33)).astype(np.int32)), pa.array(ids[row:to][document[keep]])],
                    ["one", "two", "doc"],
                )

    return emit


def _finisher(shared):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents without a candidate window are done; the others keep their text."""
        repeats = shared.value
        for batch in batches:
            column = batch.column("text")
            for row, to, words in word_slices(column, lower=False):
                least, document = _minimizers(words, words.hashes())
                waiting = np.zeros(to - row, dtype=bool)
                waiting[document[repeats.maybe(least)]] = True
                part = column[row:to]
                hashes = [None if w else _kept(t.as_buffer().to_pybytes().split()) for w, t in zip(waiting, part)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id")[row:to],
                        "text": pa.array([t.as_py() if w else None for w, t in zip(waiting, part)], pa.string()),
                        "n_words": pa.array(words.counts.astype(np.int64)),
                        "kept_sha256": pa.array(hashes, pa.string()),
                    }
                )

    return finish


def _kept(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def covered(words: Words, gone: list) -> np.ndarray:
    """Which words lie in a window that a list of window hashes names, per document."""
    hashes, at = words.windows(words.hashes(), WINDOW)
    n = np.maximum(words.counts - WINDOW + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(n)])
    change = np.zeros(len(words.start) + 1, dtype=np.int64)
    for i, names in enumerate(gone):
        if names is not None and len(names):
            here = slice(bounds[i], bounds[i + 1])
            hit = at[here][np.isin(hashes[here], np.asarray(names, dtype=np.int64).view(np.uint64))]
            np.add.at(change, hit, 1)
            np.add.at(change, hit + WINDOW, -1)
    return np.cumsum(change[:-1]) > 0


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text, gone = batch.column("text"), batch.column("gone")
        done = batch.column("kept_sha256").to_pylist()
        removed = np.zeros(batch.num_rows, dtype=np.int64)
        kept_texts: list[str | None] = [None] * batch.num_rows
        for row, to, words in word_slices(text, lower=False):
            lists = [g.values.to_numpy(zero_copy_only=False) if g.is_valid else None for g in gone[row:to]]
            out = covered(words, lists)
            for i in range(row, to):
                if done[i] is None:
                    flags = out[words.first[i - row] : words.first[i - row + 1]]
                    kept = [w for w, f in zip(text[i].as_py().encode().split(), flags) if not f]
                    removed[i] = flags.sum()
                    done[i] = _kept(kept)
                    kept_texts[i] = b" ".join(kept).decode() if removed[i] else None
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_words": batch.column("n_words"),
                "n_removed": pa.array(removed),
                "kept_sha256": pa.array(done, pa.string()),
                "kept_text": pa.array(kept_texts, pa.string()),
            }
        )


def sketch_repeats(docs: DataFrame) -> Repeats:
    """The merged sketch; its bits, at most ``MAX_CELLS`` per row, pass through the driver."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    wanted = CELLS_PER_MINIMIZER * 2 * (size // 6) // (SPAN + 1)
    cells = min(MAX_CELLS, max(MIN_CELLS, 1 << int(wanted).bit_length()))
    parts = docs.select("text").mapInArrow(_sketcher(cells), "row int, block long, once binary, more binary")
    merged = parts.groupBy("row", "block").applyInArrow(_merge, "row int, block long, bits binary")
    return Repeats(cells, [tuple(r) for r in merged.collect()])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept_text``, one row per row of ``docs``.

    A word goes if it lies in a window whose words also start somewhere in a
    document with a smaller id.  Windows are judged on the input.  ``kept_text``
    is null where nothing went.  A null text has no words; a null id counts as
    larger than all others; rows that share an id do not remove each other's
    words.
    """
    docs = texts(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(sketch_repeats(docs))
    windows = docs.mapInArrow(_emitter(shared), "one long, two int, doc long")
    first = windows.groupBy("one", "two").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first = first.where("first < last").drop("last")
    gone = windows.join(first, ["one", "two"]).where("doc > first")
    gone = gone.groupBy("doc").agg(F.collect_set("one").alias("gone"))
    state = docs.mapInArrow(_finisher(shared), "doc_id long, text string, n_words long, kept_sha256 string")
    state = state.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    return state.join(gone, "doc", "left").select("doc_id", "text", "n_words", "kept_sha256", "gone").mapInArrow(
        _remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
