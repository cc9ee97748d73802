"""Periodic runs of words, found in a grammar of each slice of texts.

A run is a stretch of words that repeats with some least period, is at least
``MIN_LENGTH`` words and two periods long, and cannot be extended.

1. Words become numbers, exact within a slice of whole documents.
2. Every word of a run lies in a window of half of ``MIN_LENGTH`` words that
   occurs twice in its run.  Only stretches covered by such windows go on; this
   loses no run and leaves most texts without anything to do.
3. Re-Pair: the pairs that occur most, compared with their neighbours in the
   sequence, become nonterminals, round by round, until no pair occurs twice.
   What is left of a stretch is cut in halves down to single symbols.
4. Each nonterminal is looked at once, at its first occurrence: which periods
   carry across the boundary of its two halves, and how far, told by prefix hashes
   and then compared word by word.
5. These runs are set off at every place the nonterminal derives, and pieces
   of one period that share a period or more are merged.  A run lies whole in the
   least node that has it, so the merged intervals are maximal.

Documents are independent: there is no shuffle, and a long text is one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keytide.llm.common import texts
from keytide.llm.text_arrays import FAMILIES, U64, Words, inverse, mix, powers, ranges, word_slices

MIN_LENGTH = 12
MATCHES = MIN_LENGTH // 2  # every run has so many consecutive words that equal the word a period later
ROUNDS = 64  # of Re-Pair; what is left then is halved, which only costs time
CHUNK = 1 << 21  # boundary tests made together

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"


@dataclass
class Nodes:
    """Occurrences ``lo, mid, hi`` of nonterminals, in words; equal ``rule`` means equal words."""

    rule: np.ndarray
    lo: np.ndarray
    mid: np.ndarray
    hi: np.ndarray

    def take(self, at: np.ndarray) -> Nodes:
        return Nodes(self.rule[at], self.lo[at], self.mid[at], self.hi[at])


def joined_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words' bytes, each followed by a space, and where each begins (and the last ends)."""
    sizes = words.end - words.start
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(begins[-1], 0x20, dtype=np.uint8)
    out[ranges(begins[:-1], sizes)] = words.data[ranges(words.start, sizes)]
    return out, begins


def word_numbers(joined: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A number per word; equal numbers mean equal words."""
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(joined)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _repeated(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches that windows found twice between the same bounds cover."""
    counts = np.maximum(np.diff(bounds) - (MATCHES - 1), 0)
    at = ranges(bounds[:-1], counts)
    found = np.repeat(np.arange(len(counts), dtype=U64), counts)
    for k in range(MATCHES):
        found = mix(found * FAMILIES[0][1] + ids[at + k].astype(U64))
    order = np.sort(found)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = at[twice[np.minimum(np.searchsorted(twice, found), len(twice) - 1)] == found]
    step = np.zeros(len(ids) + 1, dtype=np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + MATCHES, -1)
    covered = np.cumsum(step)[:-1] > 0
    opens, closes = covered.copy(), covered.copy()
    opens[1:] &= ~covered[:-1]
    closes[:-1] &= ~covered[1:]
    first, last = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0] - 1
    opens[first], closes[last] = covered[first], covered[last]
    lo, hi = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    long = hi - lo >= MIN_LENGTH
    return lo[long], hi[long]


def stretches(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that can hold runs: places in ``ids`` of their words, and their bounds among these."""
    places = np.arange(len(ids))
    while True:
        lo, hi = _repeated(ids[places], bounds)
        kept = ranges(lo, hi - lo)
        bounds = np.concatenate([[0], np.cumsum(hi - lo)])
        if len(kept) == len(places):
            return places, bounds
        places = places[kept]


def re_pair(ids: np.ndarray, bounds: np.ndarray) -> Nodes:
    """All derivation nodes of ``MIN_LENGTH`` words or more of a grammar of the stretches.

    In a round, an occurrence is replaced if its pair occurs more often than
    the pairs it overlaps, ties by pair; of ``x x x ..`` every other one is.
    """
    symbols, place = ids.copy(), np.arange(len(ids))
    piece = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    ends = place + 1
    fresh = int(ids.max(initial=0)) + 1
    found = []
    for _ in range(ROUNDS):
        left = np.flatnonzero(piece[:-1] == piece[1:])
        pairs, which, often = np.unique(symbols[left] * fresh + symbols[left + 1], return_inverse=True, return_counts=True)
        if not len(left) or often.max() < 2:
            break
        rank = np.where(often > 1, often * len(pairs) + np.arange(len(pairs)) + 1, 0)[which]
        score = np.zeros(len(symbols), dtype=np.int64)  # of a symbol and the next
        score[left] = rank
        begin = np.flatnonzero(np.append(True, score[1:] != score[:-1]))  # streaks of one pair
        value, sizes = score[begin], np.diff(np.append(begin, len(score)))
        best = (value > np.append(0, value[:-1])) & (value > np.append(value[1:], 0))
        half = (sizes[best] + 1) // 2
        chosen = np.repeat(begin[best], half) + 2 * ranges(np.zeros(len(half), np.int64), half)
        rules, rule = np.unique(score[chosen], return_inverse=True)
        rule = rule + fresh
        fresh += len(rules)
        found.append(Nodes(rule, place[chosen], place[chosen + 1], ends[chosen + 1]))
        symbols[chosen] = rule
        ends[chosen] = ends[chosen + 1]
        stay = np.ones(len(symbols), dtype=bool)
        stay[chosen + 1] = False
        symbols, place, ends, piece = symbols[stay], place[stay], ends[stay], piece[stay]
    # The rest of each stretch, halved: blocks of 2, 4, 8, .. symbols, each a node of its own.
    first = np.searchsorted(piece, np.arange(len(bounds)))
    sizes = np.diff(first)
    width = 1
    while len(sizes) and width < sizes.max():
        blocks = np.maximum(-(-(sizes - width) // (2 * width)), 0)
        low = np.repeat(first[:-1], blocks) + 2 * width * ranges(np.zeros(len(blocks), np.int64), blocks)
        last = np.minimum(low + 2 * width, np.repeat(first[1:], blocks)) - 1
        found.append(Nodes(fresh + np.arange(len(low)), place[low], place[low + width], ends[last]))
        fresh += len(low)
        width *= 2
    if not found:
        return Nodes(*(np.zeros(0, np.int64) for _ in range(4)))
    nodes = Nodes(*(np.concatenate([getattr(n, f) for n in found]) for f in ("rule", "lo", "mid", "hi")))
    return nodes.take(np.flatnonzero(nodes.hi - nodes.lo >= MIN_LENGTH))


class Extent:
    """How far two places of a sequence agree, by prefix hashes and halving steps."""

    def __init__(self, ids: np.ndarray):
        base = FAMILIES[1][1]
        self.total = np.zeros(len(ids) + 1, dtype=U64)
        np.cumsum(mix(ids.astype(U64) + U64(1)) * powers(base, len(ids)), out=self.total[1:])
        self.scale = powers(inverse(base), len(ids) + 1)

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.total[a + size] - self.total[a]) * self.scale[a] == (self.total[b + size] - self.total[b]) * self.scale[b]

    def forward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        return self._agree(a, b, most, 1)

    def backward(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words before ``a`` and before ``b``."""
        return self._agree(a, b, most, -1)

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, way: int) -> np.ndarray:
        size = np.zeros(len(a), dtype=np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            at = np.flatnonzero(size + step <= most)
            x, y, n = a[at], b[at], size[at]
            begin = (x + n, y + n) if way > 0 else (x - n - step, y - n - step)
            size[at[self.same(*begin, np.full(len(at), step))]] += step
            step >>= 1
        return size


def _near(ids: np.ndarray, x: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of the matches ``ids[x] == ids[x + q]`` have enough matches around them, up to ``MATCHES`` on a side."""
    count = np.ones(len(x), dtype=np.int64)
    for way in (-1, 1):
        going = np.arange(len(x))
        for step in range(1, MATCHES):
            at = x[going] + way * step
            inside = (at >= lo[going]) if way < 0 else (at + q[going] < hi[going])
            going, at = going[inside], at[inside]
            going = going[ids[at] == ids[at + q[going]]]
            count[going] += 1
    return np.flatnonzero(count >= MATCHES)


def boundary_runs(ids: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, ...]:
    """``node, start, end, period`` of runs across the boundaries of distinct nodes.

    A run that reaches a period or more past the boundary matches from the word
    before it, one that reaches as far back matches onto the word after it.
    """
    extent, out = Extent(ids), []
    most = (nodes.hi - nodes.lo) // 2
    for past in (True, False):
        room = np.minimum(most, nodes.hi - nodes.mid if past else nodes.mid - nodes.lo)
        edges = np.concatenate([[0], np.cumsum(room)])
        row = 0
        while row < len(room):
            to = max(row + 1, int(np.searchsorted(edges, edges[row] + CHUNK, side="right")) - 1)
            at = np.repeat(np.arange(row, to), room[row:to])
            q = ranges(np.ones(to - row, np.int64), room[row:to])
            x = nodes.mid[at] - (1 if past else q)
            row = to
            match = ids[x] == ids[x + q]
            at, q, x = at[match], q[match], x[match]
            near = _near(ids, x, q, nodes.lo[at], nodes.hi[at])
            at, q, x = at[near], q[near], x[near]
            back = extent.backward(x, x + q, x - nodes.lo[at])
            ahead = extent.forward(x, x + q, nodes.hi[at] - x - q)
            full = back + ahead >= np.maximum(q, MIN_LENGTH - q)
            out.append(np.stack([at, x - back, x + ahead + q, q])[:, full])
    found = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.zeros((4, 0), np.int64)
    return tuple(_least_periods(found))


def _least_periods(found: np.ndarray) -> np.ndarray:
    """Without intervals that a node's run of a divisor of their period contains."""
    found = found[:, np.lexsort((found[3], found[0]))]
    done = []
    while found.shape[1]:
        node, start, end, q = found
        first = np.searchsorted(node, node)  # a node's least period is that of a run
        done.append(found[:, np.unique(first)])
        within = (q % q[first] == 0) & (start >= start[first]) & (end <= end[first])
        found = found[:, ~within]
    return np.concatenate(done, axis=1) if done else found


def find(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """``start, end, period`` of all runs, by start, then period; ``bounds`` separate documents."""
    places, cuts = stretches(ids, bounds)
    if not len(places):
        return tuple(np.zeros((3, 0), np.int64))
    ids = ids[places]
    nodes = re_pair(ids, cuts)
    _, first, rule = np.unique(nodes.rule, return_index=True, return_inverse=True)
    node, start, end, q = boundary_runs(ids, nodes.take(first))
    exact = np.array([np.array_equal(ids[a : b - p], ids[a + p : b]) for a, b, p in zip(start, end, q)], dtype=bool)
    if not exact.all():
        raise RuntimeError("two different word sequences share a 64-bit hash")
    # To all places that derive the node.
    order = np.argsort(rule, kind="stable")
    heads = np.searchsorted(rule[order], np.arange(len(first) + 1))
    many = np.diff(heads)[node]
    shift = nodes.lo[order][ranges(heads[node], many)] - np.repeat(nodes.lo[first][node], many)
    start, end, q = (np.repeat(v, many) for v in (start, end, q))
    start, end = start + shift, end + shift
    order = np.lexsort((start, q))
    start, end, q = start[order], end[order], q[order]
    # Pieces of one period that share at least a period are of one run.
    far = len(ids) + 1
    reach = np.maximum.accumulate(end + q * far) - q * far
    fresh = np.ones(len(q), dtype=bool)
    fresh[1:] = (q[1:] != q[:-1]) | (start[1:] > reach[:-1] - q[1:])
    head = np.flatnonzero(fresh)
    start, q = start[head], q[head]
    end = np.maximum.reduceat(end, head) if len(head) else end
    start, end = places[start], places[end - 1] + 1
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, to, words in word_slices(batch.column("text"), lower=False):
            joined, begins = joined_words(words)
            start, end, q = find(word_numbers(joined, begins), words.first)
            counts = words.counts
            bounds = np.searchsorted(start, words.first)
            dropped = np.zeros(len(begins), dtype=np.int64)
            np.add.at(dropped, start + q, 1)
            np.add.at(dropped, end, -1)
            kept = np.cumsum(dropped)[:-1] == 0
            sizes = np.where(kept, np.diff(begins), 0)
            held = joined[np.repeat(kept, np.diff(begins))]
            edges = np.concatenate([[0], np.cumsum(sizes)])[words.first]
            # Without the space after each document's last word; a document with words keeps its first.
            last = edges[1:][counts > 0] - 1
            held = np.delete(held, last)
            edges = edges - np.concatenate([[0], np.cumsum(counts > 0)])
            text = pa.LargeStringArray.from_buffers(to - row, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(held)))
            runs = pa.StructArray.from_arrays(
                [pa.array(start - np.repeat(words.first[:-1], np.diff(bounds))), pa.array(end - start), pa.array(q)], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id")[row:to],
                    "n_words": pa.array(counts.astype(np.int64)),
                    "runs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs).cast(RUNS),
                    "kept_text": text.cast(pa.string()),
                }
            )


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, kept_text``, one row per row of ``docs``.

    ``runs`` are ``(start, length, period)`` in words, by start, then period.
    ``kept_text`` has the words that no run has after its first period, joined
    by one space.  A null or empty text has no words, no runs and an empty kept
    text.  Ids may be null or repeat; other columns are not read.
    """
    return texts(docs, id_column, text_column).mapInArrow(_search, SCHEMA)
