"""Periodic runs of words: stretches that repeat a period at least three times.

A run is a stretch of consecutive words with a smallest period q, of at least
``exponent`` periods and ``least`` words, that cannot be extended. All runs of
a text come from its Lyndon roots: for each of two opposite orders of the
words, the longest Lyndon word from every place is a candidate period, and two
longest common extensions, to the right and to the left, tell how far it holds.
Extensions take constant time: suffix trees of the stretch and of its reversal
are built by Ukkonen's method, the depths at which an Euler tour turns between
neighbouring leaves are kept in a sparse table, and the deepest node above two
leaves is a minimum over two of its rows. The same tour with the words in
opposite order gives the second ranking of the suffixes.

Most texts hold no run. All windows of ``WINDOW`` words within a run of three
periods and 24 words occur twice in the text, so trees are built only for
stretches of such windows; what a hash of them takes for equal only makes a
stretch longer.

Memory and time are in proportion to the longest such stretch of one text, some
hundred bytes and ten microseconds a word; texts are taken one at a time.

Nulls: a null text has no words, a null id is kept. Empty texts have no runs.
Repeated rows and copies are each looked at on their own. Runs are listed by
start, then period, so there are no ties. Very long texts are read whole. Empty
tables give no rows. Columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayflow.llm.common import fresh, importable, sliced

LEAST, EXPONENT = 24, 3
#: Words of a window; runs of at least 3 periods and 24 words repeat every one of theirs.
WINDOW = 8


def suffix_tree(word: list[int], kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ukkonen's tree of ``word``, which ends with a 0 that is nowhere else: (start, length, parent, symbol) of all nodes but the root's own.

    Node 0 is the root. Leaves have the whole rest of the text as length.
    """
    n = len(word)
    start, stop, link, below = [0], [0], [0], {}
    node = edge = length = waiting = 0
    for i, symbol in enumerate(word):
        waiting += 1
        made = 0
        while waiting:
            if not length:
                edge = i
            key = node * kinds + word[edge]
            child = below.get(key)
            if child is None:
                below[key] = len(start)
                start.append(i)
                stop.append(n)
                link.append(0)
                if made:
                    link[made] = node
                    made = 0
            else:
                along = stop[child] - start[child]
                if length >= along:
                    edge += along
                    length -= along
                    node = child
                    continue
                at = start[child] + length
                if word[at] == symbol:
                    if made:
                        link[made] = node
                    length += 1
                    break
                inner = len(start)
                start += (start[child], i)
                stop += (at, n)
                link += (0, 0)
                below[key] = inner
                below[inner * kinds + symbol] = inner + 1
                start[child] = at
                below[inner * kinds + word[at]] = child
                if made:
                    link[made] = inner
                made = inner
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    parent, first = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    keys, nodes = np.fromiter(below.keys(), np.int64, len(below)), np.fromiter(below.values(), np.int64, len(below))
    parent[nodes], first[nodes] = keys // kinds, keys % kinds
    return np.array(start), np.array(stop) - np.array(start), parent, first


class Extensions:
    """Suffix ranks of a word and common extensions of any two of its suffixes, from its suffix tree."""

    def __init__(self, word: np.ndarray, both_orders: bool):
        self.n = len(word)
        kinds = int(word.max()) + 2
        start, length, parent, first = suffix_tree([*(word + 1).tolist(), 0], kinds)
        leaf = start + length == self.n + 1
        leaf[0] = False
        depth = self._depths(length, parent)
        suffix = self.n + 1 - depth  # of leaves
        order, turns = self._tour(parent, first, leaf, depth)
        self.rank = np.empty(self.n + 1, np.int64)
        self.rank[suffix[order]] = np.arange(self.n + 1)
        self.table = [turns]
        while 2 << len(self.table) - 1 <= len(turns):
            last, step = self.table[-1], 1 << len(self.table) - 1
            self.table.append(np.minimum(last[:-step], last[step:]))
        self.opposite = None
        if both_orders:
            # the end of the text stays the least symbol
            order, _ = self._tour(parent, np.where(first, kinds - first, 0), leaf, depth)
            self.opposite = np.empty(self.n + 1, np.int64)
            self.opposite[suffix[order]] = np.arange(self.n + 1)

    @staticmethod
    def _depths(length: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Sums of the lengths up to the root, by doubling the way that is summed."""
        depth, above = length.copy(), parent.copy()
        depth[0] = 0
        while above.any():
            depth += depth[above]
            above = above[above]
        return depth

    @staticmethod
    def _tour(parent: np.ndarray, symbol: np.ndarray, leaf: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves in the order of an Euler tour, and the depth at which it turns before each."""
        nodes = np.lexsort((symbol[1:], parent[1:])) + 1
        begins = np.searchsorted(parent[nodes], np.arange(len(parent) + 1)).tolist()
        listed, is_leaf, depths = nodes.tolist(), leaf.tolist(), depth.tolist()
        order, turns = [], []
        waiting, turned = [(0, 0)], 0  # node, and the depth at which the tour turns to reach it; -1 for a first child
        while waiting:
            node, turn = waiting.pop()
            if turn >= 0:
                turned = turn
            if is_leaf[node]:
                order.append(node)
                turns.append(turned)
                continue
            a, b, here = begins[node], begins[node + 1], depths[node]
            for child in listed[b - 1 : a : -1]:
                waiting.append((child, here))
            waiting.append((listed[a], -1))
        return np.array(order), np.array(turns, np.int64)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of the suffixes at ``a`` and ``b``, which differ."""
        ranks = np.sort(np.stack((self.rank[a], self.rank[b])), axis=0)
        low, width = ranks[0] + 1, ranks[1] - ranks[0]
        level = np.frexp(width)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.table[k]
            out[at] = np.minimum(row[low[at]], row[low[at] + width[at] - (1 << int(k))])
        return out


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """The first place behind each with a smaller rank; the last rank is the least."""
    out, open_ = [0] * len(rank), []
    for i, r in enumerate(rank.tolist()):
        while open_ and open_[-1][0] > r:
            out[open_.pop()[1]] = i
        open_.append((r, i))
    return np.array(out)


def runs_of(word: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """(start, length, period) of all runs, ordered by start and period. ``exponent`` is 2 or more."""
    none = np.zeros((0, 3), np.int64)
    n = len(word)
    if n < max(least, exponent):
        return none
    word = np.unique(word, return_inverse=True)[1]
    forward = Extensions(word, both_orders=True)
    places = np.arange(n)
    roots = np.concatenate([np.stack((places, _next_smaller(rank)[:n] - places), 1) for rank in (forward.rank, forward.opposite)])
    at, period = np.unique(roots[(roots.sum(axis=1) < n) & (exponent * roots[:, 1] <= n)], axis=0).T
    if not len(at):
        return none
    right = forward.common(at, at + period)
    # the first root of a run begins within its first period
    held = right >= (exponent - 2) * period + 1 if exponent > 2 else right >= 0
    at, period, right = at[held], period[held], right[held]
    if not len(at):
        return none
    backward = Extensions(word[::-1], both_orders=False)
    left = backward.common(n - at, n - at - period)
    found = np.unique(np.stack((at - left, left + period + right, period), 1), axis=0)
    found = found[found[:, 1] >= np.maximum(least, exponent * found[:, 2])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def repeated_stretches(codes: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Maximal stretches of words all of whose windows occur twice, if they have ``least`` words."""
    if len(codes) < least:
        return []
    hashes = codes.astype(np.uint64)
    for step in (1, 2, 4):
        hashes = (hashes[:-step] ^ (hashes[:-step] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + (hashes[step:] ^ (hashes[step:] >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    order = hashes.argsort(kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(len(hashes) + 2, np.int8)
    twice[order[1:][same] + 1] = twice[order[:-1][same] + 1] = 1
    edges = np.flatnonzero(np.diff(twice))
    return [(a, b) for a, b in zip(edges[::2].tolist(), (edges[1::2] + WINDOW - 1).tolist()) if b - a >= least]


def text_runs(words: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> np.ndarray:
    """(start, length, period) of the runs of a list of words."""
    narrow = exponent >= EXPONENT and least >= LEAST
    stretches = repeated_stretches(np.fromiter(map(hash, words), np.int64, len(words)), least) if narrow else [(0, len(words))]
    found = [np.zeros((0, 3), np.int64)]
    for a, b in stretches:
        numbers: dict[bytes, int] = {}
        word = np.array([numbers.setdefault(w, len(numbers)) for w in words[a:b]], np.int64)
        found.append(runs_of(word, least, exponent) + np.array([a, 0, 0]))
    return np.concatenate(found)


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those behind the first period of a run."""
    if not len(runs):
        return words
    inside = np.zeros(len(words) + 1, np.int64)
    np.add.at(inside, runs[:, 0] + runs[:, 2], 1)
    np.add.at(inside, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(inside.cumsum()[:-1] == 0)]


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(documents: DataFrame, least: int = LEAST, exponent: int = EXPONENT, names: tuple[str, str] = ("runs", "collapsed")) -> DataFrame:
    """The documents without their text, with ``runs`` (start, length, period, in words) and the ``collapsed`` text, words joined by one space."""
    importable(documents.sparkSession)
    kept = documents.drop("text", *names)
    text = fresh(kept.columns, "whole_text")
    schema = kept.schema
    run_type = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    schema = T.StructType([*schema.fields, T.StructField(names[0], T.ArrayType(run_type)), T.StructField(names[1], T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            runs, texts = [], []
            for raw in batch.column(0):
                words = raw.as_py().split()  # bytes: space, tab, LF, VT, FF and CR
                found = text_runs(words, least, exponent)
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found.tolist()])
                texts.append(b" ".join(collapsed(words, found)))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(runs, _RUN), pa.array(texts, pa.binary()).cast(pa.string())], names=schema.names)

    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias(text)
    return documents.select(whole, *[F.col(c) for c in kept.columns]).mapInArrow(run, schema)
