"""Runs of periodically repeated words, found on a grammar of the text.

Words become numbers, exactly, per block of texts. Re-Pair replaces repeated pairs
of symbols by new ones in rounds, in step for all texts of a block: in each round
an occurrence is replaced unless it overlaps one of a pair that is more frequent in
its text. What is left of a text is halved again and again, so the text has one
derivation tree. A run lies across the boundary of the lowest node that holds it;
so each rule's boundary is searched once, at the rule's first place, and the runs
found there are moved to every place where the derivation has the rule. Of the
intervals of one period in a text those inside another are dropped.

At a boundary m a run of at least 24 words and three periods has eight words in
step, in [m, m + 8) or [m - 7, m + 1), with those one period before or after. The
places of these eight words give all periods to try. How far a period goes on is
the longest common extension of two places, from exact ranks of words 2^k long.

Null and empty texts have no words and no runs. Rows are treated one by one, so
repeated rows give repeated results. Only doc_id and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from twinledger.llm.textblocks import blocks, mix, prepare

#: Shortest run, in words, and in periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
_ANCHOR = 8
#: Pairs of places compared at a time.
_COMPARED = 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def _spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... (sizes[i] numbers) for each i, one after another."""
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)


class Grammar:
    """Derivation of all texts of a block: nodes (rule, start, boundary, end).

    Nodes of the same rule have the same words. Nodes shorter than the shortest run
    are left out.
    """

    def __init__(self, symbols: np.ndarray, owner: np.ndarray):
        self.nodes: list[np.ndarray] = []
        self.rules = 0
        n = len(symbols)
        start = np.arange(n)
        end = start + 1
        top = int(symbols.max()) + 1 if n else 0
        done: list[np.ndarray] = []
        while len(symbols) > 1:
            chosen, rule, n_rules = self._repeated_pairs(symbols, owner)
            if not n_rules:
                break
            self._record(rule, start[chosen], end[chosen], end[chosen + 1])
            # Texts in which no pair repeats are finished.
            busy = np.isin(owner, owner[chosen])
            symbols[chosen] = top + rule
            end[chosen] = end[chosen + 1]
            keep = np.ones(len(symbols), dtype=bool)
            keep[chosen + 1] = False
            done.append(np.stack([owner, start, end])[:, ~busy & keep])
            keep &= busy
            symbols, owner, start, end = symbols[keep], owner[keep], start[keep], end[keep]
            top += n_rules
            self.rules += n_rules
        done.append(np.stack([owner, start, end]))
        owner, start, end = np.concatenate(done, axis=1)
        order = np.argsort(start, kind="stable")
        self._halve(owner[order], start[order], end[order])

    def _record(self, rule: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> None:
        long = end - start >= LEAST_WORDS
        self.nodes.append(np.stack([self.rules + rule, start, middle, end])[:, long])

    @staticmethod
    def _repeated_pairs(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Places to replace, the number of each place's pair among those replaced, how many there are."""
        at = np.flatnonzero(owner[1:] == owner[:-1])
        order = at[np.lexsort((symbols[at + 1], symbols[at], owner[at]))]
        if not len(order):
            return at, at, 0
        a, b, who = symbols[order], symbols[order + 1], owner[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (who[1:] != who[:-1]))
        number = np.cumsum(new) - 1
        many = np.bincount(number)
        # The rank of a pair in its text: frequent ones first; none for single ones.
        weight = np.zeros(len(symbols), dtype=np.int64)
        weight[order] = np.where(many[number] > 1, many[number] * np.int64(len(many) + 1) + number + 1, 0)
        pair = np.zeros(len(symbols), dtype=np.int64)
        pair[order] = number
        before, after = np.append(0, weight[:-1]), np.append(weight[1:], 0)
        chosen = (weight > 0) & (weight >= before) & (weight >= after)
        # aaa: within a row of the same pair every second one, from the left.
        linked = np.append(False, chosen[1:] & chosen[:-1] & (weight[1:] == weight[:-1]))
        place = np.arange(len(symbols))
        head = np.maximum.accumulate(np.where(linked, -1, place))
        chosen &= (place - head) % 2 == 0
        found = np.flatnonzero(chosen)
        distinct, back = np.unique(pair[found], return_inverse=True)
        return found, back, len(distinct)

    def _halve(self, owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """The symbols left of each text under a balanced tree; every inner node is a rule of its own."""
        edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, dtype=np.int64)
        low, high = edges, np.append(edges[1:], len(owner))[: len(edges)]
        while len(low):
            wide = high - low > 1
            low, high = low[wide], high[wide]
            if not len(low):
                break
            middle = (low + high) // 2
            self._record(np.arange(len(low)), start[low], start[middle], end[high - 1])
            self.rules += len(low)
            low, high = np.concatenate([low, middle]), np.concatenate([middle, high])

    def derivation(self) -> np.ndarray:
        """rule, start, boundary, end of every node, ordered by rule."""
        nodes = np.concatenate(self.nodes, axis=1) if self.nodes else np.zeros((4, 0), dtype=np.int64)
        return nodes[:, np.argsort(nodes[0], kind="stable")]


class Extensions:
    """How many words two places have in common, forwards and backwards."""

    def __init__(self, symbols: np.ndarray, longest: int):
        ranks = symbols.astype(np.int64)
        self.levels = [ranks.astype(np.int32)]
        width = 1
        while 2 * width <= longest and 2 * width <= len(symbols):
            pairs = ranks[:-width] * (int(ranks.max()) + 1) + ranks[width:]
            _, ranks = np.unique(pairs, return_inverse=True)
            self.levels.append(ranks.astype(np.int32))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """Words in common from i and j on (or before them), at most `limit`."""
        shared = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            # A level can be used more than once: the highest one is not above half the limit.
            while True:
                width, ranks = 1 << k, self.levels[k]
                fits = np.flatnonzero(shared + width <= limit)
                x, y = (i[fits] - shared[fits] - width, j[fits] - shared[fits] - width) if back else (i[fits] + shared[fits], j[fits] + shared[fits])
                same = fits[ranks[x] == ranks[y]]
                shared[same] += width
                if not len(same) or k < len(self.levels) - 1:
                    break
        return shared


def _across(symbols: np.ndarray, owner: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Runs across the boundary of each node: node, start, end, period."""
    _, low, middle, high = nodes
    n = len(symbols)
    none = np.zeros((4, 0), dtype=np.int64)
    if n < _ANCHOR or not len(low):
        return none
    # Places by the eight words that begin there. Unlike words may share a number: these only pick what to try.
    window = np.zeros(n - _ANCHOR + 1, dtype=np.uint64)
    mixed = mix(symbols.astype(np.uint64) + np.uint64(1))
    for k in range(_ANCHOR):
        window = mix(window + mixed[k : n - _ANCHOR + 1 + k])
    window = mix(window + owner[: len(window)].astype(np.uint64))
    order = np.argsort(window, kind="stable")
    _, group = np.unique(window[order], return_inverse=True)
    of_place = np.empty(len(window), dtype=np.int64)
    of_place[order] = group
    keys = group.astype(np.int64) * n + order  # sorted: by group, then place

    node, period = [], []
    for anchor in (middle, middle - _ANCHOR + 1):
        # The anchor's eight words stand in the node; so do those of the places compared.
        fits = np.flatnonzero((anchor >= low) & (anchor + _ANCHOR <= high))
        base = of_place[anchor[fits]] * n
        first = np.searchsorted(keys, base + low[fits])
        last = np.searchsorted(keys, base + high[fits] - _ANCHOR, side="right")
        ask = np.flatnonzero(last - first > 1)
        for part in np.split(ask, np.flatnonzero(np.diff(np.cumsum((last - first)[ask]) // _COMPARED)) + 1):
            sizes = (last - first)[part]
            places = order[_spans(first[part], sizes)]
            who = np.repeat(fits[part], sizes)
            p = np.abs(places - anchor[who])
            near = (p > 0) & (LEAST_PERIODS * p <= (high - low)[who])
            if near.any():
                found = np.unique(who[near] * np.int64(n) + p[near])
                node.append(found // n)
                period.append(found % n)
    if not node:
        return none
    found = np.unique(np.concatenate(node) * np.int64(n) + np.concatenate(period))
    node, period = found // n, found % n

    # Only the texts asked about need ranks.
    texts = np.isin(owner, owner[low[np.unique(node)]])
    moved = np.cumsum(texts) - 1
    reach = Extensions(np.unique(symbols[texts], return_inverse=True)[1], int((high - low)[node].max()))
    out = []
    for part in range(0, len(node), _COMPARED):
        k, p = node[part : part + _COMPARED], period[part : part + _COMPARED]
        lo, mid, hi = low[k], middle[k], high[k]
        for x, y in ((mid - p, mid), (mid, mid + p)):
            inside = np.flatnonzero((x >= lo) & (y <= hi))
            a, b = moved[np.minimum(x[inside], n - 1)], moved[np.minimum(y[inside], n - 1)]
            b = np.where(y[inside] == n, moved[-1] + 1, b)
            right = reach.common(a, b, hi[inside] - y[inside], back=False)
            left = reach.common(a, b, x[inside] - lo[inside], back=True)
            start, end = x[inside] - left, y[inside] + right
            q = p[inside]
            good = (end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)) & (start < mid[inside]) & (end > mid[inside])
            out.append(np.stack([k[inside], start, end, q])[:, good])
    runs = np.concatenate(out, axis=1)
    # The smallest period of each interval is the run's.
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    new = np.append(True, (runs[:3, 1:] != runs[:3, :-1]).any(axis=0))[: runs.shape[1]]
    return runs[:, new]


def runs_of_block(symbols: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """text, start, end, period of all runs, by text, start and period; places count over the whole block."""
    nodes = Grammar(symbols.copy(), owner).derivation()
    rule = nodes[0]
    if not len(rule):
        return np.zeros((4, 0), dtype=np.int64)
    first = np.flatnonzero(np.append(True, rule[1:] != rule[:-1]))
    sizes = np.diff(np.append(first, len(rule)))
    node, start, end, period = _across(symbols, owner, nodes[:, first])
    # To every place of the derivation that has the rule.
    copies = sizes[node]
    shift = nodes[1][_spans(first[node], copies)] - np.repeat(nodes[1][first[node]], copies)
    start, end, period = np.repeat(start, copies) + shift, np.repeat(end, copies) + shift, np.repeat(period, copies)
    text = owner[start]
    order = np.lexsort((-end, start, period, text))
    text, start, end, period = text[order], start[order], end[order], period[order]
    # Inside another one of its text and period: it ends no later than one before it does.
    wide = np.int64(len(symbols) + 1)
    family = np.cumsum(np.append(0, (text[1:] != text[:-1]) | (period[1:] != period[:-1])))[: len(text)]
    furthest = np.maximum.accumulate(family * wide + end)
    keep = np.append(True, (family * wide + end)[1:] > furthest[:-1])[: len(text)]
    out = np.stack([text, start, end, period])[:, keep]
    return out[:, np.lexsort((out[3], out[1], out[0]))]


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period), collapsed: one row per row of `docs`.

    Words are what stands between blanks (U+0020, U+0009 to U+000D), numbered from 0.
    A run is a stretch of words with smallest period q, of LEAST_WORDS words and
    LEAST_PERIODS periods at least, which no neighbouring word extends; runs are in
    order of start, then period. `collapsed` joins by single spaces the words that no
    run holds after its first q words; it is empty, not null, where there are none.
    """
    prepare(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    run_type = pa.struct([(f.name, pa.int64()) for f in RUN.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text"):
            numbers: dict[bytes, int] = defaultdict(count().__next__)
            texts = [t.split() for t in pc.fill_null(part.column("text"), "").cast(pa.binary()).to_pylist()]
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            first = np.cumsum(sizes) - sizes
            symbols = np.fromiter((numbers[w] for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
            text, start, end, period = runs_of_block(symbols, np.repeat(np.arange(len(texts)), sizes))
            # Dropped words: inside a run, after its first period.
            steps = np.zeros(len(symbols) + 1, dtype=np.int64)
            np.add.at(steps, start + period, 1)
            np.add.at(steps, end, -1)
            kept = np.cumsum(steps)[:-1] == 0
            shorter = np.zeros(len(texts), dtype=bool)
            shorter[text] = True
            collapsed = []
            for i, words in enumerate(texts):
                if shorter[i]:
                    words = [words[k] for k in np.flatnonzero(kept[first[i] : first[i] + sizes[i]]).tolist()]
                collapsed.append(b" ".join(words))
            values = [start - first[text], end - start, period]
            edges = np.searchsorted(text, np.arange(len(texts) + 1))
            lists = pa.StructArray.from_arrays([pa.array(v) for v in values], fields=list(run_type))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), lists),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ],
                schema.fieldNames(),
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)
