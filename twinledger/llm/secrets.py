"""Secrets in texts, found through a trigram index.

Every rule's regular expression yields a Boolean query over trigrams that any
match must contain. Each block of documents gets an inverted index of the
trigrams that the queries name; postings are intersected and united, and only
the documents left are searched with the expression itself. Rules without a
mandatory trigram search every document. Blocks are indexed where they are read,
so no text is shuffled and the work grows with the input.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from twinledger.llm.textblocks import _LOWER, blocks, prepare, text_bytes

_MOST_STRINGS = 64
_MOST_CHARS = 16


@dataclass(frozen=True)
class Rule:
    """A kind of secret. `accept` judges a match; a failing match is dropped and not retried."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] | None = None


# The first three are the base rules, in the order of their spans.
RULES = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: m.end(2) - m.start(2) >= 6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 20),
    Rule("hex", r"[0-9a-f]+", lambda m: m.end() - m.start() >= 24),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,32}PRIVATE KEY-----"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abeprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment_key", r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("url_login", r"://[^\s/:@]+:[^\s/@]+@"),
)
BASE_KINDS = ("assign", "access", "hex")

# --- Boolean trigram queries -------------------------------------------------
# A query is None (every text may match), a trigram, or ("and" | "or", parts).


def _all_of(parts: list):
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any_of(parts: list):
    parts = list(dict.fromkeys(parts))
    return None if None in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[str]):
    """Any of these strings, each as all of its trigrams."""
    found = []
    for text in sorted(strings):
        data = text.encode("utf-8")
        found.append(_all_of([data[i : i + 3] for i in range(len(data) - 2)]))
    return _any_of(found)


def _characters(items: list) -> set[str] | None:
    """The ASCII characters of a class, folded; None if it is wide."""
    out: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            out.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < _MOST_CHARS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= _MOST_CHARS and all(c.isascii() for c in out) else None


def _walk(tree) -> tuple[set[str] | None, object]:
    """What a sequence may be: its strings if few, and a query that any match meets."""
    run: set[str] = {""}
    query: list = []
    exact = True

    def end_run() -> None:
        nonlocal run, exact
        query.append(_of_strings(run))
        run, exact = {""}, False

    def extend(strings: set[str]) -> None:
        nonlocal run
        if len(run) * len(strings) > _MOST_STRINGS:
            end_run()
        run = {a + b for a in run for b in strings} if len(strings) <= _MOST_STRINGS else {""}

    for op, value in tree:
        strings, more = None, None
        if op is sre.LITERAL:
            strings = {chr(value).lower()} if value < 128 else None
        elif op is sre.IN:
            strings = _characters(value)
        elif op is sre.SUBPATTERN:
            strings, more = _walk(value[3])
        elif op is sre.BRANCH:
            each = [_walk(branch) for branch in value[1]]
            if all(s is not None for s, _ in each) and sum(len(s) for s, _ in each) <= _MOST_STRINGS:
                strings = set().union(*(s for s, _ in each))
            else:
                more = _any_of([q if s is None else _all_of([q, _of_strings(s)]) for s, q in each])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            least, most, body = value
            inner, inner_query = _walk(body)
            if least == 0 and most == 1 and inner is not None and len(inner) < _MOST_STRINGS:
                strings = inner | {""}
            elif least >= 1:
                if inner is not None:
                    extend(inner)
                    if most == 1:
                        continue
                more = inner_query
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            continue
        if strings is not None:
            extend(strings)
            if more is not None:
                query.append(more)
        else:
            end_run()
            query.append(more)
    if exact:
        return run, _all_of(query)
    query.append(_of_strings(run))
    return None, _all_of(query)


def trigram_query(pattern: str):
    """The Boolean query over case-folded trigrams that every match of `pattern` meets."""
    strings, query = _walk(_parser.parse(pattern))
    return query if strings is None else _all_of([query, _of_strings(strings)])


def _trigrams(query) -> set[bytes]:
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


# --- the index of a block ----------------------------------------------------


def _code(trigram: bytes) -> int:
    return trigram[0] << 16 | trigram[1] << 8 | trigram[2]


class BlockIndex:
    """Postings of chosen trigrams over the texts of one block, letters folded."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, wanted: dict[int, int], of_code: np.ndarray):
        self.n_texts = len(offsets) - 1
        self.postings: dict[int, np.ndarray] = {}
        if len(raw) < 3:
            return
        low = _LOWER[raw].astype(np.int32)
        number = of_code[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        at = np.flatnonzero(number >= 0)
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + 3 <= offsets[text + 1]
        pairs = np.unique(number[at[inside]].astype(np.int64) * self.n_texts + text[inside])
        names, texts = pairs // self.n_texts, pairs % self.n_texts
        edges = np.searchsorted(names, np.arange(len(wanted) + 1))
        self.postings = {code: texts[edges[i] : edges[i + 1]] for code, i in wanted.items()}

    def find(self, query) -> np.ndarray:
        """Texts that meet the query, in order."""
        if query is None:
            return np.arange(self.n_texts)
        if isinstance(query, bytes):
            return self.postings.get(_code(query), np.zeros(0, dtype=np.int64))
        lists = [self.find(part) for part in query[1]]
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        lists.sort(key=len)
        found = lists[0]
        for other in lists[1:]:
            if not len(found):
                break
            found = np.intersect1d(found, other, assume_unique=True)
        return found


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of `docs`: doc_id and `found`, an array of (kind, start, end).

    Positions are code points of the whole text, ends exclusive; spans are
    ordered by start, then by the order of the rules. A null text is empty.
    Kinds may overlap; within a kind matches are leftmost and do not.
    """
    prepare(docs.sparkSession)
    span = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("found", T.ArrayType(span))])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(rule.pattern) for rule in rules]
        patterns = [re.compile(rule.pattern) for rule in rules]
        codes = sorted({_code(t) for query in queries for t in _trigrams(query)})
        wanted = {code: i for i, code in enumerate(codes)}
        of_code = np.full(1 << 24, -1, dtype=np.int16)
        of_code[codes] = np.arange(len(codes))
        names = pa.array([rule.kind for rule in rules])
        for part in blocks(batches, "text"):
            index = BlockIndex(*text_bytes(part.column("text")), wanted, of_code)
            texts = part.column("text").to_pylist()
            found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for k, (rule, query, pattern) in enumerate(zip(rules, queries, patterns)):
                accept = rule.accept
                for i in index.find(query).tolist():
                    if texts[i]:
                        found[i] += [
                            (m.start(), k, m.end())
                            for m in pattern.finditer(texts[i])
                            if accept is None or accept(m)
                        ]
            flat = [span for spans in found for span in sorted(spans)]
            kinds = names.take(pa.array([k for _, k, _ in flat], pa.int32()))
            spans = pa.StructArray.from_arrays(
                [kinds, pa.array([s for s, _, _ in flat], pa.int64()), pa.array([e for _, _, e in flat], pa.int64())],
                ["kind", "start", "end"],
            )
            ends = np.cumsum([0, *map(len, found)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)],
                ["doc_id", "found"],
            )

    return docs.select("doc_id", "text").mapInArrow(search, schema)

