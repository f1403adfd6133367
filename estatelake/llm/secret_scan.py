"""Secret scans with a trigram inverted index.

For each rule's regular expression a Boolean trigram query is derived from its
parse tree: literals are strung together as long as the set of possible
strings stays small, each string of three or more characters demands all its
trigrams, alternatives are OR-ed, unknown parts demand nothing. Texts are
scanned in segments (the record batches of a task). A segment's inverted
index is built in one pass over its lower-cased texts' trigrams and holds, for each
trigram that some query names, the documents that contain it; a query is answered by intersecting and uniting
postings, and only its candidates are verified with the expression on the
whole text. A rule whose query demands nothing (long hexadecimal runs) scans
every text. The index is as large as its segment and needs no shuffle.

Cases: NULL text is empty and has no spans; repeated rows are scanned one
by one; very long texts are scanned whole; NULL ids come back as NULL; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from re import _constants as C
from re import _parser as P


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    ignore_case: bool = False
    group: int = 0        # whose length counts
    least: int = 0        # characters that group needs

    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The three base kinds, in their listed order.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", False, 0, 20),
    # maximal runs of 24 and more: the same spans as [0-9a-f]+ with shorter runs dropped
    Rule("hex", r"[0-9a-f]{24,}", False, 0, 24),
)
# The rest tries a run of characters from its left edge only, so a long run is scanned once.
RULES = BASE + (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----"),
    Rule("url_login", r"(?<![a-z0-9+.-])[a-z][a-z0-9+.-]*+://[^\s/:@]++:[^\s/:@]++@[A-Za-z0-9.-]+"),
    Rule("google_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
)

# A query is True (no demand) or ("and" | "or", operands); an operand may be a trigram.
Query = object
MOST = 64


def _strings(strings: frozenset[str]) -> Query:
    if not strings or any(len(s) < 3 for s in strings):
        return True
    each = [("and", tuple(sorted({s[i:i + 3] for i in range(len(s) - 2)}))) for s in sorted(strings)]
    return each[0] if len(each) == 1 else ("or", tuple(each))


def _all(queries: list[Query]) -> Query:
    queries = [q for q in queries if q is not True]
    return True if not queries else queries[0] if len(queries) == 1 else ("and", tuple(queries))


def _sequence(nodes) -> tuple[frozenset[str] | None, Query]:
    """(possible strings if few, query) of consecutive nodes."""
    known, demands, whole = frozenset([""]), [], True
    for op, arg in nodes:
        strings, query = _node(op, arg)
        if strings is not None and len(known) * len(strings) <= MOST:
            known = frozenset(a + b for a in known for b in strings)
            continue
        demands.append(_strings(known))
        whole, known = False, strings if strings is not None else frozenset([""])
        if strings is None:
            demands.append(query)
    demands.append(_strings(known))
    return (known if whole else None), _all(demands)


def _node(op, arg) -> tuple[frozenset[str] | None, Query]:
    if op is C.LITERAL:
        return frozenset([chr(arg).lower()]), True
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):    # no characters of their own
        return frozenset([""]), True
    if op is C.IN:
        chars = set()
        for kind, v in arg:
            if kind is C.LITERAL:
                chars.add(chr(v).lower())
            elif kind is C.RANGE and v[1] - v[0] < 8:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None, True
        return (frozenset(chars), True) if len(chars) <= 8 else (None, True)
    if op is C.SUBPATTERN:
        return _sequence(arg[-1])
    if op is C.BRANCH:
        every = [_sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in every) and sum(len(s) for s, _ in every) <= MOST:
            strings = frozenset().union(*(s for s, _ in every))
            return strings, _strings(strings)
        each = [q for _, q in every]
        return None, True if any(q is True for q in each) else ("or", tuple(each))
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        low, high, inner = arg
        strings, query = _sequence(inner)
        if strings is not None and high == 1:
            return (strings | {""} if low == 0 else strings), True
        if strings is not None and low == high and len(strings) == 1:
            return frozenset([next(iter(strings)) * low]), True
        return None, query if low >= 1 else True
    return None, True


def trigram_query(pattern: str) -> Query:
    """The Boolean query of an expression, over lower-cased trigrams."""
    return _sequence(P.parse(pattern))[1]


def trigrams(query: Query) -> set[str]:
    if query is True:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*(trigrams(q) for q in query[1]))


def build_postings(lowered: list[str], wanted: set[str], chars: int = 1 << 22) -> dict[str, np.ndarray]:
    """Inverted index of a segment: trigram to sorted document numbers, from one pass over each text's own trigrams.
    Texts are taken together up to ``chars`` characters."""
    grams = sorted(wanted)
    found: list[list[np.ndarray]] = [[] for _ in grams]
    place = {g: i for i, g in enumerate(grams)}
    usual = [np.zeros(0x110000, bool) for _ in range(3)]
    for g in grams:
        for t, ch in zip(usual, g):
            t[ord(ch)] = True
    at = 0
    while at < len(lowered):
        end, size = at, 0
        while end < len(lowered) and (end == at or size + len(lowered[end]) <= chars):
            size += len(lowered[end])
            end += 1
        starts = np.cumsum([0] + [len(t) + 2 for t in lowered[at:end - 1]])
        c = np.frombuffer("\0\0".join(lowered[at:end]).encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(c) >= 3:
            hits = np.flatnonzero(usual[0][c[:-2]] & usual[1][c[1:-1]] & usual[2][c[2:]])
            key = (c[hits].astype(np.uint64) << np.uint64(42)) | (c[hits + 1].astype(np.uint64) << np.uint64(21)) | c[hits + 2]
            doc = at + np.searchsorted(starts, hits, "right") - 1
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                k = int(key[a])
                i = place.get(chr(k >> 42) + chr(k >> 21 & 0x1FFFFF) + chr(k & 0x1FFFFF))
                if i is not None:
                    found[i].append(np.unique(doc[a:b]))
        at = end
    return {g: np.concatenate(f).astype(np.int64) if f else np.empty(0, np.int64) for g, f in zip(grams, found)}


def answer(query: Query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Sorted document numbers that satisfy a query."""
    if query is True:
        return np.arange(n)
    if isinstance(query, str):
        return postings[query]
    op, operands = query
    lists = sorted((answer(q, postings, n) for q in operands), key=len)
    out = lists[0]
    for x in lists[1:]:
        out = np.intersect1d(out, x, assume_unique=True) if op == "and" else np.union1d(out, x)
        if op == "and" and not len(out):
            break
    return out


def spans_of(rule: Rule, regex: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, failing ones dropped afterwards."""
    return [m.span() for m in regex.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least]


_OUT = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_OUT_PA = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN))])


def _scan(rules: tuple[Rule, ...], segment: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = [(r, r.regex(), trigram_query(r.pattern)) for r in rules]
        wanted = set().union(*(trigrams(q) for *_, q in plans))
        for batch in batches:
            for at in range(0, batch.num_rows, segment):
                part = batch.slice(at, segment)
                texts = [t or "" for t in part.column(1).to_pylist()]
                postings = build_postings([t.lower() for t in texts], wanted)
                found: list[list] = [[] for _ in texts]
                for k, (rule, regex, query) in enumerate(plans):
                    for i in answer(query, postings, len(texts)):
                        found[i] += [(a, k, b) for a, b in spans_of(rule, regex, texts[i])]
                spans = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(f)] for f in found]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _OUT_PA.field("spans").type)],
                                                 schema=_OUT_PA)
    return run


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, segment: int = 2000) -> DataFrame:
    """doc_id, spans (kind, start, end in code points; by start, then rule order) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scan(tuple(rules), segment), _OUT)
