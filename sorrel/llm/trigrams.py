"""Boolean trigram queries that a regular expression implies.

A query is a trigram, or ("and" | "or", queries), or None, which holds for every text. It is a necessary condition: a lower-cased text with a match satisfies the query of the lower-cased pattern.
"""

from __future__ import annotations

from itertools import product
from re import _constants as K
from re import _parser

#: Sets of strings above this size are given up for their ends, and classes of more characters stand for any character.
MOST, MOST_OF_CLASS = 64, 8


class Facts:
    """What is known of all texts that a pattern matches: all of them (exact), or how they begin and end (sets of at most two characters each), and a query."""

    def __init__(self, exact: set[str] | None, prefix: set[str] = frozenset({""}), suffix: set[str] = frozenset({""}), query=None):
        self.exact, self.prefix, self.suffix, self.query = exact, prefix, suffix, query

    def opened(self) -> Facts:
        """The same without a list of all texts."""
        if self.exact is None:
            return self
        return Facts(None, {x[:2] for x in self.exact}, {x[-2:] for x in self.exact}, both(self.query, any_of(self.exact)))


def both(*queries):
    """All of the queries, in one flat conjunction."""
    parts: list = []
    for q in queries:
        parts += [] if q is None else q[1] if isinstance(q, tuple) and q[0] == "and" else [q]
    parts = list(dict.fromkeys(parts))
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _all_of(query) -> set:
    return set(query[1]) if isinstance(query, tuple) and query[0] == "and" else {query}


def either(queries: list):
    """Any of the queries, without those that another one follows from."""
    queries = list(dict.fromkeys(queries))
    queries = [q for q in queries if not any(p != q and _all_of(p) < _all_of(q) for p in queries)]
    return None if None in queries or not queries else queries[0] if len(queries) == 1 else ("or", tuple(queries))


def any_of(texts: set[str]):
    """That one of the texts occurs; one of fewer than three characters says nothing."""
    return either([both(*(x[i : i + 3] for i in range(len(x) - 2))) for x in sorted(texts)])


def _after(a: Facts, b: Facts) -> Facts:
    """a, then b."""
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST:
        return Facts({x + y for x, y in product(a.exact, b.exact)}, query=both(a.query, b.query))
    ends, starts = (a.exact or a.suffix), (b.exact or b.prefix)
    # the texts that span the joint are known if both sides of it are
    joint = any_of({x + y for x, y in product(ends, starts)}) if len(ends) * len(starts) <= MOST * MOST else None
    p, s = a.opened(), b.opened()
    prefix = {(x + y)[:2] for x, y in product(a.exact, s.prefix)} if a.exact is not None and len(a.exact) * len(s.prefix) <= MOST else p.prefix
    suffix = {(x + y)[-2:] for x, y in product(p.suffix, b.exact)} if b.exact is not None and len(p.suffix) * len(b.exact) <= MOST else s.suffix
    return Facts(None, prefix, suffix, both(p.query, joint, s.query))


def _or(parts: list[Facts]) -> Facts:
    if all(x.exact is not None and x.query is None for x in parts) and len(exact := set().union(*(x.exact for x in parts))) <= MOST:
        return Facts(exact)
    parts = [x.opened() for x in parts]
    ends = [set().union(*(getattr(x, side) for x in parts)) for side in ("prefix", "suffix")]
    return Facts(None, *(x if len(x) <= MOST else {""} for x in ends), either([x.query for x in parts]))


def _characters(items: list) -> set[str] | None:
    """The characters of a class, lower-cased, or None for too many or for any but some."""
    out: set[str] = set()
    for kind, value in items:
        if kind is K.LITERAL:
            out.add(chr(value).lower())
        elif kind is K.RANGE and value[1] - value[0] < 2 * MOST_OF_CLASS:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MOST_OF_CLASS else None


def _facts(tree) -> Facts:
    out = Facts({""})
    for kind, value in tree:
        if kind is K.LITERAL:
            part = Facts({chr(value).lower()})
        elif kind is K.IN:
            some = _characters(value)
            part = Facts(some) if some else Facts(None)
        elif kind is K.SUBPATTERN:
            part = _facts(value[-1])
        elif kind is K.BRANCH:
            part = _or([_facts(x) for x in value[1]])
        elif kind in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
            low, high, body = value
            once = _facts(body)
            part = Facts({""})
            for _ in range(min(low, 4)):
                part = _after(part, once)
            if low == 0 and high == 1:
                part = _or([Facts({""}), once])
            elif high != low or low > 4:
                # more of the same, or nothing, may follow: the beginning is known, and so is the end if there is one at least
                begin = part.opened()
                part = Facts(None, begin.prefix, once.opened().suffix if low else {""}, begin.query)
        elif kind is K.AT:
            continue
        else:
            part = Facts(None)
        out = _after(out, part)
    return out


def query_of(pattern: str):
    """The Boolean query of a pattern, by induction over its parsed form: literals and small classes give sets of strings, alternatives their disjunction, sequences a conjunction with the
    trigrams that span each joint, and repetitions what their least number of rounds gives. Case doesn't count. None: no trigram is mandatory.
    """
    return _facts(_parser.parse(pattern)).opened().query


def trigrams_of(query) -> set[str]:
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1])) if query else set()


def holds(query, text: str) -> bool:
    """Whether a lower-cased text satisfies a query."""
    if query is None or isinstance(query, str):
        return query is None or query in text
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])
