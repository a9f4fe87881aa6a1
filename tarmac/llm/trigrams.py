"""Boolean trigram queries of regular expressions, derived from their parse trees.

A query is ANY (no mandatory trigram) or a set of alternatives, each a set of trigrams that must
all occur in the lower-case text. The text of every match of the expression contains all trigrams
of at least one alternative.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser as parser

#: Larger sets of exact strings are given up; the query gets weaker, never wrong.
MOST_STRINGS = 64
ANY = None


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _class(items) -> set[str] | None:
    chars: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            chars.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 8:
            chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return chars


def _strings(node) -> set[str] | None:
    """The exact lower-case strings a node matches, if they are few."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.IN:
        found = _class(value)
        return found if found and len(found) <= 8 else None
    if kind is op.SUBPATTERN:
        return _sequence_strings(value[3])
    if kind is op.BRANCH:
        parts = [_sequence_strings(p) for p in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[1] <= 8:
        once = _sequence_strings(value[2])
        if once is None:
            return None
        out, now = set(), {""}
        for n in range(value[1] + 1):
            if n >= value[0]:
                out |= now
            now = {a + b for a in now for b in once}
            if len(now) > MOST_STRINGS:
                return None
        return out
    if kind in (op.ASSERT, op.ASSERT_NOT, op.AT):
        return {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        own = _strings(node)
        if own is None or len(out) * len(own) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in own}
    return out


def _of_strings(strings: set[str]):
    alternatives = {_trigrams(s) for s in strings}
    return ANY if frozenset() in alternatives else alternatives


def _both(a, b):
    if a is ANY or b is ANY:
        return b if a is ANY else a
    return {x | y for x in a for y in b}


def _needs(node):
    kind, value = node
    if kind is op.SUBPATTERN:
        return _sequence_needs(value[3])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] >= 1:
        return _sequence_needs(value[2])
    if kind is op.BRANCH:
        parts = [_sequence_needs(p) for p in value[1]]
        return ANY if ANY in parts else set().union(*parts)
    return ANY


def _sequence_needs(nodes):
    need, run = ANY, {""}
    for node in nodes:
        own = _strings(node)
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        need = _both(need, _of_strings(run))
        run = own if own is not None else {""}
        if own is None:
            need = _both(need, _needs(node))
    return _both(need, _of_strings(run))


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Alternatives of mandatory trigrams of a regular expression; None if it has no such."""
    found = _sequence_needs(parser.parse(pattern))
    if found is ANY:
        return None
    # An alternative that holds another one adds nothing.
    least = [a for a in found if not any(b < a for b in found)]
    return sorted(sorted(a) for a in least)
