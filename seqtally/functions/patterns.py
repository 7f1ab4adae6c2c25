"""What a regular-expression barcode says about the texts that hold it.

A pattern is parsed into a tree of characters, sequences, choices and repeats,
and from the tree come its *facts*: the texts that it matches if those are few,
and otherwise its required factors, a formula that every match satisfies.  A
choice is an OR over its alternatives, a sequence an AND over its parts and over
the texts that form where two parts meet; of each AND the most selective factor
is kept, so that the result is one set of texts of which every match contains at
least one (``cover``).  Small classes are spelled out: ``AC[GT]A.`` needs one of
``ACGA`` and ``ACTA``, ``(ACGTA|TTGCA).*`` one of ``ACGTA`` and ``TTGCA``.

What the parser does not know (flags, escapes by number, ...) gives no facts.
Patterns are library rows, so this per-row Python never sees a read."""

from __future__ import annotations

import re
from dataclasses import dataclass

#: A pattern that stands for at most this many plain texts is replaced by them;
#: a cover has at most as many.
MAX_TEXTS = 256
#: Longest text kept, and repeats that are written out.
LONGEST, WRITTEN = 256, 32
#: Expected occurrences of a cover per letter of random text above which seeds
#: would make more candidates than testing each read once, and up to which the
#: longer runs of an open repeat are left to a test.
FREQUENT, RARE = 0.01, 1e-6

_REPEAT = re.compile(r"(?:\{(\d+)(,(\d*))?\}|([?*+]))([?+]?)")
_LITERAL_ESCAPES = set("\\.[](){}^$|?*+-&<>=!/#%@~`'\",:; ")


class _Unknown(Exception):
    """Syntax that the parser leaves alone."""


# --- the tree: ("chars", letters or None for any), ("any",) for a dot, ("seq", nodes),
# ("alt", nodes), ("repeat", node, least, most or None), ("edge",) for what has no width

class _Parser:
    def __init__(self, text: str):
        self.text, self.i = text, 0

    def more(self) -> bool:
        return self.i < len(self.text)

    def take(self, n: int = 1) -> str:
        self.i += n
        return self.text[self.i - n:self.i]

    def whole(self):
        node = self.choice()
        if self.more():
            raise _Unknown
        return node

    def choice(self):
        parts = [self.sequence()]
        while self.more() and self.text[self.i] == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.more() and self.text[self.i] not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("seq", parts)

    def repeated(self, node):
        while times := _REPEAT.match(self.text, self.i):
            self.i = times.end()
            low, ranged, high, mark, kind = times.groups()
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(mark, (0, 0))
            if low:
                least = int(low)
                most = least if not ranged else int(high) if high else None
            if most is not None and most < least:
                raise _Unknown
            node = ("repeat", node, least, most)
            if kind == "+":  # possessive: fewer matches, the same letters
                node = ("seq", [node, ("edge",)])
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            return self.group()
        if c == "[":
            return self.letters()
        if c == "\\":
            return self.escape()
        if c == ".":
            return ("any",)
        if c in "^$":
            return ("edge",)
        if c in "*+?{":
            raise _Unknown
        return ("chars", frozenset(c))

    def group(self):
        plain = atomic = True
        if self.text.startswith("?", self.i):
            head = re.compile(r"\?(?::|>|=|!|<=|<!|<[A-Za-z][A-Za-z0-9]*>)").match(self.text, self.i)
            if not head:
                raise _Unknown
            self.i = head.end()
            plain, atomic = not head[0].endswith(("=", "!")), head[0] == "?>"
        else:
            atomic = False
        node = self.choice()
        if self.take() != ")":
            raise _Unknown
        if not plain:
            return ("edge",)
        return ("seq", [node, ("edge",)]) if atomic else node

    def escape(self):
        c = self.take()
        if c in _LITERAL_ESCAPES:
            return ("chars", frozenset(c))
        if c and c in "bBAZzG":
            return ("edge",)
        if c and c in "dDwWsShHvVtnrfae":
            return ("chars", None)
        if c and c in "XR123456789":
            while c.isdigit() and self.more() and self.text[self.i].isdigit():
                self.take()
            return ("seq", [("repeat", ("chars", None), 0, None), ("edge",)])
        raise _Unknown

    def letters(self):
        end = self.text.find("]", self.i + 1)
        inner = self.text[self.i:end]
        if end < 0 or inner.startswith("]"):
            raise _Unknown
        if any(x in inner for x in ("[", "\\", "&&")):
            raise _Unknown
        self.i = end + 1
        if inner.startswith("^"):
            return ("chars", None)
        found, i = set(), 0
        while i < len(inner):
            if i + 2 < len(inner) and inner[i + 1] == "-":
                first, last = ord(inner[i]), ord(inner[i + 2])
                if not 0 <= last - first < MAX_TEXTS:
                    return ("chars", None)
                found.update(map(chr, range(first, last + 1)))
                i += 3
            else:
                found.add(inner[i])
                i += 1
        return ("chars", frozenset(found))


@dataclass(frozen=True)
class Facts:
    """``exact``: every match is one of these (None: too many); ``sure``: and
    each of these matches wherever it occurs; ``starts`` and ``ends``: every match
    begins, and ends, with one of these; ``cover``: contains one of these."""
    exact: frozenset | None
    sure: bool
    starts: frozenset
    ends: frozenset
    cover: frozenset | None


_NOTHING = frozenset([""])


def cost(texts) -> float:
    """Expected occurrences of a set of texts per letter of random text."""
    return sum(4.0 ** -min(len(t), 12) for t in texts)


def _best(*sets):
    found = [s for s in sets if s and "" not in s]
    return min(found, key=lambda s: (cost(s), len(s))) if found else None


def _crossed(left, right):
    """All texts of one from each side, None beyond the limits."""
    if len(left) * len(right) > MAX_TEXTS:
        return None
    out = frozenset(a + b for a in left for b in right)
    return out if max(map(len, out)) <= LONGEST else None


def _exactly(texts: frozenset, sure: bool = True) -> Facts:
    return Facts(texts, sure, texts, texts, _best(texts))


_ANY = Facts(None, False, _NOTHING, _NOTHING, None)
_EDGE = Facts(_NOTHING, False, _NOTHING, _NOTHING, None)


def _then(a: Facts, b: Facts) -> Facts:
    exact = _crossed(a.exact, b.exact) if a.exact and b.exact else None
    if exact:
        return _exactly(exact, a.sure and b.sure)
    starts = (_crossed(a.exact, b.starts) if a.exact else None) or a.starts
    ends = (_crossed(a.ends, b.exact) if b.exact else None) or b.ends
    met = _crossed(a.ends, b.starts)
    return Facts(None, False, starts, ends, _best(a.cover, b.cover, met, starts, ends))


def _either(parts: list[Facts]) -> Facts:
    def union(sets):
        out = frozenset().union(*sets) if all(s is not None for s in sets) else None
        return out if out is not None and len(out) <= MAX_TEXTS else None
    exact = union([p.exact for p in parts])
    if exact:
        return _exactly(exact, all(p.sure for p in parts))
    starts, ends = (union([getattr(p, side) for p in parts]) or _NOTHING for side in ("starts", "ends"))
    return Facts(None, False, starts, ends, _best(union([p.cover for p in parts]), starts, ends))


def _facts(node) -> Facts:
    kind = node[0]
    if kind == "any":
        return _ANY
    if kind == "chars":
        return _ANY if node[1] is None else _exactly(node[1])
    if kind == "edge":
        return _EDGE
    if kind == "alt":
        return _either([_facts(n) for n in node[1]])
    if kind == "seq":
        out = _exactly(_NOTHING)
        for n in node[1]:
            out = _then(out, _facts(n))
        return out
    _, inner, least, most = node
    one, base = _facts(inner), _exactly(_NOTHING)
    for _ in range(min(least, WRITTEN)):
        base = _then(base, one)
    if most == least <= WRITTEN:
        return base
    if most is not None and most <= WRITTEN and one.exact:
        powers = [base]
        for _ in range(most - least):
            powers.append(_then(powers[-1], one))
        return _either(powers)
    # at least as often: begins and ends like the least, with anything between
    return Facts(None, False, base.starts, base.ends, base.cover)


def facts(pattern: str) -> Facts:
    """Facts of a pattern; those of any text if it cannot be parsed."""
    try:
        return _facts(_Parser(pattern).whole())
    except (_Unknown, RecursionError):
        return _ANY


def plain_texts(pattern: str) -> list[str] | None:
    """Every text that the pattern matches, if those are at most ``MAX_TEXTS``."""
    f = facts(pattern)
    return sorted(f.exact) if f.exact and f.sure and "" not in f.exact else None


def cover(pattern: str) -> list[str] | None:
    """Texts of which every match contains at least one, none within another;
    None where there are none, or only such as occur too often to search for."""
    texts = facts(pattern).cover
    if not texts:
        return None
    least = _least(texts)
    return least if cost(least) <= FREQUENT else None


def _least(texts) -> list[str]:
    return sorted(t for t in texts if not any(o != t and o in t for o in texts))


def _open(node) -> int:
    """How many repeats without an end a match can pass (two: several)."""
    kind = node[0]
    if kind in ("seq", "alt"):
        return sum(map(_open, node[1]))
    if kind != "repeat":
        return 0
    _, inner, _, most = node
    return 1 + 2 * _open(inner) if most is None else _open(inner) * (1 if most == 1 else 2)


def _grown(node, by: int):
    """The tree whose repeats without an end repeat ``by`` times more at least."""
    kind = node[0]
    if kind in ("seq", "alt"):
        return (kind, [_grown(n, by) for n in node[1]])
    if kind == "repeat":
        return ("repeat", node[1], node[2] + by, None) if node[3] is None else ("repeat", _grown(node[1], by), *node[2:])
    return node


def _spelled(node, extra: int) -> frozenset:
    """All texts of a node, a dot for any character; repeats without an end repeat
    at most ``extra`` times more than they must."""
    kind = node[0]
    if kind == "any":
        return frozenset(".")
    if kind == "chars" and node[1] is not None and "." not in node[1]:
        return node[1]
    if kind == "alt":
        out = frozenset().union(*(_spelled(n, extra) for n in node[1]))
    elif kind == "seq":
        out = _NOTHING
        for n in node[1]:
            out = _crossed(out, _spelled(n, extra))
            if not out:
                raise _Unknown
    elif kind == "repeat":
        _, inner, least, most = node
        most = least + extra if most is None else most
        if most > WRITTEN:
            raise _Unknown
        one, power, out = _spelled(inner, extra), _NOTHING, frozenset()
        for n in range(most + 1):
            out = out | power if n >= least else out
            power = (_crossed(power, one) if n < most else power)
            if not power:
                raise _Unknown
    else:
        raise _Unknown
    if len(out) > MAX_TEXTS:
        raise _Unknown
    return out


def wild_texts(pattern: str) -> tuple[list[str], list[str]] | None:
    """Texts, in which a dot is any character but a line's end, and texts of which
    each match that holds none of the former contains at least one; None where the
    pattern does not come down to these.  A run without an end is spelled out until
    the longer ones are ``RARE``."""
    try:
        tree = _Parser(pattern).whole()
        runs = _open(tree)
        for extra in range(WRITTEN if runs == 1 else 1 - min(runs, 1)):
            texts = _spelled(tree, extra)
            if "" in texts:
                return None
            longer = _facts(_grown(tree, extra + 1)).cover if runs else _NOTHING
            if not runs or longer and cost(longer) <= RARE:
                return sorted(texts), _least(longer) if runs else []
    except (_Unknown, RecursionError):
        pass
    return None
