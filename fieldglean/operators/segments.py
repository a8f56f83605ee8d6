"""Patterns over a text that arrives in parts: the matches of the whole text, without ever holding it.

A match (or its absence) at a place is settled as soon as the engine cannot have looked past what has arrived. How far it can look
follows from the pattern alone: each of its character classes goes on at most to the end of a run of its characters. What is not
settled is carried into the next part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from re import _constants as ops
from re import _parser as parser

#: Characters that are searched at a time.
PART = 1 << 16


def _class_text(op, value) -> str | None:
    """A one-character item of a parsed pattern as pattern text; None if it is something else."""
    if op is ops.LITERAL:
        return re.escape(chr(value))
    if op is ops.NOT_LITERAL:
        return f"[^{re.escape(chr(value))}]"
    if op is ops.ANY:
        return r"[^\n]"
    if op is not ops.IN:
        return None
    names = {ops.CATEGORY_DIGIT: r"\d", ops.CATEGORY_NOT_DIGIT: r"\D", ops.CATEGORY_SPACE: r"\s", ops.CATEGORY_NOT_SPACE: r"\S",
             ops.CATEGORY_WORD: r"\w", ops.CATEGORY_NOT_WORD: r"\W"}
    parts = {ops.NEGATE: lambda v: "^", ops.LITERAL: lambda v: re.escape(chr(v)), ops.CATEGORY: lambda v: names[v],
             ops.RANGE: lambda v: f"{re.escape(chr(v[0]))}-{re.escape(chr(v[1]))}"}
    return "[" + "".join(parts[o](v) for o, v in value) + "]"


def _steps(items) -> Iterator[tuple[str, int | None]]:
    """(class, most characters or None) in the order of the pattern; branches one after another, which can only reach further."""
    for op, value in items:
        if (text := _class_text(op, value)) is not None:
            yield text, 1
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            _, most, inner = value
            one = _class_text(*inner[0]) if len(inner) == 1 else None
            if one is not None:
                yield one, None if most is ops.MAXREPEAT else most
            elif most is ops.MAXREPEAT:
                yield r"[\s\S]", None  # a repeated group may go on to the end
            else:
                for _ in range(most):
                    yield from _steps(inner)
        elif op is ops.SUBPATTERN:
            yield from _steps(value[-1])
        elif op is ops.ATOMIC_GROUP:
            yield from _steps(value)
        elif op is ops.BRANCH:
            for branch in value[1]:
                yield from _steps(branch)
        else:
            raise ValueError(f"{op} looks around a match or back in it")


@cache
def reach_of(pattern: str, flags: int) -> Callable[[str, int], int]:
    """How far into a text an attempt at a place can look, at most. It never falls from one place to the next."""
    steps = [(re.compile(f"(?:{text})*", flags).match, most) for text, most in _steps(parser.parse(pattern, flags))]

    def reach(text: str, at: int) -> int:
        for run, most in steps:
            end = run(text, at).end()
            at = end if most is None else min(end, at + most)
        return at

    return reach


class Segments:
    """Matches of a pattern over the parts of one text, in order: `feed` each part, then `finish`."""

    def __init__(self, pattern: str, flags: int = 0, part: int = PART):
        self._search, self._reach, self._part = re.compile(pattern, flags).search, reach_of(pattern, flags), part
        self._parts: list[str] = []
        self._size, self._next, self.most_held = 0, part, 0

    def feed(self, text: str) -> Iterable[re.Match]:
        self._parts.append(text)
        self._size += len(text)
        self.most_held = max(self.most_held, self._size)
        # What is carried is searched again only when as much has come after it, so time stays in proportion.
        return self._matches(False) if self._size >= self._next else ()

    def finish(self) -> Iterable[re.Match]:
        return self._matches(True)

    def _matches(self, last: bool) -> Iterator[re.Match]:
        text, at = "".join(self._parts), 0
        settled = len(text) if last else self._settled(text)
        while at <= settled and (found := self._search(text, at)) and found.start() <= settled:
            yield found
            at = found.end() + (found.start() == found.end())
        rest = "" if last else text[max(at, settled + 1):] if settled >= 0 else text
        self._parts, self._size = [rest], len(rest)
        self._next = len(rest) + max(len(rest), self._part)

    def _settled(self, text: str) -> int:
        """The last place where an attempt stays within the text; -1 if there is none."""
        low, high = -1, len(text) - 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self._reach(text, middle) < len(text) else (low, middle - 1)
        return low
