"""Regular expressions as join keys: what a pattern requires of a text, as a
tree of character grams, and a cover of it that an equi-join can look up.

A pattern is read once (distinct patterns only).  ``required`` turns it into a
tree: a gram (a run of up to GRAM characters that every match holds), an AND
of trees, an OR of trees, or nothing (matches need not hold anything).  With
the number of texts that hold each gram, ``cover`` picks the cheapest set of
grams such that every match holds at least one: the cheapest child of an AND,
all children of an OR.  Texts are then joined by gram and verified by
``rlike``, so the join has a key whatever the pattern, unless the pattern
requires nothing at all.

Patterns have the meaning of ``re.search`` (the original filter): unanchored,
case-sensitive, ``.`` and ``$`` know only ``\\n``, classes like ``\\w`` are
Unicode's.  ``java_pattern`` writes the same pattern for ``rlike``; one that
cannot be read matches nothing instead of ending the job.
"""

from __future__ import annotations

import json
import re
import warnings
from re import _constants as C
from re import _parser as P

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAM = 3
CLASS_CHARS = 16  # a class of at most this many single characters is an OR of them

Tree = str | list | None  # gram, ["and" | "or", *trees], nothing required


def _all_of(trees: list) -> Tree:
    flat = []
    for t in trees:
        flat += t[1:] if isinstance(t, list) and t[0] == "and" else [] if t is None else [t]
    flat = [t for i, t in enumerate(flat) if t not in flat[:i]]
    return None if not flat else flat[0] if len(flat) == 1 else ["and", *flat]


def _one_of(trees: list) -> Tree:
    if not trees or any(t is None for t in trees):
        return None
    trees = [t for i, t in enumerate(trees) if t not in trees[:i]]
    return trees[0] if len(trees) == 1 else ["or", *trees]


def _grams(run: str) -> list:
    return [run[i:i + GRAM] for i in range(max(1, len(run) - GRAM + 1))] if run else []


def _walk(items, run: str, found: list) -> str:
    """Add what a sequence requires to ``found``; returns the literal run that
    is still open at its end."""
    for op, arg in items:
        if op is C.LITERAL:
            run += chr(arg)
        elif op in (C.AT, C.ASSERT, C.ASSERT_NOT):  # nothing is consumed: its neighbours stay adjacent
            continue
        elif op is C.SUBPATTERN and not arg[1] and not arg[2]:
            run = _walk(arg[3], run, found)
        elif op is C.ATOMIC_GROUP:
            run = _walk(arg, run, found)
        else:
            found += _grams(run)
            run = ""
            if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] >= 1:
                found.append(_sequence(arg[2]))
            elif op is C.BRANCH:
                found.append(_one_of([_sequence(b) for b in arg[1]]))
            elif op is C.IN and len(arg) <= CLASS_CHARS and all(o is C.LITERAL for o, _ in arg):
                found.append(_one_of([chr(a) for _, a in arg]))
    return run


def _sequence(items) -> Tree:
    found: list = []
    run = _walk(items, "", found)
    return _all_of([*found, *_grams(run)])


def _parsed(pattern: str):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        re.compile(pattern)
        return P.parse(pattern)


def required(pattern: str) -> Tree:
    """The gram tree of a readable pattern (re.error otherwise).  A pattern
    that ignores case requires nothing that a gram could say."""
    tree = _parsed(pattern)
    return None if tree.state.flags & re.IGNORECASE else _sequence(tree)


def grams_of(tree: Tree) -> set[str]:
    if isinstance(tree, list):
        return set().union(*(grams_of(t) for t in tree[1:]))
    return set() if tree is None else {tree}


def cover(tree: Tree, texts: dict[str, int]) -> tuple[int, list[str]]:
    """(texts met, grams) of the cheapest grams one of which every match
    holds; a gram that no text holds costs nothing."""
    if isinstance(tree, list):
        parts = [cover(t, texts) for t in tree[1:]]
        if tree[0] == "and":
            return min(parts, key=lambda p: (p[0], len(p[1]), p[1]))
        return sum(p[0] for p in parts), sorted({g for p in parts for g in p[1]})
    return texts.get(tree, 0), [tree]


# What only one of the two engines reads.
_UNREADABLE = re.compile(r"\(\?\(|\(\?[aLu]|\\[0N]|\(\?[a-z]*[aLu][a-z]*[:)]")
_COUNT = re.compile(r"\{(\d*)(,?)(\d*)\}")


def java_pattern(pattern: str) -> str | None:
    """The pattern for ``rlike``, or None when it cannot be read."""
    try:
        _parsed(pattern)
    except (re.error, OverflowError, RecursionError):
        return None
    if _UNREADABLE.search(pattern):
        return None
    out, i, in_class, classes = [], 0, False, False
    while i < len(pattern):
        c, two = pattern[i], pattern[i:i + 2]
        if c == "\\":
            classes |= two[1:] in tuple("wWdDsSbB")
            out.append({"\\Z": "\\z", "\\v": "\\x0B"}.get(two, two))
            i += 2
            continue
        if in_class:
            first = out[-1] in ("[", "[^")
            if c == "]" and not first:
                in_class = False
                out.append(c)
            else:
                out.append("\\" + c if c in "[]&^" else c)
        elif c == "[":
            in_class = True
            out.append("[^" if two == "[^" else "[")
            i += two == "[^"
        elif pattern.startswith("(?P<", i):
            out.append("(?<")
            i += 3
        elif pattern.startswith("(?P=", i):
            end = pattern.index(")", i)
            out.append(f"\\k<{pattern[i + 4:end]}>")
            i = end
        elif c == "{":
            m = _COUNT.match(pattern, i)
            if m and (m[1] or m[2]):
                out.append("{" + (m[1] or "0") + m[2] + m[3] + "}")
                i = m.end() - 1
            else:
                out.append("\\{")
        else:
            out.append("\\}" if c == "}" else c)
        i += 1
    return ("(?dU)" if classes else "(?d)") + "".join(out)


PATTERNS = "pattern string, java string, tree string, grams array<string>"


def _read(batches):
    for pdf in batches:
        rows = []
        for p in pdf["pattern"]:
            java = java_pattern(p)
            if java is not None:
                tree = required(p)
                rows.append((p, java, json.dumps(tree), sorted(grams_of(tree))))
        yield pd.DataFrame(rows, columns=["pattern", "java", "tree", "grams"])


def read_patterns(patterns: DataFrame) -> DataFrame:
    """Readable patterns only: pattern, java, tree (JSON), grams.  ``patterns``
    has one column, ``pattern``, of distinct values."""
    return patterns.mapInPandas(_read, PATTERNS)


def chosen():
    """Arrow-batched function: the cover of each tree, given the texts that
    hold its grams (an array of (gram, n) structs); empty where nothing is
    required."""
    @F.pandas_udf("array<string>")
    def covers(trees: pd.Series, held: pd.Series) -> pd.Series:
        out = []
        for tree, rows in zip(trees, held):
            tree = json.loads(tree)
            out.append([] if tree is None else cover(tree, {r["gram"]: r["n"] for r in (rows if rows is not None else [])})[1])
        return pd.Series(out, dtype=object)

    return covers
