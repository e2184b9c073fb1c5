"""Leaves of JSON documents, taken apart inside Arrow tasks; the module travels with the task."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import cloudpickle

LEAVES = "array<struct<steps: array<string>, kind: string, value: string>>"


class Number(str):
    """A number as the document spells it."""


def leaves(text: str | None) -> list[tuple[list[str], str, str | None]]:
    """(steps, kind, value) of every leaf. An empty object is a leaf of kind ``object``, a missing document an empty object.

    Text that is no JSON, or is nested deeper than the parser goes (thousands of levels), is one leaf of kind ``text``.
    """
    if text is None:
        return [([], "object", "{}")]
    try:
        top = json.loads(text, parse_int=Number, parse_float=Number, parse_constant=Number)
    except (ValueError, RecursionError):
        return [([], "text", text)]
    return list(walk(top))


def walk(top) -> Iterator[tuple[list[str], str, str | None]]:
    left = [((), top)]
    while left:
        steps, x = left.pop()
        if isinstance(x, dict) and x:
            left += [((*steps, k), child) for k, child in x.items()]
        else:
            yield list(steps), kind_of(x), as_text(x)


def kind_of(x) -> str:
    if x is None:
        return "null"
    return {Number: "number", str: "string", bool: "boolean", dict: "object", list: "array"}[type(x)]


def as_text(x) -> str | None:
    """A string's own characters, any other value as JSON without spaces; null stays null."""
    return None if x is None else str(x) if isinstance(x, str) else as_json(x)


def as_json(x) -> str:
    if isinstance(x, Number):
        return str(x)
    if isinstance(x, list):
        return "[" + ",".join(map(as_json, x)) + "]"
    if isinstance(x, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{as_json(v)}" for k, v in x.items()) + "}"
    return json.dumps(x, ensure_ascii=False)


def leaves_of(docs: pd.Series) -> pd.Series:
    return pd.Series([[{"steps": s, "kind": k, "value": v} for s, k, v in leaves(d)] for d in docs], dtype=object)


def overlay(left: Iterable[str], right: Iterable[str]) -> Iterator[tuple[list[str], str, str | None]]:
    """Leaves of the left documents that the right ones leave in place, then those the right ones bring."""
    l, r = ([(tuple(s), k, v) for d in docs for s, k, v in leaves(d)] for docs in (left, right))
    plain = {s for s, k, _ in r if k != "object"}
    # right objects stand at all places above right leaves; what the left has exactly there is replaced
    taken = {s for s, _, _ in r} | {up for s, _, _ in r for up in upper(s)}
    filled = {up for s, _, _ in l for up in upper(s)}
    for s, k, v in l:
        if s not in taken and plain.isdisjoint(upper(s)):
            yield list(s), k, v
    for s, k, v in r:
        if k != "object" or s not in filled:
            yield list(s), k, v


def upper(steps: tuple[str, ...]) -> Iterator[tuple[str, ...]]:
    """All proper beginnings of a list of steps, the empty one included."""
    return (steps[:n] for n in range(len(steps)))


def overlays_of(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series([[{"steps": s, "kind": k, "value": v} for s, k, v in overlay(l, r)] for l, r in zip(left, right)], dtype=object)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
