"""Where the rows of a frame come from, and a gate on it: what feeds a model may only be read from listed places."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from cohortlift.session import stored_from

#: Leaves of a plan that read nothing.
CONSTANT = {"LocalRelation", "OneRowRelation", "Range", "CTERelationRef"}


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _plain(path: str) -> str:
    """A path without the empty authority of local files, so that one place has one name."""
    head, _, rest = path.partition("://")
    return (f"{head}://{rest}" if rest and head != "file" else path.removeprefix("file:").replace("//", "/")).rstrip("/")


def sources_of(df: DataFrame) -> set[str]:
    """The paths that the plan of ``df`` reads, subqueries included; nothing is run.

    Tables stored by ``materialise`` count as what they were made from. A leaf whose origin the plan doesn't tell (a cached or checkpointed
    frame, rows from the driver) appears by its kind in angle brackets.
    """
    found: set[str] = set()
    left = [df._jdf.queryExecution().analyzed()]
    while left:
        node = left.pop()
        below = _items(node.children())
        left += below + _items(node.subqueries())
        kind = node.getClass().getSimpleName()
        if below or kind in CONSTANT:
            continue
        if kind != "LogicalRelation" or node.relation().getClass().getSimpleName() != "HadoopFsRelation":
            found.add(f"<{kind}>")
            continue
        for path in _items(node.relation().location().rootPaths()):
            origin = stored_from(_plain(path.toString()))
            found |= {_plain(path.toString())} if origin is None else sources_of(origin)
    return found


def refused(df: DataFrame, allowed: Iterable[str]) -> list[str]:
    """The sources of ``df`` that lie neither at nor below an allowed path."""
    roots = [_plain(a) for a in allowed]
    return sorted(s for s in sources_of(df) if not any(s == r or s.startswith(r + "/") for r in roots))


def require_sources(df: DataFrame, allowed: Iterable[str]) -> DataFrame:
    """``df``, if everything it reads is allowed; an error that names the rest otherwise."""
    if other := refused(df, allowed):
        raise ValueError(f"reads from {other}, which is not allowed here")
    return df
