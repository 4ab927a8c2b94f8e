"""Hooks by id: named changes of one source at set points, each a function from frame to frame.

A family is the point at which a hook is applied.  What a hook may do there is
checked when it is applied: it keeps the family's columns, those of the lineage,
and where the family says so, the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import col
from tidemark.operators.lineage import LINEAGE

Change = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Family:
    """The columns that a hook of the family must keep; whether it may add, drop or repeat rows; columns that it may not change."""

    keeps: tuple[str, ...]
    rows: bool = True
    fixed: tuple[str, ...] = ()


#: The points of a run: of its plan, its landed results and what is handed on; of paged requests; of catalogs; and of files.
FAMILIES = {
    "plan": Family(("request_key",)),
    "result": Family(("path", "format")),
    "handoff": Family(("path", "format")),
    "metadata": Family(("key", "value")),
    "request": Family(("request_key", "url"), rows=False, fixed=("request_key",)),
    "response": Family(("request_key", "payload"), rows=False, fixed=("request_key",)),
    "payload": Family(("request_key", "payload"), rows=False, fixed=("request_key",)),
    "records": Family(("request_key", "record_index", "record")),
    "cursor": Family(("request_key", "next_cursor"), rows=False, fixed=("request_key",)),
    "checkpoint": Family(("request_key", "checkpoint"), rows=False, fixed=("request_key",)),
    "entities": Family(("entity_type", "data", "path")),
    "discovered": Family(("path",)),
    "links": Family(("path", "url")),
    "version": Family(("path", "version"), rows=False, fixed=("path",)),
    "checksum": Family(("path", "expected"), rows=False, fixed=("path",)),
    "download": Family(("path", "content"), rows=False, fixed=("path",)),
    "members": Family(("archive", "member", "payload")),
}


class Hooks:
    """The hooks that are known, by family and id."""

    def __init__(self) -> None:
        self._known: dict[tuple[str, str], Change] = {}

    def register(self, family: str, name: str) -> Callable[[Change], Change]:
        """A decorator that makes a change known as ``name``."""
        if family not in FAMILIES:
            raise ValueError(f"unknown family {family!r}; known: {', '.join(sorted(FAMILIES))}")

        def known(change: Change) -> Change:
            if (family, name) in self._known:
                raise ValueError(f"hook {name!r} of family {family!r} is known already")
            self._known[family, name] = change
            return change

        return known

    def apply(self, df: DataFrame, family: str, names: Sequence[str] = ()) -> DataFrame:
        """``df`` through the named hooks, in their order; without names as it is.

        A column that a hook drops is an error at once; so is, when the frame is
        read, a row of a family of fixed rows whose fixed columns are changed to NULL.
        """
        rule = FAMILIES[family]
        for name in names:
            if (family, name) not in self._known:
                raise ValueError(f"no hook {name!r} of family {family!r}")
            absent = [c for c in rule.keeps if c not in df.columns]
            if absent:
                raise ValueError(f"family {family!r} needs the columns {', '.join(absent)}")
            before = df
            df = self._known[family, name](df)
            kept = [*rule.keeps, *[c for c in LINEAGE if c in before.columns]]
            dropped = [c for c in kept if c not in df.columns]
            if dropped:
                raise ValueError(f"hook {name!r} drops {', '.join(dropped)}")
            for c in rule.fixed:
                held = F.when(col(c).isNull(), F.raise_error(F.lit(f"hook {name} leaves {c} empty")).cast(df.schema[c].dataType)).otherwise(col(c))
                df = df.withColumn(c, held)
        return df

    def checked(self, df: DataFrame, family: str, names: Sequence[str], key: Sequence[str]) -> DataFrame:
        """As ``apply``, with the rows of families of fixed rows compared by key when both are at hand: ``ValueError`` if a hook adds, drops or repeats any."""
        out = self.apply(df, family, names)
        if not names or FAMILIES[family].rows:
            return out
        keys = lambda frame: frame.select(*[col(k) for k in key])
        differing = keys(df).exceptAll(keys(out)).unionAll(keys(out).exceptAll(keys(df)))
        if not differing.isEmpty():
            raise ValueError(f"hooks {', '.join(names)} change the rows of family {family!r}")
        return out

