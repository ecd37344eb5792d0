"""Columns of the caller that have the name of a helper column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def apart(docs: DataFrame, helpers: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` without columns named like one of ``helpers`` (in any case of letters), as these are renamed; and their own names by the new ones.

    ``withColumnsRenamed`` with the second brings the names back. Where no name is shared nothing changes.
    """
    taken = {c.lower() for c in docs.columns} | {h.lower() for h in helpers}
    back = {}
    for c in docs.columns:
        if c.lower() in {h.lower() for h in helpers}:
            new = f"{c}_given"
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            back[new] = c
    return docs.withColumnsRenamed({old: new for new, old in back.items()}), back
