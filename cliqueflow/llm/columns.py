"""Column names: those that an operator adds beside columns of its input that bear the same name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def free_name(taken: list[str], name: str) -> str:
    """``name``, with as many underscores in front as it takes to differ from all of ``taken``, whatever the case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def set_apart(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns renamed that clash with ``added``, and the names to give back (renamed -> own)."""
    taken, back = [*docs.columns, *added], {}
    for c in docs.columns:
        if c.lower() in {a.lower() for a in added}:
            back[name := free_name([*taken, *back], c)] = c
    return docs.withColumnsRenamed({c: name for name, c in back.items()}), back
