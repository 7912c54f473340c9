"""Repeatable row selection by hash: no shuffle, no random state, same on every retry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_sql(tag: str, keys: list[str]) -> str:
    """md5 hex of ``tag|key-key-...`` as SQL; rows get an independent draw per tag."""
    columns = ", ".join(f"CAST({k} AS STRING)" for k in keys)
    return f"md5(concat('{tag}|', concat_ws('-', {columns})))"


def tagged_hash(tag: str, keys: list[str]) -> Column:
    return F.expr(hash_sql(tag, keys))


def hash_number(tag: str, keys: list[str]) -> Column:
    """The first fifteen hex digits of the hash as a BIGINT."""
    return F.expr(f"CAST(conv(substr({hash_sql(tag, keys)}, 1, 15), 16, 10) AS BIGINT)")


def selected_sql(tag: str, keys: list[str], share: float) -> str:
    """Condition that holds for ``share`` of the rows but for chance (resolution 2**-60)."""
    cut = int(share * 16**15)
    return "true" if cut >= 16**15 else f"substr({hash_sql(tag, keys)}, 1, 15) < '{cut:015x}'"


def selected(tag: str, keys: list[str], share: float) -> Column:
    return F.expr(selected_sql(tag, keys, share))
