"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def pluck(structs: Column, field: str) -> Column:
    """Array of structs -> array of one field; a missing array becomes an empty one."""
    values = F.transform(structs, lambda s: s[field])
    return F.coalesce(values, F.array())


def array_len(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0))


def concat_arrays(*items: Column) -> Column:
    return F.concat(*[F.coalesce(c, empty_strings()) for c in items])


def non_empty_items(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def paired_items(items: Column) -> Column:
    """(x0,x1), (x2,x3), ... non-overlapping pairs; an odd last item has no partner."""
    starts = F.sequence(F.lit(1), F.size(items) - F.lit(1), F.lit(2))
    pairs = F.transform(
        starts,
        lambda i: F.struct(F.element_at(items, i).alias("src"), F.element_at(items, i + 1).alias("dst")),
    )
    return F.when(F.size(items) > 1, pairs)


def revive_list(text: Column, item_type: str = "string") -> Column:
    """Typed array from a legacy text cell such as ``"['A', 'A']"``."""
    return F.from_json(text, f"array<{item_type}>", {"allowSingleQuotes": "true"})
