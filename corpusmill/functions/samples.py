"""Fixed-length samples: padding, loss masks and the one-step shift."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def truncate_pad(ids: Column, max_length: int, pad_id: int) -> Column:
    kept = F.slice(ids, 1, max_length)
    missing = F.greatest(F.lit(max_length) - F.size(ids), F.lit(0))
    return F.concat(kept, F.array_repeat(F.lit(pad_id), missing))


def _bits(value: int, count: Column) -> Column:
    return F.array_repeat(F.lit(value).cast("tinyint"), count)


def length_mask(ids: Column, max_length: int) -> Column:
    """1 on each real position, 0 on the padding, judged by the unpadded length."""
    real = F.least(F.size(ids), F.lit(max_length))
    return F.concat(_bits(1, real), _bits(0, F.lit(max_length) - real))


def pad_value_mask(padded: Column, pad_id: int) -> Column:
    """0 wherever the id equals the padding id, also inside the text."""
    return F.transform(padded, lambda x: (x != pad_id).cast("tinyint"))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once: a lambda variable is not computed again per use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def assistant_mask(ids: Column, header: Sequence[int], end_id: int) -> Column:
    """1 from after each header through the next ``end_id``; 0 elsewhere.

    Headers are taken left to right without overlap; one without a later end adds nothing.
    The spans are few, so each position is tested against the span list inside the row.
    """
    header = list(header)
    width = len(header)
    pattern = F.array(*[F.lit(h) for h in header])
    nothing = F.array().cast("array<int>")

    def starts(xs: Column) -> Column:
        positions = F.when(
            F.size(xs) >= width, F.sequence(F.lit(1), F.size(xs) - (width - 1))
        ).otherwise(nothing)
        matches = F.filter(
            positions,
            lambda i: (F.element_at(xs, i) == header[0]) & (F.slice(xs, i, width) == pattern),
        )
        return F.aggregate(
            matches,
            nothing,
            lambda kept, i: F.when(
                i >= F.coalesce(F.array_max(kept), F.lit(0)), F.concat(kept, F.array(i + width))
            ).otherwise(kept),
        )

    def ends(xs: Column) -> Column:
        return F.filter(
            F.transform(xs, lambda x, i: F.when(x == end_id, i + 1)), lambda e: e.isNotNull()
        )

    def spans(xs: Column) -> Column:
        def span(s: Column, es: Column) -> Column:
            last = F.array_min(F.filter(es, lambda e: e >= s))
            return F.struct(s.alias("first"), last.alias("last"))

        return bind(ends(xs), lambda es: F.transform(starts(xs), lambda s: span(s, es)))

    def covered(i: Column, found: Column) -> Column:
        return F.exists(
            found, lambda s: F.coalesce((i + 1).between(s["first"], s["last"]), F.lit(False))
        )

    return bind(
        ids,
        lambda xs: bind(
            spans(xs),
            lambda found: F.transform(xs, lambda _, i: covered(i, found).cast("tinyint")),
        ),
    )


def shift_xy(padded: Column, mask: Column) -> Column:
    """``struct<x, y, mask>``: inputs, next-token targets and the mask of the targets."""
    n = F.size(padded) - 1
    return F.struct(
        F.slice(padded, F.lit(1), n).alias("x"),
        F.slice(padded, F.lit(2), n).alias("y"),
        F.slice(mask, F.lit(2), n).alias("mask"),
    )
