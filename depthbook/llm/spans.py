"""Where a pattern matches in a text, in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from depthbook.llm.common import let

#: Positions are sums over up to k lengths. Summing blocks first keeps k matches at about k * BLOCK steps.
BLOCK = 128


def _running(steps: Column) -> Column:
    """Inclusive running sums of an array that is not empty."""
    add = lambda a, x: a + x
    zero = F.lit(0).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")),
        lambda j: F.aggregate(F.slice(steps, j * BLOCK + 1, F.lit(BLOCK)), zero, add),
    )
    return let(
        blocks,
        lambda sums: F.transform(
            steps,
            lambda _, i: F.aggregate(F.slice(sums, F.lit(1), F.floor(i / BLOCK).cast("int")), zero, add)
            + F.aggregate(F.slice(steps, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1), zero, add),
        ),
    )


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """The leftmost non-overlapping matches: array of (start, end, value), in characters, end exclusive.

    The text between matches has the lengths that a split at the pattern gives, so positions are sums of lengths.
    `value` is the given group. A pattern must not match the empty text.
    """
    of = F.struct(
        text.alias("t"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )

    def placed(s: Column) -> Column:
        gaps = F.transform(F.split(s["t"], pattern, -1), lambda g: F.length(g))
        lengths = F.transform(s["hits"], lambda h: F.length(h))

        def at(b: Column) -> Column:
            steps = F.transform(b["lengths"], lambda _, i: F.get(b["gaps"], i) + F.coalesce(F.get(b["lengths"], i - 1), F.lit(0)))
            starts = let(steps, _running)
            return F.zip_with(
                starts,
                F.arrays_zip(b["lengths"].alias("n"), b["values"].alias("v")),
                lambda p, h: F.struct(p.alias("start"), (p + h["n"]).alias("end"), h["v"].alias("value")),
            )

        return let(F.struct(gaps.alias("gaps"), lengths.alias("lengths"), s["values"].alias("values")), at)

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(of, lambda s: F.when(F.size(s["hits"]) == 0, none).otherwise(placed(s)))
