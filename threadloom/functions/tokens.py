"""Token-array expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# Fixed value: label that a loss ignores.
IGNORED_LABEL = -100


def let(body: Callable[[Column], Column], **values: Column) -> Column:
    """Evaluate ``values`` once per row and hand them to ``body`` as struct fields.

    An expression that is named inside an element lambda is evaluated again for
    every element; bound here, it is only read.
    """
    held = F.array(F.struct(*[value.alias(name) for name, value in values.items()]))
    return F.element_at(F.transform(held, body), 1)


def keep_first(ids: Column, n: int | None) -> Column:
    return ids if n is None else F.slice(ids, 1, n)


def keep_last(ids: Column, n: int | None) -> Column:
    """Last ``n`` ids. ``n == 0`` keeps everything, as a ``[-0:]`` slice does."""
    if n is None or n == 0:
        return ids
    return F.when(F.size(ids) > n, F.slice(ids, -n, n)).otherwise(ids)


def with_eos(ids: Column, eos: int) -> Column:
    return F.array_append(ids, F.lit(eos))


def with_eos_if_missing(ids: Column, eos: int) -> Column:
    last = F.try_element_at(ids, F.lit(-1))
    return F.when(last == eos, ids).otherwise(F.array_append(ids, F.lit(eos)))


def with_bos_if_missing(ids: Column, bos: int | None) -> Column:
    if bos is None:
        return ids
    first = F.try_element_at(ids, F.lit(1))
    return F.when(first == bos, ids).otherwise(F.array_prepend(ids, F.lit(bos)))


def ignored(n: Column) -> Column:
    """``n`` ignored labels."""
    return F.array_repeat(F.lit(IGNORED_LABEL).cast("bigint"), n)


def pad_right(ids: Column, length: Column, value) -> Column:
    missing = F.greatest(length - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(value), missing.cast("int")))


def first_position(ids: Column, token: int) -> Column:
    """Zero-based index of the first ``token``; the length when it is absent."""
    found = F.array_position(ids, token).cast("int")
    return F.when(found > 0, found - 1).otherwise(F.size(ids))


def completion_mask(ids: Column, eos: int) -> Column:
    """1 up to and including the first end token, 0 after it."""
    return let(
        lambda s: F.transform(s["ids"], lambda _, i: F.when(i <= s["end"], 1).otherwise(0)),
        ids=ids,
        end=first_position(ids, eos),
    )


def cut_at_stop(ids: Column, stop: int, pad: int) -> Column:
    """Replace everything after the first stop token by padding."""
    padding = F.lit(pad).cast("bigint")
    return let(
        lambda s: F.transform(s["ids"], lambda x, i: F.when(i <= s["end"], x).otherwise(padding)),
        ids=ids,
        end=first_position(ids, stop),
    )


def fill_past(values: Column, length: Column, sentinel: float) -> Column:
    """Per-token values with everything past index ``length`` replaced."""
    return let(
        lambda s: F.transform(
            s["values"], lambda x, i: F.when(i > s["length"], F.lit(sentinel)).otherwise(x)
        ),
        values=values,
        length=length,
    )


def masked_reduce(values: Column, labels: Column, average: bool = False) -> Column:
    """Sum (or mean) of per-token values whose label is not ignored."""
    total = F.aggregate(
        F.zip_with(
            values, labels, lambda v, l: F.when(l != IGNORED_LABEL, v.cast("double")).otherwise(0.0)
        ),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    if not average:
        return total
    kept = F.size(F.filter(labels, lambda l: l != IGNORED_LABEL))
    return F.when(kept > 0, total / kept)


def mask_before_template(ids: Column, template: list[int]) -> Column:
    """Labels that ignore everything up to the end of the last template match.

    Without a match the whole row is ignored.
    """
    n = len(template)

    def matches(held: Column, i: Column) -> Column:
        test = F.lit(True)
        for j, token in enumerate(template):
            test = test & F.coalesce(F.get(held, i + j) == token, F.lit(False))
        return test

    def labels(s: Column) -> Column:
        end = F.aggregate(
            F.sequence(F.lit(0), F.size(s["ids"])),
            F.lit(-1),
            lambda acc, i: F.when(matches(s["ids"], i), i + n).otherwise(acc),
        )
        return let(
            lambda t: F.transform(
                t["ids"],
                lambda x, i: F.when((t["end"] < 0) | (i < t["end"]), ignored_label).otherwise(x),
            ),
            ids=s["ids"],
            end=end,
        )

    ignored_label = F.lit(IGNORED_LABEL).cast("bigint")
    return let(labels, ids=ids)
