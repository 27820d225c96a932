"""Append that ignores rows whose key is already there."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from chartmart.operators.joins import drop_keys
from chartmart.operators.rows import Order, first_per


def append_new(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Order | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Rows of ``incoming`` to append: the first of each key, of keys unknown to ``existing``.

    Without ``order`` the incoming rows must already be unique by key.
    """
    fresh = incoming if order is None else first_per(incoming, keys, order)
    return fresh if existing is None else drop_keys(fresh, existing, keys, null_safe)
