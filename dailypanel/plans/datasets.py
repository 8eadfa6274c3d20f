"""Training datasets on top of the ready panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dailypanel.operators.scale import scale_by_entity
from dailypanel.operators.sequences import padded_sequences
from dailypanel.operators.split import chrono_split


def sequence_dataset(
    ready: DataFrame, features: list[str], target: str, length: int, kind: str = "standard"
) -> DataFrame:
    """Chronological split, scaling by entity and padded sequences inside each part.

    Write it with ``partitionBy("split")`` to hand it to a trainer.
    """
    parts = scale_by_entity(chrono_split(ready), features, kind)
    return padded_sequences(parts, features, target, length, ("entity", "split"))
