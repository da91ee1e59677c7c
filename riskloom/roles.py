"""Column roles of an application table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

FILL_VALUE = -999999.0


@dataclass(frozen=True)
class Roles:
    """Names of the key, time, target and split columns; everything else is a feature."""

    key: str = "apply_no"
    time: str = "apply_time"
    target: str = "target"
    split: str = "type"
    ignore: tuple[str, ...] = field(default_factory=tuple)

    def features(self, df: DataFrame) -> list[str]:
        taken = {self.key, self.time, self.target, self.split, "month", *self.ignore}
        return [c for c in df.columns if c not in taken]


def numeric_columns(df: DataFrame, columns: list[str] | None = None) -> list[str]:
    wanted = set(columns if columns is not None else df.columns)
    return [
        f.name for f in df.schema.fields if f.name in wanted and isinstance(f.dataType, T.NumericType)
    ]
