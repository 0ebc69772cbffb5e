"""C7 profile-and-clean composite: null percentage -> drop sparse columns
-> fill numeric means / categorical modes -> IQR filters in turn."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import profile as PR


def clean_profile(df: DataFrame, threshold: float = 50.0, iqr_cols: list[str] | None = None) -> DataFrame:
    narrowed = PR.drop_sparse_columns(df, threshold)
    num, cat = PR.columns_by_kind(narrowed)
    filled = PR.fill_mean(narrowed, num) if num else narrowed
    if cat:
        filled = PR.fill_mode(filled, cat)
    cols = [c for c in (iqr_cols or num) if c in filled.columns]
    return PR.filter_iqr_all(filled, cols)
