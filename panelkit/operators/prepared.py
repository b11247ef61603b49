"""A preparation that is learnt on some rows and applied to others.

With ``fit_on="train"`` no statistic of the test rows enters the features: which columns
are kept, outlier bounds, medians, correlations and the scaling all come from
the training rows. Row-wise steps (text, codes, types, target) learn nothing but the types of the columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import columns as C
from panelkit.functions import scalars as S
from panelkit.functions.constants import PRIORITY_FEATURES, SPARSE_THRESHOLD
from panelkit.operators import clean as CL
from panelkit.operators import features as FE
from panelkit.operators import stats as ST


def _number(c: str):
    return S.nan_to_null(F.col(f"`{c}`").cast("double"))


@dataclass
class Preparation:
    """What was learnt: the features in order, their medians, outlier bounds, and (mean, deviation)."""

    features: list
    medians: dict
    bounds: dict
    scaler: dict
    strictness: str

    @classmethod
    def fit(cls, train: DataFrame, target: str, n_features: int = 20, strictness: str = "moderate",
            priority=tuple(PRIORITY_FEATURES), exclude=()) -> Preparation:
        """Learn from ``train``: drop sparse and constant columns, bounds of the quartiles (rows outside don't
        count for what follows), medians, then the features by correlation with the target, and their scale.
        ``strictness`` "none" takes no row for an outlier."""
        numeric = [c for c in C.numeric_cols(train, exclude={target, *exclude})]
        frame = train.select(target, *[_number(c).alias(c) for c in numeric])
        dropped = {*CL.sparse_columns(frame, SPARSE_THRESHOLD, priority), *CL.constant_columns(frame)}
        keep = [c for c in numeric if c not in dropped]
        bounds = {}
        if strictness != "none":
            bounds = {c: b[:2] for c, b in CL.outlier_bounds(frame, keep).items() if b[2]}
        prep = cls(keep, {}, bounds, {}, strictness)
        frame = prep.inliers(frame)
        prep.medians = {c: v if v is not None else 0.0 for c, v in ST.medians(frame, keep).items()}
        filled = prep._filled(frame.select(target, *keep))
        prep.features = FE.select_features(filled, target, priority, n_features)
        prep.scaler = FE.fit_scaler(filled, prep.features)
        return prep

    def inliers(self, df: DataFrame) -> DataFrame:
        """The rows that the learnt bounds don't flag (strict: in any column, else in more than half of them)."""
        if not self.bounds:
            return df
        flags = [F.coalesce((_number(c) < lo) | (_number(c) > hi), F.lit(False)).cast("int")
                 for c, (lo, hi) in self.bounds.items()]
        total = flags[0]
        for f in flags[1:]:
            total = total + f
        return df.where(total <= (0 if self.strictness == "strict" else len(flags) / 2))

    def _filled(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(_number(c), F.lit(float(m))) for c, m in self.medians.items() if c in df.columns})

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with its features filled by the learnt medians and scaled; a feature it lacks is its median."""
        missing = {c: F.lit(None).cast("double") for c in self.features if c not in df.columns}
        return FE.apply_scaler(self._filled(df.withColumns(missing) if missing else df), self.scaler)
