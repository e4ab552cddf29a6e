"""Feature table to model input: target, split, encoding, scaling."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourweave.functions.scalar import align_features, spread
from hourweave.functions.timeutil import HOUR, KEY
from hourweave.operators.prep import (
    Roles, feature_roles, standardize, standardize_fit, target_encode_apply, target_encode_fit, train_rows,
)
from hourweave.operators.ranking import chronological_split


@dataclass(frozen=True)
class Fitted:
    """What scoring needs: column roles and the two parameter tables."""

    roles: Roles
    encodings: DataFrame
    scaling: DataFrame

    def apply(self, df: DataFrame) -> DataFrame:
        """Encode and scale by name, with the parameters fitted on training rows."""
        encoded = target_encode_apply(df, self.encodings, self.roles.categorical)
        return standardize(encoded, self.scaling, self.roles.continuous)

    def score_input(self, df: DataFrame, keep: tuple[str, ...] = (HOUR,)) -> DataFrame:
        """Bring any frame to the fitted columns first: absent features become 0.0."""
        strings = [c for c in self.roles.categorical if c in df.columns]
        missing = [c for c in self.roles.categorical if c not in df.columns]
        aligned = align_features(df, self.roles.continuous, keep=[*keep, *strings])
        return self.apply(aligned.withColumns({c: F.lit(None).cast("string") for c in missing}))


def prepare(
    features: DataFrame,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, Fitted]:
    """Prepared rows (hour, key as `entity`, split, target, features) and the fitted state.

    The split rows feed both fits and the result, and the fitted tables every later scoring; pass `session.materialise`
    as `store` to write them once instead of deriving them each time. All rows take part.
    """
    data = store(chronological_split(spread(features)))
    roles = feature_roles(data)
    train = train_rows(data)
    fitted = Fitted(roles, store(target_encode_fit(train, roles.categorical)), store(standardize_fit(train, roles.continuous)))
    kept = data.withColumn("entity", F.col(KEY))
    return fitted.apply(kept), fitted


def train_and_val(prepared: DataFrame) -> DataFrame:
    """Rows for a final fit without a held-out validation set."""
    return prepared.filter(F.col("split").isin("train", "val"))

