"""Assembly of a whole feature set for one model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import combine
from riskloom.operators.columns import align_columns, column_roles, require_columns
from riskloom.operators.encoders import Dummies, TargetMean
from riskloom.operators.scaling import EqualWidthBinner
from riskloom.plans.vocabulary import fit_vocabulary


@dataclass(frozen=True)
class Recipe:
    """What to build: input features, columns to bin, pairs to combine, bins per column."""

    features: Sequence[str]
    binned: Sequence[str]
    pairs: Sequence[tuple[str, str]]
    bins: int = 50


def full_features(train: DataFrame, test: DataFrame, recipe: Recipe, label: str = "target", id: str = "id") -> tuple[DataFrame, DataFrame, list[str]]:
    """Categories, binaries and numbers (binned on both tables), frequencies, shared dummies, target means of
    categories, binaries and combinations (`_cmb`), the combination itself replaced by its frequency.

    All encoders share one vocabulary, so train is read once for the bins and train and test once for the encoders.
    """
    require_columns(train, id, label, *recipe.features)
    require_columns(test, id, *recipe.features)
    extra = [c for c in ("fold",) if c in train.columns]
    train = train.select(id, label, *extra, *recipe.features)
    test = test.select(id, *recipe.features)
    roles = column_roles(recipe.features)
    binner = EqualWidthBinner(list(recipe.binned), recipe.bins).fit(train, test)
    train, test = (combine(binner.transform(t), recipe.pairs, "|", "{a}_{b}_cmb") for t in (train, test))
    combos = [f"{a}_{b}_cmb" for a, b in recipe.pairs]
    coded = [*roles.categorical, *roles.binary]
    words = fit_vocabulary(train, test, [*coded, *combos], label, id=id)
    means = TargetMean([*coded, *combos], None).fit(train, label, vocabulary=words)
    dummies = Dummies(coded).fit(train, test, vocabulary=words.only(coded))
    # target mean and frequency come from the same row of the vocabulary: one lookup per column
    table = means.table.withColumn("share", F.col("n_train") / F.lit(float(words.n_train)))
    fallback = F.lit(means.prior())

    def encode(df: DataFrame) -> DataFrame:
        df = dummies.transform(df)
        for c in [*coded, *combos]:
            freq = c if c in combos else f"{c}_freq"
            df = words.attach(df, table, c, {f"{c}_avg": ("full", fallback), freq: ("share", F.lit(0.0))})
        return df

    train, test = encode(train), encode(test)
    align_columns(train, test, label)
    return train, test, [c for c in test.columns if c != id]
