"""Whole first-level models: from the two wide tables to out-of-fold and test predictions.

Each function is one family of recipes; the arguments say what differs between its members.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalars import combine, region_decode
from riskloom.operators.columns import add_missing_flags, cardinalities, column_roles, noise_columns, replace_sentinel, route
from riskloom.operators.encoders import CategoryCodes, OneHot, TargetMean, by_fold
from riskloom.operators.folds import assign_folds
from riskloom.operators.learners import Learner
from riskloom.operators.oof import OofResult, oof_predict
from riskloom.operators.scaling import EqualWidthBinner, MinMax
from riskloom.plans.materialize import materialize

KEYS = ("id", "target", "fold")
PAIR = "{a}_plus_{b}"


def _features(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEYS]


def add_region(df: DataFrame, reg: str, name: str) -> DataFrame:
    """`<name>_M`: the municipality read off a region code. Decode before the code is binned."""
    return df.withColumn(f"{name}_M", region_decode(reg)["municipality"])


def _both(train: DataFrame, test: DataFrame | None, step: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """The same step on the train table and, if there is one, on the test table."""
    return step(train), step(test) if test is not None else None


def mean_encoded_model(
    train: DataFrame, test: DataFrame | None, learner: Learner, features: Sequence[str], pairs: Sequence[tuple[str, str]] = (),
    region: tuple[str, str] | None = None, binned: Sequence[str] = (), bins: int = 50, m: float | None = None,
    in_place: bool = False, between: tuple[int, int] | None = None, mode: str = "refit",
) -> OofResult:
    """Tree models on raw columns, decoded regions, coded combinations and target means fitted outside every fold.

    Means are added as `<c>_avg`, or replace the column (in_place). They cover the categorical columns and the
    combinations, or (between) the categorical columns with a number of values strictly between the two limits. The means of all
    folds are looked up once per column and stored with the rows; each fold's model then picks its own.
    """
    noise = noise_columns(train.columns, features, KEYS)  # before columns are derived, so derived ones survive
    if region:
        train, test = _both(train, test, lambda df: add_region(df, *region))
    if binned:
        train, test = _both(train, test, EqualWidthBinner(list(binned), bins).fit(train, test).transform)
    train, test = _both(train, test, lambda df: combine(df, pairs, name=PAIR))
    combos = [PAIR.format(a=a, b=b) for a, b in pairs]
    if combos:
        train, test = _both(train, test, CategoryCodes(combos, "first").fit(train, id="id").transform)
    train, test = _both(train, test, lambda df: df.drop(*noise))
    train = materialize(train if "fold" in train.columns else assign_folds(train), "level1", ["fold"])
    cats = column_roles(_features(train)).categorical
    if between:
        counts = cardinalities(train, cats)
        cats = [c for c in cats if between[0] < counts[c] < between[1]]
    suffix = "_mean" if in_place else "_avg"
    inputs = [c for c in _features(train) if not (in_place and c in cats)] + [c + suffix for c in cats]
    means = TargetMean(cats, m, suffix=suffix).fit(train, fold="fold") if cats else None
    names = [c + suffix for c in cats]

    def each(df: DataFrame) -> DataFrame:
        """With the means outside every fold, one column per mean and fold."""
        found = means.transform(df, "each").withColumnsRenamed({c: f"{c}_each" for c in names})
        return by_fold(found, [f"{c}_each" for c in names], len(means.vocabulary.fold_n))

    if means is not None:
        train = materialize(each(train), "means", ["fold"])
        if test is not None and mode == "mean":
            test = materialize(each(test), "means")

    def prepare(df: DataFrame, j: int | None) -> DataFrame:
        if means is not None and j is None:
            df = means.transform(df, "full")
        elif means is not None:
            df = df.withColumns({c: F.col(f"`{c}_each_{j}`") for c in names})
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(df)

    return oof_predict(train, learner, test, mode, prepare, store=False)


def one_hot_model(
    train: DataFrame, test: DataFrame | None, learner: Callable[[int], Learner], features: Sequence[str] | None = None,
    without: str | None = "_calc", binned: Sequence[str] = (), bins: int = 20, sentinel_to: int = 99999,
    flags: Sequence[str] = (), scaled: Sequence[str] = (), pairs: Sequence[tuple[str, str]] = (), skip_binned_pairs: bool = False,
    routed: bool = False, min_train: int = 1, pair_min_test: int = 0, shared: bool = False, mode: str = "refit",
) -> OofResult:
    """Linear models, nets and factorization machines on one-hot columns.

    flags: columns that get a missing flag; scaled: columns scaled to [0, 1] on both tables instead of being binned
    (kept as numbers); routed: few-valued columns pass through, very wide ones are dropped; min_train, pair_min_test,
    shared: support a value needs. The learner is made for the width of the matrix. Without a test table there are only
    out-of-fold predictions, and supports in it are not asked for.
    """
    kept = list(features) if features is not None else [c for c in _features(train) if not (without and without in c)]
    train = train.select(*[c for c in KEYS if c in train.columns], *kept)
    test = test.select("id", *kept) if test is not None else None
    if flags:
        train, *others = add_missing_flags(train, *([] if test is None else [test]), cols=list(flags))
        test = others[0] if others else None
    if binned:
        train, test = _both(train, test, EqualWidthBinner(list(binned), bins).fit(train, test).transform)
    if scaled:
        train, test = _both(train, test, MinMax(list(scaled)).fit(train, test).transform)
    coded = [c for c in _features(train) if c not in set(scaled)]
    train, test = _both(train, test, lambda df: replace_sentinel(df, sentinel_to, coded))
    if skip_binned_pairs:
        pairs = [p for p in pairs if not set(p) & set(binned)]
    train, test = _both(train, test, lambda df: combine(df, pairs, name=PAIR))
    combos = [PAIR.format(a=a, b=b) for a, b in pairs]
    plain: list[str] = []
    if routed:
        where = {c: route(n) for c, n in cardinalities(train, coded).items()}
        plain = [c for c in coded if where[c] == "passthrough"]
        coded = [c for c in coded if where[c] == "onehot"]
    train = materialize(train if "fold" in train.columns else assign_folds(train), "level1")
    support = {c: (min_train, pair_min_test) for c in combos} if pair_min_test and test is not None else {}
    hot = OneHot([*coded, *combos], min_train=min_train, shared=shared and test is not None, support=support).fit(train, test)
    extra = [*plain, *scaled]
    rows = hot.transform(train, extra=extra).select(*KEYS, "features")
    others = hot.transform(test, extra=extra).select("id", "features") if test is not None else None
    return oof_predict(rows, learner(hot.size + len(extra)), others, mode)


def scaled_model(
    train: DataFrame, test: DataFrame | None, learner: Learner, products: dict[str, Column] | None = None,
    region: tuple[str, str] | None = None, binned: Sequence[str] = (), bins: int = 50, mode: str = "refit",
) -> OofResult:
    """Linear models on missing flags, decoded regions, products and binned columns, all scaled to [0, 1] on train."""
    train, *others = add_missing_flags(train, *([] if test is None else [test]), cols=_features(train))
    test = others[0] if others else None
    if region:
        train, test = _both(train, test, lambda df: add_region(df, *region))
    if products:
        train, test = _both(train, test, lambda df: df.withColumns(products))
    if binned:
        train, test = _both(train, test, EqualWidthBinner(list(binned), bins).fit(train, test).transform)
    train = materialize(train if "fold" in train.columns else assign_folds(train), "level1")
    names = _features(train)
    scaler = MinMax(names).fit(train)
    vector = VectorAssembler(inputCols=names, outputCol="features")
    rows, others = _both(train, test, lambda df: vector.transform(scaler.transform(df)))
    return oof_predict(rows.select(*KEYS, "features"), learner, others.select("id", "features") if others is not None else None, mode)
