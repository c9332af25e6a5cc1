"""Categorical encoders: codes, one-hot, frequency, target means, shared dummies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.plans.materialize import materialize
from riskloom.plans.vocabulary import Vocabulary, first_seen_codes, fit_vocabulary, sorted_codes

# fixed values
MEAN_WEIGHT = 200
MIN_SAMPLES_LEAF = 200
SMOOTHING = 10
MIN_SUPPORT = 200


@dataclass
class CategoryCodes:
    """Integer codes. order="first" numbers values by first appearance, "sorted" by value.
    Fit on train alone (unknown test values get `unknown`) or on train and test."""

    cols: Sequence[str]
    order: str = "sorted"
    unknown: int = -1
    vocabulary: Vocabulary | None = None
    table: DataFrame | None = None

    def fit(self, train: DataFrame, test: DataFrame | None = None, id: str = "id") -> CategoryCodes:
        self.vocabulary = fit_vocabulary(train, test, self.cols, id=id)
        number = first_seen_codes if self.order == "first" else sorted_codes
        self.table = materialize(number(self.vocabulary.table), "codes")
        return self

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        for c in self.cols:
            outputs = {c + suffix: ("code", F.lit(self.unknown).cast("long"))}
            df = self.vocabulary.attach(df, self.table, c, outputs)
        return df


def unseen_values(vocabulary: Vocabulary) -> DataFrame:
    """Values that occur in test but not in train, with the number of test rows they cover."""
    return vocabulary.table.where("n_train = 0 AND n_test > 0").select("feature", "value", "n_test")


def shared_values(vocabulary: Vocabulary) -> DataFrame:
    """Values that occur in both tables."""
    return vocabulary.table.where("n_train > 0 AND n_test > 0").select("feature", "value", "n_train", "n_test")


def supported_values(table: DataFrame, min_train: int = 0, min_test: int = 0, shared: bool = False) -> DataFrame:
    """Vocabulary rows with enough support. Filtering here keeps rare values from ever becoming matrix columns."""
    least = 1 if shared else 0
    return table.where((F.col("n_train") >= max(min_train, least)) & (F.col("n_test") >= max(min_test, least)))


@dataclass
class OneHot:
    """One 0/1 column per known value, as one sparse vector per row; unknown and null values give zeros.

    `support` maps a column to (min_train, min_test); other columns use the defaults.
    """

    cols: Sequence[str]
    min_train: int = 1
    min_test: int = 0
    shared: bool = False
    support: dict[str, tuple[int, int]] = field(default_factory=dict)
    vocabulary: Vocabulary | None = None
    table: DataFrame | None = None
    width: dict[str, int] = field(default_factory=dict)

    def fit(self, train: DataFrame, test: DataFrame | None = None, id: str = "id") -> OneHot:
        self.vocabulary = fit_vocabulary(train, test, self.cols, id=id)
        table = self.vocabulary.table
        special = list(self.support)
        kept = supported_values(table.where(~F.col("feature").isin(special)), self.min_train, self.min_test, self.shared)
        for c, (a, b) in self.support.items():
            kept = kept.unionByName(supported_values(table.where(F.col("feature") == c), a, b, self.shared))
        self.table = materialize(sorted_codes(kept), "onehot")
        counts = self.table.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()
        found = {r["feature"]: r["n"] for r in counts}
        self.width = {c: found[c] for c in self.cols if found.get(c, 0) > 0}
        return self

    @property
    def size(self) -> int:
        return sum(self.width.values())

    def names(self) -> DataFrame:
        """(feature, value, n_train, n_test, position in the vector)."""
        start, offset = {}, 0
        for c, n in self.width.items():
            start[c], offset = offset, offset + n
        base = F.lit(0)
        for c, s in start.items():
            base = F.when(F.col("feature") == c, s).otherwise(base)
        return self.table.select("feature", "value", "n_train", "n_test", (base + F.col("code")).alias("position"))

    def empty_columns(self) -> DataFrame:
        """(n_columns, empty_in_train, empty_in_test): how many matrix columns have no row in either table."""
        return self.table.agg(
            F.count(F.lit(1)).alias("n_columns"), F.count_if(F.col("n_train") == 0).alias("empty_in_train"), F.count_if(F.col("n_test") == 0).alias("empty_in_test")
        )

    def spots(self, df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
        """One code column per encoded column; unknown values get the code one past the last."""
        spots = {c: f"_spot{i}" for i, c in enumerate(self.width)}
        for c, spot in spots.items():
            df = self.vocabulary.attach(df, self.table, c, {spot: ("code", F.lit(self.width[c]).cast("long"))})
        return df, spots

    def positions(self, df: DataFrame, output: str = "position", keep: Sequence[str] = ("id",)) -> DataFrame:
        """Long form: one row per 1 in the matrix (keep..., position)."""
        df, spots = self.spots(df.select(*keep, *[F.col(f"`{c}`") for c in self.width if c not in keep]))
        offset, cells = 0, []
        for c, spot in spots.items():
            cells.append(F.when(F.col(spot) < self.width[c], F.col(spot) + offset))
            offset += self.width[c]
        return df.select(*keep, F.explode(F.array_compact(F.array(*cells))).alias(output))

    def transform(self, df: DataFrame, output: str = "features", extra: Sequence[str] = ()) -> DataFrame:
        """Add the vector; `extra` numeric or vector columns are appended after the one-hot blocks."""
        return self.blocks(df, {output: self.cols}, extra)

    def blocks(self, df: DataFrame, groups: dict[str, Sequence[str]], extra: Sequence[str] = ()) -> DataFrame:
        """Add one vector per group of columns (name -> columns), all in one pass; `extra` is appended to each of them."""
        keep = [F.col(f"`{c}`") for c in df.columns]
        df, spots = self.spots(df)
        # nominal metadata tells the encoder its width (one more for unknown values, dropped), so it needs no pass
        sized = {
            spot: F.col(spot).cast("double").alias(spot, metadata={"ml_attr": {"type": "nominal", "num_vals": self.width[c] + 1}})
            for c, spot in spots.items()
        }
        df = df.select(*[sized.get(c, F.col(f"`{c}`")) for c in df.columns])
        if spots:
            encoder = OneHotEncoder(inputCols=list(spots.values()), outputCols=[f"{s}_v" for s in spots.values()], dropLast=True)
            df = encoder.fit(df).transform(df)
        for output, cols in groups.items():
            own = [f"{spots[c]}_v" for c in cols if c in spots]
            df = VectorAssembler(inputCols=[*own, *extra], outputCol=output).transform(df)
        return df.select(*keep, *groups)


@dataclass
class Frequency:
    """Share of train rows holding the value; unseen values get 0."""

    cols: Sequence[str]
    suffix: str = "_freq"
    vocabulary: Vocabulary | None = None

    def fit(self, train: DataFrame, id: str = "id", vocabulary: Vocabulary | None = None) -> Frequency:
        self.vocabulary = vocabulary or fit_vocabulary(train, None, self.cols, id=id)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        table = self.vocabulary.table.withColumn("share", F.col("n_train") / F.lit(float(self.vocabulary.n_train)))
        for c in self.cols:
            df = self.vocabulary.attach(df, table, c, {c + self.suffix: ("share", F.lit(0.0))})
        return df


def smoothed_mean(pos: str, n: str, prior: float, m: float | None = None) -> str:
    """SQL text of the mean target pulled towards the prior: weight m, or (m is None) a sigmoid in the number of rows.

    pos and n are SQL texts of double type. Text keeps the many expressions of a fit cheap to build.
    """
    mean, base = f"(({pos}) / ({n}))", f"{float(prior)!r}D"
    if m is not None:
        value = f"({mean} * ({n}) + {float(m)!r}D * {base}) / (({n}) + {float(m)!r}D)"
    else:
        s = f"(1D / (1D + exp(-(({n}) - {MIN_SAMPLES_LEAF}) / {float(SMOOTHING)!r}D)))"
        value = f"{base} * (1D - {s}) + {mean} * {s}"
    return f"CASE WHEN ({n}) > 0 THEN {value} ELSE {base} END"


@dataclass
class TargetMean:
    """Mean target per value. m=200 gives the weighted form, m=None the sigmoid form.

    With a fold column the fit also holds, for every fold j, the mean over the rows outside fold j. Used on the training
    rows of fold j's model that mean contains the row's own target; nested=True keeps it out by leaving out the row's
    own fold as well.
    """

    cols: Sequence[str]
    m: float | None = MEAN_WEIGHT
    suffix: str = "_avg"
    nested: bool = False
    vocabulary: Vocabulary | None = None
    table: DataFrame | None = None

    def fit(
        self,
        train: DataFrame,
        label: str = "target",
        fold: str | None = None,
        k: int = 5,
        id: str = "id",
        vocabulary: Vocabulary | None = None,
    ) -> TargetMean:
        v = vocabulary or fit_vocabulary(train, None, self.cols, label, fold, k, id)
        self.vocabulary = v
        encoded = [smoothed_mean("CAST(pos AS DOUBLE)", "CAST(n_train AS DOUBLE)", self.prior(), self.m) + " AS full"]
        k = len(v.fold_n)
        if k:
            encoded.append(f"array({', '.join(self._outside(j) for j in range(k))}) AS outside")
        if k and self.nested:
            inner = [f"array({', '.join(self._outside(i, j) for j in range(k))})" for i in range(k)]
            encoded.append(f"array({', '.join(inner)}) AS inner")
        self.table = v.table.selectExpr("feature", "num", "value", "n_train", "n_test", *encoded)
        return self

    def _outside(self, *folds: int) -> str:
        """Mean over the rows outside the given folds."""
        out = sorted(set(folds))
        pos = "pos" + "".join(f" - fold_pos[{j}]" for j in out)
        n = "n_train" + "".join(f" - fold_n[{j}]" for j in out)
        return smoothed_mean(f"CAST({pos} AS DOUBLE)", f"CAST({n} AS DOUBLE)", self.prior(*out), self.m)

    def prior(self, *folds: int) -> float:
        v = self.vocabulary
        pos, n = v.pos - sum(v.fold_pos[j] for j in folds), v.n_train - sum(v.fold_n[j] for j in folds)
        return pos / n if n else v.pos / max(v.n_train, 1)  # nothing is left if all rows lie in these folds

    def transform(self, df: DataFrame, at: str | int = "full", fold: str = "fold") -> DataFrame:
        """at="full": fitted on all train rows; "own": outside the row's own fold; j: outside fold j;
        "each": an array with the value outside every fold."""
        priors = F.lit([self.prior(j) for j in range(len(self.vocabulary.fold_n))])
        for c in self.cols:
            name = c + self.suffix
            if at == "full":
                df = self.vocabulary.attach(df, self.table, c, {name: ("full", F.lit(self.prior()))})
                continue
            if self.nested and fold in df.columns:
                df = self.vocabulary.attach(df, self.table, c, {name: ("inner", F.lit(None))})
                df = df.withColumn(name, F.coalesce(F.col(f"`{name}`")[F.col(fold)], priors))
            else:
                df = self.vocabulary.attach(df, self.table, c, {name: ("outside", priors)})
            if at == "own":
                df = df.withColumn(name, F.col(f"`{name}`")[F.col(fold)])
            elif at != "each":
                df = df.withColumn(name, F.col(f"`{name}`")[at])
        return df


def by_fold(df: DataFrame, names: Sequence[str], k: int) -> DataFrame:
    """A column `<name>_<j>` per fold in place of each array of `TargetMean.transform(df, "each")`: stored so, a fit reads only its own fold's values."""
    keep = [F.col(f"`{c}`") for c in df.columns if c not in set(names)]
    return df.select(*keep, *[F.col(f"`{n}`")[j].alias(f"{n}_{j}") for n in names for j in range(k)])


@dataclass
class Dummies:
    """0/1 columns `<c>_<value>` for the values train and test share, for columns with more than two train values.

    One column per value is what this form is; a table of thousands of values is better served by OneHot's sparse vector.
    """

    cols: Sequence[str]
    values: dict[str, list] = field(default_factory=dict)

    def fit(self, train: DataFrame, test: DataFrame, id: str = "id", vocabulary: Vocabulary | None = None) -> Dummies:
        v = vocabulary or fit_vocabulary(train, test, self.cols, id=id)
        counts = v.table.where("n_train > 0").groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()
        wide = [r["feature"] for r in counts if 2 < r["n"]]
        rows = shared_values(v).join(v.table.select("feature", "num", "real", "value"), ["feature", "value"])
        found = rows.where(F.col("feature").isin(wide)).orderBy("feature", "num", "real", "value").collect()
        self.values = {}
        for r in found:
            self.values.setdefault(r["feature"], []).append(r[v.kinds[r["feature"]]])
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {f"{c}_{x}": (F.col(f"`{c}`") == F.lit(x)).cast("int") for c in self.values for x in self.values[c]}
        )
