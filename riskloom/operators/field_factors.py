"""Field-aware factorization machine: every value has one vector for each other field, pairs of a row's values score by their products.

A fit takes `epochs` synchronous steps over all rows. In a step the vectors are looked up for the distinct pairs of values, the products
of the pairs for the rows; the rows' errors are summed per pair before they meet vectors again, so vectors travel with distinct pairs and
never with rows. Each weight takes one AdaGrad step with its summed gradient. The state is a table (slot, v, h), a slot being a value and
another field; several fits (one per held-out fold) share all passes. Up to `most_pairs` distinct pairs the tasks get all products and return the
errors summed per pair, so a step neither unfolds nor shuffles the rows. Beyond that the rows are unfolded to their pairs and looked up by lookup_join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.scalars import MARGIN_BOUND, sigmoid_clip
from riskloom.operators.lookup import MAX_BROADCAST_ROWS, lookup_join
from riskloom.plans.materialize import discard, materialize
from riskloom.sources.ffm_text import FieldCodes, fit_field_codes


def _pair_numbers(batches: Iterator[pa.RecordBatch], base: int, columns: int, step: int = 1 << 13) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches and the numbers of their rows' pairs, -1 where a value is missing."""
    left, right = np.array(list(combinations(range(columns), 2)), np.int64).reshape(-1, 2).T
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            x = pc.fill_null(part.column("x").flatten(), -1).to_numpy(zero_copy_only=False).reshape(part.num_rows, columns)
            a, b = x[:, left], x[:, right]
            yield part, np.where((a >= 0) & (b >= 0), a * base + b, -1)


def _pair_sums(batches: Iterator[pa.RecordBatch], sent: Broadcast, base: int, columns: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches, the places of their rows' pairs among the sent ones (one past the last: none), and the rows' summed products in each fit."""
    numbers, products = sent.value
    for part, pair in _pair_numbers(batches, base, columns):
        at = np.searchsorted(numbers, pair)
        at[np.append(numbers, -2)[at] != pair] = len(numbers)
        yield part, at, np.stack([np.take(p, at).sum(axis=1) for p in products], axis=1)


@dataclass
class FieldFactors:
    """Settings and, after `fit`, codes and state. fits: the folds left out, one fit each; None is a fit on all rows.

    Null values take part in no pair. A value without a row outside the held-out fold, or met in prediction alone, has zero vectors.
    """

    cols: Sequence[str]
    factors: int = 4
    rate: float = 0.5  # one step stands for a pass of single-row steps, so it is larger than theirs
    penalty: float = 2e-6
    epochs: int = 11
    seed: int = 15
    fits: Sequence[int | None] = (None,)
    most_pairs: int = MAX_BROADCAST_ROWS
    codes: FieldCodes | None = None
    state: DataFrame | None = None
    slots: int = 0
    pairs: int = 0

    def _places(self) -> list[tuple[int, int, int]]:
        """(fit, factor, place in a vector)."""
        return [(k, t, k * self.factors + t) for k in range(len(self.fits)) for t in range(self.factors)]

    def _coded(self, df: DataFrame, id: str, *keep: Column) -> DataFrame:
        """`keep` and x, the codes of the row's values (null: none)."""
        spots = {c: f"_code{i}" for i, c in enumerate(self.cols)}
        for c, spot in spots.items():
            df = self.codes.vocabulary.attach(df, self.codes.table, c, {spot: ("code", F.lit(None).cast("long"))}, spread=id)
        return df.select(*keep, F.array(*spots.values()).alias("x"))

    def _base(self) -> int:
        base = sum(self.codes.vocabulary.rows.values()) + 1
        if base * max(base, len(self.cols)) >= 1 << 63:
            raise ValueError(f"{base} values are too many to number their pairs")
        return base

    def _row_pairs(self) -> Column:
        """The pairs of a row: pair is its number, slot_a and slot_b are each value with the other's field."""
        base, m = self._base(), len(self.cols)
        x = F.col("x")
        cells = [
            F.struct((x[i] * base + x[j]).alias("pair"), (x[i] * m + j).alias("slot_a"), (x[j] * m + i).alias("slot_b"))
            for i, j in combinations(range(m), 2)
        ]
        return F.filter(F.array(*cells), lambda c: c["pair"].isNotNull())

    def _met(self, rows: DataFrame, fits: Sequence[int | None]) -> DataFrame:
        """(pair, slot_a, slot_b, n, out0, out1, ...): rows of every pair and those outside each fit's fold; a task counts a part of its rows before it hands on pairs."""
        base, m, fits = self._base(), len(self.cols), list(fits)
        names = ["pair", "slot_a", "slot_b", "n", *[f"out{k}" for k in range(len(fits))]]
        sides = np.array(list(combinations(range(m), 2)), np.int64).reshape(-1, 2)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, pair in _pair_numbers(batches, base, m):
                number, first, place = np.unique(pair, return_index=True, return_inverse=True)
                fold, copies = (part.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "copies"))
                weights = [copies, *[copies if j is None else np.where(fold == j, 0, copies) for j in fits]]
                counts = [np.bincount(place.ravel(), np.repeat(w, pair.shape[1]), len(number)).astype(np.int64) for w in weights]
                keep = number >= 0
                i, j = sides[first[keep] % max(1, len(sides))].T
                slots = [number[keep] // base * m + j, number[keep] % base * m + i]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in (number[keep], *slots, *[c[keep] for c in counts])], names=names)

        parts = rows.select("fold", "copies", "x").mapInArrow(run, ", ".join(f"{c} long" for c in names))
        return parts.groupBy("pair", "slot_a", "slot_b").agg(*[F.sum(c).alias(c) for c in names[3:]])

    def _start(self, t: int) -> Column:
        """First value of factor t of a slot: uniform below 1 / root of `factors`, a function of slot, factor and seed."""
        even = F.pmod(F.xxhash64(F.col("slot"), F.lit(t), F.lit(self.seed)), F.lit(1 << 20)) / float(1 << 20)
        return even / self.factors**0.5

    def fit(self, df: DataFrame, label: str = "target", id: str = "id", fold: str | None = None) -> FieldFactors:
        self.codes = fit_field_codes(df, None, self.cols, id)
        held = F.col(fold).cast("int") if fold else F.lit(None).cast("int")
        each = self._coded(df, id, F.col(id).alias("id"), F.col(label).cast("double").alias("y"), held.alias("fold"))
        rows = materialize(each.groupBy("id", "y", "fold", "x").agg(F.count(F.lit(1)).alias("copies")), "coded")
        pairs = materialize(self._met(rows, self.fits), "pairs")
        self.pairs = pairs.count()
        outs = [f"out{k}" for k in range(len(self.fits))]
        sides = [F.struct(F.col(s).alias("slot"), *outs) for s in ("slot_a", "slot_b")]
        seen = pairs.select(F.inline(F.array(*sides))).groupBy("slot").agg(F.count(F.lit(1)).alias("weight_"), *[F.sum(c).alias(c) for c in outs])
        first = [F.when(F.col(f"out{k}") > 0, self._start(t)).otherwise(0.0) for k, t, _ in self._places()]
        self.state = materialize(seen.select("slot", "weight_", F.array(*first).alias("v"), F.array(*[F.lit(1.0)] * len(first)).alias("h")), "state")
        self.slots = self.state.count()
        for _ in range(self.epochs):
            self._step(rows, pairs)
        return self

    def _products(self, pairs: DataFrame, count: int) -> DataFrame:
        """`pairs` with va and vb, the vectors of both sides, and d0, d1, ..., their product in each fit."""
        side = self.state.select(F.col("slot").alias("key_"), "weight_", "v")
        for slot, v in (("slot_a", "va"), ("slot_b", "vb")):
            pairs = lookup_join(pairs, side, slot, {v: ("v", F.lit(None))}, self.slots, count, "pair")
        product = [sum(F.col("va")[at] * F.col("vb")[at] for k, _, at in self._places() if k == fit) for fit in range(len(self.fits))]
        return pairs.select("*", *[F.coalesce(p / len(self.cols), F.lit(0.0)).alias(f"d{k}") for k, p in enumerate(product)])

    def _margins(self, rows: DataFrame, products: DataFrame, keys: Sequence[str], count: int, cells: int) -> DataFrame:
        """`keys` and m0, m1, ...: sums over the row's pairs. They all start in the row's task, so the sums are complete before the shuffle."""
        ks = range(len(self.fits))
        side = products.select(F.col("pair").alias("key_"), F.col("n").alias("weight_"), *[f"d{k}" for k in ks])
        each = rows.select(*keys, F.explode_outer(self._row_pairs()["pair"]).alias("pair"))
        found = lookup_join(each, side, "pair", {f"d{k}": (f"d{k}", F.lit(0.0)) for k in ks}, count, cells)
        return found.groupBy(*keys).agg(*[F.sum(f"d{k}").alias(f"m{k}") for k in ks])

    def _sent(self, products: DataFrame) -> Broadcast:
        """The numbers of at most `most_pairs` pairs in order, and an array of their products per fit with a zero at its end."""
        found = products.select("pair", *[f"d{k}" for k in range(len(self.fits))]).orderBy("pair").toArrow()
        numbers = found.column("pair").to_numpy()
        return products.sparkSession.sparkContext.broadcast((numbers, [np.append(found.column(f"d{k}").to_numpy(), 0.0) for k in range(len(self.fits))]))

    def _margins_in_tasks(self, rows: DataFrame, products: DataFrame) -> DataFrame:
        """(id, m0, m1, ...) as `_margins` has them, without unfolding the rows."""
        sent, base, columns = self._sent(products), self._base(), len(self.cols)
        names = [f"m{k}" for k in range(len(self.fits))]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, _, margins in _pair_sums(batches, sent, base, columns):
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(m) for m in margins.T]], names=["id", *names])

        schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *[T.StructField(m, T.DoubleType()) for m in names]])
        return rows.select("id", "x").mapInArrow(run, schema).groupBy("id").agg(*[F.sum(m).alias(m) for m in names])

    def _errors_in_tasks(self, rows: DataFrame, products: DataFrame) -> DataFrame:
        """(pair, e0, e1, ...): the errors of the rows outside each fit's fold, summed per pair in the task that reads the rows."""
        sent, base, columns, fits = self._sent(products), self._base(), len(self.cols), list(self.fits)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            numbers = sent.value[0]
            total, met = np.zeros((len(fits), len(numbers) + 1)), np.zeros(len(numbers) + 1, bool)
            for part, at, margins in _pair_sums(batches, sent, base, columns):
                y, fold, copies = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "copies"))
                bounded = np.clip(margins * copies[:, None], -MARGIN_BOUND, MARGIN_BOUND)
                errors = np.nan_to_num(1.0 / (1.0 + np.exp(-bounded)) - y[:, None])  # a row without a label pulls nothing
                met[at] = True
                for k, j in enumerate(fits):
                    error = errors[:, k] if j is None else np.where(fold == j, 0.0, errors[:, k])
                    total[k] += np.bincount(at.ravel(), np.repeat(error, at.shape[1]), len(numbers) + 1)
            filled = np.flatnonzero(met[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(numbers[filled]), *[pa.array(t[filled]) for t in total]], names=["pair", *[f"e{k}" for k in range(len(fits))]])

        names = [f"e{k}" for k in range(len(fits))]
        parts = rows.select("y", "fold", "copies", "x").mapInArrow(run, ", ".join(["pair long", *[f"{e} double" for e in names]]))
        return parts.groupBy("pair").agg(*[F.sum(e).alias(e) for e in names])

    def _errors_by_shuffle(self, rows: DataFrame, products: DataFrame) -> DataFrame:
        """The same for any number of pairs."""
        ks = range(len(self.fits))
        cells = products.agg(F.sum("n")).first()[0] or 0
        margins = self._margins(rows, products, ["id", "y", "fold", "x", "copies"], self.pairs, cells)
        errors = []
        for k, j in zip(ks, self.fits):
            error = sigmoid_clip(F.col(f"m{k}") * F.col("copies")) - F.col("y")
            errors.append((error if j is None else F.when(F.col("fold") == j, 0.0).otherwise(error)).alias(f"e{k}"))
        each = margins.select("x", *errors).select(F.explode(self._row_pairs()["pair"]).alias("pair"), *[f"e{k}" for k in ks])
        return each.groupBy("pair").agg(*[F.sum(f"e{k}").alias(f"e{k}") for k in ks])

    def _step(self, rows: DataFrame, pairs: DataFrame) -> None:
        m = len(self.cols)
        products = materialize(self._products(pairs, 2 * self.pairs), "products")
        sums = (self._errors_in_tasks if self.pairs <= self.most_pairs else self._errors_by_shuffle)(rows, products)

        def pull(own: str, other: str) -> Column:
            return F.array(*[
                F.col(f"e{k}") * F.col(other)[at] / m + self.penalty * F.col(f"out{k}") * F.col(own)[at] for k, _, at in self._places()
            ])

        sides = [F.struct(F.col("slot_a").alias("slot"), pull("va", "vb").alias("g")), F.struct(F.col("slot_b").alias("slot"), pull("vb", "va").alias("g"))]
        pulled = products.join(sums, "pair").select(F.inline(F.array(*sides)))
        wide = pulled.groupBy("slot").agg(*[F.sum(F.col("g")[at]).alias(f"g{at}") for _, _, at in self._places()])
        h = [F.col("h")[at] + F.col(f"g{at}") * F.col(f"g{at}") for _, _, at in self._places()]
        v = [F.col("v")[at] - self.rate * F.col(f"g{at}") / F.sqrt(h[at]) for _, _, at in self._places()]
        before = self.state  # every slot is in a pair, so none is lost in the join
        self.state = materialize(before.join(wide, "slot").select("slot", "weight_", F.array(*v).alias("v"), F.array(*h).alias("h")), "state")
        discard(products)
        discard(before)

    def predictions(self, df: DataFrame, id: str = "id") -> DataFrame:
        """(id, p0, p1, ...): one prediction per fit. Pairs that no training row has are scored by their vectors as well; ids are unique."""
        rows = materialize(self._coded(df, id, F.col(id).alias("id")), "coded")
        met = materialize(self._met(rows.withColumns({"fold": F.lit(None).cast("int"), "copies": F.lit(1).cast("long")}), ()), "met")
        size = met.agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("cells")).first()
        products = materialize(self._products(met, 2 * size["pairs"]), "products")
        if size["pairs"] <= self.most_pairs:
            found = self._margins_in_tasks(rows, products)
        else:
            found = self._margins(rows, products, ["id"], size["pairs"], size["cells"] or 0)
        return found.select(F.col("id").alias(id), *[sigmoid_clip(f"m{k}").alias(f"p{k}") for k in range(len(self.fits))])


def field_factors_oof(train: DataFrame, settings: FieldFactors, label: str = "target", fold: str = "fold", id: str = "id") -> DataFrame:
    """Out-of-fold predictions (id, fold, target, prediction): all folds are fitted in the same passes."""
    rows = materialize(train.select(id, label, fold, *settings.cols), "factors")
    settings.fits = sorted(r[0] for r in rows.select(fold).distinct().collect())
    scores = settings.fit(rows, label, id, fold).predictions(rows, id)
    own = F.coalesce(*[F.when(F.col(fold) == j, F.col(f"p{k}")) for k, j in enumerate(settings.fits)])
    return rows.join(scores, id).select(id, fold, F.col(label).alias("target"), own.alias("prediction"))
