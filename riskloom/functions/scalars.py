"""Column expressions used by the feature steps. All of them are built-in Spark functions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values
MISSING = -1
HASH_DIM = 2**24
LOGLOSS_EPS = 10e-15
MARGIN_BOUND = 35.0


def _col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def is_sentinel(c: Column | str, sentinel: int = MISSING) -> Column:
    """Whether a number, or a text that reads as one, is the sentinel; other texts are not, null stays null."""
    found = _col(c).try_cast("double") == float(sentinel)
    return F.when(_col(c).isNotNull(), F.coalesce(found, F.lit(False)))


def missing_flag(c: Column | str, sentinel: int = MISSING) -> Column:
    return is_sentinel(c, sentinel).cast("int")


def signed_flag(c: Column | str, sentinel: int = MISSING) -> Column:
    """+1 where the value is missing, -1 elsewhere."""
    return F.when(is_sentinel(c, sentinel), 1).otherwise(-1)


def combine_key(a: Column | str, b: Column | str, sep: str = "_") -> Column:
    """Text key of a value pair. Feed it ints or strings: doubles print differently in other engines."""
    return F.concat_ws(sep, _col(a).cast("string"), _col(b).cast("string"))


def combine(df: DataFrame, pairs: Sequence[tuple[str, str]], sep: str = "_", name: str = "{a}_plus_{b}") -> DataFrame:
    """Add one combination column per pair."""
    return df.withColumns({name.format(a=a, b=b): combine_key(a, b, sep) for a, b in pairs})


def product(terms: Sequence[Column | str]) -> Column:
    out = _col(terms[0])
    for t in terms[1:]:
        out = out * _col(t)
    return out


def region_code(reg: Column | str) -> Column:
    """The integer k behind reg = sqrt(k) / 40, rounded half to even."""
    scaled = _col(reg) * 40
    return F.rint(scaled * scaled).cast("long")


def region_decode(reg: Column | str) -> Column:
    """struct(federal, municipality): k written as 27 * municipality + federal with federal in 1..27."""
    k = region_code(reg) - 1
    return F.struct(
        (F.pmod(k, F.lit(27)) + 1).cast("int").alias("federal"),
        F.floor(k / 27).cast("int").alias("municipality"),
    )


def square_trunc(c: Column | str) -> Column:
    """Square, then cut the fraction off (so sqrt(3) gives 2, not 3)."""
    return (_col(c) * _col(c)).cast("int")


def sigmoid(c: Column | str) -> Column:
    return 1.0 / (1.0 + F.exp(-_col(c)))


def sigmoid_clip(c: Column | str, bound: float = MARGIN_BOUND) -> Column:
    return sigmoid(F.least(F.greatest(_col(c), F.lit(-bound)), F.lit(bound)))


def logloss(p: Column | str, y: Column | str, eps: float = LOGLOSS_EPS) -> Column:
    bounded = F.greatest(F.least(_col(p), F.lit(1.0 - eps)), F.lit(eps))
    return F.when(_col(y) == 1, -F.log(bounded)).otherwise(-F.log(1.0 - bounded))


def hash_bucket(name: str, c: Column | str, dim: int = HASH_DIM, fast: bool = False) -> Column:
    """Bucket of a (column name, value) cell. md5 gives the same bucket in every engine, `fast` uses xxhash64."""
    key = F.concat(F.lit(f"{name}_"), _col(c).cast("string"))
    return _bucket(key, dim, fast)


def _bucket(key: Column, dim: int, fast: bool) -> Column:
    if fast:
        return F.pmod(F.xxhash64(key), F.lit(dim)).cast("int")
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(dim)).cast("int")


def hash_interactions(buckets: Column, dim: int = HASH_DIM, fast: bool = False) -> Column:
    """Buckets of all pairs i < j of the sorted bucket array."""
    x = F.sort_array(buckets)
    text = lambda v: v.cast("string")
    pairs = F.transform(
        x,
        lambda a, i: F.transform(
            F.slice(x, i + 2, F.size(x)), lambda b: _bucket(F.concat_ws("_", text(a), text(b)), dim, fast)
        ),
    )
    return F.flatten(pairs)


def hash_row(cols: Sequence[str], dim: int = HASH_DIM, interactions: bool = False, fast: bool = False) -> Column:
    """array<int> of the row's buckets: bias bucket 0, one per column, then (optionally) one per pair of columns."""
    cells = F.array(*[hash_bucket(c, c, dim, fast) for c in cols])
    parts = [F.array(F.lit(0)), cells]
    if interactions:
        parts.append(hash_interactions(cells, dim, fast))
    return F.concat(*parts)


def class_weight(label: Column | str, positive_rate: float) -> Column:
    """1 / (2 * share of the row's class)."""
    return F.when(_col(label) == 1, 1.0 / (2.0 * positive_rate)).otherwise(1.0 / (2.0 * (1.0 - positive_rate)))


def dual_target(label: Column | str) -> list[Column]:
    return [(1 - _col(label)).alias("target_0"), _col(label).alias("target_1")]


def linear_blend(weights: dict[str, float]) -> Column:
    """Weighted sum of prediction columns, added up in the order given."""
    out = F.lit(0.0)
    for name, w in weights.items():
        out = out + F.lit(float(w)) * _col(name)
    return out


def fixed_text(c: Column | str, digits: int = 9) -> Column:
    return F.format_string(f"%.{digits}f", _col(c))
