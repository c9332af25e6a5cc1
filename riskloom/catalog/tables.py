"""Scans, projections, set operations, folds and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.base import folded, long_sql, over_folds, over_fx, query, train_test, wide, wide_stored
from riskloom.functions.scalars import dual_target
from riskloom.operators import columns, folds, profile, sketches
from riskloom.plans.materialize import materialize, new_path
from riskloom.plans.matrix_store import StaleMatrix, fingerprint, load_matrix, matrix, matrix_path
from riskloom.sources.order_risk import BINARY, CATEGORICAL, split_origin
from riskloom.sources.predictions import read_table

FEATURES = ["prio_cat", "nation_cat", "ret_bin", "n_lines", "price_13"]
CODED = [*CATEGORICAL, *BINARY, "n_lines"]


@query(over_fx("SELECT * FROM fx"))
def scan_fx(spark, sf_dir):
    return wide(spark, sf_dir)


@query(over_fx("SELECT * FROM fx"))
def scan_csv(spark, sf_dir):
    """Through CSV with header, read back with a stated schema."""
    path = new_path(spark, "table") + ".csv"
    df = wide(spark, sf_dir)
    df.write.csv(path, header=True)
    return read_table(spark, path, df.schema)


@query(over_fx("SELECT * EXCLUDE (calc_disc) FROM fx"))
def drop_group(spark, sf_dir):
    return columns.drop_group(wide(spark, sf_dir), "calc_", prefix=True)


@query(over_fx("SELECT id, target, prio_cat, nation_cat, ret_bin, n_lines, price_13 FROM fx"))
def select_features(spark, sf_dir):
    return columns.select_features(wide(spark, sf_dir), FEATURES)


@query(
    over_fx(
        """
SELECT feature, role, n_missing FROM (
  SELECT 'prio_cat' AS feature, 'categorical' AS role, COUNT(*) FILTER (prio_cat = -1) AS n_missing FROM fx
  UNION ALL SELECT 'status_cat', 'categorical', COUNT(*) FILTER (status_cat = -1) FROM fx
  UNION ALL SELECT 'seg_cat', 'categorical', COUNT(*) FILTER (seg_cat = -1) FROM fx
  UNION ALL SELECT 'nation_cat', 'categorical', COUNT(*) FILTER (nation_cat = -1) FROM fx
  UNION ALL SELECT 'cust_cat', 'categorical', COUNT(*) FILTER (cust_cat = -1) FROM fx
  UNION ALL SELECT 'ret_bin', 'binary', COUNT(*) FILTER (ret_bin = -1) FROM fx
  UNION ALL SELECT 'fstat_bin', 'binary', COUNT(*) FILTER (fstat_bin = -1) FROM fx
  UNION ALL SELECT 'n_lines', 'numeric', COUNT(*) FILTER (n_lines = -1) FROM fx
  UNION ALL SELECT 'reg_03', 'numeric', COUNT(*) FILTER (reg_03 = -1) FROM fx
  UNION ALL SELECT 'qty_12', 'numeric', COUNT(*) FILTER (qty_12 = -1) FROM fx
  UNION ALL SELECT 'price_13', 'numeric', COUNT(*) FILTER (price_13 = -1) FROM fx
  UNION ALL SELECT 'bal_14', 'numeric', COUNT(*) FILTER (bal_14 = -1) FROM fx
  UNION ALL SELECT 'root_15', 'numeric', COUNT(*) FILTER (root_15 = -1) FROM fx
  UNION ALL SELECT 'calc_disc', 'numeric', COUNT(*) FILTER (calc_disc = -1) FROM fx)"""
    )
)
def column_roles(spark, sf_dir):
    df = wide(spark, sf_dir)
    roles = dict(columns.column_roles(df.columns).as_rows())
    profiled = profile.missing_profile(df, list(roles))
    role = F.lit(None).cast("string")
    for name in set(roles.values()):
        role = F.when(F.col("feature").isin([c for c, r in roles.items() if r == name]), name).otherwise(role)
    return profiled.select("feature", role.alias("role"), "n_missing")


@query(
    over_fx(
        """
SELECT feature, n_values, CASE WHEN n_values <= 2 THEN 'passthrough' WHEN n_values < 110 THEN 'onehot' ELSE 'drop' END
       AS route
FROM (SELECT feature, COUNT(DISTINCT value) AS n_values FROM long GROUP BY feature)""",
        "long AS (" + long_sql(CODED, "fx", "id") + ")",
    )
)
def card_route(spark, sf_dir):
    train, test = split_origin(wide(spark, sf_dir))
    found = profile.cardinality_profile(train, test, CODED)
    low, high = columns.LOW_CARDINALITY, columns.HIGH_CARDINALITY
    n = F.col("n_values")
    route = F.when(n <= low, "passthrough").when(n < high, "onehot").otherwise("drop")
    return found.select("feature", "n_values", route.alias("route"))


@query(
    over_fx(
        """
SELECT id, CASE WHEN ret_bin = -1 THEN 999 ELSE ret_bin END AS ret_bin,
       CASE WHEN n_lines = -1 THEN 999 ELSE n_lines END AS n_lines,
       CASE WHEN qty_12 = -1 THEN 999 ELSE qty_12 END AS qty_12 FROM fx"""
    )
)
def sentinel_replace(spark, sf_dir):
    cols = ["ret_bin", "n_lines", "qty_12"]
    return columns.replace_sentinel(wide(spark, sf_dir).select("id", *cols), 999, cols)


@query(over_folds("SELECT id, target, fold, 'validation' AS part FROM tr WHERE fold = 2 UNION ALL "
                  "SELECT id, target, fold, 'train' AS part FROM tr WHERE fold <> 2"))
def fold_slice(spark, sf_dir):
    df = folded(spark, sf_dir).select("id", "target", "fold")
    held = folds.validation_part(df, 2).withColumn("part", F.lit("validation"))
    return held.unionByName(folds.training_part(df, 2).withColumn("part", F.lit("train")))


@query(over_fx("SELECT id, is_test, CASE WHEN is_test = 1 THEN 0 ELSE target END AS target, prio_cat, qty_12 FROM fx"))
def union_origin(spark, sf_dir):
    train, test = split_origin(wide(spark, sf_dir))
    both = columns.union_origin(train, test, fill=0)
    return both.select("id", "is_test", "target", "prio_cat", "qty_12")


@query(over_fx("SELECT id, 1 - target AS target_0, target AS target_1 FROM fx WHERE is_test = 0"))
def dual_target_columns(spark, sf_dir):
    return split_origin(wide(spark, sf_dir))[0].select("id", *dual_target("target"))


@query(
    over_fx(
        """
SELECT id, target, ROW_NUMBER() OVER (ORDER BY MD5('7:' || CAST(id AS VARCHAR)), id) - 1 AS place
FROM fx WHERE is_test = 0"""
    )
)
def seeded_shuffle(spark, sf_dir):
    from riskloom.plans.ordering import global_rank

    train = split_origin(wide(spark, sf_dir))[0].select("id", "target")
    return global_rank(train, [folds.shuffle_key("id", 7), F.col("id")], name="place")


@query(over_folds("SELECT id, target, fold FROM tr"))
def stratified_folds(spark, sf_dir):
    return folded(spark, sf_dir).select("id", "target", "fold")


@query(
    over_fx(
        """
SELECT id, target, CAST((ROW_NUMBER() OVER (ORDER BY MD5('15:' || CAST(id AS VARCHAR)), id) - 1) % 5 AS INT) AS fold
FROM fx WHERE is_test = 0"""
    )
)
def plain_folds(spark, sf_dir):
    train = split_origin(wide(spark, sf_dir))[0].select("id", "target")
    return folds.assign_folds(train, stratify=None)


@query(
    over_fx(
        """
SELECT id, CAST(CAST(('0x' || SUBSTR(MD5('15:' || CAST(id AS VARCHAR)), 1, 8)) AS BIGINT) % 5 AS INT) AS fold
FROM fx WHERE is_test = 0"""
    )
)
def hashed_folds(spark, sf_dir):
    return folds.assign_folds(split_origin(wide(spark, sf_dir))[0].select("id"), exact=False)


@query(
    over_fx(
        """
SELECT feature,
       COUNT(DISTINCT value) FILTER (is_test = 0) AS n_train_values,
       COUNT(DISTINCT value) FILTER (is_test = 1) AS n_test_values,
       COUNT(DISTINCT value) AS n_values
FROM long GROUP BY feature""",
        "long AS (" + long_sql(CODED, "fx", "is_test") + ")",
    )
)
def cardinality_profile(spark, sf_dir):
    train, test = split_origin(wide(spark, sf_dir))
    return profile.cardinality_profile(train, test, CODED)


@query(
    over_fx(
        """
SELECT feature, CASE WHEN COUNT(*) FILTER (num = -1) > 0 THEN 1 ELSE 0 END AS has_missing,
       COUNT(*) FILTER (num = -1) AS n_missing
FROM long GROUP BY feature""",
        "tn AS (SELECT * FROM fx WHERE is_test = 0)",
        "long AS (" + long_sql(CODED, "tn", "is_test") + ")",
    )
)
def missing_profile(spark, sf_dir):
    return profile.missing_profile(split_origin(wide(spark, sf_dir))[0], CODED)


@query(
    over_fx(
        """
SELECT target, COUNT(*) AS n, CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (2e0 * COUNT(*)) AS weight
FROM fx WHERE is_test = 0 GROUP BY target"""
    )
)
def balanced_weights(spark, sf_dir):
    return profile.balanced_weights(split_origin(wide(spark, sf_dir))[0])


@query(
    over_fx(
        """
SELECT nation_cat AS value, COUNT(*) AS n, CAST(SUM(target) AS BIGINT) AS pos, AVG(target) AS mean,
       (SELECT AVG(target) FROM fx WHERE is_test = 0) AS prior
FROM fx WHERE is_test = 0 GROUP BY nation_cat"""
    )
)
def group_mean(spark, sf_dir):
    return profile.group_mean(split_origin(wide(spark, sf_dir))[0], "nation_cat")


@query(
    over_fx(
        """
SELECT feature, value, COUNT(*) FILTER (is_test = 0) AS n_train, COUNT(*) FILTER (is_test = 1) AS n_test
FROM long GROUP BY feature, value""",
        "long AS (" + long_sql(CODED, "fx", "is_test") + ")",
    )
)
def value_support(spark, sf_dir):
    train, test = split_origin(wide(spark, sf_dir))
    return profile.value_support(train, test, CODED)


@query(
    over_fx(
        """
SELECT feature, value, COUNT(*) AS n_test FROM long GROUP BY feature, value
HAVING COUNT(*) FILTER (is_test = 0) = 0""",
        "long AS (" + long_sql(CODED, "fx", "is_test") + ")",
    )
)
def unseen_values(spark, sf_dir):
    from riskloom.operators import encoders
    from riskloom.plans.vocabulary import fit_vocabulary

    train, test = train_test(spark, sf_dir)
    return encoders.unseen_values(fit_vocabulary(train, test, CODED))


@query(
    over_fx(
        """
SELECT feature, value, COUNT(*) FILTER (is_test = 0) AS n_train, COUNT(*) FILTER (is_test = 1) AS n_test
FROM long GROUP BY feature, value
HAVING COUNT(*) FILTER (is_test = 0) > 0 AND COUNT(*) FILTER (is_test = 1) > 0""",
        "long AS (" + long_sql(CODED, "fx", "is_test") + ")",
    )
)
def shared_values(spark, sf_dir):
    from riskloom.operators import encoders
    from riskloom.plans.vocabulary import fit_vocabulary

    train, test = train_test(spark, sf_dir)
    return encoders.shared_values(fit_vocabulary(train, test, CODED))


PARTS = {"train": ["train"], "test": ["test"], "both": ["train", "test"]}
PARTED = "(SELECT feature, value, 'both' AS part FROM long UNION ALL SELECT feature, value, CASE WHEN is_test = 1 THEN 'test' ELSE 'train' END FROM long)"
LONG = "long AS (" + long_sql(CODED, "fx", "is_test") + ")"


def _parted(spark, sf_dir):
    df = wide_stored(spark, sf_dir).withColumn("part", F.when(F.col("is_test") == 1, "test").otherwise("train"))
    return df, materialize(sketches.value_sketches(df, CODED), "sketches")


@query(over_fx(
    "SELECT feature, part, CASE WHEN n <= 2 THEN 'passthrough' WHEN n < 110 THEN 'onehot' ELSE 'drop' END AS route "
    "FROM (SELECT feature, part, COUNT(DISTINCT value) AS n FROM " + PARTED + " GROUP BY feature, part)",
    LONG,
))
def sketch_route(spark, sf_dir):
    """Routes of every column in train, test and both, from stored sketches; only columns near a limit are counted."""
    df, stored = _parted(spark, sf_dir)
    return sketches.route_by_sketches(df, stored, PARTS).withColumnRenamed("group", "part")


@query(over_fx("SELECT feature, part, COUNT(DISTINCT value) AS n_values, TRUE AS within_bound FROM " + PARTED + " GROUP BY feature, part", LONG))
def sketch_cardinality(spark, sf_dir):
    """Exact counts of distinct values, and whether the merged sketches bound them."""
    df, stored = _parted(spark, sf_dir)
    found = profile.cardinality_profile(*split_origin(df), CODED)
    names = {"n_train_values": "train", "n_test_values": "test", "n_values": "both"}
    part = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("kind")]
    exact = found.unpivot(["feature"], list(names), "kind", "n_values").select("feature", part.alias("part"), "n_values").where("n_values > 0")
    rated = sketches.merged(stored, PARTS).withColumnRenamed("group", "part")
    within = F.coalesce(F.col("n_values").between(F.col("low"), F.col("high")), F.lit(False)).alias("within_bound")
    return exact.join(rated, ["feature", "part"], "left").select("feature", "part", "n_values", within)


@query(over_fx(
    "SELECT id, is_test, " + ", ".join(f"DENSE_RANK() OVER (ORDER BY {c}) - 1 AS {c}" for c in CATEGORICAL) + ", TRUE AS loaded, TRUE AS refused FROM fx"
))
def matrix_reload(spark, sf_dir):
    """Codes kept under the fingerprint of tables, vocabulary and settings: a second call loads them, other settings are refused."""
    from riskloom.operators import encoders

    train, test = train_test(spark, sf_dir)
    folder, sources = new_path(spark, "matrices"), {"train": train, "test": test}
    codes = encoders.CategoryCodes(CATEGORICAL).fit(train, test)
    made = []

    def build():
        made.append(1)
        parts = [codes.transform(t).select("id", F.lit(i).alias("is_test"), *CATEGORICAL) for i, t in enumerate((train, test))]
        return parts[0].unionByName(parts[1])

    vocabulary, settings = codes.vocabulary.table, {"columns": CATEGORICAL}
    for _ in range(2):
        found = matrix(build, folder, "codes", sources, vocabulary, settings)
    path = matrix_path(folder, "codes", fingerprint(sources, vocabulary, settings))
    try:
        load_matrix(spark, path, fingerprint({"train": train.where("id % 2 = 0"), "test": test}, vocabulary, settings))
        refused = False
    except StaleMatrix:
        refused = True
    return found.select("*", F.lit(len(made) == 1).alias("loaded"), F.lit(refused).alias("refused"))
