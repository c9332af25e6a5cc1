"""Calibrations on rows with counts."""

from riskloom.operators import stacking


def test_calibrations_read_distinct_rows(spark, monkeypatch):
    made = [(i, int((i * 7 + i // 11) % 5 < 1 + i % 2), i % 5, float(i % 4) / 4, float(i % 3) / 3) for i in range(1200)]
    oof = spark.createDataFrame(made, "id long, target int, fold int, a double, b double")
    seen, old = [], stacking.calibrate

    def counted(rows, score, label, n, *weight):
        seen.append((rows.count(), n))
        return old(rows, score, label, n, *weight)

    monkeypatch.setattr(stacking, "calibrate", counted)
    got = stacking.stack(oof, ["a", "b"])
    scores = {r.id: r.prediction for r in got.oof.collect()}
    assert len(seen) == 5 and all(n == 960 and size <= 4 * 3 * 4 * 2 for size, n in seen)
    weights = {(r.fold, r.model): r.weight for r in got.weights.collect()}
    z = 0.0 + weights[0, "a"] * oof.a + weights[0, "b"] * oof.b
    rows = oof.withColumn("_z", z)
    plain = {r.id: r.prediction for r in old(rows.where("fold <> 0"), "_z", "target", 960)(rows.where("fold = 0"), ["id"]).collect()}
    assert plain and all(abs(scores[i] - p) < 1e-6 for i, p in plain.items())
