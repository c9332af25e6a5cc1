"""Model queries grow as many trees as the published settings have."""

import pytest

from __spark_entry__ import queries
from riskloom.catalog import blending, learning
from riskloom.operators import oof
from riskloom.operators.learners import Facts


class Asked(Exception):
    """The learner that a query hands to the out-of-fold driver."""


class Anything:
    """Stands for every table: any method of it gives another one."""

    def __getattr__(self, name):
        return lambda *args, **kwargs: self


def learner_of(monkeypatch, name):
    def stop(train, learner, *args, **kwargs):
        raise Asked(learner)

    monkeypatch.setattr(learning, "materialize", lambda rows, *args: rows)
    monkeypatch.setattr(learning, "mean_encoded", lambda *args: (None, None, None, None))
    monkeypatch.setattr(learning, "oof_predict", stop)
    monkeypatch.setattr(oof, "oof_predict", stop)
    monkeypatch.setattr(blending, "train_test", lambda *args: (Anything(), Anything()))
    monkeypatch.setattr(blending, "assign_folds", lambda rows: rows)
    monkeypatch.setattr(blending, "full_features", lambda *args: (Anything(), Anything(), ["a"]))
    monkeypatch.setattr("pyspark.ml.feature.VectorAssembler", lambda **kwargs: Anything())
    with pytest.raises(Asked) as told:
        queries()[name](None, "")
    return told.value.args[0]


def test_best_rounds_are_chosen_among_all_rounds(spark, monkeypatch):
    learner = learner_of(monkeypatch, "boosted_best_rounds")
    assert learner.trees == learner.build(Facts(10, 3), 0).getMaxIter() == 370


def test_the_full_features_are_fitted_with_all_trees(spark, monkeypatch):
    learner = learner_of(monkeypatch, "oof_full_features")
    assert learner.trees == learner.build(Facts(10, 3), 0).getMaxIter() == 500


def test_boosted_trees_are_fitted_with_all_trees(spark, monkeypatch):
    learner = learner_of(monkeypatch, "oof_gbt")
    assert learner.trees == learner.build(Facts(10, 3), 0).getMaxIter() == 370


def test_the_forest_is_fitted_with_all_trees(spark, monkeypatch):
    learner = learner_of(monkeypatch, "oof_rf")
    assert learner.build(Facts(10, 3), 0).getNumTrees() == 400
