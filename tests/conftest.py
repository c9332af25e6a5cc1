import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import local_session

    session = local_session("tests", "4", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def tables(spark):
    """Labelled rows with folds, and unlabelled rows, of the smallest scale."""
    from riskloom.operators.folds import assign_folds
    from riskloom.plans.materialize import materialize
    from riskloom.sources.order_risk import order_risk, split_origin

    train, test = split_origin(materialize(order_risk(spark, SMALL), "wide"))
    return materialize(assign_folds(train), "folded"), test


def final_plan(df):
    """Text of the physical plan that has run."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan")[0]
