import pytest

from postgauge.plans import training, training_run
from postgauge.session import fresh_path
from postgauge.stages.post_features import PostFeatures

SMALL = {"n_estimators": 2, "max_depth": 2}


@pytest.fixture
def bounds(monkeypatch):
    """What the plans ask `bounded_rows` for."""
    asked, bounded = [], training.bounded_rows

    def seen(rows, n, row_id, algorithm, seed, most):
        asked.append(most)
        return bounded(rows, n, row_id, algorithm, seed, most)

    for plan in (training, training_run):
        monkeypatch.setattr(plan, "bounded_rows", seen)
    return asked


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(i, float(i), 1.0 * (i % 5), f"u{i}") for i in range(60)]
    return spark.createDataFrame(rows, "Id int, n double, Score double, OwnerUserId string")


def test_train_evaluate_grows_from_all_rows_unless_a_caller_bounds_them(posts, bounds):
    done = training.train_evaluate(posts, posts, PostFeatures(numericCols=["n"]), params=SMALL, quality_labels=False)
    assert bounds == [None] and done.fit_rows == 60


def test_a_run_grows_from_all_rows_unless_a_caller_bounds_them(spark, posts, bounds):
    folder = fresh_path(spark, "run")
    done = training_run.run_training(spark, folder, posts, posts, PostFeatures(numericCols=["n"]), params=SMALL, quality_labels=False)
    assert bounds == [None] and done.fit_rows == 60
