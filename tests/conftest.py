import os
import sys

for _name in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS"):
    os.environ.setdefault(_name, "1")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest  # noqa: E402

from coldspring.config import AlsConfig, ContentConfig, EngineConfig, SplitConfig  # noqa: E402
from coldspring.plans.experiment import Experiment  # noqa: E402
from coldspring.sources.tables import Dataset  # noqa: E402
from coldspring.workspace import Workspace, local_session  # noqa: E402
from tests.data import ring  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, partitions=4, memory="4g", name="coldspring-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def workspace(spark):
    return Workspace(spark)


@pytest.fixture(scope="session")
def frames(spark):
    ratings, items, users = ring()
    return (spark.createDataFrame(ratings), spark.createDataFrame(items, "item_id long, title string, year int, genres array<string>"),
            spark.createDataFrame(users, "user_id long, gender string, age int, occupation int"))


# Eight directions hold the whole title space: fewer would cut through equally long ones, and any rotation of those is right.
SMALL = EngineConfig(k=5, extra_ks=(3,), split=SplitConfig(cold_user_share=0.25, cold_item_share=0.12, min_item_ratings=6),
                     als=AlsConfig(factors=5, regularization=0.2, iterations=7), content=ContentConfig(text_dims=8))


@pytest.fixture(scope="session")
def everything(workspace, frames):
    """Fitted on all ratings (no test part)."""
    from pyspark.sql import functions as F
    ratings, items, _ = frames
    return Experiment(Dataset("fixture", ratings, items, None, None), SMALL, workspace,
                      ratings.withColumn("in_train", F.lit(True)).withColumn("case_id", F.lit("both_warm")))


@pytest.fixture(scope="session")
def experiment(workspace, frames):
    """Fitted on a split, with demographics."""
    return Experiment(Dataset("fixture", *frames, None), SMALL, workspace)
