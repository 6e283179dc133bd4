import pytest

from careerpanel.functions.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        "4g",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def people(spark):
    """Split episodes of the adapter, ordinary persons only, cached."""
    from careerpanel.operators.split import add_year_age, split_episodes
    from careerpanel.plans.adapter import episode_people

    placed = episode_people(spark, SF).map(add_year_age).map(split_episodes)
    return placed.map(lambda df: df.cache())
