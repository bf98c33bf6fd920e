import pytest

from streamtab.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    return session


def rows(df, *order):
    """Rows as sorted tuples, doubles rounded."""
    picked = df.select(*order) if order else df
    return sorted(
        (tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in picked.collect()), key=repr
    )
