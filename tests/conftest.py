import pytest

from tagloom.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def cells(spark):
    """Cells from ``(row_key, qualifier[, ts[, value]])`` tuples."""

    def make(*rows):
        full = [(r[0], "cf", r[1], r[2] if len(r) > 2 else 1, r[3] if len(r) > 3 else "1") for r in rows]
        return spark.createDataFrame(full, "row_key string, family string, qualifier string, ts bigint, value string")

    return make


@pytest.fixture
def one(spark):
    """Value of a column function for one input."""

    def value(fn, *inputs):
        names = [f"c{i}" for i in range(len(inputs))]
        df = spark.createDataFrame([tuple(inputs)], ", ".join(f"{n} string" for n in names))
        return df.select(fn(*names)).first()[0]

    return value


def rows(df):
    return sorted(tuple(r) for r in df.collect())
