import pytest

from pagemill.session import session


@pytest.fixture(scope="session")
def spark():
    s = session(
        "local[8]",
        "tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def plan_of(spark, capsys):
    def text(frame, mode="formatted"):
        capsys.readouterr()
        frame.explain(mode)
        return capsys.readouterr().out

    return text
