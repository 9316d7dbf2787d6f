import pytest

from tempolane.sources.shared import send_package


@pytest.fixture(scope="module", autouse=True)
def package(spark):
    send_package(spark)


@pytest.fixture
def docs(spark):
    """Nulls, empty and long texts, repeated rows, and a column that could clash."""
    base = [f"word{i % 7} and the other{i} stand here with some more text {i * 3} for all" for i in range(8)]
    long_text = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (1, base[0] + "\n" + base[1], "a", 0), (2, base[2], "b", 0), (3, None, "a", 0), (4, "", None, 0), (5, long_text, "a", 0),
        (6, base[2], "b", 0), (6, base[2], "b", 0), (None, base[3], "c", 0), (7, "short", "c", 0), (8, base[1], "a", 0),
        (9, " \t\n  ", "b", 0), (10, long_text + " tail", "b", 0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
