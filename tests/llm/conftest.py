import pytest

from lumetry.llm.common import importable

WORDS = "stone river lamp window paper cloud garden signal copper letter winter basket mirror thunder orchard anchor".split()


@pytest.fixture(autouse=True, scope="session")
def workers(spark):
    importable(spark)


def prose(seed, n):
    """n words; the same for equal seeds."""
    return " ".join(WORDS[(seed * 7919 + i * i * 31 + i * seed) % 16] + str((seed * 31 + i * 17 + i * i) % 97) for i in range(n))


CLASHING = ", score STRING, group_id STRING, component STRING, key STRING, n STRING, digest STRING, start STRING, shard STRING"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names that operators use themselves."""
    more = ("x",) * 8
    rows = [
        (1, prose(1, 120)), (2, prose(1, 120)), (3, prose(1, 119) + " end"), (4, None), (5, ""), (None, prose(2, 80)), (None, None),
        (6, prose(3, 30000)), (7, "short"), (8, "a b c"), (9, prose(4, 70)), (9, prose(4, 70)), (10, "é ü 中文   ×"),
    ]
    return spark.createDataFrame([r + more for r in rows], "doc_id LONG, text STRING" + CLASHING).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id LONG, text STRING" + CLASHING)
