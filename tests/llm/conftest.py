import pytest
from llm_brute import SCHEMA, awkward_texts


@pytest.fixture(scope="module")
def awkward(spark):
    texts = awkward_texts()
    rows = [(None if i == 3 else 4 if i == 5 else i, t, None if i % 4 == 0 else "en" if i % 2 else "de", None if i % 5 == 0 else "s" + str(i % 3),
             None, "clash", "clash", 1, 2) for i, t in enumerate(texts)]
    rows.append(rows[8])  # a repeated row
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, None if i == 6 else i % 2, 0) for i in range(19)] + [(None, 1, 0), (2, 1, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta 5 km zeta eta theta iota"), (2, None), (3, ""), (4, "too short"), (None, "one two three four five six seven"),
                                  (1, "alpha beta gamma delta 5 km zeta eta theta iota")], "item_id long, text string")
