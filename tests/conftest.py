from __future__ import annotations

import pytest

from partyard.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests", **{"spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate ``Column -> Column`` functions on Python values, in one job."""
    from pyspark.sql import functions as F

    def run(function, *cases, kind="string"):
        width = len(cases[0]) if isinstance(cases[0], tuple) else 1
        rows = [(n, *(c if isinstance(c, tuple) else (c,))) for n, c in enumerate(cases)]
        kinds = kind if isinstance(kind, (list, tuple)) else [kind] * width
        schema = ", ".join(["n int", *(f"c{k} {kinds[k]}" for k in range(width))])
        df = spark.createDataFrame(rows, schema)
        out = df.select("n", function(*[F.col(f"c{k}") for k in range(width)]).alias("r"))
        return [r.r for r in sorted(out.collect())]

    return run
