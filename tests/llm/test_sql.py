"""The operators that SQL can say, against their SQL."""

from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tallyfield.llm import registry

from .helpers import SF


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    want = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == Counter(want.fetchall())


def test_near_vectors_equal_their_sql_where_links_are(spark, tmp_path):
    """The tables hold hardly any pairs at 0.93: the same comparison over vectors with planted near copies."""
    rng = np.random.default_rng(20)
    held = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    rows = list(held)
    for k in range(150):
        i, v, label = held[int(rng.integers(len(held)))]
        spread = float(rng.uniform(0.05, 0.6))
        near = np.asarray(v) + spread * np.linalg.norm(v) / np.sqrt(len(v)) * rng.standard_normal(len(v))
        rows.append((10**6 + k, [float(x) for x in np.float32(near)], label if k % 10 else None))
    schema = spark.read.parquet(f"{SF}/embeddings.parquet").schema
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    want = con.execute(registry.oracle_sql()["op2_vector_forest"])
    names = [d[0] for d in want.description]
    want = want.fetchall()
    got = registry.queries()["op2_vector_forest"](spark, str(tmp_path))
    assert Counter(tuple(r[n] for n in names) for r in got.collect()) == Counter(want)
    assert sum(r[names.index("n_links")] for r in want) > 100
