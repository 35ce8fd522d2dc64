"""Tables with further columns whose names differ in case only, for every query."""

import pyarrow.parquet as pq
import pytest

from __spark_entry__ import queries
from paylake.llm.queries import QUERIES

TABLE = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def clashing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("clashing")
    for name in ("documents", "embeddings", "pages", "labels", "conversations"):
        table = pq.read_table(f"{TABLE}/{name}.parquet")
        for column in reversed(table.column_names):
            table = table.add_column(0, column.upper(), [["other"] * table.num_rows])
        pq.write_table(table, folder / f"{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_names_in_another_case(spark, clashing, name):
    setting = spark.conf.get("spark.sql.caseSensitive")
    got = queries()[name](spark, clashing)
    assert spark.conf.get("spark.sql.caseSensitive") == setting
    if name in ("op2_best_fit_packing", "pipeline"):
        # Sequence numbers are free.
        assert got.count() == queries()[name](spark, TABLE).count()
    else:
        assert rows_of(got) == rows_of(queries()[name](spark, TABLE))
