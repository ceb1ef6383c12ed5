"""Details of lists where several could be the last, read from files that Spark takes in another order than they were written in."""

import duckdb
import pytest

from sievework.plans.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """400 orders with six lines each, of which all have one number; the second of two files is the larger one, so Spark reads it first."""
    top = tmp_path_factory.mktemp("ties")
    (top / "lineitem.parquet").mkdir()
    con = duckdb.connect()
    con.execute("set threads = 1")  # more threads take any of the rows that tie
    con.execute(f"copy (select i::bigint as o_orderkey, 'O' as o_orderstatus, '2-HIGH' as o_orderpriority from range(400) t(i)) to '{top}/orders.parquet'")
    line = "i // {n} as l_orderkey, 3 as l_linenumber, 30.0::double as l_quantity, chr(65 + (i * 7 % 26)::int) as l_returnflag, chr(97 + (i * 11 % 26)::int) as l_linestatus"
    for part, n in enumerate((1, 5)):
        con.execute(f"copy (select {line.format(n=n)}, repeat(chr(65 + (i % 26)::int), 40 * {part} + 1) as l_comment from range(400 * {n}) t(i)) to '{top}/lineitem.parquet/part-{part}.parquet'")
    con.execute(f"create view orders as select * from '{top}/orders.parquet'")
    con.execute(f"create view lineitem as select * from '{top}/lineitem.parquet/*.parquet'")
    return con, str(top)


@pytest.mark.parametrize("name", ["merge_details", "only_with_details"])
def test_details_of_one_number_go_by_place(spark, tables, name):
    con, top = tables
    want = con.execute(ORACLE_SQL[name]).fetchall()
    columns = [c[0] for c in con.description]
    assert sorted(map(tuple, QUERIES[name](spark, top).select(*columns).collect())) == sorted(want)
