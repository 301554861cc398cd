"""SQL table functions leave the caller's session as it was."""

from tallyloom.operators import quantify


def test_names_of_the_session_stay(spark):
    lines = spark.createDataFrame([(1, 10, "a"), (1, 11, "a"), (2, 12, "a"), (2, 12, "b"), (3, 13, None)], "customer long, order_key long, brand string")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION customers_of_one_brand(name STRING) RETURNS STRING RETURN concat(name, '!')")
    views, functions = ({x.name for x in listed()} for listed in (spark.catalog.listTables, lambda: spark.sql("SHOW USER FUNCTIONS").toDF("name").collect()))
    with quantify.table_functions(lines) as (customers, orders):
        found = spark.sql(f"SELECT customer FROM {customers}('a')"), spark.sql(f"SELECT order_key FROM {orders}('a')")
    assert [sorted(r[0] for r in f.collect()) for f in found] == [[1], [10, 11]]
    assert spark.sql("SELECT customers_of_one_brand('x')").first()[0] == "x!"
    assert {x.name for x in spark.catalog.listTables()} == views
    assert {r[0] for r in spark.sql("SHOW USER FUNCTIONS").collect()} == functions
    spark.sql("DROP TEMPORARY FUNCTION customers_of_one_brand")
