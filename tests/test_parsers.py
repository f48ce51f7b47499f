from lodestrata.functions import parsers as P


def test_python_symbols(spark):
    rows = spark.createDataFrame([("a.py", 'class A:\n  async def f(self, x):\n    """d"""\n'), ("b.py", "def ("), ("c.py", None)], "path string, text string")
    got = [tuple(r) for r in P.extract(rows, "python_symbols", "path").collect()]
    assert got == [("a.py", "class", "A", 1, [], "", False), ("a.py", "method", "f", 2, ["self", "x"], "d", True)]


def test_table_function_in_sql(spark):
    P.register(spark)
    got = spark.sql("SELECT t.name, s.name AS symbol FROM VALUES ('x', 'class B: pass') AS t(name, text), LATERAL python_symbols(t.text) s").collect()
    assert [tuple(r) for r in got] == [("x", "B")]
