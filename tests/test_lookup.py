import pytest
from pyspark.sql import functions as F

from clickloom.operators.lookup import SideTable, lookup


@pytest.mark.parametrize("columns", [4, 13])
def test_no_generated_method_holds_all_joins(spark, columns):
    """All joins were one generated method; the JVM does not compile it where there are two dozen."""
    names = [f"c{i}" for i in range(columns)]
    rows = [(k, *[None if (k + i) % 5 == 0 else (k * (i + 3)) % 17 for i in range(columns)]) for k in range(90)]
    df = spark.createDataFrame(rows, f"id int, {', '.join(f'{c} int' for c in names)}").repartition(3, "id")
    known = {(c, v): 100 * i + v for i, c in enumerate(names) for v in range(i % 4, 12)}
    entries = spark.createDataFrame([(c, v, v + 1, p) for (c, v), p in known.items()], "name string, value int, rank long, payload long")
    found = lookup(df, SideTable.measure(entries, 8), {c: c for c in names})
    runs, plan = [0], found._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Coalesce" in line and "coalesce(" not in line:
            runs.append(0)
        runs[-1] += "BroadcastHashJoin" in line
    assert sum(runs) == columns and max(runs) <= 5
    assert found.columns == ["id", *names, *[f"{c}_found" for c in names]]
    assert {tuple(r) for r in found.collect()} == {(*r, *[known.get((c, v)) for c, v in zip(names, r[1:])]) for r in rows}
    assert found.count() == len(rows)
    layout = lambda d: {(r.id, r.part) for r in d.select("id", F.spark_partition_id().alias("part")).collect()}
    groups = lambda d: sorted(sorted(k for k, p in d if p == part) for part in {p for _, p in d})
    assert groups(layout(found)) == groups(layout(df))
