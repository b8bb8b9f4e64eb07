"""Column families of V19 that queries reach; `test_oracles` compares them with their SQL."""

import pytest

import __spark_entry__ as entry_points
from paneloom.catalog import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("family", ["infodemic", "vaccination", "factcheck", "excess"])
def test_family_has_a_query_and_sql(spark, family):
    name = f"corr_matrix_{family}"
    assert name in entry_points.oracle_sql()
    assert entry_points.queries()[name](spark, SF).filter("n > 0").count() > 0


def test_vaccination_query_covers_the_panel(spark):
    from paneloom.plans import views as V

    cols = [c for c in V.FAMILIES["vaccination"] if c in fx.panel(spark, SF).columns]
    seen = entry_points.queries()["corr_matrix_vaccination"](spark, SF)
    assert {r["x"] for r in seen.collect()} | {r["y"] for r in seen.collect()} == set(cols)
