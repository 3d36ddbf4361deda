import pytest

from kestrel.operators import profile as PF


@pytest.mark.parametrize("x,k,want", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05),
                                      (10.0, 3, 0.01856613546304325), (1.0, 4, 0.9097959895689501),
                                      (30.0, 5, 1.4748581038443052e-05)])
def test_chi2_survival(x, k, want):
    assert PF._chi2_sf(x, k) == pytest.approx(want, rel=1e-6)


def test_kruskal_guard_and_significance(spark):
    rows = [(float(i), 0) for i in range(30)] + [(float(i) + 25, 1) for i in range(30)]
    res = PF.kruskal_wallis(spark.createDataFrame(rows, "x double, g int"), "x", "g")
    assert res["valid"] and res["significant"] and res["dof"] == 1
    one = spark.createDataFrame([(1.0, 0), (2.0, 0), (3.0, 1)], "x double, g int")
    assert not PF.kruskal_wallis(one, "x", "g")["valid"]
