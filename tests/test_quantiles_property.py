
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hearth.config import Scale
from hearth.operators.quantiles import exact_quantiles

TINY = Scale(exact_direct_max=12, refine_buckets=4, refine_collect_max=5)

values = st.lists(
    st.one_of(st.floats(-1e6, 1e6, allow_nan=False, width=32), st.sampled_from([0.0, 1.5, -2.25, float("nan")])),
    min_size=1,
    max_size=60,
)
groups = st.lists(st.sampled_from(["a", "b", "c"]), min_size=60, max_size=60)
probs = st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]), min_size=1, max_size=3, unique=True)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, gs=groups, ps=probs, tiny=st.booleans())
def test_quantiles_equal_pandas(spark, xs, gs, ps, tiny):
    pdf = pd.DataFrame({"g": gs[: len(xs)], "x": [float(v) for v in xs]})
    df = spark.createDataFrame(pdf)
    out = exact_quantiles(df, ["x"], ps, by=["g"], scale=TINY if tiny else Scale()).toPandas()
    exp = {}
    for g, part in pdf.groupby("g"):
        col = part["x"].dropna()
        if len(col):
            for p in ps:
                exp[(g, p)] = col.quantile(p)
    got = {(r["g"], r["prob"]): r["value"] for _, r in out.iterrows()}
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert got[k] == v
