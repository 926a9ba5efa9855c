"""Property: for decimal / exponent text (the forms both engines accept), the Spark safe casts agree
with Python's ``float(x)`` and ``int(float(x))``."""

from hypothesis import given, settings
from hypothesis import strategies as st

from courtline.functions import exprs as X

numbers = st.one_of(
    st.integers(min_value=-10**6, max_value=10**6).map(str),
    st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False).map(repr),
    st.tuples(st.integers(0, 999), st.integers(0, 99), st.sampled_from(["", "-", "+"]))
      .map(lambda t: f"{t[2]}{t[0]}.{t[1]:02d}"),
    st.tuples(st.integers(1, 9), st.integers(-3, 3)).map(lambda t: f"{t[0]}e{t[1]}"),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(numbers, min_size=50, max_size=50))
def test_safe_casts_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", X.safe_float("s").alias("f"), X.safe_int("s").alias("i")).collect()
    for r in rows:
        assert r.f == float(r.s), r.s
        assert r.i == int(float(r.s)), r.s
