"""Space trimming (X6): the fast path equals the plain character-set trim
and Python's own definition on generated strings, edge characters included."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.functions import SPACE_SEPARATORS, normalize_text, trim_spaces

# ends mixed from separators, near-miss characters (tab, newline, zero-width
# space U+200B, U+0080/U+009F at the ASCII boundary, U+2028 line separator)
# and ordinary text, including non-ASCII letters and a 4-byte character
EDGE = (SPACE_SEPARATORS + "\t\n\r\u200b\u0080\u009f\u2028\u00ff"
        + "aZ0-\u00e9\u6f22\U0001f600")
texts = st.text(alphabet=st.sampled_from(EDGE), max_size=8) | st.none()


def python_trim(s):
    return None if s is None else s.strip(SPACE_SEPARATORS)


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(texts, min_size=1, max_size=60))
def test_trim_spaces_equals_set_trim(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(
        trim_spaces("s").alias("fast"),
        F.btrim("s", F.lit(SPACE_SEPARATORS)).alias("plain")).collect()
    for v, r in zip(values, rows):
        assert r.fast == r.plain == python_trim(v), (v, r)


def test_trim_spaces_edges(spark):
    cases = ["", " ", "\u00a0", " \u00a0 x \u3000", "\tx\t", "x\u200b",
             "\u00e9", " \u00e9 ", "a\u2003b", "\u2009x", None]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    got = [r[0] for r in df.select(trim_spaces("s")).collect()]
    assert got == [python_trim(c) for c in cases]


# letters whose case mapping is special in some engine (dotted / dotless i,
# sigma, sharp s, Kelvin sign, titlecase dz), separators and near misses
CASE_EDGE = (SPACE_SEPARATORS + "\t\u200b\u0085\u180e"
             + "aZ\u0130\u0131I\u03a3\u03c3\u03c2\u0391\u1e9e\u00df\u212a\u01c5"
             + "\u00c9\u6f22\U0001f600")
case_texts = st.text(alphabet=st.sampled_from(CASE_EDGE), max_size=8) | st.none()


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(case_texts, min_size=1, max_size=60))
def test_normalize_text_equals_sql_lower_trim_coalesce(spark, values):
    """X5-X7 against the SQL the rules are written in, run by DuckDB:
    LOWER(TRIM(COALESCE(s, default))) and TRIM(COALESCE(s, default))."""
    import duckdb
    con = duckdb.connect()
    want = [con.execute("SELECT lower(trim(coalesce(?, 'direct'))), "
                        "trim(coalesce(?, 'direct'))", [v, v]).fetchone()
            for v in values]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = df.select(normalize_text("s", "direct").alias("low"),
                    normalize_text("s", "direct", lower=False).alias("kept")).collect()
    for v, g, w in zip(values, got, want):
        assert (g.low, g.kept) == w, (v, g, w)
