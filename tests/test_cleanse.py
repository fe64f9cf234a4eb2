"""PRJ-01..13 / FN-01..16: column expressions on the FIXTURES.md edge rows."""
from pyspark.sql import functions as F

from lakeward.functions import cleanse as C


def one_col(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_guarded_int_person_years(spark):  # PRJ-03
    df = one_col(spark, ["427", "0", "-12", "12345", "18x9", None, "1999"])
    got = [r[0] for r in df.select(C.guarded_int("v", C.YEAR_1_TO_4_DIGITS)).collect()]
    assert got == [427, 0, None, None, None, None, 1999]


def test_guarded_int_title_years_and_digits(spark):  # PRJ-04, PRJ-05
    df = one_col(spark, ["95", "1849", "2036", "146445", "99999999999"])
    got = df.select(C.guarded_int("v", C.YEAR_4_DIGITS).alias("y"),
                    C.guarded_int("v", C.DIGITS).alias("d")).collect()
    assert [r.y for r in got] == [None, 1849, 2036, None, None]
    assert [r.d for r in got] == [95, 1849, 2036, 146445, None]  # beyond int -> NULL


def test_unguarded_casts(spark):  # PRJ-06, PRJ-07
    df = one_col(spark, ["5.7", "10", "abc", None, "1.0"])
    got = df.select(C.to_int("v").alias("i"), C.to_double("v").alias("d")).collect()
    assert [r.i for r in got] == [None, 10, None, None, None]
    assert [r.d for r in got] == [5.7, 10.0, None, None, 1.0]


def test_flag(spark):  # PRJ-08
    df = one_col(spark, ["1", "0", None, "true"])
    assert [r[0] for r in df.select(C.flag("v")).collect()] == [True, False, False, False]


def test_split_list(spark):  # PRJ-09, FN-07, FN-08
    df = one_col(spark, ["actor,producer", "", " ", None, " Drama,Drama", "a,b,"])
    got = df.select(C.split_list("v").alias("a")).collect()
    assert [r.a for r in got] == [["actor", "producer"], None, [""], None, ["Drama", "Drama"],
                                  ["a", "b", ""]]
    sized = df.select(C.count_items(C.split_list("v")).alias("n"),
                      C.joined(C.split_list("v")).alias("j")).collect()
    assert [r.n for r in sized] == [2, None, 1, None, 2, 3]
    assert sized[0].j == "actor,producer" and sized[1].j is None


def test_codes_trim_spaces_only(spark):  # PRJ-02, PRJ-10, PRJ-11
    df = one_col(spark, [" us ", "EN", "\tx "])
    got = df.select(C.upper_code("v").alias("u"), C.lower_code("v").alias("l"),
                    C.text("v").alias("t")).collect()
    assert [r.u for r in got] == ["US", "EN", "\tX"]
    assert [r.l for r in got] == ["us", "en", "\tx"]
    assert got[2].t == "\tx"  # tabs stay (P4)


def test_strip_brackets(spark):  # PRJ-12
    df = one_col(spark, ['["Self"]', '["A","B"]', "plain", None])
    assert [r[0] for r in df.select(C.strip_brackets("v")).collect()] == \
        ["Self", 'A","B', "plain", None]


def test_keys(spark):  # FN-09, FN-11, GD-13
    df = spark.createDataFrame([("actor", None), ("actor", "lead"), (None, "x")], "c string, j string")
    got = df.select(C.composite_key("c", "j").alias("k"), C.null_safe_key("c", "j").alias("n")).collect()
    assert [r.k for r in got] == [None, "actor_lead", None]
    assert [r.n for r in got] == ["actor_", "actor_lead", None]


def test_mapped(spark):  # FN-12, GD-05 department mapping
    from lakeward.specs import DEFAULT_DEPARTMENT, DEPARTMENTS
    df = one_col(spark, ["self", "cinematographer", "production_designer", "editor", "composer"])
    got = [r[0] for r in df.select(C.mapped("v", DEPARTMENTS, DEFAULT_DEPARTMENT)).collect()]
    assert got == ["cast", "directing", "production", "writing", "other"]


def test_typed_null(spark):  # FN-13
    assert spark.range(1).select(C.typed_null("string").alias("x")).schema["x"].dataType.typeName() == "string"
    assert spark.range(1).select(F.lit(1)).count() == 1


def test_strip_brackets_equals_its_patterns(spark):
    """Cut by position, with the results of ``^\\["`` and ``"\\]$`` on odd texts."""
    odd = [None, "", '["', '"]', '["]', '[""]', ' ["a"] ', '["a"]\n', '["a"]\r\n', '["a"]\n\n', '["a","b"] x', 'a"]b"]', '\n["a"]',
           '["["é\U0001f600"]"]', '["a"]\u2028', "plain"]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    by_pattern = F.regexp_replace(F.regexp_replace(F.trim("v"), r'^\["', ""), r'"\]$', "")
    got = df.select(C.strip_brackets("v").alias("a"), by_pattern.alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert r'^\["' not in str(df.select(C.strip_brackets("v").alias("a"))._jdf.queryExecution().optimizedPlan())
