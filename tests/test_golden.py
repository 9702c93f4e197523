"""Fixed expected values and boundary cases."""

import datetime as dt

from pyspark.sql import functions as F

from tidemill.functions import dates as D, numeric as N, text as X
from tidemill.functions.stem import porter_stem
from tidemill.operators import aggregates as A, ordering as O
from tidemill.plans.aggregates import SCORE_EDGES


def value(spark, col, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()]) if cols else spark.range(1)
    return df.select(col.alias("x")).first()["x"]


def test_score_bands(spark):
    df = spark.createDataFrame([(float(v),) for v in (23, 76, 1300, 600)], "s double")
    assert [r["n"] for r in A.band_counts(df, "s", SCORE_EDGES).orderBy("band").collect()] == [0, 0, 2, 0, 1, 1, 0]


def test_nerd_score(spark):
    assert abs(value(spark, N.nerd_score(F.lit(1.0), F.lit(4.0), F.lit(1.0))) - 18.33030277982336) < 1e-12


def test_time_band_edges(spark):
    cases = {"07:59:59": "Error", "08:00:00": "Breakfast", "12:00:00": "Breakfast", "12:00:01": "Lunch",
             "16:00:00": "Lunch", "16:00:01": "Dinner", "20:00:00": "Dinner", "20:00:01": "Error"}
    for t, label in cases.items():
        assert value(spark, D.time_band(F.lit(f"2018-05-01 {t}").cast("timestamp_ntz"))) == label


def test_repair_date(spark):
    for text in ("25-12-2018", "2018-25-12", "2018-12-25"):
        assert value(spark, D.repair_date(F.lit(text))) == "2018-12-25"


def test_rolling_mean_width_five(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(1, 6)], "k string, t int, v double")
    out = O.rolling_mean(df, ["k"], ["t"], "v", 5).orderBy("t").collect()
    assert [r["rolling_mean"] for r in out] == [2, 2.5, 3, 3.5, 4]


def test_histogram_overflow(spark):
    df = spark.createDataFrame([(v,) for v in (0, 9, 10, 99, 100, 250)], "v int")
    assert [r["n"] for r in A.histogram(df, "v").orderBy("bin").collect()] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 1, 2]


def test_quartile_interpolates(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 10)], "v double")
    assert O.quantiles(df, "v", [0.25]).first()["p0"] == 1.75


def test_text_functions(spark):
    assert value(spark, X.clean_line(F.lit(" The co-op, No.1! É "))) == "the coop no"
    assert value(spark, X.unescape(F.lit("a &amp;amp;amp; b &lt;c&gt; &quot;"))) == 'a & b <c> "'
    assert value(spark, X.dehyphenate(F.lit("exam- ple and- so a- b- c"))) == "example andso abc"
    assert value(spark, X.regex_tokens(F.lit("It's a well-known fact x2"))) == ["It's", "well-known", "fact", "x2"]
    assert value(spark, X.sentences(F.lit("One here. Two there! no split? Yes."))) == [
        "one here.", "two there! no split?", "yes."]
    assert value(spark, X.clean_social(F.lit("@bob Hi, you 2! see https://a.b/c?d e"))) == "hi  you   see "
    assert value(spark, X.clean_social(F.lit("ends with @bob"))) == "ends with  bob"
    assert value(spark, X.section_between(F.lit("x Abstract\nbody\nReferences y"), "Abstract", "References")) == "\nbody\n"
    assert value(spark, X.section_between(F.lit("nothing"), "Abstract", "References")) is None
    assert value(spark, X.substring_count(F.lit("cited by a, cited by b"), "cited by")) == 2
    assert value(spark, X.bracketed(F.array(F.lit("A B"), F.lit("C D")))) == "[A B,C D]"
    assert value(spark, X.vocab_size(F.lit("a b A c!"))) == 3


def test_extended_stems():
    known = {"dies": "die", "dying": "die", "died": "die", "tried": "tri", "enjoy": "enjoy", "possibly": "possibl",
             "archaeology": "archaeolog", "skies": "sky", "news": "news", "happy": "happi", "by": "by", "spy": "spi",
             "skillfully": "skill", "proceed": "proceed", "running": "run", "relational": "relat", "used": "use"}
    assert {w: porter_stem(w, extended=True) for w in known} == known


def test_porter_stems():
    known = {"caresses": "caress", "ponies": "poni", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster",
             "motoring": "motor", "sing": "sing", "conflated": "conflat", "hopping": "hop", "falling": "fall", "filing": "file",
             "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "vietnamization": "vietnam",
             "operator": "oper", "triplicate": "triplic", "hopeful": "hope", "goodness": "good", "revival": "reviv",
             "adoption": "adopt", "effective": "effect", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
             "probate": "probat", "electrical": "electr", "decisiveness": "decis"}
    assert {w: porter_stem(w) for w in known} == known


def test_clock_and_stay(spark):
    assert value(spark, D.clock_seconds(F.lit("07:30:05"))) == 27005
    assert value(spark, D.clock_seconds(F.lit("24:30:05"))) is None
    assert value(spark, D.clock_seconds(F.lit("bad"))) is None
    stay = D.stay_seconds(F.lit("2019-05-01 10:00:00").cast("timestamp_ntz"), F.lit("2019-05-03 16:30:00").cast("timestamp_ntz"))
    assert value(spark, D.whole_days(stay)) == 2 and value(spark, D.rest_hours(stay)) == 6.5


def test_latlon_repair(spark):
    fix = lambda a, b: tuple(value(spark, N.repair_latlon(F.lit(a), F.lit(b))))
    assert fix(37.8, 144.9) == (-37.8, 144.9)
    assert fix(144.9, -37.8) == (-37.8, 144.9)
    assert fix(-37.8, 144.9) == (-37.8, 144.9)


def test_ratios(spark):
    assert value(spark, N.guarded_ratio(F.lit(1.0), F.lit(0.0))) == 0.0
    assert value(spark, N.ratio_flag(F.lit(3.0), F.lit(2.0))) == 1
    assert value(spark, N.safe_log(F.lit(0.0))) == 0.0
    assert value(spark, N.two_stage(F.lit(True), F.lit(-2.0))) == 0.0


def test_weekend(spark):
    for day, weekend in ((dt.date(2024, 1, 5), False), (dt.date(2024, 1, 6), True), (dt.date(2024, 1, 8), False)):
        assert value(spark, D.is_weekend(F.lit(day))) is weekend
