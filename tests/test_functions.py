import pytest
from pyspark.sql import functions as F

from isospread.functions import naming, physics, text
from isospread.operators import members


def test_brightness_temperature(spark):
    flux = [240.5, 0.0, -1.0, None, float("nan")]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(flux)], "i INT, FLNT DOUBLE")
    rows = df.withColumn("t", physics.brightness_temperature(F.col("FLNT"))).orderBy("i").collect()
    assert rows[0].t == pytest.approx(255.201372, abs=1e-6)
    assert [r.t for r in rows[1:]] == [0.0, None, None, None]


def test_brightness_inverts(spark):
    df = spark.range(1, 400).select(F.col("id").cast("double").alias("f"))
    t = physics.brightness_temperature(F.col("f"))
    back = df.select((F.pow(t, F.lit(4.0)) * physics.STEFAN_BOLTZMANN - F.col("f")).alias("d"))
    assert back.agg(F.max(F.abs("d"))).first()[0] < 1e-9


def test_brightness_keeps_metadata_through_parquet(spark, tmp_path):
    cube = spark.createDataFrame([("m", 1.0, 240.5, 1.0)], "ensemble_member STRING, lat DOUBLE, "
                                 "FLNT DOUBLE, PS DOUBLE")
    analysed = members.brightness(cube)
    assert analysed.columns == ["ensemble_member", "lat", "FLNT", "TBRT"]
    analysed.write.parquet(str(tmp_path / "x"))
    field = spark.read.parquet(str(tmp_path / "x")).schema["TBRT"]
    assert field.metadata == {"long_name": "brightness temperature from FLNT", "units": "K"}


def column_kwargs(spark, s):
    df = spark.createDataFrame([(s,)], "s STRING")
    return df.select(text.parse_kwargs_column(F.col("s"))).first()[0]


@pytest.mark.parametrize(
    "s, expected",
    [
        ("datalev&&250", {"DATALEV": "250"}),
        ("A&&1_B&&2", {"A": "1", "B": "2"}),
        ("A&&1_A&&2", {"A": "2"}),
        ("A&&_B&&2", {"A": "", "B": "2"}),
    ],
)
def test_kwargs(spark, s, expected):
    assert text.parse_kwargs(s) == expected
    assert column_kwargs(spark, s) == expected


@pytest.mark.parametrize("s", ["A&&1_", "TRUE", "A&&1&&2", ""])
def test_malformed_kwargs_raise(spark, s):
    with pytest.raises(ValueError, match="malformed"):
        text.parse_kwargs(s)
    with pytest.raises(Exception, match="malformed"):
        column_kwargs(spark, s)


def test_output_names(spark):
    def name(column):
        return spark.range(1).select(column).first()[0]

    e, m, s = F.lit("E"), F.lit("M"), F.lit("S")
    none, some = F.lit("NONE"), F.lit("1850")
    no, yes = F.lit(False), F.lit(True)
    assert name(naming.member_name(e, m, s, none, no)) == "E_M_S_.nc"
    assert name(naming.member_name(e, m, s, none, yes)) == "E_M_S__TESTINGMODE.nc"
    assert name(naming.member_name(e, m, s, some, no)) == "E_M_S_1850.nc"
    assert name(naming.combined_name(e, s, F.lit(2), none, no)) == "E_S_2members_.nc"
    assert naming.save_name("month_1", "tbrt") == "month_1_tbrt"
    assert naming.case_list_name("E") == "casenames_E.txt"
    assert naming.members_folder("/a/", "E") == "/a/E/INDIVIDUAL-FILES/"


def test_case_number(spark):
    df = spark.createDataFrame([("A.001",), ("7",)], "c STRING")
    assert [r[0] for r in df.select(text.case_number(F.col("c"))).collect()] == ["001", "7"]
