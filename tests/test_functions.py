import pytest
from pyspark.sql import functions as F

from funnelspark.functions import formula as fm
from funnelspark.functions import values as fv


@pytest.mark.parametrize(
    ("text", "counts"),
    [("Sm2Fe17", {"Sm": 2, "Fe": 17}), ("Fe-Co", {"Fe": 1, "Co": 1}), ("Sm(Fe2Co)3", {"Sm": 1, "Fe": 6, "Co": 3}), ("Fe Fe2", {"Fe": 3}), ("(Al(OH)3)2", {"Al": 2, "O": 6, "H": 6})],
)
def test_parse(text, counts):
    assert fm.parse_text(text) == counts


@pytest.mark.parametrize(("text", "message"), [("Xx2", "position 0"), ("Fe(", "unclosed"), ("Fe)", "unmatched"), ("", "no element"), ("Fe?", "position 2")])
def test_parse_refuses(text, message):
    with pytest.raises(ValueError, match=message):
        fm.parse_text(text)


def test_flat_equals_nested(spark):
    df = spark.createDataFrame([("Fe4Sm34",), ("SmFe12",), ("FeCoFe2",), ("Zz",), (None,), ("Fe-Co_B2",)], "t string")
    rows = df.select("t", fm.parse_flat(F.col("t")).alias("a"), fm.parse_nested("t")["counts"].alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_identity_and_subsystems(spark):
    r = spark.createDataFrame([("Fe4Sm34",)], "t string").select(fm.identity(fm.parse_flat(F.col("t"))).alias("i"), fm.subsystems(F.array(*map(F.lit, ["B", "Fe", "Sm"]))).alias("s")).first()
    assert (r.i.formula, r.i.z, r.i.chemsys, r.i.n_atoms) == ("Fe2Sm17", 2, "Fe-Sm", 38)
    assert sorted(r.s) == ["B", "B-Fe", "B-Fe-Sm", "B-Sm", "Fe", "Fe-Sm", "Sm"]


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(k) for k, c in columns.items())).first()


def test_scalars(spark):
    r = one(
        spark,
        half=F.bround(F.lit(2.5)),
        batches=fv.split_batches(F.lit(108), 100),
        none=fv.split_batches(F.lit(0), 100),
        ranges=fv.chunks(F.lit(5).cast("long"), 2),
        long=fv.seconds(F.lit("1-02:03:04")),
        short=fv.seconds(F.lit("03:04")),
        bare=fv.seconds(F.lit("90"), bare=60),
        bad=fv.seconds(F.lit("soon")),
        mb=fv.megabytes(F.lit("2G")),
        tasks=fv.array_range(F.lit("[0-2,7%2]")),
        code=fv.exit_code(F.lit("125:9")),
        last=fv.last_match(F.lit("E=1 E=2 E=3"), r"E=(\d)"),
        lacking=fv.last_match(F.lit("nothing"), r"E=(\d)"),
        drift=fv.drift(F.lit(0.0), F.lit(1.0)),
        bands=F.array(*(fv.band(F.lit(x)) for x in (0.0, 0.06, 0.1, 5.0))),
        rule=fv.rule_for(F.array(F.lit("oom"), F.lit("scf")), [("timeout", "a"), ("scf", "b"), ("oom", "c")]),
        json=fv.json_field(F.lit("{bad"), "$.k", "long"),
    )
    assert r.half == 2 and r.batches == [54, 54] and r.none == []
    assert [(x.start, x.end) for x in r.ranges] == [(0, 1), (2, 3), (4, 4)]
    assert (r.long, r.short, r.bare, r.bad, r.mb) == (93784.0, 184.0, 5400.0, None, 2048.0)
    assert r.tasks == [0, 1, 2, 7] and (r.code.code, r.code.signal) == (125, 9)
    assert (r.last, r.lacking, r.drift, r.bands, r.rule, r.json) == ("3", None, None, [0, 1, 2, 3], "b", None)
