"""Golden rows for every rule ladder and insurer class (FIXTURES.md section 3)."""

from decimal import Decimal

import pytest

from ledgerline.operators import ladders as L

MOTOR_SCHEMA = "Product_updated int, ODTerm int, TPTerm int, BookingMode string, Motor_bt string, netpr double"

MOTOR_CASES = [
    # (product, od, tp, mode, bt, factor)
    (188, 1, 1, "Online", "New", 1), (188, 1, 1, "Offline", "Renewal", .9),
    (186, 1, 3, "Online", "New", 1),  # rule 3 beats rule 6
    (186, 1, 3, "Offline", "New", .9), (186, 1, 3, "Offline", "Renewal", .8),
    (186, 1, 1, "Online", "New", 1.2), (186, 1, 1, "Online", "Renewal", 1),
    (186, 1, 1, "Offline", "New", .9), (186, 1, 1, "Offline", "Renewal", .8),
    (186, 0, 1, "Online", "New", 1), (186, 0, 1, "Offline", "New", .5),
    (187, 1, 5, "Online", "New", 1), (187, 1, 5, "Offline", "New", .8),
    (187, 1, 1, "Online", "New", 1.1), (187, 1, 1, "Online", "Renewal", 1), (187, 1, 1, "Offline", "New", 0),
    (187, 0, 1, "Online", "New", 1), (187, 0, 1, "Offline", "New", 0),
    (186, 1, 1, "Online", None, 1), (186, None, 1, "Online", "New", 1), (186, 1, 1, None, "New", 1),
    (187, 1, 1, "offline", "New", 0),  # collation: mode compared case-insensitively
]


@pytest.mark.parametrize("tw_tp_offline,expected_18", [("0", 0), ("1", 1)])
def test_motor_ladder(spark, tw_tp_offline, expected_18):
    rows = [(p, od, tp, m, bt, 1000.0) for p, od, tp, m, bt, _ in MOTOR_CASES]
    df = spark.createDataFrame(rows, MOTOR_SCHEMA)
    out = df.select(L.compile_ladder(L.motor_rules(tw_tp_offline), "netpr").alias("x")).collect()
    expected = [f for *_, f in MOTOR_CASES]
    expected[17] = expected_18  # rule 18 is the variant rule
    assert [round(r.x, 6) for r in out] == [round(1000.0 * f, 6) for f in expected]


HF_CASES = [
    # (product, bt, sum insured, factor)
    (130, "New", None, Decimal("1.25")),
    (190, "New", 1000000, Decimal("1.25")), (190, "New", 999999, Decimal(".75")),
    (190, "New", 500000, Decimal(".75")), (190, "New", 499999, Decimal(0)),
    (190, "Port", 1000000, Decimal(".5")), (190, "Port", 999999, Decimal(0)), (190, "Port", 499999, Decimal(0)),
    (190, "New", None, Decimal(1)), (190, None, 600000, Decimal(1)), (106, "Port", 100, Decimal(1)),
]


def test_health_fresh_ladder(spark):
    df = spark.createDataFrame(
        [(p, bt, si, Decimal("1000.0000")) for p, bt, si, _ in HF_CASES],
        "Product_updated int, Health_bt string, SumInsured int, netpr decimal(18,4)")
    out = df.select(L.compile_ladder(L.health_fresh_rules(), "netpr").alias("x")).collect()
    assert [r.x for r in out] == [Decimal(1000) * f for *_, f in HF_CASES]


def test_life_ladder(spark):
    cases = [("single pay", "Term", 3, 0), ("Annual", "ULIP", None, 0), ("Annual", "Term", 3, .5),
             ("Annual", "Term", 5, 1), ("Annual", "Term", None, 1), (None, None, None, 1)]
    df = spark.createDataFrame([(a, b, c, Decimal("1000.0000")) for a, b, c, _ in cases],
                               "PaymentPeriodicity string, PayoutProdCat string, PayTerm int, netpr decimal(18,4)")
    out = df.select(L.compile_ladder(L.life_rules(), "netpr").alias("x")).collect()
    assert [float(r.x) for r in out] == [1000.0 * f for *_, f in cases]


def test_sme_ladder(spark):
    cases = [("Group Gratuity Plan", .1), ("Employee group cover", .25), ("Fire", 1.25), (None, 1),
             ("group gratuity plan  ", .1)]
    df = spark.createDataFrame([(p, Decimal("1000.0000")) for p, _ in cases], "PlanName string, netpr decimal(18,4)")
    out = df.select(L.compile_ladder(L.sme_rules(), "netpr").alias("x")).collect()
    assert [float(r.x) for r in out] == [1000.0 * f for _, f in cases]


def test_insurer_classes(spark):
    names = ["united india", "IFFCO General", None, "National Insurance Co", "Acme"]
    df = spark.createDataFrame([(n,) for n in names], "`Insurer Name` string")
    motor = [r.c for r in df.select(L.classify(L.MOTOR_INSURER_CLASSES, L.OTHERS).alias("c")).collect()]
    assert motor == ["PSU", "Pvt", "Others_pvt", "PSU", "Others_pvt"]
    life_names = ["LIC India", "SBI Cover", "BAJAJ Cover", "Acme", None, "lic india "]
    df = spark.createDataFrame([(n,) for n in life_names], "`Insurer Name` string")
    life = [r.c for r in df.select(L.classify(L.LIFE_INSURER_CLASSES, L.OTHERS).alias("c")).collect()]
    assert life == ["PSU", "PSU", "Pvt", "Others_pvt", "Others_pvt", "PSU"]


def test_ladder_is_one_case_expression(spark):
    df = spark.createDataFrame([(186, 1, 1, "Online", "New", 1.0)], MOTOR_SCHEMA)
    plan = df.select(L.compile_ladder(L.motor_rules(), "netpr").alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan and "PythonUDF" not in plan
