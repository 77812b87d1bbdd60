"""Scalar expressions on the literal edge-case rows (FIXTURES section 3)."""
import datetime as dt

from pyspark.sql import functions as F

from faultline.functions import (fault_type, nonneg_round, parse_ticket_time, sla_target,
                                 to_double_or, translate_month_es)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_translate_month(spark):
    got = one_col(spark, ["12/may/26 3:45 PM", "02/SEP/26 15:45", "junk", None], translate_month_es)
    # substring match, as in the source: 'junk' contains 'jun'
    assert got == ["12/May/26 3:45 pm", "02/Sep/26 15:45", "Junk", None]


def test_translate_first_month_in_map_order(spark):
    # both 'dic' and 'ene' occur: 'ene' comes first in the map, only it is replaced
    assert one_col(spark, ["dic ene"], translate_month_es) == ["dic Jan"]


def test_parse_ticket_time(spark):
    got = one_col(spark, ["12/may/26 3:45 PM", "02/sep/26 15:45", "junk", None],
                  lambda c: parse_ticket_time(c).cast("timestamp_ntz"))
    assert got == [dt.datetime(2026, 5, 12, 15, 45), dt.datetime(2026, 9, 2, 15, 45), None, None]


def test_fault_type(spark):
    long = "x/" + "y" * 40
    got = one_col(spark, ["A/B/ corte fibra ", "sin barra", None, long], fault_type)
    assert got == ["CORTE FIBRA", "SIN BARRA", "DESCONOCIDO", "Y" * 30]


def test_users_coerce(spark):
    got = one_col(spark, ["12", "1,2", "", None], lambda c: to_double_or(c, 1.0))
    assert got == [12.0, 1.0, 1.0, 1.0]


def test_sla_target(spark):
    got = one_col(spark, [" no cumple ", "CUMPLE", "NO CUMPLE"], sla_target)
    assert got == [1, 0, 1]


def test_half_even_nonnegative_rounding(spark):
    got = one_col(spark, [0.5, 1.5, 2.5, -0.4], nonneg_round, "double")
    assert got == [0, 2, 2, 0]
