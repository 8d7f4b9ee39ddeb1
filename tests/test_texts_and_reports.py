from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import RUN
from pyspark.sql import functions as F

from ledgerline import fixed_values as fv
from ledgerline.functions import money, texts
from ledgerline.plans import alert, summary
from ledgerline.plans.jobs import alert_job


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("units", "text"),
    [(1234567.891, "R$ 1.234.567,89"), (None, "R$ 0,00"), (-1234.5, "R$ -1.234,50"), (0.125, "R$ 0,12")],
)
def test_currency_text(spark, units, text):
    assert value(spark, texts.format_brl(F.lit(units).cast("double"))) == text


def test_currency_text_from_cents(spark):
    assert value(spark, texts.format_brl_cents(F.lit(123456))) == "R$ 1.234,56"


def test_quantity_texts(spark):
    assert value(spark, texts.format_quantity(F.lit(12345.5))) == "12346"
    assert value(spark, texts.format_quantity(F.lit(2.5))) == "2"
    assert value(spark, texts.format_units(F.lit(7.9), "UND")) == "7 UND"
    assert value(spark, texts.format_moment(F.lit(datetime(2024, 3, 5, 6, 7, 8)))) == "05/03/2024 06:07:08"


def test_locale_number(spark):
    assert value(spark, texts.parse_locale_decimal(F.lit("1.234,56"))) == Decimal("1234.56")
    assert value(spark, texts.parse_locale_decimal(F.lit(None).cast("string"))) == 0
    assert value(spark, texts.parse_locale_decimal(F.lit("abc"), strict=False)) is None
    with pytest.raises(Exception, match="locale number"):
        value(spark, texts.parse_locale_decimal(F.lit("abc")))


def test_cents_divide_exactly(spark):
    assert value(spark, money.cents_to_units(F.lit(199))) == Decimal("1.99")
    assert value(spark, money.in_units(F.lit(None).cast("int"))) is None


def test_repeated_amounts_keep_their_decimals(spark):
    amount = F.lit(Decimal("0.12345678")).cast(money.AMOUNT)
    assert value(spark, money.repeated(amount, F.lit(3).cast("bigint"))) == Decimal("0.37037034")
    # More repeats than decimal(10,0) holds, as a sale with very many payments has.
    assert value(spark, money.repeated(F.lit(Decimal("1.5")).cast(money.AMOUNT), F.lit(10**12))) == 15 * 10**11
    assert value(spark, money.repeated(F.lit(None).cast(money.AMOUNT), F.lit(2).cast("bigint"))) is None


def test_whole_quantity_rounds_half_away_from_zero(spark):
    assert value(spark, money.rounded_count(F.lit(Decimal("2.5")))) == 3
    assert value(spark, money.rounded_count(F.lit(Decimal("-2.5")))) == -3


BILLING = (
    "document_number string, billing_date date, net_value decimal(18,2), freight decimal(18,2),"
    " other_expenses decimal(18,2)"
)
RETURNS = "document_number bigint, issue_date date, net_value decimal(18,2), freight decimal(18,2)"
STOCK = "location string, available_quantity decimal(18,2), total_value decimal(18,2)"


def report(spark, billed, returned, held):
    lines = summary.summary_lines(
        spark.createDataFrame(billed, BILLING),
        spark.createDataFrame(returned, RETURNS),
        spark.createDataFrame(held, STOCK),
        summary.report_locations(spark),
        RUN,
    )
    return lines.orderBy("position").collect()


def test_summary_lines(spark):
    d = Decimal
    lines = report(
        spark,
        [("1", RUN, d(10), d(1), d(2)), ("1", RUN, d(20), d(0), d(0)), ("2", RUN, d(5), None, d(0)),
         ("3", date(2024, 3, 14), d(99), d(0), d(0))],
        [(7, RUN, d("1234.5"), d("0.5"))],
        [("CD RJ - JD OLIMPO", d(3), d(123456)), ("CD SP - MELI (FULFILLMENT)", d(2), d(100)),
         ("OUTLET ES", d(4), d(50)), ("CD RJ - JO USADOS", d(9), d(900)), ("unknown", d(8), d(800))],
    )
    text = [line.text for line in lines]
    assert text[:4] == [
        "Pedidos faturados: 2", "Valor total bruto: R$ 33,00", "Pedidos devolvidos: 1",
        "Valor total devolvido: R$ 1.235,00",
    ]
    assert text[4] == "CD_RJ: 3 unidades | R$ 1.234,56"
    assert text[5] == "CD_ES: 0 unidades | R$ 0,00"
    assert text[11] == "Total Regular + Fulfillment: 5 unidades | R$ 1.235,56"
    assert text[-2:] == ["OUTLET_ES: 4 unidades | R$ 0,50", "Total em Irregularidades: 4 unidades | R$ 0,50"]
    assert len(text) == 4 + 22 + 2
    assert [line.section for line in lines[4:12]] == ["regular"] * 5 + ["fulfilment"] * 2 + ["available"]
    assert {line.report_day for line in lines} == {"15/03/2024"}


def test_summary_of_nothing(spark):
    text = [line.text for line in report(spark, [], [], [])]
    assert text[:2] == ["Pedidos faturados: 0", "Valor total bruto: R$ 0,00"]
    assert text[-1] == "Total em Irregularidades: 0 unidades | R$ 0,00"


def test_bucket_lines_sum_to_their_total(spark):
    held = [(row[1], Decimal(at), Decimal(at * 100)) for at, row in enumerate(fv.REPORT_LOCATIONS)]
    by_location = summary.stock_by_location(spark.createDataFrame(held, STOCK), summary.report_locations(spark))
    totals = summary.stock_bucket_totals(by_location).collect()
    for side in ("available", "irregular"):
        lines = [row.quantity for row in totals if row.side == side and not row.is_total]
        assert sum(lines) == [row.quantity for row in totals if row.side == side and row.is_total][0]


def alert_rows(rows, quantities, location=34):
    held = rows["stock_by_product"][0]
    rows["stock_by_product"] = [
        held | {"product_id": 23006, "product_name": f"P{at}", "available_quantity": quantity, "location_id": location}
        for at, quantity in enumerate(quantities)
    ]
    return rows


def test_alert_levels(retail, rows):
    items = alert.alert_items(retail(alert_rows(rows, [None, 3, 4, 5, 6]))).orderBy("product_name").collect()
    assert [item.level for item in items] == ["critical", "critical", "low", "low", "normal"]
    assert [item.status for item in items] == ["CRÍTICO", "CRÍTICO", "OK", "OK", "OK"]
    assert [item.quantity_text for item in items][:2] == ["0 UND", "3 UND"]
    assert [item.quantity_colour for item in items][2:] == ["#f57c00", "#f57c00", "#333"]
    assert items[0].badge_background == "#ffebee" and items[4].badge_colour == "#2e7d32"


def test_alert_sums_over_companies_and_ignores_other_products(retail, rows):
    alert_rows(rows, [1, 2])
    for held in rows["stock_by_product"]:
        held["product_name"] = "P"
    rows["stock_by_product"].append(rows["stock_by_product"][0] | {"product_id": 5})
    item, = alert.alert_items(retail(rows)).collect()
    assert item.quantity == 3


def test_alert_groups_and_header(spark, retail, rows):
    alert_rows(rows, [4, 9])
    rows["stock_by_product"].append(rows["stock_by_product"][0] | {"location_id": 265})
    items, groups, header = alert_job(spark, retail(rows), datetime(2024, 3, 15, 18))
    found = sorted((group.location, group.product_name, group.colour) for group in groups.collect())
    assert [row for row in found if row[0] == "CD RJ - JD OLIMPO"] == [
        ("CD RJ - JD OLIMPO", "P0", "#1e88e5"), ("CD RJ - JD OLIMPO", "P1", "#1e88e5"),
    ]
    assert {row[2] for row in found if row[0] == "Local Não Informado"} == {"#555555"}
    line = header.first()
    assert (line.headline, line.has_critical, line.item_count) == ("Relatório Semanal de Estoque", False, 3)
    assert line.created == "15/03/2024 18:00:00"


def test_alert_critical_headline_and_nothing_to_report(retail, rows):
    header = alert.alert_header(alert.alert_items(retail(alert_rows(rows, [1]))))
    assert header.first().headline == "⚠️ ALERTA: Estoque Crítico Identificado"
    assert alert.alert_header(alert.alert_items(retail({}))).count() == 0


def test_long_watch_list(retail, rows):
    found = alert.alert_items(retail(alert_rows(rows, [1])), products=range(22_500, 23_501))
    assert [row.quantity for row in found.collect()] == [1]


def test_repeats_keep_their_decimals_for_any_count(spark):
    amount = F.lit(Decimal("0.12345678")).cast(money.AMOUNT)
    for count in (10**10 - 1, 10**10 + 1, 10**12):
        assert value(spark, money.repeated(amount, F.lit(count))) == Decimal("0.12345678") * count


def test_fixed_lists():
    assert len(fv.REPORT_LOCATIONS) == 24 and len(fv.STOCK_LOCATIONS) == 24
    buckets = [row[2] for row in fv.REPORT_LOCATIONS]
    assert [buckets.count(name) for name in ("regular", "fulfilment", "irregular", None)] == [5, 2, 15, 2]
    assert [len(columns) for columns in (fv.BILLING_COLUMNS, fv.RETURN_COLUMNS, fv.STOCK_COLUMNS, fv.ORDER_COLUMNS)] == [
        33, 26, 8, 14,
    ]
