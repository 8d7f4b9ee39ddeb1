from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import RUN

from ledgerline.params import Codes, RunParams
from ledgerline.plans.billing import billing, direct_sale_lines, invoice_lines
from ledgerline.sources.marks import high_water_mark

PARAMS = RunParams(RUN, codes=Codes(sale_freight_pattern="%FRETE ESPECIAL%"))
MARK = date(2024, 3, 1)


def invoices(retail, rows, params=PARAMS, mark=MARK):
    return invoice_lines(retail(rows), params, mark).collect()


def test_discount_applies_to_the_line_in_cents(retail, rows):
    line, = invoices(retail, rows)
    assert (line.net_value, line.unit_value) == (Decimal("18.5"), Decimal("9.25"))
    assert line.freight == Decimal("2.5")
    assert line.tax_difference == Decimal("0.4")
    assert (line.other_expenses, line.term_value, line.line_count) == (1, Decimal("18.5"), 1)
    assert (line.partner, line.maker, line.seller, line.carrier) == ("Partner", "Maker", "Seller", "Carrier")
    assert (line.state, line.city, line.neighbourhood) == ("RJ", "Town", "Centre")
    assert (line.taxpayer_kind, line.destination) == ("NÃO CONTRIBUINTE", "INTERNA")
    assert (line.traffic_source, line.prospect_customer) == ("yes", None)
    assert (line.payment_form, line.payment_term, line.company) == ("Card", "30 days", "Company")
    assert (line.document_number, line.order_identifier, line.orders) == ("1000", "ID-300", 1)


def test_null_discount_and_unpriced_line(retail, rows):
    item = rows["document_item"][0]
    rows["document_item"] = [item | {"discount": None}, item | {"item_id": 2, "unit_price": 0, "quantity": 7}]
    line, = invoices(retail, rows)
    assert line.net_value == 20
    # The unpriced line is dropped but its quantity belongs to the product's total.
    assert line.sold_quantity == 9


def test_equal_lines_become_one_row(retail, rows):
    item = rows["document_item"][0] | {"quantity": 1}
    rows["document_item"] = [item, item | {"item_id": 2}]
    line, = invoices(retail, rows)
    assert (line.sold_quantity, line.line_count) == (2, 2)
    rows["document_item"][1]["unit_price"] = 11
    assert [line.sold_quantity for line in invoices(retail, rows)] == [2, 2]


def test_null_and_zero_discount_stay_apart(retail, rows):
    item = rows["document_item"][0]
    rows["document_item"] = [item | {"discount": None}, item | {"item_id": 2, "discount": 0}]
    assert [line.net_value for line in invoices(retail, rows)] == [20, 20]


def test_two_payments_repeat_expenses_and_count(retail, rows):
    rows["sale_payment"].append({"sale_id": 200, "payment_document_id": 2})
    rows["payment_document"].append({"payment_document_id": 2, "term_value": 50})
    line, = invoices(retail, rows)
    assert (line.other_expenses, line.line_count, line.term_value) == (2, 2, 19)


def test_every_unused_join_repeats_the_line(retail, rows):
    rows["document_exit"].append({"document_id": 100, "exit_freight": 1, "product_total": 1})
    rows["attribute_value"].append({"sale_id": 200, "attribute_type_id": 1, "value": "x"})
    rows["payment_document"].append({"payment_document_id": 1, "term_value": 50})
    line, = invoices(retail, rows)
    assert line.line_count == 2 * 2 * 2
    assert line.other_expenses == 8
    assert line.term_value == 4 * 19


def test_equal_field_values_repeat_and_different_ones_split_the_line(retail, rows):
    rows["attribute_value"] += [
        {"sale_id": 200, "attribute_type_id": 2, "value": value} for value in ("yes", "no", None)
    ]
    lines = {line.traffic_source: line.line_count for line in invoices(retail, rows)}
    assert lines == {"yes": 2, "no": 1, None: 1}


def test_document_without_exit_is_dropped(retail, rows):
    rows["document_exit"] = []
    assert invoices(retail, rows) == []


def test_old_document_without_sale_is_dropped_and_a_recent_one_kept(retail, rows):
    rows["document_sale"] = []
    rows["document"][0]["issue_date"] = RUN - timedelta(days=10)
    assert invoices(retail, rows) == []
    rows["document"][0]["issue_date"] = RUN - timedelta(days=1)
    line, = invoices(retail, rows)
    assert (line.order_identifier, line.partner) == (None, "VENDA DIRETA")


def test_old_document_counts_when_its_sale_changed_since_the_mark(retail, rows):
    rows["document"][0]["issue_date"] = RUN - timedelta(days=10)
    assert len(invoices(retail, rows)) == 1
    assert invoices(retail, rows, mark=date(2024, 3, 15)) == []
    rows["document"][0]["issue_date"] = RUN - timedelta(days=61)
    assert invoices(retail, rows) == []


def test_sale_that_does_not_exist_has_no_payments_or_fields(retail, rows):
    rows["sale"] = []
    rows["sale_payment"].append({"sale_id": 200, "payment_document_id": 1})
    line, = invoices(retail, rows)
    assert (line.line_count, line.traffic_source, line.sale_value) == (1, None, None)


def test_natures_and_status(retail, rows):
    rows["document_fiscal"][0]["operation_nature"] = None
    assert len(invoices(retail, rows)) == 1
    rows["document_fiscal"][0]["operation_nature"] = 19
    assert invoices(retail, rows) == []
    rows["document_fiscal"][0]["operation_nature"] = 685
    rows["document"][0]["status"] = 12
    assert invoices(retail, rows) == []


def test_attribute_type_missing_keeps_the_line(retail, rows):
    rows["attribute_type"] = [{"attribute_type_id": 2, "name": "via trafego"}]
    line, = invoices(retail, rows)
    assert line.traffic_source is None


def test_highest_matching_attribute_type_wins(retail, rows):
    rows["attribute_type"].append({"attribute_type_id": 9, "name": "nova VIA TRAFEGO? (2)"})
    rows["attribute_value"].append({"sale_id": 200, "attribute_type_id": 9, "value": "new"})
    assert [line.traffic_source for line in invoices(retail, rows)] == ["new"]


def test_two_principal_suppliers_give_two_lines(retail, rows):
    rows["product_supplier"][1]["principal"] = True
    assert sorted(line.maker for line in invoices(retail, rows)) == ["Maker", "Other"]


def test_other_order_type_is_not_labelled(retail, rows):
    rows["order"][0]["partner_id"] = None
    assert [line.partner for line in invoices(retail, rows)] == ["Marketplace"]
    rows["sale"][0]["order_type_id"] = 101
    rows["order_type"].append({"order_type_id": 101, "description": "Shop"})
    assert [line.partner for line in invoices(retail, rows)] == ["VENDA DIRETA"]


def test_zero_quantity_raises(retail, rows):
    rows["document_item"][0]["quantity"] = 0
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|Division by zero"):
        invoices(retail, rows)


def test_direct_sale_sums_lines_and_repeats_the_freight(retail, rows):
    item = rows["sale_item"][0]
    rows["sale_item"].append(item | {"sale_item_id": 501, "quantity": 4, "discount": None, "item_expenses": None})
    line, = direct_sale_lines(retail(rows), PARAMS, MARK).collect()
    assert (line.net_value, line.unit_value) == (Decimal("58.5"), Decimal("19.25"))
    assert (line.freight, line.other_expenses, line.line_count) == (9, 1, 2)
    assert (line.document_number, line.sold_quantity, line.destination) == ("200", None, None)


def test_direct_sale_repeats_for_order_totals_and_freight_fields(retail, rows):
    rows["order_total"].append({"order_id": 300})
    rows["attribute_value"].append({"sale_id": 200, "attribute_type_id": 1, "value": "x"})
    line, = direct_sale_lines(retail(rows), PARAMS, MARK).collect()
    assert (line.net_value, line.line_count) == (4 * Decimal("18.5"), 4)
    rows["order"] = []
    line, = direct_sale_lines(retail(rows), PARAMS, MARK).collect()
    assert line.line_count == 2


def test_direct_sale_needs_situation_and_project(retail, rows):
    rows["sale"][0]["project_id"] = None
    assert direct_sale_lines(retail(rows), PARAMS, MARK).count() == 0


def test_without_a_freight_pattern_the_field_repeats_nothing(retail, rows):
    rows["attribute_value"].append({"sale_id": 200, "attribute_type_id": 1, "value": "x"})
    line, = invoices(retail, rows, params=replace(PARAMS, codes=Codes()))
    assert line.line_count == 1


def test_billing_fills_numbers_and_keeps_both_kinds(retail, rows):
    rows["sale"][0]["sale_freight"] = None
    lines = {line.document_number: line for line in billing(retail(rows), PARAMS).collect()}
    assert set(lines) == {"1000", "200"}
    assert (lines["200"].freight, lines["200"].tax_difference) == (0, 0)


def test_mark_is_the_day_of_the_last_change_or_the_fallback(retail, rows):
    rows["sale"].append(rows["sale"][0] | {"sale_id": 201, "modified_at": datetime(2024, 3, 20), "project_id": 1})
    assert high_water_mark(retail(rows)["sale"], PARAMS).collect()[0].mark == date(2024, 3, 14)
    assert high_water_mark(retail({})["sale"], PARAMS).collect()[0].mark == RUN - timedelta(days=2)
