from __future__ import annotations

from dataclasses import replace
from datetime import timedelta
from decimal import Decimal

import pytest
from conftest import RUN

from ledgerline.params import Codes, RunParams
from ledgerline.plans.orders import order_delta, order_lines, updated_orders
from ledgerline.plans.returns import return_lines
from ledgerline.plans.stock import stock, stock_position

PARAMS = RunParams(RUN, codes=Codes(company_labels={3: "Main"}))


def returned(retail, rows, params=PARAMS):
    for fiscal in rows["document_fiscal"]:
        fiscal["operation_nature"] = 19
    return return_lines(retail(rows), params).collect()


def test_return_amounts(retail, rows):
    line, = returned(retail, rows)
    assert (line.net_value, line.unit_value, line.other_expenses) == (Decimal("18.5"), Decimal("9.25"), 3)
    assert float(line.freight) == pytest.approx(18.5 * (4 / 20.001))
    # The discount is per unit here: 2 * (10 - 1.50) * 100 / (100 - 400 + 0.001) * 12.3456 * 100
    assert float(line.extra_freight) == pytest.approx(17 * 100 / (100 - 400 + 0.001) * (1234.56 / 100) * 100)
    assert (line.partner, line.payment_form, line.company, line.order_identifier) == ("Broker", "Refund", "Main", "N-1")
    assert (line.orders, line.sold_quantity, line.document_number) == (1, 2, 1000)


def test_return_projects(retail, rows):
    document, fiscal = rows["document"][0], rows["document_fiscal"][0]
    item, leaving = rows["document_item"][0], rows["document_exit"][0]
    for number, project in ((101, 34), (102, 7)):
        rows["document"].append(document | {"document_id": number, "document_number": number, "project_id": project})
        rows["document_fiscal"].append(fiscal | {"document_id": number})
        rows["document_item"].append(item | {"document_id": number})
        rows["document_exit"].append(leaving | {"document_id": number})
    assert sorted(line.document_number for line in returned(retail, rows)) == [102, 1000]


def test_with_and_without_project_are_not_summed_together(retail, rows):
    document, fiscal = rows["document"][0], rows["document_fiscal"][0]
    rows["document"].append(document | {"document_id": 101, "project_id": 7})
    rows["document_fiscal"].append(fiscal | {"document_id": 101})
    rows["document_item"].append(rows["document_item"][0] | {"document_id": 101})
    rows["document_exit"].append(rows["document_exit"][0] | {"document_id": 101})
    rows["document_sale"].append({"document_id": 101, "sale_id": 200})
    assert [line.net_value for line in returned(retail, rows)] == [Decimal("18.5")] * 2


def test_freight_fields_repeat_the_line_but_share_their_sum(retail, rows):
    rows["attribute_value"].append({"sale_id": 200, "attribute_type_id": 1, "value": None})
    line, = returned(retail, rows)
    assert (line.net_value, line.orders, line.sold_quantity) == (37, 2, 4)
    assert float(line.extra_freight) == pytest.approx(17 * 100 / (100 - 400 + 0.001) * (1234.56 / 100) * 100)


@pytest.mark.parametrize(
    ("code", "label"),
    [(0, "SEM INTERMEDIADOR"), (1, "Broker"), (None, "SEM INDICATIVO DE INTERMEDIADOR INFORMADO")],
)
def test_intermediary(retail, rows, code, label):
    rows["document_fiscal"][0]["intermediary_code"] = code
    assert [line.partner for line in returned(retail, rows)] == [label]


def test_bad_freight_text_raises(retail, rows):
    rows["attribute_value"][0]["value"] = "abc"
    with pytest.raises(Exception, match="locale number"):
        returned(retail, rows)


def test_returns_are_of_the_run_date_only(retail, rows):
    assert returned(retail, rows, replace(PARAMS, run_date=RUN + timedelta(days=1))) == []


def test_stock_position(retail, rows):
    held = rows["stock_by_product"][0]
    rows["stock_by_product"] += [
        held | {"company_id": 4, "available_quantity": 2},
        held | {"unit_cost": 2000},
        held | {"location_id": 35},
    ]
    rows["stock_location"].append({"location_id": 35, "name": "elsewhere"})
    found = {line.unit_value: line for line in stock_position(retail(rows), PARAMS).collect()}
    assert {cost: (line.available_quantity, line.total_value) for cost, line in found.items()} == {
        Decimal(1050): (6, 6300), Decimal(2000): (4, 8000),
    }


def test_stock_flags_and_fill(retail, rows):
    rows["stock_by_product"][0]["available_quantity"] = None
    line, = stock(retail(rows), PARAMS).collect()
    assert (line.available_quantity, line.total_value) == (0, 0)
    rows["product"][0]["is_active"] = None
    assert stock(retail(rows), PARAMS).count() == 0


def test_order_amounts(retail, rows):
    line, = order_lines(retail(rows), PARAMS).collect()
    assert (line.product_value, line.final_value) == (8, 33)
    assert (line.freight, line.discount, line.quantity) == (5, 2, 3)
    assert (line.channel, line.origin, line.stock_location) == ("Partner", "Marketplace", "CD RJ - JD OLIMPO")


def test_order_defaults(retail, rows):
    rows["order"][0] |= {"partner_id": None, "identifier": None, "order_freight": None}
    rows["order_item"][0] |= {"quantity": None, "unit_price": None, "discount": None}
    rows["product"][0] |= {"sku": None, "product_name": None}
    rows["stock_location"][0]["name"] = None
    rows["order_type"][0]["description"] = None
    line, = order_lines(retail(rows), PARAMS).collect()
    assert (line.channel, line.identifier, line.sku) == ("VENDA MANUAL", "", "S/ SKU")
    assert (line.product_name, line.stock_location, line.origin) == ("PRODUTO NÃO IDENTIFICADO", "ESTOQUE PADRÃO", "OUTROS")
    assert (line.quantity, line.final_value) == (0, 0)


@pytest.mark.parametrize(
    "change", [{"situation": 5}, {"location_id": 463}, {"location_id": None}, {"order_date": RUN - timedelta(days=3)}]
)
def test_order_filters(retail, rows, change):
    rows["order"][0] |= change
    rows["stock_location"].append({"location_id": 463, "name": "excluded"})
    assert order_lines(retail(rows), PARAMS).count() == 0


def test_second_run_finds_nothing(retail, rows):
    rows["order_item"].append(rows["order_item"][0] | {"quantity": 9})
    source = order_lines(retail(rows), PARAMS)
    target = updated_orders(source.limit(0), order_delta(source, source.limit(0), PARAMS))
    assert target.count() == 1
    assert order_delta(source, target, PARAMS).count() == 0


def test_two_exits_repeat_the_line_and_add_their_rates(retail, rows):
    rows["document_exit"].append({"document_id": 100, "exit_freight": 100, "product_total": 10})
    line, = returned(retail, rows)
    assert (line.net_value, line.orders, line.sold_quantity) == (37, 2, 4)
    assert float(line.freight) == pytest.approx(18.5 * (4 / 20.001 + 1 / 10.001))
    per_goods = 1 / (100 - 400 + 0.001) + 1 / (100 - 100 + 0.001)
    assert float(line.extra_freight) == pytest.approx(17 * 100 * per_goods * (1234.56 / 100) * 100)
