"""Checking SQL: what each query must return, written the long way for the checking database.

The statements join and repeat rows in full, use correlated subqueries, one scan per branch
and windows; the Spark queries reach the same rows by other plans.
"""

from __future__ import annotations

from ledgerline.starmart.mapping import view_sql


def _views(names: str) -> str:
    return ",\n".join(f'"{name}" AS ({view_sql(name)})' for name in names.split())


def _statement(views: str, final: str, **steps: str) -> str:
    parts = [_views(views)] if views else []
    parts += [f"{name} AS ({text})" for name, text in steps.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def _money(expression: str) -> str:
    return f"CAST(ROUND({expression}, 4) AS DOUBLE)"


def _number(expression: str) -> str:
    """A locale number; null is 0."""
    return f"CAST(REPLACE(REPLACE(COALESCE({expression}, '0'), '.', ''), ',', '.') AS DECIMAL(28,10))"


def _scaled(column: str, decimals: int = 4) -> str:
    """An amount as a whole number of its last decimal, so that ratios can be divided exactly."""
    return f"CAST({column} * {10 ** decimals} AS HUGEINT)"


def _unscaled(scaled_sum: str) -> str:
    """A sum in units of 10^-12, rounded half away from zero to four places."""
    return f"CAST(({scaled_sum} + SIGN({scaled_sum}) * 50000000) // 100000000 / 10000.0 AS DOUBLE)"


def _unscaled_exact(scaled_sum: str) -> str:
    return f"CAST(({scaled_sum}) AS DECIMAL(38,0)) * 0.000000000001"


def _brl(amount: str) -> str:
    return f"'R$ ' || TRANSLATE(FORMAT('{{:,.2f}}', CAST({amount} AS DOUBLE)), ',.', '.,')"


def _whole(amount: str) -> str:
    return f"FORMAT('{{:.0f}}', CAST({amount} AS DOUBLE))"


def _labels(code: str, labels: dict[int, str], default: str | None = None) -> str:
    cases = " ".join(f"WHEN {value} THEN '{label}'" for value, label in labels.items())
    return f"CASE {code} {cases}" + (f" ELSE '{default}'" if default else "") + " END"


# Net line value and line value after both discounts, in units of 10^-8 and 10^-14.
_SCALED_NET = f"({_scaled('quantity')} * {_scaled('unit_price')} - {_scaled('COALESCE(discount, 0)')} * 100)"
_SCALED_GOODS = (
    f"{_scaled('quantity')} * ({_scaled('unit_price')} * 100 - {_scaled('COALESCE(discount, 0)')})"
    f" * {_scaled('(100 - COALESCE(discount_pct, 0))')}"
)


def _freight(freight: str, total: str) -> str:
    """Net value times freight / 100 / (total + 0.001), in units of 10^-12."""
    return f"{_SCALED_NET} * {_scaled(freight)} * 100 // ({_scaled(total)} + 10)"


def _extra(value: str, freight: str, extra: str) -> str:
    """Goods / (value - freight + 0.001) times the extra freight, in units of 10^-12."""
    return f"{_SCALED_GOODS} * {_scaled(extra)} // (100 * ({_scaled(value)} - {_scaled(freight)} + 10))"


_TAXPAYER = _labels("taxpayer_code", {0: "CONTRIBUINTE", 1: "ISENTO", 2: "NÃO CONTRIBUINTE"}, "CONTRIBUINTE")
_DESTINATION = _labels("destination_code", {0: "INTERNA", 1: "INTERESTADUAL", 2: "OPERAÇÃO COM EXTERIOR"})
_COMPANY = _labels("company_id", {1: "first", 2: "second", 4: "fourth"})

_CODES = """
    SELECT MAX(attribute_type_id) FILTER (WHERE name ILIKE '%FRETE ESPECIAL%') AS freight,
           MAX(attribute_type_id) FILTER (WHERE name ILIKE '%VIA TRAFEGO?%') AS traffic,
           MAX(attribute_type_id) FILTER (WHERE name ILIKE '%CLIENTE PROSPECTADO?%') AS prospect
    FROM attribute_type"""

_NET = "(quantity * unit_price - COALESCE(discount, 0) / 100)"

_MAKERS = """
    SELECT p.product_id, p.sku, p.product_name, p.list_cost, p.cost, g.name AS product_group, m.name AS maker
    FROM product p JOIN product_group g ON g.group_id = p.group_id
    JOIN product_supplier ps ON ps.product_id = p.product_id AND ps.principal IS TRUE
    JOIN party m ON m.party_id = ps.party_id"""

_PLACES = """
    SELECT a.address_id, a.neighbourhood, c.name AS city, s.code AS state
    FROM address a LEFT JOIN city c ON c.city_id = a.city_id LEFT JOIN state s ON s.state_id = c.state_id"""

_ORDERS = """
    SELECT o.order_id, o.order_date, o.identifier AS order_identifier, p.name AS order_partner
    FROM "order" o LEFT JOIN party p ON p.party_id = o.partner_id"""

_SELLERS = """
    SELECT cs.customer_id, p.name AS seller
    FROM customer_seller cs LEFT JOIN party p ON p.party_id = cs.seller_id WHERE cs.principal IS TRUE"""

_BILLING_VIEWS = (
    "product product_group product_supplier party customer_tax customer_seller company document document_fiscal "
    "document_item document_exit document_sale sale sale_item sale_payment payment_document sale_total order_total "
    "order order_type attribute_type attribute_value address city state payment_form_sales payment_term"
)

_BILLING_STEPS = {"codes": _CODES, "makers": _MAKERS, "places": _PLACES, "partnered": _ORDERS, "sellers": _SELLERS}

# Columns shown by both datasets, from the grouped rows.
_SHOWN = f"""
    order_date, COALESCE(order_partner, order_type, 'VENDA DIRETA') AS partner, product_group, sku, product_name,
    company, {_money("goods_cost")} AS goods_cost, {_money("list_cost")} AS list_cost, CAST(1 AS BIGINT) AS orders,
    carrier, traffic_source, prospect_customer, state, city, neighbourhood, customer, maker, payment_form, payment_term,
    {_money("sale_document_total / 100")} AS sale_value, {_TAXPAYER} AS taxpayer_kind, seller, order_identifier,
    CAST(modified_at AS DATE) AS modified_at"""

_NAMES = """
    order_date, order_partner, order_type, product_group, sku, product_name, company, goods_cost, list_cost, carrier,
    traffic_source, prospect_customer, state, city, neighbourhood, customer, maker, payment_form, payment_term,
    sale_document_total, taxpayer_code, seller, order_identifier, modified_at"""

# Joins from a sale (alias v, possibly missing) that add names.
_SALE_JOINS = """
    LEFT JOIN sale_total vt ON vt.sale_id = v.sale_id
    LEFT JOIN partnered o ON o.order_id = v.order_id
    LEFT JOIN (SELECT * FROM order_type WHERE order_type_id = 100) ot ON ot.order_type_id = v.order_type_id
    LEFT JOIN payment_form_sales pf ON pf.payment_form_id = v.payment_form_id
    LEFT JOIN payment_term pt ON pt.payment_term_id = v.payment_term_id
    LEFT JOIN sellers se ON se.customer_id = v.customer_id
    CROSS JOIN codes
    LEFT JOIN attribute_value av_freight
           ON av_freight.sale_id = v.sale_id AND av_freight.attribute_type_id = codes.freight
    LEFT JOIN attribute_value av_traffic
           ON av_traffic.sale_id = v.sale_id AND av_traffic.attribute_type_id = codes.traffic
    LEFT JOIN attribute_value av_prospect
           ON av_prospect.sale_id = v.sale_id AND av_prospect.attribute_type_id = codes.prospect"""

_SALE_NAMES = """
    o.order_date, o.order_partner, ot.description AS order_type, pf.name AS payment_form, pt.name AS payment_term,
    vt.sale_document_total, se.seller, o.order_identifier, v.modified_at,
    av_traffic.value AS traffic_source, av_prospect.value AS prospect_customer"""


def _invoice_steps(start: str, recent: str, mark: str) -> dict[str, str]:
    invoiced = f"""
        SELECT d.issue_date, d.document_id, d.document_number, f.destination_code, i.product_id, i.item_id, i.quantity,
               i.unit_price, i.discount, i.item_freight, i.recipient_tax, m.sku, m.product_name, m.list_cost,
               m.product_group, m.maker, c.name AS customer, t.taxpayer_code, co.trade_name AS company, w.state, w.city,
               w.neighbourhood, ca.name AS carrier, si.goods_cost, si.item_expenses, pd.term_value, {_SALE_NAMES},
               (SELECT SUM(x.quantity) FROM document_item x
                WHERE x.document_id = i.document_id AND x.product_id = i.product_id) AS product_quantity
        FROM document_item i
        JOIN document d ON d.document_id = i.document_id
        JOIN document_fiscal f ON f.document_id = d.document_id
        JOIN document_exit e ON e.document_id = d.document_id
        JOIN makers m ON m.product_id = i.product_id
        JOIN party c ON c.party_id = d.customer_id
        JOIN customer_tax t ON t.customer_id = d.customer_id
        JOIN company co ON co.company_id = d.company_id
        JOIN places w ON w.address_id = d.address_id
        LEFT JOIN party ca ON ca.party_id = f.carrier_id
        LEFT JOIN sale_item si ON si.sale_item_id = i.sale_item_id
        LEFT JOIN document_sale ds ON ds.document_id = d.document_id
        LEFT JOIN sale v ON v.sale_id = ds.sale_id
        LEFT JOIN sale_payment sp ON sp.sale_id = v.sale_id
        LEFT JOIN payment_document pd ON pd.payment_document_id = sp.payment_document_id
        {_SALE_JOINS}
        WHERE d.issue_date >= {start} AND (d.issue_date >= {recent} OR v.modified_at >= {mark})
          AND i.unit_price > 0 AND d.status IN (10, 11)
          AND (f.operation_nature IN (15, 29, 30, 124, 685) OR f.operation_nature IS NULL)"""
    keys = f"""document_id, product_id, issue_date, document_number, quantity, unit_price, discount, item_freight,
               recipient_tax, destination_code, product_quantity, {_NAMES}"""
    lines = f"""
        SELECT issue_date AS billing_date, {_SHOWN}, {_money(_NET)} AS net_value,
               {_money(_NET + " / quantity")} AS unit_value,
               {_money("COALESCE(SUM(item_expenses / 100), 0)")} AS other_expenses,
               CAST(product_quantity AS BIGINT) AS sold_quantity, CAST(document_number AS VARCHAR) AS document_number,
               {_money("COALESCE(item_freight, 0) / 100")} AS freight, {_DESTINATION} AS destination,
               {_money("COALESCE(recipient_tax, 0) / 100")} AS tax_difference,
               {_money("COALESCE(SUM(term_value), 0) / 100")} AS term_value, COUNT(item_id) AS line_count
        FROM invoiced GROUP BY {keys}"""
    return {"invoiced": invoiced, "invoices": lines}


def _direct_steps(start: str, recent: str, mark: str) -> dict[str, str]:
    sold = f"""
        SELECT v.sale_id, v.sale_date, v.sale_freight, i.quantity, i.unit_price, i.discount, i.item_expenses,
               i.goods_cost, i.sale_item_id, m.sku, m.product_name, m.list_cost, m.product_group, m.maker,
               c.name AS customer, t.taxpayer_code, co.trade_name AS company, w.state, w.city, w.neighbourhood,
               ca.name AS carrier, {_SALE_NAMES}
        FROM sale v
        JOIN sale_item i ON i.sale_id = v.sale_id
        JOIN makers m ON m.product_id = i.product_id
        JOIN party c ON c.party_id = v.customer_id
        JOIN customer_tax t ON t.customer_id = v.customer_id
        JOIN company co ON co.company_id = v.company_id
        JOIN places w ON w.address_id = v.address_id
        LEFT JOIN party ca ON ca.party_id = v.carrier_id
        {_SALE_JOINS}
        LEFT JOIN order_total ort ON ort.order_id = o.order_id
        WHERE v.sale_date >= {start} AND (v.sale_date >= {recent} OR v.modified_at >= {mark})
          AND v.situation = 5 AND v.project_id = 67"""
    lines = f"""
        SELECT sale_date AS billing_date, {_SHOWN}, {_money(f"SUM({_NET})")} AS net_value,
               {_money(f"SUM({_NET} / quantity)")} AS unit_value,
               {_money("SUM(item_expenses / 100)")} AS other_expenses, CAST(NULL AS BIGINT) AS sold_quantity,
               CAST(sale_id AS VARCHAR) AS document_number, {_money("sale_freight / 100")} AS freight,
               CAST(NULL AS VARCHAR) AS destination, CAST(NULL AS DOUBLE) AS tax_difference,
               CAST(0 AS DOUBLE) AS term_value, COUNT(sale_item_id) AS line_count
        FROM sold GROUP BY sale_id, sale_date, sale_freight, {_NAMES}"""
    return {"sold": sold, "direct_sales": lines}


_FILLED = "goods_cost net_value unit_value freight list_cost other_expenses tax_difference".split()
_FILL = "* REPLACE (" + ", ".join(f"COALESCE({name}, 0) AS {name}" for name in _FILLED) + ")"
_UNION = f"""
    SELECT {_FILL} FROM (SELECT * FROM invoices UNION ALL BY NAME SELECT * FROM direct_sales)"""

_WHOLE = ("DATE '1995-01-01'", "DATE '2001-07-31'", "DATE '1996-01-01'")
_MARK = """(SELECT COALESCE(CAST(MAX(modified_at) AS DATE), DATE '2001-07-30') FROM sale
            WHERE situation = 5 AND project_id = 67)"""
_WINDOW = ("DATE '2001-06-02'", "DATE '2001-07-31'", _MARK)

# Dated to the first day of their year, for the reports of one day.
_YEARLY = {
    "document_of_year": "SELECT * REPLACE (CAST(DATE_TRUNC('year', issue_date) AS DATE) AS issue_date) FROM document",
    "sale_of_year": "SELECT * REPLACE (CAST(DATE_TRUNC('year', sale_date) AS DATE) AS sale_date) FROM sale",
}


def _of_year(steps: dict[str, str]) -> dict[str, str]:
    renamed = {}
    for name, text in steps.items():
        text = text.replace("JOIN document d ", "JOIN document_of_year d ").replace("sale v ", "sale_of_year v ")
        renamed[name] = text.replace("FROM sale v\n", "FROM sale_of_year v\n")
    return renamed


def _return_steps(share=_unscaled) -> dict[str, str]:
    """Return lines, one branch per project test; ``share`` rounds freight shares or leaves them."""
    branches = []
    for test in ("d.project_id IS NULL", "d.project_id <> 34"):
        branches.append(f"""
        SELECT d.issue_date, o.order_date,
               CASE WHEN f.intermediary_code = 0 THEN 'SEM INTERMEDIADOR' WHEN f.intermediary_code = 1 THEN im.name
                    ELSE 'SEM INDICATIVO DE INTERMEDIADOR INFORMADO' END AS partner,
               m.product_group, m.sku, m.product_name, {_money(f"SUM({_NET})")} AS net_value,
               {_money(f"SUM({_NET} / quantity)")} AS unit_value,
               {_money("COALESCE(f.document_expenses / 100, 0)")} AS other_expenses, {_money("m.cost")} AS goods_cost,
               {_money("m.list_cost")} AS list_cost, COUNT(1) AS orders, CAST(SUM(i.quantity) AS BIGINT) AS sold_quantity,
               d.document_number, ca.name AS carrier,
               {share(f"SUM({_freight('e.exit_freight', 'e.product_total')})")} AS freight,
               {share(f"SUM({_extra('f.document_value', 'e.exit_freight', _number('av.value'))})")} AS extra_freight,
               w.state, w.city, w.neighbourhood, c.name AS customer, m.maker, pf.name AS payment_form,
               pt.name AS payment_term, f.order_number AS order_identifier,
               {_COMPANY.replace("company_id", "d.company_id")} AS company
        FROM document_item i
        JOIN document_of_year d ON d.document_id = i.document_id
        JOIN document_fiscal f ON f.document_id = d.document_id
        JOIN document_exit e ON e.document_id = d.document_id
        JOIN makers m ON m.product_id = i.product_id
        JOIN party c ON c.party_id = d.customer_id
        JOIN places w ON w.address_id = d.address_id
        LEFT JOIN document_sale ds ON ds.document_id = d.document_id
        LEFT JOIN sale v ON v.sale_id = ds.sale_id
        LEFT JOIN "order" o ON o.order_id = v.order_id
        LEFT JOIN payment_form_returns pf ON pf.payment_form_id = v.payment_form_id
        LEFT JOIN payment_term pt ON pt.payment_term_id = v.payment_term_id
        LEFT JOIN party ca ON ca.party_id = f.carrier_id
        LEFT JOIN party im ON im.party_id = f.intermediary_id
        LEFT JOIN attribute_value av ON av.sale_id = v.sale_id AND av.attribute_type_id =
                  (SELECT MAX(attribute_type_id) FROM attribute_type WHERE name ILIKE '%FRETE%')
        WHERE d.issue_date = DATE '1997-01-01' AND i.unit_price > 0 AND d.status IN (10, 11) AND {test}
          AND f.operation_nature = 19
        GROUP BY d.issue_date, o.order_date, f.intermediary_code, im.name, m.product_group, m.sku, m.product_name,
                 f.document_expenses, m.cost, m.list_cost, d.document_number, ca.name, w.state, w.city, w.neighbourhood,
                 c.name, m.maker, pf.name, pt.name, f.order_number, d.company_id""")
    return {"returned": "\nUNION ALL\n".join(branches)}


_RETURN_VIEWS = (
    "product product_group product_supplier party document document_fiscal document_item document_exit document_sale "
    "sale order attribute_type attribute_value address city state payment_form_returns payment_term"
)

_POSITION = f"""
    SELECT b.sku, l.name AS location, b.product_name, f.name AS maker, g.name AS product_group,
           SUM(b.available_quantity) AS available_quantity, b.unit_cost AS unit_value,
           SUM(b.available_quantity * b.unit_cost) AS total_value
    FROM stock_by_product b
    JOIN product p ON p.product_id = b.product_id
    LEFT JOIN product_group g ON g.group_id = b.group_id
    JOIN stock_location l ON l.location_id = b.location_id
    JOIN product_supplier ps ON ps.product_id = p.product_id AND ps.principal IS TRUE
    JOIN party f ON f.party_id = ps.party_id
    WHERE p.is_product IS TRUE AND p.is_active IS TRUE AND b.location_id BETWEEN 0 AND 23
    GROUP BY l.name, b.sku, b.product_name, f.name, g.name, b.unit_cost"""
_STOCK_VIEWS = "stock_by_product product product_group stock_location product_supplier party"
_STOCK_STEPS = {"position": _POSITION}

_LOCATIONS = """
    SELECT n_nationkey AS position, 'K' || n_nationkey AS key, n_name AS location_name,
           CASE n_regionkey WHEN 0 THEN 'regular' WHEN 1 THEN 'fulfilment' WHEN 4 THEN NULL ELSE 'irregular' END AS bucket,
           CASE n_regionkey WHEN 0 THEN 'available' WHEN 1 THEN 'available' WHEN 4 THEN NULL ELSE 'irregular' END AS side
    FROM nation UNION ALL SELECT 25, 'K25', 'NOWHERE', 'regular', 'available'"""
_BY_LOCATION = """
    SELECT l.*, COALESCE((SELECT SUM(available_quantity) FROM position p WHERE p.location = l.location_name), 0) AS quantity,
           COALESCE((SELECT SUM(total_value) FROM position p WHERE p.location = l.location_name), 0) AS amount
    FROM locations l"""
_LOCATION_STEPS = {"position": _POSITION, "locations": _LOCATIONS, "by_location": _BY_LOCATION}

_ORDER_LINES = f"""
    SELECT o.order_id, o.order_date, COALESCE(p.name, 'VENDA MANUAL') AS channel,
           COALESCE(o.identifier, '') AS identifier, COALESCE(m.sku, 'S/ SKU') AS sku,
           COALESCE(m.product_name, 'PRODUTO NÃO IDENTIFICADO') AS product_name,
           {_money("COALESCE(i.quantity, 0)")} AS quantity, {_money("COALESCE(o.order_freight, 0) / 100.0")} AS freight,
           {_money("COALESCE(i.discount, 0) / 100.0")} AS discount,
           {_money("COALESCE(i.unit_price, 0) - COALESCE(i.discount, 0) / 100.0")} AS product_value,
           {_money('''COALESCE(i.unit_price, 0) * COALESCE(i.quantity, 0) - COALESCE(i.discount, 0) / 100.0
                      + COALESCE(o.order_freight, 0) / 100.0''')} AS final_value,
           COALESCE(l.name, 'ESTOQUE PADRÃO') AS stock_location, COALESCE(t.description, 'OUTROS') AS origin,
           COALESCE(o.situation, 0) AS situation
    FROM "order" o LEFT JOIN party p ON p.party_id = o.partner_id
    JOIN order_type t ON t.order_type_id = o.order_type_id
    JOIN order_item i ON i.order_id = o.order_id
    JOIN product m ON m.product_id = i.product_id
    JOIN stock_location l ON l.location_id = o.location_id
    WHERE o.order_date >= DATE '1995-01-01' AND o.situation IN (0, 2) AND o.location_id <> 20"""
_ORDER_VIEWS = "order order_type order_item product party stock_location"
_ORDER_REST = (
    "channel identifier product_name quantity freight discount product_value final_value stock_location origin situation"
).split()
_LATEST = f"""
    SELECT * EXCLUDE (place) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, sku ORDER BY order_date DESC,
           {", ".join(f"{name} DESC" for name in _ORDER_REST)}) AS place FROM order_lines) WHERE place = 1"""
_ORDER_TARGET = """
    SELECT * REPLACE (CASE WHEN channel = 'NATION_3' THEN quantity + 1 ELSE quantity END AS quantity,
                      CASE WHEN channel = 'NATION_4' THEN order_date - 1 ELSE order_date END AS order_date,
                      NULLIF(identifier, '') AS identifier),
           DATE '2001-01-01' AS created_at
    FROM latest WHERE order_date < DATE '2000-01-01'"""
_ORDER_CHANGES = f"""
    SELECT s.* FROM latest s LEFT JOIN order_target t ON t.order_id = s.order_id AND t.sku = s.sku
    WHERE t.order_id IS NULL OR COALESCE(s.identifier, '') <> COALESCE(t.identifier, '')
       OR {" OR ".join(f"s.{name} IS DISTINCT FROM t.{name}" for name in _ORDER_REST if name != "identifier")}"""
_DELTA_STEPS = {
    "order_lines": _ORDER_LINES, "latest": _LATEST, "order_target": _ORDER_TARGET, "order_changes": _ORDER_CHANGES,
}

_CODED = """
    SELECT l_orderkey, l_partkey, l_linenumber, NULLIF(l_linenumber, 7) AS code FROM lineitem"""

_PRICED = """
    SELECT i.*, f.document_value, v.discount_pct, v.sale_freight
    FROM document_item i LEFT JOIN document_fiscal f ON f.document_id = i.document_id
    LEFT JOIN sale v ON v.sale_id = i.document_id"""

_DATED = """
    SELECT CASE WHEN l_linenumber < 7 OR l_returnflag <> 'N' THEN l_orderkey END AS order_code, l_partkey, l_linenumber,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_shipdate AS DATE) AS ship_day FROM lineitem"""
_LOAD_STEPS = {
    "dated": _DATED,
    "target": "SELECT *, 'target' AS origin FROM dated WHERE ship_day < DATE '2001-06-01'",
    "batch": "SELECT *, 'batch' AS origin FROM dated WHERE ship_day >= DATE '2001-05-01'",
    "written": """SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b
                  WHERE b.order_code = t.order_code AND b.l_partkey = t.l_partkey)
                  UNION ALL SELECT * FROM batch""",
}
_PLAIN_PRICE = "* REPLACE (CAST(price AS DOUBLE) AS price)"

_ALERT_ITEMS = """
    SELECT COALESCE(l.name, 'Local Não Informado') AS location, b.product_name,
           COALESCE(SUM(b.available_quantity), 0) AS quantity
    FROM stock_by_product b LEFT JOIN stock_location l ON l.location_id = b.location_id
    WHERE b.product_name IN ('red plate', 'small widget', 'hot ring', 'hot plate', 'old rod')
      AND b.location_id IN (2, 5, 8, 11, 14, 17)
    GROUP BY b.product_name, l.name"""
_ALERT_VIEWS = "stock_by_product stock_location"


def _summary_lines() -> str:
    def pair(table: str, section: str, first: int, orders: str, total: str) -> str:
        return f"""
        SELECT {first} AS position, '{section}' AS section, 'orders' AS key, CAST(orders AS DOUBLE) AS quantity,
               CAST(NULL AS DOUBLE) AS amount, '{orders}: ' || {_whole("orders")} AS text FROM {table}
        UNION ALL
        SELECT {first + 1}, '{section}', 'total', NULL, {_money("COALESCE(total, 0)")},
               '{total}: ' || {_brl("COALESCE(total, 0)")}
        FROM {table}"""

    def stock(label: str) -> str:
        return f"""{label} || ': ' || {_whole("quantity")} || ' unidades | ' || {_brl("amount / 100")}"""

    return f"""
        SELECT CAST(position AS INTEGER) AS position, section, key, quantity, amount, text,
               '01/01/1997' AS report_day
        FROM (
        {pair("billed_day", "billing", 0, "Pedidos faturados", "Valor total bruto")}
        UNION ALL
        {pair("returned_day", "returns", 2, "Pedidos devolvidos", "Valor total devolvido")}
        UNION ALL
        SELECT 4 + 2 * position, bucket, key, {_money("quantity")}, {_money("amount")}, {stock("key")}
        FROM by_location WHERE side IS NOT NULL
        UNION ALL
        SELECT 4 + 2 * last + 1, side, 'total', {_money("quantity")}, {_money("amount")},
               {stock("CASE side WHEN 'available' THEN 'Total Regular + Fulfillment' ELSE 'Total em Irregularidades' END")}
        FROM (SELECT side, MAX(position) AS last, SUM(quantity) AS quantity, SUM(amount) AS amount
              FROM by_location WHERE side IS NOT NULL GROUP BY side))"""


_BILLED_DAY = """
    SELECT COUNT(DISTINCT document_number) AS orders,
           SUM(CAST(net_value AS DECIMAL(28,4)) + CAST(freight AS DECIMAL(28,4)) + CAST(other_expenses AS DECIMAL(28,4)))
               AS total
    FROM billed WHERE billing_date = DATE '1997-01-01'"""
_RETURNED_DAY = """
    SELECT COUNT(DISTINCT document_number) AS orders, SUM(CAST(net_value AS DECIMAL(26,4)) + freight) AS total
    FROM returned WHERE issue_date = DATE '1997-01-01'"""
_BILLING_OF_YEAR = {
    **_BILLING_STEPS, **_YEARLY, **_of_year(_invoice_steps(*_WHOLE)), **_of_year(_direct_steps(*_WHOLE)),
    "billed": _UNION, "billed_day": _BILLED_DAY,
}
_RETURN_PARTS = {"document_of_year": _YEARLY["document_of_year"], "makers": _MAKERS, "places": _PLACES}
_RETURNS_OF_YEAR = {**_RETURN_PARTS, **_return_steps()}
_RETURNED_TOTAL = {**_RETURN_PARTS, **_return_steps(_unscaled_exact), "returned_day": _RETURNED_DAY}

_ACCOUNT = "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) END"
_CENTS = "CASE WHEN o_orderstatus <> 'P' THEN CAST(ROUND(o_totalprice * 100) AS DECIMAL(18,4)) END"


# Whether a row's month is one that the batch falls in or takes rows from.
_TOUCHED = """COALESCE(CAST(DATE_TRUNC('month', {row}.ship_day) AS DATE), DATE '0001-01-01') IN (
    SELECT COALESCE(CAST(DATE_TRUNC('month', ship_day) AS DATE), DATE '0001-01-01') FROM batch
    UNION ALL SELECT COALESCE(CAST(DATE_TRUNC('month', t.ship_day) AS DATE), DATE '0001-01-01') FROM target t
    WHERE EXISTS (SELECT 1 FROM batch b WHERE b.order_code = t.order_code AND b.l_partkey = t.l_partkey))"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["scan_param_window"] = """
        SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS order_day, l_quantity AS quantity
        FROM lineitem, orders WHERE o_orderkey = l_orderkey AND o_orderdate >= DATE '2001-08-01' - 60"""
    sql["target_window"] = """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate
        FROM orders WHERE o_orderdate >= DATE '2001-08-01' - 60"""
    sql["high_water_mark"] = _statement("sale", f"SELECT CAST({_MARK} AS DATE) AS mark")
    sql["high_water_mark_fallback"] = _statement(
        "sale", f"SELECT CAST({_MARK.replace('project_id = 67', 'project_id = -1')} AS DATE) AS mark"
    )

    sql["incremental_lines"] = """
        SELECT o_orderkey, l_linenumber, CAST(o_orderdate AS DATE) AS order_day, CAST(modified AS DATE) AS modified
        FROM orders LEFT JOIN (SELECT l_orderkey, l_linenumber,
                                      CASE WHEN l_returnflag <> 'N' THEN l_shipdate END AS modified FROM lineitem)
             ON l_orderkey = o_orderkey
        WHERE o_orderdate >= DATE '2001-06-02' AND (o_orderdate >= DATE '2001-07-31' OR modified >= DATE '2001-08-01')"""
    sql["filter_in_list"] = f"SELECT * FROM ({_CODED}) WHERE code IN (1, 3, 7)"
    sql["filter_in_dimension"] = """
        SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
        WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""
    sql["filter_in_or_null"] = f"SELECT * FROM ({_CODED}) WHERE code IN (1, 3) OR code IS NULL"
    sql["filter_not_equal"] = f"SELECT * FROM ({_CODED}) WHERE code <> 3"
    sql["filter_flag_true"] = _statement(
        "product", "SELECT product_id, sku FROM product WHERE is_product IS TRUE AND is_active IS TRUE"
    )

    sql["attribute_codes"] = _statement("attribute_type", "SELECT * FROM codes", codes=_CODES)
    sql["attribute_lookup"] = _statement(
        "sale attribute_type attribute_value",
        """SELECT s.sale_id, f.value AS freight, t.value AS traffic, p.value AS prospect
           FROM sale s CROSS JOIN codes
           LEFT JOIN attribute_value f ON f.sale_id = s.sale_id AND f.attribute_type_id = codes.freight
           LEFT JOIN attribute_value t ON t.sale_id = s.sale_id AND t.attribute_type_id = codes.traffic
           LEFT JOIN attribute_value p ON p.sale_id = s.sale_id AND p.attribute_type_id = codes.prospect""",
        codes=_CODES,
    )

    sql["fields_in_one_scan"] = _statement(
        "attribute_type attribute_value",
        """SELECT s.sale_id, t.value AS traffic, p.value AS prospect, t.n AS traffic_n, p.n AS prospect_n,
                  f.n AS freight_rows, CAST(NULL AS BIGINT) AS unknown_rows
           FROM (SELECT DISTINCT sale_id FROM attribute_value CROSS JOIN codes
                 WHERE attribute_type_id IN (codes.freight, codes.traffic, codes.prospect)) s
           LEFT JOIN (SELECT sale_id, value, COUNT(*) AS n FROM attribute_value CROSS JOIN codes
                      WHERE attribute_type_id = codes.traffic GROUP BY 1, 2) t ON t.sale_id = s.sale_id
           LEFT JOIN (SELECT sale_id, value, COUNT(*) AS n FROM attribute_value CROSS JOIN codes
                      WHERE attribute_type_id = codes.prospect GROUP BY 1, 2) p ON p.sale_id = s.sale_id
           LEFT JOIN (SELECT sale_id, COUNT(*) AS n FROM attribute_value CROSS JOIN codes
                      WHERE attribute_type_id = codes.freight GROUP BY 1) f ON f.sale_id = s.sale_id""",
        codes=_CODES,
    )
    sql["window_items"] = _statement(
        "document document_item",
        f"""SELECT document_id, COUNT(*) AS items, CAST(SUM(quantity) AS DOUBLE) AS quantity FROM document_item
           WHERE document_id IN (SELECT document_id FROM document WHERE issue_date >= {_WINDOW[0]})
           GROUP BY document_id""",
    )

    sql["bucketed_window_items"] = sql["window_items"]
    sql["equal_depth_splits"] = _statement(
        "document_item",
        "SELECT sale_item_id, CAST(1 AS BIGINT) AS splits, COUNT(*) AS row_count FROM document_item GROUP BY sale_item_id",
    )

    sql["invoice_lines"] = _statement(
        _BILLING_VIEWS, "SELECT * FROM invoices", **_BILLING_STEPS, **_invoice_steps(*_WHOLE)
    )
    sql["direct_sale_lines"] = _statement(
        _BILLING_VIEWS, "SELECT * FROM direct_sales", **_BILLING_STEPS, **_direct_steps(*_WHOLE)
    )
    sql["billing_union"] = _statement(
        _BILLING_VIEWS, _UNION, **_BILLING_STEPS, **_invoice_steps(*_WINDOW), **_direct_steps(*_WINDOW)
    )
    sql["returns_lines"] = _statement(_RETURN_VIEWS, "SELECT * FROM returned", **_RETURNS_OF_YEAR)
    sql["snapshot_stock"] = _statement(
        _STOCK_VIEWS,
        f"""SELECT * REPLACE ({_money("available_quantity")} AS available_quantity, {_money("unit_value")} AS unit_value,
                              {_money("total_value")} AS total_value), DATE '2001-08-02' AS created_on FROM position""",
        **_STOCK_STEPS,
    )
    sql["order_lines"] = _statement(_ORDER_VIEWS, "SELECT * FROM order_lines", order_lines=_ORDER_LINES)

    sql["net_values"] = _statement(
        "document_item",
        f"""SELECT item_id, product_id, {_money(_NET)} AS net_value, {_money(_NET + " / quantity")} AS unit_value
            FROM document_item""",
    )
    sql["freight_proration"] = _statement(
        "document_item document_fiscal sale",
        f"""SELECT document_id, {_unscaled(f"SUM({_freight('COALESCE(sale_freight, 0)', 'document_value')})")} AS freight
            FROM priced GROUP BY document_id""",
        priced=_PRICED,
    )
    extra = _extra("document_value", "COALESCE(sale_freight, 0)", "1234.56")
    sql["extra_freight"] = _statement(
        "document_item document_fiscal sale",
        f"SELECT document_id, {_unscaled(f'SUM({extra})')} AS extra_freight FROM priced GROUP BY document_id",
        priced=_PRICED,
    )
    sql["parse_locale_decimal"] = _statement(
        "attribute_type attribute_value",
        f"""SELECT sale_id, value, {_money(_number("value"))} AS number FROM attribute_value
            WHERE attribute_type_id = (SELECT MAX(attribute_type_id) FROM attribute_type WHERE name ILIKE '%FRETE%')""",
    )
    sql["parse_locale_decimal_lenient"] = _statement(
        "attribute_value",
        f"""SELECT sale_id, attribute_type_id, {_money(_number("value").replace("CAST(", "TRY_CAST(", 1))} AS number
            FROM attribute_value""",
    )
    sql["coerce_numeric"] = """
        SELECT p_partkey, CAST(COALESCE(TRY_CAST(p_brand AS DECIMAL(28,10)), 0) AS DOUBLE) AS p_brand,
               CAST(p_size AS DOUBLE) AS size,
               CASE p_type WHEN 'ECONOMY' THEN 12.5 WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN 0 WHEN 'PROMO' THEN 0
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) END AS price
        FROM part"""
    sql["cents_to_units"] = f"""
        SELECT o_orderkey, {_money(f"COALESCE({_CENTS}, 0) / 100")} AS units, {_money(f"({_CENTS}) / 100")} AS units_or_null
        FROM orders"""
    sql["code_labels"] = _statement(
        "document document_fiscal customer_tax party",
        f"""SELECT d.document_id, {_TAXPAYER} AS taxpayer_kind, {_DESTINATION} AS destination, {_COMPANY} AS company,
                   CASE f.intermediary_code WHEN 0 THEN 'none' WHEN 1 THEN p.name ELSE 'not stated' END AS partner
            FROM document d JOIN document_fiscal f ON f.document_id = d.document_id
            JOIN customer_tax t ON t.customer_id = d.customer_id
            LEFT JOIN party p ON p.party_id = f.intermediary_id""",
    )
    sql["format_brl"] = f"""
        SELECT o_orderkey, {_brl(f"COALESCE({_ACCOUNT}, 0)")} AS from_units, {_brl("o_totalprice")} AS from_cents,
               {_whole(f"COALESCE({_ACCOUNT}, 0)")} AS rounded,
               CAST(CAST(TRUNC(CAST(COALESCE({_ACCOUNT}, 0) AS DOUBLE)) AS BIGINT) AS VARCHAR) || ' UND' AS whole,
               STRFTIME(o_orderdate, '%d/%m/%Y') AS day
        FROM orders"""
    sql["count_variants"] = f"""
        SELECT o_orderpriority, COUNT(code) AS codes, COUNT(*) AS line_count, COUNT(DISTINCT l_partkey) AS products,
               CAST(SUM(COALESCE(code, 0)) AS BIGINT) AS sum_of_filled, CAST(COALESCE(SUM(code), 0) AS BIGINT) AS filled_sum
        FROM ({_CODED}) JOIN orders ON o_orderkey = l_orderkey GROUP BY o_orderpriority"""

    sql["total_qty_per_item"] = _statement(
        "document_item",
        f"""SELECT item_id, document_id, product_id, {_money("quantity")} AS quantity,
                   (SELECT CAST(SUM(x.quantity) AS BIGINT) FROM document_item x
                    WHERE x.document_id = i.document_id AND x.product_id = i.product_id) AS total
            FROM document_item i""",
    )
    sql["role_playing_dims"] = f"""
        SELECT a.n_name AS customer_place, b.n_name AS supplier_place, COUNT(*) AS line_count,
               {_money("SUM(CAST(l_quantity AS DECIMAL(18,2)))")} AS quantity
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN supplier ON s_suppkey = l_suppkey JOIN nation a ON a.n_nationkey = c_nationkey
        JOIN nation b ON b.n_nationkey = s_nationkey GROUP BY 1, 2"""
    sql["conditional_label_join"] = _statement(
        "sale order_type",
        """SELECT s.sale_id, s.order_type_id, t.description AS order_type FROM sale s
           LEFT JOIN order_type t ON t.order_type_id = s.order_type_id AND t.order_type_id = 100""",
    )
    sql["composite_key_join"] = _statement(
        "document_item sale_item",
        f"""SELECT i.document_id, i.sale_item_id, i.product_id, {_money("i.quantity")} AS quantity,
                   {_money("s.goods_cost")} AS goods_cost
            FROM document_item i LEFT JOIN sale_item s ON s.sale_id = i.document_id AND s.sale_item_id = i.sale_item_id""",
    )
    sql["main_supplier_join"] = _statement(
        "product product_group product_supplier party", "SELECT product_id, sku, product_group, maker FROM makers",
        makers=_MAKERS,
    )
    sql["existence_join"] = _statement(
        "document document_exit",
        """SELECT d.document_id, d.document_number, COUNT(*) AS exits
           FROM document d JOIN document_exit e ON e.document_id = d.document_id GROUP BY 1, 2""",
    )
    sql["existence_semi_join"] = """
        SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
    sql["outer_then_inner"] = _statement(
        "product product_supplier party",
        """SELECT p.product_id, p.sku, s.party_id, m.name AS maker FROM product p
           LEFT JOIN product_supplier s ON s.product_id = p.product_id AND s.principal IS TRUE
           JOIN party m ON m.party_id = s.party_id""",
    )
    sql["payment_fanout"] = _statement(
        "sale_item sale_payment payment_document sale",
        f"""SELECT i.sale_id, {_money("SUM(COALESCE(i.item_expenses, 0))")} AS expenses,
                   COUNT(i.sale_item_id) AS line_count, {_money("COALESCE(SUM(d.term_value), 0)")} AS terms
            FROM sale_item i
            LEFT JOIN sale v ON v.sale_id = i.sale_id
            LEFT JOIN sale_payment p ON p.sale_id = v.sale_id
            LEFT JOIN payment_document d ON d.payment_document_id = p.payment_document_id
            GROUP BY i.sale_id""",
    )

    sql["replace_by_key"] = _statement("", f"SELECT {_PLAIN_PRICE} FROM written", **_LOAD_STEPS)
    sql["replace_by_key_null_safe"] = _statement(
        "",
        f"""SELECT {_PLAIN_PRICE} FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b
              WHERE b.order_code IS NOT DISTINCT FROM t.order_code AND b.l_partkey IS NOT DISTINCT FROM t.l_partkey)
            UNION ALL SELECT {_PLAIN_PRICE} FROM batch""",
        **_LOAD_STEPS,
    )
    sql["replace_by_typed_key"] = sql["replace_by_key"]
    sql["empty_batch_noop"] = _statement("", f"SELECT {_PLAIN_PRICE} FROM target", **_LOAD_STEPS)
    sql["lower_case_names"] = "SELECT p_partkey, p_name, p_size FROM part"
    sql["project_allowlist"] = f"""
        SELECT p_name, CAST(p_partkey AS INTEGER) AS p_partkey, {_money("p_retailprice")} AS p_retailprice,
               CAST(p_size AS BIGINT) AS p_size FROM part"""
    sql["delta_empty_target"] = _statement(_ORDER_VIEWS, "SELECT * FROM latest", **_DELTA_STEPS)
    sql["delta_detect"] = _statement(_ORDER_VIEWS, "SELECT * FROM order_changes", **_DELTA_STEPS)
    sql["delta_detect_digests"] = sql["delta_detect"]
    sql["delta_upsert"] = _statement(
        _ORDER_VIEWS,
        """SELECT * FROM order_target t WHERE NOT EXISTS (SELECT 1 FROM order_changes c
             WHERE c.order_id = t.order_id AND c.sku = t.sku)
           UNION ALL BY NAME
           SELECT c.*, COALESCE(t.created_at, DATE '2001-08-01') AS created_at
           FROM order_changes c LEFT JOIN order_target t ON t.order_id = c.order_id AND t.sku = c.sku""",
        **_DELTA_STEPS,
    )
    sql["written_replace"] = sql["replace_by_key"]
    sql["written_upsert"] = sql["delta_upsert"]
    sql["written_snapshot"] = sql["snapshot_stock"]
    sql["last_line_per_key"] = _statement(
        "",
        f"""SELECT {_PLAIN_PRICE} FROM dated WHERE order_code IS NULL UNION ALL
            SELECT {_PLAIN_PRICE} FROM (SELECT * EXCLUDE (place) FROM (SELECT *, ROW_NUMBER() OVER (
                PARTITION BY order_code, l_partkey ORDER BY ship_day DESC, l_linenumber DESC, price DESC) AS place
                FROM dated WHERE order_code IS NOT NULL) WHERE place = 1)""",
        dated=_DATED,
    )
    sql["load_metrics"] = _statement(
        "",
        """SELECT 'target' AS load, COUNT(*) AS row_count FROM target
           UNION ALL SELECT 'batch', COUNT(*) FROM batch UNION ALL SELECT 'written', COUNT(*) FROM written""",
        **_LOAD_STEPS,
    )

    sql["written_counts"] = _statement(
        "",
        """SELECT kind, (SELECT COUNT(*) FROM written) AS rows_after, CAST(row_count AS BIGINT) AS row_count FROM (
             SELECT 'loaded' AS kind, COUNT(*) AS row_count FROM batch
             UNION ALL SELECT 'inserted', 0 UNION ALL SELECT 'updated', 0
             UNION ALL SELECT 'removed', (SELECT COUNT(*) FROM target) + (SELECT COUNT(*) FROM batch) - (SELECT COUNT(*) FROM written)
             UNION ALL SELECT 'kept', COUNT(*) - (SELECT COUNT(*) FROM batch b2 WHERE """ + _TOUCHED.format(row="b2") + """)
                        FROM written w WHERE """ + _TOUCHED.format(row="w") + """)""",
        **_LOAD_STEPS,
    )

    sql["daily_billing_summary"] = _statement(
        _BILLING_VIEWS, f"SELECT orders, {_money('total')} AS total FROM billed_day", **_BILLING_OF_YEAR
    )
    sql["daily_billing_states"] = sql["daily_billing_summary"]
    sql["daily_returns_summary"] = _statement(
        _RETURN_VIEWS,
        f"SELECT orders, {_money('total')} AS total FROM returned_day",
        **_RETURNED_TOTAL,
    )
    sql["stock_by_location"] = _statement(
        _STOCK_VIEWS,
        f"""SELECT * REPLACE ({_money("quantity")} AS quantity, {_money("amount")} AS amount) FROM by_location""",
        **_LOCATION_STEPS,
    )
    sql["stock_bucket_totals"] = _statement(
        _STOCK_VIEWS,
        f"""SELECT side, bucket, position, key, {_money("quantity")} AS quantity, {_money("amount")} AS amount,
                   FALSE AS is_total FROM by_location WHERE side IS NOT NULL
            UNION ALL
            SELECT side, NULL, NULL, NULL, {_money("SUM(quantity)")}, {_money("SUM(amount)")}, TRUE
            FROM by_location WHERE side IS NOT NULL GROUP BY side""",
        **_LOCATION_STEPS,
    )
    return_views = [name for name in _RETURN_VIEWS.split() if name not in _BILLING_VIEWS.split()]
    stock_views = [name for name in _STOCK_VIEWS.split() if name not in _BILLING_VIEWS.split()]
    sql["daily_summary_lines"] = _statement(
        " ".join([_BILLING_VIEWS, *return_views, *stock_views]),
        _summary_lines(),
        **{**_BILLING_OF_YEAR, **_RETURNED_TOTAL, **_LOCATION_STEPS},
    )

    sql["daily_report_headings"] = _statement(
        "",
        """SELECT 0 AS position, 0 AS level, 'orders' AS section, '✅ RESUMO DIÁRIO DOS PEDIDOS - 01/01/1997' AS text
           UNION ALL SELECT 0, 1, 'billing', 'FATURAMENTO:' UNION ALL SELECT 2, 1, 'returns', 'DEVOLUÇÕES:'
           UNION ALL SELECT 4, 0, 'stock', '✅ RESUMO DIÁRIO DO ESTOQUE - 01/01/1997'
           UNION ALL SELECT CAST(4 + 2 * MIN(position) AS INTEGER), 1, bucket,
               CASE bucket WHEN 'regular' THEN 'ESTOQUE REGULAR:' WHEN 'fulfilment' THEN 'ESTOQUE FULFILLMENT:'
                    ELSE 'ESTOQUE DE PENDENCIAS, AVARIADOS, TRANSFERÊNCIA E OUTLET:' END
           FROM locations WHERE side IS NOT NULL GROUP BY bucket""",
        locations=_LOCATIONS,
    )
    sql["stock_alert_items"] = _statement(
        _ALERT_VIEWS,
        f"""SELECT location, product_name, {_money("quantity")} AS quantity,
                   CAST(CAST(quantity AS BIGINT) AS VARCHAR) || ' UND' AS quantity_text,
                   CASE WHEN quantity <= 150 THEN 'CRÍTICO' ELSE 'OK' END AS status,
                   CASE WHEN quantity <= 150 THEN 'critical' WHEN quantity <= 250 THEN 'low' ELSE 'normal' END AS level,
                   CASE WHEN quantity <= 150 THEN '#d32f2f' WHEN quantity <= 250 THEN '#f57c00' ELSE '#333' END
                       AS quantity_colour,
                   CASE WHEN quantity <= 150 THEN '#ffebee' ELSE '#e8f5e9' END AS badge_background,
                   CASE WHEN quantity <= 150 THEN '#c62828' ELSE '#2e7d32' END AS badge_colour
            FROM items""",
        items=_ALERT_ITEMS,
    )
    sql["stock_alert_groups"] = _statement(
        _ALERT_VIEWS,
        """SELECT location, CASE location WHEN 'NATION_2' THEN '#1e88e5' WHEN 'NATION_5' THEN '#43a047'
                  ELSE '#555555' END AS colour, product_name, quantity
           FROM items""",
        items=_ALERT_ITEMS,
    )
    sql["stock_alert_header"] = _statement(
        _ALERT_VIEWS,
        """SELECT COUNT(*) AS item_count, COUNT(*) FILTER (WHERE quantity <= 150) AS critical_count,
                  BOOL_OR(quantity <= 150) AS has_critical,
                  CASE WHEN BOOL_OR(quantity <= 150) THEN '⚠️ ALERTA: Estoque Crítico Identificado'
                       ELSE 'Relatório Semanal de Estoque' END AS headline,
                  '01/08/2001 09:05:07' AS created
           FROM items HAVING COUNT(*) > 0""",
        items=_ALERT_ITEMS,
    )
    return sql
