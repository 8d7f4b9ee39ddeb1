"""Values the results depend on, stated as data.

FIXED VALUES. Codes, labels, patterns, key lists and display texts of the source
system and of its reports. They are the defaults of ``params.Codes`` and of the
report functions; every one of them can be replaced by the caller.
Names of the business itself (company labels, the freight attribute of its own
delivery service) are not stated here: they are arguments.
"""

from __future__ import annotations

from decimal import Decimal

# --- document, sale and order codes -----------------------------------------
DOCUMENT_STATUS = (10, 11)
INVOICE_NATURES = (15, 29, 30, 124, 685)
RETURN_NATURE = 19
RETURN_EXCLUDED_PROJECT = 34
SALE_SITUATION = 5
SALE_PROJECT = 67
LABELLED_ORDER_TYPE = 100
ORDER_SITUATIONS = (0, 2)
ORDER_EXCLUDED_LOCATION = 463

# --- windows in days ----------------------------------------------------------
BILLING_DAYS = 60
RECENT_DAYS = 1
ORDER_DAYS = 2
MARK_FALLBACK_DAYS = 2

# --- amounts ------------------------------------------------------------------
CENTS = Decimal(100)
RATIO_EPSILON = Decimal("0.001")

# --- extra-field patterns (case-insensitive; "?" is an ordinary character) -----
RETURN_FREIGHT_PATTERN = "%FRETE%"
TRAFFIC_PATTERN = "%VIA TRAFEGO?%"
PROSPECT_PATTERN = "%CLIENTE PROSPECTADO?%"

# --- code labels ----------------------------------------------------------------
TAXPAYER_LABELS = {0: "CONTRIBUINTE", 1: "ISENTO", 2: "NÃO CONTRIBUINTE"}
TAXPAYER_DEFAULT = "CONTRIBUINTE"
DESTINATION_LABELS = {0: "INTERNA", 1: "INTERESTADUAL", 2: "OPERAÇÃO COM EXTERIOR"}
NO_INTERMEDIARY = "SEM INTERMEDIADOR"
UNKNOWN_INTERMEDIARY = "SEM INDICATIVO DE INTERMEDIADOR INFORMADO"
DIRECT_SALE_PARTNER = "VENDA DIRETA"

# --- default texts of an order line ----------------------------------------------
ORDER_CHANNEL_DEFAULT = "VENDA MANUAL"
ORDER_IDENTIFIER_DEFAULT = ""
ORDER_SKU_DEFAULT = "S/ SKU"
ORDER_PRODUCT_DEFAULT = "PRODUTO NÃO IDENTIFICADO"
ORDER_LOCATION_DEFAULT = "ESTOQUE PADRÃO"
ORDER_ORIGIN_DEFAULT = "OUTROS"

# --- stock locations of the snapshot ------------------------------------------------
STOCK_LOCATIONS = (
    34, 67, 133, 166, 199, 265, 299, 300, 331, 397, 463, 498,
    499, 500, 501, 502, 503, 504, 506, 507, 510, 511, 512, 513,
)

# --- report locations: key, location name, bucket, side --------------------------------
# Listed bucket by bucket in report order; the last two are in no report line.
REPORT_LOCATIONS = (
    ("CD_RJ", "CD RJ - JD OLIMPO", "regular", "available"),
    ("CD_ES", "CD ES - MERCOCAMP", "regular", "available"),
    ("CD_MG", "CD MG - ORMIFRIO", "regular", "available"),
    ("LOJA_XEREM", "LOJA XERÉM - CD RJ", "regular", "available"),
    ("LOJA_XEREM_ES", "LOJA XERÉM - CD ES", "regular", "available"),
    ("CD_SP_MELI", "CD SP - MELI (FULFILLMENT)", "fulfilment", "available"),
    ("CD_SP_MAGALU", "CD SP - MAGALU (FULFILLMENT)", "fulfilment", "available"),
    ("CD_RJ_PENDENCIA", "CD RJ - JO PENDENCIA", "irregular", "irregular"),
    ("CD_ES_PENDENCIA", "CD ES - MC PENDENCIA", "irregular", "irregular"),
    ("CD_RJ_AVARIA", "CD RJ - JO AVARIA", "irregular", "irregular"),
    ("CD_ES_AVARIA", "CD ES - MC AVARIAS", "irregular", "irregular"),
    ("CD_ES_JO_AVARIA", "CD ES - JD OLIMPO AVARIA", "irregular", "irregular"),
    ("CD_ES_DEFEITO", "CD ES - MC DEFEITO", "irregular", "irregular"),
    ("CD_RJ_DEFEITO", "CD RJ - JO DEFEITO", "irregular", "irregular"),
    ("CD_RJ_PECAS", "CD RJ - JO PEÇAS", "irregular", "irregular"),
    ("EM_MANUTENCAO", "EM MANUTENÇÃO (FABRICANTE)", "irregular", "irregular"),
    ("EM_RECEBIMENTO", "EM RECEBIMENTO (SEPARAÇÃO)", "irregular", "irregular"),
    ("SEPARACAO_LOJA_XEREM", "CD SEPARAÇÃO - LOJA XEREM", "irregular", "irregular"),
    ("CD_FULL_SEPARACAO", "CD FULL - MELI RJ SEPARAÇÃO", "irregular", "irregular"),
    ("CD_FULL_RETORNOS", "CD FULL - MELI RJ RETORNO", "irregular", "irregular"),
    ("OUTLET_RJ", "OUTLET RJ", "irregular", "irregular"),
    ("OUTLET_ES", "OUTLET ES", "irregular", "irregular"),
    ("CD_RJ_USADOS", "CD RJ - JO USADOS", None, None),
    ("CD_ES_JD_OLIMPO", "CD ES - JD OLIMPO", None, None),
)

# --- stock alert -----------------------------------------------------------------------------
WATCHED_PRODUCTS = (15185, 19807, 23006, 24846, 24847)
WATCHED_LOCATIONS = (34, 67, 265, 397, 506, 507)
CRITICAL_AT = 3
LOW_AT = 5
STATUS_CRITICAL = "CRÍTICO"
STATUS_OK = "OK"
QUANTITY_UNIT = "UND"
LOCATION_COLOURS = {
    "CD RJ - JD OLIMPO": "#1e88e5",
    "CD ES - MERCOCAMP": "#43a047",
    "CD MG - ORMIFRIO": "#72350E",
    "CD ES - JD OLIMPO": "#595959",
    "LOJA XERÉM - CD RJ": "#FF8400",
    "LOJA XERÉM - CD ES": "#FFFE00",
}
DEFAULT_COLOUR = "#555555"
QUANTITY_COLOURS = {"critical": "#d32f2f", "low": "#f57c00", "normal": "#333"}
BADGE_BACKGROUND = {"critical": "#ffebee", "ok": "#e8f5e9"}
BADGE_COLOUR = {"critical": "#c62828", "ok": "#2e7d32"}
UNKNOWN_LOCATION = "Local Não Informado"
HEADLINE_CRITICAL = "⚠️ ALERTA: Estoque Crítico Identificado"
HEADLINE_NORMAL = "Relatório Semanal de Estoque"

# --- report texts -------------------------------------------------------------------------------
SUMMARY_BILLED_ORDERS = "Pedidos faturados"
SUMMARY_BILLED_TOTAL = "Valor total bruto"
SUMMARY_RETURNED_ORDERS = "Pedidos devolvidos"
SUMMARY_RETURNED_TOTAL = "Valor total devolvido"
SUMMARY_UNITS = "unidades"
SUMMARY_TOTALS = {"available": "Total Regular + Fulfillment", "irregular": "Total em Irregularidades"}
SUMMARY_TITLES = {"orders": "✅ RESUMO DIÁRIO DOS PEDIDOS", "stock": "✅ RESUMO DIÁRIO DO ESTOQUE"}
SUMMARY_SECTIONS = {
    "billing": "FATURAMENTO:",
    "returns": "DEVOLUÇÕES:",
    "regular": "ESTOQUE REGULAR:",
    "fulfilment": "ESTOQUE FULFILLMENT:",
    "irregular": "ESTOQUE DE PENDENCIAS, AVARIADOS, TRANSFERÊNCIA E OUTLET:",
}

# --- target columns, in order ------------------------------------------------------------------
BILLING_COLUMNS = (
    ("modified_at", "timestamp_ntz"), ("order_date", "date"), ("net_value", "decimal(38,10)"),
    ("unit_value", "decimal(38,10)"), ("other_expenses", "decimal(38,10)"),
    ("goods_cost", "decimal(38,10)"), ("list_cost", "decimal(38,10)"), ("orders", "bigint"),
    ("sold_quantity", "bigint"), ("freight", "decimal(38,10)"), ("tax_difference", "decimal(38,10)"),
    ("channel_commission", "decimal(38,10)"), ("billing_date", "date"), ("document_number", "string"),
    ("carrier", "string"), ("seller", "string"), ("traffic_source", "string"), ("state", "string"),
    ("city", "string"), ("neighbourhood", "string"), ("customer", "string"), ("partner", "string"),
    ("product_group", "string"), ("sku", "string"), ("product_name", "string"), ("maker", "string"),
    ("payment_form", "string"), ("payment_term", "string"), ("company", "string"),
    ("taxpayer_kind", "string"), ("destination", "string"), ("prospect_customer", "string"),
    ("order_identifier", "string"),
)
RETURN_COLUMNS = (
    ("issue_date", "date"), ("order_date", "date"), ("partner", "string"), ("product_group", "string"),
    ("sku", "string"), ("product_name", "string"), ("net_value", "decimal(38,10)"),
    ("unit_value", "decimal(38,10)"), ("other_expenses", "decimal(38,10)"),
    ("goods_cost", "decimal(38,10)"), ("list_cost", "decimal(38,10)"), ("orders", "bigint"),
    ("sold_quantity", "bigint"), ("document_number", "bigint"), ("carrier", "string"),
    ("freight", "decimal(38,10)"), ("extra_freight", "decimal(38,10)"), ("state", "string"),
    ("city", "string"), ("neighbourhood", "string"), ("customer", "string"), ("maker", "string"),
    ("payment_form", "string"), ("payment_term", "string"), ("order_identifier", "string"),
    ("company", "string"),
)
STOCK_COLUMNS = (
    ("sku", "string"), ("location", "string"), ("product_name", "string"), ("maker", "string"),
    ("product_group", "string"), ("available_quantity", "decimal(38,10)"),
    ("unit_value", "decimal(38,10)"), ("total_value", "decimal(38,10)"),
)
ORDER_COLUMNS = (
    ("order_id", "bigint"), ("order_date", "date"), ("channel", "string"), ("identifier", "string"),
    ("sku", "string"), ("product_name", "string"), ("quantity", "decimal(38,10)"),
    ("freight", "decimal(38,10)"), ("discount", "decimal(38,10)"), ("product_value", "decimal(38,10)"),
    ("final_value", "decimal(38,10)"), ("stock_location", "string"), ("origin", "string"),
    ("situation", "int"),
)
