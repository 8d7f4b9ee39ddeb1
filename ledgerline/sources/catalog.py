"""Source tables: our names, the source system's names and the types.

FIXED VALUES. ``our_table: (source table, ((our column, source column, type), ...))``.
The types follow use: bigint for identifiers, int for small codes, decimal(18,4) for amounts and quantities.
"""

from __future__ import annotations

from functools import cache
from typing import NamedTuple

SOURCE_TABLES = {
    "product": (
        "material",
        (
            ("product_id", "cdmaterial", "bigint"),
            ("sku", "identificacao", "string"),
            ("product_name", "nome", "string"),
            ("group_id", "cdmaterialgrupo", "bigint"),
            ("list_cost", "valorvendaminimo", "decimal(18,4)"),
            ("cost", "valorcusto", "decimal(18,4)"),
            ("is_product", "produto", "boolean"),
            ("is_active", "ativo", "boolean"),
        ),
    ),
    "product_group": (
        "materialgrupo",
        (
            ("group_id", "cdmaterialgrupo", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
    "product_supplier": (
        "materialfornecedor",
        (
            ("product_id", "cdmaterial", "bigint"),
            ("party_id", "cdpessoa", "bigint"),
            ("principal", "principal", "boolean"),
        ),
    ),
    "party": (
        "pessoa",
        (
            ("party_id", "cdpessoa", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
    "customer_tax": (
        "cliente",
        (
            ("customer_id", "cdpessoa", "bigint"),
            ("taxpayer_code", "contribuinteicmstipo", "int"),
        ),
    ),
    "customer_seller": (
        "clientevendedor",
        (
            ("customer_id", "cdcliente", "bigint"),
            ("seller_id", "cdcolaborador", "bigint"),
            ("principal", "principal", "boolean"),
        ),
    ),
    "company": (
        "empresa",
        (
            ("company_id", "cdpessoa", "bigint"),
            ("trade_name", "nomefantasia", "string"),
        ),
    ),
    "document": (
        "nota",
        (
            ("document_id", "cdnota", "bigint"),
            ("customer_id", "cdcliente", "bigint"),
            ("company_id", "cdempresa", "bigint"),
            ("address_id", "cdendereco", "bigint"),
            ("status", "cdnotastatus", "int"),
            ("project_id", "cdprojeto", "bigint"),
            ("issue_date", "dtemissao", "date"),
            ("document_number", "numero", "bigint"),
        ),
    ),
    "document_fiscal": (
        "notafiscalproduto",
        (
            ("document_id", "cdnota", "bigint"),
            ("operation_nature", "cdnaturezaoperacao", "int"),
            ("carrier_id", "cdtransportador", "bigint"),
            ("intermediary_id", "cdintermediador", "bigint"),
            ("intermediary_code", "intermediadornfe", "int"),
            ("destination_code", "localdestinonfe", "int"),
            ("document_expenses", "outrasdespesas", "decimal(18,4)"),
            ("document_value", "valor", "decimal(18,4)"),
            ("order_number", "numeropedido", "string"),
        ),
    ),
    "document_item": (
        "notafiscalprodutoitem",
        (
            ("item_id", "cdnotafiscalprodutoitem", "bigint"),
            ("document_id", "cdnotafiscalproduto", "bigint"),
            ("product_id", "cdmaterial", "bigint"),
            ("sale_item_id", "cdvendamaterial", "bigint"),
            ("quantity", "qtde", "decimal(18,4)"),
            ("unit_price", "valorunitario", "decimal(18,4)"),
            ("discount", "valordesconto", "decimal(18,4)"),
            ("item_freight", "valorfrete", "decimal(18,4)"),
            ("recipient_tax", "valoricmsdestinatario", "decimal(18,4)"),
        ),
    ),
    "document_exit": (
        "vwsaidafiscal",
        (
            ("document_id", "cdnota", "bigint"),
            ("exit_freight", "valorfrete", "decimal(18,4)"),
            ("product_total", "valortotalprodutos", "decimal(18,4)"),
        ),
    ),
    "document_sale": (
        "notavenda",
        (
            ("document_id", "cdnota", "bigint"),
            ("sale_id", "cdvenda", "bigint"),
        ),
    ),
    "sale": (
        "venda",
        (
            ("sale_id", "cdvenda", "bigint"),
            ("customer_id", "cdcliente", "bigint"),
            ("company_id", "cdempresa", "bigint"),
            ("address_id", "cdenderecoentrega", "bigint"),
            ("order_id", "cdpedidovenda", "bigint"),
            ("order_type_id", "cdpedidovendatipo", "bigint"),
            ("payment_form_id", "cdformapagamento", "bigint"),
            ("payment_term_id", "cdprazopagamento", "bigint"),
            ("carrier_id", "cdterceiro", "bigint"),
            ("situation", "cdvendasituacao", "int"),
            ("project_id", "cdprojeto", "bigint"),
            ("sale_date", "dtvenda", "date"),
            ("modified_at", "dtaltera", "timestamp_ntz"),
            ("sale_freight", "valorfrete", "decimal(18,4)"),
            ("discount_pct", "percentualdesconto", "decimal(18,4)"),
        ),
    ),
    "sale_item": (
        "vendamaterial",
        (
            ("sale_item_id", "cdvendamaterial", "bigint"),
            ("sale_id", "cdvenda", "bigint"),
            ("product_id", "cdmaterial", "bigint"),
            ("quantity", "quantidade", "decimal(18,4)"),
            ("unit_price", "preco", "decimal(18,4)"),
            ("discount", "desconto", "decimal(18,4)"),
            ("item_expenses", "outrasdespesas", "decimal(18,4)"),
            ("goods_cost", "valorcustomaterial", "decimal(18,4)"),
        ),
    ),
    "sale_payment": (
        "vendapagamento",
        (
            ("sale_id", "cdvenda", "bigint"),
            ("payment_document_id", "cddocumento", "bigint"),
        ),
    ),
    "payment_document": (
        "aux_documento",
        (
            ("payment_document_id", "cddocumento", "bigint"),
            ("term_value", "valortermo", "decimal(18,4)"),
        ),
    ),
    "sale_total": (
        "vvalorvenda",
        (
            ("sale_id", "cdvenda", "bigint"),
            ("sale_document_total", "total_documento", "decimal(18,4)"),
        ),
    ),
    "order_total": (
        "vvalorpedidovenda",
        (
            ("order_id", "cdpedidovenda", "bigint"),
        ),
    ),
    "order": (
        "pedidovenda",
        (
            ("order_id", "cdpedidovenda", "bigint"),
            ("partner_id", "cdparceiro", "bigint"),
            ("order_type_id", "cdpedidovendatipo", "bigint"),
            ("location_id", "cdlocalarmazenagem", "bigint"),
            ("order_date", "dtpedidovenda", "date"),
            ("identifier", "identificador", "string"),
            ("situation", "pedidovendasituacao", "int"),
            ("order_freight", "valorfrete", "decimal(18,4)"),
        ),
    ),
    "order_type": (
        "pedidovendatipo",
        (
            ("order_type_id", "cdpedidovendatipo", "bigint"),
            ("description", "descricao", "string"),
        ),
    ),
    "order_item": (
        "pedidovendamaterial",
        (
            ("order_id", "cdpedidovenda", "bigint"),
            ("product_id", "cdmaterial", "bigint"),
            ("quantity", "quantidade", "decimal(18,4)"),
            ("unit_price", "preco", "decimal(18,4)"),
            ("discount", "desconto", "decimal(18,4)"),
        ),
    ),
    "attribute_type": (
        "campoextrapedidovendatipo",
        (
            ("attribute_type_id", "cdcampoextrapedidovendatipo", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
    "attribute_value": (
        "vendavalorcampoextra",
        (
            ("sale_id", "cdvenda", "bigint"),
            ("attribute_type_id", "cdcampoextrapedidovendatipo", "bigint"),
            ("value", "valor", "string"),
        ),
    ),
    "address": (
        "endereco",
        (
            ("address_id", "cdendereco", "bigint"),
            ("city_id", "cdmunicipio", "bigint"),
            ("neighbourhood", "bairro", "string"),
        ),
    ),
    "city": (
        "municipio",
        (
            ("city_id", "cdmunicipio", "bigint"),
            ("state_id", "cduf", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
    "state": (
        "uf",
        (
            ("state_id", "cduf", "bigint"),
            ("code", "sigla", "string"),
        ),
    ),
    "payment_form_sales": (
        "documentotipo",
        (
            ("payment_form_id", "cddocumentotipo", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
    "payment_form_returns": (
        "formapagamento",
        (
            ("payment_form_id", "cdformapagamento", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
    "payment_term": (
        "prazopagamento",
        (
            ("payment_term_id", "cdprazopagamento", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
    "stock_by_product": (
        "vgerenciarmaterial",
        (
            ("product_id", "cdmaterial", "bigint"),
            ("group_id", "cdmaterialgrupo", "bigint"),
            ("location_id", "cdlocalarmazenagem", "bigint"),
            ("company_id", "cdempresa", "bigint"),
            ("sku", "identificacao", "string"),
            ("product_name", "nome", "string"),
            ("available_quantity", "qtdedisponivel", "decimal(18,4)"),
            ("unit_cost", "valorcustomaterial", "decimal(18,4)"),
        ),
    ),
    "stock_location": (
        "localarmazenagem",
        (
            ("location_id", "cdlocalarmazenagem", "bigint"),
            ("name", "nome", "string"),
        ),
    ),
}


class SourceColumn(NamedTuple):
    name: str
    source_name: str
    data_type: str


@cache
def source_table(table: str) -> str:
    return SOURCE_TABLES[table][0]


@cache
def columns(table: str) -> tuple[SourceColumn, ...]:
    return tuple(SourceColumn(*column) for column in SOURCE_TABLES[table][1])


@cache
def schema(table: str) -> str:
    """DDL of a table under our names."""
    return ", ".join(f"`{column.name}` {column.data_type}" for column in columns(table))
