from __future__ import annotations

import json
from contextlib import contextmanager
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import RUN, table
from pyspark.sql import functions as F

from ledgerline import fixed_values as fv
from ledgerline.__main__ import main, read_codes, read_jdbc
from ledgerline.params import Codes, RunParams
from ledgerline.plans.jobs import general_job, load_orders, open_targets
from ledgerline.session import shuffle_partitions_for
from ledgerline.sinks.tables import Folder, PartitionedTable, SnapshotTable
from ledgerline.sources import catalog, readers

PARAMS = RunParams(RUN, codes=Codes(sale_freight_pattern="%FRETE ESPECIAL%"))
COLUMNS = (("code", "string"), ("day", "date"), ("qty", "int"))


def monthly(spark, path):
    return PartitionedTable(spark, str(path), COLUMNS, "month", F.date_format(F.col("day"), "yyyy-MM"))


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "code string, day date, qty int")


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


JAN, FEB, MAR = date(2024, 1, 5), date(2024, 2, 5), date(2024, 3, 5)


def test_catalog_covers_all_source_tables():
    assert len(catalog.SOURCE_TABLES) == 31
    assert catalog.columns("document")[0] == ("document_id", "cdnota", "bigint")
    names = [catalog.source_table(name) for name in catalog.SOURCE_TABLES]
    assert len(set(names)) == len(names)


def test_parquet_tables_under_source_names(spark, tmp_path):
    source = spark.createDataFrame([(7, "RJ", "more")], "cduf int, sigla string, other string")
    source.write.parquet(str(tmp_path / "uf"))
    state = readers.parquet_tables(spark, str(tmp_path), ["state"])["state"]
    assert state.dtypes == [("state_id", "bigint"), ("code", "string")]
    assert contents(state) == [(7, "RJ")]


def test_jdbc_options():
    source = readers.JdbcSource(
        "jdbc:postgresql://host/db", {"user": "reader"}, {"document_item": readers.SplitRead("cdnota", 0, 100, 8)}
    )
    assert source.options("state")["dbtable"] == "uf"
    assert "partitionColumn" not in source.options("state")
    options = source.options("document_item")
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("cdnota", "8", "reader")


def test_large_jdbc_tables_must_be_split(spark):
    source = readers.JdbcSource("jdbc:postgresql://host/db", splits={"sale": readers.SplitRead("cdvenda", 0, 100, 8)})
    with pytest.raises(ValueError, match="large tables document_item, order$"):
        readers.jdbc_tables(spark, source, ["sale", "order", "state", "document_item"])


def test_read_sql_binds_tables_and_parameters(spark):
    df = batch(spark, ("a", JAN, 1), ("b", MAR, 2))
    found = readers.read_sql(spark, "SELECT code FROM {lines} WHERE day >= :since", {"lines": df}, {"since": FEB})
    assert contents(found) == [("b",)]
    assert readers.target_window(df.withColumn("created_at", F.lit(1)), "day", FEB).columns == ["code", "day", "qty"]


def test_snapshot_versions(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), COLUMNS)
    assert target.read().count() == 0
    assert target.write_unless_empty(batch(spark, ("a", JAN, 1))) == 1
    assert target.write_unless_empty(batch(spark, ("b", FEB, 2), ("c", FEB, 3))) == 2
    assert contents(target.read()) == [("b", FEB, 2), ("c", FEB, 3)]
    assert target.write_unless_empty(target.read().limit(0)) == 0
    assert contents(target.read()) == [("b", FEB, 2), ("c", FEB, 3)]
    # The next version may be computed from the current one.
    target.write_unless_empty(target.read().withColumn("qty", F.col("qty") + 1))
    assert contents(target.read()) == [("b", FEB, 3), ("c", FEB, 4)]
    assert len(target.versions()) == 2


def test_unfinished_version_is_not_read(spark, tmp_path):
    target = SnapshotTable(spark, str(tmp_path / "t"), COLUMNS)
    target.write_unless_empty(batch(spark, ("a", JAN, 1)))
    batch(spark, ("b", JAN, 1)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(str(tmp_path / "t" / "version-0000000002"))
    assert contents(target.read()) == [("a", JAN, 1)]
    target.write_unless_empty(batch(spark, ("c", JAN, 1)))
    assert target.versions()[-1] == "version-0000000003"


def test_partitioned_replace_rewrites_only_touched_partitions(spark, tmp_path):
    target = monthly(spark, tmp_path / "t")
    start = [("a", JAN, 1), ("b", FEB, 2), ("c", MAR, 3), (None, JAN, 4), ("d", None, 5)]
    assert target.replace_by_key(batch(spark, *start), "run1", ["code"]) == 5
    assert contents(target.read()) == sorted(start, key=str)
    before = target.current().folders["2024-03"]
    # "b" moves from February to January; February is left empty and goes.
    assert target.replace_by_key(batch(spark, ("b", JAN, 20), (None, JAN, 40)), "run2", ["code"]) == 2
    assert contents(target.read()) == sorted(
        [("a", JAN, 1), ("b", JAN, 20), ("c", MAR, 3), (None, JAN, 4), (None, JAN, 40), ("d", None, 5)], key=str
    )
    assert target.current().folders["2024-03"] == before
    assert "2024-02" not in target.current().folders
    assert target.replace_by_key(target.read().limit(0), "run3", ["code"]) == 0
    assert Folder(spark, str(tmp_path / "t" / "staging")).names() == []


def test_partitioned_upsert(spark, tmp_path):
    target = monthly(spark, tmp_path / "t")
    target.upsert(batch(spark, ("a", JAN, 1), ("a", FEB, 2), ("b", MAR, 3)), "run1", ["code"], ["day"])
    assert contents(target.read()) == [("a", FEB, 2), ("b", MAR, 3)]
    assert target.upsert(batch(spark, ("a", MAR, 9)), "run2", ["code"], ["day"]) == 1
    assert contents(target.read()) == [("a", MAR, 9), ("b", MAR, 3)]


@contextmanager
def broken(monkeypatch, method):
    """Loads break where the writer calls ``method``."""

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, method, lost)
        yield


@pytest.mark.parametrize("again", ["run2", "run9"])
@pytest.mark.parametrize("method", ["_written", "publish"])
def test_a_broken_load_changes_nothing_and_is_run_again(spark, tmp_path, monkeypatch, method, again):
    target = monthly(spark, tmp_path / "t")
    start = [("a", JAN, 1), (None, JAN, 2)]
    target.replace_by_key(batch(spark, *start), "run1", ["code"])
    load = batch(spark, ("a", FEB, 10), (None, FEB, 20))
    with broken(monkeypatch, method), pytest.raises(OSError):
        target.replace_by_key(load, "run2", ["code"])
    assert contents(target.read()) == sorted(start, key=str)
    assert target.replace_by_key(load, again, ["code"]) == 2
    assert contents(target.read()) == sorted([("a", FEB, 10), (None, FEB, 20), (None, JAN, 2)], key=str)


def test_a_load_broken_after_publishing_is_not_done_twice(spark, tmp_path, monkeypatch):
    target = monthly(spark, tmp_path / "t")
    load = batch(spark, ("a", FEB, 10), (None, FEB, 20))
    with broken(monkeypatch, "_clean"), pytest.raises(OSError):
        target.replace_by_key(load, "run1", ["code"])
    assert target.replace_by_key(load, "run1", ["code"]) == 2
    assert contents(target.read()) == sorted([("a", FEB, 10), (None, FEB, 20)], key=str)


def test_a_load_after_a_broken_one_is_kept(spark, tmp_path, monkeypatch):
    target = monthly(spark, tmp_path / "t")
    first, second = batch(spark, ("a", JAN, 1)), batch(spark, ("b", JAN, 2))
    with broken(monkeypatch, "publish"), pytest.raises(OSError):
        target.replace_by_key(first, "run1", ["code"])
    target.replace_by_key(second, "run2", ["code"])
    target.replace_by_key(first, "run1", ["code"])
    assert contents(target.read()) == [("a", JAN, 1), ("b", JAN, 2)]


def test_a_load_overtaken_while_computing_is_computed_again(spark, tmp_path, monkeypatch):
    target = monthly(spark, tmp_path / "t")
    target.replace_by_key(batch(spark, ("a", JAN, 1)), "run1", ["code"])
    reader = target.read()
    publish, overtaken = PartitionedTable.publish, []

    def overtake(self, version):
        if not overtaken:
            overtaken.append(version.number)
            other = batch(spark, ("b", JAN, 2))
            assert monthly(spark, tmp_path / "t").replace_by_key(other, "run3", ["code"]) == 1
        return publish(self, version)

    with monkeypatch.context() as patch:
        patch.setattr(PartitionedTable, "publish", overtake)
        assert target.upsert(batch(spark, ("a", JAN, 9), ("c", FEB, 3)), "run2", ["code"]) == 2
    assert contents(target.read()) == [("a", JAN, 9), ("b", JAN, 2), ("c", FEB, 3)]
    assert (overtaken, target.current().number) == ([2], 3)
    assert monthly(spark, tmp_path / "t").read().count() == 3
    assert reader.schema == target.read().schema


def test_folders_of_dead_loads_go(spark, tmp_path, monkeypatch):
    target = monthly(spark, tmp_path / "t")
    with broken(monkeypatch, "publish"), pytest.raises(OSError):
        target.replace_by_key(batch(spark, ("z", JAN, 0)), "dead", ["code"])
    for number in range(3):
        reader = target.read()
        target.replace_by_key(batch(spark, ("a", JAN, number)), f"run{number}", ["code"])
        # The version before stays readable.
        assert reader.count() == min(number, 1)
    assert Folder(spark, str(tmp_path / "t" / "staging")).names() == []
    assert Folder(spark, str(tmp_path / "t" / "data")).names() == [
        "load_folder=0000000001-run1", "load_folder=0000000002-run2"
    ]


def test_general_job(spark, retail, rows, tmp_path):
    returned = {"document_id": 101, "document_number": 1001}
    rows["document"].append(rows["document"][0] | returned)
    rows["document_fiscal"].append(rows["document_fiscal"][0] | {"document_id": 101, "operation_nature": 19})
    rows["document_item"].append(rows["document_item"][0] | {"document_id": 101})
    rows["document_exit"].append(rows["document_exit"][0] | {"document_id": 101})
    targets = open_targets(spark, str(tmp_path))
    counts, report = general_job(spark, retail(rows), targets, PARAMS, "run1")
    assert counts == {"billing": 2, "returns": 1, "stock": 1}
    printed = report.orderBy("position", "level").collect()
    assert [line.text for line in printed[:3]] == [
        "✅ RESUMO DIÁRIO DOS PEDIDOS - 15/03/2024", "FATURAMENTO:", "Pedidos faturados: 2"
    ]
    assert [line.text for line in printed if line.level < 2][2:5] == [
        "DEVOLUÇÕES:", "✅ RESUMO DIÁRIO DO ESTOQUE - 15/03/2024", "ESTOQUE REGULAR:"
    ]
    assert {line.report_day for line in printed} == {"15/03/2024"}
    text = [line.text for line in printed if line.level == 2]
    # Invoice 18.50 + 2.50 + 1, direct sale 18.50 + 9 + 1; return 18.50 + its freight share.
    assert text[:3] == ["Pedidos faturados: 2", "Valor total bruto: R$ 50,50", "Pedidos devolvidos: 1"]
    assert text[4] == "CD_RJ: 4 unidades | R$ 42,00"
    assert targets.billing.read().dtypes == [(name, kind) for name, kind in fv.BILLING_COLUMNS]
    assert {row.channel_commission for row in targets.billing.read().collect()} == {None}

    # The same day again, with a changed price: the keys are replaced, not repeated.
    rows["document_item"][0]["unit_price"] = 20
    counts, _ = general_job(spark, retail(rows), targets, PARAMS, "run2")
    assert targets.billing.read().count() == 2
    assert {row.net_value for row in targets.billing.read().collect()} == {Decimal("38.5"), Decimal("18.5")}


def test_order_job(spark, retail, rows, tmp_path):
    target = open_targets(spark, str(tmp_path)).orders
    assert load_orders(retail(rows), target, PARAMS, "run1") == 1
    assert load_orders(retail(rows), target, PARAMS, "run2") == 0
    created = target.read().first().created_at
    assert created is not None
    rows["order"][0]["situation"] = 0
    rows["order"].append(rows["order"][0] | {"order_id": 301})
    rows["order_item"].append(rows["order_item"][0] | {"order_id": 301})
    assert load_orders(retail(rows), target, PARAMS, "run3") == 2
    later = replace(PARAMS, run_date=RUN + timedelta(days=30))
    assert load_orders(retail(rows), target, later, "run4") == 0
    found = sorted(target.read().collect(), key=lambda row: row.order_id)
    assert [(row.order_id, row.situation) for row in found] == [(300, 0), (301, 0)]
    # An update keeps the time of creation, an insert has its own.
    assert found[0].created_at == created < found[1].created_at


def test_return_without_a_number_stops_the_load(spark, retail, rows, tmp_path):
    rows["document_fiscal"][0]["operation_nature"] = 19
    rows["document"][0]["document_number"] = None
    targets = open_targets(spark, str(tmp_path))
    with pytest.raises(Exception, match="key document_number"):
        general_job(spark, retail(rows), targets, PARAMS, "run1")
    assert targets.returns.read().count() == 0


def test_empty_sources_change_nothing(spark, retail, rows, tmp_path):
    targets = open_targets(spark, str(tmp_path))
    general_job(spark, retail(rows), targets, PARAMS, "run1")
    counts, _ = general_job(spark, retail({}), targets, PARAMS, "run2")
    assert counts == {"billing": 0, "returns": 0, "stock": 0}
    assert (targets.billing.read().count(), targets.stock.read().count()) == (2, 1)


def test_literal_tables_have_catalogued_types(spark):
    assert table(spark, "state", []).dtypes == [("state_id", "bigint"), ("code", "string")]


def test_catalog_tables_by_source_name(spark):
    spark.createDataFrame([(1, "RJ")], "cduf bigint, sigla string").createOrReplaceTempView("uf")
    assert contents(readers.catalog_tables(spark, names=["state"])["state"]) == [(1, "RJ")]


def test_codes_file_and_shuffle_size(tmp_path):
    path = tmp_path / "codes.json"
    path.write_text('{"company_labels": {"3": "Main"}, "document_status": [10], "return_nature": 20}')
    codes = read_codes(str(path))
    assert (codes.company_labels, codes.document_status, codes.return_nature) == ({3: "Main"}, (10,), 20)
    assert read_codes(None) == Codes()
    assert shuffle_partitions_for(10**9) == 200
    assert shuffle_partitions_for(100 * 2**30) == 800


def test_jdbc_file(tmp_path):
    path = tmp_path / "jdbc.json"
    path.write_text('{"properties": {"user": "u"}, "splits": {"sale": {"column": "cdvenda", "lower": 0, "upper": 9,'
                    ' "partitions": 3}}}')
    source = read_jdbc("jdbc:postgresql://host/db", str(path))
    assert (source.options("sale")["upperBound"], source.options("sale")["user"]) == ("9", "u")


def test_command_line(spark, retail, rows, tmp_path, capsys):
    for name, df in retail(rows).items():
        named = df.select(*[F.col(column.name).alias(column.source_name) for column in catalog.columns(name)])
        named.write.parquet(str(tmp_path / "source" / catalog.source_table(name)))
    common = ["--source", str(tmp_path / "source"), "--targets", str(tmp_path / "targets"), "--run-date", "2024-03-15"]
    main(["orders", *common])
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"orders": 1}
    with pytest.raises(ValueError, match="sale_freight_pattern"):
        main(["general", *common])
    codes = tmp_path / "codes.json"
    codes.write_text('{"sale_freight_pattern": "%FRETE ESPECIAL%"}')
    main(["general", *common, "--codes", str(codes)])
    lines = capsys.readouterr().out.splitlines()
    assert json.loads(lines[0]) == {"billing": 2, "returns": 0, "stock": 1}
    assert json.loads(lines[1])["text"] == "✅ RESUMO DIÁRIO DOS PEDIDOS - 15/03/2024"
    assert json.loads(lines[3])["text"] == "Pedidos faturados: 2"
    with pytest.raises(SystemExit):
        main(["general", "--source", str(tmp_path / "source")])
