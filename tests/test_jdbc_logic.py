"""JDBC source / target logic without a database.

No database server (or embedded database) is started here; the reader and
writer are replaced by recorders, so what is checked is the options and
statements this library hands to Spark's JDBC data source.
"""

from datetime import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from marlstone.operators import clean_orders
from marlstone.sources.publish import JdbcTarget, jdbc_transaction
from marlstone.sources.relational import JdbcSource, slice_predicates
from marlstone.sources.zones import read_path


class CatalogReader:
    """Stands in for ``spark.read``: runs the statements on catalog tables."""

    def __init__(self, spark, log):
        self.spark, self.log, self.opts = spark, log, {}

    def format(self, fmt):
        assert fmt == "jdbc"
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def load(self):
        self.log.append(self.opts)
        return self.spark.sql(self.opts["query"]) if "query" in self.opts else self.spark.table(self.opts["dbtable"])

    def jdbc(self, url, table, predicates):
        self.log.append({**self.opts, "url": url, "dbtable": table, "predicates": predicates})
        parts = [self.spark.table(table).where(p).coalesce(1) for p in predicates]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionAll(more)
        return out


@pytest.fixture()
def statements(spark, monkeypatch):
    """Statements and options handed to the JDBC reader, run on database jdbc_src."""
    log = []
    spark.sql("CREATE DATABASE IF NOT EXISTS jdbc_src")
    monkeypatch.setattr(type(spark), "read", property(lambda self: CatalogReader(self, log)))
    return log


def _source(**kw):
    return JdbcSource({"url": "jdbc:postgresql://h/db", "user": "u", "password": "p", "driver": "D"},
                      schema="jdbc_src", **kw)


def test_slices_hold_equally_many_rows_of_a_clustered_key(spark, statements):
    """Nine tenths of the keys lie in a hundred-thousandth of their range; two are NULL, one lies far below."""
    keys = [*range(5_000_000, 5_000_900), *range(10_000_000, 100_000_000, 900_000), -7, None, None]
    spark.sql("DROP TABLE IF EXISTS jdbc_src.clustered")
    spark.createDataFrame([(k, f" n{k} ") for k in keys], "id long, name string").write.saveAsTable("jdbc_src.clustered")
    df = _source(rows_per_slice=100, keys={"clustered": "id"}).read(spark, "clustered")
    scan = statements[-1]
    assert scan["dbtable"] == "jdbc_src.clustered" and scan["preferTimestampNTZ"] == "true"
    sizes = [spark.table("jdbc_src.clustered").where(p).count() for p in scan["predicates"]]
    assert sum(sizes) == len(keys) and len(sizes) == 11
    assert max(sizes) <= 2 * 100 and all(n == 100 for n in sizes[1:-1])
    assert df.dtypes == [("id", "bigint"), ("name", "string")]  # SELECT *: the source's own columns and types
    assert sorted(map(str, df.collect())) == sorted(map(str, spark.table("jdbc_src.clustered").collect()))
    # fewer statements, larger slices
    statements.clear()
    _source(rows_per_slice=100, max_slices=3, keys={"clustered": "id"}).read(spark, "clustered")
    assert len(statements[-1]["predicates"]) == 3


def test_small_empty_and_unkeyed_tables_are_one_statement(spark, statements):
    for table, rows in (("small", [(1,), (2,)]), ("nothing", []), ("unkeyed", [(1,)])):
        spark.sql(f"DROP TABLE IF EXISTS jdbc_src.{table}")
        spark.createDataFrame(rows, "id int").write.saveAsTable(f"jdbc_src.{table}")
        df = _source(rows_per_slice=2, keys={"small": "id", "nothing": "id"}).read(spark, table)
        assert "predicates" not in statements[-1] and df.count() == len(rows)


def test_slices_of_repeated_and_text_keys(spark, statements):
    """A repeated key stays in one slice; text keys are quoted."""
    names = ["a"] * 6 + ["o'b", "b", "c", "d", None]
    spark.sql("DROP TABLE IF EXISTS jdbc_src.named")
    spark.createDataFrame([(n,) for n in names], "name string").write.saveAsTable("jdbc_src.named")
    df = _source(rows_per_slice=2, keys={"named": "name"}).read(spark, "named")
    assert statements[-1]["predicates"][0] == "name < 'b' OR name IS NULL"
    assert sorted(r.name or "" for r in df.collect()) == sorted(n or "" for n in names)


def test_slice_predicates():
    assert slice_predicates("k", []) == ["1 = 1"]
    assert slice_predicates("k", [3]) == ["1 = 1"]
    assert slice_predicates("k", [3, 9, 12]) == ["k < 9 OR k IS NULL", "k >= 9 AND k < 12", "k >= 12"]
    assert slice_predicates("k", ["a", "o'b"]) == ["k < 'o''b' OR k IS NULL", "k >= 'o''b'"]


def _recorded_session(jvm):
    return type("S", (), {"sparkContext": type("C", (), {"_jvm": jvm})})


def test_one_snapshot_for_all_statements_of_an_extract(spark, statements, monkeypatch, scratch):
    """The snapshot is exported before the first read, named in every statement, and
    held until the last table is written."""
    from marlstone.plans import pipeline
    from marlstone.sources import relational
    jvm = RecordingJvm()
    monkeypatch.setattr(relational, "jdbc_connection", lambda s, o: jvm)
    spark.sql("DROP TABLE IF EXISTS jdbc_src.moment")
    spark.createDataFrame([(i,) for i in range(10)], "id int").write.saveAsTable("jdbc_src.moment")
    source = _source(rows_per_slice=4, keys={"moment": "id"})
    with source.consistent(spark) as seen:
        seen.read(spark, "moment")
        assert "close" not in [c[0] for c in jvm.calls]
    names = [c[0] for c in jvm.calls]
    assert names == ["setAutoCommit", "createStatement", "execute", "executeQuery", "next", "getString",
                     "rollback", "close"]
    assert ("setAutoCommit", False) in jvm.calls and ("executeQuery", "SELECT pg_export_snapshot()") in jvm.calls
    assert len(statements) == 3  # count, starts, rows
    for opts in statements:
        assert opts["sessionInitStatement"].startswith(
            "SET TRANSACTION ISOLATION LEVEL REPEATABLE READ, READ ONLY; SET TRANSACTION SNAPSHOT '")
    assert "sessionInitStatement" not in source.extra
    # every table of an extract is read within one block, and the connection is closed after a failure too
    jvm.calls.clear()
    read = []

    def failing(self, spark, table):
        read.append((table, "close" in [c[0] for c in jvm.calls], "sessionInitStatement" in self.extra))
        if len(read) == 2:
            raise OSError("gone")
        return spark.table("jdbc_src.moment")

    monkeypatch.setattr(JdbcSource, "read", failing)
    monkeypatch.setattr(pipeline, "begin", lambda *a: FakeStage())
    monkeypatch.setattr(pipeline, "_write", lambda stage, zone, table, rows: rows())
    with pytest.raises(OSError):
        pipeline.extract_to_bronze(spark, source, scratch, tables=["one", "two", "three"])
    assert read == [("one", False, True), ("two", False, True)]
    assert [c[0] for c in jvm.calls].count("close") == 1


class FakeStage:
    """An extract that had finished a table before: under a snapshot it is read anew."""

    def __init__(self):
        self.finished = {("bronze", "one"): None}


def test_common_snapshot_needs_its_database(spark):
    with pytest.raises(ValueError, match="PostgreSQL"), JdbcSource({"url": "jdbc:x://h"}).consistent(spark):
        pass
    with pytest.raises(ValueError, match="fetch_size"), _source(fetch_size=0).consistent(spark):
        pass
    plain = JdbcSource({"url": "jdbc:x://h"}, common_snapshot=False)
    with plain.consistent(spark) as seen:
        assert seen is plain


class RecordingWriter:
    def __init__(self, log):
        self.log, self.opts = log, {}

    def format(self, fmt):
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def mode(self, m):
        self.opts["mode"] = m
        return self

    def save(self):
        self.log.append(dict(self.opts))


class FakeFrame:
    columns = ["b", "a"]
    sparkSession = "session"

    def __init__(self, log):
        self.log = log

    @property
    def write(self):
        return RecordingWriter(self.log)


def test_jdbc_target_refills_in_one_transaction():
    log, calls = [], []
    target = JdbcTarget({"url": "u"}, num_partitions=4, schema="bi", transaction=lambda *a: calls.append(a))
    target.replace_rows(FakeFrame(log), "gold_x")
    target.replace_rows(FakeFrame(log), "gold_x")
    stages = [w.pop("dbtable") for w in log]
    assert log == [{"url": "u", "numPartitions": "4", "batchsize": "10000", "mode": "overwrite"}] * 2
    assert all(s.startswith('"bi"."gold_x__stage_') for s in stages) and len(set(stages)) == 2
    assert calls == [("session", {"url": "u"}, [
        'TRUNCATE TABLE "bi"."gold_x"',
        f'INSERT INTO "bi"."gold_x" ("b", "a") SELECT "b", "a" FROM {stage}',
        f"DROP TABLE {stage}"]) for stage in stages]


def test_jdbc_target_runs_no_transaction_after_a_failed_load():
    calls = []

    class Failing(FakeFrame):
        @property
        def write(self):
            raise OSError("no rows")

    with pytest.raises(OSError):
        JdbcTarget({"url": "u"}, transaction=lambda *a: calls.append(a)).replace_rows(Failing([]), "gold_x")
    assert calls == []


class RecordingJvm:
    """Stands in for the JVM: a driver whose connection records its calls."""

    def __init__(self, fail_on=None):
        self.calls, self.fail_on = [], fail_on

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *args))
            if name == "executeUpdate" and args[0] == self.fail_on:
                raise ValueError("refused")
            return self
        return call if name not in ("java", "lang", "util", "Thread", "Class") else self


@pytest.mark.parametrize("fail_on, end", [(None, "commit"), ("two", "rollback")])
def test_jdbc_transaction(fail_on, end):
    jvm = RecordingJvm(fail_on)
    session = _recorded_session(jvm)
    options = {"url": "jdbc:x", "driver": "D", "user": "u", "password": "p"}
    if fail_on:
        with pytest.raises(ValueError):
            jdbc_transaction(session, options, ["one", "two"])
    else:
        jdbc_transaction(session, options, ["one", "two"])
    names = [c[0] for c in jvm.calls]
    assert ("connect", "jdbc:x", jvm) in jvm.calls and ("setAutoCommit", False) in jvm.calls
    assert [c[1] for c in jvm.calls if c[0] == "executeUpdate"] == ["one", "two"]
    assert {"commit", "rollback"} & set(names) == {end}
    assert names.count("close") == 2


def test_existing_bronze_with_narrower_money_is_readable(spark, scratch):
    """Bronze files keep the source's own decimals, as NUMERIC(10,2) of the
    shop's DDL."""
    path = f"{scratch}/legacy_orders.parquet"
    money = pa.decimal128(10, 2)
    table = pa.table({
        "order_id": pa.array([1, 2], pa.int32()),
        "create_at": pa.array([datetime(2026, 6, 10, 10, 3, 30)] * 2, pa.timestamp("us")),
        "website_session_id": pa.array([101, 102], pa.int32()),
        "user_id": pa.array([1, 2], pa.int32()),
        "primary_product_id": pa.array([1, 1], pa.int32()),
        "items_purchased": pa.array([1, 1], pa.int32()),
        "price_usd": pa.array([Decimal("19.99"), Decimal("-1.00")], money),
        "cogs_usd": pa.array([Decimal("9.00"), Decimal("1.00")], money),
    })
    pq.write_table(table, path)
    rows = clean_orders(read_path(spark, path)).collect()
    assert [(r.order_id, r.price_usd, r.created_at.isoformat()) for r in rows] == [
        (1, 19.99, "2026-06-10T10:03:30")]
