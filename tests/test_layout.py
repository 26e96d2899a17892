"""Stored layouts, runtime filters, slices and salts: plans and rows."""

import datetime as dt
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerline import config as C
from ledgerline.operators.joins import salt_width
from ledgerline.plans import combine, health, motor, parts
from ledgerline.registry import fixture_config, run, specs
from ledgerline.session import MOST_FILTER_BITS, runtime_filter_conf
from ledgerline.sources.catalog import Catalog, key_column, month_product_predicates
from ledgerline.sources.fixtures import FIRST, RENEWAL, REPEATED, FixtureTables, fixture_catalog, write_fixture_tables
from ledgerline.sources.layout import LEAD_KEYS, bucket_rows, open_lead_layout, write_lead_layout

SF = "/root/testdata/sf0.001"
LEADS = ("sme_leads", "motor_leads", "health_fresh_leads", "health_renewal_leads", "life_leads")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plain"))
    write_fixture_tables(spark, SF, root)
    return Catalog.from_parquet(spark, root)


@pytest.fixture(scope="module", params=[False, True], ids=["buckets", "buckets-and-months"])
def by_lead(spark, stored, request, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("by_lead"))
    write_lead_layout(stored, root, 6, months=request.param)
    return root


class settings:
    """Session settings for a while."""

    def __init__(self, spark, **conf):
        self.spark, self.conf = spark, {f"spark.sql.{k.replace('__', '.')}": v for k, v in conf.items()}

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self.conf}
        for k, v in self.conf.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.spark.conf.set(k, v) if v is not None else self.spark.conf.unset(k)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)[^\n]*", plan)


# -- lead layout ------------------------------------------------------------------------

@pytest.mark.parametrize("name", ["sme_leads", "motor_leads", "health_fresh_leads", "life_leads", "motor_summary"])
def test_lookups_by_lead_need_no_exchange(spark, stored, by_lead, name, tmp_path):
    """No lookup is small enough to be broadcast here, the partner universe is."""
    stored.table("partners").where("PartnerCode IN ('IP7', 'IP8', 'IP10')").coalesce(1).write.parquet(f"{tmp_path}/few")
    few, spec = spark.read.parquet(f"{tmp_path}/few"), specs()[name]
    cfg = replace(fixture_config(spec.variant, spec.period), salts=1)
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="5000"):
        here, there = (physical(spec.fn(cat.with_table("partners", few), cfg)) for cat in (open_lead_layout(spark, by_lead), stored))
    lead = re.compile(r"Exchange hashpartitioning\((leadid|_k|\w*[Ll][Ee][Aa][Dd]\w*)#")
    joins = 1 if name == "sme_leads" else 2
    assert len(lead.findall(there)) > joins, "the plain layout shuffles the stream and the lookups by lead"
    assert not lead.search(here)
    assert len(re.findall(r"SortMergeJoin \[leadid#", here)) >= joins


@pytest.mark.parametrize("name", [*LEADS, "motor_summary", "combined_leads", "renewal_locking_date"])
def test_lead_layout_gives_the_same_rows(spark, stored, by_lead, name):
    with settings(spark, autoBroadcastJoinThreshold="-1"):
        assert rows(run(name, open_lead_layout(spark, by_lead))) == rows(run(name, stored))


def test_layout_can_be_read_plain(spark, stored, by_lead):
    cat = open_lead_layout(spark, by_lead, plain=tuple(LEAD_KEYS))
    assert rows(run("motor_leads", cat)) == rows(run("motor_leads", stored))


def test_bucket_rows_show_a_hot_lead(spark, stored, by_lead):
    n = {r["bucket"]: r["n"] for r in bucket_rows(spark, by_lead, "bookings").collect()}
    assert set(n) == set(range(6)) and sum(n.values()) == stored.table("bookings").count()


# -- normalised key columns ---------------------------------------------------------------

@pytest.mark.parametrize("name, column", [
    ("sme_leads", "Status"), ("life_leads", "Status"), ("motor_leads", "Leadsource"),
    ("health_fresh_leads", "BusinessType"), ("health_renewal_leads", "BusinessType")])
def test_text_filters_reach_the_scan(spark, stored, by_lead, name, column):
    text = spark._jvm.PythonSQLUtils.explainString(run(name, open_lead_layout(spark, by_lead))._jdf.queryExecution(), "formatted")
    pushed = [line for line in text.splitlines() if line.startswith("PushedFilters") and "BookingDate" in line]
    assert pushed and all(key_column(column) in line for line in pushed)
    plain = spark._jvm.PythonSQLUtils.explainString(run(name, stored)._jdf.queryExecution(), "formatted")
    assert key_column(column) not in plain


# -- one pass over all lines ------------------------------------------------------------------

@pytest.mark.parametrize("variant", [C.CURRENT, C.NO_SELL_NOW, C.LEGACY], ids=lambda v: v.name)
def test_one_pass_equals_the_five_reports(stored, variant):
    cfg = fixture_config(variant, C.Period.year(1997))
    got = combine.combined_leads(stored, cfg)
    want = combine.consolidate([combine.line_reports(stored, cfg)[n] for n in combine.LINES])
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_one_pass_without_product_filter_on_life_details(stored):
    """A details row may be looked up by health and by life."""
    cfg = fixture_config(replace(C.CURRENT, life_details_product_filter=False), C.Period.year(1997))
    assert rows(combine.combined_leads(stored, cfg)) == rows(
        combine.consolidate([combine.line_reports(stored, cfg)[n] for n in combine.LINES]))


def test_one_pass_condition_on_lookup_columns(stored):
    cfg = fixture_config(period=C.Period.year(1997))
    for sql in ("VerificationStatus = 'Verified'", "MatrixLeadId IS NOT NULL", "APE > 20000 AND special_deal_flag = 1", "_line = 'Life'"):
        got = rows(combine.combined_leads(stored, cfg, F.expr(sql)))
        want = rows(combine.combined_leads(stored, cfg))
        assert got and not got - want and sum(got.values()) < sum(want.values())


def test_one_pass_reads_the_fact_twice(spark, stored):
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1"):
        df = run("combined_leads", stored)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        plan = physical(df)
    scans = [b for b in text.split("\n\n") if "Scan parquet" in b and re.search(r"Location: .*/bookings\]", b)]
    assert len(scans) == 2  # bookings, prior policies
    assert sum("BusinessType" in b for b in scans) == 1
    assert len(exchanges(plan)) <= 26
    # one lookup per table
    for name in ("booking_details", "verification", "contest", "business_type", "pay_term"):
        assert len([b for b in text.split("\n\n") if "Scan parquet" in b and re.search(rf"Location: .*/{name}\]", b)]) == 1


# -- runtime filters -----------------------------------------------------------------------

def _rows_into_counts(df) -> int:
    """Rows that leave the filter above each lookup scan, from the metrics of a run without AQE."""
    df.collect()
    total = 0

    def walk(node):
        nonlocal total
        if node.nodeName() == "Filter" and "might_contain" in node.condition().toString() and "eadi" in node.condition().toString().lower():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return total


def test_lookups_are_reduced_to_the_periods_leads(spark, stored):
    bloom = "optimizer__runtime__bloomFilter__"
    cfg = lambda p: fixture_config(period=p)
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1",
                  **{bloom + "enabled": "false"}):
        plain = {p: rows(motor.motor_leads(stored, cfg(p))) for p in (C.Period.quarter(1997, 1), C.Period.year(1997))}
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1",
                  **{bloom + "enabled": "true", bloom + "applicationSideScanSizeThreshold": "1"}):
        n = {}
        for p, want in plain.items():
            df = motor.motor_leads(stored, cfg(p))
            assert "might_contain" in physical(df)
            assert rows(df) == want  # no false loss
            n[p] = _rows_into_counts(motor.motor_leads(stored, cfg(p)))
    quarter, year = n.values()
    assert 0 < quarter < year / 2 < stored.table("business_type").count()


def test_runtime_filters_end_where_they_would_be_full():
    on = runtime_filter_conf(1_000_000)
    assert on["spark.sql.optimizer.runtime.bloomFilter.numBits"] == "8000000"
    assert runtime_filter_conf(MOST_FILTER_BITS) == {"spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}


# -- hot referral, hot dimension keys ---------------------------------------------------------

def _hot_catalog(spark, stored, n=6000):
    """A third of all edges refer to one prior booking."""
    b = stored.table("bookings")
    one = b.where("ProductId = 190 AND PolicyEndDate >= TIMESTAMP_NTZ '1997-02-01 00:00:00' AND PolicyEndDate < TIMESTAMP_NTZ '1997-10-01 00:00:00'").first()
    made = {"leadid": "10000000 + id", "ProductId": "190", "BusinessType": "'Renewal'", "StatusId": "41"}
    copy = spark.range(n).crossJoin(b.where(f"leadid = {one['leadid']}").limit(1)).selectExpr(
        *[f"CAST({made.get(c, f'`{c}`')} AS {t}) AS `{c}`" for c, t in b.dtypes])
    edges = stored.table("lead_referral")
    hot = spark.range(n).selectExpr("10000000 + id AS LeadID", f"{one['leadid']}L AS ReferralID")
    return stored.with_table("bookings", b.unionByName(copy)).with_table("lead_referral", edges.unionByName(hot)), one["leadid"]


def test_hot_referral_is_split(spark, stored):
    cat, hot = _hot_catalog(spark, stored)
    cfg = replace(fixture_config(C.NO_SELL_NOW, C.Period.year(1997)), salts=32)
    prior = health.counted_policies(cat.table("bookings"))
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1", shuffle__partitions="16"):
        met = health.met_edges(cat, prior, 32)
        n = [r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect()]
        edges = cat.table("lead_referral")
        assert edges.where(f"ReferralID = {hot}").count() * 3 >= edges.count() - 3
        median = sorted(n)[len(n) // 2]
        assert max(n) <= 2 * median
        got = rows(health.prior_policies(cat, cfg))
    p = cfg.period
    plain = cat.table("lead_referral").selectExpr("LeadID AS _lead", "ReferralID").join(
        cat.table("bookings").where(F.expr(f"PolicyEndDate >= TIMESTAMP_NTZ '{p.min_date} 00:00:00' AND PolicyEndDate < TIMESTAMP_NTZ '{p.max_date} 00:00:00'")),
        F.expr("ReferralID = leadid")).groupBy("_lead", "PolicyEndDate").count()
    assert got == rows(plain)


@pytest.mark.parametrize("slices", [1, 7])
def test_slices_change_no_rows(spark, stored, slices):
    cat, _ = _hot_catalog(spark, stored, 50)
    e, b = cat.table("lead_referral"), cat.table("bookings")
    prev = b.selectExpr("leadid AS p", "CAST(PolicyEndDate AS DATE) AS d")
    e = e.selectExpr("LeadID AS _lead", "ReferralID")
    plain = b.join(e, F.expr("leadid = _lead")).join(prev, F.expr("ReferralID = p")).select("leadid", "ReferralID", "BookingDate", "d")
    assert rows(parts.renewal_calendar(cat, slices).select("leadid", "ReferralID", "BookingDate", "Prev_end_date")) == rows(plain)


@pytest.mark.parametrize("salts", [8, 64])
def test_hot_partner_is_spread_over_the_tasks_asked_for(spark, stored, salts):
    hot = stored.with_table("bookings", stored.table("bookings").withColumn("Utm_term", F.lit("IP7")))
    cfg = fixture_config(period=C.Period.year(1997))
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1", shuffle__partitions=str(4 * salts)):
        from ledgerline.operators.partners import attach_partner
        salted = attach_partner(hot.table("bookings"), hot, replace(cfg, salts=salts))
        assert f", {salts})" in physical(salted)
        flags = physical(motor.join_status_classes(hot.table("bookings"), hot, salts))
        assert not re.search(r"Exchange hashpartitioning\(StatusId#", flags.split("SortMergeJoin")[1].split("FileScan")[0])
        used = salted.select(F.spark_partition_id().alias("p")).distinct().count()
        assert salts // 2 < used <= salts
        one = motor.motor_leads(hot, replace(cfg, salts=1))
        assert rows(motor.motor_leads(hot, replace(cfg, salts=salts))) == rows(one)


def test_salt_width_follows_the_session(spark, stored):
    df = stored.table("status")
    assert salt_width(df) == 1 and salt_width(df, 5) == 5
    with settings(spark, adaptive__skewJoin__enabled="false", shuffle__partitions="33"):
        assert salt_width(df) == 33


# -- JDBC ------------------------------------------------------------------------------------

def test_predicates_cover_the_window_once():
    got = month_product_predicates("BookingDate", dt.date(2025, 11, 10), dt.date(2026, 2, 1), "ProductId", [(186, 187), (7,)])
    months = ["'2025-11-10' AND BookingDate < '2025-12-01'", "'2025-12-01' AND BookingDate < '2026-01-01'", "'2026-01-01' AND BookingDate < '2026-02-01'"]
    assert got == [f"BookingDate >= {m} AND ProductId IN ({p})" for m in months for p in ("186, 187", "7")]
    assert len(month_product_predicates("d", dt.date(2026, 1, 1), dt.date(2027, 1, 1))) == 12


def test_jdbc_reads_one_task_per_predicate(spark, monkeypatch):
    """The call as it is built; no database is started."""
    from pyspark.sql import DataFrameReader

    seen = {}
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, **kw: seen.update(url=url, table=table, **kw) or "frame")
    predicates = month_product_predicates("BookingDate", dt.date(2026, 1, 1), dt.date(2026, 4, 1))
    cat = Catalog.from_jdbc(spark, "jdbc:x", {"bookings": "dbo.b"}, {"user": "u"}, {"bookings": {"predicates": predicates, "fetchsize": 5000}})
    assert cat.table("bookings") == "frame"
    assert seen == {"url": "jdbc:x", "table": "dbo.b", "predicates": predicates, "properties": {"user": "u", "fetchsize": "5000"}}


def test_every_report_runs_on_plain_columns(spark):
    """A fact without stored keys or months (the fixture views) keeps working."""
    cat = fixture_catalog(spark, SF)
    assert key_column("Status") not in cat.table("bookings").columns
    assert "sme_leads" in specs() and run("sme_leads", cat).count() > 0


def test_bookings_derive_in_one_sort_and_store_no_texts(spark, tmp_path):
    # two copies of an order, a repeated line, a line without an order, null keys
    spark.sql("""SELECT * FROM VALUES (1L, 5L, timestamp_ntz'1997-02-01 00:00:00'), (1L, 5L, timestamp_ntz'1997-02-01 00:00:00'),
        (2L, null, timestamp_ntz'1997-03-01 00:00:00'), (null, 7L, null) AS t(o_orderkey, o_custkey, o_orderdate)""").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("""SELECT *, timestamp_ntz'1997-05-01 00:00:00' AS l_shipdate FROM VALUES
        (1L, 3L, 4L, 1, 6D, 100.5D, 0.05D, 0.02D, 'R'), (1L, 3L, 4L, 1, 6D, 100.5D, 0.05D, 0.02D, 'R'), (1L, 2L, 9L, 1, 7D, 10D, 0.1D, 0D, 'A'),
        (1L, 8L, 1L, 3, 11D, 20D, 0D, 0.08D, 'N'), (2L, null, 4L, 4, null, null, null, null, null), (2L, 1L, 1L, null, 1D, 1D, 0D, 0D, 'N'),
        (9L, 1L, 1L, 1, 1D, 1D, 0D, 0D, 'N'), (null, 1L, 1L, 1, 1D, 1D, 0D, 0D, 'N')
        AS t(l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    with settings(spark, adaptive__enabled="false", autoBroadcastJoinThreshold="-1"):
        ft = FixtureTables(spark, str(tmp_path))
        assert len(re.findall(r"(?m)^[ :+*()\d-]*Sort \[", physical(ft.base()))) == 2  # lineitem, orders
        rows = ft.stored()
    stored = spark.read.parquet(*rows.inputFiles())
    assert [c for c, t in stored.dtypes if t == "string"] == ["Utm_term"]
    kinds = Counter((r["leadid"], r["_kind"]) for r in rows.collect())
    # per lead of order 1, both copies of the order: line 1 in three rows, line 3 in one
    assert kinds == {(11, FIRST): 1, (18, RENEWAL): 1, (11, REPEATED): 5, (13, FIRST): 1, (13, REPEATED): 1, (24, FIRST): 1, (None, FIRST): 1}
    got = {(r["leadid"], r["_kind"]): r for r in rows.where("_kind <> 2").collect()}
    first, renewed, bare = got[11, FIRST], got[18, RENEWAL], got[24, FIRST]
    # the first row is that of the least part
    assert [str(first[c]) for c in ("TotalPremium", "APE", "Net Premium", "ODPremium", "TPPremium")] == ["10.00", "9.0000", "10.0000", "6.0000", "4.0000"]
    assert [first[c] for c in ("BookingMode", "Insurer Name", "BusinessType", "IsComplianceN", "PlanName", "SubProduct", "VehicleSubClass", "Leadsource")] == [
        "Offline", "Birla Cover", "NEW BUSINESS", "Yes", "Fire", None, "Car", "POS"]
    assert (renewed["BusinessType"], renewed["Status"], renewed["APE"]) == ("RENEWAL ", "Sale Complete", first["APE"])
    assert [bare[c] for c in ("TotalPremium", "APE", "Insurer Name", "Status", "IsComplianceN", "PlanName", "SubProduct", "Leadsource", "Utm_term")] == [
        None, None, None, "Booked", "Yes", None, "Private", "POS", None]
