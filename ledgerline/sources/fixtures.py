"""Test catalog derived from the supplied star-schema tables.

The reports need insurance tables (bookings, partners, referrals, ...). The test data
is a TPC-H-like star schema (lineitem, orders, customer). This module derives every
logical table from it with the DataFrame API, deterministically, so reports run at any
scale factor and an independent SQL oracle can derive the same rows. The derivation
rules are the ones written down in FIXTURES.md section 2.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .catalog import Catalog, write_bookings


def case_map(expr: Column, mapping: dict, default=None) -> Column:
    """SQL ``CASE expr WHEN k THEN v ... ELSE default END``."""
    out = None
    for k, v in mapping.items():
        out = F.when(expr == F.lit(k), F.lit(v)) if out is None else out.when(expr == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default))


def _dec(c: Column, p: int, s: int) -> Column:
    return c.cast(f"decimal({p},{s})")


def twice(rows: DataFrame, condition: str) -> DataFrame:
    """The rows, those that meet the condition a second time, in one pass."""
    return rows.withColumn("_copy", F.expr(f"explode(CASE WHEN {condition} THEN array(0, 1) ELSE array(0) END)")).drop("_copy")


#: Kinds of stored bookings.
FIRST, RENEWAL, REPEATED = range(3)
#: Amounts stored as their share of the premium (few values, so a small column) and multiplied where they are read.
SHARES = ("APE", "Net Premium", "ODPremium", "TPPremium")
#: Texts stored as a small number: what the numbers stand for, and the text of all others.
TEXTS = {
    "BookingMode": ({0: "Online", 1: "Offline", 2: "offline", 3: "Online"}, None),
    "Insurer Name": ({
        0: "National Insurance Co", 1: "The Oriental", 2: "united india",
        3: "New India Assurance", 4: "Future Sompo", 5: "IFFCO General", 6: "LIC India",
        7: "SBI Cover", 8: "HDFC Cover", 9: "BAJAJ Cover", 10: "Axis Cover",
        11: "Birla Cover", 12: "Acme Cover",
    }, None),
    "BusinessType": ({
        0: "Fresh Booking", 1: "New", 2: "NEW BUSINESS", 3: "Rollover", 4: "New Port",
        5: "Renewal", 6: "renewal", 8: "RENEWAL ",
    }, None),
    "Status": ({2: "Policy Issued", 3: "Sale Complete", 5: "Soft Copy Received", 7: "Refunded", 8: "Rejected"}, "Booked"),
    "IsComplianceN": ({0: "No"}, "Yes"),
    "PlanName": ({0: "Group Gratuity Plan", 1: "Employee group cover", 2: "Fire"}, None),
    "SubProduct": ({0: "Taxi", 1: None, 2: None}, "Private"),
    "VehicleSubClass": ({0: "Taxi"}, "Car"),
    "Leadsource": ({0: "B2CMRP", 1: None}, "POS"),
}


class FixtureTables:
    """Lazily derived fixture relations over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._memo: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _once(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    # -- base ---------------------------------------------------------------
    def base(self) -> DataFrame:
        """lineitem joined to its order, with derived keys; duplicates kept, ``rn`` 1 for the
        first row of an (order, line) by the listed columns.

        Lines and orders are numbered before they meet, so that the order of rows that numbers them serves the join
        too: lineitem is shuffled and sorted once."""

        def build():
            l = self._read("lineitem").select(
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
            ).repartition("l_orderkey")
            o = self._read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
            lines = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
                "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                "l_shipdate", "l_discount", "l_tax", "l_returnflag",
            )
            orders = Window.partitionBy("o_orderkey").orderBy("o_orderdate", "o_custkey")
            l = l.withColumn("_line", F.row_number().over(lines))
            o = o.withColumn("_order", F.row_number().over(orders))
            return l.join(o, l.l_orderkey == o.o_orderkey, "inner").select(
                *l.columns[:-1], *o.columns[:-1],
                F.expr("_line + _order - 1 AS rn"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("leadid"),
                ((F.col("l_partkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_suppkey")) % 18).alias("k_prod"),
                ((F.col("l_orderkey") + F.col("l_partkey")) % 9).alias("k_stat"),
                F.col("l_quantity").cast("int").alias("qty"),
            )

        return self._once("base", build)

    # -- relations ------------------------------------------------------------
    def stored(self) -> DataFrame:
        """Every booking that the tables derive from, with its ``_kind``: the first of a lead, the renewal
        of a first one, or another row of a lead.

        All tables but the partners' derive from these rows, each with other columns, so that Spark would
        join, sort and derive them again for every reference. They are derived in one pass and stored once, amounts as
        shares of the premium and texts as numbers (a reference makes those it reads), under the shared checkpoint folder, when a table is first asked for."""

        def build():
            b = self.base()
            price = _dec(F.col("l_extendedprice"), 12, 2)
            code = F.concat(F.lit("IP"), (F.col("o_custkey") % 40).cast("string"))
            b = b.select(
                "rn",
                F.col("leadid"),
                F.when(F.col("l_linenumber") == 3, F.lower(code)).otherwise(code).alias("Utm_term"),
                case_map(F.col("k_prod"), {
                    0: 186, 1: 186, 2: 187, 3: 188, 4: 7, 5: 115, 6: 200, 7: 193, 8: 194,
                    9: 221, 10: 190, 11: 190, 12: 130, 13: 224, 14: 3, 15: 118, 16: 106,
                }, 187).alias("ProductId"),
                price.alias("TotalPremium"),
                _dec(1 - F.col("l_discount"), 3, 2).alias("APE"),
                _dec(1 - F.col("l_tax"), 3, 2).alias("Net Premium"),
                _dec(F.lit(0.6), 2, 1).alias("ODPremium"),
                _dec(F.lit(0.4), 2, 1).alias("TPPremium"),
                case_map(F.col("qty") % 4, {0: 0, 1: 1, 2: 3}, None).cast("int").alias("ODTerm"),
                case_map(F.col("l_partkey") % 5, {0: 0, 1: 1, 2: 3}, 5).alias("TPTerm"),
                (F.col("l_orderkey") % 5).alias("BookingMode"),
                ((F.col("l_suppkey") + F.col("l_partkey")) % 14).alias("Insurer Name"),
                ((F.col("l_orderkey") + F.col("l_linenumber")) % 8).alias("BusinessType"),
                case_map(F.col("k_stat"), {0: 13, 1: 39, 2: 41, 3: 42, 4: 43, 5: 44, 6: 77, 7: 50}, 51).alias("StatusId"),
                F.col("k_stat").alias("Status"),
                F.when(F.col("l_returnflag") == "R", F.lit(0)).alias("IsComplianceN"),
                (F.col("l_partkey") % 4).alias("PlanName"),
                (F.col("qty") % 6).alias("SubProduct"),
                (F.col("l_suppkey") % 4).alias("VehicleSubClass"),
                (F.col("qty") % 11).alias("Leadsource"),
                (F.col("o_orderdate") + F.expr("INTERVAL 10 HOURS")).alias("BookingDate"),
                F.col("l_shipdate").alias("PolicyStartDate"),
                F.when(F.col("l_suppkey") % 2 == 0, F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS"))
                .otherwise(F.col("l_shipdate") - F.expr("INTERVAL 120 DAYS")).alias("PolicyEndDate"),
            )
            kinds = f"CASE WHEN rn > 1 THEN array({REPEATED}) WHEN leadid % 10 = 1 THEN array({FIRST}, {RENEWAL}) ELSE array({FIRST}) END"
            changed = {
                "leadid": "leadid + 7",
                "ProductId": "CASE leadid % 30 WHEN 1 THEN 130 WHEN 11 THEN 190 ELSE 224 END",
                "BusinessType": "CASE WHEN leadid % 4 = 1 THEN 5 ELSE 8 END",
                "StatusId": "CASE leadid % 40 WHEN 1 THEN 41 WHEN 11 THEN 42 WHEN 21 THEN 43 ELSE 44 END",
                "Status": "CASE leadid % 40 WHEN 1 THEN 2 WHEN 11 THEN 3 WHEN 21 THEN 0 ELSE 5 END",
                "BookingDate": "PolicyEndDate + INTERVAL '1' DAY * CAST(leadid % 191 - 95 AS INT) + INTERVAL '10' HOUR",
                "PolicyStartDate": "PolicyEndDate",
                "PolicyEndDate": "PolicyEndDate + INTERVAL '365' DAY",
            }
            columns = [c for c in b.columns if c != "rn"]
            kept = {c: f"CASE WHEN _kind = {RENEWAL} THEN {changed[c]} ELSE {c} END" if c in changed else f"`{c}`" for c in columns}
            rows = stage(b.selectExpr("*", f"explode({kinds}) AS _kind").selectExpr("_kind", *[
                f"CAST({e} AS TINYINT) AS `{c}`" if c in TEXTS else f"{e} AS `{c}`" for c, e in kept.items()]), "bookings")
            return rows.withColumns(
                {c: _dec(F.col("TotalPremium") * F.col(f"`{c}`"), 18, 4) for c in SHARES}
                | {c: case_map(F.col(f"`{c}`"), texts, other).cast("string") for c, (texts, other) in TEXTS.items()})

        return self._once("stored", build)

    def first_bookings(self) -> DataFrame:
        return self.stored().where(f"_kind = {FIRST}").drop("_kind")

    def bookings(self) -> DataFrame:
        """The first bookings, and for line 1 of each order a renewal of that booking
        around the end of its policy."""
        return self._once("bookings", lambda: self.stored().where(f"_kind <> {REPEATED}").drop("_kind"))

    def booking_details(self) -> DataFrame:
        insured = case_map(F.col("leadid") % 5, {0: 300000, 1: 500000, 2: 750000, 3: 1000000}, None).cast("int")
        # a second row with another sum for every 11th lead
        return self.bookings().where(F.col("leadid") % 10 != 7).select(
            F.col("leadid").alias("LEADID"),
            F.col("ProductId").alias("ProductID"),
            F.explode(F.when(F.col("leadid") % 11 == 0, F.array(insured, F.lit(250000))).otherwise(F.array(insured)))
            .alias("SumInsured"),
            (F.col("leadid") % 6).cast("int").alias("PlanId"),
            (F.col("leadid") % 3).cast("int").alias("SupplierId"),
            F.col("APE").alias("BasicPremium"),
            case_map(F.col("leadid") % 4, {0: "Single", 1: "single pay"}, "Annual").alias("PaymentPeriodicity"),
            F.col("BookingDate").alias("issuanceDate"),
        )

    def verification(self) -> DataFrame:
        # from the un-deduplicated rows: repeated lead ids on purpose (fan-out case)
        return self.stored().where(F.expr(f"_kind <> {RENEWAL}") & (F.col("leadid") % 10).isin(1, 2, 3, 4)).select(
            F.col("leadid").alias("LeadId"),
            case_map(F.col("leadid") % 3, {0: "Verified", 1: "verification done"}, "Pending").alias("VerificationStatus"),
        )

    def contest(self) -> DataFrame:
        p = F.col("ProductId")
        out = self.bookings().where(F.col("leadid") % 13 == 0).select(
            F.col("leadid").alias("MatrixLeadId"),
            F.when(p.isin(186, 187, 188), F.lit("Motor"))
            .when(p.isin(7, 115, 200), F.lit("life"))
            .when(p.isin(193, 194, 221), F.lit("SME"))
            .otherwise(F.lit("Health")).alias("product"),
            F.col("BookingDate").cast("date").alias("ContestMonth"),
            F.when(F.col("leadid") % 3 == 0, F.lit(0)).otherwise(F.lit(1)).alias("IsActive"),
        )
        return twice(out, "MatrixLeadId % 26 = 0")

    def partners(self) -> DataFrame:
        def build():
            k = F.col("c_custkey")
            return self._read("customer").select(
                F.when(k % 17 == 0, F.concat(F.lit("XX"), k.cast("string")))
                .otherwise(F.concat(F.lit("IP"), k.cast("string"))).alias("PartnerCode"),
                F.when(k % 4 == 0, F.lit("No")).otherwise(F.lit("Yes")).alias("SellNowEnabled"),
                F.when(k % 3 == 0, F.lit("No")).otherwise(F.lit("Yes")).alias("ComplianceCertified"),
                case_map(k % 9, {
                    0: "Region A", 1: "Region B", 2: "Others", 3: "Fleets", 4: "prime", 5: "Institutional",
                    6: "Strategic Motor", 7: None,
                }, "Region C").cast("string").alias("Markettype"),
                case_map(k % 5, {0: "PRIME", 1: "VRM", 2: "Fleets", 3: "Retail"}, "Others").alias("SalesCat"),
                case_map(k % 4, {0: "Health Team 1", 1: "Life Team", 2: "Motor Team"}, None)
                .cast("string").alias("NH_NAME"),
                F.col("c_name").alias("PartnerName"),
            )

        return self._once("partners", build)

    def partner_directory(self) -> DataFrame:
        none = F.lit(None).cast("string")
        return self.partners().select(
            "PartnerCode", "PartnerName",
            none.alias("RMCode"), none.alias("RMName"),
            F.col("Markettype").alias("MarketType"),
            none.alias("PartnerPhoneNumber"), none.alias("PartnerEmailId"),
            "ComplianceCertified", "SellNowEnabled", "SalesCat", "NH_NAME",
        )

    def inclusion(self) -> DataFrame:
        k = F.col("c_custkey")
        return self._read("customer").where(k % 7 == 0).select(
            F.concat(F.lit("IP"), k.cast("string")).alias("PartnerCode"))

    def lead_referral(self) -> DataFrame:
        l = F.col("leadid")
        out = self.bookings().where((l % 10 <= 6) & (l % 8 != 0)).select(
            (l + 1).alias("LeadID"), l.alias("ReferralID"))
        # the renewals refer to the booking they renew, every third one twice
        renewed = self.first_bookings().where("leadid % 10 = 1").selectExpr("leadid + 7 AS LeadID", "leadid AS ReferralID")
        return out.unionByName(renewed).unionByName(renewed.where("ReferralID % 3 = 0"))

    def business_type(self) -> DataFrame:
        l = F.col("leadid")
        out = self.bookings().where(l % 10 != 5).select(
            l.alias("Leadid"),
            case_map(l % 4, {0: "New", 1: "Rollover", 2: "Renewal"}, None).cast("string").alias("MotorBusinessType"),
        )
        return twice(out, "Leadid % 12 = 1")

    def status(self) -> DataFrame:
        rows = [(13, "Booked"), (39, "Payment Done"), (41, "Policy Issued"), (42, "Sale Complete"),
                (43, "Docs Awaited"), (44, "Soft Copy Received"), (77, "Inspection"), (50, "Refunded"),
                (51, "rejected")]
        return self.spark.createDataFrame(rows, "StatusId int, StatusName string").coalesce(1)

    def life_plans(self) -> DataFrame:
        # every (plan, product, supplier) combination; plan 5 listed twice on purpose
        rows = [(plan, prod, sup, "ULIP" if plan == 5 else "Term")
                for plan, prod, sup in itertools.product((0, 1, 2, 3, 5, 5), (7, 115, 200), (0, 1, 2))]
        return self.spark.createDataFrame(rows, "PlanID int, ProductID int, SupplierID int, PayoutProdCat string") \
            .coalesce(1)

    def pay_term(self) -> DataFrame:
        l = F.col("leadid")
        out = self.bookings().where(l % 10 != 6).select(l.alias("LeadId"), (l % 7).cast("int").alias("PayTerm"))
        return twice(out, "LeadId % 9 = 0")

    def partner_quarter(self) -> DataFrame:
        o = self._read("orders")
        m = F.month("o_orderdate")
        total = F.sum(_dec(F.col("o_totalprice"), 12, 2))
        return (
            o.groupBy(
                F.concat(F.lit("IP"), F.col("o_custkey").cast("string")).alias("PartnerCode"),
                F.year("o_orderdate").cast("int").alias("CalendarYear"),
                F.when(m <= 3, F.lit("Q1-JFM")).when(m <= 6, F.lit("Q2-AMJ"))
                .when(m <= 9, F.lit("Q3-JAS")).otherwise(F.lit("Q4-OND")).alias("Quarter"),
            )
            .agg(total.alias("_t"))
            .select(
                "PartnerCode", "CalendarYear", "Quarter",
                F.when(F.col("_t") >= 150000, F.lit("Crown")).when(F.col("_t") >= 60000, F.lit("Gold"))
                .otherwise(F.lit("Base")).alias("Tier"),
                _dec(F.col("_t") * 30, 18, 2).alias("WeightedNet"),
            )
        )

    def catalog(self) -> Catalog:
        names = ("bookings", "booking_details", "verification", "contest", "partners", "partner_directory",
                 "inclusion", "lead_referral", "business_type", "status", "life_plans", "pay_term",
                 "partner_quarter")
        return Catalog(self.spark, {n: getattr(self, n) for n in names})


def fixture_catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return FixtureTables(spark, sf_dir).catalog()


def write_fixture_tables(spark: SparkSession, sf_dir: str, root: str, partition_fact: bool = False) -> None:
    """Store every derived table as ``{root}/{name}`` parquet.

    The bookings table feeds most other tables, so it is written first and the rest is
    derived from the stored copy (one pass over lineitem/orders instead of one per
    table)."""
    ft = FixtureTables(spark, sf_dir)
    if partition_fact:
        write_bookings(ft.bookings(), f"{root}/bookings")
    else:
        # several files also of a small table, as a large one has
        ft.bookings().repartition(spark.sparkContext.defaultParallelism, "leadid").write.mode("overwrite").parquet(f"{root}/bookings")
    ft._memo["bookings"] = spark.read.parquet(f"{root}/bookings")
    cat = ft.catalog()
    for n in cat.names():
        if n != "bookings":
            cat.table(n).write.mode("overwrite").parquet(f"{root}/{n}")
