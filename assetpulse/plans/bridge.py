"""Domain tables derived from the star-schema test tables (see FIXTURES.md, section 2).

Fact bridge: an asset is a supplier, its work and requests are line items. Screening bridge: an asset is
a customer, its work rows are events and its life events are orders. Every table is a projection of whole
input tables, so its size follows the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-06-30"
SCREEN_AS_OF = "2024-01-30"
#: Whole numbers, each with the bits it may need.
TIE_BREAK = [("order_id", 40), ("line", 6), ("part_id", 34), ("quantity", 12), ("price_cents", 33)]
FIRMWARE_TIE_BREAK = TIE_BREAK[:3]
_TIE = [
    "l_orderkey AS order_id",
    "l_linenumber AS line",
    "l_partkey AS part_id",
    "CAST(l_quantity AS BIGINT) AS quantity",
    "CAST(round(l_extendedprice * 100) AS BIGINT) AS price_cents",
]


class Bridge:
    """Reads the test tables under sf_dir and derives the domain tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """Each file's listing and footer is read once per bridge."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # ---- fact bridge ----

    def assets(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS customer_asset_identifier",
            "date_add(DATE'1995-01-01', CAST(s_suppkey * 37 % 2500 AS INT)) AS installed_date",
            "CASE WHEN s_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS active_status",
            "CAST(s_nationkey AS BIGINT) AS product_identifier",
            "concat('SN-', s_suppkey) AS serial_number",
            "1 + s_nationkey % 3 AS partner_id",
        )

    def assets_with_devices(self) -> DataFrame:
        """The master with device columns of its own."""
        nation = self.table("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS product_identifier", "n_name AS model_name", "100 * (n_nationkey + 1) AS capacity"
        )
        return self.assets().join(nation, "product_identifier")

    def daily_work(self) -> DataFrame:
        return (
            self.table("lineitem")
            .filter("l_returnflag = 'N'")
            .selectExpr(
                "l_suppkey AS customer_asset_identifier",
                "CAST(l_shipdate AS DATE) AS date",
                "CAST(l_quantity AS BIGINT) AS working_unit",
                *_TIE,
            )
        )

    def service_requests(self) -> DataFrame:
        return (
            self.table("lineitem")
            .filter("l_returnflag IN ('A', 'R')")
            .selectExpr(
                "l_suppkey AS customer_asset_identifier",
                "CAST(l_shipdate AS DATE) AS service_request_date",
                """CASE WHEN l_returnflag = 'A' AND l_quantity <= 4 THEN 'Preventative Maintenance'
                        WHEN l_returnflag = 'R' AND l_quantity >= 48 THEN 'Hardware Fault'
                        WHEN l_returnflag = 'R' AND l_quantity >= 46 THEN 'Paper Jam'
                        WHEN l_returnflag = 'A' AND l_quantity BETWEEN 5 AND 10 THEN 'Cleaning Supplies'
                        WHEN l_returnflag = 'A' THEN CASE CAST(l_quantity AS INT) % 6
                            WHEN 0 THEN 'Log Collection/Configuration' WHEN 1 THEN 'Installation/Integration'
                            WHEN 2 THEN 'Misrouted Call' WHEN 3 THEN 'Welcome Call' WHEN 4 THEN 'Serial Number Wrong' END
                   END AS incident_category""",
                "l_linestatus AS status",
                "CAST(l_linenumber AS STRING) AS priority",
                "concat('SN-', l_suppkey) AS serial_number",
            )
        )

    def error_events(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_suppkey AS customer_asset_identifier",
            "concat('SN-', l_suppkey) AS serial_number",
            "CAST(1 + l_suppkey % 3 AS INT) AS partner_id",
            "CAST(l_shipdate AS DATE) AS date",
            "concat('00:00:0', l_linenumber) AS time",
            "CAST(l_partkey % 320 AS INT) AS code_id",
            "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS code_type",
            "1 + l_linenumber % 3 AS criticality",
            "concat('code ', l_partkey % 320) AS description",
            "l_orderkey AS order_id",
        )

    def asset_features(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
            "CAST(n_nationkey AS BIGINT) AS product_identifier",
            "n_name AS model_name",
            "n_regionkey AS model_group_id",
            "r_name AS model_group_name",
            "n_regionkey % 2 AS category_id",
            "concat('CATEGORY_', n_regionkey % 2) AS category_name",
            "n_nationkey % 4 AS type_id",
            "concat('TYPE_', n_nationkey % 4) AS type_name",
            "100 * (n_nationkey + 1) AS capacity",
            "concat('SECURITY_', n_nationkey % 3) AS security_type",
        )

    def firmware(self) -> DataFrame:
        return (
            self.table("lineitem")
            .filter("l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity = 25")
            .selectExpr(
                "l_suppkey AS customer_asset_identifier",
                "l_linenumber AS firmware_version_id",
                "CAST(l_shipdate AS STRING) AS created_date",
                *_TIE,
            )
        )

    def fleet_life_events(self) -> DataFrame:
        """Status (2), log (3) and firmware (4) events of the fact bridge's assets. Most assets have a log event at install."""
        changes = (
            self.table("lineitem")
            .filter("(l_returnflag = 'A' AND l_linenumber >= 6) OR (l_returnflag = 'R' AND l_linenumber = 5 AND l_quantity > 40)")
            .selectExpr(
                "l_suppkey AS customer_asset_identifier",
                "CAST(l_shipdate AS DATE) AS date",
                "CASE l_linenumber WHEN 7 THEN 3 WHEN 6 THEN 2 ELSE 4 END AS life_event_code",
                """CAST(CASE WHEN l_linenumber = 5 THEN l_partkey % 50
                             WHEN l_linenumber = 7 AND (l_suppkey % 7 = 3 OR (l_suppkey % 7 IN (1, 5) AND l_partkey % 4 = 0)) THEN 2
                             WHEN l_linenumber = 6 AND l_suppkey % 10 = 4 AND l_partkey % 3 = 0 THEN 0
                             ELSE 1 END AS INT) AS life_event_value""",
            )
        )
        installed = self.assets().filter("customer_asset_identifier % 4 <> 2").selectExpr(
            "customer_asset_identifier",
            "installed_date AS date",
            "3 AS life_event_code",
            "CASE WHEN customer_asset_identifier % 7 = 3 THEN 2 ELSE 1 END AS life_event_value",
        )
        return changes.unionByName(installed)

    def service_orders(self) -> DataFrame:
        """Orders; the asset is the customer, so that some orders point outside the asset master."""
        return self.table("orders").selectExpr(
            "o_orderkey AS id",
            "o_custkey AS customer_asset_identifier",
            "CAST(o_orderdate AS DATE) AS service_order_created_on",
            "CAST(1 + o_orderkey % 5 AS INT) AS service_provider",
        )

    def field_activity(self) -> DataFrame:
        return self.table("lineitem").selectExpr(
            "l_orderkey AS field_service_order_id",
            "CASE WHEN l_quantity > 1 THEN CAST(l_suppkey AS DOUBLE) END AS field_technician_id",
            "concat('Technician ', l_suppkey) AS field_technician",
            "date_format(l_shipdate, 'yyyy-MM-dd') AS date_arrival",
        )

    def operational_days(self) -> DataFrame:
        return self.table("supplier").selectExpr("s_suppkey AS id", "explode(sequence(0, 6)) AS day").selectExpr(
            "id",
            "day",
            "CASE WHEN (id + day) % 3 = 0 THEN NULL WHEN (id + day) % 5 = 0 THEN -1.0D ELSE 8.0D END AS operational_hours",
        )

    def asset_information_source(self) -> DataFrame:
        customer, nation = self.table("customer"), self.table("nation")
        return customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
            "c_custkey AS customer_asset_identifier",
            "date_format(date_add(DATE'2023-12-20', CAST(c_custkey % 45 AS INT)), 'yyyy-MM-dd') AS install_date",
            "c_mktsegment AS model_name",
            "n_regionkey AS model_group_id",
            "n_regionkey % 2 AS category_id",
            "n_nationkey % 4 AS type_id",
            "100 * (n_nationkey + 1) AS capacity",
            "concat('REF-', c_nationkey) AS attribute_reference",
            "1 AS customer_id",
            "concat('SN-', c_custkey) AS Asset_serial_number",
            "n_name AS location_name",
            "c_name AS end_customer",
            "concat('PROVIDER_', n_regionkey) AS service_provider",
            "c_acctbal AS balance",
        )

    def error_code_source(self) -> DataFrame:
        return self.table("part").selectExpr(
            "1 AS customer_id",
            "CAST(p_partkey AS INT) AS code_id",
            "p_size % 5 AS priority",
            "1 + p_size % 2 AS code_type",
            "p_name AS description",
            "p_brand AS machine_code",
            "CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS include_in_priority_group",
            "p_retailprice AS price",
        )

    def security_map(self) -> DataFrame:
        """Lacks one security type, so that an unknown name occurs."""
        return (
            self.table("nation")
            .selectExpr("concat('SECURITY_', n_nationkey % 3) AS security_type", "n_nationkey % 3 + 1 AS id")
            .filter("id <= 2")
            .distinct()
        )

    def model_map(self) -> DataFrame:
        return self.table("nation").selectExpr("n_name AS model_name", "n_nationkey + 1 AS id")

    # ---- screening bridge ----

    def screen_assets(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey AS customer_asset_identifier",
            "date_add(DATE'2023-12-20', CAST(c_custkey % 45 AS INT)) AS installed_date",
            "CASE WHEN c_acctbal < 0 THEN 'Inactive' WHEN c_acctbal > 9500 THEN 'Unknown' ELSE 'Active' END AS active_status",
            "CAST(c_nationkey AS BIGINT) AS product_identifier",
            "concat('SN-', c_custkey) AS serial_number",
            "1 AS partner_id",
        )

    def screen_work(self) -> DataFrame:
        return self.table("events").selectExpr(
            "user_id AS customer_asset_identifier",
            "CAST(ts AS DATE) AS date",
            "CAST(value AS BIGINT) AS working_unit",
            "event_id",
        )

    def life_events(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_custkey AS customer_asset_identifier",
            "CAST(o_orderdate AS DATE) AS date",
            "CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 3 END AS life_event_code",
            """CASE WHEN o_orderstatus = 'O' THEN 1
                    WHEN o_orderstatus = 'F' THEN 2
                    WHEN o_orderpriority = '5-LOW' THEN 0
                    ELSE 1 END AS life_event_value""",
            """CASE WHEN o_orderstatus = 'O' THEN 'Daily'
                    WHEN o_orderstatus = 'F' THEN 'Manually'
                    ELSE 'Status' END AS life_event_description""",
        )
