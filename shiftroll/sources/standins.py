"""Legacy tables made from the star-schema sample tables.

The sample folders hold no payroll data.  Each method shapes whole sample
tables into one legacy table, so that the work of the operators grows with
the data.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftroll.functions.joins import lookup_join
from shiftroll.functions.scalars import employee_ref, iso_date, null_of
from shiftroll.operators.carry import DictionaryColumn
from shiftroll.session import materialise
from shiftroll.sources.tables import read_driver_table

CODE_BASE = 1000
USER_BASE = 100_000
CODETYPES = ["E", "D", "C", "B", "T", "H", "Y", "S", "J", "", "e"]
EXPORT_CODES = ["BASIC", "TRAVEL", "HOUSING", "CELL", "RA", "MEDICAL"]
EVENT_ORDINALS = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
EVENT_STATUS = {"error": "suspended", "purchase": "terminated"}
NO_DEPENDANTS_RULE = 7


def hundredths(col: str) -> Column:
    """Two-decimal double as a whole number of hundredths."""
    return F.floor(F.col(col) * 100 + 0.5)


def money(col: str) -> Column:
    """Two-decimal double as a decimal, without going through its text."""
    return (hundredths(col).cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast("decimal(12,2)")


def pick(values: list[str | None], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


class Standins:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        # with the schema given, no job looks into the files first
        return read_driver_table(self.spark, self.folder, name, SCHEMAS[name])

    # ---- employees -------------------------------------------------------

    def _order_days(self) -> DataFrame:
        return (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(
                F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day")
            )
        )

    def employees(self) -> DataFrame:
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("regionkey")
        )
        people = lookup_join(self.table("customer"), nations, ["c_nationkey"]).join(self._order_days(), "c_custkey", "left")
        key = F.col("c_custkey")
        nation = F.col("c_nationkey")
        country = F.when(nation % 4 == 3, F.substring("n_name", 1, 3)).otherwise(
            pick(["", "za", "ZAF", ""], nation % 4)
        )
        return people.select(
            F.concat(F.lit("co_"), "regionkey").alias("source_schema"),
            key.alias("employeeno"),
            (key + CODE_BASE).alias("employeeid_f01"),
            F.col("c_name").alias("surname_f02"),
            F.col("n_name").alias("givennames_f21"),
            (key + 800_000).alias("identity_f12"),
            F.date_sub("first_day", (F.lit(7000) + key % 5000).cast("int")).alias("birthdate_d930"),
            F.col("first_day").alias("engagedate_d931"),
            F.when(key % 5 == 0, F.col("last_day")).alias("dischargedate_d932"),
            pick(["Mr", "Ms", "Dr"], nation % 3).alias("title_f28"),
            F.col("c_mktsegment").alias("occupation_f11"),
            F.col("c_nationkey").cast("string").alias("category_f13"),
            country.alias("taxcountrycode_f14"),
            pick(["Male", "f", "", None], key % 4).alias("gender_f22"),
            F.when(key % 3 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("user"), key.cast("string"), F.lit("@example.org")))
            .alias("emailaddress_f40"),
            F.when(key % NO_DEPENDANTS_RULE == 0, F.lit(None))
            .otherwise(key % 70 - 5)
            .cast("int")
            .alias("taxdependants_f08"),
        )

    def loaded_employees(self, hired: bool = False) -> DataFrame:
        """Employees that reached the target: customers without debt."""
        rows = self.table("customer").filter(F.col("c_acctbal") >= 0).select("c_custkey")
        columns = [
            employee_ref("c_custkey").alias("id"),
            (F.col("c_custkey") + USER_BASE).alias("user_id"),
        ]
        if hired:
            rows = rows.join(self._order_days().select("c_custkey", "first_day"), "c_custkey", "left")
            columns.append(iso_date("first_day").alias("hired_at"))
        return rows.select(*columns)

    def known_employees(self) -> DataFrame:
        """Employee codes the target had before the run."""
        return self.table("supplier").select((F.col("s_suppkey") + CODE_BASE).cast("string").alias("employee_code"))

    def known_users(self) -> DataFrame:
        """User ids with rows in the target before the run."""
        return self.table("supplier").select((F.col("s_suppkey") + USER_BASE).alias("employee_id"))

    def employees_on_display(self) -> DataFrame:
        """Migrated employees, and others that the application created."""
        migrated = self.loaded_employees().withColumn("salary_current_minor", F.lit(0).cast("long"))
        native = self.table("supplier").select(
            F.concat(F.lit("app-"), F.col("s_suppkey").cast("string")).alias("id"),
            F.col("s_suppkey").alias("user_id"),
            hundredths("s_acctbal").alias("salary_current_minor"),
        )
        return migrated.unionByName(native)

    # ---- amounts ---------------------------------------------------------

    def _order_lines(self, *order_columns: str, lines: DataFrame | None = None) -> DataFrame:
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", *order_columns)
        return lookup_join(self.table("lineitem") if lines is None else lines, orders, ["l_orderkey"])

    def _priced(self, *columns: str) -> DataFrame:
        """Lines with their price and discount as one whole number, so that a shuffle carries no doubles."""
        product = hundredths("l_extendedprice") * hundredths("l_discount")
        return self.table("lineitem").select("l_orderkey", "l_partkey", *columns, product.alias("product"))

    def amounts(self) -> DataFrame:
        amount = F.col("product").cast("decimal(15,0)") * F.lit(Decimal("0.0001"))
        return self._order_lines(lines=self._priced()).select(
            F.col("o_custkey").alias("employeeno"),
            F.col("l_partkey").alias("ordinalno"),
            amount.cast("decimal(19,4)").alias("amount_q"),
        )

    def codes(self, description: Column | None = None, catalogued_only: bool = False) -> DataFrame:
        parts = self.table("part")
        if catalogued_only:
            parts = parts.filter(F.col("p_size") <= 45)
        key = F.col("p_partkey")
        return parts.select(
            key.alias("ordinalno"),
            (F.col("p_name") if description is None else description).alias("description"),
            pick(CODETYPES, key % len(CODETYPES)).alias("codetype"),
            F.col("p_brand").alias("currency_code"),
            money("p_retailprice").alias("codelimit"),
            F.col("p_type").alias("taxtype"),
            F.col("p_size").alias("taxincasn"),
            F.col("p_name").alias("consolcode"),
            (F.col("p_size") % 2).alias("adjustflag"),
            (F.col("p_size") > 25).alias("manualdisplayind"),
            (money("p_retailprice") > 1000).alias("prorataind"),
            F.when(F.col("p_type") != "ECONOMY", F.lit(True)).alias("qmfdisplayind"),
        )

    def catalogue(self) -> DataFrame:
        """Codes that the catalogue knows; the amounts use others too."""
        return self.codes(catalogued_only=True)

    def export_codes(self) -> DataFrame:
        return self.codes(pick(EXPORT_CODES, F.col("p_partkey") % len(EXPORT_CODES)), catalogued_only=True)

    def known_ordinals(self) -> DataFrame:
        return self.table("supplier").filter(F.col("s_suppkey") % 3 == 0).select(F.col("s_suppkey").alias("ordinal_no"))

    def known_amounts(self) -> DataFrame:
        """Keys that the targets of the keyed amounts had before the run."""
        first = self._order_lines().filter(F.col("l_linenumber") == 1)
        return first.select((F.col("o_custkey") + USER_BASE).alias("employee_id"), F.col("l_partkey").alias("ordinal_no"))

    # ---- slots -----------------------------------------------------------

    def slot_settings(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_size").alias("ordinalno"),
            F.col("p_name").alias("alphaname"),
            F.col("p_brand").alias("description"),
            F.col("p_type").alias("codetype"),
            F.col("p_retailprice").cast("decimal(19,4)").alias("codelimit"),
        )

    def slots(self) -> DataFrame:
        ordinal = F.lit(None)
        for name, number in EVENT_ORDINALS.items():
            ordinal = F.when(F.col("event_type") == name, F.lit(number)).otherwise(ordinal)
        return self.table("events").select(
            F.col("user_id").alias("employeeno"),
            ordinal.cast("int").alias("ordinalno"),
            F.col("props").alias("reference_v"),
            F.col("ts").cast("date").alias("date_d0"),
            F.col("value").cast("decimal(19,10)").alias("amount_m"),
        )

    def known_slots(self) -> DataFrame:
        return self.known_users().withColumn("ordinal_no", F.lit(1))

    def thirdparty_payments(self) -> DataFrame:
        return self._order_lines().select(
            F.col("o_custkey").alias("employeeno"),
            F.col("l_linenumber").alias("ordinalno"),
            F.concat(F.lit("AG"), F.col("l_suppkey").cast("string")).alias("agentkey"),
            money("l_tax").alias("agenthandlingfee"),
            F.col("l_returnflag").alias("agenthandlingfeetype"),
            money("l_discount").alias("employerhandlingfee"),
            F.col("l_linestatus").alias("employerhandlingfeetype"),
            money("l_extendedprice").alias("monthlydeductionamount"),
            (F.col("l_returnflag") == "R").alias("stopindicator"),
            F.col("l_shipdate").cast("date").alias("thirdpartydate"),
            F.concat(F.lit("REF"), F.col("l_orderkey").cast("string")).alias("thirdpartyreference"),
        )

    # ---- accounts, calendar ----------------------------------------------

    def accounts(self) -> DataFrame:
        key = F.col("o_orderkey")
        status = F.col("o_orderstatus")
        return self.table("orders").select(
            F.col("o_custkey").alias("employeeno"),
            key.alias("ordinalno"),
            F.when(status == "O", F.lit("")).otherwise(status).alias("accounttype_g1"),
            F.col("o_orderpriority").alias("accountname_g2"),
            key.cast("string").alias("accountnumber_g3"),
            F.when(status != "F", F.concat(F.lit("B"), F.col("o_custkey").cast("string"))).alias("branchcode_g4"),
            pick(["", "usd", "zarx"], key % 3).alias("accountcurrency_g10"),
            status.alias("paymode_g0"),
            F.col("o_orderpriority").alias("sourcebankaccount_g5"),
            null_of("string").alias("splitpaycode_g6"),
            null_of("string").alias("accountholderstatus_g7"),
            (key % 2 == 0).alias("sarsbankaccount_g8"),
            null_of("string").alias("accountiban_g9"),
        )

    def known_accounts(self) -> DataFrame:
        return self.table("events").select(
            (F.col("user_id") + USER_BASE).alias("employee_id"), F.col("event_id").alias("ordinal_no")
        )

    def calendar(self) -> DataFrame:
        """Legacy calendar: one row per month with orders."""
        months = self.table("orders").groupBy(F.last_day("o_orderdate").alias("rundate")).agg(
            F.count(F.lit(1)).cast("int").alias("daysinperiod")
        )
        return months.select(
            (F.year("rundate") * 12 + F.month("rundate")).alias("ordinalno"),
            "daysinperiod",
            "rundate",
            F.month("rundate").alias("taxmonth"),
            F.year("rundate").alias("taxperiod"),
        )

    def payrolls(self) -> DataFrame:
        return self.table("region").select(
            (F.col("r_regionkey") + 1).alias("id"), F.substring("r_name", 1, 2).alias("country_code")
        )

    def known_periods(self, payroll_id: int) -> DataFrame:
        """The first year's periods exist already."""
        return (
            self.table("orders")
            .filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz"))
            .select(F.lit(payroll_id).alias("payroll_id"), iso_date(F.last_day("o_orderdate")).alias("period_end"))
            .distinct()
        )

    # ---- routes ----------------------------------------------------------

    def route_rows(self) -> DataFrame:
        """One route per supplier; companies repeat."""
        key = F.col("s_nationkey")
        return self.table("supplier").select(
            F.concat(F.lit("co_"), key).alias("legacy_company_schema"),
            F.concat(F.lit("pay_"), key).alias("legacy_payroll_schema"),
            F.concat(F.lit("t"), F.col("s_suppkey").cast("string")).alias("tenant_slug"),
            (key + 1).alias("target_payroll_id"),
            F.lit(1).alias("legacy_payroll_number"),
        )

    def region_routes(self) -> DataFrame:
        """One route per region, for the companies of ``employees``."""
        key = F.col("r_regionkey")
        return self.table("region").select(
            F.concat(F.lit("co_"), key).alias("legacy_company_schema"),
            F.concat(F.lit("pay_"), key).alias("legacy_payroll_schema"),
            F.lower("r_name").alias("tenant_slug"),
            (key + 1).alias("target_payroll_id"),
            (key + 10).alias("legacy_payroll_number"),
        )

    def companies(self) -> DataFrame:
        """Company of each employee."""
        return lookup_join(
            self.table("customer").select("c_custkey", "c_nationkey"),
            self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"),
            ["c_nationkey"],
        ).select(F.col("c_custkey").alias("employeeno"), F.concat(F.lit("co_"), "n_regionkey").alias("source_schema"))

    def tenant_amounts(self) -> DataFrame:
        """Amounts with the company of their employee."""
        return lookup_join(self.amounts(), self.companies(), ["employeeno"])

    # ---- companies that share a tenant -----------------------------------

    def shared_routes(self) -> DataFrame:
        """Two tenants for the companies of all regions."""
        slug = F.concat(F.lit("shared_"), (F.col("legacy_payroll_number") % 2).cast("string"))
        return self.region_routes().withColumn("tenant_slug", slug)

    def _supplier_companies(self) -> DataFrame:
        nations = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
        return lookup_join(self.table("supplier").select("s_suppkey", "s_nationkey"), nations, ["s_nationkey"]).select(
            F.col("s_suppkey").alias("l_suppkey"), "n_regionkey"
        )

    def shared_amounts(self) -> DataFrame:
        """Amounts with the company that pays them, the supplier's; an employee has amounts in several."""
        amount = F.col("product").cast("decimal(15,0)") * F.lit(Decimal("0.0001"))
        lines = lookup_join(self._priced("l_suppkey"), self._supplier_companies(), ["l_suppkey"]).drop("l_suppkey")
        return self._order_lines(lines=lines).select(
            F.concat(F.lit("co_"), "n_regionkey").alias("source_schema"),
            F.col("o_custkey").alias("employeeno"),
            F.col("l_partkey").alias("ordinalno"),
            amount.cast("decimal(19,4)").alias("amount_q"),
        )

    def shared_codes(self) -> DataFrame:
        """Each company's catalogue: of the codes it uses four in five, with types of its own."""
        used = lookup_join(self.table("lineitem").select("l_suppkey", "l_partkey"), self._supplier_companies(), ["l_suppkey"])
        # written, as the lookups ask for sizes and frequent keys of what comes of it
        used = materialise(used.select("n_regionkey", F.col("l_partkey").alias("ordinalno")).distinct())
        own = used.filter(F.col("ordinalno") % 5 != F.col("n_regionkey"))
        named = lookup_join(own, self.codes(catalogued_only=True).drop("codetype"), ["ordinalno"])
        kind = pick(CODETYPES, (F.col("ordinalno") + F.col("n_regionkey")) % len(CODETYPES))
        company = F.concat(F.lit("co_"), "n_regionkey")
        return named.select(company.alias("source_schema"), *[c for c in named.columns if c != "n_regionkey"], kind.alias("codetype"))

    def shared_slots(self) -> DataFrame:
        """Slots that several companies fill for the same employee."""
        events = self.table("events").select("event_id", F.col("user_id").alias("employeeno"), "props")
        return events.select(
            F.concat(F.lit("co_"), F.col("event_id") % 5).alias("source_schema"),
            "employeeno",
            (F.col("event_id") % 7).cast("int").alias("ordinalno"),
            F.concat(F.col("props"), (F.lit(9) - F.col("event_id") % 5).cast("string")).alias("reference_v"),
        )

    def company_banks(self) -> list[DataFrame]:
        """Banks of the companies, which differ in columns: the even ones know the country, the odd ones a fee."""
        companies = self.companies().select(F.col("employeeno").alias("c_custkey"), "source_schema")
        rows = lookup_join(self.table("customer"), companies, ["c_custkey"]).select(
            "source_schema",
            F.concat(F.lit("B"), F.col("c_nationkey") % 4).alias("branchcode"),
            F.col("c_mktsegment").alias("bankname"),
            F.col("c_name").alias("branchname"),
            F.col("c_nationkey").cast("string").alias("countrycode"),
            F.when(F.col("c_acctbal") > 0, hundredths("c_acctbal")).alias("fee"),
        )
        even = F.substring("source_schema", 4, 9).cast("int") % 2 == 0
        return [rows.filter(even).drop("fee"), rows.filter(~even).drop("countrycode")]

    def company_run_history(self) -> DataFrame:
        """Runs with their company, and a column that no target has."""
        history = self.table("orders").select(
            F.year("o_orderdate").alias("runyear"),
            F.month("o_orderdate").alias("runperiod"),
            F.col("o_custkey").alias("employeeno"),
            F.lit(1).alias("payroll"),
            F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("backpay"),
        )
        return lookup_join(history, self.companies(), ["employeeno"])

    # ---- carried tables --------------------------------------------------

    def run_history(self) -> DataFrame:
        day = F.col("o_orderdate")
        return self.table("orders").select(
            F.year(day).alias("runyear"),
            F.month(day).alias("runperiod"),
            F.col("o_custkey").alias("employeeno"),
            day.cast("date").alias("rundate"),
            F.lit(1).alias("payroll"),
            F.col("o_orderpriority").alias("costcode"),
            F.col("o_orderstatus").alias("taxcode"),
            (F.col("o_custkey") + CODE_BASE).cast("string").alias("employeeid"),
        )

    def run_history_amounts(self) -> DataFrame:
        return self._order_lines("o_orderdate").select(
            F.year("o_orderdate").alias("runyear"),
            F.month("o_orderdate").alias("runperiod"),
            F.col("o_custkey").alias("employeeno"),
            F.col("l_partkey").alias("ordinalno"),
            F.col("l_linenumber").alias("usageid"),
            F.col("l_returnflag").alias("codename"),
            F.col("l_linestatus").alias("codetype"),
            money("l_extendedprice").alias("amount"),
        )

    def banks(self) -> DataFrame:
        return self.table("customer").select(
            F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("branchcode"),
            F.col("c_mktsegment").alias("bankname"),
            F.col("c_name").alias("branchname"),
            F.col("c_nationkey").cast("string").alias("countrycode"),
        )

    def increments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("autonumber"),
            F.col("o_custkey").alias("employeeno"),
            F.col("o_orderdate").cast("date").alias("date_d8"),
            money("o_totalprice").alias("amount_u"),
        )

    def report_calcs(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_suppkey").alias("reportno"),
            F.col("l_partkey").alias("ordinalno"),
            F.col("l_returnflag").alias("calctime"),
            F.col("l_linestatus").alias("op1a"),
            F.col("l_linenumber").alias("op1n"),
            F.col("l_quantity").cast("int").alias("op2n"),
        )

    def currencies(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_nationkey").alias("payroll"),
            F.col("c_mktsegment").alias("country_code"),
            F.col("c_name").alias("currency_code1"),
            money("c_acctbal").alias("currency_exchange"),
        )

    def uif_companies(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_nationkey").alias("uifcono"),
            F.concat(F.col("s_name"), F.lit("@example.org")).alias("contactemail"),
            F.col("s_suppkey").cast("string").alias("taxno"),
            F.col("s_name").alias("tradingname"),
        )

    def table_values(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_size").alias("ordinalno"), F.col("p_partkey").alias("row"), F.col("p_name").alias("item")
        )

    def tax_audit(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("autonumber"),
            F.col("event_type").alias("breakkey"),
            F.col("user_id").alias("employeeno"),
            F.hour("ts").alias("linenr"),
            F.col("props").alias("printline"),
            F.substring("event_type", 1, 1).alias("reportsection"),
            F.col("ts").cast("date").alias("rundate"),
        )

    def rates(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("autonumber"),
            F.col("p_brand").alias("code"),
            F.col("p_name").alias("description"),
            F.col("p_retailprice").cast("decimal(19,10)").alias("ratevalue"),
        )

    def split_codes(self) -> DataFrame:
        return self.table("customer").select(F.col("c_mktsegment").alias("splitpaycode"))

    def thirdparty_transactions(self) -> DataFrame:
        return self._order_lines("o_orderdate").select(
            F.col("o_custkey").alias("employeeno"),
            F.col("l_orderkey").alias("transseqno"),
            money("l_extendedprice").alias("amount"),
            F.col("l_linenumber").alias("classno"),
            F.col("l_returnflag").alias("code"),
            F.col("o_orderdate").cast("date").alias("datevalue"),
            F.col("l_suppkey").alias("user_id"),
        )

    def run_texts(self) -> DataFrame:
        return self.slots().select(
            F.year("date_d0").alias("runyear"),
            F.month("date_d0").alias("runperiod"),
            "employeeno",
            "ordinalno",
            F.col("reference_v").alias("reference"),
        )

    # ---- effective-dated rows --------------------------------------------

    def dated_rows(self) -> DataFrame:
        other = F.col("event_type")
        status = F.lit("active")
        for name, word in EVENT_STATUS.items():
            status = F.when(other == name, F.lit(word)).otherwise(status)
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("user_id").alias("employee_id"),
            F.when(other == "signup", F.lit(2)).otherwise(F.lit(1)).alias("payroll_id"),
            status.alias("status"),
            iso_date("ts").alias("effective_from"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("recorded_at"),
        )

    def pending_transactions(self) -> DataFrame:
        return self.table("orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("employee_id"))

    def facts(self) -> DataFrame:
        return self._order_lines().select(
            F.col("o_custkey").alias("employee_id"),
            F.col("l_returnflag").alias("code"),
            hundredths("l_extendedprice").alias("amount_minor"),
        )

    def ledger(self) -> DataFrame:
        return self.table("events").select(
            F.col("user_id").alias("employee_id"),
            F.col("event_type").alias("code"),
            hundredths("value").alias("amount_minor"),
        )


def _columns(text: str) -> list[DictionaryColumn]:
    parts = [item.split() for item in text.replace("\n", " ").split(",") if item.strip()]
    return [DictionaryColumn(p[0], p[1], int(p[2]) if len(p) > 2 else 0) for p in parts]


# Dictionary entries of the carried tables that the sample tables can feed.
# name, type, place in the key
DICTIONARY: dict[str, tuple[str, list[DictionaryColumn]]] = {
    "run_history": (
        "payroll",
        _columns(
            "RunYear SMALLINT 1, RunPeriod SMALLINT 2, EmployeeNo INTEGER 3, RunDate DATE, BirthDate DATE, "
            "EngageDate DATE, DischargeDate DATE, EmployeeId TEXT, Surname TEXT, Initials TEXT, Payroll INTEGER, "
            "CostCode TEXT, TaxCode TEXT, Occupation TEXT, StopPay BOOLEAN, Category TEXT, Gender TEXT, "
            "TaxDependants INTEGER"
        ),
    ),
    "run_history_amounts": (
        "payroll",
        _columns(
            "RunYear SMALLINT 1, RunPeriod SMALLINT 2, EmployeeNo INTEGER 3, OrdinalNo INTEGER 4, UsageId INTEGER 5, "
            "CodeName TEXT, CodeType TEXT, Amount MONEY"
        ),
    ),
    "settings_calendar": (
        "payroll",
        _columns(
            "OrdinalNo INTEGER 1, ClearConcostfInd BOOLEAN, ClearConfInd BOOLEAN, DaysInPeriod INTEGER, "
            "PayPeriodFrom DATE, PayPeriodTo DATE, RunDate DATE, RunDoneInd BOOLEAN, RunInMonth SMALLINT, "
            "RunsInMonth SMALLINT, TaxMonth SMALLINT, TaxPeriod SMALLINT"
        ),
    ),
    "settings_banks": (
        "company",
        _columns(
            "BranchCode TEXT 1, BankName TEXT, BranchAddr1 TEXT, BranchAddr2 TEXT, BranchAddr3 TEXT, "
            "BranchAddr4 TEXT, BranchName TEXT, CountryCode TEXT, BankSwiftCode TEXT"
        ),
    ),
    "employee_increments": (
        "company",
        _columns("AutoNumber AUTO_KEY 1, EmployeeNo INTEGER, Date_D8 DATE, Amount_U MONEY"),
    ),
    "settings_report_calcs": (
        "company",
        _columns(
            "Payroll INTEGER 1, ReportNo INTEGER 2, OrdinalNo INTEGER 3, CalcTime TEXT, IndNo INTEGER, IndVal TEXT, "
            "Op1A TEXT, Op1N INTEGER, Op2A TEXT, Op2N INTEGER, Op3A TEXT, Op3N INTEGER, OpCode TEXT"
        ),
    ),
    "settings_currency": (
        "company",
        _columns(
            "Payroll INTEGER 1, Country_Code TEXT, Currency_Code1 TEXT, Currency_Code2 TEXT, "
            "Currency_Exchange ACCURATE, Currency_Exchange_Buy ACCURATE, Currency_Exchange_Sell ACCURATE, "
            "Tax_Currency_Code TEXT"
        ),
    ),
    "settings_zaf_uif_company": (
        "company",
        _columns("UifCoNo INTEGER, ContactEmail TEXT, TaxNo TEXT, TradingName TEXT, UifNo TEXT"),
    ),
    "settings_split_payment_code": ("company", _columns("SplitPayCode TEXT 1")),
    "employee_thirdparty_transact": (
        "company",
        _columns(
            "EmployeeNo INTEGER 1, TransSeqNo INTEGER 2, Amount MONEY, ClassNo SMALLINT, Code TEXT, CostCode TEXT, "
            "DateValue DATE, User_Id INTEGER"
        ),
    ),
    "run_history_alpha": (
        "payroll",
        _columns(
            "RunYear SMALLINT 1, RunPeriod SMALLINT 2, EmployeeNo INTEGER 3, OrdinalNo INTEGER 4, Reference TEXT, "
            "RefName TEXT"
        ),
    ),
    "settings_table_values": ("payroll", _columns("OrdinalNo INTEGER 1, Row INTEGER 2, Item TEXT")),
    "pay_run_tax_audit": (
        "payroll",
        _columns(
            "AutoNumber AUTO_KEY 1, BreakKey TEXT, EmployeeNo INTEGER, LineNr INTEGER, BreakKeyDescr TEXT, "
            "PageNr INTEGER, PrintLine TEXT, ReportSection BOOLEAN, RunDate DATE"
        ),
    ),
    "ratef": (
        "payroll",
        _columns(
            "AutoNumber AUTO_KEY 1, Code TEXT, DateValue DATE, CostCode TEXT, Description TEXT, "
            "EffectiveDate DATE, RateValue ACCURATE"
        ),
    ),
}
