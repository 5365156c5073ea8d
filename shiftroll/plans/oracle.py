"""The queries of ``registry`` as SQL on the same sample tables."""

from __future__ import annotations

CUTOVER = "2000-03-15T08:00:00+02:00"
PAYDAY = "2024-01-15"

# Legacy tables made from the sample tables, with what each one builds on.
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "order_days": (
        (),
        """SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
        FROM orders GROUP BY o_custkey""",
    ),
    "loaded": (
        ("order_days",),
        """SELECT 'emp-' || c_custkey AS id, c_custkey + 100000 AS user_id, CAST(first_day AS VARCHAR) AS hired_at
        FROM customer LEFT JOIN order_days ON o_custkey = c_custkey WHERE c_acctbal >= 0""",
    ),
    "order_lines": ((), "SELECT * FROM lineitem JOIN orders ON o_orderkey = l_orderkey"),
    "line_amounts": (
        ("order_lines",),
        """SELECT o_custkey, l_partkey,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(19,4)) AS amount
        FROM order_lines""",
    ),
    "part_types": (
        (),
        """SELECT *, CASE p_partkey % 11 WHEN 0 THEN 'E' WHEN 1 THEN 'D' WHEN 2 THEN 'C' WHEN 3 THEN 'B' WHEN 4 THEN 'T'
          WHEN 5 THEN 'H' WHEN 6 THEN 'Y' WHEN 7 THEN 'S' WHEN 8 THEN 'J' WHEN 10 THEN 'E' END AS codetype FROM part""",
    ),
    "staged": (
        ("line_amounts", "part_types", "loaded"),
        """SELECT CAST(o_custkey AS VARCHAR) AS legacy_empno, user_id AS employee_id, hired_at, l_partkey AS ordinal_no,
          p_name AS name, CAST(round(amount * 100) AS BIGINT) AS amount_minor, amount AS amount_raw, codetype
        FROM line_amounts LEFT JOIN part_types ON p_partkey = l_partkey AND p_size <= 45
        LEFT JOIN loaded ON user_id = o_custkey + 100000 WHERE NOT (amount = 0)""",
    ),
    "routed": (
        ("staged",),
        """SELECT *, CASE WHEN employee_id IS NULL THEN 'employee_not_loaded'
          WHEN codetype IS NULL THEN 'codetype_not_found' WHEN codetype = 'E' THEN 'earnings'
          WHEN codetype = 'D' THEN 'deductions' WHEN codetype = 'C' THEN 'employer_cost'
          WHEN codetype IN ('B', 'T') THEN 'balances' WHEN codetype = 'Y' THEN 'ytd_takeon'
          ELSE 'deprecated' END AS destination FROM staged""",
    ),
    "staged_employees": (
        ("order_days",),
        """SELECT CAST(c_custkey AS VARCHAR) AS legacy_empno, CAST(c_custkey + 1000 AS VARCHAR) AS employee_code,
          c_name AS last_name, n_name AS first_name, CAST(c_custkey + 800000 AS VARCHAR) AS id_number,
          CAST(first_day - CAST(7000 + c_custkey % 5000 AS INTEGER) AS VARCHAR) AS date_of_birth,
          CAST(first_day AS VARCHAR) AS hired_at,
          CASE WHEN c_custkey % 5 = 0 THEN CAST(last_day AS VARCHAR) END AS terminated_at,
          CASE c_nationkey % 3 WHEN 0 THEN 'Mr' WHEN 1 THEN 'Ms' ELSE 'Dr' END AS title,
          c_mktsegment AS occupation, CAST(c_nationkey AS VARCHAR) AS category, 'unspecified' AS marital_status,
          1 AS currency, CASE c_nationkey % 4 WHEN 1 THEN 'ZA' WHEN 2 THEN 'ZAF' WHEN 3 THEN substr(n_name, 1, 3) END
            AS nationality_country_code,
          CASE c_custkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' ELSE 'unspecified' END AS gender,
          CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 1000 || '@migrated.invalid'
            ELSE 'user' || c_custkey || '@example.org' END AS email,
          c_custkey, c_nationkey, 'co_' || n_regionkey AS source_schema
        FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN order_days ON o_custkey = c_custkey""",
    ),
    "minted": (
        ("staged_employees",),
        """SELECT *, row_number() OVER (ORDER BY legacy_empno) AS mint_rank,
          (SELECT max(s_suppkey) + 100000 FROM supplier) + row_number() OVER (ORDER BY legacy_empno) AS user_id
        FROM staged_employees""",
    ),
    "known_slots": ((), "SELECT s_suppkey + 100000 AS employee_id, 1 AS ordinal_no FROM supplier"),
    "leg_slots": (
        (),
        """SELECT user_id AS employeeno, CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2
          WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END AS INTEGER) AS ordinalno,
          props AS reference_v, CAST(ts AS DATE) AS date_d0, CAST(value AS DECIMAL(19,10)) AS amount_m FROM events""",
    ),
    "linked_slots": (
        ("leg_slots", "loaded", "known_slots"),
        """SELECT e.user_id AS employee_id, s.ordinalno AS ordinal_no, s.reference_v, CAST(s.date_d0 AS VARCHAR)
          AS date_text, s.amount_m FROM leg_slots s JOIN loaded e ON e.user_id = s.employeeno + 100000
        WHERE NOT EXISTS (SELECT 1 FROM known_slots k WHERE k.employee_id = e.user_id AND k.ordinal_no = s.ordinalno)""",
    ),
    "routes": (
        (),
        """SELECT 'co_' || r_regionkey AS source_schema, 'tenant_' || lower(r_name) AS tenant,
          r_regionkey + 1 AS target_payroll_id FROM region""",
    ),
    "tenant_minted": (
        ("staged_employees", "routes"),
        """SELECT *, row_number() OVER (PARTITION BY tenant ORDER BY legacy_empno) AS mint_rank,
          100000 + row_number() OVER (ORDER BY tenant, legacy_empno) AS user_id
        FROM staged_employees JOIN routes USING (source_schema)""",
    ),
    "tenant_staged": (
        ("staged", "staged_employees", "routes"),
        """SELECT r.tenant, s.* FROM staged s JOIN staged_employees e ON e.legacy_empno = s.legacy_empno
        JOIN routes r USING (source_schema)""",
    ),
    "shared_codes": (
        ("part_types",),
        """SELECT 'tenant_shared_' || (g.r_regionkey % 2) AS tenant, 'co_' || g.r_regionkey AS origin, g.r_regionkey,
          CASE (p_partkey + g.r_regionkey) % 11 WHEN 0 THEN 'E' WHEN 1 THEN 'D' WHEN 2 THEN 'C' WHEN 3 THEN 'B'
            WHEN 4 THEN 'T' WHEN 5 THEN 'H' WHEN 6 THEN 'Y' WHEN 7 THEN 'S' WHEN 8 THEN 'J' WHEN 10 THEN 'E' END AS code_type,
          p.* EXCLUDE (codetype) FROM part_types p JOIN region g ON p_partkey % 5 <> g.r_regionkey WHERE p_size <= 45""",
    ),
    "used_codes": (
        ("shared_codes",),
        """SELECT * FROM shared_codes WHERE (r_regionkey, p_partkey) IN (SELECT n_regionkey, l_partkey FROM lineitem
          JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)""",
    ),
    "at_home": (
        ("loaded",),
        """SELECT loaded.*, n_regionkey FROM loaded JOIN customer ON c_custkey + 100000 = user_id
          JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "shared_staged": (
        ("used_codes", "at_home", "order_lines"),
        """SELECT 'tenant_shared_' || (sn.n_regionkey % 2) AS tenant, 'co_' || sn.n_regionkey AS origin,
          e.user_id AS employee_id, e.hired_at, l_partkey AS ordinal_no, c.p_name AS name, c.code_type AS codetype,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(19,4)) AS amount_raw
        FROM order_lines JOIN supplier ON s_suppkey = l_suppkey JOIN nation sn ON sn.n_nationkey = s_nationkey
        LEFT JOIN used_codes c ON c.r_regionkey = sn.n_regionkey AND c.p_partkey = l_partkey
        LEFT JOIN at_home e ON e.user_id = o_custkey + 100000 AND e.n_regionkey % 2 = sn.n_regionkey % 2
        WHERE l_discount <> 0 AND l_extendedprice <> 0""",
    ),
    "shared_routed": (
        ("shared_staged",),
        """SELECT *, CAST(round(amount_raw * 100) AS BIGINT) AS amount_minor,
          CASE WHEN employee_id IS NULL THEN 'employee_not_loaded'
          WHEN codetype IS NULL THEN 'codetype_not_found' WHEN codetype = 'E' THEN 'earnings'
          WHEN codetype = 'D' THEN 'deductions' WHEN codetype = 'C' THEN 'employer_cost'
          WHEN codetype IN ('B', 'T') THEN 'balances' WHEN codetype = 'Y' THEN 'ytd_takeon'
          ELSE 'deprecated' END AS destination FROM shared_staged""",
    ),
    "keyed": (
        ("routed",),
        """SELECT r.*, k.employee_id IS NOT NULL AS held, row_number() OVER (
          PARTITION BY destination, r.employee_id, r.ordinal_no
          ORDER BY CASE WHEN destination = 'balances' THEN amount_raw ELSE amount_minor END, codetype, amount_minor,
            amount_raw) AS nth,
          first_value(amount_raw) OVER (PARTITION BY destination, r.employee_id, r.ordinal_no
          ORDER BY CASE WHEN destination = 'balances' THEN amount_raw ELSE amount_minor END, codetype, amount_minor,
            amount_raw) AS first_raw
        FROM routed r LEFT JOIN (SELECT DISTINCT o_custkey + 100000 AS employee_id, l_partkey AS ordinal_no
          FROM order_lines WHERE l_linenumber = 1) k
        ON k.employee_id = r.employee_id AND k.ordinal_no = r.ordinal_no AND r.destination <> 'employer_cost'
        WHERE destination IN ('employer_cost', 'balances', 'deprecated')""",
    ),
    "dated_rows": (
        (),
        """SELECT event_id AS id, user_id AS employee_id, CASE event_type WHEN 'signup' THEN 2 ELSE 1 END AS payroll_id,
          CASE event_type WHEN 'error' THEN 'suspended' WHEN 'purchase' THEN 'terminated' ELSE 'active' END AS status,
          CAST(CAST(ts AS DATE) AS VARCHAR) AS effective_from, strftime(ts, '%Y-%m-%d %H:%M:%S') AS recorded_at
        FROM events""",
    ),
    "snapshot": (
        ("dated_rows",),
        f"""SELECT * FROM dated_rows WHERE effective_from <= '{PAYDAY}'
        QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY effective_from DESC, recorded_at DESC, id DESC) = 1""",
    ),
    "work": (
        ("snapshot",),
        """SELECT employee_id FROM snapshot WHERE payroll_id = 1
        UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'""",
    ),
    "facts": (
        ("order_lines",),
        """SELECT o_custkey AS employee_id, l_returnflag AS code,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS amount_minor FROM order_lines""",
    ),
    "ledger": (
        (),
        """SELECT user_id AS employee_id, event_type AS code,
          CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT) AS amount_minor FROM events""",
    ),
    "fact_totals": (
        ("facts",),
        """SELECT employee_id, code, CAST(sum(amount_minor) AS BIGINT) AS amount_minor FROM facts
        GROUP BY employee_id, code""",
    ),
    "increments": (
        ("loaded",),
        """SELECT o_orderkey AS id, user_id AS employee_id, CAST(o_orderdate AS DATE) AS date_d8,
          CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(19,4)) AS amount_u
        FROM orders JOIN loaded ON user_id = o_custkey + 100000""",
    ),
    "rates": (
        (),
        """SELECT CAST(1 AS INTEGER) AS payroll, p_partkey AS id, p_brand AS code, CAST(NULL AS DATE) AS date_value,
          CAST(NULL AS VARCHAR) AS cost_code, p_name AS description, CAST(NULL AS DATE) AS effective_date,
          CAST(p_retailprice AS DECIMAL(19,10)) AS rate_value FROM part""",
    ),
}


def _needed(views: tuple[str, ...], seen: list[str]) -> list[str]:
    for view in views:
        _needed(_VIEWS[view][0], seen)
        if view not in seen:
            seen.append(view)
    return seen


def _sql(views: tuple[str, ...], body: str) -> str:
    """``body`` on top of the views it needs; it may begin with ``, more AS (...)``."""
    parts = [f"{v} AS ({_VIEWS[v][1]})" for v in _needed(views, [])]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def _first(keys: str, order: list[str]) -> str:
    """Keep the smallest row per key."""
    ordering = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {ordering}) = 1"


def _lines(destination: str, marks: str, base: str) -> str:
    return f"""SELECT {base} + row_number() OVER (ORDER BY employee_id, ordinal_no, amount_raw) AS id, employee_id,
      name AS label, amount_minor, {marks}, hired_at AS effective_from, '{CUTOVER}' AS recorded_at,
      7 AS created_by_user_id, CAST(NULL AS VARCHAR) AS ended_at, name AS payroll_code
    FROM routed WHERE destination = '{destination}'"""


def _quarantine(reason: str) -> str:
    return f"""SELECT 'tenant_sample' AS tenant, legacy_empno, name AS code, codetype, amount_minor,
      '{reason}' AS reason, '{CUTOVER}' AS loaded_at FROM routed WHERE destination = '{reason}'"""


_EMPLOYEE_COLUMNS = f"""'emp-' || legacy_empno AS id, user_id, employee_code, first_name, last_name, email, id_number,
      hired_at, terminated_at, CAST(0 AS BIGINT) AS salary_current_minor, currency, '{CUTOVER}' AS created_at,
      date_of_birth, gender, title, nationality_country_code, marital_status, CAST(NULL AS VARCHAR) AS preferred_name,
      occupation, category"""

_HISTORY = """SELECT {scope} user_id, k.step, k.status, k.effective_from FROM {rows},
      LATERAL (SELECT 1 AS step, 'active' AS status, hired_at AS effective_from
        UNION ALL SELECT 2, 'terminated', terminated_at) k WHERE k.effective_from IS NOT NULL"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["stage_employees"] = _sql(("staged_employees",), "SELECT * EXCLUDE (c_custkey, c_nationkey, source_schema) FROM staged_employees")
    sql["mint_users"] = _sql(
        ("minted",),
        f"""SELECT user_id AS id, email, '!migrated-no-login' AS password_hash, first_name, last_name, 1 AS is_active,
        '{CUTOVER}' AS created_at FROM minted""",
    )
    sql["mint_idmap"] = _sql(("minted",), "SELECT legacy_empno, user_id FROM minted")
    sql["attach_ids"] = _sql(
        ("staged_employees", "loaded"),
        """SELECT s.legacy_empno, e.user_id, s.employee_code, s.hired_at
        FROM staged_employees s JOIN loaded e ON e.user_id = c_custkey + 100000""",
    )
    sql["build_employees"] = _sql(
        ("minted",),
        f"""SELECT {_EMPLOYEE_COLUMNS} FROM minted
        WHERE employee_code NOT IN (SELECT CAST(s_suppkey + 1000 AS VARCHAR) FROM supplier)""",
    )
    sql["build_contracts"] = _sql(
        ("minted",),
        f"""SELECT (SELECT max(event_id) FROM events) + row_number() OVER (ORDER BY user_id) AS id,
        user_id AS employee_id, 'monthly' AS rate_type, CAST(0 AS BIGINT) AS rate_minor, currency,
        CAST(40.00 AS DECIMAL(5,2)) AS hours_per_week, CAST(NULL AS BIGINT) AS org_unit_id,
        hired_at AS effective_from, '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id FROM minted""",
    )
    sql["build_assignments"] = _sql(
        ("minted",),
        f"""SELECT row_number() OVER (ORDER BY user_id) AS id, user_id AS employee_id, 1 AS payroll_id,
        hired_at AS effective_from, '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id FROM minted""",
    )
    sql["build_status"] = _sql(
        ("minted",),
        f"""SELECT row_number() OVER (ORDER BY user_id, step) AS id, user_id AS employee_id, status, effective_from,
        '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id FROM ({_HISTORY.format(scope="", rows="minted")})""",
    )
    sql["import_catalogue"] = _sql(
        ("part_types",),
        """SELECT p_partkey AS ordinal_no, p_name AS name, codetype AS code_type, p_brand AS currency_code,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS code_limit_minor, p_type AS tax_type,
        p_size AS tax_inc_asn, p_name AS consol_code, p_size % 2 AS adjust_flag,
        CAST(p_size > 25 AS INTEGER) AS manual_display,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) > 1000 AS INTEGER) AS prorata,
        CAST(p_type <> 'ECONOMY' AS INTEGER) AS qmf_display
        FROM part_types WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0)""",
    )
    sql["stage_amounts"] = _sql(("staged",), "SELECT * FROM staged")
    sql["route_amounts"] = _sql(
        ("routed",), "SELECT legacy_empno, employee_id, ordinal_no, codetype, amount_minor, destination FROM routed"
    )
    sql["route_earnings"] = _sql(("routed",), _lines("earnings", "1 AS taxable, 1 AS uif_applicable", "0"))
    sql["route_deductions"] = _sql(
        ("routed",), _lines("deductions", "0 AS reduces_taxable", "(SELECT max(p_partkey) FROM part)")
    )
    keys = "employee_id, ordinal_no"
    sql["route_employer_cost"] = _sql(
        ("routed",),
        f"""SELECT {keys}, amount_minor FROM routed WHERE destination = 'employer_cost'
        {_first(keys, ["amount_minor"])}""",
    )
    sql["route_balances"] = _sql(
        ("routed",),
        f"""SELECT {keys}, amount_raw AS amount FROM routed WHERE destination = 'balances'
        {_first(keys, ["amount_raw"])}""",
    )
    sql["route_ytd"] = _sql(
        ("routed",),
        f"""SELECT 'tenant_sample' AS tenant, employee_id, legacy_empno, name AS code, amount_minor,
        '{CUTOVER}' AS loaded_at FROM routed WHERE destination = 'ytd_takeon'""",
    )
    sql["route_deprecated"] = _sql(
        ("routed",),
        f"""SELECT {keys}, amount_minor, codetype FROM routed WHERE destination = 'deprecated'
        {_first(keys, ["amount_minor", "codetype"])}""",
    )
    sql["quarantine_unknown"] = _sql(("routed",), _quarantine("codetype_not_found"))
    sql["quarantine_orphans"] = _sql(("routed",), _quarantine("employee_not_loaded"))
    summary = "count(*) AS row_count, CAST(sum(amount_minor) AS BIGINT) AS amount_minor"
    sql["routing_summary"] = _sql(
        ("routed",), f"SELECT destination, codetype, {summary} FROM routed GROUP BY destination, codetype"
    )
    sql["routing_conservation"] = _sql(
        ("keyed",),
        """, fates AS (
          SELECT destination, codetype, amount_minor, CASE WHEN nth = 1 AND NOT held THEN 1 ELSE 0 END AS added FROM keyed
          UNION ALL SELECT destination, codetype, amount_minor, 1 FROM routed
          WHERE destination NOT IN ('employer_cost', 'balances', 'deprecated'))
        SELECT destination, codetype, count(*) AS staged_rows, CAST(sum(added) AS BIGINT) AS added_rows,
          CAST(sum(1 - added) AS BIGINT) AS skipped_rows, CAST(sum(amount_minor) AS BIGINT) AS staged_minor,
          CAST(sum(added * amount_minor) AS BIGINT) AS added_minor,
          CAST(sum((1 - added) * amount_minor) AS BIGINT) AS skipped_minor
        FROM fates GROUP BY destination, codetype""",
    )
    sql["skipped_amounts"] = _sql(
        ("keyed",),
        """SELECT destination, employee_id, ordinal_no, codetype, amount_minor, amount_raw,
          count(*) AS skipped_rows, CASE WHEN held THEN 'target' ELSE 'batch' END AS held_by,
          CASE WHEN NOT held THEN first_raw END AS held_amount
        FROM keyed WHERE held OR nth > 1 GROUP BY ALL""",
    )
    sql["refresh_salary"] = _sql(
        ("routed",),
        """SELECT l.id, l.user_id, CAST(coalesce(sum(r.amount_minor), 0) AS BIGINT) AS salary_current_minor
        FROM loaded l LEFT JOIN routed r ON r.employee_id = l.user_id AND r.destination = 'earnings'
        GROUP BY l.id, l.user_id
        UNION ALL SELECT 'app-' || s_suppkey, s_suppkey, CAST(CAST(s_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT)
        FROM supplier""",
    )
    slots = ["salary", "allowance_travel", "allowance_housing", "allowance_cell", "deduction_retirement", "deduction_medical"]
    columns = ", ".join(
        f"""CAST(round(coalesce(sum(amount) FILTER (WHERE p_partkey % 6 = {i}), 0) * 100) AS BIGINT) AS {slot}_minor"""
        for i, slot in enumerate(slots)
    )
    sql["export_import_rows"] = _sql(
        ("staged_employees", "line_amounts"),
        f"""SELECT c_custkey + 1000 AS employee_code, first_name, last_name, email, hired_at,
        c_custkey + 800000 AS id_number,
        CASE c_nationkey % 4 WHEN 2 THEN 'ZAF' WHEN 3 THEN substr(first_name, 1, 3) ELSE 'ZA' END AS currency, {columns}
        FROM staged_employees LEFT JOIN line_amounts ON o_custkey = c_custkey
        LEFT JOIN part ON p_partkey = l_partkey AND p_size <= 45
        GROUP BY c_custkey, c_nationkey, first_name, last_name, email, hired_at""",
    )
    sql["export_import_csv"] = sql["export_import_rows"]
    sql["quarantine_report"] = _sql(
        ("routed",), f"{_quarantine('codetype_not_found')} UNION ALL {_quarantine('employee_not_loaded')}"
    )
    sql["import_alpha_settings"] = f"""SELECT p_size AS ordinal_no, p_name AS name FROM part
        WHERE p_size NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0) {_first("p_size", ["p_name"])}"""
    sql["import_date_settings"] = f"""SELECT p_size AS ordinal_no, p_brand AS name FROM part
        {_first("p_size", ["p_brand"])}"""
    sql["import_precision_settings"] = f"""SELECT p_size AS ordinal_no, p_brand AS name, p_type AS code_type,
        CAST(p_retailprice AS DECIMAL(19,4)) AS limit_value FROM part
        {_first("p_size", ["p_brand", "p_type", "p_retailprice"])}"""
    for name, column in (("alpha", "reference_v"), ("dates", "date_text"), ("precision", "amount_m")):
        sql[f"import_{name}"] = _sql(
            ("linked_slots",),
            f"SELECT {keys}, {column} AS value FROM linked_slots {_first(keys, [column])}",
        )
    sql["import_thirdparty"] = _sql(
        ("order_lines", "loaded", "known_slots"),
        f""", linked AS (SELECT user_id AS employee_id, l_linenumber AS ordinal_no, 'AG' || l_suppkey AS agent_key,
          CAST(CAST(l_tax AS DECIMAL(12,2)) * 100 AS BIGINT) AS agent_handling_fee_minor,
          l_returnflag AS agent_handling_fee_type,
          CAST(CAST(l_discount AS DECIMAL(12,2)) * 100 AS BIGINT) AS employer_handling_fee_minor,
          l_linestatus AS employer_handling_fee_type,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS monthly_deduction_amount_minor,
          CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS stop_indicator,
          CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS third_party_date, 'REF' || l_orderkey AS third_party_reference
          FROM order_lines JOIN loaded ON user_id = o_custkey + 100000)
        SELECT * FROM linked l
        WHERE NOT EXISTS (SELECT 1 FROM known_slots k WHERE k.employee_id = l.employee_id
          AND k.ordinal_no = l.ordinal_no)
        {_first(keys, ["agent_key", "agent_handling_fee_minor", "agent_handling_fee_type", "employer_handling_fee_minor",
                       "employer_handling_fee_type", "monthly_deduction_amount_minor", "stop_indicator",
                       "third_party_date", "third_party_reference"])}""",
    )
    sql["import_bank_details"] = _sql(
        ("loaded",),
        f"""SELECT (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY user_id, o_orderkey) AS id,
        user_id AS employee_id, o_orderkey AS ordinal_no,
        CASE WHEN o_orderstatus = 'O' THEN 'unknown' ELSE o_orderstatus END AS account_type,
        o_orderpriority AS account_name, CAST(o_orderkey AS VARCHAR) AS account_number,
        CASE WHEN o_orderstatus <> 'F' THEN 'B' || o_custkey ELSE '' END AS bank_sort_code,
        CAST(NULL AS VARCHAR) AS swift_code,
        CASE o_orderkey % 3 WHEN 1 THEN 'USD' ELSE 'ZAR' END AS currency, o_orderstatus AS pay_mode,
        o_orderpriority AS source_bank_account, CAST(NULL AS VARCHAR) AS split_pay_code,
        CAST(NULL AS VARCHAR) AS account_holder_status, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END
          AS sars_bank_account, CAST(NULL AS VARCHAR) AS iban, '{CUTOVER}' AS effective_from,
        '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id
        FROM orders JOIN loaded ON user_id = o_custkey + 100000
        WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.user_id + 100000 = loaded.user_id
          AND b.event_id = o_orderkey)""",
    )
    sql["build_tax_status"] = _sql(
        ("staged_employees", "loaded"),
        f"""SELECT user_id AS employee_id, CASE WHEN c_nationkey % 4 = 3 THEN 0 ELSE 1 END AS resident,
        CAST(CASE WHEN c_custkey % 7 = 0 OR c_custkey % 70 < 5 THEN 0 WHEN c_custkey % 70 > 55 THEN 50
          ELSE c_custkey % 70 - 5 END AS INTEGER) AS dependent_count, 0 AS disability, 'derived' AS age_band,
        s.hired_at AS effective_from, '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id
        FROM staged_employees s JOIN loaded ON user_id = c_custkey + 100000
        WHERE user_id NOT IN (SELECT s_suppkey + 100000 FROM supplier)""",
    )
    sql["build_periods"] = f"""WITH calendar AS (SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS run_date FROM orders),
        known AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS run_date FROM orders WHERE o_orderdate < '1996-01-01')
        SELECT 1 AS payroll_id, CAST(CAST(date_trunc('month', run_date) AS DATE) AS VARCHAR) AS period_start,
        CAST(run_date AS VARCHAR) AS period_end, CAST(run_date AS VARCHAR) AS payday,
        substr(r_name, 1, 2) AS country_code,
        CASE WHEN run_date < DATE '2000-03-01' THEN 'closed' ELSE 'open' END AS status,
        '{CUTOVER}' AS created_at, 'regular' AS period_kind
        FROM calendar JOIN region ON r_regionkey + 1 = 1
        WHERE run_date NOT IN (SELECT run_date FROM known)"""
    sql.update(_carried())
    sql.update(_schema_tools())
    sql.update(_tenants(summary))
    sql.update(_shared())
    sql.update(_pay_run())
    return sql


def _carried() -> dict[str, str]:
    null_text = "CAST(NULL AS VARCHAR)"
    null_date = "CAST(NULL AS DATE)"
    null_int = "CAST(NULL AS INTEGER)"
    null_flag = "CAST(NULL AS BOOLEAN)"
    null_small = "CAST(NULL AS SMALLINT)"
    sql: dict[str, str] = {}
    keys = "run_year, run_period, employee_id"
    sql["carry_run_history"] = _sql(
        ("loaded",),
        f"""SELECT CAST(year(o_orderdate) AS SMALLINT) AS run_year, CAST(month(o_orderdate) AS SMALLINT) AS run_period,
        user_id AS employee_id, CAST(o_orderdate AS DATE) AS run_date, {null_date} AS birth_date,
        {null_date} AS engage_date, {null_date} AS discharge_date, CAST(o_custkey + 1000 AS VARCHAR) AS employee_code,
        {null_text} AS surname, {null_text} AS initials, CAST(1 AS INTEGER) AS payroll, o_orderpriority AS cost_code,
        o_orderstatus AS tax_code, {null_text} AS occupation, {null_flag} AS stop_pay, {null_text} AS category,
        {null_text} AS gender, {null_int} AS tax_dependants
        FROM orders JOIN loaded ON user_id = o_custkey + 100000
        {_first(keys, ["run_date", "cost_code", "tax_code"])}""",
    )
    keys = "payroll, run_year, run_period, employee_id, ordinal_no, usage_id"
    sql["carry_run_history_amounts"] = _sql(
        ("order_lines", "loaded"),
        f"""SELECT CAST(1 AS INTEGER) AS payroll, CAST(year(o_orderdate) AS SMALLINT) AS run_year,
        CAST(month(o_orderdate) AS SMALLINT) AS run_period, user_id AS employee_id,
        CAST(l_partkey AS INTEGER) AS ordinal_no, l_linenumber AS usage_id, l_returnflag AS code_name,
        l_linestatus AS code_type, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(19,4)) AS amount
        FROM order_lines JOIN loaded ON user_id = o_custkey + 100000
        {_first(keys, ["code_name", "code_type", "amount"])}""",
    )
    sql["carry_settings_calendar"] = f"""SELECT CAST(1 AS INTEGER) AS payroll,
        CAST(year(day) * 12 + month(day) AS INTEGER) AS ordinal_no, {null_flag} AS clear_concostf_ind,
        {null_flag} AS clear_conf_ind, days_in_period, {null_date} AS pay_period_from, {null_date} AS pay_period_to,
        day AS run_date, {null_flag} AS run_done_ind, {null_small} AS run_in_month, {null_small} AS runs_in_month,
        CAST(month(day) AS SMALLINT) AS tax_month, CAST(year(day) AS SMALLINT) AS tax_period
        FROM (SELECT last_day(CAST(o_orderdate AS DATE)) AS day, CAST(count(*) AS INTEGER) AS days_in_period
          FROM orders GROUP BY 1)"""
    sql["carry_settings_banks"] = f"""SELECT c_nationkey || '-' || c_mktsegment AS branch_code, c_mktsegment AS bank_name,
        {null_text} AS branch_addr1, {null_text} AS branch_addr2, {null_text} AS branch_addr3,
        {null_text} AS branch_addr4, c_name AS branch_name, CAST(c_nationkey AS VARCHAR) AS country_code,
        {null_text} AS bank_swift_code FROM customer {_first("branch_code", ["bank_name", "branch_name", "country_code"])}"""
    sql["carry_employee_increments"] = _sql(("increments",), "SELECT * FROM increments")
    keys = "payroll, report_no, ordinal_no"
    sql["carry_settings_report_calcs"] = f"""SELECT CAST(1 AS INTEGER) AS payroll, CAST(l_suppkey AS INTEGER) AS report_no,
        CAST(l_partkey AS INTEGER) AS ordinal_no, l_returnflag AS calc_time, {null_int} AS ind_no,
        {null_text} AS ind_val, l_linestatus AS op1_a, l_linenumber AS op1_n, {null_text} AS op2_a,
        CAST(l_quantity AS INTEGER) AS op2_n, {null_text} AS op3_a, {null_int} AS op3_n, {null_text} AS op_code
        FROM lineitem {_first(keys, ["calc_time", "op1_a", "op1_n", "op2_n"])}"""
    null_rate = "CAST(NULL AS DECIMAL(19,10))"
    sql["carry_settings_currency"] = f"""SELECT c_nationkey AS payroll, c_mktsegment AS country_code,
        c_name AS currency_code1, {null_text} AS currency_code2,
        CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(19,10)) AS currency_exchange,
        {null_rate} AS currency_exchange_buy, {null_rate} AS currency_exchange_sell, {null_text} AS tax_currency_code
        FROM customer {_first("payroll", ["country_code", "currency_code1", "currency_exchange"])}"""
    sql["carry_settings_zaf_uif_company"] = f"""SELECT s_nationkey AS uif_co_no,
        s_name || '@example.org' AS contact_email, CAST(s_suppkey AS VARCHAR) AS tax_no, s_name AS trading_name,
        {null_text} AS uif_no FROM supplier"""
    sql["carry_settings_table_values"] = """SELECT CAST(1 AS INTEGER) AS payroll, p_size AS ordinal_no,
        CAST(p_partkey AS INTEGER) AS row_no, p_name AS item FROM part"""
    sql["carry_pay_run_tax_audit"] = _sql(
        ("loaded",),
        f"""SELECT CAST(1 AS INTEGER) AS payroll, event_id AS id, event_type AS break_key, l.user_id AS employee_id,
        CAST(hour(ts) AS INTEGER) AS line_nr, {null_text} AS break_key_descr, {null_int} AS page_nr,
        props AS print_line, substr(event_type, 1, 1) AS report_section, CAST(ts AS DATE) AS run_date
        FROM events v JOIN loaded l ON l.user_id = v.user_id + 100000""",
    )
    sql["carry_ratef"] = _sql(("rates",), "SELECT * FROM rates")
    sql["carry_ratef_again"] = _sql(
        ("rates",), "SELECT * FROM rates WHERE id NOT IN (SELECT s_suppkey FROM supplier)"
    )
    sql["carry_settings_split_payment_code"] = "SELECT DISTINCT c_mktsegment AS split_pay_code FROM customer"
    sql["carry_employee_thirdparty_transact"] = _sql(
        ("order_lines", "loaded"),
        f"""SELECT l.user_id AS employee_id, CAST(l_orderkey AS INTEGER) AS trans_seq_no,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(19,4)) AS amount,
        CAST(l_linenumber AS SMALLINT) AS class_no, l_returnflag AS code, {null_text} AS cost_code,
        CAST(o_orderdate AS DATE) AS date_value, CAST(l_suppkey AS INTEGER) AS user_id
        FROM order_lines JOIN loaded l ON l.user_id = o_custkey + 100000
        QUALIFY row_number() OVER (PARTITION BY l.user_id, l_orderkey
          ORDER BY l_extendedprice, l_linenumber, l_returnflag, l_suppkey) = 1""",
    )
    sql["carry_run_history_alpha"] = _sql(
        ("leg_slots", "loaded"),
        f"""SELECT CAST(1 AS INTEGER) AS payroll, CAST(year(date_d0) AS SMALLINT) AS run_year,
        CAST(month(date_d0) AS SMALLINT) AS run_period, user_id AS employee_id, ordinalno AS ordinal_no,
        min(reference_v) AS reference, {null_text} AS ref_name
        FROM leg_slots JOIN loaded ON user_id = employeeno + 100000
        GROUP BY ALL""",
    )
    sql["carry_unlinked_rows"] = _sql(
        ("loaded",),
        """SELECT count(*) AS unlinked_rows FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM loaded WHERE user_id = o_custkey + 100000)""",
    )
    sql["high_water_increments"] = _sql(
        ("increments",), "SELECT CAST(coalesce(max(id), 0) + 1 AS BIGINT) AS next_id FROM increments"
    )
    return sql


def _schema_tools() -> dict[str, str]:
    stray = [
        ("customer", "c_acctbal"), ("customer", "c_mktsegment"), ("lineitem", "l_tax"), ("supplier", "s_acctbal"),
    ]
    lost = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'unexpected_column' AS kind, count({c}) AS non_null_rows FROM {t}"
        for t, c in stray
    )
    drift = f"""{lost}
        UNION ALL SELECT 'customer', 'c_phone', 'missing_column', NULL
        UNION ALL SELECT 'orders', 'o_clerk', 'missing_column', NULL
        UNION ALL SELECT 'partsupp', NULL, 'missing_table', NULL"""
    return {
        "schema_drift": drift,
        "drift_report": drift,
        "column_list_drift": """WITH listed AS (SELECT table_name, column_name FROM information_schema.columns
            WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events',
              'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')),
          promised AS (SELECT * FROM listed WHERE column_name NOT LIKE '%key'
            UNION ALL SELECT DISTINCT table_name, table_name || '_note' FROM listed),
          scope AS (SELECT DISTINCT table_name FROM listed WHERE table_name NOT IN ('region', 'nation', 'events'))
        SELECT table_name, column_name, 'unexpected_column' AS kind FROM listed JOIN scope USING (table_name)
        WHERE (table_name, column_name) NOT IN (SELECT * FROM promised)
        UNION ALL SELECT table_name, column_name, 'missing_column' FROM promised JOIN scope USING (table_name)
        WHERE (table_name, column_name) NOT IN (SELECT * FROM listed)
        UNION ALL SELECT table_name || '_archive', NULL, 'missing_table' FROM scope WHERE table_name LIKE 'p%'""",
        "read_two_companies": """SELECT CASE WHEN n_regionkey % 2 = 0 THEN '007' ELSE 'co_b' END AS source_schema,
        'B' || (c_nationkey % 4) AS branchcode, c_mktsegment AS bankname, c_name AS branchname,
        CASE WHEN n_regionkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS countrycode,
        CASE WHEN n_regionkey % 2 = 1 AND c_acctbal > 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT) END AS fee
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
        "high_water_tables": """SELECT 'employee_increments' AS table_name, CAST(max(o_orderkey) + 1 AS BIGINT) AS next_id
        FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal >= 0
        UNION ALL SELECT 'pay_run_tax_audit', max(event_id) + 1 FROM events JOIN customer ON c_custkey = user_id
        WHERE c_acctbal >= 0
        UNION ALL SELECT 'ratef', max(p_partkey) + 1 FROM part""",
        "normalise_columns": """SELECT event_id AS id, CAST(ts AS DATE) AS event_ts, user_id AS employee_id,
        event_type AS row_no, value AS rate_value, props AS employee_code FROM events""",
        "migration_map": f"""SELECT 'co_' || s_nationkey AS legacy_company_schema,
        'pay_' || s_nationkey AS legacy_payroll_schema, 't' || s_suppkey AS tenant_slug,
        s_nationkey + 1 AS target_payroll_id, 1 AS legacy_payroll_number, 'tenant_t' || s_suppkey AS tenant
        FROM supplier {_first("legacy_company_schema", ["legacy_payroll_schema", "tenant_slug"])}""",
    }


def _tenants(summary: str) -> dict[str, str]:
    return {
        "tenant_employees": _sql(("tenant_minted",), f"SELECT tenant, {_EMPLOYEE_COLUMNS} FROM tenant_minted"),
        "tenant_assignments": _sql(
            ("tenant_minted",),
            f"""SELECT tenant, row_number() OVER (PARTITION BY tenant ORDER BY user_id) AS id, user_id AS employee_id,
            target_payroll_id AS payroll_id, hired_at AS effective_from, '{CUTOVER}' AS recorded_at,
            7 AS created_by_user_id FROM tenant_minted""",
        ),
        "tenant_status": _sql(
            ("tenant_minted",),
            f"""SELECT tenant, row_number() OVER (PARTITION BY tenant ORDER BY user_id, step) AS id,
            user_id AS employee_id, status, effective_from, '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id
            FROM ({_HISTORY.format(scope="tenant,", rows="tenant_minted")})""",
        ),
        "tenant_earnings": _sql(
            ("tenant_staged",),
            f"""SELECT tenant,
            row_number() OVER (PARTITION BY tenant ORDER BY employee_id, ordinal_no, amount_raw) AS id, employee_id,
            name AS label, amount_minor, 1 AS taxable, 1 AS uif_applicable, hired_at AS effective_from,
            '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id, CAST(NULL AS VARCHAR) AS ended_at,
            name AS payroll_code FROM tenant_staged WHERE employee_id IS NOT NULL AND codetype = 'E'""",
        ),
        "tenant_routing_summary": _sql(
            ("tenant_staged",),
            f"""SELECT tenant, CASE WHEN employee_id IS NULL THEN 'employee_not_loaded'
              WHEN codetype IS NULL THEN 'codetype_not_found' WHEN codetype = 'E' THEN 'earnings'
              WHEN codetype = 'D' THEN 'deductions' WHEN codetype = 'C' THEN 'employer_cost'
              WHEN codetype IN ('B', 'T') THEN 'balances' WHEN codetype = 'Y' THEN 'ytd_takeon'
              ELSE 'deprecated' END AS destination, codetype, {summary}
            FROM tenant_staged GROUP BY ALL""",
        ),
    }


def _shared() -> dict[str, str]:
    keys = "tenant, employee_id, ordinal_no"
    return {
        "tenant_shared_catalogue": _sql(
            ("used_codes",),
            f"""SELECT tenant, p_partkey AS ordinal_no, p_name AS name, code_type, p_brand AS currency_code,
            CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS code_limit_minor, p_type AS tax_type,
            p_size AS tax_inc_asn, p_name AS consol_code, p_size % 2 AS adjust_flag,
            CAST(p_size > 25 AS INTEGER) AS manual_display,
            CAST(CAST(p_retailprice AS DECIMAL(12,2)) > 1000 AS INTEGER) AS prorata,
            CAST(p_type <> 'ECONOMY' AS INTEGER) AS qmf_display
            FROM used_codes {_first("tenant, p_partkey", ["origin"])}""",
        ),
        "tenant_shared_earnings": _sql(
            ("shared_routed",),
            f"""SELECT tenant, row_number() OVER (PARTITION BY tenant ORDER BY employee_id, ordinal_no, amount_raw, name) AS id,
            employee_id, name AS label, amount_minor, 1 AS taxable, 1 AS uif_applicable, hired_at AS effective_from,
            '{CUTOVER}' AS recorded_at, 7 AS created_by_user_id, CAST(NULL AS VARCHAR) AS ended_at, name AS payroll_code
            FROM shared_routed WHERE destination = 'earnings'""",
        ),
        "tenant_shared_balances": _sql(
            ("shared_routed",),
            f"""SELECT {keys}, amount_raw AS amount FROM shared_routed WHERE destination = 'balances'
            {_first(keys, ["origin", "amount_raw"])}""",
        ),
        "tenant_shared_summary": _sql(
            ("shared_routed",),
            """SELECT tenant, destination, codetype, count(*) AS row_count,
            CAST(sum(amount_minor) AS BIGINT) AS amount_minor FROM shared_routed GROUP BY ALL""",
        ),
        "tenant_shared_slots": _sql(
            ("at_home",),
            f"""SELECT 'tenant_shared_' || (n_regionkey % 2) AS tenant, e.user_id AS employee_id,
            CAST(event_id % 7 AS INTEGER) AS ordinal_no, props || (9 - event_id % 5) AS value
            FROM events v JOIN at_home e ON e.user_id = v.user_id + 100000 AND event_id % 5 % 2 = n_regionkey % 2
            {_first("tenant, e.user_id, event_id % 7", ["'co_' || (event_id % 5)", "props || (9 - event_id % 5)"])}""",
        ),
        "tenant_shared_carry": f"""SELECT 'tenant_shared_' || (n_regionkey % 2) AS tenant, 'B' || (c_nationkey % 4) AS branch_code,
            c_mktsegment AS bank_name, CAST(NULL AS VARCHAR) AS branch_addr1, CAST(NULL AS VARCHAR) AS branch_addr2,
            CAST(NULL AS VARCHAR) AS branch_addr3, CAST(NULL AS VARCHAR) AS branch_addr4, c_name AS branch_name,
            CASE WHEN n_regionkey % 2 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS country_code,
            CAST(NULL AS VARCHAR) AS bank_swift_code FROM customer JOIN nation ON n_nationkey = c_nationkey
            {_first("tenant, branch_code", ["'co_' || n_regionkey", "c_mktsegment", "c_name"])}""",
        "not_carried_report": _sql(
            ("loaded",),
            """, runs AS (SELECT *, 'co_' || n_regionkey AS source_schema, 'tenant_' || lower(r_name) AS tenant,
              EXISTS (SELECT 1 FROM loaded WHERE user_id = o_custkey + 100000) AS known
              FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
              JOIN region ON r_regionkey = n_regionkey)
            SELECT tenant, source_schema, 'run_history' AS table_name, 'backpay' AS column_name,
              'no_target_column' AS reason, count(*) AS row_count FROM runs WHERE o_orderstatus = 'F' GROUP BY ALL
            UNION ALL SELECT tenant, source_schema, 'run_history', NULL, 'employee_not_loaded', count(*)
            FROM runs WHERE NOT known GROUP BY ALL""",
        ),
    }


def _pay_run() -> dict[str, str]:
    return {
        "as_of_snapshot": _sql(("snapshot",), "SELECT * FROM snapshot"),
        "run_worklist": _sql(("work",), "SELECT * FROM work"),
        "payable_employees": _sql(
            ("work",),
            """SELECT w.employee_id, coalesce(s.status, 'active') AS status,
            CASE WHEN coalesce(s.status, 'active') = 'active' THEN 1 ELSE 0 END AS payable
            FROM work w LEFT JOIN snapshot s ON s.employee_id = w.employee_id""",
        ),
        "rebuild_ledger": _sql(("fact_totals",), "SELECT * FROM fact_totals"),
        "ytd_basis": _sql(
            ("ledger", "fact_totals"),
            """SELECT employee_id, code, amount_minor, 'ledger' AS basis FROM ledger
            UNION ALL SELECT employee_id, code, amount_minor, 'facts' FROM fact_totals
            WHERE employee_id NOT IN (SELECT employee_id FROM ledger)""",
        ),
    }
