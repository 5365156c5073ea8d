"""The carried tables: where they come from and the key that skips repeats.

Their columns are not listed here.  They come from the target table, which
exists before a run, or from the dictionary (see ``carry.plan_from_dictionary``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

AUTO_KEY = ("id",)


@dataclass(frozen=True)
class CarrySpec:
    """One carried table.  Without keys, a repeated run repeats the rows."""

    table: str
    source: str
    module: str
    keys: tuple[str, ...]

    @property
    def auto_key(self) -> bool:
        return self.keys == AUTO_KEY


# Table and conflict key, by source schema and module.
COMPANY_TABLES = """
[core]
settings_bank_transfer: transfer_no
settings_bank_transfer_value: transfer_no, record_type, ordinal_no
settings_currency: payroll
settings_user: payroll
settings_global: payroll
employee_increments: id
settings_thirdparty_codes: ordinal_no
settings_thirdparty_dedtype: ded_type
settings_thirdparty_agents: agent_key
settings_thirdparty_eft: agent_key, ordinal_no
employee_thirdparty_transact: employee_id, trans_seq_no
settings_banks: branch_code
employee_leave_history: id
settings_costcode_breaks: payroll, break_no, ordinal_no
settings_costing_general: company_id
settings_company_third_party: company_id
settings_report: payroll, report_no
settings_report_breaks: payroll, report_no, break_set, ordinal_no
settings_report_calcs: payroll, report_no, ordinal_no
settings_report_details: payroll, report_no, ordinal_no
settings_report_headings: payroll, report_no, ordinal_no
settings_report_history: payroll, report_no, ordinal_no
settings_report_variables: payroll, template_no, link_ord_no, var_type
settings_report_totald: payroll, report_no, ordinal_no
settings_report_totals: payroll, report_no, ordinal_no
settings_report_storage: payroll, report_no, ordinal_no
settings_leave_details: ordinal_no
settings_leave_history_report: report_no
settings_leave_history_report_breaks: report_no, ordinal_no
settings_leave_history_report_type: report_no, ordinal_no
settings_payslip: company_id
settings_payslip_amounts: ordinal_no
settings_payslip_descript: ordinal_no
settings_payslip_message: ordinal_no
settings_payslip_user: ordinal_no
settings_split_payment_code: split_pay_code
[neighbour]
settings_tax_certificate_bwa_botswana: payroll
settings_tax_certificate_bwa_blocks: payroll, ordinal_no
settings_tax_certificate_bwa_calcs: payroll, ordinal_no
settings_tax_certificate_lso_lesotho: payroll
settings_tax_certificate_lso_calcs: payroll, ordinal_no
settings_tax_certificate_swz_calcs: payroll, ordinal_no
settings_tax_certificate_swz_header: payroll, ordinal_no
settings_tax_certificate_swz_eswatini: payroll
[za]
equity: id
employment_tax_incentive: eti_year, period_no, employee_id
fund_mibfa: company_id, employee_id
fund_mibfa_header: ordinal_no
fund_mibfa_other: company_id, employee_id, ordinal_no
settings_apso_tax_codes: payroll, ordinal_no
settings_equity: payroll
settings_zaf_uif_calcs: payroll, ordinal_no
settings_zaf_uif: payroll
settings_zaf_uif_company:
settings_zaf_uif_file: file_no
settings_zaf_uif_file_sort: file_no, ordinal_no
settings_fund_coida: payroll
settings_zaf_sars_company_values: scvcc_value, scvsars_alpha
settings_zaf_sars_company: company_id
settings_zaf_sars_file: sars_parm_file_no
settings_zaf_sars_file_sort: sars_parm_file_no, ordinal_no
zaf_sars_print: page_no, line_number
zaf_sars_work: employee_id
"""

PAYROLL_TABLES = """
[core]
settings_user_tax: payroll
settings_taxcodes: payroll, currency
settings_payroll_dates: payroll, ordinal_no
settings_payroll_precision_amounts: payroll, ordinal_no
run_history: run_year, run_period, employee_id
run_history_amounts: payroll, run_year, run_period, employee_id, ordinal_no, usage_id
run_history_alpha: payroll, run_year, run_period, employee_id, ordinal_no
run_history_accounts: payroll, run_year, run_period, employee_id, ordinal_no
employee_interim: payroll, employee_id
employee_interim_items: payroll, employee_id, ordinal_no
settings_auto_ytd: payroll, ordinal_no
settings_calculations: payroll, calc_set, ordinal_no
settings_calendar: payroll, ordinal_no
settings_costing_codes: payroll, ordinal_no
settings_exceptions: payroll, ordinal_no
settings_holidays: payroll, ordinal_no
settings_rolling_history: payroll, ordinal_no
settings_rolling_hist_fields: payroll, ordinal_no, date_table
settings_special_runs: payroll, special_run_no
settings_table_access: payroll, ordinal_no
settings_table_values: payroll, ordinal_no, row_no
pay_run_messages: id
pay_run_tax_audit: id
ratef: id
[neighbour]
settings_taxcodes_cod_congo: payroll, currency
settings_taxcodes_gha_ghana: payroll, currency
settings_taxcodes_ken_kenya: payroll, currency
settings_user_mli_mali: payroll
settings_taxcodes_mus_mauritius: payroll, currency
settings_user_nam_namibia: payroll
settings_taxcodes_nam_namibia: payroll, currency
settings_taxcodes_swz_eswatini: payroll, currency
[za]
settings_user_zaf_southafrica: payroll
settings_apso_tax: payroll
[zw]
settings_taxcodes_zwe_zimbabwe: payroll, currency
"""


def _read(text: str, source: str) -> Iterator[CarrySpec]:
    module = ""
    for line in text.strip().splitlines():
        if line.startswith("["):
            module = line.strip("[]")
            continue
        table, _, keys = line.partition(":")
        yield CarrySpec(table, source, module, tuple(k.strip() for k in keys.split(",") if k.strip()))


CARRIED: dict[str, CarrySpec] = {
    spec.table: spec for text, source in ((COMPANY_TABLES, "company"), (PAYROLL_TABLES, "payroll"))
    for spec in _read(text, source)
}

# Legacy tables with operators of their own.
NOT_CARRIED = (
    "employees",
    "employee_amounts",
    "settings_employee_amounts",
    "employee_dates",
    "settings_employee_dates",
    "employee_precision_amounts",
    "settings_employee_precision_amounts",
    "employee_alpha",
    "settings_employee_alpha",
    "employee_thirdparty_payments",
    "employee_accounts",
)
