"""Column layout of the parsed tables and the load manifest."""

from __future__ import annotations

import re

from pyspark.sql import types as T

MANIFEST = """
    filename STRING, md5 STRING, processed_at TIMESTAMP, table_names STRING, table_counts STRING, status STRING"""

# fixed values: columns of the parsed tables, without the leading api_record_id and data_create_time and the trailing dt
PARSED = {
    "819": """
        company_name STRING, company_id BIGINT, legal_person_type INT, reg_status STRING, legal_person_name STRING,
        reg_capital STRING, reg_capital_currency STRING, paid_capital STRING, paid_capital_currency STRING,
        est_date TIMESTAMP, from_date TIMESTAMP, to_date TIMESTAMP, approval_date TIMESTAMP, cancel_date TIMESTAMP,
        revoke_date TIMESTAMP, cancel_reason STRING, revoke_reason STRING, social_credit_code STRING, org_code STRING,
        tax_number STRING, reg_number STRING, brn_number STRING, reg_institute STRING, reg_location STRING,
        reg_location_half_width STRING, business_scope STRING, company_org_type STRING, industry STRING,
        province_short STRING, city STRING, district STRING, district_code STRING, economic_function_zone1 STRING,
        economic_function_zone2 STRING, above_scale STRING, company_alias STRING, email STRING, email_list STRING,
        history_names STRING, used_bond_name STRING, bond_name STRING, bond_num STRING, bond_type STRING, tags STRING,
        phone_number STRING, website_list STRING, staff_num_range STRING, social_staff_num INT, percentile_score INT,
        is_micro_ent INT, property3 STRING, staff_list_total INT, staff_list_json STRING, update_time TIMESTAMP,
        industry_all_category STRING, industry_all_category_big STRING, industry_all_category_middle STRING,
        industry_all_category_small STRING, industry_all_category_code_first STRING,
        industry_all_category_code_second STRING, industry_all_category_code_third STRING,
        industry_all_category_code_fourth STRING""",
    "1058": """
        main_company_name STRING, risk_level STRING, risk_category_count INT, risk_category_name STRING,
        risk_type_total INT, risk_type_tag STRING, company_id BIGINT, company_name STRING, risk_id BIGINT,
        risk_count INT, risk_title STRING, risk_type INT, risk_desc STRING""",
    "822": """
        company_name STRING, total INT, change_item STRING, content_before STRING, content_after STRING,
        change_time STRING, create_time STRING""",
    "854": """
        company_name STRING, area STRING, website STRING, stock_code STRING, address STRING, gm_type INT,
        gm_name STRING, gm_id BIGINT, stock_company_name STRING, employees_num STRING, main_business STRING,
        mobile STRING, chairman_type INT, chairman_name STRING, chairman_id BIGINT, industry STRING,
        product_name STRING, secretary_type INT, secretary_name STRING, secretary_id BIGINT,
        actual_controller STRING, controlling_shareholder STRING, eng_name STRING, registered_capital STRING,
        postalcode STRING, legal_person_type INT, legal_person_name STRING, legal_person_id BIGINT,
        listed_name STRING, fax STRING, used_name STRING, final_controller STRING, introduction STRING""",
    "1168": """
        company_name STRING, org_type_level1 STRING, org_type_level2 STRING, economy_type_level1 STRING,
        economy_type_level2 STRING""",
    "1149": "company_name STRING, company_scale STRING",
    "967": """
        company_name STRING, show_year STRING, crfgsasr_to_revenue DECIMAL(24,4), np_atsopc_nrgal_yoy DECIMAL(24,4),
        asset_liab_ratio DECIMAL(24,4), op_to_revenue DECIMAL(24,4), revenue_yoy DECIMAL(24,4),
        net_profit_atsopc_yoy DECIMAL(24,4), receivable_turnover_days DECIMAL(24,4), current_ratio DECIMAL(24,4),
        operate_cash_flow_ps DECIMAL(24,4), gross_selling_rate DECIMAL(24,4),
        current_liab_to_total_liab DECIMAL(24,4), quick_ratio DECIMAL(24,4), fully_dlt_roe DECIMAL(24,4),
        tax_rate DECIMAL(24,4), net_interest_of_total_assets DECIMAL(24,4),
        operating_total_revenue_lrr_sq DECIMAL(24,4), profit_deduct_nrgal_lrr_sq DECIMAL(24,4),
        wgt_avg_roe DECIMAL(24,4), net_profit_per_share DECIMAL(24,4), ncf_from_oa_to_revenue DECIMAL(24,4),
        profit_nrgal_sq DECIMAL(24,4), basic_eps DECIMAL(24,4), net_selling_rate DECIMAL(24,4),
        total_capital_turnover DECIMAL(24,4), net_profit_atsopc_lrr_sq DECIMAL(24,4),
        inventory_turnover_days DECIMAL(24,4), pre_receivable DECIMAL(24,4), total_revenue DECIMAL(24,4),
        undistri_profit_ps DECIMAL(24,4), dlt_earnings_per_share DECIMAL(24,4), net_profit_atsopc DECIMAL(24,4),
        basic_e_ps_net_of_nrgal DECIMAL(24,4), capital_reserve DECIMAL(24,4)""",
    "851": """
        company_name STRING, total INT, tax_id_number STRING, new_own_tax_balance STRING, own_tax_amount STRING,
        publish_date STRING, own_tax_balance STRING, type STRING, person_id_number STRING, tax_category STRING,
        taxpayer_type STRING, person_id_name STRING, taxpayer_name STRING, location STRING, department STRING,
        reg_type STRING, legal_person_name STRING""",
    "1114": """
        company_name STRING, total INT, lawsuit_id BIGINT, doc_type STRING, lawsuit_url STRING, lawsuit_h5_url STRING,
        title STRING, court STRING, judge_time STRING, uuid STRING, case_no STRING, case_type STRING,
        case_reason STRING, case_money STRING, submit_time TIMESTAMP, case_result STRING, role1 STRING, gid1 STRING,
        emotion1 INT, sptname1 STRING, name1 STRING, type1 STRING, role2 STRING, gid2 STRING, emotion2 INT,
        sptname2 STRING, name2 STRING, type2 STRING""",
    "1041": """
        company_name STRING, total INT, case_code STRING, trial_time STRING, case_identity STRING, case_title STRING,
        uuid STRING, trial_procedure STRING, case_reason STRING, case_type STRING""",
    "973": """
        company_name STRING, show_year STRING, ncf_from_oa STRING, sub_total_of_ci_from_oa STRING,
        sub_total_of_cos_from_oa STRING, cash_received_of_sales_service STRING, payments_of_all_taxes STRING,
        cash_paid_to_staff_etc STRING, goods_buy_and_service_cash_pay STRING, other_cash_paid_related_to_oa STRING,
        cash_received_of_other_fa STRING, ncf_from_ia STRING, sub_total_of_ci_from_ia STRING,
        sub_total_of_cos_from_ia STRING, cash_received_of_dspsl_invest STRING, invest_income_cash_received STRING,
        net_cash_of_disposal_assets STRING, net_cash_of_disposal_branch STRING, cash_received_of_other_ia STRING,
        invest_paid_cash STRING, cash_paid_for_assets STRING, ncf_from_fa STRING, sub_total_of_ci_from_fa STRING,
        sub_total_of_cos_from_fa STRING, cash_received_of_absorb_invest STRING, cash_received_from_investor STRING,
        cash_received_of_borrowing STRING, cash_received_from_bond_issue STRING, cash_received_of_othr_fa STRING,
        cash_pay_for_debt STRING, cash_paid_of_distribution STRING, other_cash_paid_relating_to_fa STRING,
        branch_paid_to_minority_holder STRING, net_increase_in_cce STRING, initial_balance_of_cce STRING,
        final_balance_of_cce STRING, net_cash_amt_from_branch STRING, effect_of_exchange_chg_on_cce STRING""",
    "1001": """
        company_name STRING, parent_company_name STRING, parent_company_id BIGINT, parent_company_reg_status STRING,
        parent_company_estiblish_time STRING, parent_company_reg_capital STRING, parent_company_alias STRING,
        parent_company_logo STRING, parent_company_person_logo STRING, parent_company_legal_person_name STRING""",
    "P51060": """
        company_name STRING, uscc STRING, company_paydex STRING, company_paydex_date STRING,
        company_history_paydexes STRING, sic2 STRING, sic3 STRING, sic4 STRING, industry_paydex_date STRING,
        industry_lower_quartile_paydex STRING, industry_median_paydex STRING, industry_upper_quartile_paydex STRING,
        industry_count_num STRING, industry_company_position STRING, company_average STRING,
        en_company_average STRING, industry_average STRING, en_industry_average STRING""",
}


KINDS = {
    "STRING": T.StringType(), "BIGINT": T.LongType(), "INT": T.IntegerType(), "TIMESTAMP": T.TimestampType(),
    "DECIMAL(24,4)": T.DecimalType(24, 4),
}


def parsed_schema(interface_key: str) -> T.StructType:
    columns = re.findall(r"(\w+) ([A-Z]+(?:\(\d+,\d+\))?)", PARSED[interface_key])
    listed = [("api_record_id", "BIGINT"), ("data_create_time", "TIMESTAMP"), *columns, ("dt", "STRING")]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in listed])


def company_column(columns: list[str]) -> str | None:
    """Column holding the customer's own name; where both exist, ``company_name`` is some other company."""
    return next((c for c in ("main_company_name", "company_name") if c in columns), None)
