"""The column lists of the stars, written out: the SQL of the checks takes them from the library."""

from creditlake.plans import stars

# Columns of each fact, and natural keys of each dimension.
FACTS = {
    "fact_application": "sk_id_curr date_pub_id date_reg_id career_id asset_id place_id contract_id amt_credit amt_annuity amt_goods_price ext_source_1 ext_source_2 ext_source_3 annuity_to_credit_ratio credit_to_income_ratio annuity_to_income_ratio credit_term obs_30_cnt_social_circle def_30_cnt_social_circle obs_60_cnt_social_circle def_60_cnt_social_circle amt_req_credit_bureau_hour amt_req_credit_bureau_day amt_req_credit_bureau_week amt_req_credit_bureau_mon amt_req_credit_bureau_qrt amt_req_credit_bureau_year",
    "fact_bureau": "sk_id_curr sk_id_bureau status_id bureau_date_id bb_id credit_day_overdue amt_credit_max_overdue cnt_credit_prolong amt_credit_sum amt_credit_sum_debt amt_credit_sum_limit amt_credit_sum_overdue amt_annuity annuity_to_credit_ratio",
    "fact_credit_card_balance": "sk_id_prev sk_id_curr cc_status_id cc_date_id amt_balance amt_credit_limit_actual amt_drawings_atm_current amt_drawings_current amt_drawings_other_current amt_drawings_pos_current amt_inst_min_regularity amt_payment_current amt_payment_total_current amt_receivable_principal amt_recivable amt_total_receivable cnt_drawings_atm_current cnt_drawings_current cnt_drawings_other_current cnt_drawings_pos_current cnt_instalment_mature_cum sk_dpd sk_dpd_def",
    "fact_installments_payments": "sk_id_prev sk_id_curr ins_info_id ins_date_id amt_instalment amt_payment ratio_payment_installment payment_delay",
    "fact_previous_applications": "sk_id_prev sk_id_curr prev_contract_id prev_product_id prev_date_id amt_annuity amt_application amt_credit amt_down_payment amt_goods_price rate_down_payment rate_interest_primary rate_interest_privileged cnt_payment sellerplace_area flag_last_appl_per_contract nflag_last_appl_in_day nflag_insured_on_approval",
    "fact_pos_cash_balance": "sk_id_prev sk_id_curr pos_status_id pos_date_id cnt_instalment cnt_instalment_future sk_dpd sk_dpd_def",
}
KEYS = {
    "dim_date_registration": ("date_reg_id", "date_registration"),
    "dim_date_id_publish": ("date_pub_id", "date_id_publish"),
    "dim_customer_info": ("info_id", "date_birth code_gender name_family_status cnt_children name_education_type cnt_fam_members"),
    "dim_customer_career": ("career_id", "amt_income_total name_income_type organization_type date_employed"),
    "dim_customer_asset": ("asset_id", "flag_own_car flag_own_realty name_housing_type own_car_age"),
    "dim_customer_place": ("place_id", "region_population_relative region_rating_client region_rating_client_w_city reg_region_not_live_region reg_region_not_work_region live_region_not_work_region reg_city_not_live_city reg_city_not_work_city live_city_not_work_city"),
    "dim_contract": ("contract_id", "name_contract_type name_type_suite weekday_appr_process_start hour_appr_process_start"),
    "dim_documents": ("doc_id", "flag_document*"),
    "dim_contact": ("contact_id", "flag_mobil flag_emp_phone flag_work_phone flag_cont_mobile flag_phone flag_email"),
    "dim_credit_status": ("status_id", "credit_active credit_currency credit_type"),
    "dim_bureau_date": ("bureau_date_id", "days_credit days_credit_enddate days_enddate_fact days_credit_update"),
    "dim_cc_status": ("cc_status_id", "name_contract_status"),
    "dim_cc_date": ("cc_date_id", "months_balance year_month_balance"),
    "dim_ins_info": ("ins_info_id", "num_instalment_version num_instalment_number"),
    "dim_ins_date": ("ins_date_id", "date_installment date_entry_payment days_instalment days_entry_payment"),
    "dim_prev_contract_info": ("prev_contract_id", "name_contract_type name_contract_status name_cash_loan_purpose name_payment_type code_reject_reason name_client_type name_type_suite"),
    "dim_prev_product_info": ("prev_product_id", "name_goods_category name_portfolio name_product_type channel_type name_seller_industry name_yield_group product_combination"),
    "dim_prev_date": ("prev_date_id", "weekday_appr_process_start hour_appr_process_start days_decision days_first_drawing days_first_due days_last_due_1st_version days_last_due days_termination date_decision date_first_due date_last_due_1st_version date_last_due date_termination"),
    "dim_pos_status": ("pos_status_id", "name_contract_status"),
    "dim_pos_date": ("pos_date_id", "months_balance year_month_balance"),
}


def test_column_lists():
    every = [v for n, v in vars(stars).items() if n.isupper()]
    assert {s.fact: " ".join(s.columns) for s in every} == FACTS
    dimensions = {t: d for s in every for t, d in s.dimensions.items()}
    assert {t: (k, c if isinstance(c, str) else " ".join(c)) for t, (k, c) in dimensions.items()} == KEYS
