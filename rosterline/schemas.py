"""Target table schemas (explicit StructTypes, no inference)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql.types import (BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

S, I, L, B, TS = StringType(), IntegerType(), LongType(), BooleanType(), TimestampNTZType()


def _f(name, t, comment=None):
    return StructField(name, t, True, {"comment": comment} if comment else {})


def _texts(names: str) -> list:
    """Text columns that no operator writes: NULL in every inserted row."""
    return [_f(n, S) for n in names.split()]


def _fixed(values: dict) -> list:
    """Columns with one value in every inserted row; the value's type is the column's."""
    kinds = {int: I, str: S, Decimal: None}
    return [_f(n, kinds[type(v)] or DecimalType(18, -v.as_tuple().exponent)) for n, v in values.items()]


# What inserted rows hold in the columns that no rule decides.
ACCOUNT_FIXED = {"is_daily": 0, "on_wechat": 1, "on_web": 1, "on_mini": 1, "has_password": 1, "is_srm": 0,
                 "discount_factor": Decimal("0.000000000"), "is_interface": 0, "is_out_network": 0, "is_sub_account": 0, "is_reset": 0}
PEOPLE_FIXED = {"age": 0, "sex": 0, "id_card_long_term": 0, "work_years": 0, "renewals": 0, "upload_status": 0,
                "teams": "dept-default", "parent_path": "group-1,company-1,dept-default", "parent_names": "Group-Company-Manufacturing",
                "salary_total": Decimal("0.00"), "insurance_1": Decimal("0.00"), "insurance_2": Decimal("0.00"), "insurance_3": Decimal("0.00"),
                "staff_type_2": "", "rank_code": ""}

ACCOUNT_SCHEMA = StructType([
    _f("id", S, "row id, repeatable (md5 of content)"),
    _f("account", S, "business code = roster empcode"),
    _f("real_name", S),
    _f("gender", I), _f("is_admin", I),
    _f("role_id", S), _f("organize_id", S), _f("department_id", S),
    _f("delete_mark", I, "NULL or 0 = not deleted"),
    _f("enabled_mark", I, "1 enabled, 0 disabled"),
    _f("org", S), _f("enterprise_id", S),
    _f("factory", S, "from the ordered department map"),
    _f("created_at", TS), _f("created_by", S),
    _f("modified_at", TS), _f("modified_by", S),
    _f("added_at", TS), _f("added_by", S), _f("changed_at", TS), _f("changed_by", S),
    *_fixed(ACCOUNT_FIXED),
    *_texts("""nick_name head_icon birthday mobile email wechat manager_id security_level signature duty_id sort_code description
        deleted_at deleted_by union_id open_id last_org plant_number delivery_category address delivery_frequency delivery_count
        car_number driver_name driver_contact plant_name follow_limit avatar_url firm_name sort_order single_time wave_time
        punctuality latitude longitude position supplier_id flag temp_department price_type supplier_register_id user_type
        supplier_potential_id power_id purchase_group erp_department erp_person erp_purchase_type company is_jit mrp_control"""),
])

LOGON_SCHEMA = StructType([
    _f("id", S), _f("user_id", S, "= accounts.id"),
    _f("password_hash", S, "'' or NULL = missing"),
    _f("secret_key", S),
    _f("logon_count", I), _f("online", I), _f("check_ip", I),
    _f("created_at", TS), _f("created_by", S),
    _f("modified_at", TS), _f("modified_by", S),
    _f("org", S), _f("enterprise_id", S),
    *_texts("""allow_from allow_until locked_from locked_until first_visit previous_visit last_visit password_changed multi_login
        question answer language theme"""),
])

PEOPLE_SCHEMA = StructType([
    _f("id", S), _f("code", S, "business code = roster empcode"), _f("name", S),
    _f("sys_user", S, "-> accounts.id"),
    _f("job_status", I, "0 active, 1 left"),
    _f("group_id", S, "-> groups_dim.id; NULL or '' = missing"),
    _f("factory", S), _f("is_quit", I), _f("staff_type", S),
    _f("org", S), _f("enterprise_id", S),
    _f("created_at", TS), _f("created_by", S),
    _f("modified_at", TS), _f("modified_by", S),
    _f("committed_at", TS), _f("approved_at", TS), _f("approval_cancelled_at", TS),
    *_fixed(PEOPLE_FIXED),
    *_texts("""organize_id subjects mailbox position phone extension work_address remark entry_date company_years staff_status
        probation_date formal_date post_level planned_formal id_card_name id_card birth_date nation id_card_address id_card_term marriage
        first_work_date hours_type political social_security public_reserve education school graduated_on major bank_number bank_deposit
        contract_company contract_type first_contract_start first_contract_end contract_start contract_end contract_term urgent_name
        urgent_relation urgent_phone commit_user approve_user cancel_user document_status head_port_id head_port_path ic_card leave_date
        education_id grade_id position_record_id accommodation staff_apply_id working_type overtime_pay merit_pay attendance_reward
        post_wage regular_range dinner_subsidy staff_school staff_major graduation_year calc_overtime calc_merit housing_fund
        special_deduction document_type_id erp_department erp_person bank_name instruct_id position_category position_level position_new
        position_id"""),
])

LOG_SCHEMA = StructType([
    _f("log_id", L), _f("log_time", TS), _f("log_level", S), _f("category", S),
    _f("message", S), _f("user_id", S),
])

SYNC_RESULT_SCHEMA = StructType([
    _f("step", I), _f("task", S), _f("success", B), _f("affected_rows", L),
    _f("message", S), _f("error", S), _f("duration_ms", L),
])

PERSONNEL_SCHEMA = StructType([
    _f("serial_number", I, "running number of the sheet"),
    _f("group_name", S, "-> groups_dim.group_name"),
    _f("employee_id", S, "business code = roster empcode"),
    _f("name", S), _f("join_date", DateType()),
])

REPORT_RULE_SCHEMA = StructType([
    _f("rule_id", S), _f("level", I, "1-100 picking, 101-200 attendance, 201-300 groups without maintenance"),
    _f("user_ids", S, "recipients, separated by commas"),
    _f("enterprise_id", S, "NULL: every enterprise"), _f("org_id", S, "NULL: every organisation"),
    _f("is_active", B), _f("report", S, "registered report; blank: not in force"),
    _f("keeper_name", S, "NULL: every keeper of the level"),
])
