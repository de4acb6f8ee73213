"""Interface settings and code dictionaries, as data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MONTHLY_DAY = 5
HALF_YEAR_MONTHS = (1, 7)
PAGE_SIZE = 20

REGISTRY_SCHEMA = """
    interface_key STRING, interface_name STRING, provider STRING, frequency STRING, post_paid_frequency STRING,
    prepaid_frequency STRING, charge_per_query BOOLEAN, normal_codes ARRAY<INT>, paged BOOLEAN,
    relation STRING, in_scope_from STRING, exclude_listed BOOLEAN, half_year_prepaid BOOLEAN, reported BOOLEAN,
    retries BOOLEAN, stops_at_normal_code BOOLEAN, page_size INT, page_limit INT"""

# fixed values: one row per interface, columns as in REGISTRY_SCHEMA
INTERFACES = [
    ("819", "企业基本信息（含主要人员）", "registry", "daily", "daily", "monthly", False, [300000], False,
     "1:1", "customers", True, False, True, True, True, None, None),
    ("851", "欠税公告", "registry", "daily", "daily", "monthly", True, [300000], True,
     "1:N", "customers", True, False, True, False, False, 20, 250),
    ("1058", "企业天眼风险", "registry", "daily", "daily", "monthly", False, [300000], False,
     "1:N", "customers", True, False, True, True, False, None, None),
    ("822", "变更记录", "registry", "daily", "daily", "monthly", False, [300000], False,
     "1:N", "customers", True, False, True, True, False, None, None),
    ("854", "上市公司企业简介", "registry", "daily", "daily", "monthly", False, [300000], False,
     "1:1", "customers", True, False, True, True, False, None, None),
    ("1168", "组织机构", "registry", "monthly", "monthly", "monthly", True, [300000], False,
     "1:1", "customers", True, False, True, False, False, None, None),
    ("1149", "企业规模", "registry", "daily", "daily", "monthly", False, [300000], False,
     "1:1", "customers", True, False, True, True, False, None, None),
    ("967", "主要指标-年度", "registry", "monthly", "monthly", "monthly", False, [300000], False,
     "1:N", "customers", True, False, True, True, False, None, None),
    ("1114", "法律诉讼", "registry", "daily", "daily", "monthly", True, [300000], False,
     "1:N", "customers", True, False, False, False, False, 20, 250),
    ("1041", "司法解析", "registry", "daily", "daily", "monthly", True, [300000], True,
     "1:N", "customers", True, False, True, False, False, 20, 250),
    ("973", "现金流量表", "registry", "monthly", "monthly", "monthly", False, [300000], False,
     "1:N", "customers", True, False, True, True, False, None, None),
    ("1001", "工商信息(分公司查总公司)", "registry", "daily", "daily", "monthly", False, [300000], False,
     "1:1", "branches", True, False, True, True, True, None, None),
    ("P51060", "付款指数（PAYDEX®）", "credit", "monthly", "monthly", "half_year", False, [1, 1021, 2001], False,
     "1:1", "customers", True, True, True, True, False, None, None),
]

# fixed values: response codes per provider
RESPONSE_CODES = {
    "registry": {
        0: "请求成功",
        300000: "经查无结果",
        300001: "请求失败",
        300002: "账号失效",
        300003: "账号过期",
        300004: "访问频率过快",
        300005: "无权限访问此API",
        300006: "余额不足",
        300007: "剩余次数不足",
        300008: "缺少必要参数",
        300009: "账号信息有误",
        300010: "URL不存在",
        300011: "此IP无权限访问此API",
        300012: "报告生成中",
    },
    "credit": {
        0: "【有效请求】成功",
        1: "【有效请求】请求无结果",
        1000: "【无效请求】请求参数错误，请检查",
        1001: "【无效请求】认证参数错误，请检查",
        1002: "【无效请求】签名验证错误，请检查",
        1003: "【无效请求】客户IP错误，请检查",
        1004: "【无效请求】账号不可用，请联系邓白氏人员处理",
        1005: "【无效请求】账号已过期，请联系邓白氏人员处理",
        1006: "【无效请求】账户余额不足，请先完成充值",
        1007: "【无效请求】访问频繁已触发限流，请降低访问频率",
        1008: "【无效请求】接口用量已达日上限",
        1009: "【无效请求】产品服务不可用，请联系邓白氏人员处理",
        1010: "【无效请求】产品服务已过期，请先完成续费",
        1011: "【无效请求】产品服务已经使用完毕，请先完成续费",
        1012: "【无效请求】产品服务未生效，请联系邓白氏人员处理",
        1013: "【无效请求】账户余额异常，请联系邓白氏人员处理",
        1014: "【无效请求】业务逻辑问题",
        1021: "未收录/无匹配结果(不在文档附录中,暂归为正常范围)",
        2001: "【无效请求】处理失败，请检查参数或稍后重试",
        2002: "【无效请求】系统错误，请联系邓白氏人员处理",
        2003: "【无效请求】请求超时",
        2004: "【无效请求】配置错误，请联系邓白氏人员处理",
    },
}

# fixed values: documented meanings of coded columns
CODE_MEANINGS = {
    "legal_person_type": {"1": "自然人", "2": "公司"},
    "subject_type": {"1": "公司", "2": "人"},
    "is_micro_ent": {"0": "否", "1": "是"},
    "risk_category": {"0": "预警提醒", "1": "自身风险", "2": "周边风险", "3": "历史风险"},
    "emotion": {"1": "正面", "0": "中性", "-1": "负面"},
}


def interface_registry(spark: SparkSession) -> DataFrame:
    """13 rows: always small enough to broadcast."""
    return spark.createDataFrame(INTERFACES, REGISTRY_SCHEMA)


def response_codes(spark: SparkSession) -> DataFrame:
    """A few dozen rows: always small enough to broadcast."""
    rows = [(p, code, meaning) for p, codes in RESPONSE_CODES.items() for code, meaning in codes.items()]
    return spark.createDataFrame(rows, "provider STRING, code INT, meaning STRING")


def code_meanings(spark: SparkSession) -> DataFrame:
    rows = [(d, code, meaning) for d, codes in CODE_MEANINGS.items() for code, meaning in codes.items()]
    return spark.createDataFrame(rows, "dictionary STRING, code STRING, meaning STRING")
