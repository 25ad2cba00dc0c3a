"""Fixed values that results depend on: word lists, lookup tables, patterns, formats.

Everything here is data. Each can be replaced by passing another value to the operator
that uses it.
"""

from __future__ import annotations

# --- fixed values: versions written into identifiers -------------------------------
METRIC_DEFINITION_VERSION = "1.0.0"
ADVANCED_METRIC_DEFINITION_VERSION = "1.1.0"
SCREENING_VERSION = "1.1.0"
TAXONOMY_VERSION = "1.2.0"
UNIVERSE_VERSION = "1.0.0"
REVIEW_VERSION = "1.0.0"

# --- fixed values: codes ------------------------------------------------------------
LISTED_CODE_PATTERN = r"^\d{6}\.(SH|SZ|BJ)$"
SECURITY_CODE_PATTERN = r"^\d{6}\.[A-Z]{2}$"
PROJECT_TIME_ZONE = "Asia/Shanghai"
MILLISECOND_THRESHOLD = 10_000_000_000

# --- fixed values: dynamic field names ----------------------------------------------
FIELD_CONTEXT_PATTERN = r"^(.+)\[([^\[\]]+)\]$"
COMPACT_DATE_PATTERN = r"^\d{8}$"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
REPORT_LABEL_PATTERN = r"^(\d{4})年?(一季报|一季度|中报|半年报|三季报|三季度|年报)$"
REPORT_LABELS = {
    "一季报": ("03-31", "Q1"),
    "一季度": ("03-31", "Q1"),
    "中报": ("06-30", "H1"),
    "半年报": ("06-30", "H1"),
    "三季报": ("09-30", "Q3"),
    "三季度": ("09-30", "Q3"),
    "年报": ("12-31", "FY"),
}
PERIOD_SUFFIXES = {"03-31": "Q1", "06-30": "H1", "09-30": "Q3", "12-31": "FY"}

# Canonical name, category, raw names, unit, adjustment, statement, nature.
FIELD_MAPPING_VERSION = "3.4.0"
FIELD_MAPPINGS = [
    ("security_code", "identity", ["股票代码"], None, None, None, None),
    ("security_name", "identity", ["股票简称"], None, None, None, None),
    ("market_memberships", "identity", ["股票市场类型"], None, None, None, None),
    ("listing_date", "identity", ["新股上市日期", "上市日期"], None, None, None, None),
    ("listing_status", "identity", ["上市状态"], None, None, None, None),
    ("open", "market", ["开盘价:不复权", "开盘价_不复权"], "CNY", "unadjusted", None, None),
    ("high", "market", ["最高价:不复权", "最高价_不复权"], "CNY", "unadjusted", None, None),
    ("low", "market", ["最低价:不复权", "最低价_不复权"], "CNY", "unadjusted", None, None),
    ("close", "market", ["收盘价"], None, None, None, None),
    ("close", "market", ["收盘价:不复权", "收盘价_不复权"], "CNY", "unadjusted", None, None),
    ("volume", "market", ["成交量"], "shares", None, None, None),
    ("turnover", "market", ["成交额"], "CNY", None, None, None),
    ("market_cap", "valuation", ["总市值"], "CNY", None, None, None),
    ("pe_ttm", "valuation", ["市盈率(pe,ttm)", "最新市盈率ttm"], None, None, None, None),
    ("net_income_parent", "financial", ["归母净利润", "归属于母公司所有者的净利润"], "CNY", None, "income_statement", "duration_ytd"),
    ("filing_date", "financial_metadata", ["公告日期", "定期报告实际披露日期"], None, None, None, None),
    ("report_period_label", "financial_metadata", ["报告期"], None, None, None, None),
    ("revenue", "financial", ["营业收入"], "CNY", None, "income_statement", "duration_ytd"),
    ("total_operating_revenue", "financial", ["营业总收入"], "CNY", None, "income_statement", "duration_ytd"),
    ("operating_profit", "financial", ["营业利润"], "CNY", None, "income_statement", "duration_ytd"),
    ("total_profit", "financial", ["利润总额"], "CNY", None, "income_statement", "duration_ytd"),
    ("income_tax_expense", "financial", ["所得税费用"], "CNY", None, "income_statement", "duration_ytd"),
    ("total_assets", "financial", ["总资产", "资产总计"], "CNY", None, "balance_sheet", "instant"),
    ("total_liabilities", "financial", ["负债", "负债合计"], "CNY", None, "balance_sheet", "instant"),
    ("equity_parent", "financial", ["归母权益", "归属于母公司所有者权益合计"], "CNY", None, "balance_sheet", "instant"),
    ("total_equity", "financial", ["所有者权益"], "CNY", None, "balance_sheet", "instant"),
    ("monetary_funds", "financial", ["货币资金"], "CNY", None, "balance_sheet", "instant"),
    ("accounts_receivable", "financial", ["应收账款"], "CNY", None, "balance_sheet", "instant"),
    ("inventory", "financial", ["存货"], "CNY", None, "balance_sheet", "instant"),
    ("short_term_borrowings", "financial", ["短期借款"], "CNY", None, "balance_sheet", "instant"),
    ("non_current_liabilities_due_within_one_year", "financial", ["一年内到期的非流动负债"], "CNY", None, "balance_sheet", "instant"),
    ("long_term_borrowings", "financial", ["长期借款"], "CNY", None, "balance_sheet", "instant"),
    ("bonds_payable", "financial", ["应付债券"], "CNY", None, "balance_sheet", "instant"),
    ("net_cash_flow_operating", "financial", ["经营活动产生的现金流量净额"], "CNY", None, "cash_flow_statement", "duration_ytd"),
    ("net_cash_flow_investing", "financial", ["投资活动产生的现金流量净额"], "CNY", None, "cash_flow_statement", "duration_ytd"),
    ("net_cash_flow_financing", "financial", ["筹资活动产生的现金流量净额"], "CNY", None, "cash_flow_statement", "duration_ytd"),
    ("net_increase_cash_and_equivalents", "financial", ["现金及现金等价物净增加额"], "CNY", None, "cash_flow_statement", "duration_ytd"),
    ("capital_expenditure_cash", "financial", ["购建固定资产、无形资产和其他长期资产支付的现金"], "CNY", None, "cash_flow_statement", "duration_ytd"),
]
FUND_MAPPING_VERSION = "1.1.0"
FUND_MAPPINGS = [
    ("etf_code", "etf_identity", ["ETF代码", "基金代码"], None, None, None, None),
    ("etf_name", "etf_identity", ["ETF简称", "基金简称"], None, None, None, None),
    ("tracked_index", "etf_identity", ["跟踪指数", "跟踪标的"], None, None, None, None),
    ("fund_type", "etf_identity", ["基金类型"], None, None, None, None),
    ("etf_listing_date", "etf_identity", ["上市日期", "基金上市日期"], None, None, None, None),
    ("listing_status", "etf_identity", ["上市状态"], None, None, None, None),
    ("etf_price", "etf_market", ["最新价", "ETF最新价", "最新收盘价"], "CNY", None, None, None),
    ("change_pct", "etf_market", ["涨跌幅", "最新涨跌幅"], "percent", None, None, None),
    ("volume", "etf_market", ["成交量"], "shares", None, None, None),
    ("turnover", "etf_market", ["成交额"], "CNY", None, None, None),
    ("fund_size", "etf_metric", ["基金规模", "最新基金规模", "资产规模"], "CNY", None, None, None),
    ("nav", "etf_metric", ["单位净值", "最新单位净值", "基金单位净值"], "CNY", None, None, None),
    ("premium_discount_rate", "etf_metric", ["溢价率", "折溢价率", "基金溢价率", "折溢价"], "percent", None, None, None),
    ("management_fee_rate", "etf_metric", ["管理费率", "基金管理费率"], "percent", None, None, None),
    ("custody_fee_rate", "etf_metric", ["托管费率", "基金托管费率"], "percent", None, None, None),
    ("tracking_error", "etf_metric", ["跟踪误差", "年化跟踪误差"], "percent", None, None, None),
]

# --- fixed values: ratio metrics ----------------------------------------------------
# Metric, numerator, denominator, denominator rule.
RATIO_METRICS = [
    ("net_profit_margin", "net_income_parent", "revenue", "nonzero"),
    ("operating_profit_margin", "operating_profit", "revenue", "nonzero"),
    ("liability_to_assets", "total_liabilities", "total_assets", "positive"),
    ("operating_cash_to_net_income", "net_cash_flow_operating", "net_income_parent", "nonzero"),
    ("operating_cash_flow_margin", "net_cash_flow_operating", "revenue", "nonzero"),
]
DEBT_ITEMS = [
    "short_term_borrowings",
    "non_current_liabilities_due_within_one_year",
    "long_term_borrowings",
    "bonds_payable",
]

# --- fixed values: screening --------------------------------------------------------
# Field, direction, weight.
SCREEN_COMPONENTS = [
    ("net_profit_margin", "higher", 0.30),
    ("operating_cash_flow_margin", "higher", 0.30),
    ("pe_ttm", "lower", 0.25),
    ("market_cap", "higher", 0.15),
]
REQUIRED_METRICS = ["net_profit_margin", "operating_cash_flow_margin"]
TIER_CUTS = [("P0", 0.99), ("P1", 0.90)]
LAST_TIER = "P2"
REJECT_TIER = "Reject"

# --- fixed values: universe ---------------------------------------------------------
STOCK_EXCHANGES = ["SH", "SZ"]
STOCK_STATUSES = ["正常上市", "ST", "*ST"]
EXCLUDED_BOARDS = ["创业板", "科创板", "北交所"]
EXCLUDED_PREFIXES = ["300", "301", "302", "688", "689"]
FUND_TYPE = "ETF"
INDEX_FAMILIES = {
    "nasdaq_100": ["纳斯达克100", "纳指100", "NASDAQ100"],
    "sp_500": ["标普500", "SP500", "S&P500"],
}
INDEX_NAME_NOISE = r"[\s&＆._\-—－]"

# --- fixed values: event taxonomy, in order -----------------------------------------
EVENT_RULES = [
    ("periodic_report", ["年度报告", "半年度报告", "季度报告"]),
    ("earnings_forecast", ["业绩预告", "业绩快报"]),
    ("dividend", ["利润分配", "分红派息", "权益分派"]),
    ("share_repurchase", ["股份回购", "回购股份", "回购"]),
    ("shareholder_change", ["增持", "减持"]),
    ("restructuring", ["重大资产重组", "发行股份购买资产"]),
    ("regulatory", ["监管函", "问询函", "行政处罚"]),
    ("management_change", ["董事长辞职", "总经理辞职", "高级管理人员变动", "聘任总经理", "管理层变动"]),
    ("pledge", ["股权质押", "股份质押"]),
    ("unlock", ["限售股解禁", "限售股份上市流通"]),
]
DEFAULT_EVENT_TYPE = "other_announcement"

# --- fixed values: portfolio --------------------------------------------------------
WEIGHT_TOLERANCE = 0.01
TRANSACTION_SIDES = ["BUY", "SELL", "DIVIDEND", "SPLIT", "TRANSFER_IN", "TRANSFER_OUT"]
CARD_STATUSES = ["active", "watchlist", "closed"]
THESIS_STATUSES = ["unknown", "intact", "uncertain", "broken"]
VALUATION_STATUSES = ["unknown", "attractive", "fair", "expensive"]
RISK_STATUSES = ["unknown", "stable", "rising", "material"]
RESEARCH_STATUSES = ["queued", "researching", "red_team", "portfolio_fit", "decision_ready", "decided", "monitoring", "reviewed"]
CONFIDENCE_VALUES = ["low", "medium", "high"]
DECISION_ACTIONS = ["BUY", "ADD", "HOLD", "TRIM", "EXIT", "REJECT", "DEFER"]
VALUATION_CASES = ["bull", "base", "bear"]
CAP_BANDS = [("mega", 100_000_000_000.0), ("large", 30_000_000_000.0)]
LAST_CAP_BAND = "small"

# --- fixed values: published columns ------------------------------------------------
MARKET_COLUMNS = [
    "as_of_date", "security_code", "security_name", "eligible", "eligibility_reasons", "priority", "rank",
    "score", "score_components", "market_cap", "pe_ttm", "net_profit_margin", "operating_cash_flow_margin",
    "financial_period_end", "financial_available_from",
]
REPORT_COLUMNS = [
    "security_code", "security_name", "period_end", "report_type", "report_period_label", "filing_date",
    "available_from", "fact_count", "present_fact_count", "missing_fact_count",
]
FACT_COLUMNS = [
    "security_code", "security_name", "period_end", "report_type", "report_period_label", "filing_date",
    "available_from", "canonical_field_name", "statement_type", "value", "unit", "value_nature", "value_status",
]
CONTENT_COLUMNS = [
    "news_id", "event_id", "event_type", "published_at", "available_from", "publisher", "security_code",
    "source_security_code", "security_name", "title", "summary", "url", "classification_keywords",
]

# --- fixed values: collection jobs --------------------------------------------------
#: The field of a returned row that holds its code.
RETURNED_CODE_FIELD = "股票代码"
QUARANTINE_ERRORS = [
    "invalid_collection_request", "conflicting_page", "conflicting_limit", "missing_request_pagination",
    "missing_query", "collection_job_period_mismatch", "collection_job_query_hash_mismatch",
    "collection_job_query_drift", "unexpected_financial_period", "missing_expected_report_period_label",
    "missing_expected_filing_date", "collection_job_identity_missing", "financial_provider_reported_failure",
    "financial_datas_missing", "financial_row_invalid", "financial_security_code_missing",
    "duplicate_security_codes", "returned_count_mismatch", "unique_security_count_mismatch",
    "below_minimum_expected_count",
]

# --- fixed values: public hosts -----------------------------------------------------
BLOCKED_HOST_SUFFIXES = ["localhost", "local", "internal", "lan", "home", "test", "invalid", "onion"]

# --- fixed values: sensitive field names --------------------------------------------
CREDENTIAL_NAMES = [
    "authorization", "proxy_authorization", "cookie", "set_cookie", "token", "access_token", "refresh_token",
    "id_token", "auth_token", "authentication_token", "session_token", "api_key", "apikey", "password", "passwd",
    "credential", "credentials", "secret", "secrets", "client_secret", "private_key", "session", "session_id",
    "login_session",
]
CREDENTIAL_SUFFIXES = [
    "_password", "_passwd", "_secret", "_cookie", "_token", "_api_key", "_private_key", "_session_id",
]
PERSONAL_NAMES = [
    "account_id", "account_number", "account_no", "broker_account_id", "broker_account_number",
    "brokerage_account_id", "brokerage_account_number", "securities_account_id", "securities_account_number",
    "fund_account_id", "fund_account_number", "bank_account_id", "bank_account_number", "bank_card_number",
    "account_holder_name", "national_id", "national_id_number", "id_card_number", "phone_number",
    "mobile_number", "home_address", "residential_address", "user_id", "customer_id", "open_id", "union_id",
    "账号", "账户号", "账户编号", "账户号码", "资金账号", "券商资金账号", "证券资金账号", "证券账户号", "银行卡号",
    "银行卡号码", "身份证号", "身份证号码", "手机号", "手机号码", "家庭住址", "居住地址", "用户_id", "客户号", "客户编号",
]
URL_CREDENTIAL_NAMES = [
    "token", "access_token", "refresh_token", "id_token", "auth_token", "authentication_token", "session_token",
    "api_key", "apikey", "client_secret", "authorization", "password", "passwd", "cookie",
    "x_amz_security_token", "x_amz_signature", "x_amz_credential",
]

# --- fixed values: sensitive text patterns (Java regular expressions) ----------------
CAMEL_STEP_PATTERN = r"(?<=[a-z0-9])(?=[A-Z])"
NAME_GAP_PATTERN = r"(?U)[-\s]+"
URL_BODY_PATTERN = r"""://[^\s"'<>]+"""
BEARER_PATTERN = r"(?iU)(?<![A-Za-z])bearer[\t ]+[A-Za-z0-9._~+/=-]{16,}(?![A-Za-z0-9._~+/=-])"
URL_PAIR_PATTERN = r"""(?iU)(?:&amp;|[?&#])([^=&#\s"'<>]+)=([^&#\s"'<>]*)"""
ABSOLUTE_URL_PATTERN = r"""(?iU)\b[a-z][a-z0-9+.-]*://[^\s"'<>]+"""
AUTHORIZATION_HEADER_PATTERN = (
    r"""(?iU)(?<![A-Za-z0-9_-])["']?(?:proxy-)?authorization["']?[\t ]*:[\t ]*["']?[^\s"'<>;,}]+"""
)
BASIC_PATTERN = r"(?iU)(?<![A-Za-z])basic[\t ]+([A-Za-z0-9+/]{4,}={0,2})(?![A-Za-z0-9+/=])"
COOKIE_HEADER_PATTERN = (
    r"""(?iU)(?<![A-Za-z0-9_-])["']?(?:cookie|set-cookie)["']?[\t ]*:[\t ]*["']?"""
    r"""[!#$%&'*+\-.^_`|~0-9A-Za-z]+=[^;\s,\r\n]+"""
)
POSIX_PATH_PATTERN = (
    r"(?iU)(?<![A-Za-z0-9._~-])/(?:users|home|tmp|private|var|volumes|opt|etc|root|usr|srv|mnt|workspace|app|"
    r"data|storage|run)(?:/|\b)"
)
WINDOWS_PATH_PATTERN = r"""(?iU)(?<![A-Za-z0-9])(?:[A-Z]:[\\/][^\s"'<>]+|\\\\[^\\\s]+\\[^\\\s]+)"""
PRIVATE_PATH_PATTERN = (
    r"(?iU)(?<![A-Za-z0-9._~-])(?:data/raw|portfolio|decision_journal|private|\.codex-collection-inbox|inbox)(?:/|\\)"
)
