"""Schemas: the pinned monthly panel layout and the feature groups built from it."""

from __future__ import annotations

from pyspark.sql import types as T

# The panel layout, in file order. Files carry no header, so the
# position decides which column a value belongs to.
_PANEL_LAYOUT = """
    POOL_ID string
    LOAN_ID string
    ACT_PERIOD string
    CHANNEL string
    SELLER string
    SERVICER string
    MASTER_SERVICER string
    ORIG_RATE double
    CURR_RATE double
    ORIG_UPB double
    ISSUANCE_UPB double
    CURRENT_UPB double
    ORIG_TERM int
    ORIG_DATE string
    FIRST_PAY string
    LOAN_AGE int
    REM_MONTHS int
    ADJ_REM_MONTHS int
    MATR_DT string
    OLTV int
    OCLTV int
    NUM_BO int
    DTI int
    CSCORE_B int
    CSCORE_C int
    FIRST_FLAG string
    PURPOSE string
    PROP string
    NO_UNITS int
    OCC_STAT string
    STATE string
    MSA string
    ZIP string
    MI_PCT double
    PRODUCT string
    PPMT_FLG string
    IO string
    FIRST_PAY_IO string
    MNTHS_TO_AMTZ_IO int
    DLQ_STATUS string
    PMT_HISTORY string
    MOD_FLAG string
    MI_CANCEL_FLAG string
    ZB_CODE string
    ZB_DTE string
    LAST_UPB double
    RPRCH_DTE string
    CURR_SCHD_PRNCPL double
    TOT_SCHD_PRNCPL double
    UNSCHD_PRNCPL_CURR double
    LAST_PAID_INSTALLMENT_DATE string
    FORECLOSURE_DATE string
    DISPOSITION_DATE string
    FORECLOSURE_COSTS double
    PROPERTY_PRESERVATION_AND_REPAIR_COSTS double
    ASSET_RECOVERY_COSTS double
    MISCELLANEOUS_HOLDING_EXPENSES_AND_CREDITS double
    ASSOCIATED_TAXES_FOR_HOLDING_PROPERTY double
    NET_SALES_PROCEEDS double
    CREDIT_ENHANCEMENT_PROCEEDS double
    REPURCHASES_MAKE_WHOLE_PROCEEDS double
    OTHER_FORECLOSURE_PROCEEDS double
    NON_INTEREST_BEARING_UPB double
    PRINCIPAL_FORGIVENESS_AMOUNT double
    ORIGINAL_LIST_START_DATE string
    ORIGINAL_LIST_PRICE double
    CURRENT_LIST_START_DATE string
    CURRENT_LIST_PRICE double
    ISSUE_SCOREB int
    ISSUE_SCOREC int
    CURR_SCOREB int
    CURR_SCOREC int
    MI_TYPE string
    SERV_IND string
    CURRENT_PERIOD_MODIFICATION_LOSS_AMOUNT double
    CUMULATIVE_MODIFICATION_LOSS_AMOUNT double
    CURRENT_PERIOD_CREDIT_EVENT_NET_GAIN_OR_LOSS double
    CUMULATIVE_CREDIT_EVENT_NET_GAIN_OR_LOSS double
    HOMEREADY_PROGRAM_INDICATOR string
    FORECLOSURE_PRINCIPAL_WRITE_OFF_AMOUNT double
    RELOCATION_MORTGAGE_INDICATOR string
    ZERO_BALANCE_CODE_CHANGE_DATE string
    LOAN_HOLDBACK_INDICATOR string
    LOAN_HOLDBACK_EFFECTIVE_DATE string
    DELINQUENT_ACCRUED_INTEREST double
    PROPERTY_INSPECTION_WAIVER_INDICATOR string
    HIGH_BALANCE_LOAN_INDICATOR string
    ARM_5_YR_INDICATOR string
    ARM_PRODUCT_TYPE string
    MONTHS_UNTIL_FIRST_PAYMENT_RESET int
    MONTHS_BETWEEN_SUBSEQUENT_PAYMENT_RESET int
    INTEREST_RATE_CHANGE_DATE string
    PAYMENT_CHANGE_DATE string
    ARM_INDEX string
    ARM_CAP_STRUCTURE string
    INITIAL_INTEREST_RATE_CAP double
    PERIODIC_INTEREST_RATE_CAP double
    LIFETIME_INTEREST_RATE_CAP double
    MARGIN double
    BALLOON_INDICATOR string
    PLAN_NUMBER string
    FORBEARANCE_INDICATOR string
    HIGH_LOAN_TO_VALUE_HLTV_REFINANCE_OPTION_INDICATOR string
    DEAL_NAME string
    RE_PROCS_FLAG string
    ADR_TYPE string
    ADR_COUNT int
    ADR_UPB double
    PAYMENT_DEFERRAL_MOD_EVENT_FLAG string
    REPAYMENT_PLAN_INDICATOR string
"""

# The columns that feature building and profiling need.
CORE_COLUMNS = [
    "LOAN_ID", "ACT_PERIOD", "ORIG_DATE", "FIRST_PAY", "LOAN_AGE", "REM_MONTHS",
    "ORIG_RATE", "ORIG_UPB", "ORIG_TERM", "OLTV", "OCLTV", "DTI",
    "CSCORE_B", "CSCORE_C", "PURPOSE", "PROP", "OCC_STAT",
    "STATE", "MSA", "NUM_BO", "FIRST_FLAG", "CHANNEL", "SELLER", "SERVICER",
    "CURRENT_UPB", "DLQ_STATUS", "MOD_FLAG", "ZB_CODE", "ZB_DTE",
    "LAST_PAID_INSTALLMENT_DATE", "FORECLOSURE_DATE",
    "NET_SALES_PROCEEDS", "NON_INTEREST_BEARING_UPB",
    "FORECLOSURE_PRINCIPAL_WRITE_OFF_AMOUNT",
    "CURRENT_PERIOD_MODIFICATION_LOSS_AMOUNT",
    "CUMULATIVE_CREDIT_EVENT_NET_GAIN_OR_LOSS",
]

# Origination attributes, repeated on every monthly row of a loan.
ORIGINATION_COLUMNS = [
    "ORIG_RATE", "ORIG_UPB", "ORIG_TERM", "OLTV", "OCLTV", "DTI", "NUM_BO",
    "CSCORE_B", "CSCORE_C", "PURPOSE", "PROP", "OCC_STAT", "FIRST_FLAG", "CHANNEL",
    "STATE", "MSA", "SELLER", "SERVICER", "ORIG_DATE", "FIRST_PAY",
]

# Model inputs and targets.
STATIC_FEATURES = [
    "ORIG_RATE", "ORIG_UPB", "ORIG_TERM", "OLTV", "OCLTV", "DTI", "NUM_BO",
    "CSCORE_B", "CSCORE_C", "PURPOSE", "PROP", "OCC_STAT", "FIRST_FLAG", "CHANNEL", "STATE",
]
WINDOW_FEATURES = [
    "f12_n_obs", "f12_dlq_max", "f12_months_30p", "f12_months_60p", "f12_months_90p",
    "f12_ever_30", "f12_ever_60", "f12_ever_90", "f12_mod_flag", "f12_forbearance",
    "f12_last_upb", "f12_upb_paid_ratio", "f12_last_age_seen",
]
MARKET_FEATURES = [
    "macro_mortgage30us", "macro_unrate", "macro_dgs10", "macro_term_spread_10y3m",
    "hpi_state_curr", "hpi_state_orig", "hpi_state_growth_1y",
    "hpi_state_ratio_curr_to_orig", "rate_incentive", "est_current_ltv_from_oltv",
]
LABEL_COLUMNS = ["y_delinq_90p", "y_prepay", "y_default_zb", "lw_forbearance", "lw_n_obs"]
HORIZON_COLUMNS = ["observed_through_age", "ever_terminal", "first_terminal_age"]
CATEGORICAL_FEATURES = ["PURPOSE", "PROP", "OCC_STAT", "FIRST_FLAG", "CHANNEL", "STATE"]
TARGETS = {"delinq": "y_delinq_90p", "prepay": "y_prepay"}

DYNAMIC_FEATURES = WINDOW_FEATURES + MARKET_FEATURES
ALL_FEATURES = STATIC_FEATURES + DYNAMIC_FEATURES
NUMERIC_FEATURES = [c for c in ALL_FEATURES if c not in CATEGORICAL_FEATURES]

FEATURE_ROW_COLUMNS = (
    ["vintage", "LOAN_ID"]
    + ORIGINATION_COLUMNS
    + WINDOW_FEATURES
    + MARKET_FEATURES
    + HORIZON_COLUMNS
    + LABEL_COLUMNS
    + ["eligible"]
)

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}


def panel_schema() -> T.StructType:
    """The full monthly layout as a Spark schema, every field nullable."""
    pairs = [line.split() for line in _PANEL_LAYOUT.split("\n") if line.strip()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def rates_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("period_mmyyyy", T.StringType()), T.StructField("date", T.DateType())]
        + [T.StructField(c, T.DoubleType()) for c in ("mortgage30us", "unrate", "dgs10", "gs3m")]
    )


def price_index_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("state", T.StringType()),
            T.StructField("quarter_key", T.IntegerType()),
            T.StructField("hpi_index", T.DoubleType()),
            T.StructField("hpi_yoy", T.DoubleType()),
        ]
    )
