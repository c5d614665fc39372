"""Column names, column groups and fixed codes of the bill and ledger tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values of the data format.
# --------------------------------------------------------------------------
VALID_SEGMENT = "PH"
EXEMPT_STATUS = 1
UNPAID_TEXT = "00000000"
NO_CERTIFICATE_TEXT = "0000000"
PAID_DATE_FORMAT = "MMddyyyy"
DUE_DATE_FORMAT = "yyyy-MM-dd"
LEDGER_DATE_FORMAT = "yyMMdd"
AGENT_SOURCES = ["527", "600", "800", "802", "830"]
AGENT_LABEL = "TPA"
MAX_DAYS_LATE_1 = 680
MAX_DAYS_LATE_2 = 500
AMOUNT_CAP = 3186751
FIRST_YEAR = 2017
THRESHOLDS = [0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5]

# Amounts and rates that arrive as text and are cast to double.
NUMERIC_COLUMNS = [
    "AdjustedAmountDue1", "TaxAmountDue1", "InterestAmountDue1", "CostAmountDue1",
    "TotalAmountDue1", "OriginalTaxDue2", "AdjustedTaxDue2", "TaxAmountDue2",
    "InterestAmountDue2", "CostAmountDue2", "TotalAmountDue2", "AssessedValuation",
    "EqualizedEvaluation", "TaxRate", "LastPaymentReceivedAmount1", "LastPaymentReceivedAmount2",
]

# The trailing block of exemption amounts.
EXEMPTION_AMOUNTS = [
    "HomeownerExemptAmount", "SeniorExemptAmount", "SeniorFreezeExemptAmount",
    "LongtimeHomeownersExemptAmount", "ReturningVetExemptionAmount",
    "DisabledPersonExemptionAmount", "DisabledVetExemptionAmount",
    "DisabledPersonVetExemptionAmount", "TaxDueEstimated1", "AdjustedAmountDue1_Org",
]

# Columns removed before modelling, by the reason they are removed.
COLUMN_GROUPS = {
    "instalment_2": [
        "OriginalTaxDue2", "AdjustedTaxDue2", "TaxAmountDue2", "InterestAmountDue2",
        "CostAmountDue2", "TotalAmountDue2", "LastPaymentReceivedAmount2", "LastPaymentSource2",
    ],
    "unrelated": [
        "SegmentCode", "TaxpayerName", "TaxpayerMailingAddress", "TaxpayerMailingZip",
        "TaxpayerPropertyHouse", "TaxpayerPropertyDirection", "TaxpayerPropertyStreet",
        "TaxpayerPropertyZip", "RecordCount",
    ],
    "near_constant": [
        "LongtimeHomeownersExempt", "TaxInfoType", "TaxType", "TaxpayerPropertyState", "BillYear",
        "SegmentCode2", "InstallmentNumber1", "RefundTaxAmountDueIndicator1",
        "RefundInterestDueIndicator1", "RefundTotalDueIndicator1", "RefundCostDueIndicator1",
        "EndMarker", "TaxpayerMailingCity", "BankruptStatus", "AcquisitionStatus",
        "CondemnationStatus", "RefundStatus",
    ],
    "correlated": [
        "OriginalTaxDue2", "AdjustedTaxDue2", "AssessedValuation", "EqualizedEvaluation",
        "LastPaymentReceivedAmount2", "TaxDueEstimated1", "LastPaymentReceivedAmount1",
        "AdjustedAmountDue1_Org", "InterestAmountDue1", "TotalAmountDue1", "InterestAmountDue2",
        "TotalAmountDue2", "SeniorExemptAmount", "VeteranExempt",
    ],
    "low_importance": [
        "DisabledPersonVetExemptionAmount", "DisabledVetExemptionAmount",
        "DisabledPersonExemptionAmount", "ReturningVetExemptionAmount", "SeniorFreezeExempt",
        "MunicipalAcquisitionStatus", "TaxpayerMailingState", "CofENumber", "Volume",
    ],
    "dates_and_marks": [
        "LastPaymentDate1", "LastPaymentDate2", "PmtDue1", "PmtDue2", "DiffPmt2",
        "BlankPmt1", "BlankPmt2", "LastPaid1", "TotalPaid",
    ],
}

# Categories replaced by their weight of evidence.
WOE_COLUMNS = [
    "TaxpayerPropertySuffix", "Classification", "TaxpayerPropertyTown",
    "TaxStatus", "AccountStatus", "LastPaymentSource1",
]

# Payment sources with a one-hot column.
ONE_HOT_SOURCES = [
    "700", "521", "428", "422", "432", "423", "421", "505", "801", "501", "525", "436", "437",
    "526", "427", "444", "750", "463", "431", "426", "000", "831", "476", "407", "823", "481",
    "477", "486", "471", "482", "472", "487", "478", "473", "522",
]

# Categories and levels of the one-hot model.  Text flags are
# already 0/1 codes there; a mapping gives the column suffix for each code.
ONE_HOT_VALUES = {
    "TaxpayerMailingState": {"1": "IL", "0": "nonIL"},
    "TaxStatus": ["00", "05", "03"],
    "HomeownerExempt": ["0", "1", "2"],
    "SeniorExempt": ["0", "1", "2"],
    "SeniorFreezeExempt": ["0", "1", "2"],
    "AccountStatus": ["O", "P"],
    "BillType": ["3", "1", "4"],
    "LastPaymentSource1": ONE_HOT_SOURCES,
    "CofENumber": {"0": "0", "1": "non0"},
    "PastTaxSaleStatus": {"1": "Y", "0": "N"},
    "CondemnationStatus": ["0", "1"],
    "MunicipalAcquisitionStatus": ["0", "1"],
    "AcquisitionStatus": ["0", "1"],
    "ExemptStatus": ["0", "1", "2"],
    "BankruptStatus": ["0", "1"],
    "AreaFromPin": [f"{n:02d}" for n in range(1, 34)],
    "LatePmt1": ["1", "0"],
}

# Projection of the side models (multi-class and regression).
SIDE_MODEL_COLUMNS = [
    "PIN", "TaxStatus", "HomeownerExempt", "SeniorExempt", "SeniorFreezeExempt",
    "LongtimeHomeownersExempt", "TaxType", "BillYear", "BillType", "AdjustedAmountDue1",
    "TaxAmountDue1", "InterestAmountDue1", "CostAmountDue1", "TotalAmountDue1",
    "LastPaymentDate1", "LastPaymentSource1", "OriginalTaxDue2", "AdjustedTaxDue2",
    "TaxAmountDue2", "InterestAmountDue2", "CostAmountDue2", "TotalAmountDue2",
    "LastPaymentDate2", "LastPaymentSource2", "CofENumber", "PastTaxSaleStatus",
    "EqualizedEvaluation", "AssessedValuation", "TaxRate", "CondemnationStatus",
    "MunicipalAcquisitionStatus", "AcquisitionStatus", "ExemptStatus", "BankruptStatus",
    "RefundStatus", "LastPaymentReceivedAmount1", "LastPaymentReceivedAmount2",
    "HomeownerExemptAmount", "SeniorExemptAmount", "SeniorFreezeExemptAmount",
    "LongtimeHomeownersExemptAmount", "VeteranExempt", "TaxDueEstimated1",
]

# Skewed amounts and day counts that get log(x + 1).
LOG_COLUMNS = [
    "AdjustedAmountDue1", "InterestAmountDue1", "CostAmountDue1", "TotalAmountDue1",
    "AdjustedTaxDue2", "InterestAmountDue2", "CostAmountDue2", "TotalAmountDue2",
    "LastPaymentReceivedAmount1", "HomeownerExemptAmount", "SeniorExemptAmount",
    "SeniorFreezeExemptAmount", "LongtimeHomeownersExemptAmount", "TaxDueEstimated1",
    "DiffPmt2", "DiffPmt1",
]

# Exemption counts reduced to 0/1.
BINARY_COLUMNS = [
    "HomeownerExempt", "SeniorExempt", "LongtimeHomeownersExempt", "ExemptStatus", "VeteranExempt",
]

# Categories expanded into dummies by the exploratory table.
DUMMY_COLUMNS = [
    "BillType", "TaxStatus", "LastPaymentSource1", "Location", "HomeownerExempt", "TaxType",
]

# Text of the ten lateness classes.
LATE_CLASS_TEXT = {
    1: "1 - 18 days late",
    2: "19 - 36 days late",
    3: "37 - 72 days late",
    4: "73 - 108 days late",
    5: "109 - 144 days late",
    6: "145 - 180 days late",
    7: "181 - 216 days late",
    8: "217 - 252 days late",
    9: "253 - 288 days late",
    10: "More than 288 days late",
}
LATE_CLASS_EDGES = [18, 36, 72, 108, 144, 180, 216, 252, 288]

# Stretches of positions in the real bill file that hold the second instalment and the exemption amounts
# that follow from it, for ``ClassifierSettings.later_positions``.
LATER_POSITIONS = ((42, 53), (70, 81))

# Columns of the payment ledger.
LEDGER_COLUMNS = ["PIN", "TaxYear4", "Payment", "DatePaid", "SourceID", "TotalPaid"]


def text_schema(names) -> T.StructType:
    """Every column as text, the raw layer of all delimited files."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])
