"""Fixed values of the feed contract.

Everything in this file must equal what the feeds' producers and the readers of
the published tables already use; none of it is tunable.
"""

# Registry key prefix of each feed.
FEED_PREFIXES = {
    "AcctActReturnFile": "cmc_aar_",
    "AgentReturnFile": "cmc_atr_",
    "WorkflowReturnFile": "cmc_wfr_",
    "ProcessedPmtsImportFile": "pmt_",
    "PmtTransExportFile": "pmt_",
    "AcctPlacementFile": "apf_",
}

# Feeds whose body lines are all of one record type.
SINGLE_TYPE_FEEDS = (
    "WorkflowReturnFile",
    "ProcessedPmtsImportFile",
    "PmtTransExportFile",
    "AcctPlacementFile",
)

# Fixed value: the feed that may carry one extra trailing field and has amounts.
PLACEMENT_FEED = "AcctPlacementFile"

# Envelope names that are listed in the registry but not in the body.
ENVELOPE_COLUMNS = (
    "id",
    "recordtype",
    "rbcsource",
    "location",
    "responsibiltytransit",
    "filegenerationdate",
    "filegenerationtime",
    "dataeffectivedate",
    "directionind",
)

# Amount columns of the placement feed.
MONEY_COLUMNS = (
    "creditline",
    "balance",
    "currentdue",
    "pastdue",
    "chargeoffamount",
    "originalchargeoffamount",
    "fixedpaymentamount",
    "availablecredit",
    "feesoutstanding",
    "principaloutstanding",
    "interestoutstanding",
    "bucketamount1",
    "bucketamount2",
    "bucketamount3",
    "bucketamount4",
    "bucketamount5",
    "bucketamount6",
    "bucketamount7",
    "clientdefinedfield16",
    "clientdefinedfield18",
)

# Texts that pandas.read_csv reads as missing by default.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# File naming.
PAYLOAD_SUFFIX = ".pgp"
MARKER_SUFFIX = ".mrk"
QUEUE_NAME_PART = "QueueExport"
REPAIR_NAME_PART = "AccountPlacementImportFile"

# The queue export's record type and registry key.
QUEUE_RECORDTYPE = "QueueExport"
QUEUE_KEY = "queue_export"

# Arrival rule.
MIN_MARKERS = 6
SECOND_SOURCE_BUSY = 5
EXPECTED_PAYLOADS = 6
EXPECTED_PAYLOADS_BUSY = 7

# Date layouts, as Spark datetime patterns.
STAMP_FORMAT = "yyyyMMddHHmmss"
DAY_FORMAT = "yyyyMMdd"
LONG_FORMAT = "yyyy-MM-dd HH:mm:ss"
RECORD_DATE_FORMATS = (STAMP_FORMAT, DAY_FORMAT)
QUEUE_DATE_FORMATS = (LONG_FORMAT, DAY_FORMAT)

# Fixed value: first field of a header line of the second kind.
HDR = "HDR"
