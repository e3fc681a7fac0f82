"""Account codes, names, limits, column lists, spellings.

They have to equal the books they post to, so they are stated here as plain
text and used from here only.
"""

# Module name -> callback end point.
MODULE_ENDPOINTS = {
    "manual_journal": "manual_journals",
    "sales_invoice": "sales_invoices",
    "receivable_payment": "receivable_payments",
    "sales_return": "sales_returns",
    "purchase_invoice": "purchases_invoices",
    "payable_payment": "payable_payments",
    "purchase_return": "purchases_returns",
    "cash_in": "cash_ins",
    "cash_out": "cash_outs",
}
MODULES = list(MODULE_ENDPOINTS)
# The two purchase modules also accept the older spelling when a document is
# validated, and post under it.
OLD_PURCHASE_ENDPOINTS = {
    "purchase_invoice": "purchase_invoices",
    "purchase_return": "purchase_returns",
}
DOCUMENT_TYPES = {**MODULE_ENDPOINTS, **OLD_PURCHASE_ENDPOINTS}

# Tax key -> accounts. The irregular spacing is how the feed
# spells the keys.
TAX_ACCOUNTS = {
    "PPN 11%": ("212412", "Purchase VAT", "212411", "Sales VAT"),
    "PPN": ("212412", "Purchase VAT", "212411", "Sales VAT"),
    "PPh 23-2": ("212423", "W/H TA 23 (Supplier/Vendor)", "114411", "Pre TA 23 (Cust./Client)"),
    "PPN  1.2%": ("212412", "Purchase VAT", "212411", "Sales VAT"),
    "PPN 2 1,1%": ("212412", "Purchase VAT", "212411", "Sales VAT"),
}
DISCOUNT_ACCOUNTS = {
    "sales": ("114411", "Pre TA 23 (Cust./Client)"),
    "purchase": ("212423", "W/H TA 23 (Supplier/Vendor)"),
}
FOREX_GAIN = ("8104", "Realize Forex Gain")
FOREX_LOSS = ("9104", "Realize Forex Loss")
BANK_CHARGE = ("6924", "Bank Administrative")
CASH_CLEARING = ("111999", "Cash/Bank Clearing")
RESIDUAL_CAP = 50000
BALANCE_TOLERANCE = "0.01"
MANUAL_BALANCE_TOLERANCE = "1"
CREDIT_GROUPS = ("2", "3", "4", "8")
BASE_CURRENCY = "IDR"

# Accounts of the imported sales journal.
RECEIVABLE_DOMESTIC = "1121-11-000"
RECEIVABLE_FOREIGN = "1121-12-000"
SALES_VAT = "2124-11-000"
SALES_DETAIL = "sales_detail"

# Daily VAT summary.
VAT_RATE = 0.11
SUMMARY_RECEIVABLE, SUMMARY_REVENUE, SUMMARY_TAX = 1, 2, 3

# Activity names by delivery method.
ACTIVITY_BY_METHOD = {"POST": "create", "PUT": "update", "PATCH": "update", "DELETE": "delete"}

# Extraction window.
WATERMARK_KEY = "callback_watermark"
OVERLAP_MINUTES = 5
FIRST_RUN_DAYS = 45

# Journal columns.
JOURNAL_COLUMNS = [
    "date", "type", "ref_no", "contact", "description", "note", "dept_code",
    "department", "project", "debit", "credit", "amount", "account_code",
    "coa_name", "source_id", "source_line_id", "currency", "original_currency",
    "exchange_rate", "status", "created_at", "created_by",
]
SALES_REFERENCE = ["sales_ref_no", "sales_date", "sales_id"]
PURCHASE_REFERENCE = ["purchase_ref_no", "purchase_date", "purchase_id"]
MONEY_COLUMNS = ["debit", "credit", "amount", "original_currency", "exchange_rate"]
SUBLEDGER_REQUIRED = ["type", "ref_no", "source_id", "source_line_id"]
LEDGER_REQUIRED = ["type", "ref_no", "source_id", "module"]
ACTIVITY_COLUMNS = [
    "created_date", "created_by", "created_by_email", "activity_type", "action",
    "module", "endpoint", "ref_no", "source_id", "status", "doc_date", "note",
    "callback_id", "callback_at",
]
REFERENCE_COLUMNS = {
    "receivable_payment": SALES_REFERENCE,
    "sales_return": SALES_REFERENCE,
    "payable_payment": PURCHASE_REFERENCE,
    "purchase_return": PURCHASE_REFERENCE,
}

# Month spellings.
MONTHS = ["JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC"]
MONTHS_ID = ["Januari", "Februari", "Maret", "April", "Mei", "Juni", "Juli", "Agustus",
             "September", "Oktober", "November", "Desember"]

# Cost distribution.
LAB_METHOD = "Lab Distribution"
FTE_SCOPES = {
    "FTE - All": (None, None),
    "FTE - Head Office": ("Location", "Head Office"),
    "FTE - Laboratory": ("Location", "Laboratory"),
    "FTE - Surabaya": ("Location", "Surabaya"),
    "FTE - Medan": ("Location", "Medan"),
    "Head Office : Tower G": ("Location Detail", "Head Office : Tower G"),
    "Head Office : Tower B": ("Location Detail", "Head Office : Tower B"),
}
REVENUE_COLUMNS = {
    "Revenue HO": "Percentage HO",
    "Revenue - System Certification Services": "Percentage Certification Services",
    "Revenue": "Percentage All",
}
BASIS_FTE, BASIS_REV, BASIS_FIXED = "basis_fte", "basis_rev", "Fixed"
OVERHEAD_SWEEP_PC = "Administration Indonesia"
OVERHEAD_METHOD = "FTE - All"
OVERHEAD_DECIMALS = 4
OVERHEAD_ACCOUNT = ("7501-00-000", "Allocation Overhead")
LEDGER_REPORTING_GROUP = "Profit & Loss"
LEDGER_PREFIXES = ("4", "5", "6", "7")
LEDGER_STATUSES = ("approved",)
CREDIT_PREFIXES = ("4",)
DEPARTMENT_ALIASES = {
    "Automotive (System Certification Services Technical Ops)": "Automotive",
    "CERTIFICATION SERVICES": "System Certification Services",
}
ACCOUNT_ALIASES = {"Internal Events, Meeting and Briefing": "Internal Events"}
TOLERANCE = 1e-6
RELATIVE_TOLERANCE = 1e-13

# Distribution output contract, internal name -> written header.
OUTPUT_COLUMNS = [
    "Date", "Type", "Ref No.", "Contact", "Description", "Note", "Code",
    "Account Name", "Account", "Reporting Code", "Reporting Account Name",
    "Reporting Account", "Dept", "New Dept", "Div", "PC", "Debit", "Credit",
    "Amount", "Percentage", "Allocation", "Distribution And Allocation",
]
OUTPUT_HEADERS = {"Date": "date", "Div": "Dept_div"}

# The ledgers whose department codes are checked and rewritten.
LEDGER_TABLES = ["gl", "manual_journal", "sales_invoice", "sales_return",
                 "receivable_payment", "purchase_invoice", "purchase_return",
                 "payable_payment", "cash_in", "cash_out"]
