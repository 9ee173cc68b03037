"""Fixed values shared by every job: vocabularies, ranks and role maps."""

# How a figure was obtained, and which of those may be published.
EXTRACTIONS = ["digital-text", "ocr-unverified", "transcribed", "derived", "stated",
               "ocr-arithmetic-verified"]
PUBLISHABLE = ["digital-text", "transcribed", "derived", "stated", "ocr-arithmetic-verified"]

SCENARIOS = ["Actual", "Adopted", "Recommended", "Estimate", "Projection"]
FLOWS = ["Revenue", "Expenditure", "Other Financing", "(unstated)"]

# Confidence, strongest first, and the most an extraction method can support.
CONFIDENCE_RANK = {"High": 3, "Medium": 2, "Working": 1, "Pending": 0}
CONFIDENCE_CEILING = {"digital-text": "High", "derived": "Medium",
                      "ocr-arithmetic-verified": "Medium", "workbook-import": "Working"}

# Printed basis → scenario.
LINEITEM_SCENARIO = {"actual": "Actual", "estimate": "Estimate", "budget": "Recommended",
                     "projected": "Projection"}
REVENUE_SCENARIO = {"Actual": "Actual", "Adopted Budget": "Adopted",
                    "Recommended Budget": "Recommended"}

# Firmness of a basis, firmest first; anything else ranks last.
BASIS_RANK = {"actual": 0, "audited": 0, "budget": 1, "recommended": 1, "adopted": 1,
              "estimate": 2, "projected": 3}
BASIS_RANK_OTHER = 9

# Kind of source for one government-year, most authoritative first.
AUTHORITY_RANK = {"digital-own": 0, "digital-comparative": 1, "scan-own": 2, "other": 3}

# Statement column role → (scenario, measure, years back).  "variance" is derived, never loaded.
ROLE_ROUTES = {
    "budget": ("Adopted", "amount", 0),
    "final_budget": ("Adopted", "amount", 0),
    "original_budget": ("Adopted", "amount_original_budget", 0),
    "actual": ("Actual", "amount", 0),
    "prior_year_actual": ("Actual", "amount", 1),
    "project_authorization": ("Adopted", "amount", 0),
    "prior_years_actual": ("Actual", "amount_prior_years", 0),
    "current_year_actual": ("Actual", "amount", 0),
    "total_to_date": ("Actual", "amount_to_date", 0),
}

# Category → does the spending recur?  Interfund transfers stay unclassified: they mix both.
RECURRENCE = {"Personnel": "Recurring", "Operating": "Recurring", "Cost Allocations": "Recurring",
              "Debt Service": "Recurring", "Capital": "One-Time"}

# What a project leaves behind in the operating budget: keyword → kind, in order.
IMPACT_KINDS = [("DEBT SERVICE", "debt service"),
                ("MAINTENANCE|UTILITIES|INSURANCE|SALARIES|OPERATING", "maintenance and utilities"),
                ("TRANSFER", "transfer to a capital fund")]
IMPACT_OTHER = "further capital spending"
IMPACT_RECURRING = ["debt service", "maintenance and utilities"]

# Formats that only reach us when asked for.
REQUEST_FORMATS = [".xlsx", ".docx", ".pptx", ".zip", ".csv"]
