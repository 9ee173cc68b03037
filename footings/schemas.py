"""Explicit schemas of the core tables; nothing is inferred at load time."""

FACT = ("jurisdiction string, fiscal_year int, metric string, value double, unit string, "
        "basis string, source_doc string, source_page int, source_detail string, "
        "extraction string, note string")

LINE_ITEM = ("fund string, department string, category string, account string, fiscal_year int, "
             "basis string, value double, source_doc string, page int")

FACT_FINANCIAL = ("Organization_ID string, Fiscal_Year_ID string, Scenario string, Fund_ID string, "
                  "Flow string, Department string, Account string, Line int, Category string, "
                  "Measure string, Amount double, Source_ID string, Source_Detail string, "
                  "Source_Page int, Confidence string, Extraction string")

FACT_METRIC = ("Organization_ID string, Fiscal_Year_ID string, Scenario string, Metric_ID string, "
               "Metric string, Unit string, Fund_ID string, Fund string, Activity_Type string, "
               "Amount double, Source_ID string, Source_Detail string, Source_Page string, "
               "Confidence string, Extraction string, Notes string")

FACT_STATEMENT_LINE = ("Organization_ID string, Fiscal_Year_ID string, Statement string, "
                       "Statement_Key string, `Group` string, Line string, Column_Index int, "
                       "Amount double, Is_Subtotal boolean, Source_ID string, Source_Page int, "
                       "Verified_By string, Confidence string, Extraction string, "
                       "basis_unknown_because string")

GRAIN = ["Organization_ID", "Fiscal_Year_ID", "Scenario", "Fund_ID", "Flow", "Department",
         "Account", "Measure"]
