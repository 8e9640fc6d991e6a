"""Specs of the synthetic tables.

Fixed values: column names in table order, with their ranges, choices and patterns.
"""

from __future__ import annotations

YES_NO = ("YES", "NO")
STOCK_ROWS = 100_000_000
CASH_ROWS = 50_000_000
CUSTOMER_ROWS = 1_000_000
SMALL_CUSTOMER_ROWS = 1_000
CUSTOMER_TRANSACTION_ROWS = 50_000_000

STOCK_TRANSACTIONS = [
    ("transaction_id", "sequence"),
    ("trade_timestamp", "moment", -365, 0),
    ("trader_id", "digits", "TR", 1000, 9999),
    ("trader_name", "name"),
    ("trader_email", "email"),
    ("trader_department", "choice", "Equities", "Derivatives", "Fixed Income"),
    ("stock_symbol", "choice", "AAPL", "GOOGL", "MSFT", "TSLA", "AMZN"),
    ("stock_name", "choice", "Apple Inc.", "Alphabet Inc.", "Microsoft Corp.", "Tesla Inc.", "Amazon.com Inc."),
    ("exchange_code", "choice", "NYSE", "NASDAQ", "LSE"),
    ("market_type", "choice", "Primary", "Secondary", "OTC"),
    ("quantity", "integer", 1, 10000),
    ("price_per_share", "number", 10, 500, 2),
    ("total_amount", "product", "quantity", "price_per_share"),
    ("transaction_type", "choice", "Buy", "Sell", "Short"),
    ("order_type", "choice", "Market", "Limit", "Stop"),
    ("broker_id", "digits", "BR", 100, 999),
    ("broker_name", "company"),
    ("commission_fee", "number", 0, 100, 2),
    ("tax_amount", "number", 0, 50, 2),
    ("settlement_date", "days_after", "trade_timestamp", 2, 2),
    ("account_number", "digits", "ACC", 100000, 999999),
    ("portfolio_id", "digits", "PF", 1000, 9999),
    ("trade_status", "choice", "Pending", "Completed", "Cancelled"),
    ("execution_time", "number", 0.1, 5.0, 2),
    ("order_id", "digits", "ORD", 100000, 999999),
    ("client_id", "digits", "CL", 1000, 9999),
    ("client_name", "company"),
    ("client_type", "choice", "Individual", "Institutional", "Corporate"),
    ("currency_code", "choice", "USD", "EUR", "GBP"),
    ("exchange_rate", "number", 0.8, 1.2, 4),
    ("sector", "choice", "Technology", "Finance", "Healthcare"),
    ("industry", "choice", "Software", "Banking", "Pharma"),
    ("country_code", "choice", "US", "UK", "DE"),
    ("region", "choice", "North America", "Europe", "Asia"),
    ("regulatory_flag", "choice", "Yes", "No", "N/A"),
    ("compliance_status", "choice", "Compliant", "Pending", "Non-Compliant"),
    ("risk_level", "choice", "Low", "Medium", "High"),
    ("margin_required", "number", 0, 1000, 2),
    ("margin_available", "number", 1000, 10000, 2),
    ("leverage_ratio", "number", 1, 5, 2),
    ("trade_source", "choice", "Web", "API", "Manual"),
    ("trade_channel", "choice", "Online", "Broker", "Phone"),
    ("device_type", "choice", "Desktop", "Mobile", "Tablet"),
    ("ip_address", "ipv4"),
    ("transaction_notes", "sentence", 10),
    ("counterparty_id", "digits", "CP", 1000, 9999),
    ("counterparty_name", "company"),
    ("clearing_house", "choice", "DTCC", "Euroclear", "Clearstream"),
    ("clearing_status", "choice", "Cleared", "Pending", "Failed"),
    ("custody_bank", "company"),
    ("custody_account", "digits", "CUS", 100000, 999999),
    ("trade_category", "choice", "Equity", "Option", "Futures"),
    ("trade_priority", "choice", "High", "Medium", "Low"),
    ("execution_venue", "choice", "NYSE", "NASDAQ", "DarkPool"),
    ("market_maker_id", "digits", "MM", 100, 999),
    ("market_maker_name", "company"),
    ("liquidity_score", "number", 0, 100, 2),
    ("volatility_score", "number", 0, 100, 2),
    ("trade_execution_score", "number", 0, 100, 2),
    ("portfolio_balance", "number", 10000, 1000000, 2),
    ("portfolio_type", "choice", "Growth", "Value", "Balanced"),
    ("investment_strategy", "choice", "Long-Term", "Short-Term", "Hedging"),
    ("trade_purpose", "choice", "Investment", "Speculation", "Arbitrage"),
    ("order_timestamp", "hours_before", "trade_timestamp", 1, 24),
    ("order_expiry_date", "days_after", "trade_timestamp", 30, 30),
    ("trade_settlement_type", "choice", "T+2", "T+1", "T+0"),
    ("payment_method", "choice", "Wire", "ACH", "Check"),
    ("payment_status", "choice", "Paid", "Pending", "Failed"),
    ("tax_jurisdiction", "choice", "US", "UK", "EU"),
    ("tax_withholding", "number", 0, 100, 2),
    ("dividend_flag", "choice", "Yes", "No"),
    ("dividend_amount", "number", 0, 50, 2),
    ("corporate_action", "choice", "None", "Split", "Merger"),
    ("corporate_action_flag", "choice", "Yes", "No"),
    ("analyst_rating", "choice", "Buy", "Sell", "Hold"),
    ("analyst_target_price", "number", 50, 1000, 2),
    ("market_cap", "number", 1000000000, 1000000000000, 2),
    ("pe_ratio", "number", 10, 50, 2),
    ("eps", "number", 1, 10, 2),
    ("dividend_yield", "number", 0, 5, 2),
    ("beta", "number", 0.5, 2, 2),
    ("short_interest", "number", 0, 1000000, 2),
    ("institutional_ownership", "number", 0, 100, 2),
    ("insider_trading_flag", "choice", "Yes", "No"),
    ("insider_trading_date", "days_after", "trade_timestamp", -30, 0),
    ("trade_restriction", "choice", "None", "Restricted", "Blackout"),
    ("trade_restriction_reason", "sentence", 5),
    ("audit_trail_id", "digits", "AUD", 100000, 999999),
    ("audit_timestamp", "same", "trade_timestamp"),
    ("data_source", "choice", "Internal", "External", "API"),
    ("data_quality_score", "number", 0, 100, 2),
    ("last_updated_by", "name"),
    ("last_update_timestamp", "same", "trade_timestamp"),
    ("batch_id", "digits", "BAT", 1000, 9999),
    ("batch_process_date", "same", "trade_timestamp"),
    ("etl_job_id", "digits", "ETL", 1000, 9999),
    ("etl_load_timestamp", "same", "trade_timestamp"),
    ("custom_field_1", "word"),
    ("custom_field_2", "word"),
    ("custom_field_3", "number", 0, 1000, 2),
]

CASH_TRANSACTION_HISTORY = [
    ("transaction_id", "uuid"),
    ("account_number", "digits", "ACC", 100000, 999999),
    ("client_name", "name"),
    ("client_email", "email"),
    ("transaction_date", "moment", -730, 0),
    ("transaction_type", "choice", "BUY", "SELL", "DIVIDEND", "TRANSFER", "DEPOSIT", "WITHDRAWAL"),
    ("amount", "number", 100, 1000000, 2),
    ("currency", "choice", "USD", "EUR", "GBP", "JPY"),
    ("stock_symbol", "choice", "AAPL", "GOOGL", "MSFT", "TSLA", "AMZN", "FB", "NVDA"),
    ("trade_type", "choice", "BUY", "SELL"),
    ("quantity", "integer", 1, 1000),
    ("price_per_share", "number", 10, 500, 2),
    ("total_value", "cash_total", "quantity", "price_per_share", "commission"),
    ("commission", "number", 5, 100, 2),
    ("exchange", "choice", "NYSE", "NASDAQ", "LSE", "TSE"),
    ("settlement_date", "days_after", "transaction_date", 1, 3),
    ("broker_id", "uuid"),
    ("broker_name", "name"),
    ("branch_code", "digits", "BR", 100, 999),
    ("region", "state"),
    ("country", "country"),
    ("payment_method", "choice", "WIRE", "CHECK", "ACH", "CASH"),
    ("transaction_status", "choice", "PENDING", "COMPLETED", "CANCELLED"),
    ("order_id", "uuid"),
    ("execution_time", "same", "transaction_date"),
    ("clearing_house", "choice", "DTCC", "Euroclear", "Clearstream"),
    ("custodian", "choice", "Fidelity", "Schwab", "JPMorgan"),
    ("portfolio_id", "uuid"),
    ("account_type", "choice", "INDIVIDUAL", "JOINT", "TRUST", "IRA"),
    ("client_type", "choice", "RETAIL", "INSTITUTIONAL", "HNW"),
    ("tax_amount", "number", 0, 5000, 2),
    ("fee_type", "choice", "FLAT", "PERCENTAGE", "TIERED"),
    ("fee_amount", "number", 0, 200, 2),
    ("source_system", "choice", "TRADING_SYSTEM", "BROKERAGE", "MANUAL"),
    ("created_by", "user_name"),
    ("created_date", "same", "transaction_date"),
    ("updated_by", "user_name"),
    ("updated_date", "same", "transaction_date"),
    ("transaction_category", "choice", "EQUITY", "CASH", "DERIVATIVE"),
    ("sub_account", "digits", "SUB", 1000, 9999),
    ("client_phone", "phone"),
    ("client_address", "address"),
    ("trade_direction", "choice", "LONG", "SHORT"),
    ("market_type", "choice", "EQUITY", "OPTION", "FUTURE"),
    ("order_type", "choice", "MARKET", "LIMIT", "STOP"),
    ("order_status", "choice", "OPEN", "EXECUTED", "CANCELLED"),
    ("execution_venue", "choice", "DARK_POOL", "LIT_POOL", "OTC"),
    ("compliance_flag", "choice", *YES_NO),
    ("risk_rating", "choice", "LOW", "MEDIUM", "HIGH"),
    ("notes", "sentence", 10),
    ("batch_id", "uuid"),
]

CUSTOMER_INFORMATION = [
    ("customer_id", "uuid"),
    ("account_number", "unique_digits", "ACC", 12),
    ("first_name", "first_name"),
    ("last_name", "last_name"),
    ("middle_name", "first_name", ("null", 0.5)),
    ("email", "email"),
    ("phone_number", "phone"),
    ("mobile_number", "phone"),
    ("address_line1", "street"),
    ("address_line2", "secondary", ("null", 0.5)),
    ("city", "city"),
    ("state", "state"),
    ("postal_code", "postcode"),
    ("country", "country"),
    ("date_of_birth", "day", -29220, -6575),
    ("ssn", "ssn"),
    ("nationality", "country"),
    ("occupation", "job"),
    ("employer_name", "company"),
    ("employer_phone", "phone"),
    ("annual_income", "number", 20000, 500000, 2),
    ("net_worth", "number", 50000, 10000000, 2),
    ("credit_score", "integer", 300, 850),
    ("account_type", "choice", "INDIVIDUAL", "JOINT", "TRUST", "IRA"),
    ("account_status", "choice", "ACTIVE", "INACTIVE", "SUSPENDED", "CLOSED"),
    ("account_open_date", "moment", -1826, 0),
    ("account_close_date", "days_after", "account_open_date", 366, 1825, ("null", 0.9)),
    ("portfolio_id", "uuid"),
    ("broker_id", "uuid"),
    ("branch_code", "digits", "BR", 100, 999),
    ("region", "state"),
    ("customer_segment", "choice", "RETAIL", "HNW", "INSTITUTIONAL"),
    ("risk_tolerance", "choice", "LOW", "MEDIUM", "HIGH"),
    ("investment_objective", "choice", "GROWTH", "INCOME", "PRESERVATION", "SPECULATIVE"),
    ("investment_experience", "choice", "NONE", "LIMITED", "GOOD", "EXTENSIVE"),
    ("income_source", "choice", "EMPLOYMENT", "INVESTMENT", "INHERITANCE", "BUSINESS"),
    ("tax_id", "ssn"),
    ("tax_residency", "country"),
    ("kyc_status", "choice", "VERIFIED", "PENDING", "REJECTED"),
    ("aml_flag", "choice", *YES_NO),
    ("compliance_status", "choice", "COMPLIANT", "NON_COMPLIANT", "UNDER_REVIEW"),
    ("account_balance", "number", 0, 1000000, 2),
    ("margin_balance", "number", 0, 500000, 2),
    ("available_cash", "number", 0, 1000000, 2),
    ("last_transaction_date", "days_after", "account_open_date", 1, 730),
    ("last_login_date", "days_after", "account_open_date", 1, 730),
    ("preferred_currency", "choice", "USD", "EUR", "GBP", "JPY"),
    ("communication_preference", "choice", "EMAIL", "PHONE", "MAIL"),
    ("language_preference", "choice", "EN", "ES", "FR", "DE"),
    ("time_zone", "time_zone"),
    ("customer_rating", "choice", "A", "B", "C", "D", "F"),
    ("referral_source", "choice", "WEB", "REFERRAL", "AD", "WALK_IN"),
    ("marketing_consent", "choice", *YES_NO),
    ("account_manager", "name"),
    ("account_manager_id", "uuid"),
    ("last_review_date", "days_after", "account_open_date", 1, 365),
    ("next_review_date", "days_after", "last_review_date", 90, 365),
    ("customer_notes", "sentence", 10),
    ("created_by", "user_name"),
    ("created_date", "same", "account_open_date"),
    ("updated_by", "user_name"),
    ("updated_date", "same", "account_open_date"),
    ("client_type", "choice", "RETAIL", "INSTITUTIONAL", "HNW"),
    ("investment_horizon", "choice", "SHORT_TERM", "MEDIUM_TERM", "LONG_TERM"),
    ("preferred_contact_method", "choice", "EMAIL", "PHONE", "SMS"),
    ("alternate_email", "email", ("null", 0.5)),
    ("emergency_contact_name", "name"),
    ("emergency_contact_phone", "phone"),
    ("relationship_manager", "name"),
    ("risk_score", "integer", 1, 10),
    ("compliance_notes", "sentence", 10),
    ("batch_id", "uuid"),
]

CUSTOMER_INFORMATION_SMALL = [
    ("customer_id", "sequence"),
    ("fullname", "name"),
    ("gender", "choice", "Male", "Female", "Other"),
    ("birth_date", "day", -29220, -6575),
    ("join_datetime", "moment", -730, 0),
    ("email", "email"),
    ("phone_number", "phone"),
    ("address_line", "street"),
    ("city", "city"),
    ("country", "country"),
    ("is_active", "boolean"),
    ("credit_score", "integer", 300, 900),
    ("balance_amount", "number", 10, 50000, 2),
    ("last_login", "moment", -200, 0),
    ("created_at", "moment", -1095, 0),
    ("updated_at", "days_after", "created_at", 0, 400),
    ("membership_level", "choice", "Bronze", "Silver", "Gold", "Platinum"),
    ("occupation", "job"),
    ("notes", "sentence", 6),
    ("referral_code", "pattern", "REF####"),
]

CUSTOMER_TRANSACTIONS = [
    ("customer_id", "integer", 1, 100000000),
    ("account_number", "iban"),
    ("full_name", "name"),
    ("email", "email"),
    ("phone", "phone"),
    ("address", "address"),
    ("date_of_birth", "day", -42000, 0),
    ("gender", "choice", "Male", "Female", "Other"),
    ("account_type", "choice", "Savings", "Checking", "Business"),
    ("account_open_date", "day", -1826, 0),
    ("last_transaction_date", "moment", -365, 0),
    ("kyc_verified", "boolean"),
    ("annual_income", "float", 5, 2),
    ("employment_status", "job"),
    ("credit_score", "integer", 300, 850),
    ("transaction_amount", "float", 4, 2),
    ("transaction_type", "choice", "Deposit", "Withdrawal", "Transfer", "Payment"),
    ("merchant_name", "company"),
    ("merchant_category", "slogan"),
    ("merchant_country", "country"),
    ("transaction_currency", "currency"),
    ("exchange_rate", "float", 2, 4),
    ("device_type", "choice", "Mobile", "Web", "ATM", "POS"),
    ("login_time", "moment", -30, 0),
    ("logout_time", "moment", -30, 0),
    ("ip_address", "ipv4"),
    ("session_duration", "integer", 1, 7200),
    ("risk_score", "float", 2, 2),
    ("loan_status", "choice", "Approved", "Rejected", "Pending"),
    ("loan_amount", "float", 4, 2),
    ("loan_type", "choice", "Home", "Auto", "Personal", "Credit Line"),
    ("repayment_schedule", "choice", "Monthly", "Quarterly", "Annually"),
    ("missed_payments", "integer", 0, 12),
    ("branch_code", "pattern", "BR###"),
    ("referral_code", "pattern", "REF####"),
    ("referred_by", "name"),
    ("marketing_opt_in", "boolean"),
    ("sms_alerts_enabled", "boolean"),
    ("email_alerts_enabled", "boolean"),
    ("overdraft_enabled", "boolean"),
    ("overdraft_limit", "float", 4, 2),
    ("last_login", "moment", -365, 0),
    ("failed_login_attempts", "integer", 0, 10),
    ("account_status", "choice", "Active", "Inactive", "Frozen", "Closed"),
    ("account_balance", "float", 5, 2),
    ("account_tier", "choice", "Basic", "Silver", "Gold", "Platinum"),
    ("rewards_points", "integer", 0, 10000),
    ("rewards_status", "choice", "Bronze", "Silver", "Gold"),
    ("preferred_language", "language"),
    ("number_of_dependents", "integer", 0, 5),
    ("residential_status", "choice", "Owner", "Renter", "Living with Parents"),
    ("housing_type", "choice", "Apartment", "House", "Townhouse"),
    ("social_security_number", "ssn"),
    ("passport_number", "pattern", "P########"),
    ("driver_license_number", "pattern", "DL#######"),
    ("employment_start_date", "day", -1826, 0),
    ("employment_end_date", "day", -1826, 0),
    ("tax_id", "pattern", "TIN#######"),
    ("salary_payment_frequency", "choice", "Weekly", "Bi-Weekly", "Monthly"),
    ("salary_account", "boolean"),
    ("pension_contribution", "float", 4, 2),
    ("insurance_policy_number", "pattern", "INS#######"),
    ("insurance_type", "choice", "Health", "Life", "Auto", "Home"),
    ("insurance_expiry_date", "day", 1, 30),
    ("investment_profile", "choice", "Conservative", "Balanced", "Aggressive"),
    ("crypto_wallet", "boolean"),
    ("crypto_balance", "float", 4, 2),
    ("mortgage_account", "boolean"),
    ("mortgage_balance", "float", 5, 2),
    ("rent_payment", "float", 4, 2),
    ("monthly_expenses", "float", 4, 2),
    ("savings_goal", "float", 4, 2),
    ("goal_completion_percentage", "float", 2, 2),
    ("blacklist_status", "boolean"),
    ("fraud_flag", "boolean"),
    ("source_system", "choice", "CRM", "MobileApp", "WebPortal", "Batch"),
    ("record_created_at", "moment", -365, 0),
    ("record_updated_at", "moment", -365, 0),
]

SPECS = {
    "stock_transactions": STOCK_TRANSACTIONS,
    "cash_transaction_history": CASH_TRANSACTION_HISTORY,
    "customer_information": CUSTOMER_INFORMATION,
    "customer_information_small": CUSTOMER_INFORMATION_SMALL,
    "customer_transactions": CUSTOMER_TRANSACTIONS,
}
