"""The data contract once more, for the SQL side: written apart from the engine's, so a wrong rule there is not wrong here too."""

from __future__ import annotations

# Keys as table: columns, with ! for unique ones beside the primary key.
KEYS = """
dim_date: date_sk
dim_date: full_date !
dim_customer: customer_sk
dim_product: product_sk
dim_product: product_name !
dim_merchant: merchant_sk
dim_campaign: campaign_sk
fact_account_monthly: customer_sk, product_sk, date_sk
fact_campaign_response: customer_sk, campaign_sk
customer_rfm_snapshot: customer_sk
"""

# References as table.column > parent.column.
REFERENCES = """
dim_campaign.target_product_sk > dim_product.product_sk
fact_transaction.customer_sk > dim_customer.customer_sk
fact_transaction.date_sk > dim_date.date_sk
fact_transaction.merchant_sk > dim_merchant.merchant_sk
fact_account_monthly.customer_sk > dim_customer.customer_sk
fact_account_monthly.product_sk > dim_product.product_sk
fact_account_monthly.date_sk > dim_date.date_sk
fact_campaign_response.customer_sk > dim_customer.customer_sk
fact_campaign_response.campaign_sk > dim_campaign.campaign_sk
fact_campaign_response.contact_date_sk > dim_date.date_sk
fact_campaign_response.response_date_sk > dim_date.date_sk
customer_rfm_snapshot.customer_sk > dim_customer.customer_sk
"""

# What makes a row a violation, as table | name | condition. A condition that is NULL is none.
VIOLATIONS = """
dim_date | quarter_range | quarter < 1 OR quarter > 4
dim_date | month_range | month < 1 OR month > 12
dim_date | day_of_month_range | day_of_month < 1 OR day_of_month > 31
dim_date | day_of_week_range | day_of_week < 1 OR day_of_week > 7
dim_date | is_weekend_flag | is_weekend <> 0 AND is_weekend <> 1
dim_date | is_month_end_flag | is_month_end <> 0 AND is_month_end <> 1
dim_date | year_month_shape | NOT regexp_full_match(year_month, '\\d{4}-\\d{2}')
dim_customer | gender_domain | gender <> 'M' AND gender <> 'F'
dim_customer | income_band_domain | income_band NOT IN ('low', 'low_mid', 'mid', 'high')
dim_customer | employment_domain | employment NOT IN ('employed', 'self_employed', 'retired', 'student')
dim_customer | age_range | age < 18 OR age > 120
dim_customer | tenure_not_negative | tenure_years < 0
dim_customer | products_not_negative | existing_product_count < 0
dim_customer | digital_flag | digital_engagement_flag <> 0 AND digital_engagement_flag <> 1
dim_product | group_domain | product_group NOT IN ('daily_banking', 'lending', 'deposits')
dim_product | target_flag | is_campaign_target <> 0 AND is_campaign_target <> 1
dim_merchant | category_domain | mcc_category NOT IN ('groceries', 'dining', 'ecommerce', 'entertainment', 'transport', 'fuel', 'utilities', 'healthcare', 'retail', 'travel', 'n/a')
dim_merchant | key_not_negative | merchant_sk < 0
dim_campaign | dates_ordered | end_date < start_date OR measurement_end_date < end_date
dim_campaign | share_range | treatment_share < 0 OR treatment_share > 1
dim_campaign | cost_not_negative | cost_per_contact_gel < 0
fact_transaction | type_domain | txn_type NOT IN ('purchase', 'cash_withdrawal', 'inflow')
fact_transaction | direction_domain | direction <> 'debit' AND direction <> 'credit'
fact_transaction | amount_not_negative | amount_gel < 0
fact_transaction | merchant_only_on_purchase | txn_type <> 'purchase' AND merchant_sk <> 0
fact_account_monthly | opened_flag | opened_this_month <> 0 AND opened_this_month <> 1
fact_account_monthly | held_flag | is_held <> 0 AND is_held <> 1
fact_campaign_response | assignment_domain | assignment <> 'treatment' AND assignment <> 'control'
fact_campaign_response | outcome_flags | contacted NOT IN (0, 1) OR responded NOT IN (0, 1) OR card_opened NOT IN (0, 1) OR activated NOT IN (0, 1)
fact_campaign_response | holdout_not_contacted | assignment NOT IN ('treatment', 'control') OR contacted <> CASE assignment WHEN 'treatment' THEN 1 ELSE 0 END
fact_campaign_response | activated_implies_opened | activated > card_opened
fact_campaign_response | response_is_activation | responded <> activated
fact_campaign_response | value_needs_response | responded <> 1 AND annual_value_gel <> 0
fact_campaign_response | cost_needs_contact | contacted <> 1 AND contact_cost_gel <> 0
fact_campaign_response | contact_date_matches_key | CASE WHEN contact_date IS NULL THEN contact_date_sk <> 0 ELSE contact_date_sk <= 0 END
fact_campaign_response | response_date_matches_key | CASE WHEN response_date IS NULL THEN response_date_sk <> 0 ELSE response_date_sk <= 0 END
"""


def keys() -> list[tuple[str, str, str]]:
    """(table, kind, columns)."""
    lines = [line.split(": ") for line in KEYS.strip().splitlines()]
    return [(table, "unique" if columns.endswith("!") else "primary", columns.removesuffix(" !")) for table, columns in lines]


def references() -> list[tuple[str, str, str, str]]:
    """(table, column, parent, its column)."""
    return [tuple(part for side in line.split(" > ") for part in side.split(".")) for line in REFERENCES.strip().splitlines()]


def violations() -> list[tuple[str, str, str]]:
    return [tuple(part.strip() for part in line.split(" | ", 2)) for line in VIOLATIONS.strip().splitlines()]
