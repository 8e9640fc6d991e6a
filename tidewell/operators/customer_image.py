"""The wide customer image and the envelope generator built on it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import codes
from tidewell.functions.clock import ISO_OFFSET_FORMAT
from tidewell.operators import cdc
from tidewell.sinks.files import (
    FILE_COUNT,
    RECORDS_PER_FILE,
    TARGET_FILE_MB,
    manifest,
    manifest_summary,
    write_manifest,
)

TABLE_NAME = "STOCK.CUSTOMER"
CUSTOM_ATTRIBUTES = 40

# The named fields of the image in record order, each as a SQL expression over
# `id` (the customer id) and `now` (the run time as text); {name} stands for the full name.
# `text` is the id as text; {pad8} is it padded with zeros to eight digits, and so on. Padding
# never cuts: ids longer than the pad keep all their digits.
IMAGE_FIELDS = r"""
customer_id = id
customer_code = concat('CUST', {pad7})
customer_type = 'INDIVIDUAL'
full_name = {name}
short_name = {name}
gender = CASE WHEN id % 2 = 0 THEN 'M' ELSE 'F' END
date_of_birth = '1990-05-20'
nationality = 'VN'
marital_status = 'SINGLE'
tax_code = concat('TAX', {pad8})
customer_status = 'ACTIVE'
risk_level = CASE WHEN id % 5 = 0 THEN 'HIGH' ELSE 'MEDIUM' END
segment = 'RETAIL'
branch_code = concat('BR', lpad(id % 20, 3, '0'))
broker_code = concat('BRK', lpad(id % 100, 3, '0'))
account_no = concat('ACC', {pad10})
trading_account_no = concat('TRADE', {pad10})
custody_account_no = concat('CSD', {pad10})
email = concat('customer', text, '@example.com')
mobile_phone = substring(concat('09', {pad8}), 1, 10)
home_phone = CAST(NULL AS STRING)
office_phone = CAST(NULL AS STRING)
fax = CAST(NULL AS STRING)
address_line1 = concat(text, ' Nguyen Hue Boulevard')
address_line2 = 'Tower A, Floor 12'
ward = 'Ben Nghe'
district = 'District 1'
province = 'Ho Chi Minh City'
country = 'Vietnam'
postal_code = '700000'
contact_person = concat('Contact ', text)
occupation = 'Engineer'
company_name = 'Example Securities Client Company'
job_title = 'Senior Specialist'
annual_income = '500000000'
net_worth = '1500000000'
source_of_funds = 'SALARY'
investment_experience = '5_YEARS'
risk_appetite = 'MEDIUM'
kyc_status = 'COMPLETED'
kyc_date = '2025-01-10'
aml_flag = false
pep_flag = false
sanction_flag = false
fatca_flag = false
fatca_country = CAST(NULL AS STRING)
crs_flag = false
crs_country = CAST(NULL AS STRING)
id_type = 'CCCD'
id_number = substring(concat('0790', {pad8}), 1, 12)
id_issue_date = '2022-07-15'
id_issue_place = 'Cuc Canh Sat QLHC'
id_expiry_date = '2037-07-15'
passport_number = CAST(NULL AS STRING)
passport_issue_date = CAST(NULL AS STRING)
passport_expiry_date = CAST(NULL AS STRING)
bank_account_no = substring(concat('9704', {pad12}), 1, 16)
bank_name = 'VCB'
bank_branch = 'Sai Gon'
settlement_method = 'BANK_TRANSFER'
cash_balance = '25000000.50'
margin_balance = '5000000.00'
loan_balance = '0'
credit_limit = '100000000'
available_limit = '95000000'
portfolio_value = '230000000.75'
realized_pnl = '1200000.25'
unrealized_pnl = '3500000.10'
last_trade_date = CAST(date_add(DATE'2024-10-01', CAST(id % 120 AS INT)) AS STRING)
last_login_ts = now
preferred_language = 'vi'
preferred_channel = 'MOBILE_APP'
sms_opt_in = true
email_opt_in = true
mobile_app_opt_in = true
marketing_opt_in = false
vip_flag = id % 10 = 0
priority_flag = id % 7 = 0
blacklist_flag = false
fraud_flag = false
relationship_manager = concat('RM', lpad(id % 100, 3, '0'))
referral_code = concat('REF', lpad(id % 1000, 3, '0'))
referrer_name = concat('Referrer ', text)
opened_date = '2024-06-01'
closed_date = CAST(NULL AS STRING)
created_by = 'SYSTEM'
created_ts = now
updated_by = 'SYSTEM'
updated_ts = now
approved_by = 'SUPERVISOR01'
approved_ts = now
remark = repeat(concat('Customer profile for ', {name}, '. Stock company customer record. customer_id=', text, '. '), 3)
source_system = 'CORE_CRM'
external_customer_id = concat('EXT', {pad8})
trading_permission = 'Y'
derivative_permission = 'N'
bond_permission = 'Y'
mutual_fund_permission = 'Y'
online_trading_flag = true
margin_trading_flag = true
securities_depository_flag = true
"""

# What an update also sets in the after image.
UPDATE_CHANGES = {
    "email": "concat('updated_', text, '@example.com')",
    "risk_level": "'HIGH'",
    "updated_by": "'BATCH_JOB'",
}


def image_expressions() -> dict[str, str]:
    """Field name to SQL expression, custom attributes included."""
    fields = dict(
        line.split(" = ", 1) for line in IMAGE_FIELDS.strip().splitlines()
    )
    for i in range(1, CUSTOM_ATTRIBUTES + 1):
        fields[f"custom_attr_{i:03d}"] = (
            f"concat('custom-value-', text, '-{i} | Customer profile payload attribute-sequence={i}')"
        )
    return fields


_PADS = {f"pad{n}": f"lpad(text, greatest({n}, length(text)), '0')" for n in (7, 8, 10, 12)}


def customer_image(name: str, changes: dict[str, str] | None = None) -> Column:
    """The image over columns ``id``, ``text`` and ``now``; ``name`` is the SQL of the full name."""
    fields = {**image_expressions(), **(changes or {})}
    return F.struct(*[F.expr(v.format(name=name, **_PADS)).alias(f) for f, v in fields.items()])


def customer_events(
    ids: DataFrame, key: str = "id", now: Column | None = None, rich_updates: bool = False
) -> DataFrame:
    """Envelopes for a frame of customer ids: operation by id modulo three.

    ``rich_updates`` also changes e-mail, risk level and author in updates, and moves commit number
    and position on by the operation's offset. Each side is one struct whose few differing fields
    depend on the operation, which keeps the wide expression single.
    """
    stamp = F.date_format(F.current_timestamp() if now is None else now, ISO_OFFSET_FORMAT)
    rows = ids.select(
        F.col(key).cast("long").alias("id"),
        F.col(key).cast("string").alias("text"),
        stamp.alias("now"),
        codes.operation_by_modulo(F.col(key)).alias("op"),
    )

    def name(suffix: str) -> str:
        return f"concat('Customer ', text, CASE WHEN op = 'U' THEN '{suffix}' ELSE '' END)"

    plain = image_expressions()
    changes = {
        field: f"CASE WHEN op = 'U' THEN {new} ELSE {plain[field]} END"
        for field, new in UPDATE_CHANGES.items()
    }
    op = F.col("op")
    shift = op if rich_updates else None
    return cdc.build_envelope(
        rows,
        TABLE_NAME,
        op,
        before=customer_image(name(" Old")),
        after=customer_image(name(" New"), changes if rich_updates else None),
        op_ts=F.col("now"),
        current_ts=F.col("now"),
        csn=cdc.commit_number(F.col("id"), shift),
        pos=cdc.log_position(F.col("id"), shift),
    )


def generate_customer_events(
    spark: SparkSession, rows: int, start: int = 1, rich_updates: bool = False, partitions=None
) -> DataFrame:
    """Envelopes for ``rows`` generated customers, ids from ``start``."""
    ids = spark.range(start, start + rows, 1, partitions) if partitions else spark.range(start, start + rows)
    return customer_events(ids, "id", rich_updates=rich_updates)


def generate_event_files(
    spark: SparkSession,
    path: str,
    file_count: int = FILE_COUNT,
    records_per_file: int = RECORDS_PER_FILE,
    target_file_mb: int = TARGET_FILE_MB,
    mode: str = "overwrite",
    fmt: str = "parquet",
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """``file_count`` files of ``records_per_file`` envelopes with a manifest; gives its summary.

    Each partition of the id range is one file, so the wide rows are never shuffled.
    """
    events = generate_customer_events(spark, file_count * records_per_file, partitions=file_count)
    events.write.format(fmt).option("maxRecordsPerFile", records_per_file).mode(mode).save(path)
    run_at = run_at or dt.datetime.now(dt.timezone.utc)
    listed = manifest(spark, path, fmt, run_at, records_per_file, target_file_mb)
    write_manifest(listed, path)
    return manifest_summary(listed)
