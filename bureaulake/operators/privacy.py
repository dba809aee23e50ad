"""Personal data: find columns by name, mask values, scan free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureaulake.functions.bins import case
from bureaulake.operators.ranking import hash_bucket, row_number_in_buckets

# Words that mark a column, by category, with the masking method.
NAME_WORDS = {
    "names": ["name", "names", "first_name", "last_name", "full_name", "customer_name", "applicant_name", "client_name",
              "contact_name", "person_name"],
    "emails": ["email", "emails", "email_address", "e_mail", "mail", "contact_email", "customer_email"],
    "phones": ["phone", "phones", "telephone", "mobile", "cell", "contact_number", "phone_number", "mobile_number",
               "telephone_number"],
    "ids": ["national_id", "passport", "passport_number", "ssn", "social_security", "driver_license", "drivers_license", "vin",
            "employee_id", "customer_id", "applicant_id"],
    "addresses": ["address", "addresses", "home_address", "billing_address", "mailing_address", "street", "city", "postal",
                  "zip", "zipcode", "postcode", "location"],
}
METHODS = {"names": "tokenize", "emails": "hash", "phones": "hash", "ids": "hash", "addresses": "generalize"}


def column_category(name: Column) -> Column:
    """Category of a column name by whole words (an underscore is part of a word), or null."""
    lowered = F.lower(F.trim(name))
    return case([(lowered.rlike(r"\b(" + "|".join(words) + r")\b"), c) for c, words in NAME_WORDS.items()])


def masking_method(category: Column) -> Column:
    return case([(category == c, m) for c, m in METHODS.items()])


def masked_hash(value: Column, salt: str) -> Column:
    """First 16 hex digits of the salted SHA-256; blanks stay as they are."""
    text = F.trim(value.cast("string"))
    return F.when(text != "", F.substring(F.sha2(F.concat(F.lit(salt), text), 256), 1, 16)).otherwise(value.cast("string"))


def generalised(value: Column, column: str) -> Column:
    name = column.lower()
    if any(w in name for w in ("name", "email", "phone")):
        text = "[REDACTED]"
    elif any(w in name for w in ("address", "street", "city")):
        text = "[LOCATION]"
    elif any(w in name for w in ("id", "ssn", "passport")):
        text = "[ID]"
    else:
        text = "[PII]"
    return F.when(F.trim(value.cast("string")) != "", F.lit(text)).otherwise(value.cast("string"))


def tokens(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with a dense token number in hash order: stable across runs and partitionings."""
    value = F.trim(F.col(column).cast("string"))
    distinct = df.select(value.alias("value")).filter("value <> ''").distinct().withColumn("digest", F.sha2("value", 256))
    ranked = row_number_in_buckets(distinct, [], hash_bucket(F.col("digest")), [F.col("digest")], "token_no")
    return ranked.select("value", F.concat(F.lit(f"PII_{column}_"), F.col("token_no")).alias("token"))


def mask(df: DataFrame, methods: dict[str, str], salt: str = "") -> DataFrame:
    """Whole table with the given columns masked; only ``tokenize`` needs a join."""
    out = df
    for column, method in methods.items():
        if method == "tokenize":
            lookup = tokens(df, column).withColumnRenamed("token", "_token")
            out = (out.withColumn("value", F.trim(F.col(column).cast("string"))).join(lookup, "value", "left")
                   .withColumn(column, F.coalesce("_token", F.col(column).cast("string"))).drop("value", "_token"))
        elif method == "generalize":
            out = out.withColumn(column, generalised(F.col(column), column))
        else:
            out = out.withColumn(column, masked_hash(F.col(column), salt))
    return out


# Kinds of values inside running text. The first ones tell who someone is and are redacted in this order, so that a
# number that belongs to an earlier kind isn't taken for a later one.
TEXT_PII = {
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "uuid": r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b",
    "credit_card": r"\b[0-9]{13,19}\b",
    "date_string": r"\b[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}\b",
    "phone": r"[+]?[(]?\b[0-9]{3,4}[)]?[- .]?[(]?[0-9]{3,4}[)]?[- .]?[0-9]{3,9}\b",
    "national_id": r"\b[A-Z]{1,3}[0-9]{5,17}\b",
}
TEXT_KINDS = TEXT_PII | {
    "guid": r"\{[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\}",
    "alphanumeric": r"\b([A-Za-z]+[0-9]|[0-9]+[A-Za-z])[A-Za-z0-9]*\b",
    "numeric": r"\b[0-9]+\b",
}
# A text without this sign or a digit cannot hold the kind, so its pattern is not tried. One look for digits serves eight kinds.
NEEDS = {"email": "@", "uuid": "-", "date_string": None, "credit_card": None, "phone": None, "national_id": None, "guid": "{", "alphanumeric": None, "numeric": None}
#: A kind as long as this needs so many digits beside each other.
DIGITS = {"credit_card": r"[0-9]{13}", "national_id": r"[A-Z][0-9]{5}", "phone": r"[0-9]{3}", "date_string": r"[0-9]{4}[-/][0-9]"}


def may_hold(text: Column, name: str) -> Column:
    """A cheap test that every text with the kind passes."""
    if NEEDS[name]:
        return text.contains(NEEDS[name])
    return text.rlike(DIGITS.get(name, "[0-9]"))


def count_in_text(text: Column, name: str) -> Column:
    found = F.regexp_count(text, F.lit(TEXT_KINDS[name]))
    return F.when(text.isNotNull(), F.when(may_hold(text, name), found).otherwise(0))


def redact_text(text: Column) -> Column:
    """Whole text with every hit of the kinds that identify someone replaced by its kind."""
    for name, pattern in TEXT_PII.items():
        text = F.when(may_hold(text, name), F.regexp_replace(text, pattern, f"[{name.upper()}]")).otherwise(text)
    return text
