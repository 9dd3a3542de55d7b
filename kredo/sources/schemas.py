"""Declared schemas (never inferred: enterprise numbers keep leading zeros)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

RUBRIC = T.StructType([
    T.StructField("Code", S),
    T.StructField("Period", S),
    T.StructField("Value", S),
])
RUBRICS = T.ArrayType(RUBRIC)

# FIXED VALUES: one annual-account filing: 22 scalars + the nested rubrics.
FILING_FIELDS = [
    "ReferenceNumber", "DepositDate", "StartDate", "EndDate", "ModelType",
    "DepositType", "Language", "Currency", "EnterpriseNumber", "EnterpriseName",
    "Address", "LegalForm", "LegalSituation", "FullFillLegalValidation",
    "ActivityCode", "AccountingDataURL", "ImprovementDate", "CorrectedData",
    "DataVersion", "EnterpriseName_historic", "Address_historic",
    "LegalForm_historic",
]
FILING = T.StructType([T.StructField(c, S) for c in FILING_FIELDS] + [T.StructField("Rubrics", RUBRICS)])

# Landed filing as the web service returns it: two documents per filing.
# FIXED VALUES: the web service's field names.  FilingYear is the year that was requested; a line with
# neither document says that the enterprise has no filing for that year.
RAW_FILING = T.StructType([
    T.StructField("EnterpriseNumber", S),
    T.StructField("FilingYear", T.LongType()),
    T.StructField("data", T.StructType([
        T.StructField("referenceNumber", S),
        T.StructField("EnterpriseName", S),
        T.StructField("Address", S),
        T.StructField("LegalForm", S),
        T.StructField("Rubrics", RUBRICS),
    ])),
    T.StructField("reference", T.StructType([
        T.StructField("DepositDate", S),
        T.StructField("ExerciseDates", T.StructType([
            T.StructField("startDate", S), T.StructField("endDate", S)])),
        T.StructField("ModelType", S),
        T.StructField("DepositType", S),
        T.StructField("Language", S),
        T.StructField("Currency", S),
        T.StructField("EnterpriseName", S),
        T.StructField("Address", S),
        T.StructField("LegalForm", S),
        T.StructField("LegalSituation", S),
        T.StructField("FullFillLegalValidation", S),
        T.StructField("ActivityCode", S),
        T.StructField("AccountingDataURL", S),
        T.StructField("ImprovementDate", S),
        T.StructField("CorrectedData", S),
        T.StructField("DataVersion", S),
    ])),
])


# How a landed line is read: a line that is no such document is kept as text.
CORRUPT = "_corrupt_record"
LANDED = T.StructType([*RAW_FILING.fields, T.StructField(CORRUPT, S)])


def _schema(cols: list[str], dates: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([T.StructField(c, T.DateType() if c in dates else S) for c in cols])


DIM_ENTERPRISE = _schema(["EnterpriseNumber", "Status", "JuridicalSituation", "TypeOfEnterprise",
                          "JuridicalForm", "JuridicalFormCAC", "StartDate"], ("StartDate",))
DIM_ADDRESS = _schema(["EntityNumber", "TypeOfAddress", "CountryNL", "CountryFR", "Zipcode",
                       "MunicipalityNL", "MunicipalityFR", "StreetNL", "StreetFR", "HouseNumber",
                       "Box", "ExtraAddressInfo", "DateStrikingOff"], ("DateStrikingOff",))
DIM_ACTIVITY = _schema(["EntityNumber", "ActivityGroup", "NaceVersion", "NaceCode", "Classification"])
DIM_DENOMINATION = _schema(["EntityNumber", "Language", "TypeOfDenomination", "Denomination"])
DIM_CODE = _schema(["Category", "Code", "Language", "Description"])
DIM_NACE_MAPPING = _schema(["Level", "Code", "Sector"])
MACRO = T.StructType([
    T.StructField("year", T.LongType()),
    T.StructField("interest_rate", T.DoubleType()),
    T.StructField("inflation", T.DoubleType()),
])

DIMENSIONS = {
    "dim_enterprise": DIM_ENTERPRISE,
    "dim_address": DIM_ADDRESS,
    "dim_activity": DIM_ACTIVITY,
    "dim_denomination": DIM_DENOMINATION,
    "dim_code": DIM_CODE,
    "dim_nace_mapping": DIM_NACE_MAPPING,
}


def date_columns(schema: T.StructType) -> list[str]:
    """Names of the DATE columns of a dimension schema."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.DateType)]


def as_text(schema: T.StructType) -> T.StructType:
    """Same columns, all text: how a CSV is read before dates are parsed."""
    return T.StructType([T.StructField(f.name, S) for f in schema.fields])
