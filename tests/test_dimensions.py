import datetime as dt

from kredo.operators import dimensions
from kredo.sources import schemas


def _addr(spark, rows):
    full = []
    for ent, typ, struck in rows:
        r = {c: None for c in schemas.DIM_ADDRESS.fieldNames()}
        r.update(EntityNumber=ent, TypeOfAddress=typ, DateStrikingOff=struck, Zipcode=typ)
        full.append(tuple(r[c] for c in schemas.DIM_ADDRESS.fieldNames()))
    return spark.createDataFrame(full, schemas.DIM_ADDRESS)


def test_preferred_address(spark):
    d = dt.date(2019, 12, 31)
    a = _addr(spark, [("1", "REGO", d), ("1", "BAET", None), ("2", "REGO", d), ("2", "ABBR", d)])
    got = {r["EntityNumber"]: r["TypeOfAddress"] for r in dimensions.preferred_address(a).collect()}
    assert got == {"1": "BAET", "2": "ABBR"}        # not struck off first; only struck-off: still one kept


def test_ranked_and_pivoted_activities(spark):
    rows = [("0001.000.001", "006", "2025", "01.110", "MAIN"), ("0001.000.001", "001", "2025", "99.000", "MAIN"),
            ("0001.000.001", "001", "2025", "45.200", "MAIN"), ("0001.000.001", "003", "2025", "45.200", "MAIN"),
            ("0001.000.001", "001", "2008", "00.100", "MAIN"), ("0001.000.001", "001", "2025", "00.200", "SECO"),
            ("0001.000.001", "002", "2025", "00.300", "MAIN")]
    act = spark.createDataFrame(rows, schemas.DIM_ACTIVITY).withColumnRenamed("EntityNumber", "EnterpriseNumber")
    ranked = [(r["NaceCode"], r["rn"]) for r in dimensions.ranked_activities(act).orderBy("rn").collect()]
    assert ranked == [("45.200", 1), ("99.000", 2), ("45.200", 3), ("01.110", 4)]
    p = dimensions.pivoted_activities(act).first()
    assert (p["nace_primary_code"], p["nace_primary_division"], p["nace_tertiary_code"]) == ("45.200", "45", "45.200")
    assert p["clean_enterprise_number"] == "0001000001"
