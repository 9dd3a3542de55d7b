"""Small literal frames in the reference's shapes."""

from pyspark.sql import functions as F

from kredo.sources import schemas


def filing(ref, ent, end, model="m02-f", lang="NL", improved=None, rubrics=(), year=None, **extra):
    row = {c: None for c in schemas.FILING_FIELDS}
    row.update(ReferenceNumber=ref, EnterpriseNumber=ent, EndDate=end, ModelType=model, Language=lang,
               ImprovementDate=improved, StartDate=None, EnterpriseName=f"name {ent}")
    row.update(extra)
    row["Rubrics"] = None if rubrics is None else [dict(Code=c, Period=p, Value=v) for c, p, v in rubrics]
    row["filing_year"] = year if year is not None else (int(end[:4]) if end and end[:4].isdigit() else 2022)
    return row


def filings_df(spark, rows):
    from pyspark.sql import types as T
    schema = T.StructType(list(schemas.FILING.fields) + [T.StructField("filing_year", T.LongType())])
    return spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)


def empty_dims(spark):
    e = spark.createDataFrame([], schemas.DIM_ENTERPRISE)
    a = spark.createDataFrame([], schemas.DIM_ADDRESS)
    act = spark.createDataFrame([], schemas.DIM_ACTIVITY).withColumnRenamed("EntityNumber", "EnterpriseNumber")
    return e, a, act


def healthy(total=100000.0, revenue=200000.0, fte="5", equity="50000", profit="1000"):
    """Rubrics of a plain healthy Micro company (current period)."""
    return [("20/58", "N", str(total)), ("70", "N", str(revenue)), ("9087", "N", fte),
            ("10/15", "N", equity), ("9904", "N", profit), ("490/1", "N", "300"), ("10", "N", "200")]


def col_values(df, c):
    return [r[0] for r in df.select(F.col(c)).collect()]
