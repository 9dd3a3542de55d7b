"""Filings and register dimensions derived from the driver's TPC-H-like tables.

The reference ships no data; these tables have the reference's shapes and are
derived row by row from ``orders``, ``customer`` and ``nation`` (the rules are
in FIXTURES.md section 3).  All derivations are narrow projections plus one
join with ``customer``: rubric arrays are built per filing in one codegen'd
projection, so the derived data grows with the driver tables and costs no
shuffle of its own.

The rules are written once as SQL snippets.  ``dialect='spark'`` feeds
``selectExpr`` here; ``dialect='duckdb'`` feeds the oracle, which keeps the
rubrics in long form (no arrays) as an independent check of the nesting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kredo.functions import codes
from kredo.functions.scalars import dmy_to_date
from kredo.sources import schemas

# Periods written into the derived rubrics, with their hash offsets.
FIXTURE_PERIODS = (("N", 0), ("NM1", 5), ("X", 9))
# Rubric positions (0-based, order of codes.RUBRICS) with special value rules.
_ASSETS, _FTE, _EQUITY, _REVENUE = 0, 1, 2, 3
_RESULT_CODES = (4, 7, 28, 8)          # 9904, 9901, 9903, 9905
_NONNEG_CODES = (25, 14)               # 490/1, 10
ACTIVITY_GROUPS = ("001", "003", "006", "001", "002")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt by a key over the shuffle partitions.

    The per-filing work that follows (building ~100 rubrics per row) is heavy and the rows are narrow,
    so they are always dealt, whatever the number of input splits.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


# ---------------------------------------------------------------- snippets

def _idiv(a: str, b: int, dialect: str) -> str:
    return f"({a} div {b})" if dialect == "spark" else f"({a} // {b})"


def _pad(x: str, n: int) -> str:
    """Left-pad the decimal text of x with zeros to n; never truncate."""
    s = f"CAST({x} AS STRING)"
    return f"(CASE WHEN length({s}) >= {n} THEN {s} ELSE lpad({s}, {n}, '0') END)"


def dotted(x: str) -> str:
    """Enterprise number text '0ddd.ddd.ddd' of an integer key."""
    p = _pad(x, 9)
    return f"('0' || substr({p}, 1, 3) || '.' || substr({p}, 4, 3) || '.' || substr({p}, 7))"


def order_cols() -> list[str]:
    """k, cu, tp, y, name and the raw columns the filing rules need."""
    return [
        "o_orderkey AS k", "o_custkey AS cu",
        "CAST(floor(o_totalprice) AS BIGINT) AS tp",
        "CAST(year(o_orderdate) + 25 AS BIGINT) AS y",
        "o_orderstatus", "o_orderpriority", "c_name",
    ]


def filing_cols() -> list[str]:
    """Scalar filing columns over (k, cu, tp, y, o_orderstatus, o_orderpriority, c_name)."""
    return [
        f"CAST(y AS STRING) || '-' || {_pad('k', 8)} AS ReferenceNumber",
        "CAST(y + 1 AS STRING) || '-03-31' AS DepositDate",
        "CAST(y AS STRING) || '-01-01' AS StartDate",
        "CAST(y AS STRING) || '-12-31' AS EndDate",
        "(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'm02' WHEN '2' THEN 'm01' "
        "WHEN '3' THEN 'm07' WHEN '4' THEN 'm87' WHEN '5' THEN 'm120' END) || "
        "(CASE WHEN k % 11 = 0 THEN '-p' ELSE '-f' END) AS ModelType",
        "'Initial' AS DepositType",
        "(CASE o_orderstatus WHEN 'O' THEN 'NL' WHEN 'F' THEN 'FR' WHEN 'P' THEN 'DE' END) AS Language",
        "'EUR' AS Currency",
        f"{dotted('cu')} AS EnterpriseNumber",
        "c_name AS EnterpriseName",
        "CAST(NULL AS STRING) AS Address",
        "'014' AS LegalForm",
        "'000' AS LegalSituation",
        "'Y' AS FullFillLegalValidation",
        "CAST(NULL AS STRING) AS ActivityCode",
        "CAST(NULL AS STRING) AS AccountingDataURL",
        "(CASE WHEN k % 3 = 0 THEN CAST(y + 1 AS STRING) || '-06-' || "
        "lpad(CAST(1 + k % 28 AS STRING), 2, '0') END) AS ImprovementDate",
        "'N' AS CorrectedData",
        "'1' AS DataVersion",
        "c_name AS EnterpriseName_historic",
        "CAST(NULL AS STRING) AS Address_historic",
        "'014' AS LegalForm_historic",
    ]


def rubric_keep(i: str) -> str:
    return f"(k + {i}) % 7 <> 0"


def rubric_code(i: int, dialect: str = "spark") -> str:
    spec = codes.RUBRICS[i]
    if spec.alt is None:
        return f"'{spec.code}'"
    return f"(CASE WHEN (k + {i}) % 10 = 0 THEN '{spec.alt}' ELSE '{spec.code}' END)"


def rubric_value(i: int, d: int, dialect: str = "spark") -> str:
    """Value text of rubric i in the period with hash offset d (first match wins)."""
    h = f"(((k + 13) * {2 * i + 7919 + d} + cu * 31) % 1009)"
    t10 = _idiv("tp", 10, dialect)
    if i == _ASSETS:
        v = f"(CASE WHEN k % 23 = 0 THEN {h} % 1000 ELSE tp * (1 + {h} % 20) END)"
    elif i == _REVENUE:
        v = f"(CASE WHEN k % 23 = 0 THEN {h} % 1000 ELSE tp * ({h} % 30) END)"
    elif i == _FTE:
        v = f"(CASE WHEN {h} % 5 = 0 THEN 0 ELSE {h} % 70 END)"
    elif i == _EQUITY:
        v = f"(tp * ({h} % 24 - 4))"
    elif i in _RESULT_CODES:
        v = f"({t10} * ({h} % 21 - 8))"
    elif i in _NONNEG_CODES:
        v = f"({t10} * ({h} % 21))"
    else:
        v = f"({t10} * ({h} % 21 - 5))"
    return f"(CASE WHEN (k * 7 + {i}) % 97 = 0 THEN 'n/a' ELSE CAST({v} AS STRING) END)"


def rubrics_array_sql() -> str:
    """Spark SQL: the array<struct<Code,Period,Value>> of one filing.

    A concatenation of one-element (kept) or empty (dropped) arrays: all
    codegen'd expressions, no lambda over the elements.
    """
    elems = []
    for period, d in FIXTURE_PERIODS:
        for i in range(len(codes.RUBRICS)):
            elems.append(
                f"CASE WHEN {rubric_keep(str(i))} THEN array(named_struct('Code', {rubric_code(i)}, "
                f"'Period', '{period}', 'Value', {rubric_value(i, d)})) ELSE array() END")
    return f"concat({', '.join(elems)})"


# ---------------------------------------------------------------- Spark frames

def _orders_with_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"), "o_orderkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    # customer grows with the data: Spark's size-checked planner decides broadcast vs shuffle.
    return o.join(c, o["o_custkey"] == c["c_custkey"], "left").selectExpr(*order_cols())


def filings(spark: SparkSession, sf_dir: str, by_year: bool = False) -> DataFrame:
    """One nested filing per order: FILING schema plus ``filing_year``.

    ``filing_year`` plays the role of the per-year table suffix (2020-2026).  ``by_year``: each task gives its filings
    by year, as a write by year needs them.  The narrow rows are sorted, not the rubric arrays (~14 KB a filing).
    """
    base = _orders_with_names(spark, sf_dir)
    if by_year:
        base = base.sortWithinPartitions("y")
    # Every expression already has the declared type (text, array of text structs): no cast pass.
    return base.selectExpr(*filing_cols(), f"{rubrics_array_sql()} AS Rubrics", "y AS filing_year")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")


def dim_enterprise_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir).where("c_custkey % 50 <> 0")
    return c.selectExpr(
        f"{dotted('c_custkey')} AS EnterpriseNumber",
        "'AC' AS Status",
        "(CASE c_custkey % 20 WHEN 0 THEN '010' WHEN 1 THEN '050' WHEN 2 THEN '012' ELSE '000' END)"
        " AS JuridicalSituation",
        "'2' AS TypeOfEnterprise", "'014' AS JuridicalForm",
        "CAST(NULL AS STRING) AS JuridicalFormCAC",
        "'01-02-' || CAST(1970 + c_custkey % 50 AS STRING) AS StartDate")


def dim_address_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir)
    # nation has 25 rows at every scale: a fixed-size broadcast.
    n = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
    j = j.withColumn("TypeOfAddress", F.explode(F.expr(
        "CASE WHEN c_custkey % 7 = 0 THEN array('REGO', 'BAET') ELSE array('REGO') END")))
    return j.selectExpr(
        f"{dotted('c_custkey')} AS EntityNumber", "TypeOfAddress",
        "'Belgie' AS CountryNL", "'Belgique' AS CountryFR",
        "CAST(1000 + c_nationkey * 10 AS STRING) AS Zipcode",
        "n_name AS MunicipalityNL", "n_name AS MunicipalityFR",
        "CAST(NULL AS STRING) AS StreetNL", "CAST(NULL AS STRING) AS StreetFR",
        "CAST(NULL AS STRING) AS HouseNumber", "CAST(NULL AS STRING) AS Box",
        "CAST(NULL AS STRING) AS ExtraAddressInfo",
        "CASE WHEN c_custkey % 7 = 0 AND TypeOfAddress = 'REGO' THEN '31-12-2019' END AS DateStrikingOff")


def nace_code_sql(cu: str, j: str) -> str:
    return (f"lpad(CAST(1 + ({cu} * 17 + {j} * 29) % 99 AS STRING), 2, '0') || '.' || "
            f"lpad(CAST(({cu} * 7 + {j} * 311) % 1000 AS STRING), 3, '0')")


def dim_activity_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _customers(spark, sf_dir).where("c_custkey % 13 <> 0")
    c = c.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(ACTIVITY_GROUPS) - 1))))
    groups = ", ".join(f"'{g}'" for g in ACTIVITY_GROUPS)
    return c.selectExpr(
        f"{dotted('c_custkey')} AS EntityNumber",
        f"element_at(array({groups}), j + 1) AS ActivityGroup",
        "CASE WHEN (c_custkey + j) % 6 = 0 THEN '2008' ELSE '2025' END AS NaceVersion",
        f"{nace_code_sql('c_custkey', 'j')} AS NaceCode",
        "CASE WHEN (c_custkey + j) % 5 = 0 THEN 'SECO' ELSE 'MAIN' END AS Classification")


def sector_of_division_sql(n: str) -> str:
    """Our sector grouping of 2-digit NACE divisions (the reference's is unpublished)."""
    return (f"CASE WHEN {n} BETWEEN 41 AND 43 THEN 'bouw' WHEN {n} BETWEEN 45 AND 47 THEN 'handel' "
            f"WHEN {n} BETWEEN 58 AND 82 THEN 'diensten' ELSE 'overig' END")


def dim_nace_mapping(spark: SparkSession) -> DataFrame:
    """99 divisions -> sector; a fixed-size lookup table."""
    return spark.range(1, 100).selectExpr(
        "'2' AS Level", "lpad(CAST(id AS STRING), 2, '0') AS Code",
        f"{sector_of_division_sql('id')} AS Sector")


def macro(spark: SparkSession) -> DataFrame:
    """Yearly macro indicators 2020-2026 (names ours)."""
    return spark.range(2020, 2027).selectExpr(
        "id AS year", "CAST(id - 2020 AS DOUBLE) * CAST(0.5 AS DOUBLE) - CAST(0.5 AS DOUBLE) AS interest_rate",
        "CAST((id * 7) % 10 AS DOUBLE) AS inflation")


def _with_dates(df: DataFrame, schema) -> DataFrame:
    dates = set(schemas.date_columns(schema))
    return df.select(*[dmy_to_date(c).alias(c) if c in dates else F.col(c) for c in df.columns])


def dim_enterprise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_dates(dim_enterprise_text(spark, sf_dir), schemas.DIM_ENTERPRISE)


def dim_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_dates(dim_address_text(spark, sf_dir), schemas.DIM_ADDRESS)


def dim_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Activities as the staging SQL reads them: ``EntityNumber`` renamed."""
    return dim_activity_text(spark, sf_dir).withColumnRenamed("EntityNumber", "EnterpriseNumber")


def enterprise_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input list of the ingest job: one row per order's enterprise (duplicates kept)."""
    o = table(spark, sf_dir, "orders").select("o_custkey")
    return o.selectExpr(f"{dotted('o_custkey')} AS EnterpriseNumber")


def score_sql(cu: str, y: str, label: str) -> str:
    """Deterministic model score of a labelled window (for metric operators)."""
    return f"CAST((({cu} * 37 + {y} * 11) % 100) + 40 * {label} AS DOUBLE) / CAST(140 AS DOUBLE)"


def rule_cluster_sql(cu: str) -> str:
    """Deterministic cluster id standing in for k-means labels (exact profiles)."""
    return f"(({cu} * 13) % 32)"


# ---------------------------------------------------------------- stored derived tables

def _input_signature(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> str:
    """Sizes and modification times of all files of the driver tables a derived table is built from."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    parts = []
    for n in names:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{n}.parquet")
        files = p.getFileSystem(conf).listFiles(p, True)
        found = []
        while files.hasNext():
            st = files.next()
            found.append(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}")
        parts.append(f"{n}:" + ",".join(sorted(found)))
    return ";".join(parts)


def stored(spark: SparkSession, sf_dir: str, name: str, build, inputs: tuple[str, ...],
           partition_by: str | None = None) -> DataFrame:
    """A derived table written once to the shared checkpoint folder, then read like any stored table.

    The folder name is a hash of the derivation rules and the input files, so
    a changed rule or input gives a new table.  The write goes to a private
    temporary folder first and is renamed into place, so concurrent callers
    and failed writes never expose a partial table.
    """
    import hashlib
    import inspect
    import uuid

    from kredo.session import shared_path
    rules = inspect.getsource(filings) + inspect.getsource(stored_filings) + rubrics_array_sql() + "|".join(filing_cols()) + "|".join(order_cols())
    key = hashlib.sha1(f"{name}|{sf_dir}|{_input_signature(spark, sf_dir, inputs)}|{rules}".encode()).hexdigest()[:16]
    final = shared_path(spark, "kredo-derived", f"{name}-{key}")
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    fpath = jvm.org.apache.hadoop.fs.Path(final)
    fs = fpath.getFileSystem(conf)
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{final}/_SUCCESS")):
        # A hidden name ('.'): should a concurrent writer's rename land it inside
        # the finished table, Spark's file listing still skips it.
        parent, base = final.rsplit("/", 1)
        tmp_name = f".{base}.tmp-{uuid.uuid4().hex}"
        tmp = jvm.org.apache.hadoop.fs.Path(f"{parent}/{tmp_name}")
        # The values of rubrics hardly repeat: a dictionary of them is built for nothing, and copied on every read.
        w = build().write.mode("overwrite").option("parquet.enable.dictionary#Rubrics.list.element.Value", "false")
        (w.partitionBy(partition_by) if partition_by else w).parquet(tmp.toString())
        if fs.exists(fpath) or not fs.rename(tmp, fpath):
            fs.delete(tmp, True)                          # another writer won: use its table
        nested = jvm.org.apache.hadoop.fs.Path(f"{final}/{tmp_name}")
        if fs.exists(nested):
            fs.delete(nested, True)
        if not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{final}/_SUCCESS")):
            raise RuntimeError(f"unfinished table at {final}; remove it and run again")
    return spark.read.parquet(final)


def stored_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived filings as a stored table partitioned by ``filing_year`` (the per-year tables).

    Without a JVM handle (e.g. a Connect session) the filings are derived
    lazily instead; results are the same.
    """
    try:
        spark._jvm.org.apache.hadoop.fs.Path  # noqa: B018 - probe for a classic session
    except Exception:  # noqa: BLE001
        return filings(spark, sf_dir)
    df = stored(spark, sf_dir, "filings", lambda: filings(spark, sf_dir, by_year=True).withColumn(
        "_n_rubrics", F.coalesce(F.size("Rubrics"), F.lit(0))), ("orders", "customer"), "filing_year")
    return df.select(*schemas.FILING.fieldNames(), F.col("filing_year").cast("bigint").alias("filing_year"), "_n_rubrics",
                     file_row_id())


def file_row_id() -> "F.Column":
    """A stable id of a stored row: (hash of its file, its position in the file).

    Read straight from the file's metadata, it is the same in every scan of
    the table and on every task retry (unlike an id assigned at run time).
    Use on a DataFrame fresh from one file read: it is unique within one scan
    of a table (a union of two reads of the same files would repeat ids).
    """
    return F.struct(F.xxhash64(F.col("_metadata.file_path")).alias("file"),
                    F.col("_metadata.row_index").alias("row")).alias("_filing_id")
