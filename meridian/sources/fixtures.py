"""Test relations derived from the driver tables, as SQL that Spark and DuckDB both run.

EPOCH(c) stands for seconds since 1970 of a timestamp without zone, SPREAD(t.c) for the array column's elements as
(pos, col) beside the table's columns.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

FIXTURES = {
    "fx_vis": """
        SELECT event_id AS sample_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS freq_id,
        user_id AS input_id, t, CAST(floor((t-1704067200)/86164.0989e0) AS BIGINT) AS lsd,
        360*((t-1704067200)/86164.0989e0 - floor((t-1704067200)/86164.0989e0)) AS ra, value AS re, CAST(k-50 AS DOUBLE) AS im,
        CASE WHEN k%10=0 THEN 0.0e0 ELSE (k%10)/4.0e0 END AS w, (k%25)/500.0e0 AS frac_lost
        FROM (SELECT *, EPOCH(ts) AS t, cast(regexp_extract(props,'([0-9]+)',1) as int) AS k FROM events)
    """,
    "fx_input": """
        SELECT DISTINCT user_id AS input_id, user_id%4 AS cyl, CASE WHEN user_id%8<4 THEN 'X' ELSE 'Y' END AS pol,
        22.0e0*(user_id%4) AS x, 0.3e0*floor(user_id/8) AS y, user_id%13<>0 AS good FROM events
    """,
    "fx_baseline": """
        SELECT a.input_id*32+b.input_id-a.input_id AS prod_id, a.input_id AS input_a, b.input_id AS input_b, concat(a.pol,b.pol) AS pol, abs(a.cyl-b.cyl) AS xind, a.x-b.x AS dx, a.y-b.y AS dy
        FROM fx_input a JOIN fx_input b ON a.input_id<=b.input_id AND b.input_id<a.input_id+32
    """,
    "fx_day": """
        SELECT lsd, freq_id, stack_id, ra_id, 15.0e0*ra_id AS ra, (lsd+ra_id/24.0e0)*5184000.0e0 AS t, avg(p/1000) AS re, avg(100*d) AS im,
        sum(q)*CASE WHEN (lsd+freq_id+ra_id)%11=0 THEN 0.0e0 ELSE 1.0e0 END AS w
        FROM (SELECT CAST(floor(EPOCH(l_shipdate)/5184000) AS BIGINT) AS lsd, CAST(l_linenumber AS BIGINT) AS freq_id, l_suppkey%5 AS stack_id, l_partkey%24 AS ra_id, l_extendedprice AS p, l_discount AS d, l_quantity AS q FROM lineitem)
        GROUP BY lsd, freq_id, stack_id, ra_id
    """,
    "fx_cell": """
        SELECT l_orderkey, l_linenumber, EPOCH(l_shipdate) AS t, l_suppkey%32 AS input_id, l_partkey%8 AS freq_id, avg(l_extendedprice/1000) AS re, avg(l_tax*100) AS im, sum(l_quantity) AS w
        FROM lineitem GROUP BY 1,2,3,4,5
    """,
    "fx_gain": """
        SELECT EPOCH(o_orderdate) AS update_t, o_custkey%32 AS input_id, o_orderkey%8 AS freq_id, avg(o_totalprice/100000) AS re, avg((o_orderkey%7)/10.0e0) AS im,
        max(CASE WHEN o_orderpriority='5-LOW' THEN 0.0e0 ELSE 1.0e0 END) AS w, max(CASE WHEN o_orderpriority='1-URGENT' THEN 'transition' ELSE 'gain' END) AS update_kind FROM orders GROUP BY 1,2,3
    """,
    "fx_flag_vis": """
        SELECT event_id AS flag_id, CASE WHEN user_id%2=0 THEN 'rain1mm' ELSE 'acjump' END AS flag_type, EPOCH(ts) AS start_t, EPOCH(ts)+cast(regexp_extract(props,'([0-9]+)',1) as int)*60.0e0 AS finish_t,
        CASE WHEN user_id%3=0 THEN NULL ELSE user_id%5 END AS freq_id FROM events WHERE event_type='error'
    """,
    "fx_flag_meta": """
        SELECT event_id AS flag_id, EPOCH(ts) AS start_t, EPOCH(ts)+600.0e0 AS finish_t, props AS metadata, cast(regexp_extract(props,'([0-9]+)',1) as int) AS k FROM events WHERE event_type='error'
    """,
    "fx_flag_day": """
        SELECT o_orderkey AS flag_id, CASE o_orderstatus WHEN 'F' THEN 'rain1mm' WHEN 'O' THEN 'acjump' ELSE 'globalflag' END AS flag_type, EPOCH(o_orderdate) AS start_t,
        EPOCH(o_orderdate)+(1+o_orderkey%72)*600.0e0 AS finish_t, CASE WHEN o_orderkey%3=0 THEN NULL ELSE 1+o_orderkey%7 END AS freq_id FROM orders
    """,
    "fx_weather": """
        SELECT event_id, EPOCH(ts) AS t, value/100 AS rain, cast(regexp_extract(props,'([0-9]+)',1) as int)/2.0e0 AS temperature FROM events WHERE event_type='view'
    """,
    "fx_spec": """
        SELECT vec_id%4 AS freq_id, CAST(floor(vec_id/4) AS BIGINT)%8 AS beam, CAST(floor(vec_id/32) AS BIGINT) AS t_id, CAST(pos AS INT) AS subfreq, 1.0e0+CAST(col AS DOUBLE) AS x,
        CASE WHEN (vec_id+pos)%17=0 THEN 0.0e0 ELSE 1.0e0+vec_id%3 END AS w FROM SPREAD(embeddings.embedding)
    """,
    "fx_map": """
        SELECT CAST(l_linenumber AS BIGINT) AS freq_id, l_partkey%180 AS ra_id, l_suppkey%10 AS el_id, 2.0e0*(l_partkey%180) AS ra, -0.9e0+0.2e0*(l_suppkey%10) AS el, avg(l_extendedprice/1000)-50 AS val, CAST(count(*) AS DOUBLE) AS w
        FROM lineitem GROUP BY 1,2,3,4,5
    """,
    "fx_catalog": """
        SELECT s_suppkey AS source_id, s_name AS name, s_suppkey*137.50776e0 - 360*floor(s_suppkey*137.50776e0/360) AS ra, CAST((s_suppkey*31)%90 AS DOUBLE) AS dec, abs(s_acctbal)/10 AS flux, 1.0e0+(s_suppkey%100)/100.0e0 AS z FROM supplier
    """,
    "fx_file": """
        SELECT o_orderkey AS file_id, o_custkey%20 AS acq_id, EPOCH(o_orderdate)+(o_orderkey%24)*3600.0e0 AS start_t, EPOCH(o_orderdate)+(o_orderkey%24)*3600.0e0+7200.0e0+(o_orderkey%5)*3600.0e0 AS finish_t,
        o_orderstatus='F' AS online, o_orderkey%50<>0 AS has_file, CASE WHEN o_orderpriority='5-LOW' THEN 'weather' ELSE 'corr' END AS acqtype FROM orders
    """,
    "fx_polmap": """
        SELECT CAST(l_linenumber AS BIGINT) AS freq_id, l_partkey%180 AS ra_id, l_suppkey%10 AS el_id, l_orderkey%2 AS pol, avg(l_extendedprice/1000)-50 AS val, CAST(count(*) AS DOUBLE) AS w FROM lineitem GROUP BY 1,2,3,4
    """,
    "fx_wide": """
        SELECT CAST(floor(EPOCH(l_shipdate)/15552000) AS BIGINT) AS update_id, l_partkey%64 AS freq_id, l_suppkey%8 AS input_id, 1.0e0+avg(l_discount) AS re, avg(l_tax) AS im, CAST(count(*) AS DOUBLE) AS w FROM lineitem GROUP BY 1,2,3
    """,
    "fx_delay": """
        SELECT user_id%4 AS table_id, user_id%8 AS input_id, t, avg(value)*1.0e-10 AS delay, 1.0e0 AS w FROM (SELECT user_id, EPOCH(ts) AS t, value FROM events WHERE event_type <> 'error') GROUP BY 1,2,3
    """,
    "fx_dataset": """
        SELECT o_orderkey AS dataset_id, CASE WHEN o_orderkey%11=0 THEN NULL ELSE CAST(floor(o_orderkey/3) AS BIGINT) END AS parent_id, CASE WHEN o_orderkey%5=0 THEN 'map' ELSE 'gain' END AS kind, o_orderkey%3 AS state FROM orders
    """,
    "fx_opinion": """
        SELECT doc_id AS lsd, CASE WHEN quality=1 THEN 'good' ELSE 'bad' END AS decision, toxic FROM labels
    """,
    "fx_log": """
        SELECT doc_id AS tag, source, text AS log, n_chars FROM documents
    """,
}

#: Forms of the same relations for Spark alone, which has no range join: equal rows, met by cells of the key, so that
#: the work grows with the rows and not with their square. DuckDB always runs FIXTURES.
SPARK_FORMS = {
    "fx_baseline": """
        SELECT a.input_id*32+b.input_id-a.input_id AS prod_id, a.input_id AS input_a, b.input_id AS input_b, concat(a.pol,b.pol) AS pol, abs(a.cyl-b.cyl) AS xind, a.x-b.x AS dx, a.y-b.y AS dy
        FROM (SELECT *, explode(array(floor(input_id/32), floor(input_id/32)+1)) AS cell FROM fx_input) a JOIN (SELECT *, floor(input_id/32) AS cell FROM fx_input) b
        ON a.cell=b.cell AND a.input_id<=b.input_id AND b.input_id<a.input_id+32
    """,
}


def _needs(sql: str) -> list[str]:
    """Fixtures that a text uses, each after those it uses itself."""
    found: list[str] = []
    for name in re.findall(r"\bfx_\w+", sql):
        for x in (*_needs(FIXTURES[name]), name):
            if x not in found:
                found.append(x)
    return found


def _with(sql: str, forms: dict[str, str] = FIXTURES) -> str:
    parts = [f"{name} AS ({forms[name].strip()})" for name in _needs(sql)]
    body = sql.strip()
    if head := re.match(r"WITH\s+(RECURSIVE\s+)?", body, re.I):
        return f"WITH {(head[1] or '')}{', '.join([*parts, body[head.end():]])}"
    return f"WITH {', '.join(parts)} {body}" if parts else body


def duckdb_sql(sql: str) -> str:
    """A query over fixtures and tables in DuckDB's dialect."""
    sql = re.sub(r"EPOCH\((\w+)\)", r"(epoch_us(\1)/1e6)", _with(sql))
    return re.sub(r"SPREAD\((\w+)\.(\w+)\)", r"(SELECT * EXCLUDE (\2), generate_subscripts(\2,1)-1 AS pos, unnest(\2) AS col FROM \1)", sql)


def spark_sql(sql: str, sf_dir: str) -> str:
    """The same query in Spark's dialect, over the Parquet files of sf_dir."""
    sql = re.sub(r"EPOCH\((\w+)\)", r"(unix_micros(cast(\1 as timestamp))/1e6)", _with(sql, FIXTURES | SPARK_FORMS))
    sql = re.sub(r"SPREAD\((\w+)\.(\w+)\)", r"\1 LATERAL VIEW posexplode(\2) e AS pos, col", sql)
    return re.sub(rf"\b(FROM|JOIN)\s+({'|'.join(TABLES)})\b", lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet` AS {m[2]}", sql)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture relation (name without fx_)."""
    return spark.sql(spark_sql(f"SELECT * FROM fx_{name}", sf_dir))
