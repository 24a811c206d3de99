"""Source-like text made from sample rows, for the cleaning queries.

Each expression turns a row into the spellings a source export may hold, chosen
by arithmetic on the row's key, and covers every row of its table.
"""

from __future__ import annotations

# Query name -> (table, key column, text expression).
TEXTS = {
    "blank_null": (
        "customer",
        "c_custkey",
        "CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '   '"
        " WHEN 2 THEN concat('  ', c_name, ' ') ELSE c_name END",
    ),
    "int": (
        "part",
        "p_partkey",
        "CASE p_partkey % 9 WHEN 0 THEN concat(' ', p_size, ' ') WHEN 1 THEN '3.0'"
        " WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN concat('+', p_size)"
        " WHEN 5 THEN '99999999999' WHEN 6 THEN concat('-', p_size) WHEN 7 THEN '1e3'"
        " ELSE CAST(p_size AS STRING) END",
    ),
    "decimal": (
        "orders",
        "o_orderkey",
        "CASE o_orderkey % 9 WHEN 0 THEN '1e3' WHEN 1 THEN '1,234' WHEN 2 THEN ''"
        " WHEN 3 THEN '1.005' WHEN 4 THEN '12345678901.23' WHEN 5 THEN '.5'"
        " WHEN 6 THEN concat(' ', o_custkey, '. ') WHEN 7 THEN"
        " concat('-', o_custkey, '.125')"
        " ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END",
    ),
    "date": (
        "orders",
        "o_orderkey",
        "CASE o_orderkey % 7 WHEN 0 THEN '2022-01' WHEN 1 THEN '01/05/2022'"
        " WHEN 2 THEN ' ' WHEN 3 THEN '2022-02-30'"
        " WHEN 4 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:11:12')"
        " WHEN 5 THEN '20220105'"
        " ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    ),
    "timestamp": (
        "events",
        "event_id",
        "CASE event_id % 5 WHEN 0 THEN '2024-01-05' WHEN 1 THEN 'soon'"
        " WHEN 2 THEN '2024-01-05 23:59:59.6'"
        " ELSE concat(' ', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '.',"
        " lpad(CAST(event_id % 1000 AS STRING), 3, '0')) END",
    ),
    "prefix_date": (
        "lineitem",
        None,
        "CASE l_linenumber % 3 WHEN 0 THEN ''"
        " WHEN 1 THEN concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'x17:30')"
        " ELSE concat(CAST(CAST(l_shipdate AS DATE) AS STRING), ' 08:00:00.5') END",
    ),
    "flag3": (
        "lineitem",
        None,
        "CASE l_returnflag WHEN 'N' THEN concat('True', repeat(' ', l_linenumber % 3))"
        " WHEN 'R' THEN CASE l_linenumber % 2 WHEN 0 THEN 'FALSE' ELSE 'False' END"
        " ELSE CASE l_linenumber % 2 WHEN 0 THEN 'yes' END END",
    ),
    "line": (
        "events",
        "event_id",
        "CASE WHEN event_id % 37 = 0 THEN concat(event_id, ',', event_type)"
        " ELSE concat(event_id, ',', event_type, ',', props, ', ', value, ',') END",
    ),
}

# The 12 columns of a load line; blanks, bad numbers and bad dates included.
LOAD_LINE = (
    "concat_ws(',', CASE WHEN o_orderkey % 71 = 0 THEN ' ' ELSE"
    " CAST(o_orderkey AS STRING) END, CAST(o_custkey AS STRING),"
    " concat('R', (o_orderkey % 25) * 25 + o_custkey % 25),"
    " CASE o_orderkey % 53 WHEN 0 THEN 'n/a' WHEN 1 THEN '' ELSE"
    " CAST(CAST(o_orderdate AS DATE) AS STRING) END,"
    " concat(' ', o_orderpriority, ' '),"
    " CASE o_orderkey % 31 WHEN 0 THEN '1e3' ELSE"
    " CAST(((o_orderkey * 37) % 450) * 100 AS STRING) END,"
    " CASE o_orderkey % 29 WHEN 0 THEN '4.0' ELSE"
    " CAST(o_orderkey % 40 + 1 AS STRING) END,"
    " CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING),"
    " CASE o_orderkey % 23 WHEN 0 THEN '' ELSE CAST(o_orderkey % 500 AS STRING) END,"
    " CAST(o_orderkey % 70 AS STRING), 'Completed',"
    " CASE o_orderkey % 19 WHEN 0 THEN '  ' ELSE o_orderstatus END)"
)
