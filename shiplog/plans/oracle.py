"""DuckDB SQL for the driver's correctness check.

Each query in ``ORACLE`` is self-contained ANSI-ish SQL over the driver's
pre-registered views. The derived relations of ``shiplog.plans.derived`` are
re-stated here as CTEs with the same rules, written independently in SQL.
"""

from __future__ import annotations

# ---------------------------------------------------------------- B1 / inv
_INVENTORY = r"""
raw_inventory AS (
  SELECT event_id, user_id, event_type, ts,
    CASE WHEN event_id % 29 = 1 THEN './.hidden/'
         WHEN event_id % 31 = 1 THEN './'
         ELSE './rel/'
              || CASE WHEN event_id % 41 = 1 THEN '20241399-0000' ELSE strftime(ts, '%Y%m%d-%H00') END
              || CASE WHEN event_id % 3 = 0 THEN '' ELSE ';' || event_type END
              || '/'
    END
    || CASE WHEN event_id % 37 = 1 THEN 'readme.txt'
            ELSE lpad(CAST(event_id AS VARCHAR), 8, '0') || ';'
                 || CASE WHEN event_id % 23 = 0 THEN 'deploy_repo' ELSE 't' || CAST(user_id % 7 AS VARCHAR) END
                 || '.'
                 || CASE WHEN event_id % 11 = 1 THEN 'sql.tmp'
                         WHEN event_id % 13 = 1 THEN 'log'
                         WHEN event_id % 17 = 1 THEN 'sql.~bak'
                         WHEN event_id % 19 = 1 THEN 'bak~'
                         WHEN event_id % 4 = 0 THEN 'sql'
                         WHEN event_id % 4 = 1 THEN 'pck'
                         WHEN event_id % 4 = 2 THEN 'vw'
                         ELSE 'trg' END
       END AS path
  FROM events
),
normalised AS (
  SELECT event_id, user_id, event_type, regexp_replace(path, '^\./', '') AS path
  FROM raw_inventory
),
kept AS (
  SELECT * FROM normalised
  WHERE NOT (
        regexp_matches(path, '^\.[^/]*/')
     OR regexp_matches(regexp_extract(path, '([^/]*)$', 1), '\.~.{3}$')
     OR regexp_matches(regexp_extract(path, '([^/]*)$', 1), '\..{3}~$')
     OR strpos(regexp_extract(path, '([^/]*)$', 1), ';deploy_repo.') > 0
     OR suffix(regexp_extract(path, '([^/]*)$', 1), '.tmp')
     OR suffix(regexp_extract(path, '([^/]*)$', 1), '.log'))
    AND len(string_split(path, '/')) >= 2
),
split_parts AS (
  SELECT *,
    regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder,
    regexp_extract(path, '([^/]*)$', 1) AS file,
    regexp_extract(path, '([^/]*)/[^/]*$', 1) AS pkg
  FROM kept
),
parsed AS (
  SELECT event_id, user_id, event_type, path, folder, file,
    CASE WHEN regexp_extract(pkg, '^(\d{8}-\d{4})(;.*)?$', 1) <> ''
         THEN try_strptime(regexp_extract(pkg, '^(\d{8}-\d{4})(;.*)?$', 1), '%Y%m%d-%H%M') END AS package_ts,
    CASE WHEN strpos(pkg, ';') > 0 THEN regexp_extract(pkg, '^[^;]*;(.*)$', 1) END AS package_comment,
    CASE WHEN regexp_extract(file, '^(\d+);([A-Za-z0-9_]+)\.(.*)$', 1) <> ''
         THEN TRY_CAST(regexp_extract(file, '^(\d+);([A-Za-z0-9_]+)\.(.*)$', 1) AS BIGINT) END AS script_no,
    nullif(regexp_extract(file, '^(\d+);([A-Za-z0-9_]+)\.(.*)$', 2), '') AS target_id,
    CASE WHEN regexp_matches(file, '^(\d+);([A-Za-z0-9_]+)\.(.*)$')
         THEN regexp_extract(file, '^(\d+);([A-Za-z0-9_]+)\.(.*)$', 3) END AS extension
  FROM split_parts
),
checked AS (
  SELECT *,
    CASE WHEN package_ts IS NULL THEN 'bad package folder'
         WHEN target_id IS NULL THEN 'bad script name'
         WHEN script_no IS NULL OR NOT (script_no > 0) THEN 'bad script number' END AS reject_reason
  FROM parsed
),
inv AS (
  SELECT *, 'app' || CAST(event_id % 2 AS VARCHAR) AS app_id
  FROM checked WHERE reject_reason IS NULL
)"""

# ---------------------------------------------------------------- B3 / B4
_LEDGER = (
    _INVENTORY
    + r""",
scripts AS (
  SELECT app_id, event_id AS id_script, folder, file, package_ts, package_comment,
         script_no, target_id, hour(package_ts) % 2 = 0 AS is_finished
  FROM inv WHERE event_id % 3 <> 1
),
exec_base AS (
  SELECT app_id, user_id % 10 AS id_run, event_id AS id_script, target_id,
    CAST(CASE WHEN event_id % 10 = 9 THEN NULL
              WHEN event_type = 'error' AND user_id % 3 = 0 AND event_id % 50 = 2 THEN 1
              ELSE 0 END AS BIGINT) AS rc,
    CAST(row_number() OVER (PARTITION BY app_id, user_id % 10
                            ORDER BY package_ts, script_no, path) AS BIGINT) AS num_order
  FROM inv WHERE event_id % 3 <> 1
),
executions AS (
  SELECT app_id, id_run, id_run * 1099511627776 + num_order AS id_script_execution,
         id_script, num_order, target_id, rc
  FROM exec_base
),
runs AS (
  SELECT e.app_id, e.id_run, CASE WHEN e.id_run % 4 = 3 THEN 'sync' ELSE 'all' END AS action,
         make_timestamp(2024, 2, CAST(e.id_run AS BIGINT) + 1, 0, 0, 0) AS run_ts,
         r.r_name AS env
  FROM (SELECT DISTINCT app_id, id_run FROM executions) e
  LEFT JOIN region r ON e.id_run % 5 = r.r_regionkey
),
returns AS (
  SELECT app_id, id_script_execution, rc FROM executions WHERE rc IS NOT NULL
)"""
)

# every valid script and execution; the partial ledger is for merging and sync
_FULL = _LEDGER.replace(" WHERE event_id % 3 <> 1", "")

ORACLE: dict[str, str] = {}

ORACLE["inventory_filter"] = f"""
WITH {_INVENTORY}
SELECT event_id, user_id, event_type, path FROM kept
"""

ORACLE["inventory_parse"] = f"""
WITH {_INVENTORY}
SELECT event_id, path, folder, file, package_ts, package_comment, script_no,
       target_id, extension, reject_reason
FROM checked
"""

_NEW_SCRIPTS = r""",
unknown AS (
  SELECT i.* FROM inv i
  WHERE NOT EXISTS (SELECT 1 FROM scripts s
                    WHERE s.app_id = i.app_id AND s.folder = i.folder AND s.file = i.file)
),
fresh AS (
  SELECT u.* FROM unknown u
  WHERE NOT EXISTS (SELECT 1 FROM scripts s
                    WHERE s.is_finished AND s.app_id = u.app_id AND s.folder = u.folder)
),
last_id AS (SELECT app_id, max(id_script) AS last_id FROM scripts GROUP BY app_id),
new_rows AS (
  SELECT f.app_id,
         coalesce(l.last_id, 0)
           + row_number() OVER (PARTITION BY f.app_id ORDER BY f.package_ts, f.script_no, f.path) AS id_script,
         f.folder, f.file, f.package_ts, f.package_comment, f.script_no, f.target_id,
         false AS is_finished, true AS is_new
  FROM fresh f LEFT JOIN last_id l ON l.app_id = f.app_id
),
merged AS (
  SELECT app_id, id_script, folder, file, package_ts, package_comment, script_no, target_id,
         is_finished, false AS is_new
  FROM scripts
  UNION ALL
  SELECT * FROM new_rows
)"""

ORACLE["merge_increments"] = f"""
WITH {_LEDGER}{_NEW_SCRIPTS}
SELECT * FROM merged
"""


def _pending(scripts_rel: str) -> str:
    return rf""",
todo AS (
  SELECT s.* FROM {scripts_rel} s
  WHERE NOT EXISTS (SELECT 1 FROM executions e
                    WHERE e.rc = 0 AND e.app_id = s.app_id AND e.id_script = s.id_script)
),
next_run AS (
  SELECT t.app_id, coalesce(max(r.id_run), 0) + 1 AS id_run
  FROM (SELECT DISTINCT app_id FROM todo) t LEFT JOIN runs r ON r.app_id = t.app_id
  GROUP BY t.app_id
),
ordered AS (
  SELECT t.app_id, n.id_run,
         CAST(row_number() OVER (PARTITION BY t.app_id, n.id_run
                                 ORDER BY t.package_ts, t.script_no, t.folder || '/' || t.file) AS BIGINT) AS num_order,
         t.id_script, t.folder, t.file, t.target_id, t.package_ts, t.script_no
  FROM todo t JOIN next_run n ON n.app_id = t.app_id
)"""


ORACLE["pending_in_order"] = f"""
WITH {_FULL}{_pending("scripts")}
SELECT * FROM ordered
"""

ORACLE["run_create"] = f"""
WITH {_FULL}{_pending("scripts")},
new_execs AS (
  SELECT app_id, id_run, id_run * 1099511627776 + num_order AS id_script_execution,
         id_script, num_order, target_id
  FROM ordered
),
inc AS (SELECT app_id, folder, min(id_script) AS id_increment FROM scripts GROUP BY app_id, folder)
SELECT e.app_id, e.id_run, e.id_script_execution, e.num_order, e.id_script, i.id_increment,
       e.target_id, s.folder AS script_folder, s.file AS script_file, CAST(NULL AS VARCHAR) AS add_info
FROM new_execs e
LEFT JOIN scripts s ON s.app_id = e.app_id AND s.id_script = e.id_script
LEFT JOIN inc i ON i.app_id = s.app_id AND i.folder = s.folder
"""

ORACLE["run_outcome_halt"] = f"""
WITH {_FULL},
applied AS (
  SELECT e.app_id, e.id_run, e.id_script_execution, e.num_order, r.rc
  FROM executions e
  LEFT JOIN returns r ON r.app_id = e.app_id AND r.id_script_execution = e.id_script_execution
),
halted AS (
  SELECT *, coalesce(bool_or(rc > 0) OVER (PARTITION BY app_id, id_run ORDER BY num_order
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS halted
  FROM applied
)
SELECT app_id, id_run, id_script_execution, num_order, rc,
       CASE WHEN halted THEN 'not_reached' WHEN rc IS NULL THEN 'open'
            WHEN rc = 0 THEN 'ok' ELSE 'failed' END AS status
FROM halted
"""

# the same executions and codes, whatever the order the reports come in
ORACLE["outcome_feed"] = ORACLE["run_outcome_halt"]

# ---------------------------------------------------------------- B2 config
_CONFIG = r"""
nat AS (
  SELECT r.r_name AS env, n.n_nationkey AS n,
         translate(lower(n.n_name), '0123456789', 'abcdefghij') AS nm
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
config AS (
  SELECT env, CAST(0 AS INTEGER) AS layer, CAST(n * 10 + 1 AS INTEGER) AS ord,
         'dpltgt_' || nm || '_tech' AS key,
         CASE n % 3 WHEN 0 THEN 'oracle-sqlplus' WHEN 1 THEN 'spark-sql' ELSE '' END AS value
  FROM nat
  UNION ALL
  SELECT env, 0, CAST(n * 10 + 2 AS INTEGER), 'dpltgt_' || nm || '_db', 'db' || CAST(n AS VARCHAR)
  FROM nat WHERE n % 4 <> 3
  UNION ALL
  SELECT env, 0, CAST(n * 10 + 3 AS INTEGER), 'dpltgt_' || nm || '_password', 'pw' || CAST(n AS VARCHAR)
  FROM nat WHERE n % 2 = 0
  UNION ALL
  SELECT env, 0, CAST(n * 10 + 4 AS INTEGER), 'dbgrp_' || nm, 'x' FROM nat WHERE n % 3 = 0
  UNION ALL
  SELECT env, 1, CAST(n AS INTEGER), 'dpltgt_' || nm || '_db', 'ovr' || CAST(n AS VARCHAR)
  FROM nat WHERE n % 2 = 0
  UNION ALL
  SELECT env, 1, CAST(n + 100 AS INTEGER), 'dpltgt_' || nm || '_db', 'last' || CAST(n AS VARCHAR)
  FROM nat WHERE n % 6 = 0
  UNION ALL
  SELECT env, 0, CAST(300 + k AS INTEGER), 'dpltgt_t' || CAST(k AS VARCHAR) || '_tech',
         CASE k % 3 WHEN 0 THEN 'oracle-sqlplus' WHEN 1 THEN 'spark-sql' ELSE '' END
  FROM (SELECT r_name AS env, unnest(range(6)) AS k FROM region)
  UNION ALL
  SELECT r_name, 0, 400, 'cfg_target_no_run', 't1,t3' FROM region
  UNION ALL
  SELECT r_name, 0, 401, 'deploy_repo_tech', CASE WHEN r_regionkey % 2 = 0 THEN 'postgres' ELSE ' ' END FROM region
  UNION ALL
  SELECT r_name, 0, 402, 'DPLTGT_Upper_TECH', 'tech' || CAST(r_regionkey AS VARCHAR) FROM region
),
eff_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY env, key ORDER BY layer DESC, ord DESC) AS pick FROM config
),
eff AS (SELECT env, key, value, layer FROM eff_ranked WHERE pick = 1)"""

ORACLE["run_classify"] = f"""
WITH {_FULL}, {_CONFIG},
settings AS (
  SELECT env, max(CASE WHEN key = 'cfg_target_no_run' THEN value END) AS no_run FROM eff GROUP BY env
),
techs AS (
  SELECT env, regexp_extract(key, '^dpltgt_(.+)_tech$', 1) AS target_id, trim(value) AS tech
  FROM eff WHERE regexp_matches(key, '^dpltgt_.+_tech\\z')
),
x AS (
  SELECT e.app_id, e.id_run, e.id_script_execution, e.target_id, e.rc, r.env, r.action, s.no_run, t.tech
  FROM executions e
  LEFT JOIN runs r ON r.app_id = e.app_id AND r.id_run = e.id_run
  LEFT JOIN settings s ON s.env = r.env
  LEFT JOIN techs t ON t.env = r.env AND t.target_id = e.target_id
),
y AS (
  SELECT *, coalesce(list_contains(string_split(no_run, ','), target_id), false)
            OR coalesce(action = 'sync', false) AS is_fake
  FROM x
),
z AS (
  SELECT app_id, id_run, id_script_execution, target_id, env, is_fake,
         CASE WHEN NOT is_fake THEN coalesce(nullif(tech, ''), 'oracle-sqlplus') END AS tech,
         CASE WHEN is_fake THEN CAST(0 AS BIGINT) ELSE rc END AS rc
  FROM y
)
SELECT *, CASE WHEN rc IS NULL THEN 'open' WHEN rc = 0 THEN 'ok' ELSE 'failed' END AS status FROM z
"""

ORACLE["sync_mark"] = f"""
WITH {_LEDGER}{_NEW_SCRIPTS}{_pending("merged")}
SELECT app_id, id_run, id_run * 1099511627776 + num_order AS id_script_execution, num_order, id_script,
       CAST(0 AS BIGINT) AS rc, true AS is_fake, 'ok' AS status
FROM ordered
"""

ORACLE["app_id_check"] = r"""
WITH c AS (
  SELECT c_custkey,
         CASE WHEN c_custkey % 2 = 0 THEN replace(c_name, '#', '_') ELSE c_name END AS app_id
  FROM customer
)
SELECT c_custkey, app_id,
       coalesce(regexp_matches(app_id, '^[A-Za-z][A-Za-z0-9_-]*\z'), false) AS is_valid
FROM c
"""

ORACLE["override_parse"] = f"""
WITH {_CONFIG},
lines AS (
  SELECT env, ord, key || '=' || value AS text FROM config WHERE layer = 1
  UNION ALL
  SELECT r.r_name, CAST(n.n_nationkey + 1000 AS INTEGER), 'dpltgt_' || n.n_name || '_db=x'
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
v AS (
  SELECT *, coalesce(regexp_matches(text, '^(cfg|dpltgt|dbgrp)_[a-zA-Z_]+=[^=\\s]*\\z'), false) AS is_valid
  FROM lines
)
SELECT env, ord, text, is_valid,
       CASE WHEN is_valid THEN regexp_extract(text, '^([^=]*)=', 1) END AS key,
       CASE WHEN is_valid THEN regexp_replace(text, '^[^=]*=', '') END AS value
FROM v
"""

ORACLE["config_effective"] = f"""
WITH {_CONFIG},
base_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY env, key ORDER BY ord DESC) AS pick
  FROM config WHERE layer = 0
),
base AS (SELECT env, key, value AS base_value FROM base_ranked WHERE pick = 1),
counts AS (SELECT env, CAST(count(*) FILTER (WHERE layer > 0) AS BIGINT) AS n_overrides FROM config GROUP BY env),
j AS (
  SELECT e.env, e.key, e.value, b.base_value, e.layer > 0 AS overridden,
         coalesce(regexp_matches(e.key, 'passw(or)?d\\z'), false) AS is_secret, c.n_overrides
  FROM eff e
  LEFT JOIN base b ON b.env = e.env AND b.key = e.key
  LEFT JOIN counts c ON c.env = e.env
)
SELECT env, key,
       CASE WHEN is_secret AND value IS NOT NULL THEN '*****' ELSE value END AS value,
       CASE WHEN is_secret AND base_value IS NOT NULL THEN '*****' ELSE base_value END AS base_value,
       overridden, is_secret, n_overrides
FROM j
"""

ORACLE["techs_in_use"] = f"""
WITH {_CONFIG},
t AS (
  SELECT env, coalesce(nullif(trim(value), ''), 'oracle-sqlplus') AS tech
  FROM eff WHERE regexp_matches(key, '(?i)^dpltgt_.*_tech\\z')
  UNION
  SELECT env, coalesce(nullif(max(CASE WHEN key = 'deploy_repo_tech' THEN trim(value) END), ''),
                       'oracle-sqlplus')
  FROM eff GROUP BY env
)
SELECT env, tech, CAST(row_number() OVER (PARTITION BY env ORDER BY tech) AS BIGINT) AS tech_no FROM t
"""

ORACLE["target_list"] = f"""
WITH {_CONFIG},
names AS (
  SELECT env,
         CASE WHEN starts_with(key, 'dpltgt_') THEN regexp_extract(key, '^dpltgt_(.*)_(db|user|password)$', 1)
              WHEN starts_with(key, 'dbgrp_') THEN regexp_extract(key, '^dbgrp_(.*)$', 1) END AS target,
         CASE WHEN starts_with(key, 'dpltgt_') THEN 'atomic'
              WHEN starts_with(key, 'dbgrp_') THEN 'composite' END AS kind
  FROM eff
),
k AS (
  SELECT env, target, bool_or(kind = 'atomic') AS a FROM names
  WHERE target IS NOT NULL AND target <> '' GROUP BY env, target
)
SELECT env, target, CASE WHEN a THEN 'atomic' ELSE 'composite' END AS kind,
       '    * ' || target || CASE WHEN a THEN '' ELSE ' (composite)' END AS label,
       CAST(row_number() OVER (PARTITION BY env ORDER BY target) AS BIGINT) AS target_no
FROM k
"""

ORACLE["natural_order"] = r"""
WITH p AS (
  SELECT p_partkey, p_brand,
         coalesce(CASE WHEN regexp_extract(p_brand, '#(\d+(?:\.\d+)?)', 1) <> ''
                       THEN TRY_CAST(regexp_extract(p_brand, '#(\d+(?:\.\d+)?)', 1) AS DECIMAL(38,9)) END,
                  CAST(0 AS DECIMAL(38,9))) AS brand_no
  FROM part
)
SELECT p_partkey, p_brand, brand_no,
       CAST(row_number() OVER (ORDER BY brand_no, p_brand, p_partkey) AS BIGINT) AS ord
FROM p
"""

ORACLE["precedence_union"] = r"""
WITH u AS (
  SELECT 0 AS layer, n_name AS name FROM nation
  UNION ALL
  SELECT 1 AS layer, s_name AS name FROM supplier
),
k AS (
  SELECT layer, name,
         coalesce(CASE WHEN regexp_extract(name, '(\d+)', 1) <> ''
                       THEN TRY_CAST(regexp_extract(name, '(\d+)', 1) AS DECIMAL(38,9)) END,
                  CAST(0 AS DECIMAL(38,9))) AS num_key
  FROM u
)
SELECT layer, name, CAST(row_number() OVER (ORDER BY layer, num_key, name) AS BIGINT) AS ord FROM k
"""

# ---------------------------------------------------------------- B5 catalog
_CATALOG = r"""
cols AS (
  SELECT DISTINCT upper(table_name) AS table_name, upper(column_name) AS column_name,
         CAST(ordinal_position AS INTEGER) AS column_id, lower(column_name) AS nm, data_type AS duck_type
  FROM information_schema.columns
  WHERE lower(table_name) IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
                              'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels',
                              'conversations')
),
catalog AS (
  SELECT table_name, column_name, column_id,
         CASE WHEN nm = 'html' THEN 'XMLTYPE'
              WHEN nm = 'props' THEN 'CLOB'
              WHEN nm = 'embedding' THEN 'BLOB'
              WHEN nm = 'label' THEN NULL
              WHEN nm = 'lang' THEN 'CHAR'
              WHEN nm = 'role' THEN 'NCHAR'
              WHEN nm = 'text' THEN 'NVARCHAR2'
              WHEN nm = 'l_shipdate' THEN 'DATE'
              WHEN nm = 'o_orderdate' THEN 'TIMESTAMP(6) WITH TIME ZONE'
              WHEN nm = 'ts' THEN 'TIMESTAMP(6)'
              WHEN duck_type = 'VARCHAR' THEN 'VARCHAR2'
              ELSE 'NUMBER' END AS data_type,
         CASE WHEN nm = 'html' THEN 'SYS' END AS data_type_owner,
         CAST(column_id * 10 AS INTEGER) AS data_length,
         CASE WHEN nm = 'html' THEN 'YES' WHEN nm = 'l_tax' THEN 'YES' WHEN column_id % 2 = 1 THEN 'NO' END
           AS virtual_column,
         CASE WHEN nm = 'n_chars' THEN 'YES' WHEN column_id % 2 = 0 THEN 'NO' END AS hidden_column
  FROM cols
),
visible AS (
  SELECT * FROM catalog
  WHERE (virtual_column IS DISTINCT FROM 'YES'
         OR (data_type_owner = 'SYS' AND data_type = 'XMLTYPE'))
    AND hidden_column IS DISTINCT FROM 'YES'
    AND data_type NOT IN ('BLOB', 'BFILE', 'CLOB', 'NCLOB')
)"""

_COLUMNS = {
    "benchmark": ["item_id", "text"],
    "conversations": ["conv_id", "turn", "role", "text"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "labels": ["doc_id", "quality", "toxic"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "pages": ["page_id", "url", "html"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "region": ["r_regionkey", "r_name"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
}
_VALUE_COUNTS = "\n  UNION ALL\n".join(
    f"  SELECT '{t.upper()}' AS table_name, '{c.upper()}' AS column_name, count({c}) AS n_values FROM {t}"
    for t, cols in _COLUMNS.items()
    for c in cols
)

ORACLE["visible_columns"] = f"""
WITH {_CATALOG},
counted AS (
{_VALUE_COUNTS}
)
SELECT v.table_name, v.column_name, v.column_id, v.data_type, c.n_values
FROM visible v JOIN counted c ON c.table_name = v.table_name AND c.column_name = v.column_name
"""

_STRING_COLUMNS = {
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"],
    "pages": ["url", "html"],
    "benchmark": ["text"],
    "conversations": ["role", "text"],
}
# longest value in bytes of every string column (sets its char(n))
_MEASURED = "\n  UNION ALL\n".join(
    f"  SELECT '{t.upper()}' AS table_name, '{c.upper()}' AS column_name, "
    f"CAST(max(strlen({c})) AS INTEGER) AS max_len FROM {t}"
    for t, cols in _STRING_COLUMNS.items()
    for c in cols
)

ORACLE["loader_spec"] = f"""
WITH {_CATALOG},
measured AS (
{_MEASURED}
),
sized AS (
  SELECT k.table_name, k.column_name, k.column_id, k.data_type, k.data_type_owner,
         CASE WHEN c.duck_type = 'VARCHAR' THEN m.max_len ELSE k.data_length END AS data_length,
         k.virtual_column, k.hidden_column
  FROM catalog k
  JOIN cols c ON c.table_name = k.table_name AND c.column_name = k.column_name
  LEFT JOIN measured m ON m.table_name = k.table_name AND m.column_name = k.column_name
),
visible_sized AS (
  SELECT * FROM sized
  WHERE (virtual_column IS DISTINCT FROM 'YES'
         OR (data_type_owner = 'SYS' AND data_type = 'XMLTYPE'))
    AND hidden_column IS DISTINCT FROM 'YES'
    AND data_type NOT IN ('BLOB', 'BFILE', 'CLOB', 'NCLOB')
),
lines AS (
  SELECT table_name, column_id,
         '    ' || lower(column_name)
         || coalesce(CASE WHEN data_type IN ('CHAR', 'VARCHAR2', 'NVARCHAR2', 'NCHAR')
                          THEN '    char(' || CAST(CASE WHEN data_type IN ('NCHAR', 'NVARCHAR2')
                                                       THEN 2 * data_length ELSE data_length END AS VARCHAR) || ')'
                          WHEN data_type = 'DATE' THEN '    char(64)'
                          WHEN data_type = 'TIMESTAMP' THEN '    char(64)'
                          WHEN data_type LIKE 'TIMESTAMP(%) WITH TIME ZONE' THEN '    char(64)'
                          WHEN data_type = 'XMLTYPE' THEN '    char(4000)' END, '')
         || CASE WHEN row_number() OVER (PARTITION BY table_name ORDER BY column_id DESC) = 1 THEN '' ELSE ',' END
           AS line
  FROM visible_sized
),
tables AS (SELECT table_name, count(*) AS n FROM lines GROUP BY table_name),
head(pos, tpl) AS (VALUES
  (0, 'options ('),
  (1, '    skip = 0,'),
  (2, '    direct = false'),
  (3, ')'),
  (4, 'load'),
  (5, '    characterset utf8'),
  (6, '    infile * "str ''<eor>\\n''"'),
  (7, '    badfile ''{{T}}.bad'''),
  (8, '    discardfile ''{{T}}.discard'''),
  (9, 'into table {{T}}'),
  (10, '    replace'),
  (11, 'fields terminated by ''' || chr(9) || ''''),
  (12, '    optionally enclosed by ''@..'' and ''..@'''),
  (13, '    trailing nullcols'),
  (14, '(')
),
foot(pos, tpl) AS (VALUES (0, ')'), (1, 'begindata'))
SELECT t.table_name, CAST(1 + h.pos AS BIGINT) AS line_no, replace(h.tpl, '{{T}}', t.table_name) AS line
FROM tables t, head h
UNION ALL
SELECT table_name, CAST(15 + row_number() OVER (PARTITION BY table_name ORDER BY column_id) AS BIGINT), line
FROM lines
UNION ALL
SELECT t.table_name, CAST(16 + t.n + f.pos AS BIGINT), f.tpl FROM tables t, foot f
"""


def _enc(expr: str) -> str:
    return f"'@..' || coalesce({expr}, '') || '..@'"


_TS9 = "strftime({c}, '%Y-%m-%d %H:%M:%S.%n')"
_ORDERS_LINE = " || chr(9) || ".join(
    [
        _enc("CAST(o_orderkey AS VARCHAR)"),
        _enc("CAST(o_custkey AS VARCHAR)"),
        _enc("o_orderstatus"),
        _enc("CAST(o_totalprice AS VARCHAR)"),
        _enc(_TS9.format(c="o_orderdate") + " || ' +00/00'"),
        _enc("o_orderpriority"),
    ]
)
_LINEITEM_LINE = " || chr(9) || ".join(
    [
        _enc("CAST(l_orderkey AS VARCHAR)"),
        _enc("CAST(l_partkey AS VARCHAR)"),
        _enc("CAST(l_suppkey AS VARCHAR)"),
        _enc("CAST(l_linenumber AS VARCHAR)"),
        _enc("CAST(l_quantity AS VARCHAR)"),
        _enc("CAST(l_extendedprice AS VARCHAR)"),
        _enc("CAST(l_discount AS VARCHAR)"),
        _enc("l_returnflag"),
        _enc("l_linestatus"),
        _enc("strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"),
    ]
)

ORACLE["enclosed_export"] = f"""
SELECT 'ORDERS' AS table_name,
       CAST(row_number() OVER (ORDER BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                                        o_orderpriority) AS BIGINT) AS seq,
       {_ORDERS_LINE} || chr(9) || '<eor>' AS line
FROM orders
UNION ALL
SELECT 'LINEITEM',
       CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                                        l_extendedprice, l_discount, l_returnflag, l_linestatus,
                                        l_shipdate) AS BIGINT),
       {_LINEITEM_LINE} || chr(9) || '<eor>'
FROM lineitem
"""

ORACLE["enclosed_roundtrip"] = """
SELECT d.doc_id, nullif(d.text, '') AS text, nullif(d.lang, '') AS lang, nullif(d.source, '') AS source,
       l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

ORACLE["execution_list_read"] = f"""
WITH {_FULL},
inc AS (SELECT app_id, folder, min(id_script) AS id_increment FROM scripts GROUP BY app_id, folder)
SELECT e.id_script_execution, e.num_order, e.id_script, i.id_increment, e.target_id,
       s.folder AS script_folder, s.file AS script_file,
       CASE e.num_order % 6 WHEN 0 THEN NULL WHEN 1 THEN 'x' WHEN 2 THEN 'a|b' WHEN 3 THEN 'a|b|'
            WHEN 4 THEN 'x||' ELSE NULL END AS add_info
FROM executions e
LEFT JOIN scripts s ON s.app_id = e.app_id AND s.id_script = e.id_script
LEFT JOIN inc i ON i.app_id = s.app_id AND i.folder = s.folder
"""

_DOCUMENT_LINE = " || chr(9) || ".join([_enc("CAST(doc_id AS VARCHAR)"), _enc("CASE WHEN doc_id % 7 <> 0 THEN text END"), _enc("lang"), _enc("source")])

ORACLE["column_list"] = f"""
SELECT 'ORDERS' AS table_name, o_orderkey AS id,
       md5({_ORDERS_LINE.replace("coalesce(o_orderstatus, '')", "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END")}) AS record_md5
FROM orders
UNION ALL
SELECT 'DOCUMENTS', doc_id, md5({_DOCUMENT_LINE}) FROM documents
"""

_PARTS = "year({c}) AS y, month({c}) AS mo, day({c}) AS d, hour({c}) AS h, minute({c}) AS mi, second({c}) AS s"
ORACLE["enclosed_roundtrip_times"] = f"""
WITH t AS (
  SELECT 'orders' AS name, o_orderkey AS id,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 10000 YEAR ELSE o_orderdate END AS ts FROM orders
  UNION ALL
  SELECT 'events', event_id, CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 20000 YEAR ELSE ts END FROM events
)
SELECT name, id, {_PARTS.format(c="ts")} FROM t
"""

_VALID_TENANTS = _NEW_SCRIPTS.replace("FROM inv i", "FROM (SELECT * FROM inv WHERE event_id % 5 <> 0) i")
ORACLE["deploy_prepare"] = f"""
WITH {_LEDGER}{_VALID_TENANTS}{_pending("merged")}
SELECT o.app_id, o.id_run, o.id_run * 1099511627776 + o.num_order AS id_script_execution, o.num_order,
       o.id_script, o.target_id, g.r_name AS env,
       CASE WHEN list_contains(['t1', 't3'], o.target_id) THEN CAST(0 AS BIGINT) END AS rc
FROM ordered o, (SELECT r_name FROM region WHERE r_regionkey = 1) g
"""

# returns of the runs below 8; the others are not touched
_RECORDED = f"""{_FULL},
reported AS (SELECT * FROM executions),
halted AS (
  SELECT *, coalesce(bool_or(rc > 0) OVER (PARTITION BY app_id, id_run ORDER BY num_order
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS halted
  FROM reported
),
settled AS (
  SELECT app_id, id_run, id_script_execution, id_script, num_order, CASE WHEN NOT halted THEN rc END AS rc,
         CASE WHEN halted THEN 'not_reached' WHEN rc IS NULL THEN 'open' WHEN rc = 0 THEN 'ok' ELSE 'failed' END AS status
  FROM halted
)"""

ORACLE["deploy_record"] = f"""
WITH {_RECORDED}
SELECT app_id, id_run, id_script_execution, num_order, rc, status FROM settled
"""

ORACLE["deploy_finished"] = f"""
WITH {_RECORDED},
done AS (SELECT DISTINCT app_id, id_script FROM settled WHERE rc = 0)
SELECT s.app_id, s.folder FROM scripts s LEFT JOIN done d ON d.app_id = s.app_id AND d.id_script = s.id_script
WHERE NOT s.is_finished GROUP BY s.app_id, s.folder HAVING count(*) = count(d.id_script)
"""

ORACLE["ledger_versions"] = f"""
WITH {_FULL}
SELECT app_id, id_script_execution, id_script, num_order, target_id,
       CASE WHEN id_run % 2 = 0 THEN rc END AS rc
FROM executions
"""

# the same rules over the customers' environments
_NATIONS = _CONFIG[: _CONFIG.index("config AS (")]
_CUSTOMERS = r"""
nat AS (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN 'hot' ELSE 'e' || CAST(c_custkey // 5 AS VARCHAR) END AS env,
         c_custkey AS n, c_name AS name, translate(lower(c_name), '0123456789#', 'abcdefghij_') AS nm
  FROM customer
),
envs AS (SELECT DISTINCT env AS r_name, CASE WHEN n % 3 = 0 THEN 0 ELSE n // 5 END AS r_regionkey FROM nat),
"""
_CONFIG_AT_SIZE = _CONFIG.replace(_NATIONS, _CUSTOMERS).replace("FROM region", "FROM envs")
for _key in ("override_parse", "config_effective", "techs_in_use", "target_list"):
    ORACLE[f"{_key}_at_size"] = ORACLE[_key].replace(_CONFIG, _CONFIG_AT_SIZE)
ORACLE["override_parse_at_size"] = ORACLE["override_parse_at_size"].replace(
    """SELECT r.r_name, CAST(n.n_nationkey + 1000 AS INTEGER), 'dpltgt_' || n.n_name || '_db=x'
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "SELECT env, CAST(n + 1000 AS INTEGER), 'dpltgt_' || name || '_db=x' FROM nat",
)

ORACLE["config_files"] = f"""
WITH {_CONFIG_AT_SIZE}
SELECT env, CAST(0 AS INTEGER) AS layer,
       CAST(row_number() OVER (PARTITION BY env ORDER BY ord, key) AS INTEGER) AS ord, key, trim(value) AS value
FROM config WHERE layer = 0
"""

_SPEC = ORACLE["loader_spec"].strip()
ORACLE["loader_spec_files"] = f"""
SELECT table_name, md5(string_agg(line, chr(10) ORDER BY line_no) || chr(10)) AS file_md5
FROM ({_SPEC}) GROUP BY table_name
"""

ORACLE["split_no_run"] = f"""
WITH {_FULL}
SELECT e.app_id, e.id_script_execution, e.target_id, r.env, NOT list_contains(['t1', 't3'], e.target_id) AS runs
FROM executions e JOIN runs r ON r.app_id = e.app_id AND r.id_run = e.id_run
"""

ORACLE["pre_phase"] = f"""
WITH {_FULL}
SELECT app_id, id_script_execution, rc,
       CASE WHEN rc = 0 THEN 'ok' WHEN rc IS NOT NULL THEN 'failed' WHEN num_order % 2 = 0 THEN 'running' ELSE 'open' END AS status
FROM executions
"""

_EXPORT = ORACLE["enclosed_export"].strip()
ORACLE["loader_file"] = f"""
WITH head AS (SELECT sum(octet_length(encode(line)) + 1) AS n FROM ({_SPEC}) WHERE table_name = 'LINEITEM'),
rec AS (SELECT seq, line, octet_length(encode(line)) + 1 AS n FROM ({_EXPORT}) WHERE table_name = 'LINEITEM')
SELECT seq AS record_no,
  CAST((SELECT n FROM head) + coalesce(sum(n) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset,
  md5(line) AS record_md5
FROM rec
"""


def _faulty(name: str, i: str, a: str, n: str, t: str) -> str:
    own = f"SELECT {i} AS id, {a} AS a, {n} AS n, CAST({t} AS TIMESTAMP) AS t FROM {name}"
    field = lambda x: f"'@..' || coalesce({x}, '') || '..@' || chr(9)"
    head = f"{field('CAST(id AS VARCHAR)')} || {field('a')}"
    number = "CASE WHEN id % 11 = 1 THEN 'n' ELSE '' END || CAST(n AS VARCHAR)"
    time = "CASE WHEN id % 19 = 4 THEN 'never' ELSE strftime(t, '%Y-%m-%d %H:%M:%S.%n') END"
    return f"""
SELECT '{name}' AS name, id, a, n, t, row_number() OVER (ORDER BY id, a, n, t) AS record_no,
  id % 13 = 2 AS blank, id % 13 <> 2 AND id % 17 = 3 AS short,
  CASE WHEN id % 13 = 2 THEN {" || ".join([field("''")] * 4)} WHEN id % 17 = 3 THEN {head} ELSE {head} || {field(number)} || {field(time)} END AS line
FROM ({own})"""


ORACLE["loader_rejects"] = f"""
WITH rec AS (
{_faulty("orders", "o_orderkey", "o_orderpriority", "o_custkey", "o_orderdate")}
UNION ALL
{_faulty("events", "event_id", "event_type", "user_id", "ts")}
),
placed AS (
  SELECT *, CAST(10 + coalesce(sum(octet_length(encode(line)) + 6) OVER (PARTITION BY name ORDER BY record_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
    NOT blank AND NOT short AND id % 11 = 1 AS bad_n, NOT blank AND NOT short AND id % 19 = 4 AS bad_t
  FROM rec
)
SELECT name, CAST(record_no AS BIGINT) AS record_no, start,
  CASE WHEN bad_n OR bad_t THEN 'bad' WHEN blank THEN 'discard' ELSE 'good' END AS side,
  CASE WHEN bad_n THEN 'n: not bigint' WHEN bad_t THEN 't: not timestamp_ntz' WHEN blank THEN 'no field is filled' END AS reason,
  CASE WHEN NOT blank THEN id END AS id, CASE WHEN NOT blank THEN a END AS a,
  CASE WHEN NOT blank AND NOT short AND NOT bad_n THEN n END AS n, CASE WHEN NOT blank AND NOT short AND NOT bad_t THEN t END AS t
FROM placed WHERE record_no > 5
"""

ORACLE["ledger_changes"] = f"""
WITH {_FULL},
half AS (SELECT app_id, id_script, CASE WHEN day(package_ts) <= 15 THEN 1 ELSE 2 END AS half FROM scripts)
SELECT e.app_id, e.id_script_execution, e.id_script, e.rc, CAST(NULL AS BIGINT) AS old_rc,
  CASE WHEN h.half = 2 OR e.id_script % 5 < 3 THEN 'update' ELSE 'insert' END AS change,
  CAST(CASE WHEN h.half = 2 THEN 4 ELSE 2 END AS BIGINT) AS v
FROM executions e JOIN half h ON h.app_id = e.app_id AND h.id_script = e.id_script
"""

_PENDING = ORACLE["pending_in_order"].strip()
ORACLE["pending_maintained"] = f"""
WITH {_FULL},
touched AS (
  SELECT s.app_id, CAST(s.package_ts AS DATE) AS d,
    max(CASE WHEN day(s.package_ts) > 15 THEN CASE WHEN e.rc = 0 THEN 4 ELSE 1 END
             WHEN e.rc = 0 OR s.id_script % 5 >= 3 THEN 2 ELSE 1 END) AS written
  FROM scripts s LEFT JOIN executions e ON e.app_id = s.app_id AND e.id_script = s.id_script
  GROUP BY 1, 2
)
SELECT p.*, CAST(t.written AS BIGINT) AS written
FROM ({_PENDING}) p JOIN touched t ON t.app_id = p.app_id AND t.d = CAST(p.package_ts AS DATE)
"""

ORACLE["tree_listing"] = f"""
WITH {_INVENTORY}
SELECT DISTINCT path, CAST(len(string_split(path, '/')) AS BIGINT) AS depth FROM normalised WHERE NOT regexp_matches(path, '^\\.[^/]*/')
"""

_NEW_OF_LAST_DAYS = _NEW_SCRIPTS.replace("FROM inv i", "FROM (SELECT * FROM inv WHERE day(package_ts) > 20 AND event_id % 6 <> 5) i")
ORACLE["merge_skipping"] = f"""
WITH {_LEDGER}{_NEW_OF_LAST_DAYS}
SELECT * EXCLUDE (is_new), true AS skipped FROM new_rows
"""
