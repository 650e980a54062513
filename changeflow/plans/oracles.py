"""SQL equivalents of the registered queries, written against the given tables for another engine.

They follow other routes than the library: merges are three branches of joins, replays are a closed
form over the last DELETE, the last UPDATE and the first INSERT of a key.
"""

from __future__ import annotations

from changeflow.functions.columns import SAMPLE_A, SAMPLE_B, SAMPLE_M
from changeflow.plans.catalogue import NEXT_BATCH, SAMPLE_RATE
from changeflow.plans.feeds import SNAPSHOT_YEAR

CUSTOMERS = "SELECT c_custkey AS k, c_acctbal AS v FROM customer"
FEED = """
SELECT user_id * 20 AS k, value AS v,
       CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
       ts, event_id, CAST(day(ts) AS INT) AS b
FROM events"""
WEEKLY = f"SELECT k, v, op, ts, event_id, (b - 1) // 7 + 1 AS b FROM ({FEED}) f"
LINES = """
SELECT l_orderkey AS k, l_partkey AS v,
       CASE l_returnflag WHEN 'N' THEN 'INSERT' WHEN 'R' THEN 'DELETE' ELSE 'UPDATE' END AS op,
       l_shipdate, l_linenumber, l_partkey, l_suppkey, year(l_shipdate) AS b
FROM lineitem"""
LINE_TIES = "l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC"
LINES_BEFORE = f"""
SELECT k, v FROM ({LINES}) l WHERE b <= {SNAPSHOT_YEAR}
QUALIFY row_number() OVER (PARTITION BY k ORDER BY {LINE_TIES}) = 1"""
LINES_AFTER = f"SELECT * FROM ({LINES}) l WHERE b > {SNAPSHOT_YEAR}"
FEED_TIES = "ts DESC, event_id DESC"
OP_RANK = "CASE op WHEN 'DELETE' THEN 3 WHEN 'UPDATE' THEN 2 WHEN 'INSERT' THEN 1 ELSE 0 END DESC"

# The same with all columns of the customers, and with each line of an order.
_ROW = "struct_pack(c_name := {}, c_nationkey := {}, c_acctbal := {}, c_mktsegment := {})"
ROW_COLUMNS = "v.c_name AS c_name, v.c_nationkey AS c_nationkey, v.c_acctbal AS c_acctbal, v.c_mktsegment AS c_mktsegment"
CUSTOMER_ROWS = f"SELECT c_custkey AS k, {_ROW.format('c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment')} AS v FROM customer"
ROWS_FEED = FEED.replace(
    "value AS v", _ROW.format("'Event#' || event_id", "CAST(event_id % 25 AS INT)", "value", "upper(event_type)") + " AS v"
)
ROWS_WEEKLY = WEEKLY.replace(FEED, ROWS_FEED)
EACH_LINE = "l_orderkey || '-' || l_linenumber AS k"
EACH_LINE_BEFORE = LINES_BEFORE.replace("l_orderkey AS k", EACH_LINE).replace(LINE_TIES, f"{LINE_TIES}, {OP_RANK}")
EACH_LINE_AFTER = LINES_AFTER.replace("l_orderkey AS k", EACH_LINE)


def once(feed: str, insert_on_match: str = "b.v") -> str:
    """One merge of the latest change per key into the customers."""
    return f"""
WITH d AS (SELECT * FROM ({feed}) f QUALIFY row_number() OVER (PARTITION BY k ORDER BY {FEED_TIES}) = 1),
     b AS ({CUSTOMERS})
SELECT b.k AS k, b.v AS v FROM b LEFT JOIN d ON b.k = d.k
WHERE d.k IS NULL OR d.op IS NULL OR d.op NOT IN ('INSERT', 'UPDATE', 'DELETE')
UNION ALL
SELECT b.k, CASE WHEN d.op = 'UPDATE' THEN d.v ELSE {insert_on_match} END
FROM b JOIN d ON b.k = d.k WHERE d.op IN ('INSERT', 'UPDATE')
UNION ALL
SELECT d.k, d.v FROM d WHERE d.op IN ('INSERT', 'UPDATE') AND NOT EXISTS (SELECT 1 FROM b WHERE b.k = d.k)"""


def replayed(feed: str, base: str, ties: str, outer: str = "SELECT k, v FROM final") -> str:
    """All batches of a feed applied to a base; ``outer`` reads the result from ``final``."""
    return f"""
WITH per_batch AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, b ORDER BY {ties}) AS rn FROM ({feed}) f) x
    WHERE rn = 1),
base AS ({base}),
ld AS (SELECT k, max(CASE WHEN op = 'DELETE' THEN b END) AS ld FROM per_batch GROUP BY k),
aft AS (SELECT p.k, max(CASE WHEN op = 'UPDATE' THEN b END) AS lu, min(CASE WHEN op = 'INSERT' THEN b END) AS fi
        FROM per_batch p JOIN ld ON p.k = ld.k WHERE ld.ld IS NULL OR p.b > ld.ld GROUP BY p.k),
keys AS (SELECT coalesce(base.k, ld.k) AS k, base.v AS v0, lu, fi, (base.k IS NOT NULL AND ld.ld IS NULL) AS pre
         FROM base FULL OUTER JOIN ld ON base.k = ld.k LEFT JOIN aft ON aft.k = ld.k),
final AS (SELECT keys.k AS k, CASE WHEN lu IS NOT NULL THEN pu.v WHEN pre THEN v0 ELSE pi.v END AS v FROM keys
          LEFT JOIN per_batch pu ON pu.k = keys.k AND pu.b = lu
          LEFT JOIN per_batch pi ON pi.k = keys.k AND pi.b = fi
          WHERE lu IS NOT NULL OR pre OR fi IS NOT NULL)
{outer}"""


LATEST_WINS = f"""
WITH d AS (SELECT * FROM ({ROWS_FEED}) f QUALIFY row_number() OVER (PARTITION BY k ORDER BY b DESC, {FEED_TIES}) = 1)
SELECT c.k AS k, c.v AS v FROM ({CUSTOMER_ROWS}) c WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.k = c.k)
UNION ALL SELECT k, v FROM d WHERE op <> 'DELETE'"""

MERGE_CHANGES = f"""
WITH d AS (SELECT * FROM ({ROWS_FEED}) f QUALIFY row_number() OVER (PARTITION BY k ORDER BY {FEED_TIES}) = 1),
     b AS ({CUSTOMER_ROWS})
SELECT b.k AS k, b.v AS v, 'delete' AS _change_type FROM b JOIN d ON b.k = d.k WHERE d.op = 'DELETE'
UNION ALL SELECT b.k, b.v, 'update_preimage' FROM b JOIN d ON b.k = d.k WHERE d.op = 'UPDATE'
UNION ALL SELECT b.k, d.v, 'update_postimage' FROM b JOIN d ON b.k = d.k WHERE d.op = 'UPDATE'
UNION ALL SELECT d.k, d.v, 'insert' FROM d
          WHERE d.op <> 'DELETE' AND NOT EXISTS (SELECT 1 FROM b WHERE b.k = d.k)"""

# What a batch finds follows from the key's earlier batches since its last DELETE.
ALL_CHANGES = f"""
WITH per_batch AS (
    SELECT * FROM ({ROWS_WEEKLY}) f QUALIFY row_number() OVER (PARTITION BY k, b ORDER BY {FEED_TIES}) = 1),
base AS ({CUSTOMER_ROWS}),
hist AS (SELECT k, v, op, b,
                count(CASE WHEN op = 'DELETE' THEN 1 END)
                    OVER (PARTITION BY k ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seg
         FROM per_batch),
prior AS (SELECT h.k, h.v, h.op, h.b, h.seg = 0 AND base.k IS NOT NULL AS from_base, base.v AS v0,
                 max(CASE WHEN op = 'UPDATE' THEN b END) OVER w AS lu,
                 min(CASE WHEN op = 'INSERT' THEN b END) OVER w AS fi
          FROM hist h LEFT JOIN base ON base.k = h.k
          WINDOW w AS (PARTITION BY h.k, h.seg ORDER BY h.b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
found AS (SELECT p.k, p.v, p.op, p.b, (lu IS NOT NULL OR from_base OR fi IS NOT NULL) AS there,
                 CASE WHEN lu IS NOT NULL THEN pu.v WHEN from_base THEN v0 ELSE pi.v END AS old_v
          FROM prior p
          LEFT JOIN per_batch pu ON pu.k = p.k AND pu.b = p.lu
          LEFT JOIN per_batch pi ON pi.k = p.k AND pi.b = p.fi),
every_change AS (
    SELECT k, old_v AS v, 'delete' AS _change_type, b FROM found WHERE there AND op = 'DELETE'
    UNION ALL SELECT k, old_v, 'update_preimage', b FROM found WHERE there AND op = 'UPDATE'
    UNION ALL SELECT k, v, 'update_postimage', b FROM found WHERE there AND op = 'UPDATE'
    UNION ALL SELECT k, v, 'insert', b FROM found WHERE NOT there AND op <> 'DELETE')
SELECT k, v, _change_type, CAST(b AS BIGINT) AS _commit_version FROM every_change"""


def _product_changes(after: str = LINES_AFTER, before: str = LINES_BEFORE, ties: str = LINE_TIES) -> str:
    """Set difference of the products after each year, commit by commit."""
    years = range(SNAPSHOT_YEAR, 2002)
    sets = [
        replayed(f"SELECT * FROM ({after}) y WHERE b <= {year}", before, ties,
                 f"SELECT DISTINCT v AS p, {year} AS y FROM final")
        for year in years
    ]
    at = " UNION ALL ".join(f"SELECT * FROM ({s}) s" for s in sets)
    return f"""
WITH at_year AS ({at})
SELECT p, 'insert' AS _change_type, CAST(y - {SNAPSHOT_YEAR} AS BIGINT) AS _commit_version FROM at_year a
WHERE y > {SNAPSHOT_YEAR} AND NOT EXISTS (SELECT 1 FROM at_year o WHERE o.p = a.p AND o.y = a.y - 1)
UNION ALL
SELECT p, 'delete', CAST(y + 1 - {SNAPSHOT_YEAR} AS BIGINT) FROM at_year a
WHERE y < {max(years)} AND NOT EXISTS (SELECT 1 FROM at_year o WHERE o.p = a.p AND o.y = a.y + 1)"""


# -- loyalty tables: the row is carried as a struct ---------------------------------------------


def _loyalty(feed: str, base: str, ties: str, key: str, columns: list[str]) -> str:
    fields = ", ".join(f"v.{c} AS {c}" for c in columns)
    return replayed(feed, base, ties, f"SELECT k AS {key}, {fields} FROM final")


def _flags(column: str, pairs: list[tuple[str, str]]) -> str:
    return ", ".join(f"{flag} := CAST({column} = '{value}' AS BIGINT)" for flag, value in pairs)


CLIENTE_COLUMNS = ["flEmail", "flTwitch", "flYouTube", "flBlueSky", "flInstagram", "qtdePontos", "DtCriacao", "DtAtualizacao"]
_SEGMENTS = _flags("c_mktsegment", list(zip(CLIENTE_COLUMNS, ["HOUSEHOLD", "MACHINERY", "FURNITURE", "BUILDING", "AUTOMOBILE"])))
_KINDS = _flags("event_type", list(zip(CLIENTE_COLUMNS, ["click", "view", "purchase", "signup", "error"])))
CLIENTES = f"""
SELECT CAST(c_custkey AS VARCHAR) AS k, struct_pack({_SEGMENTS}, qtdePontos := CAST(floor(c_acctbal) AS BIGINT),
       DtCriacao := '2023-12-31', DtAtualizacao := '2023-12-31') AS v FROM customer"""
CLIENTES_FEED = f"""
SELECT CAST(user_id * 20 AS VARCHAR) AS k, struct_pack({_KINDS}, qtdePontos := CAST(floor(value) AS BIGINT),
       DtCriacao := strftime(ts, '%Y-%m-%d'), DtAtualizacao := CAST(ts AS VARCHAR)) AS v,
       CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
       ts, event_id, (CAST(day(ts) AS INT) - 1) // 7 + 1 AS b FROM events"""

TRANSACAO_COLUMNS = ["IdCliente", "DtCriacao", "QtdePontos", "DescSistemaOrigem"]
TRANSACOES = """
SELECT CAST(o_orderkey AS VARCHAR) AS k, struct_pack(IdCliente := CAST(o_custkey AS VARCHAR),
       DtCriacao := strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), QtdePontos := CAST(floor(o_totalprice) AS BIGINT),
       DescSistemaOrigem := o_orderpriority) AS v FROM orders"""
TRANSACOES_FEED = """
SELECT CAST(l_orderkey AS VARCHAR) AS k, struct_pack(IdCliente := CAST(l_suppkey AS VARCHAR),
       DtCriacao := strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S'), QtdePontos := CAST(floor(l_extendedprice) AS BIGINT),
       DescSistemaOrigem := l_linestatus) AS v,
       CASE l_returnflag WHEN 'N' THEN 'INSERT' WHEN 'R' THEN 'DELETE' ELSE 'UPDATE' END AS op,
       year(l_shipdate) AS b FROM lineitem"""
TRANSACAO_TIES = f"{OP_RANK}, v.IdCliente DESC, v.DtCriacao DESC, v.QtdePontos DESC, v.DescSistemaOrigem DESC"

PRODUTO_COLUMNS = ["IdTransacao", "IdProduto", "QtdeProduto", "vlProduto"]
_ITEMS = """
SELECT l_orderkey || '-' || l_linenumber AS k, struct_pack(IdTransacao := CAST(l_orderkey AS VARCHAR),
       IdProduto := CAST(l_partkey AS VARCHAR), QtdeProduto := CAST(l_quantity AS BIGINT),
       vlProduto := CAST(floor(l_extendedprice) AS BIGINT)) AS v,
       CASE l_returnflag WHEN 'N' THEN 'INSERT' WHEN 'R' THEN 'DELETE' ELSE 'UPDATE' END AS op,
       l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, year(l_shipdate) AS b FROM lineitem"""
ITEMS = f"""
SELECT k, v FROM ({_ITEMS}) i WHERE b <= {SNAPSHOT_YEAR}
QUALIFY row_number() OVER (PARTITION BY k ORDER BY {LINE_TIES}, v.QtdeProduto DESC, v.vlProduto DESC) = 1"""
ITEMS_FEED = f"SELECT * FROM ({_ITEMS}) i WHERE b > {SNAPSHOT_YEAR}"
ITEM_TIES = f"{OP_RANK}, v.IdTransacao DESC, v.IdProduto DESC, v.QtdeProduto DESC, v.vlProduto DESC"

_NO_OPS = ROWS_FEED.replace("ELSE 'UPDATE'", "WHEN 'click' THEN 'UPDATE' WHEN 'purchase' THEN 'REFUND'")
_MERGED_ROWS = once(ROWS_FEED).replace(CUSTOMERS, CUSTOMER_ROWS)
_SILVER_ROW = "v.c_acctbal AS balance, v.c_name AS c_name, v.c_nationkey AS c_nationkey, v.c_mktsegment AS c_mktsegment"


def _guarded(remember: bool) -> str:
    """Six batches, one after the other: what is stored (alive) and what was deleted (dead), by key."""
    event = "struct_pack(event_id := event_id, ts := ts, event_type := event_type, value := value, props := props)"
    parts = [
        f"""feed AS (SELECT user_id AS k, {event} AS v, ts,
       CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op,
       CASE WHEN day(ts) % 3 = 0 THEN 1 ELSE event_id % 4 + 2 END AS b FROM events),
won AS (SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY k, b ORDER BY ts DESC, v.event_id DESC) = 1),
s0 AS (SELECT user_id AS k, {event} AS v, CAST(NULL AS TIMESTAMP) AS dead FROM events WHERE day(ts) <= 10
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)"""
    ]
    for b in range(1, 6):
        late = "coalesce(w.ts < s.v.ts, false)" + (" OR coalesce(w.ts < s.dead, false)" if remember else "")
        parts.append(f"""s{b} AS (
    SELECT coalesce(s.k, w.k) AS k,
           CASE WHEN w.k IS NULL OR {late} OR (w.op = 'INSERT' AND s.v IS NOT NULL) THEN s.v WHEN w.op <> 'DELETE' THEN w.v END AS v,
           CASE WHEN w.k IS NULL OR {late} THEN s.dead WHEN w.op = 'DELETE' THEN w.ts END AS dead
    FROM s{b - 1} s FULL JOIN (SELECT * FROM won WHERE b = {b}) w ON w.k = s.k)""")
    return f"""
WITH {", ".join(parts)}
SELECT k, v.event_id AS event_id, v.ts AS ts, v.event_type AS event_type, v.value AS value, v.props AS props FROM s5 WHERE v IS NOT NULL"""


_ORDER_BATCHES = """
SELECT *, o_totalprice * 2 AS doubled, year(o_orderdate) < 1998 AS early, o_orderpriority < '3' AS urgent,
       CASE WHEN year(o_orderdate) >= 1998 THEN 'INSERT' WHEN o_orderstatus = 'P' THEN 'DELETE'
            WHEN o_orderkey % 40 = 1 THEN 'UPDATE' END AS op FROM orders"""
_EMITTED = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS emitted FROM events"
_NEXT = f"""
SELECT * FROM orders
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_orderkey)
ORDER BY o_orderdate, o_orderkey LIMIT {NEXT_BATCH}"""

# Pairs of product and supplier, as a set over two columns.
_PAIR = "struct_pack(p := l_partkey, s := l_suppkey) AS v"
_PAIRS_BEFORE, _PAIRS_AFTER = (q.replace("l_partkey AS v", _PAIR) for q in (EACH_LINE_BEFORE, EACH_LINE_AFTER))


def _offers(pairs: str, more: str = "") -> str:
    return f"SELECT p.p AS p, p.s AS s{more} FROM ({pairs}) q"


ORACLES = {
    "silver_projection_clients": "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
    "stamp_snapshot": """
        SELECT *, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp,
               '2024-01-02T03:04:05' AS _extracted_at, 'fullload' AS _load_type FROM orders""",
    "conform_schema": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
               CAST(CAST(round_even(c_acctbal, 0) AS BIGINT) AS VARCHAR) AS c_acctbal,
               TRY_CAST(c_mktsegment AS BIGINT) AS c_mktsegment, c_name, CAST(NULL AS VARCHAR) AS _operation
        FROM customer""",
    "scale_round_restore": """
        SELECT * REPLACE (CAST(round_even(p_size * CAST(1.07 AS DOUBLE), 0) AS INTEGER) AS p_size,
                          p_retailprice * CAST(1.07 AS DOUBLE) AS p_retailprice) FROM part""",
    "date_parse_profile": """
        WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS date_text,
                          o_orderpriority, o_orderstatus FROM orders),
        c AS (SELECT 'o_orderkey' AS "column", count(*) AS n_rows, count(o_orderkey) AS n_values, CAST(0 AS BIGINT) AS n_dates FROM o
              UNION ALL SELECT 'date_text', count(*), count(date_text), count(TRY_CAST(date_text AS TIMESTAMP)) FROM o
              UNION ALL SELECT 'o_orderpriority', count(*), count(o_orderpriority), count(TRY_CAST(o_orderpriority AS TIMESTAMP)) FROM o
              UNION ALL SELECT 'o_orderstatus', count(*), count(o_orderstatus), count(TRY_CAST(o_orderstatus AS TIMESTAMP)) FROM o)
        SELECT *, n_values > 0 AND n_dates = n_values AS maybe_date FROM c""",
    "csv_snapshot": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "latest_snapshot": """
        SELECT *, '2024-02-01T00:00:00' AS _extracted_at, 'fullload' AS _load_type,
               CAST(NULL AS VARCHAR) AS _operation FROM customer""",
    "drifting_types": """
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS o_orderstatus) FROM orders""",
    "drifting_stream": """
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' AND o_orderkey % 5 <> 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority)
        FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 5 = 0)""",
    "rejected_rows": """
        SELECT o_orderkey, 'o_totalprice' AS rejected_column, CAST(1 AS BIGINT) AS _commit_version FROM orders
        WHERE o_orderstatus <> 'F' AND o_orderkey % 10 = 0 AND o_totalprice <> floor(o_totalprice)""",
    "accepted_rows": """
        SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN CAST(trunc(o_totalprice) AS BIGINT)
                               ELSE CAST(floor(o_totalprice) AS BIGINT) END AS o_totalprice) FROM orders
        WHERE o_orderstatus = 'F' OR o_orderkey % 10 <> 0 OR o_totalprice = floor(o_totalprice)""",
    "schema_document": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey,
               CAST(NULL AS VARCHAR) AS _operation FROM customer""",
    "exact_sample": f"""
        SELECT * FROM orders ORDER BY (o_orderkey % {SAMPLE_M} * {SAMPLE_A} + {SAMPLE_B}) % {SAMPLE_M}, o_orderkey
        LIMIT (SELECT greatest(1, CAST(floor({SAMPLE_RATE} * count(*)) AS BIGINT)) FROM orders)""",
    "exact_sample_of_one": f"""
        SELECT * FROM supplier ORDER BY (s_suppkey % {SAMPLE_M} * {SAMPLE_A} + {SAMPLE_B}) % {SAMPLE_M}, s_suppkey LIMIT 1""",
    "remembered_pending": f"""
        SELECT * FROM orders QUALIFY row_number() OVER (ORDER BY o_orderdate, o_orderkey) > {2 * NEXT_BATCH}""",
    "extractions_in_turn": f"""
        WITH a AS (SELECT * FROM orders WHERE o_orderkey % 7 <> 0 ORDER BY o_orderdate, o_orderkey LIMIT {NEXT_BATCH}),
             b AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)
                   ORDER BY o_orderdate, o_orderkey LIMIT {NEXT_BATCH}),
             c AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a UNION ALL SELECT o_orderkey FROM b)
                   ORDER BY o_orderdate, o_orderkey LIMIT {NEXT_BATCH})
        SELECT *, 1 AS run FROM a UNION ALL SELECT *, 2 FROM b UNION ALL SELECT *, 3 FROM c""",
    "profile_landings": """
        WITH o AS (SELECT *, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_clerk FROM orders),
        f AS (
            SELECT 'o_orderkey' AS "column", count(*) AS n_rows, count(o_orderkey) AS n_values, CAST(0 AS BIGINT) AS n_dates, count(DISTINCT o_orderkey) AS d FROM o
            UNION ALL SELECT 'o_custkey', count(*), count(o_custkey), 0, count(DISTINCT o_custkey) FROM o
            UNION ALL SELECT 'o_orderstatus', count(*), count(o_orderstatus), 0, count(DISTINCT o_orderstatus) FROM o
            UNION ALL SELECT 'o_totalprice', count(*), count(o_totalprice), 0, count(DISTINCT o_totalprice) FROM o
            UNION ALL SELECT 'o_orderdate', count(*), count(o_orderdate), count(o_orderdate), count(DISTINCT o_orderdate) FROM o
            UNION ALL SELECT 'o_orderpriority', count(*), count(o_orderpriority), 0, count(DISTINCT o_orderpriority) FROM o
            UNION ALL SELECT 'o_clerk', count(*), count(o_clerk), 0, count(DISTINCT o_clerk) FROM o)
        SELECT "column", n_rows, n_values, n_dates, n_values = n_rows AND d >= 0.9 * n_rows AS maybe_key,
               n_values > 0 AND n_dates = n_values AS maybe_date FROM f""",
    "reconciliation": """
        WITH a AS (SELECT *, o_orderkey // 1000 AS thousand FROM orders),
             b AS (SELECT * REPLACE (CASE WHEN thousand % 5 = 0 AND o_orderkey % 100 = 1 THEN 'corrected' ELSE o_orderpriority END AS o_orderpriority)
                   FROM a WHERE NOT (thousand % 5 = 0 AND o_orderkey % 500 = 2)),
             d AS (SELECT thousand FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) x
                   UNION SELECT thousand FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) y),
             n AS (SELECT thousand, sum(p) AS p, sum(q) AS q FROM (
                       SELECT thousand, 1 AS p, 0 AS q FROM a UNION ALL SELECT thousand, 0, 1 FROM b) z GROUP BY thousand)
        SELECT thousand, CAST(p AS BIGINT) AS n_before, CAST(q AS BIGINT) AS n_after, thousand NOT IN (SELECT thousand FROM d) AS same FROM n""",
    "latest_event_per_user": """
        SELECT * FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "latest_line_per_key": """
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                                            l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                                            l_linestatus DESC) = 1""",
    "next_pending_batch": _NEXT,
    "emitted_rows": """
        SELECT * FROM orders
        WHERE EXISTS (SELECT 1 FROM events WHERE user_id = o_orderkey)""",
    "pending_rows": """
        SELECT * FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_orderkey)""",
    "emitted_key_set": f"{_EMITTED} UNION SELECT CAST(o_orderkey AS VARCHAR) FROM ({_NEXT}) n",
    "union_change_sets": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority,
               CASE o_orderstatus WHEN 'O' THEN 'INSERT' WHEN 'F' THEN 'UPDATE' ELSE 'DELETE' END AS _operation,
               CASE WHEN o_orderstatus = 'F' THEN 'F' END AS o_orderstatus
        FROM orders WHERE o_orderstatus IN ('O', 'F', 'P')""",
    "keyed_sample": f"""
        SELECT * FROM orders
        WHERE (o_orderkey % {SAMPLE_M} * {SAMPLE_A} + {SAMPLE_B}) % {SAMPLE_M} < {int(SAMPLE_RATE * SAMPLE_M)}""",
    "op_counts_by_day": f"""
        SELECT b, count(*) AS n_rows, count(*) FILTER (op = 'INSERT') AS n_insert,
               count(*) FILTER (op = 'UPDATE') AS n_update, count(*) FILTER (op = 'DELETE') AS n_delete
        FROM ({FEED}) f GROUP BY b""",
    "layer_counts": f"""
        SELECT 'bronze' AS layer, count(*) AS n_rows FROM ({once(FEED)}) m
        UNION ALL SELECT 'silver', count(*) FROM ({once(FEED)}) m WHERE v > 20""",
    "merge_once": once(FEED),
    "merge_once_rows": f"SELECT k, {ROW_COLUMNS} FROM ({_MERGED_ROWS}) m",
    "merge_once_latest_wins": f"SELECT k, {ROW_COLUMNS} FROM ({once(ROWS_FEED, insert_on_match='d.v').replace(CUSTOMERS, CUSTOMER_ROWS)}) m",
    "merge_changes": f"SELECT k, {ROW_COLUMNS}, _change_type FROM ({MERGE_CHANGES}) m",
    "merge_null_and_unknown_ops": f"SELECT k, {ROW_COLUMNS} FROM ({once(_NO_OPS).replace(CUSTOMERS, CUSTOMER_ROWS)}) m",
    "merge_guarded": """
        WITH s AS (SELECT * FROM events WHERE day(ts) <= 15
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
             d AS (SELECT * FROM events
                   QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id % 7 DESC, event_id DESC) = 1),
             kept AS (SELECT s.* FROM s LEFT JOIN d USING (user_id)
                      WHERE d.user_id IS NULL OR d.ts < s.ts OR d.event_type = 'signup'),
             put AS (SELECT d.* FROM d LEFT JOIN s USING (user_id)
                     WHERE d.event_type <> 'error'
                       AND (s.user_id IS NULL OR (d.ts >= s.ts AND d.event_type <> 'signup')))
        SELECT user_id AS k, * EXCLUDE (user_id) FROM (SELECT * FROM kept UNION ALL SELECT * FROM put) a""",
    "snapshot_diff": f"""
        SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN b.v ELSE a.v END AS v,
               CASE WHEN b.k IS NULL THEN 'INSERT' WHEN a.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS _operation
        FROM ({CUSTOMERS}) b FULL JOIN ({once(FEED)}) a ON a.k = b.k
        WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v""",
    "snapshot_diff_rows": f"""
        SELECT k, {ROW_COLUMNS}, _operation FROM (
            SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN b.v ELSE a.v END AS v,
                   CASE WHEN b.k IS NULL THEN 'INSERT' WHEN a.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS _operation
            FROM ({CUSTOMER_ROWS}) b FULL JOIN ({_MERGED_ROWS}) a ON a.k = b.k
            WHERE a.k IS NULL OR b.k IS NULL OR a.v IS DISTINCT FROM b.v) d""",
    "snapshot_diff_repeated_keys": """
        WITH a AS (SELECT * REPLACE (CASE WHEN l_linenumber = 2 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity)
                   FROM (SELECT * FROM lineitem WHERE l_linenumber <> 3
                         UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1 AND l_returnflag = 'R') x),
             gone AS (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM a),
             come AS (SELECT * FROM a EXCEPT ALL SELECT * FROM lineitem),
             n AS (SELECT l_orderkey, sum(o) AS o, sum(w) AS w FROM (
                       SELECT l_orderkey, 1 AS o, 0 AS w FROM gone UNION ALL SELECT l_orderkey, 0, 1 FROM come) y
                   GROUP BY l_orderkey)
        SELECT c.*, CASE WHEN o = 1 AND w = 1 THEN 'UPDATE' ELSE 'INSERT' END AS _operation
        FROM come c JOIN n ON c.l_orderkey = n.l_orderkey
        UNION ALL
        SELECT g.*, 'DELETE' FROM gone g JOIN n ON g.l_orderkey = n.l_orderkey WHERE NOT (o = 1 AND w = 1)""",
    "replay_fold": replayed(FEED, CUSTOMERS, FEED_TIES),
    "replay_fold_rows": replayed(ROWS_FEED, CUSTOMER_ROWS, FEED_TIES, f"SELECT k, {ROW_COLUMNS} FROM final"),
    "replay_daily": replayed(ROWS_FEED, CUSTOMER_ROWS, FEED_TIES, f"SELECT k, {ROW_COLUMNS} FROM final"),
    "replay_backlog": replayed(ROWS_FEED, CUSTOMER_ROWS, FEED_TIES, f"SELECT k, {ROW_COLUMNS} FROM final"),
    "replay_latest_wins": f"SELECT k, {ROW_COLUMNS} FROM ({LATEST_WINS}) w",
    "replay_guarded": _guarded(remember=False),
    "replay_tombstones": _guarded(remember=True),
    "partitioned_orders": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CASE WHEN op IS NULL THEN o_totalprice ELSE doubled END AS o_totalprice, o_orderdate, o_orderpriority
        FROM ({_ORDER_BATCHES}) o WHERE early AND coalesce(op <> 'DELETE', true) OR op = 'INSERT'""",
    "partitioned_order_changes": f"""
        WITH c AS (SELECT *, CAST(CASE WHEN urgent THEN 1 ELSE 3 END AS BIGINT) AS _commit_version
                   FROM ({_ORDER_BATCHES}) o WHERE op IS NOT NULL),
        kinds AS (SELECT * FROM (VALUES ('INSERT', 'insert', true), ('DELETE', 'delete', false), ('UPDATE', 'update_preimage', false),
                                        ('UPDATE', 'update_postimage', true)) t(op, _change_type, new))
        SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN new THEN doubled ELSE o_totalprice END AS o_totalprice,
               o_orderdate, o_orderpriority, _change_type, _commit_version FROM c JOIN kinds USING (op)""",
    "changes_by_version": f"""
        SELECT k, {ROW_COLUMNS}, _change_type, _commit_version FROM ({ALL_CHANGES}) a WHERE _commit_version BETWEEN 2 AND 4""",
    "latest_row_change_per_key": f"""
        SELECT k, {ROW_COLUMNS}, _change_type, _commit_version FROM ({ALL_CHANGES}) a WHERE _change_type <> 'update_preimage'
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY _commit_version DESC) = 1""",
    "table_bootstrap": "SELECT * FROM orders",
    "table_at_version": replayed(
        f"SELECT * FROM ({ROWS_WEEKLY}) w WHERE b <= 3", CUSTOMER_ROWS, FEED_TIES, f"SELECT k, {ROW_COLUMNS} FROM final"
    ),
    "silver_from_changes": replayed(
        ROWS_WEEKLY, CUSTOMER_ROWS, FEED_TIES, f"SELECT k AS id, {_SILVER_ROW} FROM final WHERE v.c_acctbal > 20"
    ),
    "silver_merged_from_changes": replayed(
        ROWS_WEEKLY, CUSTOMER_ROWS, FEED_TIES, f"SELECT k AS id, {_SILVER_ROW} FROM final WHERE v.c_acctbal > 20"
    ),
    "silver_merged_backlog": f"""
        WITH l AS (SELECT k, v, CASE WHEN _change_type = 'delete' OR NOT v.c_acctbal > 20 THEN 'DELETE'
                                     WHEN _change_type = 'insert' THEN 'INSERT' ELSE 'UPDATE' END AS op
                   FROM ({ALL_CHANGES}) a WHERE _change_type <> 'update_preimage'
                   QUALIFY row_number() OVER (PARTITION BY k ORDER BY _commit_version DESC) = 1),
             s AS (SELECT * FROM ({CUSTOMER_ROWS}) c WHERE v.c_acctbal > 20),
             m AS (SELECT coalesce(s.k, l.k) AS k, CASE WHEN s.k IS NULL OR l.op = 'UPDATE' THEN l.v ELSE s.v END AS v
                   FROM s FULL JOIN l ON s.k = l.k WHERE l.op IS NULL OR l.op <> 'DELETE')
        SELECT k AS id, {_SILVER_ROW} FROM m""",
    "distinct_products": "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL",
    "distinct_products_maintained": replayed(LINES_AFTER, LINES_BEFORE, LINE_TIES, "SELECT DISTINCT v AS p FROM final"),
    "distinct_products_changes": _product_changes(),
    "distinct_line_products_maintained": replayed(
        EACH_LINE_AFTER, EACH_LINE_BEFORE, f"{LINE_TIES}, {OP_RANK}", "SELECT DISTINCT v AS p FROM final"
    ),
    "distinct_line_products_changes": _product_changes(EACH_LINE_AFTER, EACH_LINE_BEFORE, f"{LINE_TIES}, {OP_RANK}"),
    "silver_from_sql": replayed(
        ROWS_WEEKLY, CUSTOMER_ROWS, FEED_TIES, f"SELECT k AS id, {_SILVER_ROW} FROM final WHERE v.c_acctbal > 20"
    ),
    "distinct_offers_maintained": _offers(replayed(_PAIRS_AFTER, _PAIRS_BEFORE, f"{LINE_TIES}, {OP_RANK}", "SELECT DISTINCT v AS p FROM final")),
    "distinct_offers_changes": _offers(_product_changes(_PAIRS_AFTER, _PAIRS_BEFORE, f"{LINE_TIES}, {OP_RANK}"), ", _change_type, _commit_version"),
    "distinct_offers_streamed": _offers(replayed(_PAIRS_AFTER, _PAIRS_BEFORE, f"{LINE_TIES}, {OP_RANK}", "SELECT DISTINCT v AS p FROM final")),
    "loyalty_clientes": _loyalty(CLIENTES_FEED, CLIENTES, FEED_TIES, "idCliente", CLIENTE_COLUMNS),
    "loyalty_transacoes": _loyalty(TRANSACOES_FEED, TRANSACOES, TRANSACAO_TIES, "IdTransacao", TRANSACAO_COLUMNS),
    "loyalty_transacao_produto": _loyalty(ITEMS_FEED, ITEMS, ITEM_TIES, "idTransacaoProduto", PRODUTO_COLUMNS),
    "loyalty_produtos": replayed(ITEMS_FEED, ITEMS, ITEM_TIES, "SELECT DISTINCT v.IdProduto AS IdProduto FROM final"),
}
ORACLES["snapshot_diff_digest"] = ORACLES["snapshot_diff_rows"]
