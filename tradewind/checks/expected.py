"""The expected result of every registered query, as SQL over the same tables.

The statements compute from the star-schema tables directly; they share no step with the
operators. Money is summed as DECIMAL(18,2).
"""


def msum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


ORDERS = """
o0 AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS tc FROM orders),
o1 AS (SELECT *, tc * 18 // 118 AS xc,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'pos'
         WHEN o_orderpriority IN ('2-HIGH', '5-LOW') THEN 'shopify'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'distributor' ELSE 'amazon' END AS channel FROM o0),
so AS (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '#' || o_orderkey AS order_number, channel,
    o_orderdate AS created_at, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN channel IN ('shopify', 'amazon')
         THEN 'c' || o_custkey || '.' || channel || '@example.com' END AS customer_email,
    'INR' AS currency, (tc - xc) / 100.0::DOUBLE AS subtotal_amount,
    xc / 100.0::DOUBLE AS tax_amount, o_totalprice AS total_amount,
    o_orderpriority AS payment_method, o_orderstatus AS payment_status, 'Online' AS region FROM o1)
"""

LINES = """
l0 AS (SELECT *, l_orderkey || '-' || l_linenumber AS lid,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS pc,
    CAST(round(l_tax * 100) AS BIGINT) AS pct, l_extendedprice / l_quantity AS up FROM lineitem),
li AS (SELECT *, (pc * pct + 50) // 100 AS xc FROM l0)
"""

ITEMS = (
    LINES
    + """,
it AS (SELECT lid AS order_item_id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku, p_name AS title, CAST(l_quantity AS INT) AS quantity,
    up AS unit_price, l_extendedprice AS total_amount, xc / 100.0::DOUBLE AS tax_amount,
    l_shipdate AS shipped FROM li JOIN part ON l_partkey = p_partkey)
"""
)


def daily(src: str) -> str:
    return f"""SELECT strftime(created_at, '%Y-%m-%d') AS sales_date, channel,
    COUNT(order_id) AS order_count, {msum('total_amount')} AS gross_revenue,
    {msum('tax_amount')} AS tax_collected,
    {msum('total_amount')} / COUNT(total_amount) AS average_order_value
    FROM {src} GROUP BY 1, 2"""


def inventory(items: str, orders: str) -> str:
    return f"""SELECT strftime(o.created_at, '%Y-%m-%d') AS sales_date, i.sku,
    MIN(i.title) AS product_title, CAST(SUM(i.quantity) AS BIGINT) AS units_sold,
    {msum('i.total_amount')} AS total_sales_amount
    FROM {items} i JOIN {orders} o ON i.order_id = o.order_id GROUP BY 1, 2"""


def customers(src: str) -> str:
    return f"""SELECT customer_id,
    arg_min(customer_email, (created_at, order_id))
        FILTER (WHERE customer_email IS NOT NULL) AS customer_email,
    MIN(created_at) AS first_purchase_date, MAX(created_at) AS last_purchase_date,
    COUNT(order_id) AS total_orders, {msum('total_amount')} AS total_spend,
    arg_min(channel, (created_at, order_id)) AS preferred_channel
    FROM {src} WHERE customer_id IS NOT NULL GROUP BY 1"""


def products(src: str) -> str:
    return f"""SELECT sku, title, unit_price AS retail_price FROM (
    SELECT *, row_number() OVER (PARTITION BY sku ORDER BY title, unit_price) AS rn
    FROM {src}) WHERE rn = 1"""


def unique_items(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY order_item_id ORDER BY shipped DESC, order_id DESC, sku DESC, title DESC,
    quantity DESC, unit_price DESC, total_amount DESC) AS rn FROM {src}) WHERE rn = 1"""


def merged(target: str, source: str, keys: str) -> str:
    """Source rows win over target rows of the same key, all columns."""
    same = " AND ".join(f"s.{k} IS NOT DISTINCT FROM t.{k}" for k in keys.split())
    return f"""SELECT * FROM {source} UNION ALL BY NAME
    SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {same})"""


LOADED = "< TIMESTAMP '1999-01-01'"
BATCH = ">= TIMESTAMP '1998-01-01'"
FIRST_LOAD = f"""(SELECT * REPLACE (
    CASE WHEN payment_status = 'P' THEN 0 ELSE total_amount END AS total_amount,
    CASE WHEN payment_status = 'P' THEN 0 ELSE tax_amount END AS tax_amount)
    FROM so WHERE created_at {LOADED})"""
BATCH_LOAD = f"(SELECT * FROM so WHERE created_at {BATCH})"


PRODUCT_REVENUE = f"""SELECT product_title, {msum('total_sales_amount')} AS total_sales_amount
    FROM ({inventory('it', 'so')}) GROUP BY 1"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes} {body}"


def kept_merge(changes: str) -> str:
    """Orders upsert: channel and currency of a matched order are the target's."""
    return with_(
        f"{ORDERS}, t AS (SELECT * FROM so WHERE created_at {LOADED}), "
        f"s AS (SELECT * REPLACE ({changes}) FROM so WHERE created_at {BATCH})",
        """SELECT s.* REPLACE (coalesce(t.channel, s.channel) AS channel,
            coalesce(t.currency, s.currency) AS currency)
        FROM s LEFT JOIN t ON s.order_id = t.order_id
        UNION ALL BY NAME SELECT * FROM t WHERE order_id NOT IN (SELECT order_id FROM s)""",
    )


# two loads into the lake: the second moves the pending orders
MOVED = """CASE WHEN payment_status = 'P' THEN created_at + INTERVAL 1 DAY ELSE created_at END
        AS created_at,
    CASE WHEN payment_status = 'P' THEN 'moved-' || customer_id ELSE customer_id END AS customer_id"""
LAKE = f"""{ORDERS}, {ITEMS}, t AS (SELECT * FROM {FIRST_LOAD}),
s AS (SELECT * REPLACE ({MOVED}) FROM so WHERE created_at {BATCH}),
lo AS (SELECT s.* REPLACE (coalesce(t.channel, s.channel) AS channel,
        coalesce(t.currency, s.currency) AS currency)
    FROM s LEFT JOIN t ON s.order_id = t.order_id
    UNION ALL BY NAME SELECT * FROM t WHERE order_id NOT IN (SELECT order_id FROM s)),
ti AS ({unique_items(f'it WHERE shipped {LOADED}')}),
si AS ({unique_items(f'it WHERE shipped {BATCH}')}),
lit AS ({merged('ti', 'si', 'order_item_id')})"""

# feeds: one record version per id, then the silver columns

DIST = (
    LINES
    + """,
dl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lid
    ORDER BY l_shipdate DESC, 'distributor-' || l_suppkey || '-' || l_partkey DESC,
    CAST(l_suppkey AS VARCHAR) DESC, l_returnflag DESC, CAST(l_partkey AS VARCHAR) DESC,
    CAST(l_quantity AS INT) DESC, up DESC, xc DESC, pc + xc DESC, l_linestatus DESC) AS rn
    FROM li) WHERE rn = 1)
"""
)
DIST_ORDERS = f"""SELECT 'INV-' || l_orderkey AS order_id, 'INV-' || l_orderkey AS order_number,
    'distributor' AS channel, date_trunc('day', MIN(l_shipdate))::TIMESTAMP AS created_at,
    arg_min(CAST(l_suppkey AS VARCHAR), lid) AS customer_id, CAST(NULL AS VARCHAR) AS customer_email,
    'INR' AS currency, {msum('pc / 100.0::DOUBLE')} AS subtotal_amount,
    {msum('xc / 100.0::DOUBLE')} AS tax_amount,
    {msum('(pc + xc) / 100.0::DOUBLE')} AS total_amount, 'BANK_TRANSFER' AS payment_method,
    arg_min(l_linestatus, lid) AS payment_status, arg_min(l_returnflag, lid) AS region
    FROM dl GROUP BY 1, 2"""
DIST_ITEMS = """SELECT lid AS order_item_id, 'INV-' || l_orderkey AS order_id,
    CAST(l_partkey AS VARCHAR) AS sku, CAST(l_partkey AS VARCHAR) AS title,
    CAST(l_quantity AS INT) AS quantity, up AS unit_price,
    (pc + xc) / 100.0::DOUBLE AS total_amount FROM dl"""

# One record per order line. Versions with the same ship date and file share part, supplier and
# order, so the remaining tie-break only concerns rows that differ in price or quantity.
POS = (
    LINES
    + """,
pl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lid
    ORDER BY l_shipdate DESC, 'pos-' || l_suppkey || '-' || l_partkey DESC, pc DESC) AS rn
    FROM li) WHERE rn = 1),
px AS (SELECT *, 1 AS n, CAST(l_partkey AS VARCHAR) AS xsku, 'Part ' || l_partkey AS xtitle,
        CAST(l_quantity AS INT) AS xqty FROM pl WHERE l_returnflag IN ('A', 'R')
    UNION ALL SELECT *, 2, CASE WHEN l_linenumber = 7 THEN CAST(l_partkey AS VARCHAR)
        ELSE 'S' || l_suppkey END, 'Service', 1 FROM pl WHERE l_returnflag = 'R')
"""
)
POS_ORDERS = """SELECT 'T' || lid AS order_id, 'T' || lid AS order_number, 'pos' AS channel,
    l_shipdate AS created_at, CASE WHEN l_quantity > 25 THEN 'L' || l_suppkey END AS customer_id,
    CAST(NULL AS VARCHAR) AS customer_email, 'INR' AS currency, l_extendedprice AS subtotal_amount,
    xc / 100.0::DOUBLE AS tax_amount, (pc + xc) / 100.0::DOUBLE AS total_amount,
    l_linestatus AS payment_method, 'PAID' AS payment_status, 'Store ' || l_suppkey AS region
    FROM pl"""
# The key of a SKU that an order lists again is made from its key and its number among them.
def again(order: str) -> str:
    n = "row_number() OVER (PARTITION BY lid, xsku ORDER BY n)"
    return f"""CASE {n} WHEN 1 THEN sha256({order} || '-' || xsku)
    ELSE sha256(sha256({order} || '-' || xsku) || '#' || {n}) END"""


POS_ITEMS = f"""SELECT {again("'T' || lid")} AS order_item_id, 'T' || lid AS order_id,
    xsku AS sku, xtitle AS title, xqty AS quantity,
    CASE WHEN n = 1 THEN up ELSE xc / 100.0::DOUBLE END AS unit_price,
    CASE WHEN n = 1 THEN l_extendedprice ELSE xc / 100.0::DOUBLE END AS total_amount FROM px"""

AMZ_ID = "CASE WHEN l_linestatus = 'F' THEN 'T' ELSE 'A' END || lid"
AMAZON = (
    LINES
    + f""",
al AS (SELECT * FROM (SELECT *, {AMZ_ID} AS aid, row_number() OVER (PARTITION BY {AMZ_ID}
    ORDER BY l_shipdate DESC, 'amazon-' || l_suppkey || '-' || l_partkey DESC, pc DESC) AS rn
    FROM li) WHERE rn = 1),
ax AS (SELECT *, 1 AS n, CAST(l_partkey AS VARCHAR) AS xsku, 'Part ' || l_partkey AS xtitle,
        CAST(l_quantity AS INT) AS xqty, pc / 100.0::DOUBLE AS xamt FROM al
        WHERE l_returnflag IN ('A', 'R')
    UNION ALL SELECT *, 2, CASE WHEN l_linenumber = 7 THEN CAST(l_partkey AS VARCHAR)
        ELSE 'S' || l_suppkey END, 'Service', 0, xc / 100.0::DOUBLE FROM al
        WHERE l_returnflag = 'R')
"""
)
AMAZON_ORDERS = """SELECT aid AS order_id, 'AMZ-' || lid AS order_number, 'amazon' AS channel,
    l_shipdate AS created_at, 's' || l_suppkey || '@example.com' AS customer_id,
    's' || l_suppkey || '@example.com' AS customer_email,
    CASE WHEN l_tax > 0.04 THEN 'USD' ELSE 'INR' END AS currency,
    CASE l_returnflag WHEN 'A' THEN pc / 100.0::DOUBLE WHEN 'R' THEN (pc + xc) / 100.0::DOUBLE
        END AS subtotal_amount,
    CASE WHEN l_returnflag IN ('A', 'R') THEN xc / 100.0::DOUBLE END AS tax_amount,
    (pc + xc) / 100.0::DOUBLE AS total_amount, 'COD' AS payment_method, 'PAID' AS payment_status,
    'Amazon.in' AS region FROM al"""
AMAZON_ITEMS = f"""SELECT {again("aid").replace("BY lid", "BY aid")} AS order_item_id, aid AS order_id, xsku AS sku,
    xtitle AS title, xqty AS quantity,
    CASE WHEN xqty <> 0 THEN xamt / xqty END AS unit_price, xamt AS total_amount FROM ax"""

SHOP = "o0 AS (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS tc FROM orders), " + (
    "sp AS (SELECT *, tc * 18 // 118 AS xc FROM o0)"
)
SHOP_ORDERS = """SELECT 'S' || o_orderkey AS order_id, '#' || o_orderkey AS order_number,
    'shopify' AS channel, o_orderdate AS created_at, 'C' || o_custkey AS customer_id,
    'c' || o_custkey || '@example.com' AS customer_email, 'INR' AS currency,
    (tc - xc) / 100.0::DOUBLE AS subtotal_amount, xc / 100.0::DOUBLE AS tax_amount,
    tc / 100.0::DOUBLE AS total_amount,
    CASE WHEN o_orderstatus = 'P' THEN 'ONLINE' ELSE o_orderpriority END AS payment_method,
    'PAID' AS payment_status, 'Online' AS region FROM sp"""
SHOP_ITEMS = """SELECT 'S' || o_orderkey || '/' || n AS order_item_id, 'S' || o_orderkey AS order_id,
    'C' || o_custkey AS sku, 'Pack ' || o_custkey AS title, CASE n WHEN 1 THEN 1 ELSE 3 END AS quantity,
    CASE n WHEN 1 THEN tc ELSE xc END / 100.0::DOUBLE AS unit_price,
    CASE n WHEN 1 THEN 1 ELSE 3 END * (CASE n WHEN 1 THEN tc ELSE xc END / 100.0::DOUBLE)
        AS total_amount FROM sp, (VALUES (1), (2)) v(n)"""

_LINES_ONCE = LINES
ALL_FEEDS = ", ".join(
    [LINES, *(c.replace(_LINES_ONCE + ",", "") for c in (DIST, POS, AMAZON)), SHOP]
)
ALL_ORDERS = (
    f"{ALL_FEEDS}, a1 AS ({SHOP_ORDERS}), a2 AS ({POS_ORDERS}), a3 AS ({DIST_ORDERS}), "
    f"a4 AS ({AMAZON_ORDERS}), ao AS ("
    + " UNION ALL BY NAME ".join(f"SELECT *, {i} AS rk FROM a{i}" for i in (1, 2, 3, 4))
    + ")"
)
ALL_ITEMS = (
    f"{ALL_FEEDS}, b1 AS ({SHOP_ITEMS}), b2 AS ({POS_ITEMS}), b3 AS ({DIST_ITEMS}), "
    f"b4 AS ({AMAZON_ITEMS}), bo AS ("
    + " UNION ALL BY NAME ".join(f"SELECT *, {i} AS channel_rank FROM b{i}" for i in (1, 2, 3, 4))
    + """), ui AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY order_item_id ORDER BY channel_rank DESC, order_id DESC, sku DESC, title DESC,
    quantity DESC, unit_price DESC NULLS LAST, total_amount DESC NULLS LAST) AS rn FROM bo)
    WHERE rn = 1)"""
)


def report(src: str, table: str, rules: list) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{kind}' AS rule, '{column}' AS \"column\", '{severity}' AS severity, "
        f"(SELECT {count} FROM {src}) AS unexpected"
        for kind, column, severity, count in rules
    )
    return f"""SELECT '{table}' AS "table", (SELECT COUNT(*) FROM {src}) AS row_count, r.*,
    CASE WHEN unexpected = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({rows}) r"""


def nulls(c: str) -> str:
    return f"COUNT(*) - COUNT({c})"


def repeats(c: str) -> str:
    return f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {c} FROM %s))"


BAD = """bad AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc,
    'drop_' || strftime(o_orderdate, '%Y-%m-%d') AS file, CASE
    WHEN o_totalprice < 6000 THEN ['email: pattern']
    WHEN o_totalprice BETWEEN 6000 AND 10999.99 THEN ['customer: missing']
    WHEN o_totalprice BETWEEN 11000 AND 15999.99 THEN ['createdAt: null']
    WHEN o_totalprice BETWEEN 16000 AND 20999.99 THEN ['totalTaxSet: type']
    WHEN o_totalprice BETWEEN 21000 AND 23499.99 THEN ['invalid json']
    WHEN o_totalprice BETWEEN 23500 AND 25999.99 THEN ['no envelope']
    WHEN o_totalprice BETWEEN 28500 AND 30999.99 THEN ['id: missing', 'name: missing',
        'createdAt: missing', 'email: missing', 'totalPriceSet: missing',
        'subtotalPriceSet: missing', 'totalTaxSet: missing', 'customer: missing',
        'lineItems: missing', 'sourceName: missing'] ELSE [] END AS errors,
    CASE WHEN o_totalprice BETWEEN 21000 AND 28499.99 THEN 0 ELSE 1 END AS records FROM orders),
ok AS (SELECT file, COUNT(*) AS n_documents, CAST(SUM(records) AS BIGINT) AS n_records,
    CAST(SUM(len(errors)) AS BIGINT) AS n_errors, SUM(len(errors)) = 0 AS passed FROM bad GROUP BY 1)
"""

EVENT_FEATURES = """ef AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY customer_id ORDER BY event_timestamp DESC, created_timestamp DESC,
    event_type DESC, "value" DESC) AS rn FROM (
        SELECT CAST(user_id AS VARCHAR) AS customer_id, event_type, "value",
        date_trunc('hour', ts)::TIMESTAMP AS event_timestamp, ts AS created_timestamp FROM events)
    WHERE event_timestamp BETWEEN TIMESTAMP '2023-10-27' AND TIMESTAMP '2024-01-25')
    WHERE rn = 1)"""

_CRIT, _WARN = "critical", "warning"

POS_DROPS = """SELECT CASE WHEN ok THEN CAST(o_orderkey AS VARCHAR) END AS transaction_id,
    'st' || o_custkey AS store_id, o_orderpriority AS payment_method, o_totalprice AS total_amount,
    CASE WHEN NOT ok THEN 'transaction_id: missing' END AS reasons,
    CASE WHEN ok THEN 'accepted' ELSE 'dead_letter' END AS route
    FROM (SELECT *, o_orderstatus <> 'P' AS ok FROM orders)"""

EXPECTED = {
    "ingest_web_drops": with_(SHOP, SHOP_ORDERS),
    "ingest_market_drops": """
        SELECT CASE WHEN ok THEN CAST(o_orderkey AS VARCHAR) END AS "AmazonOrderId",
            o_orderstatus AS "OrderStatus",
            CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total,
            CASE WHEN NOT ok THEN 'AmazonOrderId: missing' END AS reasons,
            CASE WHEN ok THEN 'accepted' ELSE 'dead_letter' END AS route, '2024-01-01' AS ingest_date
        FROM (SELECT *, o_orderstatus <> 'P' AS ok FROM orders) WHERE o_custkey % 5 <> 0
        UNION ALL SELECT NULL, NULL, NULL, 'no Orders list', 'dead_letter', '2024-01-01'
        FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey % 5 = 0""",
    "ingest_pos_drops": POS_DROPS,
    "stream_restart": POS_DROPS,
    "ingest_csv_drops": """
        SELECT CASE WHEN ok THEN l_orderkey || '-' || l_linenumber END AS "TransactionID",
            CASE WHEN ok THEN 'North, "' || l_suppkey || '" Co' END AS "DistributorName",
            CASE WHEN ok THEN l_linestatus END AS "Region",
            CASE WHEN ok THEN strftime(l_shipdate, '%Y-%m-%d') END AS invoice_date,
            CASE WHEN ok THEN CAST(l_partkey AS VARCHAR) END AS "SKU",
            CASE WHEN ok THEN CAST(l_quantity AS INT) END AS "Quantity",
            CASE WHEN ok THEN l_extendedprice END AS "UnitPrice",
            CASE WHEN NOT ok THEN 'Quantity: type' END AS reasons,
            CASE WHEN ok THEN 'accepted' ELSE 'dead_letter' END AS route
        FROM (SELECT *, l_returnflag <> 'R' AS ok FROM lineitem)""",
    "contract_types": """
        SELECT CAST(p_partkey AS VARCHAR) AS file, 'size: type' AS error FROM part WHERE p_size % 3 = 0
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'tags: type' FROM part WHERE p_size % 4 = 0
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'brand: pattern' FROM part
        WHERE NOT regexp_matches(p_brand, '^Brand#[1-3]')""",
    "lake_guards": """
        SELECT 'available' AS what, CASE WHEN count(*) > 0 THEN 'true' ELSE 'false' END AS "value"
        FROM orders
        UNION ALL SELECT 'empty', 'false' UNION ALL SELECT 'missing', 'false'
        UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM orders
        UNION ALL SELECT 'stamped', '2024-01-01'
        UNION ALL SELECT 'latest', strftime(max(o_orderdate), '%Y-%m-%d') FROM orders
        UNION ALL SELECT 'skipped rules', '6'""",
    "daily_revenue_channel": with_(ORDERS, daily("so")),
    "inventory_turnover": with_(f"{ORDERS}, {ITEMS}", inventory("it", "so")),
    "customer_360": with_(ORDERS, customers("so")),
    "kpi_totals": with_(
        ORDERS,
        f"SELECT {msum('total_amount')} AS total_revenue, COUNT(order_id) AS total_orders, "
        f"{msum('tax_amount')} AS total_tax FROM so",
    ),
    "revenue_pivot": with_(
        ORDERS,
        "SELECT strftime(created_at, '%Y-%m-%d') AS sales_date, "
        + ", ".join(
            f"coalesce(CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) "
            f"FILTER (WHERE channel = '{c}') AS DOUBLE), 0.0) AS {c}"
            for c in ("shopify", "pos", "distributor", "amazon")
        )
        + " FROM so GROUP BY 1",
    ),
    "days_in_order": with_(ORDERS, daily("so")),
    "recent_days": with_(
        f"{ORDERS}, d AS ({daily('so')})",
        "SELECT * FROM d WHERE sales_date IN "
        "(SELECT DISTINCT sales_date FROM d ORDER BY 1 DESC LIMIT 20)",
    ),
    "skus_by_units": with_(f"{ORDERS}, {ITEMS}", inventory("it", "so")),
    "top_skus_by_units": with_(
        f"{ORDERS}, {ITEMS}",
        f"SELECT * FROM ({inventory('it', 'so')}) "
        "ORDER BY units_sold DESC, total_sales_amount DESC, sales_date, sku LIMIT 20",
    ),
    "products_by_revenue": with_(f"{ORDERS}, {ITEMS}", PRODUCT_REVENUE),
    "top_products_by_revenue": with_(
        f"{ORDERS}, {ITEMS}",
        f"{PRODUCT_REVENUE} ORDER BY total_sales_amount DESC, product_title LIMIT 20",
    ),
    "customers_by_spend": with_(ORDERS, customers("so")),
    "top_customers": with_(
        ORDERS,
        f"SELECT * FROM ({customers('so')}) "
        "ORDER BY total_spend DESC NULLS LAST, customer_id LIMIT 20",
    ),
    "dedupe_latest_items": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
        l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "item_surrogate_key": """SELECT l_linenumber,
        sha256(l_orderkey || '-' || l_partkey) AS order_item_id FROM lineitem""",
    "item_key_collisions": """SELECT sha256(l_orderkey || '-' || l_partkey) AS order_item_id,
        COUNT(*) AS row_count FROM lineitem GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1""",
    "conform_shopify_orders": with_(SHOP, SHOP_ORDERS),
    "conform_shopify_items": with_(SHOP, SHOP_ITEMS),
    "conform_pos_orders": with_(POS, POS_ORDERS),
    "conform_pos_items": with_(POS, POS_ITEMS),
    "invoice_rollup": with_(DIST, DIST_ORDERS),
    "conform_distributor_items": with_(DIST, DIST_ITEMS),
    "conform_amazon_orders": with_(AMAZON, AMAZON_ORDERS),
    "conform_amazon_items": with_(AMAZON, AMAZON_ITEMS),
    "order_item_sums": with_(
        f"{ORDERS}, {ITEMS}",
        f"""SELECT so.order_id, so.total_amount AS order_total, {msum('it.tax_amount')} AS tax_amount,
        {msum('it.total_amount')} AS subtotal_amount
        FROM so LEFT JOIN it ON so.order_id = it.order_id GROUP BY 1, 2""",
    ),
    "extract_products": with_(ITEMS, products("it")),
    "union_channels": with_(
        ALL_ORDERS,
        """SELECT l.* EXCLUDE (rk, channel, currency), f.channel, f.currency FROM
        (SELECT * FROM ao QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY rk DESC) = 1) l
        JOIN (SELECT order_id, channel, currency FROM ao
            QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY rk) = 1) f
        ON l.order_id = f.order_id""",
    ),
    "union_items": with_(ALL_ITEMS, "SELECT * FROM ui"),
    "item_totals": with_(
        ALL_ITEMS,
        f"SELECT channel_rank, COUNT(*) AS lines, CAST(SUM(quantity) AS BIGINT) AS units, "
        f"{msum('total_amount')} AS amount FROM bo GROUP BY 1",
    ),
    "union_products": with_(
        ALL_ITEMS,
        """SELECT sku, title, unit_price AS retail_price FROM (SELECT *, row_number() OVER (
        PARTITION BY sku ORDER BY title = sku, channel_rank DESC, title,
        unit_price NULLS FIRST) AS rn FROM ui) WHERE rn = 1""",
    ),
    "upsert_orders": kept_merge(
        "'shopify' AS channel, 'USD' AS currency, 'REFUNDED' AS payment_status, "
        "0.0::DOUBLE AS total_amount"
    ),
    "upsert_items": with_(
        f"{ITEMS}, t AS ({unique_items(f'it WHERE shipped {LOADED}')}), "
        f"s AS ({unique_items(f'it WHERE shipped {BATCH}')})",
        f"SELECT * EXCLUDE (tax_amount) FROM ({merged('t', 's', 'order_item_id')})",
    ),
    "upsert_products": with_(
        f"{ITEMS}, t AS ({products(f'it WHERE shipped {LOADED}')}), "
        f"s AS ({products(f'it WHERE shipped {BATCH}')})",
        merged("t", "s", "sku"),
    ),
    "upsert_daily_revenue": with_(
        f"{ORDERS}, t AS ({daily(FIRST_LOAD)}), s AS ({daily(BATCH_LOAD)})",
        merged("t", "s", "sales_date channel"),
    ),
    "upsert_inventory": with_(
        f"{ORDERS}, {ITEMS}, t AS ({inventory('it', FIRST_LOAD)}), "
        f"s AS ({inventory('it', BATCH_LOAD)})",
        merged("t", "s", "sales_date sku"),
    ),
    "upsert_customer_360": with_(
        f"{ORDERS}, t AS ({customers(FIRST_LOAD)}), s AS ({customers(BATCH_LOAD)})",
        merged("t", "s", "customer_id"),
    ),
    "bucketed_orders": with_(LAKE, "SELECT * FROM lo"),
    "gold_increment": with_(
        LAKE,
        f"""SELECT 'daily_revenue_channel' AS mart, sales_date AS key_a, channel AS key_b,
            order_count AS n, gross_revenue AS amount,
            CAST(CAST(round(tax_collected * 100) AS BIGINT) AS VARCHAR) AS label
        FROM ({daily('lo')})
        UNION ALL SELECT 'inventory_turnover', sales_date, sku, units_sold, total_sales_amount,
            product_title FROM ({inventory('lit', 'lo')})
        UNION ALL SELECT 'customer_360', customer_id, NULL, total_orders, total_spend,
            concat_ws(',', preferred_channel, customer_email) FROM ({customers('lo')})""",
    ),
    "publish_orders": kept_merge("'shopify' AS channel, 'REFUNDED' AS payment_status"),
    "dq_orders": with_(
        ORDERS,
        report(
            "so",
            "silver.orders",
            [
                ("not_null", "order_id", _CRIT, nulls("order_id")),
                (
                    "in_set",
                    "channel",
                    _CRIT,
                    "COUNT(*) FILTER (WHERE channel NOT IN "
                    "('shopify', 'pos', 'distributor', 'amazon'))",
                ),
                ("at_least", "total_amount", _CRIT, "COUNT(*) FILTER (WHERE total_amount < 0)"),
                ("not_null", "created_at", _CRIT, nulls("created_at")),
                ("unique", "order_id", _CRIT, repeats("order_id") % "so"),
                ("not_null", "customer_email", _WARN, nulls("customer_email")),
            ],
        ),
    ),
    "dq_order_items": with_(
        ITEMS,
        report(
            "it",
            "silver.order_items",
            [
                ("not_null", "order_item_id", _CRIT, nulls("order_item_id")),
                ("not_null", "order_id", _CRIT, nulls("order_id")),
                ("not_null", "sku", _CRIT, nulls("sku")),
                ("above", "quantity", _CRIT, "COUNT(*) FILTER (WHERE quantity <= 0)"),
                ("at_least", "unit_price", _CRIT, "COUNT(*) FILTER (WHERE unit_price < 0)"),
                ("unique", "order_item_id", _CRIT, repeats("order_item_id") % "it"),
            ],
        ),
    ),
    "dq_violations": with_(
        ITEMS,
        """SELECT order_item_id, sku, total_amount, 'unique(order_item_id)' AS broken FROM it
        WHERE order_item_id IN (SELECT order_item_id FROM it GROUP BY 1 HAVING COUNT(*) > 1)""",
    ),
    "dq_order_violations": with_(
        ORDERS,
        """SELECT order_id, 'not_null(customer_email)' AS broken FROM so
        WHERE customer_email IS NULL""",
    ),
    "decode_payload": "SELECT event_id, CAST(regexp_extract(props, '\"k\": *(-?[0-9]+)', 1) AS INT) "
    "AS k FROM events",
    "contract_report": with_(
        BAD,
        """SELECT doc AS file, CASE WHEN error IN ('invalid json', 'no envelope') THEN NULL
        ELSE 0 END AS record, error FROM (SELECT doc, unnest(errors) AS error FROM bad)""",
    ),
    "contract_verdicts": with_(BAD, "SELECT * FROM ok"),
    "route_files": with_(
        BAD,
        """SELECT doc, CASE WHEN passed THEN 'clean' ELSE 'quarantined' END AS route
        FROM bad JOIN ok ON bad.file = ok.file""",
    ),
    "route_documents": with_(
        BAD,
        """SELECT doc, CASE WHEN len(errors) = 0 THEN 'clean' ELSE 'quarantined' END AS route
        FROM bad""",
    ),
    "recognised_documents": """SELECT CAST(o_orderkey AS VARCHAR) AS doc,
        o_totalprice NOT BETWEEN 21000 AND 23499.99 AS recognised FROM orders""",
    "ingest_documents": with_(BAD, """SELECT
        CASE WHEN good THEN CAST(o_orderkey AS VARCHAR) END AS id,
        CASE WHEN good THEN '#' || o_orderkey END AS name,
        CASE WHEN good THEN '2024-01-01T00:00:00Z' END AS createdAt,
        CASE WHEN good THEN 'a.b@example.com' END AS email,
        CASE WHEN good THEN 'web' END AS sourceName, CASE WHEN good THEN '1.00' END AS total,
        CASE WHEN good THEN 0 END AS lines, NOT good AS is_dead,
        CASE WHEN NOT good THEN array_to_string(errors, ',') END AS reasons,
        'drop_' || strftime(o_orderdate, '%Y-%m-%d') AS _ingest_file_name,
        CASE WHEN good THEN 'accepted' ELSE 'dead_letter' END AS route
        FROM (SELECT o.*, errors, o_totalprice >= 31000 AS good
            FROM orders o JOIN bad ON doc = CAST(o_orderkey AS VARCHAR)
            WHERE o_totalprice NOT BETWEEN 26000 AND 28499.99)"""),
    "stream_append_events": """SELECT
        CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS transaction_id,
        CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS store_id,
        CASE WHEN event_type <> 'error' THEN event_type END AS store_name,
        CASE WHEN event_type <> 'error' THEN "value" END AS total_amount,
        CASE WHEN event_type <> 'error' THEN props END AS payment_method,
        CASE WHEN event_type = 'error' THEN '{"transaction_id":"' || event_id END AS dead_payload,
        'kafka-stream' AS _ingest_file_name,
        CASE WHEN event_type = 'error' THEN 'dead_letter' ELSE 'accepted' END AS route
        FROM events""",
    "latest_features": with_(EVENT_FEATURES, "SELECT * FROM ef"),
    "lookup_features": with_(
        EVENT_FEATURES,
        """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, event_type, "value"
        FROM customer LEFT JOIN ef ON CAST(c_custkey AS VARCHAR) = ef.customer_id""",
    ),
    "customer_features": with_(
        f"{ORDERS}, c AS ({customers('so')})",
        """SELECT customer_id, customer_email, total_orders, total_spend, preferred_channel,
        TIMESTAMP '2001-07-01' AS event_timestamp, TIMESTAMP '2001-07-01' AS created_timestamp FROM c""",
    ),
    "product_features": with_(
        f"{ORDERS}, {ITEMS}, v AS ({inventory('it', 'so')})",
        f"""SELECT * FROM (SELECT sku, arg_max(product_title, (sales_date, product_title))
        AS product_title, CAST(SUM(units_sold) AS BIGINT) AS units_sold,
        {msum('total_sales_amount')} AS total_sales_amount,
        CAST(MAX(sales_date) AS TIMESTAMP) AS event_timestamp,
        TIMESTAMP '2001-07-01' AS created_timestamp FROM v GROUP BY 1)
        WHERE event_timestamp BETWEEN TIMESTAMP '2001-04-02' AND TIMESTAMP '2001-07-01'""",
    ),
}
