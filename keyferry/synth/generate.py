"""Related sample tables (customers, products, orders, order lines).

The rows are derived from the keys of existing tables, so the generator's work
grows with them and it runs fully distributed: one generated customer per
row of the ``ids`` frame, and so on. Every value is a hash of the row id
(functions/pseudo.py), so output is repeatable under any partitioning.

Rules:

* customers: ids from 1; names, e-mail (lower-case first.last@domain, not
  unique), phone 555-nnnn, street address, a matched city/state/zip triple,
  created on 2024-01-15 + (id - 1) days;
* products: ids from 101; the first ones from a fixed catalogue, then
  "Product n" with a picked category and a price from 9.99 to 999.99; stock
  10 to 500; SKU = first three letters of the name, upper-cased, and two
  numbers; created on 2024-01-01 + i days;
* orders: ids from 1001; an existing customer; status, payment method,
  shipping address, notes (one choice is empty); placed on 2024-02-01 + i days;
* order lines: 1 to min(max_items, products) *distinct* products per order,
  quantity 1 to 5, amount = round(price * quantity, 2) by a price look-up.
  The k-th product of an order is (start + k * step) mod n with
  step = 2^61 - 1 mod n; 2^61 - 1 is prime, so step and n are coprime and the
  first n values are distinct: no cross join, no retry.

Dates do not wrap unless ``span_days`` asks for wrapped offsets: they go on past
the year 9999 as far as Spark, Parquet and DuckDB count days (32 bits, the year
5881580). Python's own dates end with 9999, so a program that collects later
ones takes them as text or as days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyferry.functions.pseudo import (
    PRIME,
    between,
    between_sql,
    mix,
    mix_sql,
    mix_wide,
    mix_wide_sql,
    pick,
    pick_sql,
    sql_str,
)
from keyferry.operators.joins import lookup_join

# ---------------------------------------------------------------------------
# Our own word lists.
FIRST_NAMES = [
    "Anouk", "Bertil", "Chiara", "Dorian", "Eszter", "Farid", "Greta", "Hugo", "Ingrid", "Jarek",
    "Keiko", "Leif", "Maren", "Nils", "Odette", "Paavo", "Ronja", "Severin", "Tove", "Yusuf",
]
LAST_NAMES = [
    "Amsel", "Birkholt", "Corvino", "Dahlgren", "Eisvogel", "Falkner", "Grahl", "Hazelwood",
    "Inkster", "Jaskolka", "Kestrel", "Lerche", "Merula", "Nachtigal", "Ortolan",
    "Plover", "Rallo", "Swift", "Tanager", "Wren",
]
DOMAINS = ["example.com", "example.net", "example.org", "mail.test"]
STREETS = [
    "Astrolabe Row", "Bellfounder Street", "Canal Terrace", "Drumlin Path", "Ferry Steps",
    "Granite Close", "Lighthouse Walk", "Tollgate Square",
]
# (city, state, zip): zip codes are text, several start with 0.
PLACES = [
    ("Augusta", "ME", "04330"), ("Concord", "NH", "03301"), ("Montpelier", "VT", "05602"),
    ("Annapolis", "MD", "21401"), ("Newport", "RI", "02840"), ("Cheyenne", "WY", "82001"),
    ("Sitka", "AK", "99835"), ("Topeka", "KS", "66603"), ("Worcester", "MA", "01608"),
    ("Olympia", "WA", "98501"), ("Roswell", "NM", "88201"), ("Princeton", "NJ", "08540"),
]
COUNTRY = "USA"
# (category, product name, price): an observatory's and a pottery's shop.
CATALOGUE = [
    ("Optics", "Meridian Finder Scope", 84.5),
    ("Optics", "Red Torch", 17.25),
    ("Optics", "Barlow Lens", 61.0),
    ("Optics", "Solar Film Sheet", 27.4),
    ("Charts", "Pocket Planisphere", 13.8),
    ("Charts", "Lunar Atlas", 46.0),
    ("Charts", "Tide Almanac", 21.35),
    ("Clay", "Stoneware Block", 18.6),
    ("Clay", "Porcelain Slip", 24.75),
    ("Clay", "Raku Mix", 31.2),
    ("Glazes", "Celadon Glaze", 36.9),
    ("Glazes", "Tenmoku Glaze", 39.45),
    ("Glazes", "Ash Glaze", 33.1),
    ("Tools", "Loop Trimmer", 12.65),
    ("Tools", "Banding Wheel", 92.0),
    ("Tools", "Cone Pack", 15.95),
]
CATEGORIES = ["Optics", "Charts", "Clay", "Glazes", "Tools"]
SUPPLIERS = ["Perihelion Works", "Saltmarsh Kilns", "Umbra Instruments", "Third Tide Stores"]
DESCRIPTORS = ["handmade", "calibrated", "travel-size", "refurbished", "seasonal"]
STATUSES = ["pending", "processing", "shipped", "delivered"]
PAYMENTS = ["card", "bank_transfer", "wallet"]
NOTES = [
    "", "Courier must not stack the crate", "Keep dry", "Hold at the depot until Friday",
    "Neighbour at 12 signs", "Invoice by post", "Packed with two cold packs", "Second parcel follows",
    "Return the pallet",
]
# Start dates and first ids.
CUSTOMER_START = "2024-01-15"
PRODUCT_START = "2024-01-01"
ORDER_START = "2024-02-01"
FIRST_CUSTOMER_ID = 1
FIRST_PRODUCT_ID = 101
FIRST_ORDER_ID = 1001
MAX_ITEMS = 10
LAST_DAY = 2**31 - 2  # since 1970, 5881580-07-10: the last finite date of DuckDB, one before Spark's
# ---------------------------------------------------------------------------


def _str(c: Column) -> Column:
    return c.cast("string")


def _days(start: str, offset: Column, span: int | None = None) -> Column:
    """``start`` + ``offset`` days; NULL stays NULL. Past ``LAST_DAY`` the row is an
    error, unless ``span`` is given: then offsets wrap after that many days."""
    if span is not None:
        offset = offset % F.lit(span)
    first = F.lit(start).cast("date")
    too_late = F.raise_error(F.concat(F.lit(f"{start} plus "), offset.cast("string"), F.lit(" days is no date: give span_days")))
    return F.when(offset > F.lit(LAST_DAY) - F.unix_date(first), too_late.cast("date")).otherwise(F.date_add(first, offset.cast("int")))


def _days_sql(start: str, offset: str) -> str:
    return f"(DATE '{start}' + CAST({offset} AS INTEGER))"


def _check_count(n: int, what: str) -> None:
    if n < 1:
        raise ValueError(f"{what} must be at least 1, got {n}")


# -- G1 ----------------------------------------------------------------------
def customers(ids: DataFrame, span_days: int | None = None) -> DataFrame:
    """One customer per row of ``ids`` (column ``customer_id``)."""
    i = F.col("customer_id")
    first = pick(FIRST_NAMES, mix(i, 1))
    last = pick(LAST_NAMES, mix(i, 2))
    place = mix(i, 7) % F.lit(len(PLACES))
    return ids.select(
        i.alias("customer_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@"), pick(DOMAINS, mix(i, 3))).alias("email"),
        F.concat(F.lit("555-"), _str(between(mix(i, 4), 1000, 9999))).alias("phone"),
        F.concat(_str(between(mix(i, 5), 10, 9999)), F.lit(" "), pick(STREETS, mix(i, 6))).alias("address"),
        pick([p[0] for p in PLACES], place).alias("city"),
        pick([p[1] for p in PLACES], place).alias("state"),
        pick([p[2] for p in PLACES], place).alias("zip_code"),
        F.lit(COUNTRY).alias("country"),
        _days(CUSTOMER_START, i - F.lit(FIRST_CUSTOMER_ID), span_days).alias("created_date"),
    )


def customers_sql(ids_sql: str) -> str:
    i = "customer_id"
    first = pick_sql(FIRST_NAMES, mix_sql(i, 1))
    last = pick_sql(LAST_NAMES, mix_sql(i, 2))
    place = f"({mix_sql(i, 7)}) % {len(PLACES)}"
    return f"""SELECT {i} AS customer_id,
  {first} AS first_name,
  {last} AS last_name,
  lower({first}) || '.' || lower({last}) || '@' || {pick_sql(DOMAINS, mix_sql(i, 3))} AS email,
  '555-' || CAST({between_sql(mix_sql(i, 4), 1000, 9999)} AS VARCHAR) AS phone,
  CAST({between_sql(mix_sql(i, 5), 10, 9999)} AS VARCHAR) || ' ' || {pick_sql(STREETS, mix_sql(i, 6))} AS address,
  {pick_sql([p[0] for p in PLACES], place)} AS city,
  {pick_sql([p[1] for p in PLACES], place)} AS state,
  {pick_sql([p[2] for p in PLACES], place)} AS zip_code,
  {sql_str(COUNTRY)} AS country,
  {_days_sql(CUSTOMER_START, f"{i} - {FIRST_CUSTOMER_ID}")} AS created_date
FROM ({ids_sql}) AS ids"""


# -- G2 ----------------------------------------------------------------------
def products(ids: DataFrame, span_days: int | None = None) -> DataFrame:
    """One product per row of ``ids`` (column ``product_id``)."""
    pid = F.col("product_id")
    i = pid - F.lit(FIRST_PRODUCT_ID)
    k = len(CATALOGUE)
    in_cat = i < F.lit(k)
    idx = (F.least(i, F.lit(k - 1)) + F.lit(1)).cast("int")
    cat_name = F.element_at(F.array(*[F.lit(c[1]) for c in CATALOGUE]), idx)
    cat_cat = F.element_at(F.array(*[F.lit(c[0]) for c in CATALOGUE]), idx)
    cat_price = F.element_at(F.array(*[F.lit(float(c[2])) for c in CATALOGUE]), idx)
    name = F.when(in_cat, cat_name).otherwise(F.concat(F.lit("Product "), _str(i + F.lit(1))))
    category = F.when(in_cat, cat_cat).otherwise(pick(CATEGORIES, mix(pid, 11)))
    price = F.when(in_cat, cat_price).otherwise(between(mix(pid, 12), 999, 99999).cast("double") / F.lit(100))
    return ids.select(
        pid.alias("product_id"),
        name.alias("product_name"),
        category.alias("category"),
        F.concat(F.initcap(pick(DESCRIPTORS, mix(pid, 13))), F.lit(" "), F.lower(category), F.lit(" item")).alias(
            "description"
        ),
        price.alias("price"),
        between(mix(pid, 14), 10, 500).alias("stock_quantity"),
        pick(SUPPLIERS, mix(pid, 15)).alias("supplier"),
        F.concat(
            F.upper(F.substring(name, 1, 3)), F.lit("-"), _str(between(mix(pid, 16), 100, 999)),
            F.lit("-"), _str(between(mix(pid, 17), 10, 99)),
        ).alias("sku"),
        _days(PRODUCT_START, i, span_days).alias("created_date"),
    )


def products_sql(ids_sql: str) -> str:
    pid = "product_id"
    i = f"({pid} - {FIRST_PRODUCT_ID})"
    k = len(CATALOGUE)
    idx = f"CAST(least({i}, {k - 1}) + 1 AS INTEGER)"
    names = "[" + ", ".join(sql_str(c[1]) for c in CATALOGUE) + "]"
    cats = "[" + ", ".join(sql_str(c[0]) for c in CATALOGUE) + "]"
    prices = "CAST([" + ", ".join(repr(float(c[2])) for c in CATALOGUE) + "] AS DOUBLE[])"
    name = f"(CASE WHEN {i} < {k} THEN ({names})[{idx}] ELSE 'Product ' || CAST({i} + 1 AS VARCHAR) END)"
    category = f"(CASE WHEN {i} < {k} THEN ({cats})[{idx}] ELSE {pick_sql(CATEGORIES, mix_sql(pid, 11))} END)"
    return f"""SELECT {pid} AS product_id,
  {name} AS product_name,
  {category} AS category,
  upper(substr({pick_sql(DESCRIPTORS, mix_sql(pid, 13))}, 1, 1)) || substr({pick_sql(DESCRIPTORS, mix_sql(pid, 13))}, 2)
    || ' ' || lower({category}) || ' item' AS description,
  CASE WHEN {i} < {k} THEN ({prices})[{idx}]
       ELSE CAST({between_sql(mix_sql(pid, 12), 999, 99999)} AS DOUBLE) / 100 END AS price,
  {between_sql(mix_sql(pid, 14), 10, 500)} AS stock_quantity,
  {pick_sql(SUPPLIERS, mix_sql(pid, 15))} AS supplier,
  upper(substr({name}, 1, 3)) || '-' || CAST({between_sql(mix_sql(pid, 16), 100, 999)} AS VARCHAR)
    || '-' || CAST({between_sql(mix_sql(pid, 17), 10, 99)} AS VARCHAR) AS sku,
  {_days_sql(PRODUCT_START, i)} AS created_date
FROM ({ids_sql}) AS ids"""


# -- G3 ----------------------------------------------------------------------
def orders(ids: DataFrame, n_customers: int, span_days: int | None = None) -> DataFrame:
    """One order per row of ``ids`` (column ``order_id``); customers are
    ``FIRST_CUSTOMER_ID .. FIRST_CUSTOMER_ID + n_customers - 1``."""
    _check_count(n_customers, "customer count")
    oid = F.col("order_id")
    # City, state and zip code of one place.
    place = pick([f"{c}, {s} {z}" for c, s, z in PLACES], mix(oid, 25))
    return ids.select(
        oid.alias("order_id"),
        (F.lit(FIRST_CUSTOMER_ID) + mix_wide(oid, 21) % F.lit(n_customers)).alias("customer_id"),
        _days(ORDER_START, oid - F.lit(FIRST_ORDER_ID), span_days).alias("order_date"),
        pick(STATUSES, mix(oid, 22)).alias("status"),
        pick(PAYMENTS, mix(oid, 23)).alias("payment_method"),
        F.concat(_str(between(mix(oid, 24), 10, 9999)), F.lit(" "), pick(STREETS, mix(oid, 26)), F.lit(", "), place).alias(
            "shipping_address"
        ),
        pick(NOTES, mix(oid, 27)).alias("notes"),
    )


def orders_sql(ids_sql: str, n_customers_sql: str) -> str:
    oid = "order_id"
    place = pick_sql([f"{c}, {s} {z}" for c, s, z in PLACES], mix_sql(oid, 25))
    return f"""SELECT {oid} AS order_id,
  {FIRST_CUSTOMER_ID} + ({mix_wide_sql(oid, 21)}) % ({n_customers_sql}) AS customer_id,
  {_days_sql(ORDER_START, f"{oid} - {FIRST_ORDER_ID}")} AS order_date,
  {pick_sql(STATUSES, mix_sql(oid, 22))} AS status,
  {pick_sql(PAYMENTS, mix_sql(oid, 23))} AS payment_method,
  CAST({between_sql(mix_sql(oid, 24), 10, 9999)} AS VARCHAR) || ' ' || {pick_sql(STREETS, mix_sql(oid, 26))}
    || ', ' || {place} AS shipping_address,
  {pick_sql(NOTES, mix_sql(oid, 27))} AS notes
FROM ({ids_sql}) AS ids"""


# -- G4 ----------------------------------------------------------------------
def order_lines(orders_df: DataFrame, products_df: DataFrame, n_products: int, max_items: int = MAX_ITEMS) -> DataFrame:
    """Lines of every order: distinct products, quantity 1-5, amount via J1."""
    _check_count(n_products, "product count")
    _check_count(max_items, "max items per order")
    oid = F.col("order_id")
    m = F.lit(1) + mix(oid, 31) % F.lit(min(max_items, n_products))
    start = mix_wide(oid, 32) % F.lit(n_products)
    step = PRIME % n_products
    # Drawn once per order, before there is a row per line.
    drawn = orders_df.select(oid, start.alias("start"), m.alias("m"))
    lines = drawn.select(oid, "start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - F.lit(1))).alias("k")).select(
        oid,
        (F.lit(FIRST_PRODUCT_ID) + (F.col("start") + F.col("k") * F.lit(step)) % F.lit(n_products)).alias("product_id"),
        between(mix(F.concat(oid.cast("string"), F.lit("-"), F.col("k").cast("string")), 33), 1, 5).alias("quantity"),
    )
    priced = lookup_join(lines, products_df.select("product_id", "price"), "product_id")
    return priced.select(
        "order_id", "product_id", "quantity", F.round(F.col("price") * F.col("quantity"), 2).alias("amount")
    )


def order_lines_sql(orders_sql_text: str, products_sql_text: str, n_products_sql: str, max_items: int = MAX_ITEMS) -> str:
    oid = "o.order_id"
    n = f"({n_products_sql})"
    m = f"(1 + ({mix_sql(oid, 31)}) % least({max_items}, {n}))"
    start = f"(({mix_wide_sql(oid, 32)}) % {n})"
    step = f"({PRIME} % {n})"
    return f"""WITH o AS ({orders_sql_text}),
p AS ({products_sql_text}),
l AS (
  SELECT {oid} AS order_id,
         {FIRST_PRODUCT_ID} + ({start} + k * {step}) % {n} AS product_id,
         {between_sql(mix_sql(f"{oid} || '-' || k", 33), 1, 5)} AS quantity
  FROM o, LATERAL (SELECT unnest(range(0, {m})) AS k) AS ks
)
SELECT l.order_id, l.product_id, l.quantity, round(p.price * l.quantity, 2) AS amount
FROM l JOIN p ON l.product_id = p.product_id"""
