"""SQL twin of each registered query, for DuckDB over the benchmark tables.

A twin is the tail of a chain of common table expressions that derives the same stand-in
trips and then the layers; `chain` puts the needed part of the chain in front.
"""

from __future__ import annotations

from fareline import words as W
from fareline.operators.quality import declared
from fareline.schemas import PAYMENT_TYPES, RATE_CODES, VENDORS

SOURCE, ENGLISH = W.SOURCE, W.ENGLISH


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_quoted(i) for i in items) + "]"


def _values(rows) -> str:
    return ", ".join(f"({code}, {_quoted(name)})" for code, name in rows)


MONEY = "DECIMAL(18,2)"
KEY = "vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, pulocationid, dolocationid"
TRIP_COLUMNS = (
    "vendorid, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, ratecodeid, "
    "store_and_fwd_flag, pulocationid, dolocationid, payment_type, fare_amount, extra, mta_tax, tip_amount, "
    "tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee, cbd_congestion_fee"
)
KEPT_FIRST = """total_amount DESC NULLS FIRST, _loaded_at DESC NULLS FIRST, _source_file NULLS LAST,
    passenger_count NULLS LAST, trip_distance_miles NULLS LAST, rate_code_id NULLS LAST,
    is_store_and_forward NULLS LAST, payment_type_id NULLS LAST, fare_amount NULLS LAST,
    extra_amount NULLS LAST, mta_tax_amount NULLS LAST, tip_amount NULLS LAST, tolls_amount NULLS LAST,
    improvement_surcharge_amount NULLS LAST, congestion_surcharge_amount NULLS LAST,
    airport_fee_amount NULLS LAST, cbd_congestion_fee_amount NULLS LAST,
    pickup_datetime NULLS LAST, dropoff_datetime NULLS LAST, vendor_id NULLS LAST,
    pickup_location_id NULLS LAST, dropoff_location_id NULLS LAST, _source_period NULLS LAST"""
TYPED_COLUMNS = (
    "vendor_id, pickup_datetime, dropoff_datetime, duration_seconds, passenger_count, trip_distance_miles, "
    "rate_code_id, is_store_and_forward, pickup_location_id, dropoff_location_id, payment_type_id, fare_amount, "
    "extra_amount, mta_tax_amount, tip_amount, tolls_amount, improvement_surcharge_amount, "
    "congestion_surcharge_amount, airport_fee_amount, cbd_congestion_fee_amount, total_amount"
)


def _broken_rule(words: W.Words) -> str:
    arms = [
        "total_amount < 0",
        "fare_amount < 0",
        "dropoff_datetime < pickup_datetime",
        "duration_seconds > 86400",
        "CAST(date_trunc('month', pickup_datetime) AS DATE) <> _source_period",
        "duration_seconds = 0 AND trip_distance_miles = 0",
        "trip_distance_miles > 200",
        "total_amount > 1000",
    ]
    lines = " ".join(f"WHEN {arm} THEN {_quoted(r)}" for arm, r in zip(arms, words.reasons))
    return f"CASE {lines} END"


def _steps(words: W.Words, typed_from: str = "bronze") -> dict[str, str]:
    steps = {
        "src": """
            SELECT l.*, s.sgn FROM lineitem l, (VALUES (1, 0), (1, 7), (1, 8), (-1, 8)) s(sgn, r)
            WHERE (s.r = 0 AND l.l_partkey % 499 NOT IN (7, 8)) OR (s.r = 8 AND l.l_partkey % 499 = 8)
               OR (s.r = 7 AND l.l_partkey % 499 = 7) OR (s.r = 0 AND l.l_partkey % 499 = 7)""",
        "base": """
            SELECT l_orderkey * 7 + l_linenumber AS h, CAST(round(l_extendedprice) AS BIGINT) AS cents,
                   l_partkey AS part, l_quantity AS qty, sgn, o_orderdate,
                   (l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity < 10) AS neg,
                   CAST(date_trunc('month', o_orderdate
                        + CASE WHEN l_partkey % 211 = 0 THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END) AS DATE) AS file_month,
                   o_orderdate + to_seconds(((l_orderkey * 7 + l_linenumber) * 97) % 86400) AS pickup
            FROM src JOIN orders ON l_orderkey = o_orderkey""",
        "raw": """
            SELECT CAST([1, 2, 6, 7][h % 4 + 1] AS BIGINT) AS vendorid,
                   pickup AS tpep_pickup_datetime,
                   pickup + to_seconds(CASE WHEN h % 97 = 0 THEN 0 WHEN h % 101 = 0 THEN -60
                                            WHEN h % 499 = 0 THEN 90000 ELSE 60 + (h * 13) % 5400 END) AS tpep_dropoff_datetime,
                   CASE WHEN h % 5 <> 0 THEN h % 9 END AS passenger_count,
                   CAST(CASE WHEN h % 61 = 0 OR h % 194 = 0 THEN 0 WHEN h % 997 = 0 THEN 25000
                             ELSE part % 2000 + 1 END AS DOUBLE) / 100.0 AS trip_distance,
                   CAST(CASE WHEN h % 5 = 0 THEN NULL WHEN h % 7 = 0 THEN 99 ELSE h % 6 + 1 END AS BIGINT) AS ratecodeid,
                   CASE WHEN h % 5 = 0 THEN NULL WHEN h % 3 = 0 THEN 'Y' ELSE ' n ' END AS store_and_fwd_flag,
                   h % 265 + 1 AS pulocationid, (h * 3) % 265 + 1 AS dolocationid,
                   CAST(CASE WHEN h % 5 = 0 THEN 0 ELSE h % 4 + 1 END AS BIGINT) AS payment_type,
                   CAST(sgn * CASE WHEN neg OR qty = 50 THEN -1 ELSE 1 END * (cents // 2) AS DOUBLE) / 100.0 AS fare_amount,
                   CAST((h % 4) * 50 AS DOUBLE) / 100.0 AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
                   CAST(CASE WHEN h % 5 <> 0 AND h % 4 = 0 THEN cents // 10 ELSE 0 END AS DOUBLE) / 100.0 AS tip_amount,
                   CAST(CASE WHEN h % 20 = 1 THEN 6.94 ELSE 0 END AS DOUBLE) AS tolls_amount,
                   CAST(1.0 AS DOUBLE) AS improvement_surcharge,
                   CAST(sgn * CASE WHEN neg THEN -1 ELSE 1 END * cents AS DOUBLE) / 100.0 AS total_amount,
                   CASE WHEN h % 5 <> 0 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
                   CAST(CASE WHEN h % 5 = 0 THEN NULL WHEN h % 11 = 0 THEN 1.75 ELSE 0 END AS DOUBLE) AS airport_fee,
                   CAST(0.75 AS DOUBLE) AS cbd_congestion_fee,
                   'trips_' || strftime(file_month, '%Y-%m') || '.parquet' AS _source_file,
                   CAST(file_month + 35 AS TIMESTAMP) AS _file_last_modified,
                   CAST(file_month + 40 AS TIMESTAMP) AS _loaded_at
            FROM base""",
        "bronze": """
            SELECT *, CAST(regexp_extract(_source_file, '\\d{4}-\\d{2}') || '-01' AS DATE) AS _source_period FROM raw""",
        "ties": """
            SELECT * FROM bronze
            UNION ALL SELECT * REPLACE (tpep_pickup_datetime + INTERVAL 200 MILLISECOND AS tpep_pickup_datetime,
                                        tpep_dropoff_datetime + INTERVAL 200 MILLISECOND AS tpep_dropoff_datetime)
            FROM bronze WHERE pulocationid % 7 = 0
            UNION ALL SELECT * REPLACE (NULL::BIGINT AS vendorid) FROM bronze WHERE pulocationid % 11 = 0
            UNION ALL SELECT * REPLACE (NULL::BIGINT AS vendorid,
                                        tpep_pickup_datetime + INTERVAL 3 HOUR AS tpep_pickup_datetime,
                                        tpep_dropoff_datetime + INTERVAL 3 HOUR AS tpep_dropoff_datetime)
            FROM bronze WHERE pulocationid % 11 = 0""",
        "zones": """
            SELECT id AS locationid,
                   CASE id WHEN 265 THEN '' WHEN 264 THEN ' ' ELSE r_name END AS borough,
                   CASE WHEN id = 265 THEN '' WHEN id = 264 THEN NULL ELSE ' Zone ' || id END AS zone,
                   CASE WHEN id >= 264 THEN '' WHEN id % 40 = 0 THEN 'Airports' WHEN id = 1 THEN 'EWR'
                        WHEN id % 2 = 0 THEN 'Boro Zone' ELSE 'Yellow Zone' END AS service_zone,
                   'taxi_zone_lookup.csv' AS _source_file
            FROM range(1, 266) g(id) JOIN region ON r_regionkey = id % 5""",
        "typed": f"""
            SELECT CAST(vendorid AS INTEGER) AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
                   tpep_dropoff_datetime AS dropoff_datetime,
                   date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS duration_seconds,
                   CAST(passenger_count AS INTEGER) AS passenger_count,
                   CAST(trip_distance AS {MONEY}) AS trip_distance_miles, CAST(ratecodeid AS INTEGER) AS rate_code_id,
                   CASE upper(trim(store_and_fwd_flag)) WHEN 'Y' THEN true WHEN 'N' THEN false END AS is_store_and_forward,
                   CAST(pulocationid AS INTEGER) AS pickup_location_id, CAST(dolocationid AS INTEGER) AS dropoff_location_id,
                   CAST(payment_type AS INTEGER) AS payment_type_id, CAST(fare_amount AS {MONEY}) AS fare_amount,
                   CAST(extra AS {MONEY}) AS extra_amount, CAST(mta_tax AS {MONEY}) AS mta_tax_amount,
                   CAST(tip_amount AS {MONEY}) AS tip_amount, CAST(tolls_amount AS {MONEY}) AS tolls_amount,
                   CAST(improvement_surcharge AS {MONEY}) AS improvement_surcharge_amount,
                   CAST(congestion_surcharge AS {MONEY}) AS congestion_surcharge_amount,
                   CAST(airport_fee AS {MONEY}) AS airport_fee_amount,
                   CAST(cbd_congestion_fee AS {MONEY}) AS cbd_congestion_fee_amount,
                   CAST(total_amount AS {MONEY}) AS total_amount, _source_file, _source_period, _loaded_at
            FROM {typed_from}""",
        "ruled": f"""
            SELECT *, md5(vendor_id || '|' || strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') || '|'
                          || strftime(dropoff_datetime, '%Y-%m-%d %H:%M:%S') || '|'
                          || pickup_location_id || '|' || dropoff_location_id) AS trip_id,
                   {_broken_rule(words)} AS broken_rule
            FROM typed""",
        "ranked": f"""
            SELECT *, row_number() OVER (PARTITION BY trip_id, broken_rule IS NULL ORDER BY {KEPT_FIRST}) AS dedup_rank,
                   bool_or(coalesce(total_amount < 0, false)) OVER (PARTITION BY trip_id) AS has_reversal
            FROM ruled""",
        "evaluated": f"""
            SELECT trip_id, {TYPED_COLUMNS}, has_reversal,
                   coalesce(broken_rule, CASE WHEN dedup_rank > 1 THEN {_quoted(words.duplicate)} END) AS rejection_reason,
                   _source_file, _source_period, _loaded_at
            FROM ranked""",
        "trips": f"""
            SELECT * EXCLUDE (rejection_reason, duration_seconds) REPLACE (
                       CASE WHEN passenger_count >= 1 AND passenger_count <= 6 THEN passenger_count END AS passenger_count,
                       CASE WHEN trip_distance_miles <> 0 THEN trip_distance_miles END AS trip_distance_miles,
                       ifnull(rate_code_id, 99) AS rate_code_id),
                   CASE WHEN duration_seconds > 0 THEN CAST((duration_seconds * 200 + 60) // 120 AS {MONEY}) / 100 END AS minutes_raw
            FROM evaluated WHERE rejection_reason IS NULL""",
        "silver": f"""
            SELECT * EXCLUDE (minutes_raw), CAST(minutes_raw AS {MONEY}) AS trip_duration_minutes FROM trips""",
        "szones": """
            SELECT CAST(locationid AS INTEGER) AS location_id,
                   CASE WHEN trim(coalesce(borough, '')) <> '' THEN trim(borough)
                        WHEN locationid = 265 THEN 'Outside of NYC' ELSE 'Unknown' END AS borough,
                   CASE WHEN trim(coalesce(zone, '')) <> '' THEN trim(zone)
                        WHEN locationid = 265 THEN 'Outside of NYC' ELSE 'Unknown' END AS zone_name,
                   CASE WHEN trim(coalesce(service_zone, '')) <> '' THEN trim(service_zone) ELSE 'N/A' END AS service_zone,
                   locationid <> 264 AND locationid <> 265 AS is_identified_zone
            FROM zones""",
        "fact": """
            SELECT trip_id,
                   CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS pickup_date_key,
                   CAST(date_part('hour', pickup_datetime) AS INTEGER) AS pickup_time_key,
                   CAST(strftime(dropoff_datetime, '%Y%m%d') AS INTEGER) AS dropoff_date_key,
                   CAST(date_part('hour', dropoff_datetime) AS INTEGER) AS dropoff_time_key,
                   pickup_location_id AS pickup_zone_key, dropoff_location_id AS dropoff_zone_key,
                   vendor_id AS vendor_key, rate_code_id AS rate_code_key, payment_type_id AS payment_type_key,
                   pickup_datetime, dropoff_datetime, is_store_and_forward, has_reversal, passenger_count,
                   trip_distance_miles, trip_duration_minutes, fare_amount, extra_amount, mta_tax_amount, tip_amount,
                   tolls_amount, improvement_surcharge_amount, congestion_surcharge_amount, airport_fee_amount,
                   cbd_congestion_fee_amount, total_amount, _source_file, _source_period
            FROM silver""",
        "dates": f"""
            SELECT CAST(strftime(x, '%Y%m%d') AS INTEGER) AS date_key, CAST(x AS DATE) AS full_date,
                   CAST(date_part('year', x) AS INTEGER) AS year, CAST(date_part('quarter', x) AS INTEGER) AS quarter,
                   CAST(date_part('month', x) AS INTEGER) AS month,
                   {_list(words.months)}[date_part('month', x)] AS month_name, strftime(x, '%Y-%m') AS year_month,
                   CAST(date_part('day', x) AS INTEGER) AS day_of_month,
                   CAST(date_part('isodow', x) AS INTEGER) AS day_of_week,
                   {_list(words.weekdays)}[date_part('isodow', x)] AS day_name,
                   CAST(date_part('week', x) AS INTEGER) AS iso_week, date_part('isodow', x) > 5 AS is_weekend
            FROM (SELECT unnest(generate_series(date_trunc('day', min(pickup_datetime)),
                                                date_trunc('day', max(dropoff_datetime)), INTERVAL 1 DAY)) AS x FROM silver)""",
        "times": f"""
            SELECT CAST(h AS INTEGER) AS time_key, CAST(h AS INTEGER) AS hour_of_day,
                   printf('%02d:00', h) AS hour_label, {_list(words.day_periods)}[h // 6 + 1] AS day_period
            FROM range(24) g(h)""",
        "dzones": """
            SELECT location_id AS zone_key, borough, zone_name, service_zone,
                   service_zone = 'Airports' OR service_zone = 'EWR' AS is_airport, is_identified_zone
            FROM szones""",
        "vendors": f"SELECT * FROM (VALUES {_values(VENDORS)}) v(vendor_key, vendor_name)",
        "rates": f"""
            SELECT *, rate_code_key BETWEEN 2 AND 3 AS is_airport_rate
            FROM (VALUES {_values(RATE_CODES)}) v(rate_code_key, rate_code_name)""",
        "payments": f"""
            SELECT *, {_list(words.payment_groups)}[least(payment_type_key, 3) + 1] AS payment_group
            FROM (VALUES {_values(PAYMENT_TYPES)}) v(payment_type_key, payment_type_name)""",
        "files": """
            SELECT _source_file AS source_file, _source_period AS period, count(*) AS n, date_part('month', _source_period) AS m
            FROM bronze GROUP BY ALL""",
        "ledger": """
            SELECT source_file, 'LOADED' AS status, n AS rows_loaded, 'ok' AS message, period + 41 AS done, n * 100 AS size FROM files
            UNION ALL SELECT source_file, 'LOADED', n - 1, 'ok', period + 31, n * 100 FROM files WHERE m % 2 = 0
            UNION ALL SELECT source_file, 'FAILED', NULL, repeat('x', 1200), period + 51, n * 100 FROM files WHERE m % 5 = 0""",
        "verdicts": """
            SELECT source_period, 'trips_' || strftime(source_period, '%Y-%m') || '.parquet' AS source_file,
                   CAST(n * 100 + CASE WHEN m = 3 THEN 1 ELSE 0 END AS BIGINT) AS size_bytes,
                   CASE WHEN n IS NULL AND source_period >= DATE '2001-08-01' THEN 'NOT_AVAILABLE'
                        WHEN n IS NULL THEN 'FAILED' WHEN m IN (3, 6) THEN 'LOAD' ELSE 'SKIPPED' END AS verdict,
                   CAST(CASE WHEN m NOT IN (3, 6) THEN n END AS BIGINT) AS rows_loaded, n
            FROM (SELECT CAST(unnest(generate_series(DATE '1994-11-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS source_period)
            LEFT JOIN files ON period = source_period""",
        "faulty": """
            SELECT * REPLACE (
                CASE WHEN pickup_location_id % 50 <> 7 THEN trip_id END AS trip_id,
                CASE WHEN pickup_location_id % 60 = 9 THEN 5 ELSE vendor_id END AS vendor_id,
                CASE WHEN pickup_location_id % 90 = 11 THEN -trip_distance_miles ELSE trip_distance_miles END AS trip_distance_miles,
                CASE WHEN pickup_location_id % 70 <> 13 THEN payment_type_id END AS payment_type_id)
            FROM silver""",
        "broken": """
            SELECT * FROM faulty UNION ALL SELECT * FROM faulty WHERE pickup_location_id % 80 = 17""",
        "target": """
            SELECT * FROM bronze WHERE _loaded_at <= TIMESTAMP '2001-01-01' AND vendorid <> 7""",
    }
    steps["bfact"] = steps["fact"].replace("FROM silver", "FROM broken")
    return steps


# Steps each step reads from.
NEEDS = {
    "base": ["src"], "raw": ["base"], "bronze": ["raw"], "ties": ["bronze"], "ruled": ["typed"],
    "ranked": ["ruled"], "evaluated": ["ranked"], "trips": ["evaluated"], "silver": ["trips"],
    "szones": ["zones"], "fact": ["silver"], "dates": ["silver"], "dzones": ["szones"],
    "files": ["bronze"], "ledger": ["files"], "verdicts": ["files"], "faulty": ["silver"],
    "broken": ["faulty"], "bfact": ["broken"], "target": ["bronze"],
}


def chain(needed: str, body: str, words: W.Words = SOURCE, typed_from: str = "bronze") -> str:
    """`typed_from` names the step that the typed rows come from."""
    steps = _steps(words, typed_from)
    wanted: set[str] = set()

    def add(name: str) -> None:
        for other in [typed_from] if name == "typed" else NEEDS.get(name, []):
            add(other)
        wanted.add(name)

    for name in needed.split():
        add(name)
    used = [f"{name} AS ({sql})" for name, sql in steps.items() if name in wanted]
    return f"WITH {', '.join(used)} {body}"


def _with_trips(dimension: str, key: str, table: str, table_key: str, columns: str = "d.*") -> str:
    return f"""SELECT {columns}, coalesce(c.n, 0) AS trips FROM {dimension} d
        LEFT JOIN (SELECT {table_key} AS k, count(*) AS n FROM {table} GROUP BY 1) c ON c.k = d.{key}"""


def _half_up(top: str, bottom: str, digits: int) -> str:
    """Exactly rounded quotient of two integers, the lower one positive."""
    scaled = f"(2 * abs({top}) * {10 ** digits} + {bottom}) // (2 * {bottom})"
    return f"CAST(sign({top}) * CAST({scaled} AS BIGINT) AS DECIMAL(18,0)) / {10 ** digits}"


def _cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


def _median_money(column: str, where: str = "true") -> str:
    cents = f"median(CAST(round({column} * 100) AS BIGINT)) FILTER (WHERE {where})"
    return f"CAST(CAST(sign({cents}) * floor(abs({cents}) + 0.5) AS BIGINT) / 100.0 AS {MONEY})"


def _per_file(table: str) -> str:
    return f"""SELECT _source_file, count(*) AS rows, CAST(sum(CAST(total_amount AS {MONEY})) AS DECIMAL(38,2)) AS total
        FROM {table} GROUP BY 1"""


def _ratio(top: str, bottom: str, factor: int) -> str:
    both = f"FILTER (WHERE {top} IS NOT NULL AND {bottom} IS NOT NULL)"
    upper = f"(sum({_cents(top)}) {both} * {factor})"
    lower = f"nullif(sum({_cents(bottom)}) {both}, 0)"
    return f"CAST({_half_up(upper, lower, 4)} AS DECIMAL(18,4))"


MEASURES = (
    "trip_distance_miles trip_duration_minutes fare_amount extra_amount mta_tax_amount tip_amount tolls_amount "
    "improvement_surcharge_amount congestion_surcharge_amount airport_fee_amount cbd_congestion_fee_amount total_amount"
).split()


def _additive(by: str) -> str:
    sums = ", ".join(f"CAST(sum({m}) AS DECIMAL(38,2)) AS {m}" for m in MEASURES)
    return f"""SELECT {by}, count(*) AS trips, CAST(sum(passenger_count) AS BIGINT) AS passenger_count, {sums}
        FROM fact GROUP BY ALL"""


def _net(by: str) -> str:
    return f"""SELECT {by}, count(*) AS trips, CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue
        FROM fact WHERE has_reversal = false GROUP BY ALL"""


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _completeness() -> str:
    def n(test: str, name: str) -> str:
        return f"count(*) FILTER (WHERE {test}) AS {name}"

    p, q = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    single = [
        "vendorid", "passenger_count", "ratecodeid", "store_and_fwd_flag", "payment_type",
        "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    ]
    out = ["count(*) AS total_rows"] + [n(f"{c} IS NULL", f"null_{c}") for c in single]
    out += [
        n(f"({p} IS NULL) OR ({q} IS NULL)", "null_times"),
        n("(pulocationid IS NULL) OR (dolocationid IS NULL)", "null_locations"),
        n(f"{p} > {q}", "dropoff_before_pickup"),
        n(f"{p} = {q}", "zero_duration"),
        n(f"date_diff('minute', {p}, {q}) > 1440", "over_24h"),
        n(f"strftime({p}, '%Y-%m') <> strftime(_source_period, '%Y-%m')", "outside_file_month"),
        n("trip_distance < 0", "negative_distance"), n("trip_distance = 0", "zero_distance"),
        n("trip_distance > 200", "distance_over_200"), n("fare_amount < 0", "negative_fare"),
        n("total_amount < 0", "negative_total"), n("total_amount = 0", "zero_total"),
        n("total_amount > 1000", "total_over_1000"), n("passenger_count = 0", "zero_passengers"),
        n("passenger_count > 6", "passengers_over_6"),
    ]
    return f"SELECT {', '.join(out)} FROM bronze"


def _categories() -> str:
    columns = ["vendorid", "ratecodeid", "payment_type", "store_and_fwd_flag", "passenger_count"]
    return _union(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS rows,
            count(*) FILTER (WHERE total_amount < 0) AS negative_total_rows FROM bronze GROUP BY {c}"""
        for c in columns
    )


def _duplicates() -> str:
    exact, by_key, across = SOURCE.duplicate_kinds
    keys = f"""(SELECT count(*) AS n, count(DISTINCT _source_file) AS f FROM bronze GROUP BY {KEY} HAVING count(*) > 1)"""
    return _union(
        [
            f"""SELECT '{exact}' AS kind, count(*) AS groups, CAST(sum(n - 1) AS BIGINT) AS surplus_rows
                FROM (SELECT count(*) AS n FROM bronze GROUP BY {TRIP_COLUMNS} HAVING count(*) > 1)""",
            f"SELECT '{by_key}', count(*), CAST(sum(n - 1) AS BIGINT) FROM {keys}",
            f"SELECT '{across}', count(*), CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM {keys} WHERE f > 1",
        ]
    )


def _patterns() -> str:
    pair, negative, same, different, other = SOURCE.duplicate_patterns
    return f"""SELECT pattern, count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows FROM (
        SELECT count(*) AS n, count(*) FILTER (WHERE total_amount < 0) AS neg, count(DISTINCT total_amount) AS amounts,
               sum(total_amount) AS balance,
               CASE WHEN n = 2 AND neg = 1 AND balance BETWEEN -0.009 AND 0.009 THEN '{pair}'
                    WHEN neg = n THEN '{negative}' WHEN neg > 0 THEN '{other}'
                    WHEN amounts = 1 THEN '{same}' ELSE '{different}' END AS pattern
        FROM bronze GROUP BY {KEY} HAVING count(*) > 1) GROUP BY pattern"""


# The gate on clean layers: one line per check, all of them without offenders except the
# references of the stand-in trips, which use every code.
def _gate() -> str:
    lines: list[str] = []

    def nulls(table: str, name: str, columns: str) -> None:
        for c in columns.split():
            lines.append(f"SELECT '{name}.not_null.{c}' AS \"check\", count(*) AS offenders FROM {table} WHERE {c} IS NULL")

    def repeats(table: str, name: str, columns: str) -> None:
        for c in columns.split():
            lines.append(f"SELECT '{name}.unique.{c}', count({c}) - count(DISTINCT {c}) FROM {table}")

    def orphans(table: str, name: str, column: str, parent: str, key: str) -> None:
        lines.append(
            f"SELECT '{name}.references.{column}', count(*) FROM {table} "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent})"
        )

    nulls("raw", "yellow_trips", "_source_file _loaded_at")
    nulls("zones", "taxi_zones", "locationid")
    repeats("zones", "taxi_zones", "locationid")
    nulls("bronze", "bronze_yellow_trips", "_source_file _source_period _loaded_at")
    lines.append("SELECT 'bronze_yellow_trips.not_null._bronze_loaded_at', 0")
    nulls("zones", "bronze_taxi_zones", "locationid _source_file")
    lines.append("SELECT 'bronze_taxi_zones.not_null._loaded_at', 0")
    repeats("zones", "bronze_taxi_zones", "locationid")
    for table, name, key, label in (
        ("vendors", "ref_vendors", "vendor", "vendor_name"), ("rates", "ref_rate_codes", "rate_code", "rate_code_name"),
        ("payments", "ref_payment_types", "payment_type", "payment_type_name"),
    ):
        lines.append(f"SELECT '{name}.not_null.{key}_id', count(*) FROM {table} WHERE {key}_key IS NULL")
        lines.append(f"SELECT '{name}.not_null.{label}', count(*) FROM {table} WHERE {label} IS NULL")
        lines.append(f"SELECT '{name}.unique.{key}_id', count(*) - count(DISTINCT {key}_key) FROM {table}")
    nulls("evaluated", "silver_yellow_trips_evaluated", "trip_id")
    reasons = ", ".join(_quoted(r) for r in SOURCE.reasons)
    lines.append(
        f"SELECT 'silver_yellow_trips_evaluated.accepted.rejection_reason', count(*) FROM evaluated WHERE rejection_reason NOT IN ({reasons})"
    )
    lines.append(
        "SELECT 'silver_yellow_trips_rejected.not_null.rejection_reason', count(*) FROM evaluated WHERE rejection_reason IS NOT NULL AND rejection_reason = ''"
    )
    nulls(
        "silver", "silver_yellow_trips",
        "trip_id pickup_datetime dropoff_datetime vendor_id rate_code_id pickup_location_id dropoff_location_id "
        "payment_type_id total_amount has_reversal",
    )
    repeats("silver", "silver_yellow_trips", "trip_id")
    name = "silver_yellow_trips"
    orphans("silver", name, "vendor_id", "vendors", "vendor_key")
    orphans("silver", name, "rate_code_id", "rates", "rate_code_key")
    orphans("silver", name, "pickup_location_id", "szones", "location_id")
    orphans("silver", name, "dropoff_location_id", "szones", "location_id")
    orphans("silver", name, "payment_type_id", "payments", "payment_type_key")
    lines.append(f"SELECT 'silver_rules', count(*) FROM silver WHERE {SILVER_RULE}")
    nulls("szones", "silver_taxi_zones", "location_id borough zone_name service_zone")
    repeats("szones", "silver_taxi_zones", "location_id")
    nulls(
        "fact", "fct_trips",
        "trip_id pickup_date_key pickup_time_key dropoff_date_key dropoff_time_key pickup_zone_key dropoff_zone_key "
        "vendor_key rate_code_key payment_type_key total_amount",
    )
    repeats("fact", "fct_trips", "trip_id")
    for role in ("pickup", "dropoff"):
        orphans("fact", "fct_trips", f"{role}_date_key", "dates", "date_key")
        orphans("fact", "fct_trips", f"{role}_time_key", "times", "time_key")
        orphans("fact", "fct_trips", f"{role}_zone_key", "dzones", "zone_key")
    orphans("fact", "fct_trips", "vendor_key", "vendors", "vendor_key")
    orphans("fact", "fct_trips", "rate_code_key", "rates", "rate_code_key")
    orphans("fact", "fct_trips", "payment_type_key", "payments", "payment_type_key")
    nulls("dates", "dim_date", "date_key full_date")
    repeats("dates", "dim_date", "date_key full_date")
    nulls("times", "dim_time", "time_key day_period")
    repeats("times", "dim_time", "time_key")
    nulls("dzones", "dim_zone", "zone_key borough zone_name")
    repeats("dzones", "dim_zone", "zone_key")
    for table, name, key in (
        ("vendors", "dim_vendor", "vendor_key"), ("rates", "dim_rate_code", "rate_code_key"),
        ("payments", "dim_payment_type", "payment_type_key"),
    ):
        nulls(table, name, key)
        repeats(table, name, key)
    lines.append("SELECT 'raw_equals_bronze', abs((SELECT count(*) FROM raw) - (SELECT count(*) FROM bronze))")
    lines.append(
        "SELECT 'bronze_equals_silver_and_rejected', abs((SELECT count(*) FROM bronze) - (SELECT count(*) FROM silver) "
        "- (SELECT count(*) FROM evaluated WHERE rejection_reason IS NOT NULL))"
    )
    lines.append("SELECT 'silver_equals_gold', abs((SELECT count(*) FROM silver) - (SELECT count(*) FROM fact))")
    return _union(lines)


SILVER_RULE = """NOT (total_amount BETWEEN 0 AND 1000) OR fare_amount < 0 OR dropoff_datetime < pickup_datetime
    OR date_diff('second', pickup_datetime, dropoff_datetime) > 86400
    OR strftime(pickup_datetime, '%Y-%m') <> strftime(_source_period, '%Y-%m')
    OR NOT (trip_distance_miles > 0 AND trip_distance_miles <= 200) OR trip_duration_minutes <= 0
    OR passenger_count < 1 OR passenger_count > 6"""

MAY = "(SELECT * FROM fact WHERE strftime(pickup_datetime, '%Y-%m') = '1996-05') fact"
STAR = f"""SELECT borough, day_period, count(*) AS trips, CAST(sum(total_amount) AS DECIMAL(38,2)) AS revenue,
        CAST({_half_up(f"sum({_cents('trip_distance_miles')})", "nullif(count(trip_distance_miles), 0) * 100", 2)} AS {MONEY}) AS mean_miles
    FROM fact, dzones z, times t, dates d
    WHERE pickup_zone_key = z.zone_key AND pickup_time_key = t.time_key AND pickup_date_key = d.date_key
      AND d.is_weekend = false AND has_reversal = false
    GROUP BY borough, day_period"""


def _orphan_line(column: str, parent: str, key: str) -> str:
    return f"""SELECT 'silver_yellow_trips.references.{column}' AS "check", count(*) AS offenders FROM broken b
        WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = b.{column})"""


def _damaged_tables() -> dict[str, str]:
    """Every table of the layers, with the faults the query puts in."""

    def unless(condition: str, column: str) -> str:
        return f"CASE WHEN NOT coalesce({condition}, false) THEN {column} END AS {column}"

    def twice(table: str, key: str, condition: str, *replaced: str) -> str:
        rows = f"(SELECT * FROM {table} UNION ALL SELECT * FROM {table} WHERE {condition})"
        return f"(SELECT * REPLACE ({', '.join(replaced)}) FROM {rows})"

    zones = twice("zones", "locationid", "locationid % 40 = 1", unless("locationid % 53 = 0", "locationid"))
    found = {
        "yellow_trips": f"(SELECT * REPLACE ({unless('pulocationid % 50 = 7', '_loaded_at')}, {unless('pulocationid % 61 = 5', '_source_file')}) FROM raw)",
        "taxi_zones": zones, "bronze_taxi_zones": f"(SELECT *, 1 AS _loaded_at FROM {zones})",
        "bronze_yellow_trips": f"""(SELECT * REPLACE ({unless('pulocationid % 50 = 7', '_source_period')}),
            CASE WHEN NOT coalesce(pulocationid % 61 = 5, false) THEN 1 END AS _bronze_loaded_at
            FROM bronze WHERE vendorid <> 7 OR date_part('year', _source_period) <> 1996)""",
        "silver_yellow_trips_evaluated": f"""(SELECT * REPLACE ({unless('pickup_location_id % 47 = 3', 'trip_id')},
            CASE WHEN rejection_reason = {_quoted(SOURCE.no_movement)} THEN 'unheard of' ELSE rejection_reason END AS rejection_reason) FROM evaluated)""",
        "silver_yellow_trips": "broken",
        "silver_taxi_zones": twice(
            "(SELECT * FROM szones WHERE location_id % 53 <> 0)", "location_id", "location_id % 40 = 1",
            unless("location_id % 45 = 2", "borough")),
        "fct_trips": f"""(SELECT * REPLACE (
            CASE WHEN pickup_zone_key % 90 = 11 THEN 77 ELSE pickup_time_key END AS pickup_time_key,
            {unless('pickup_zone_key % 71 = 4', 'dropoff_date_key')}, {unless('pickup_zone_key % 67 = 6', 'total_amount')}) FROM bfact)""",
    }
    for name, table, key, label in (
        ("ref_vendors", "vendors", "vendor", "vendor_name"), ("ref_rate_codes", "rates", "rate_code", "rate_code_name"),
        ("ref_payment_types", "payments", "payment_type", "payment_type_name"),
    ):
        codes = f"(SELECT {key}_key AS {key}_id, {label} FROM {table})"
        found[name] = twice(codes, key, f"{key}_id = 1", unless(f"{key}_id = 2", label), unless(f"{key}_id = 6", f"{key}_id"))
    for name, table, key, also in (
        ("dim_date", "dates", "date_key", "full_date"), ("dim_time", "times", "time_key", "day_period"),
        ("dim_zone", "dzones", "zone_key", "borough"), ("dim_vendor", "vendors", "vendor_key", None),
        ("dim_rate_code", "rates", "rate_code_key", None), ("dim_payment_type", "payments", "payment_type_key", None),
    ):
        faults = [unless(f"{key} % 31 = 3", also)] if also else []
        found[name] = twice(table, key, f"{key} % 40 = 1", *faults, unless(f"{key} % 53 = 5", key))
    found["silver_yellow_trips_rejected"] = f"(SELECT * FROM {found['silver_yellow_trips_evaluated']} WHERE rejection_reason IS NOT NULL)"
    return found


def _gate_damaged() -> str:
    """Every check of every layer, written out over the damaged tables."""
    tables, lines = _damaged_tables(), []

    def count(name: str, rows: str, where: str = "true") -> None:
        lines.append(f"SELECT '{name}' AS \"check\", count(*) AS offenders FROM {rows} WHERE {where}")

    for layer in declared().values():
        for name, checks in layer.items():
            for c in checks.not_null:
                count(f"{name}.not_null.{c}", tables[name], f"{c} IS NULL")
            for c, allowed in checks.accepted.items():
                count(f"{name}.accepted.{c}", tables[name], f"{c} NOT IN ({', '.join(map(_quoted, allowed))})")
            for c in checks.unique:
                count(f"{name}.unique.{c}", f"(SELECT {c} FROM {tables[name]} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
            for c, (parent, key) in checks.references.items():
                count(
                    f"{name}.references.{c}", f"{tables[name]} c",
                    f"c.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {tables[parent]} p WHERE p.{key} = c.{c})",
                )
    count("silver_rules", "broken", SILVER_RULE)
    files = "(SELECT _source_file AS f, count(*) AS n FROM {} GROUP BY 1)"
    count(
        "raw_equals_bronze",
        f"{files.format(tables['yellow_trips'])} r FULL JOIN {files.format(tables['bronze_yellow_trips'])} b ON r.f IS NOT DISTINCT FROM b.f",
        "r.n IS DISTINCT FROM b.n",
    )

    def rows(name: str) -> str:
        return f"(SELECT count(*) FROM {tables[name]})"

    count(
        "bronze_equals_silver_and_rejected", "(SELECT 1)",
        f"{rows('bronze_yellow_trips')} <> {rows('silver_yellow_trips')} + {rows('silver_yellow_trips_rejected')}",
    )
    total = "(SELECT sum(total_amount) FROM {})"
    count(
        "silver_equals_gold", "(SELECT 1)",
        f"{rows('silver_yellow_trips')} <> {rows('fct_trips')} OR {total.format('broken')} <> {total.format(tables['fct_trips'])}",
    )
    return " UNION ALL ".join(lines)


def statements() -> dict[str, str]:
    part_zones = "(SELECT * FROM szones WHERE location_id % 53 <> 0)"
    return {
        "requested_periods": """SELECT CAST(m AS DATE) AS source_period, 'trips_' || strftime(m, '%Y-%m') || '.parquet' AS source_file
            FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS m FROM orders)""",
        "file_inventory_verdict": chain("verdicts", "SELECT source_period, source_file, size_bytes, verdict FROM verdicts"),
        "landing_inventory": chain("verdicts", """SELECT source_file, verdict,
            CAST(n * CASE WHEN date_part('month', source_period) = 3 THEN 101 ELSE 100 END AS BIGINT) AS size_bytes,
            CASE WHEN n IS NOT NULL THEN true END AS has_time FROM verdicts"""),
        "availability_verdict": chain("verdicts", "SELECT source_period, source_file, verdict FROM verdicts WHERE n IS NULL"),
        "change_detection": chain("verdicts", "SELECT source_file, verdict, rows_loaded FROM verdicts WHERE n IS NOT NULL"),
        "forced_reload": chain("verdicts", "SELECT source_file, 'LOAD' AS verdict, CAST(NULL AS BIGINT) AS rows_loaded FROM verdicts WHERE n IS NOT NULL"),
        "ledger_append": chain("ledger", """SELECT status, count(*) AS attempts, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded,
            CAST(max(length(message)) AS INTEGER) AS longest_message FROM ledger GROUP BY status"""),
        "ledger_latest_load": chain("files", "SELECT source_file, n * 100 AS logged_size, n AS logged_rows FROM files"),
        "ledger_listing": chain("ledger", "SELECT source_file, status, rows_loaded, message, CAST(done AS TIMESTAMP) AS finished_at FROM ledger"),
        "rows_per_file": chain("files", "SELECT source_file, n AS rows_present FROM files"),
        "run_lines": chain("verdicts", """SELECT source_file, replace(verdict, 'LOAD', 'LOADED') AS status, CAST(CASE WHEN verdict IN ('LOAD', 'SKIPPED') THEN n END AS BIGINT) AS rows_loaded,
            CASE verdict WHEN 'LOAD' THEN 'ok' WHEN 'SKIPPED' THEN 'already loaded, no change'
                 WHEN 'FAILED' THEN 'missing although it is an old month' ELSE 'not published yet' END AS message FROM verdicts"""),
        "run_summary": chain("files verdicts", "SELECT CAST(sum(n) AS BIGINT) AS trip_rows FROM verdicts"),
        "parquet_by_name_load": chain("raw", f"""SELECT {TRIP_COLUMNS.rsplit(',', 1)[0]},
            CASE WHEN _source_file >= 'trips_1998' THEN cbd_congestion_fee END AS cbd_congestion_fee,
            CASE WHEN _source_file >= 'trips_1998' THEN 'new.parquet' ELSE 'old.parquet' END AS _source_file,
            true AS stamps_in_order FROM raw"""),
        "csv_zone_load": chain("zones bronze", _with_trips(
            "(SELECT locationid, nullif(borough, '') AS borough, nullif(zone, '') AS zone, nullif(service_zone, '') AS service_zone FROM zones)",
            "locationid", "bronze", "pulocationid")),
        "seed_load": chain("silver vendors rates payments", _union(
            _with_trips(f"(SELECT '{name}' AS seed, {key}_key AS code, {label} AS label FROM {table})", "code", "silver", f"{key}_id")
            for name, table, key, label in (
                ("ref_vendors", "vendors", "vendor", "vendor_name"),
                ("ref_rate_codes", "rates", "rate_code", "rate_code_name"),
                ("ref_payment_types", "payments", "payment_type", "payment_type_name"),
            ))),
        "replace_by_file": chain("raw", _per_file("(SELECT * FROM raw WHERE _source_file <> 'trips_1996-05.parquet' OR vendorid < 6)")),
        "full_replace_small": chain("zones bronze", _with_trips(
            "(SELECT locationid, service_zone FROM zones WHERE locationid % 53 <> 0)", "locationid", "bronze", "dolocationid")),
        "bronze_projection": chain("bronze", "SELECT *, true AS stamps_in_order FROM bronze"),
        "bronze_period": chain("bronze", "SELECT _source_file, _source_period, count(*) AS rows FROM bronze GROUP BY ALL"),
        "bronze_new_rows": chain("raw target", _per_file("(SELECT * FROM raw WHERE _loaded_at > (SELECT max(_loaded_at) FROM target))")),
        "bronze_incremental": chain("target", _per_file(
            "(SELECT * FROM target UNION ALL SELECT * FROM bronze WHERE _loaded_at > (SELECT max(_loaded_at) FROM target))")),
        "bronze_full_refresh": chain("bronze", _per_file("bronze")),
        "bronze_stream_refresh": chain("bronze", _per_file("bronze")),
        "bronze_zones": chain("zones bronze", _with_trips("zones", "locationid", "bronze", "pulocationid")),
        "silver_typed": chain("typed", "SELECT * FROM typed"),
        "silver_duration": chain("bronze", """SELECT date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS seconds,
            date_diff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) AS minutes, count(*) AS rows FROM bronze GROUP BY ALL"""),
        "silver_flag": chain("bronze", """SELECT store_and_fwd_flag, CASE store_and_fwd_flag WHEN 'Y' THEN true WHEN ' n ' THEN false END AS is_store_and_forward,
            count(*) AS rows FROM bronze GROUP BY ALL"""),
        "silver_key": chain("ruled", "SELECT trip_id, vendor_id, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id FROM ruled"),
        "silver_rules": chain("ruled", "SELECT trip_id, total_amount, _source_file, broken_rule FROM ruled"),
        "silver_fingerprint": chain("typed", f"""SELECT copies, count(*) AS fingerprints FROM (
            SELECT count(*) AS copies FROM typed GROUP BY {TYPED_COLUMNS}, _source_file, _source_period, _loaded_at) GROUP BY copies"""),
        "silver_dedup_rank": chain("ranked", """SELECT trip_id, broken_rule IS NULL AS is_valid, total_amount, _source_file,
            vendor_id, pickup_datetime, pickup_location_id, dedup_rank FROM ranked""", typed_from="ties"),
        "silver_reversal": chain("ranked", "SELECT trip_id, pickup_datetime, total_amount, has_reversal FROM ranked", typed_from="ties"),
        "silver_reason": chain("evaluated", "SELECT * FROM evaluated", typed_from="ties"),
        "silver_reason_english": chain("evaluated", "SELECT rejection_reason, has_reversal, count(*) AS rows FROM evaluated GROUP BY ALL", ENGLISH),
        "silver_valid": chain("evaluated", "SELECT * EXCLUDE (rejection_reason) FROM evaluated WHERE rejection_reason IS NULL"),
        "silver_quarantine": chain("evaluated", "SELECT * FROM evaluated WHERE rejection_reason IS NOT NULL"),
        "silver_repairs": chain("silver", "SELECT * FROM silver"),
        "silver_zones": chain("szones silver", _with_trips("szones", "location_id", "silver", "pickup_location_id")),
        "rejections_by_reason": chain("evaluated", "SELECT rejection_reason, count(rejection_reason) AS rows FROM evaluated GROUP BY 1 HAVING count(rejection_reason) > 0"),
        "date_key": chain("fact", "SELECT pickup_date_key AS date_key, pickup_time_key AS time_key, count(*) AS trips FROM fact GROUP BY ALL"),
        "fact_trips": chain("fact", "SELECT * FROM fact"),
        "dim_date": chain("dates fact", _with_trips("dates", "date_key", "fact", "pickup_date_key")),
        "dim_date_english": chain("dates", "SELECT * FROM dates", ENGLISH),
        "dim_time": chain("times fact", _with_trips("times", "time_key", "fact", "pickup_time_key")),
        "dim_zone": chain("dzones fact", _with_trips("dzones", "zone_key", "fact", "dropoff_zone_key")),
        "dim_vendor": chain("vendors fact", _with_trips("vendors", "vendor_key", "fact", "vendor_key")),
        "dim_rate_code": chain("rates fact", _with_trips("rates", "rate_code_key", "fact", "rate_code_key")),
        "dim_payment_type": chain("payments fact", _with_trips("payments", "payment_type_key", "fact", "payment_type_key")),
        "star_report": chain("fact dzones times dates", STAR),
        "role_playing_report": chain("fact dzones", """SELECT a.borough AS pickup_borough, b.borough AS dropoff_borough, count(*) AS trips,
            CAST(sum(total_amount) AS DECIMAL(38,2)) AS total_amount
            FROM fact JOIN dzones a ON a.zone_key = pickup_zone_key JOIN dzones b ON b.zone_key = dropoff_zone_key GROUP BY ALL"""),
        "derived_measures": chain("fact", f"""SELECT vendor_key, payment_type_key,
            {_ratio('trip_distance_miles', 'trip_duration_minutes', 60)} AS miles_per_hour,
            {_ratio('tip_amount', 'fare_amount', 100)} AS tip_percent,
            CAST({_half_up(f"sum({_cents('total_amount')})", "(count(total_amount) * 100)", 4)} AS DECIMAL(18,4)) AS mean_amount
            FROM fact GROUP BY ALL"""),
        "additive_measures": chain("fact", _additive("pickup_time_key, rate_code_key")),
        "net_revenue": chain("fact", _net("_source_period")),
        "net_revenue_month": chain("fact", _net("_source_period").replace("FROM fact", f"FROM {MAY}")),
        "star_report_month": chain("fact dzones times dates", STAR.replace("FROM fact", f"FROM {MAY}")),
        "check_not_null": chain("broken", _union(
            f"SELECT '{c}' AS \"check\", count(*) - count({c}) AS offenders FROM broken"
            for c in ("trip_id", "vendor_id", "payment_type_id", "total_amount"))),
        "check_unique": chain("broken", "SELECT trip_id, count(trip_id) AS n FROM broken GROUP BY trip_id HAVING count(trip_id) > 1"),
        "check_relationships": chain("broken vendors rates payments szones", _union([
            _orphan_line("vendor_id", "vendors", "vendor_key"), _orphan_line("rate_code_id", "rates", "rate_code_key"),
            _orphan_line("payment_type_id", "payments", "payment_type_key"),
            _orphan_line("pickup_location_id", part_zones, "location_id"),
            _orphan_line("dropoff_location_id", part_zones, "location_id")])),
        "check_relationship_rows": chain("broken", "SELECT trip_id, vendor_id, total_amount FROM broken WHERE vendor_id = 5"),
        "check_accepted_values": chain("evaluated", f"""SELECT trip_id, rejection_reason, duration_seconds FROM evaluated
            WHERE rejection_reason = '{SOURCE.no_movement}'"""),
        "reconcile_raw_bronze": chain("raw target", """SELECT coalesce(r.f, t.f) AS _source_file, r.n AS raw_rows, t.n AS bronze_rows
            FROM (SELECT _source_file AS f, count(*) AS n FROM raw GROUP BY 1) r
            FULL JOIN (SELECT _source_file AS f, count(*) AS n FROM target GROUP BY 1) t ON r.f = t.f
            WHERE coalesce(r.n, 0) <> coalesce(t.n, 0)"""),
        "reconcile_contents": chain("raw bronze", f"""SELECT r.f AS _source_file, r.n AS raw_rows, b.n AS bronze_rows
            FROM (SELECT DISTINCT _source_file AS f FROM (
                SELECT _source_file, {TRIP_COLUMNS} FROM (SELECT * REPLACE (CASE WHEN pulocationid % 9 = 2
                    AND _source_file = 'trips_1996-05.parquet' THEN total_amount + 1 ELSE total_amount END AS total_amount) FROM raw)
                EXCEPT ALL SELECT _source_file, {TRIP_COLUMNS} FROM bronze)) d
            JOIN (SELECT _source_file AS f, count(*) AS n FROM raw GROUP BY 1) r ON r.f = d.f
            JOIN (SELECT _source_file AS f, count(*) AS n FROM bronze GROUP BY 1) b ON b.f = d.f"""),
        "reconcile_bronze_silver": chain("evaluated", f"""SELECT * FROM (SELECT count(*) AS bronze_rows,
            count(*) FILTER (WHERE rejection_reason IS NULL) AS valid_rows,
            count(*) FILTER (WHERE rejection_reason <> '{SOURCE.duplicate}') AS rejected_rows FROM evaluated)
            WHERE bronze_rows > valid_rows + rejected_rows"""),
        "check_silver_rules": chain("broken", f"""SELECT trip_id, pickup_datetime, dropoff_datetime, trip_distance_miles, passenger_count,
            fare_amount, total_amount FROM broken WHERE {SILVER_RULE}"""),
        "reconcile_silver_gold": chain("fact", """SELECT count(*) AS silver_rows, count(*) FILTER (WHERE NOT has_reversal) AS gold_rows,
            CAST(sum(total_amount) AS DECIMAL(28,2)) AS silver_total,
            CAST(sum(total_amount) FILTER (WHERE NOT has_reversal) AS DECIMAL(28,2)) AS gold_total FROM fact
            HAVING count(*) <> count(*) FILTER (WHERE NOT has_reversal)"""),
        "quality_gate": chain("raw zones vendors rates payments evaluated silver szones fact dates times dzones", _gate()),
        "quality_gate_damaged": chain(
            "raw zones bronze vendors rates payments evaluated broken bfact szones dates times dzones", _gate_damaged()),
        "profile_completeness": chain("bronze", _completeness()),
        "profile_categories": chain("bronze", _categories()),
        "profile_duplicates": chain("bronze", _duplicates()),
        "profile_orphans": chain("bronze", """SELECT 'pickup' AS role, pulocationid AS locationid, count(*) AS rows FROM bronze WHERE pulocationid % 53 = 0 GROUP BY ALL
            UNION ALL SELECT 'dropoff', dolocationid, count(*) FROM bronze WHERE dolocationid % 53 = 0 GROUP BY ALL"""),
        "profile_catalog": chain("zones bronze", _with_trips(
            "(SELECT locationid, borough, zone, service_zone FROM zones WHERE locationid >= 264)", "locationid", "bronze", "pulocationid")),
        "profile_negative_amounts": chain("bronze", f"""SELECT vendorid, payment_type, count(*) AS rows,
            count(*) FILTER (WHERE greatest(fare_amount, total_amount) < 0) AS both_negative,
            count(*) FILTER (WHERE fare_amount < 0 AND total_amount >= 0) AS fare_only_negative,
            count(*) FILTER (WHERE total_amount < 0 AND fare_amount >= 0) AS total_only_negative,
            {_median_money('total_amount', 'fare_amount < 0 AND total_amount >= 0')} AS median_total_fare_only
            FROM bronze GROUP BY ALL"""),
        "profile_duplicate_patterns": chain("bronze", _patterns()),
        "profile_zero_matrix": chain("bronze", f"""SELECT tpep_pickup_datetime = tpep_dropoff_datetime AS zero_duration, trip_distance = 0 AS zero_distance,
            count(*) AS rows, count(*) FILTER (WHERE total_amount > 0) AS paid_rows, {_median_money('total_amount')} AS median_total
            FROM bronze GROUP BY ALL"""),
        "pipeline_run": chain("fact", _additive("vendor_key, has_reversal")),
    }
